"""Event documents for tests."""

import json


def doc(event_id="evt_" + "a" * 32, name="page_viewed", ts="2025-01-01T10:00:00Z", received=None,
        anon="anon_" + "1" * 12, user=None, device="desktop_web", account=None, utm=None, email=None,
        page=None, drop=(), **extra):
    """One event document as JSON text; keys in ``drop`` are left out."""
    d = {"event_id": event_id, "event_name": name, "event_ts": ts,
         "received_ts": received if received is not None else ts,
         "anonymous_id": anon, "user_id": user, "device_type": device, "user_agent": "Mozilla/5.0",
         "schema_version": "1.0.0",
         "properties": {"account_id": account, "page": page, "utm_source": utm, "email": email}}
    d.update(extra)
    for k in drop:
        d.pop(k, None)
    return json.dumps(d, separators=(",", ":"))
