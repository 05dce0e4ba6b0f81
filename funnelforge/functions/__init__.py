from funnelforge.functions.semantics import (  # noqa: F401
    round_half_away, hours_between, try_timestamp, try_int_rounded,
    epoch_to_ts, month_start, safe_div, cents_to_usd, first_element, email_domain,
)
from funnelforge.functions.jsonx import parse_doc, json_text, json_kind  # noqa: F401
