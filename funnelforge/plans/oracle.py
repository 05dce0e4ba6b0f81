"""DuckDB oracle SQL for the query catalogue.

Every oracle is one statement: the TESTDATA adapter CTEs (rendered from the
same definitions the Spark side uses, see sources.testdata) followed by the
model CTEs written directly in warehouse SQL, and a final SELECT.  The model
CTEs follow the published model semantics plus the tie-break and conflict
decisions this package documents (README, "Semantics decisions").
"""

from __future__ import annotations

import re

from funnelforge.sources.testdata import RAW_TABLES, duck_raw_cte

CTES: dict[str, str] = {name: duck_raw_cte(name) for name in RAW_TABLES}


def _json_kind(expr: str) -> str:
    t = f"json_type({expr})"
    return (f"CASE WHEN {t} IS NULL THEN NULL WHEN {t} = 'VARCHAR' THEN 'string' "
            f"WHEN {t} = 'NULL' THEN 'null' WHEN {t} = 'BOOLEAN' THEN 'boolean' "
            f"WHEN {t} = 'OBJECT' THEN 'object' WHEN {t} = 'ARRAY' THEN 'array' ELSE 'number' END")


# Broken text is no document; it yields no fields.
CTES["event_docs"] = "SELECT raw_json, CASE WHEN json_valid(raw_json) THEN raw_json END AS doc, _loaded_at FROM events_raw"

CTES["parsed_events"] = f"""
SELECT doc ->> '$.event_id' AS event_id,
       doc ->> '$.event_name' AS event_name,
       {_json_kind("doc -> '$.event_name'")} AS event_name_json_type,
       try_cast(doc ->> '$.event_ts' AS TIMESTAMP) AS event_ts,
       try_cast(doc ->> '$.received_ts' AS TIMESTAMP) AS received_ts,
       doc ->> '$.anonymous_id' AS anonymous_id,
       doc ->> '$.user_id' AS user_id,
       doc ->> '$.device_type' AS device_type,
       doc ->> '$.properties.account_id' AS account_id,
       doc ->> '$.properties.page' AS page,
       doc ->> '$.properties.utm_source' AS utm_source,
       doc ->> '$.properties.email' AS email,
       doc ->> '$.schema_version' AS schema_version,
       raw_json, _loaded_at
FROM event_docs"""

_VALID = """event_id IS NOT NULL AND event_name IS NOT NULL AND event_name_json_type = 'string'
      AND event_ts IS NOT NULL AND (anonymous_id IS NOT NULL OR user_id IS NOT NULL)"""

_STG_COLS = ("event_id, event_name, event_ts, received_ts, anonymous_id, user_id, device_type, "
             "account_id, page, utm_source, email, schema_version")


def stg_events_sql(source: str, extra_where: str = "") -> str:
    return f"""
SELECT {_STG_COLS}, date_diff('hour', event_ts, received_ts) AS arrival_delay_hours
FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                                   ORDER BY received_ts ASC NULLS LAST, md5(raw_json) ASC NULLS LAST) AS rn
      FROM {source}
      WHERE {_VALID} {extra_where}) d
WHERE rn = 1"""


CTES["stg_events"] = stg_events_sql("parsed_events")

CTES["dead_letter"] = """
SELECT event_id, raw_json,
       CASE WHEN event_ts IS NULL THEN 'missing_or_invalid_event_ts'
            WHEN event_name_json_type <> 'string' THEN 'event_name_not_string'
            WHEN anonymous_id IS NULL AND user_id IS NULL THEN 'no_identity'
            ELSE 'unknown_violation' END AS failure_reason,
       _loaded_at
FROM parsed_events
WHERE event_ts IS NULL OR event_name_json_type <> 'string' OR (anonymous_id IS NULL AND user_id IS NULL)"""

CTES["stg_companies"] = """
SELECT id AS crm_company_id, properties.name AS company_name, lower(properties.domain) AS domain,
       properties.industry AS industry, try_cast(properties.numberofemployees AS INTEGER) AS employee_count,
       properties.lifecyclestage AS lifecycle_stage,
       try_cast(properties.createdate AS TIMESTAMP) AS crm_created_at
FROM hubspot_companies"""

CTES["stg_contacts"] = """
SELECT id AS crm_contact_id, lower(properties.email) AS email, properties.firstname AS first_name,
       properties.lastname AS last_name, properties.associatedcompanyid AS crm_company_id
FROM hubspot_contacts"""

CTES["stg_deals"] = """
SELECT id AS crm_deal_id, properties.dealname AS deal_name,
       try_cast(properties.amount AS DECIMAL(12,2)) AS deal_amount_annual,
       properties.dealstage AS deal_stage, try_cast(properties.closedate AS DATE) AS close_date,
       properties.associatedcompanyid AS crm_company_id
FROM hubspot_deals"""

CTES["stg_customers"] = """
SELECT id AS stripe_customer_id, lower(email) AS email, name AS customer_name,
       make_timestamp(created * 1000000) AS billing_created_at, metadata.account_id AS account_id
FROM stripe_customers"""

CTES["stg_subscriptions"] = """
SELECT id AS stripe_subscription_id, customer AS stripe_customer_id, status,
       make_timestamp(current_period_start * 1000000) AS period_start_at,
       make_timestamp(try_cast(canceled_at AS BIGINT) * 1000000) AS canceled_at,
       items.data[1].price.id AS stripe_price_id,
       items.data[1].price.unit_amount / 100.0 AS unit_price_usd,
       items.data[1].quantity AS seat_count
FROM stripe_subscriptions"""

CTES["stg_invoices"] = """
SELECT id AS stripe_invoice_id, customer AS stripe_customer_id, subscription AS stripe_subscription_id,
       amount_paid / 100.0 AS amount_usd, status AS invoice_status,
       make_timestamp(created * 1000000) AS invoiced_at,
       date_trunc('month', make_timestamp(created * 1000000)) AS invoice_month,
       lines.data[1].quantity AS seat_count
FROM stripe_invoices"""

# Identity and marts: formulated over aggregates of whole rows (the smallest
# struct of a group), as-of joins and per-key sums, not with the operators' plans.
CTES["identify_claims"] = """
SELECT anonymous_id, user_id, account_id, event_ts, lower(email) AS mail
FROM stg_events WHERE event_name = 'identify'"""

CTES["anon_to_user"] = """
SELECT device AS anonymous_id, claim.who AS user_id, claim.at AS first_identified_at,
       claimants > 1 AS had_conflicting_claims
FROM (FROM identify_claims
      SELECT anonymous_id AS device, min({'at': event_ts, 'who': user_id}) AS claim,
             count(DISTINCT user_id) AS claimants
      WHERE anonymous_id IS NOT NULL AND user_id IS NOT NULL GROUP BY ALL)"""

CTES["user_to_account"] = """
SELECT who AS user_id, claim.acct AS account_id, claim.mail AS email, claim.at AS joined_at
FROM (FROM identify_claims
      SELECT user_id AS who,
             min({'at': event_ts, 'acct': account_id, 'unknown': mail IS NULL, 'mail': mail}) AS claim
      WHERE user_id IS NOT NULL AND account_id IS NOT NULL GROUP BY ALL)"""

CTES["domain_votes"] = """
FROM user_to_account SELECT account_id, split_part(email, '@', 2) AS dom, count(*) AS voters GROUP BY ALL"""

CTES["oldest_company"] = """
FROM stg_companies
SELECT domain AS dom, min({'undated': crm_created_at IS NULL, 'born': crm_created_at, 'id': crm_company_id,
                           'label': company_name, 'stage': lifecycle_stage}) AS co
WHERE domain IS NOT NULL GROUP BY ALL"""

CTES["account_spine"] = """
SELECT v.account_id, v.pick.dom AS email_domain, o.co.id AS crm_company_id, o.co.label AS company_name,
       o.co.stage AS lifecycle_stage, b.stripe_customer_id,
       EXISTS (FROM oldest_company x WHERE x.dom = v.pick.dom) AS is_crm_matched,
       EXISTS (FROM stg_customers x WHERE x.account_id = v.account_id) AS is_billing_matched
FROM (FROM domain_votes
      SELECT account_id, min({'rank': -voters, 'unknown': dom IS NULL, 'dom': dom}) AS pick GROUP BY ALL) v
LEFT JOIN oldest_company o ON o.dom = v.pick.dom
LEFT JOIN stg_customers b ON b.account_id = v.account_id"""

CTES["fct_events"] = """
SELECT event_id, event_name, event_ts, device_type, page, utm_source, person AS user_id,
       coalesce(account_id, (SELECT u.account_id FROM user_to_account u WHERE u.user_id = person)) AS account_id,
       user_id IS NULL AND person IS NOT NULL AS is_stitched, anonymous_id
FROM (SELECT *, coalesce(user_id, (SELECT a.user_id FROM anon_to_user a
                                   WHERE a.anonymous_id = stg_events.anonymous_id)) AS person
      FROM stg_events WHERE event_name <> 'identify')"""

CTES["first_touches"] = """
FROM fct_events
SELECT account_id, min({'at': event_ts, 'via': utm_source, 'event': event_id}) AS touch
WHERE account_id IS NOT NULL AND utm_source IS NOT NULL GROUP BY ALL"""

CTES["dim_accounts"] = """
SELECT account_id, company_name, email_domain, crm_company_id, stripe_customer_id, is_crm_matched,
       is_billing_matched, touch.via AS first_touch_channel, touch.at AS first_touch_at
FROM account_spine LEFT JOIN first_touches USING (account_id)"""

CTES["paid_months"] = """
SELECT i.invoice_month AS month, c.account_id, coalesce(c.account_id, '') AS k, sum(i.amount_usd) AS mrr
FROM stg_invoices i JOIN stg_customers c ON c.stripe_customer_id = i.stripe_customer_id
WHERE i.invoice_status = 'paid' GROUP BY i.invoice_month, c.account_id"""

CTES["fct_mrr_monthly"] = """
SELECT now.month AS invoice_month, now.account_id, now.mrr, coalesce(was.mrr, 0) AS prev_mrr,
       CASE WHEN was.k IS NULL OR now.month - was.month > INTERVAL 35 DAY THEN 'new'
            WHEN now.mrr > was.mrr THEN 'expansion' WHEN now.mrr < was.mrr THEN 'contraction' ELSE 'retained' END AS movement
FROM paid_months now ASOF LEFT JOIN paid_months was ON now.k = was.k AND now.month > was.month"""

CTES["cohort_sums"] = """
SELECT month, k, sum(had) AS had, sum(kept) AS kept, bool_or(earned) AS earned
FROM (SELECT invoice_month + INTERVAL 1 MONTH AS month, coalesce(account_id, '') AS k,
             mrr AS had, 0 AS kept, FALSE AS earned FROM fct_mrr_monthly
      UNION ALL
      SELECT invoice_month, coalesce(account_id, ''), NULL, if(account_id IS NULL, 0, mrr), TRUE FROM fct_mrr_monthly)
GROUP BY ALL"""

CTES["fct_ndr"] = """
SELECT month AS invoice_month, count(had) AS base_accounts, round(sum(had), 2) AS base_mrr,
       round(sum(kept) FILTER (had IS NOT NULL), 2) AS retained_mrr,
       round(sum(kept) FILTER (had IS NOT NULL) / nullif(sum(had), 0), 4) AS ndr,
       count(*) FILTER (had IS NOT NULL AND kept = 0) AS churned_accounts
FROM cohort_sums GROUP BY month HAVING bool_or(earned) AND count(had) > 0"""

CTES["fct_revenue_attribution"] = """
SELECT channel, count(*) AS accounts_signed_up, count(earned) AS accounts_paying,
       round(count(earned) / count(*), 3) AS signup_to_paid_rate,
       round(coalesce(sum(earned), 0), 2) AS total_revenue_usd,
       round(coalesce(sum(earned), 0) / nullif(count(earned), 0), 2) AS revenue_per_paying_account
FROM (SELECT ifnull(first_touch_channel, '(unattributed)') AS channel,
             (SELECT sum(f.mrr) FROM fct_mrr_monthly f WHERE f.account_id = dim_accounts.account_id) AS earned
      FROM dim_accounts) GROUP BY channel"""

_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(sql: str, known: list[str]) -> list[str]:
    words = set(_WORD.findall(sql))
    return [k for k in known if k in words]


def with_ctes(final_select: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``final_select`` with every CTE it needs (transitively), in order."""
    ctes = dict(CTES)
    ctes.update(extra or {})
    order = list(ctes)
    needed: set[str] = set()
    stack = _deps(final_select, order)
    while stack:
        n = stack.pop()
        if n in needed:
            continue
        needed.add(n)
        stack.extend(d for d in _deps(ctes[n], order) if d != n)
    # adapter CTEs shadow the TESTDATA views only by their own names
    parts = [f"{n} AS ({ctes[n].strip()})" for n in order if n in needed]
    if not parts:
        return final_select.strip()
    return "WITH " + ",\n".join(parts) + "\n" + final_select.strip()


# ---------------------------------------------------------------------------
# Contract rules in warehouse SQL (generated from the same contract document
# the Spark compiler reads; the two compilers are independent).
# ---------------------------------------------------------------------------
def _sql_lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def contract_violations_sql(schema: dict, raw: str = "doc") -> str:
    """SQL list expression of violated rule codes in validator order."""
    def kind(path: str | None) -> str:
        t = f"json_type({raw})" if path is None else f"json_type({raw}, '{path}')"
        return (f"(CASE WHEN {t} IS NULL THEN NULL WHEN {t} = 'VARCHAR' THEN 'string' "
                f"WHEN {t} = 'NULL' THEN 'null' WHEN {t} = 'BOOLEAN' THEN 'boolean' "
                f"WHEN {t} = 'OBJECT' THEN 'object' WHEN {t} = 'ARRAY' THEN 'array' ELSE 'number' END)")

    def has(k: str) -> str:
        return f"(json_type({raw}, '$.{k}') IS NOT NULL)"

    def types(spec) -> list[str]:
        t = spec.get("type")
        return [] if t is None else ([t] if isinstance(t, str) else list(t))

    is_obj = f"({kind(None)} = 'object')"
    rules: list[tuple[str, str]] = []
    top = types(schema)
    if top:
        rules.append(("not_json", f"{raw} IS NULL"))
        rules.append(("type", f"NOT ({kind(None)} IN ({', '.join(_sql_lit(t) for t in top)}))"))
    for k in schema.get("required", []):
        rules.append((f"required:{k}", f"{is_obj} AND NOT {has(k)}"))
    for k, spec in schema.get("properties", {}).items():
        kk = kind(f"$.{k}")
        allowed = types(spec)
        if allowed:
            rules.append((f"type:{k}", f"{is_obj} AND {has(k)} AND NOT ({kk} IN ({', '.join(_sql_lit(t) for t in allowed)}))"))
        if "pattern" in spec:
            rules.append((f"pattern:{k}", f"{is_obj} AND {kk} = 'string' AND NOT regexp_matches({raw} ->> '$.{k}', {_sql_lit(spec['pattern'])})"))
        if "enum" in spec:
            vals = [v for v in spec["enum"] if v is not None]
            ok = f"({kk} = 'string' AND ({raw} ->> '$.{k}') IN ({', '.join(_sql_lit(v) for v in vals)}))"
            if None in spec["enum"]:
                ok = f"({ok} OR {kk} = 'null')"
            rules.append((f"enum:{k}", f"{is_obj} AND {has(k)} AND NOT {ok}"))
    if schema.get("anyOf"):
        branches = []
        for sub in schema["anyOf"]:
            req = sub.get("required", [])
            branches.append("(" + " AND ".join(has(k) for k in req) + ")" if req else "TRUE")
        code = "anyOf:" + "|".join("+".join(s.get("required", [])) for s in schema["anyOf"])
        rules.append((code, f"{is_obj} AND NOT ({' OR '.join(branches)})"))
    if schema.get("additionalProperties") is False:
        known = "[" + ", ".join(_sql_lit(k) for k in schema.get("properties", {})) + "]"
        rules.append(("additional_properties",
                      f"{is_obj} AND len(list_filter(json_keys({raw}), lambda x: NOT list_contains({known}, x))) > 0"))
    items = ", ".join(f"CASE WHEN {cond} THEN {_sql_lit(code)} END" for code, cond in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"
