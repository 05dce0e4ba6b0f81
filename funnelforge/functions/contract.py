"""The product-event wire contract, compiled to Column rules.

The contract is a JSON-Schema (draft 2020-12) document.  Instead of running a
validator per record, ``compile_contract`` turns the keywords used by the
contract (type, required, properties/type/pattern/enum, anyOf-of-required,
additionalProperties=false) into boolean Column expressions evaluated in one
pass over the parsed VARIANT.  ``violations`` yields the violated rule codes in
the order a validator reports them (schema keyword order), so the first code
is the failure reason.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelforge.functions.jsonx import json_kind, text_kind, with_doc

# ---------------------------------------------------------------------------
# The v1 product-event contract (must equal the published one).
# ---------------------------------------------------------------------------
EVENT_NAMES = [
    "page_viewed", "signed_up", "identify", "session_started",
    "doc_created", "doc_edited", "comment_added", "search_performed",
    "integration_used", "member_invited", "export_performed",
]
DEVICE_TYPES = ["desktop_web", "mobile_web", "ios_app", "android_app"]

PRODUCT_EVENT_V1 = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "title": "Product event contract v1.0.0",
    "type": "object",
    "required": ["event_id", "event_name", "event_ts", "schema_version"],
    "properties": {
        "event_id": {"type": "string", "pattern": "^evt_[a-f0-9]{32}$"},
        "event_name": {"type": "string", "enum": EVENT_NAMES},
        "event_ts": {"type": "string", "format": "date-time"},
        "received_ts": {"type": ["string", "null"], "format": "date-time"},
        "anonymous_id": {"type": ["string", "null"], "pattern": "^anon_[a-f0-9]{12}$"},
        "user_id": {"type": ["string", "null"], "pattern": "^usr_[a-f0-9]{12}$"},
        "device_type": {"type": ["string", "null"], "enum": DEVICE_TYPES + [None]},
        "user_agent": {"type": ["string", "null"]},
        "schema_version": {"type": "string", "pattern": "^1\\.\\d+\\.\\d+$"},
        "properties": {"type": "object"},
    },
    "anyOf": [{"required": ["anonymous_id"]}, {"required": ["user_id"]}],
    "additionalProperties": False,
}


@dataclass(frozen=True)
class Rule:
    code: str
    violated: Column  # TRUE when the document breaks the rule


def load_contract(path: str) -> dict:
    """Read a contract file (JSON Schema) from the driver's file system."""
    with open(path) as fh:
        return json.load(fh)


def _types(spec) -> list[str]:
    t = spec.get("type")
    if t is None:
        return []
    return [t] if isinstance(t, str) else list(t)


def _kind_ok(kind: Column, allowed: list[str]) -> Column:
    # JSON Schema "integer" is a subset of "number"; the contract uses neither
    names = set(allowed) | ({"number"} if "integer" in allowed else set())
    return kind.isin(sorted(names))


def _java_pattern(p: str) -> str:
    # Validators use Python's ``re``: \d and \w match any Unicode digit /
    # word character.  Java needs UNICODE_CHARACTER_CLASS for the same meaning.
    return "(?U)" + p


def contract_keys(schema: dict) -> list[str]:
    """Top-level keys whose kind / text the rules need."""
    keys = list(schema.get("required", [])) + list(schema.get("properties", {}))
    for sub in schema.get("anyOf", []) or []:
        keys += sub.get("required", [])
    return list(dict.fromkeys(keys))


def _kind_col(key: str | None) -> str:
    return "_kind" if key is None else f"_kind_{key}"


def _text_col(key: str) -> str:
    return f"_text_{key}"


def _once(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Add ``column``, evaluated once: the optimizer cannot copy a generator's
    value into the expressions and filters above it (see ``with_doc``)."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def with_contract_inputs(df: DataFrame, schema: dict, raw_col: str = "raw_json") -> DataFrame:
    """Add, once per document, the JSON kind of the document and of every key the
    rules look at, the text of keys with pattern / enum rules, and the key list.

    The document is cast once to a map of its members; kinds and texts are taken
    from the members found there.  A document that the variant parser refuses
    although it is JSON (duplicate keys) is read by its text instead.
    """
    raw, doc = F.col(raw_col), F.col("_doc")
    members = F.try_variant_get(doc, "$", "map<string,variant>")
    d = _once(with_doc(df, raw_col), F.struct(
        members.alias("map"), F.when(doc.isNull(), F.json_object_keys(raw)).alias("text_keys")), "_members")
    found, text_keys = F.col("_members.map"), F.col("_members.text_keys")
    props = schema.get("properties", {})
    cols = [F.when(found.isNotNull() | text_keys.isNotNull(), "object").when(doc.isNotNull(), "other").alias(_kind_col(None)),
            F.coalesce(F.map_keys(found), text_keys).alias("_keys")]
    for k in contract_keys(schema):
        member = F.try_element_at(found, F.lit(k))
        cols.append(F.when(text_keys.isNull(), json_kind(member)).otherwise(text_kind(raw, k)).alias(_kind_col(k)))
        spec = props.get(k, {})
        if "pattern" in spec or "enum" in spec:
            cols.append(F.when(text_keys.isNull(), F.try_variant_get(member, "$", "string"))
                        .otherwise(F.get_json_object(raw, f"$.{k}")).alias(_text_col(k)))
    return _once(d, F.struct(*cols), "_in")


def compile_contract(schema: dict, raw: Column | None = None) -> list[Rule]:
    """Compile the contract keywords into ordered rules over the columns made
    by ``with_contract_inputs``."""
    rules: list[Rule] = []
    kind = F.col(f"_in.{_kind_col(None)}")
    is_obj = kind == "object"

    def has(key: str) -> Column:
        return F.col(f"_in.{_kind_col(key)}").isNotNull()

    top = _types(schema)
    if top:
        # an unparseable document is reported as such, not as a type error
        rules.append(Rule("not_json", kind.isNull()))
        rules.append(Rule("type", kind.isNotNull() & ~_kind_ok(kind, top)))

    for key in schema.get("required", []):
        rules.append(Rule(f"required:{key}", is_obj & ~has(key)))

    for key, spec in schema.get("properties", {}).items():
        k = F.col(f"_in.{_kind_col(key)}")
        allowed = _types(spec)
        if allowed:
            rules.append(Rule(f"type:{key}", is_obj & has(key) & ~_kind_ok(k, allowed)))
        if "pattern" in spec:
            txt = F.col(f"_in.{_text_col(key)}")
            rules.append(Rule(f"pattern:{key}",
                              is_obj & (k == "string") & ~txt.rlike(_java_pattern(spec["pattern"]))))
        if "enum" in spec:
            values = [v for v in spec["enum"] if v is not None]
            ok = (k == "string") & F.col(f"_in.{_text_col(key)}").isin(values)
            if None in spec["enum"]:
                ok = ok | (k == "null")
            rules.append(Rule(f"enum:{key}", is_obj & has(key) & ~ok))

    any_of = schema.get("anyOf")
    if any_of:
        branches = []
        for sub in any_of:
            cond = F.lit(True)
            for key in sub.get("required", []):
                cond = cond & has(key)
            branches.append(cond)
        satisfied = branches[0]
        for b in branches[1:]:
            satisfied = satisfied | b
        rules.append(Rule("anyOf:" + "|".join("+".join(s.get("required", [])) for s in any_of),
                          is_obj & ~satisfied))

    if schema.get("additionalProperties") is False:
        known = F.array(*[F.lit(k) for k in schema.get("properties", {})])
        rules.append(Rule("additional_properties",
                          is_obj & (F.size(F.array_except(F.col("_in._keys"), known)) > 0)))
    return rules


def violations(raw: Column | str, schema: dict | None = None) -> Column:
    """array<string> of violated rule codes, in validator order (empty = valid).

    Expects the columns of ``with_contract_inputs``.  Built as a concatenation
    of zero-or-one element arrays (no higher-order function, so the whole
    projection stays in generated code).
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    rules = compile_contract(schema or PRODUCT_EVENT_V1, raw)
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(F.coalesce(r.violated, F.lit(False)), F.array(F.lit(r.code)))
                      .otherwise(none) for r in rules])


def validate(df: DataFrame, raw_col: str = "raw_json", schema: dict | None = None) -> DataFrame:
    """K-8 input: ``df`` plus ``violations`` (array) and ``failure_reason`` (first
    code; NULL when the document is valid)."""
    schema = schema or PRODUCT_EVENT_V1
    checked = _once(with_contract_inputs(df, schema, raw_col), violations(raw_col, schema), "violations")
    return checked.withColumn("failure_reason", F.get(F.col("violations"), 0)).drop("_doc", "_members", "_in")


def contract_report(validated: DataFrame) -> DataFrame:
    """K-9: valid count, dead-letter count and dead-letter share (percent, 3
    decimals; NULL without documents) of validated documents in one aggregation."""
    from funnelforge.functions.semantics import round_half_away, safe_div
    bad = F.size("violations") > 0
    return validated.agg(
        F.count_if(~bad).alias("valid_count"),
        F.count_if(bad).alias("dead_letter_count"),
        round_half_away(safe_div(F.count_if(bad) * F.lit(100.0), F.count(F.lit(1))), 3).alias("dead_letter_pct"))


def contract_samples(validated: DataFrame, n: int = 3, order_by: str = "raw_json") -> DataFrame:
    """K-9: ``n`` sample violations (event id text, first reason), the first by
    ``order_by`` – a top-n, so only ``n`` rows per task reach the driver."""
    return (validated.filter(F.size("violations") > 0)
            .select(F.get_json_object("raw_json", "$.event_id").alias("event_id"), "failure_reason", order_by)
            .orderBy(order_by).limit(n).select("event_id", "failure_reason"))
