"""Bronze layer: land raw inputs with an explicit schema and a load time.

* events     – NDJSON, one document per line, kept as the original string
               (schema-on-read; typing happens in staging).
* CRM export – companies / contacts / deals, nested ``properties`` wrapper.
* billing    – customers / subscriptions / invoices, nested ``items`` /
               ``lines`` arrays and ``metadata``.

Schemas are fixed here instead of inferred: inference lets a column's type
drift with its null density (``canceled_at``), which is exactly the failure
mode to avoid.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L = T.StringType(), T.LongType()


def _f(name, dtype):
    return T.StructField(name, dtype, True)


def _struct(*fields):
    return T.StructType(list(fields))


EVENTS_RAW = _struct(_f("raw_json", S), _f("_loaded_at", T.TimestampNTZType()))

HUBSPOT_COMPANIES = _struct(
    _f("id", S),
    _f("properties", _struct(_f("name", S), _f("domain", S), _f("industry", S),
                             _f("numberofemployees", L), _f("lifecyclestage", S), _f("createdate", S))))
HUBSPOT_CONTACTS = _struct(
    _f("id", S),
    _f("properties", _struct(_f("email", S), _f("firstname", S), _f("lastname", S),
                             _f("associatedcompanyid", S), _f("createdate", S))))
HUBSPOT_DEALS = _struct(
    _f("id", S),
    _f("properties", _struct(_f("dealname", S), _f("amount", L), _f("dealstage", S),
                             _f("closedate", S), _f("associatedcompanyid", S))))
STRIPE_CUSTOMERS = _struct(
    _f("id", S), _f("object", S), _f("email", S), _f("name", S), _f("created", L),
    _f("metadata", _struct(_f("account_id", S))))
STRIPE_SUBSCRIPTIONS = _struct(
    _f("id", S), _f("object", S), _f("customer", S), _f("status", S),
    _f("current_period_start", L), _f("canceled_at", L),
    _f("items", _struct(_f("data", T.ArrayType(_struct(
        _f("price", _struct(_f("id", S), _f("unit_amount", L))), _f("quantity", L)))))))
STRIPE_INVOICES = _struct(
    _f("id", S), _f("object", S), _f("customer", S), _f("subscription", S),
    _f("amount_paid", L), _f("currency", S), _f("status", S), _f("created", L),
    _f("lines", _struct(_f("data", T.ArrayType(_struct(
        _f("quantity", L), _f("price", _struct(_f("id", S)))))))))

EXPORT_SCHEMAS = {
    "hubspot_companies": HUBSPOT_COMPANIES,
    "hubspot_contacts": HUBSPOT_CONTACTS,
    "hubspot_deals": HUBSPOT_DEALS,
    "stripe_customers": STRIPE_CUSTOMERS,
    "stripe_subscriptions": STRIPE_SUBSCRIPTIONS,
    "stripe_invoices": STRIPE_INVOICES,
}


def load_time() -> Column:
    """Load timestamp (UTC wall clock, no zone) stamped on every landed row."""
    return F.current_timestamp().cast("timestamp_ntz")


def read_events_raw(spark: SparkSession, path: str | list[str], modified_after: str | None = None) -> DataFrame:
    """S-1: NDJSON events, one unparsed document per row; with ``modified_after``
    (UTC, like 2026-01-31T00:00:00) only files that came later are read.

    The text source splits large files, so a 100 TB landing directory is read
    by as many tasks as ``spark.sql.files.maxPartitionBytes`` dictates.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read if modified_after is None else spark.read.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    return (reader.text(paths)
            .select(F.col("value").alias("raw_json"), load_time().alias("_loaded_at")))


def land_events(docs: DataFrame, root: str, load_date: str) -> None:
    """Persist one delivery of documents with its load time, as the partition
    ``load_date`` of the bronze table (a repeated delivery replaces its own)."""
    (docs.select("raw_json").withColumn("_loaded_at", load_time()).withColumn("load_date", F.lit(load_date).cast("date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_date").parquet(root))


def landed_events(spark: SparkSession, root: str, since: str | None = None) -> DataFrame:
    """The bronze table of documents; with ``since`` only deliveries from that
    date on (whole partitions are skipped)."""
    rows = spark.read.parquet(root)
    if since is not None:
        rows = rows.where(F.col("load_date") >= F.lit(since).cast("date"))
    return rows.select("raw_json", "_loaded_at")


def read_export(spark: SparkSession, table: str, path: str | list[str]) -> DataFrame:
    """S-2 / S-3: a CRM or billing export (JSON lines) with its fixed nested schema."""
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.schema(EXPORT_SCHEMAS[table]).option("mode", "PERMISSIVE").json(paths)
            .withColumn("_loaded_at", load_time()))


@dataclass(frozen=True)
class BronzeSpec:
    """S-4: one landed table: where it comes from and how it is read."""
    table: str
    relpath: str
    group: str
    reader: Callable[[SparkSession, str], DataFrame]


def _export_reader(table):
    return lambda spark, path: read_export(spark, table, path)


BRONZE_SPECS = [
    BronzeSpec("events_raw", "events", "events", read_events_raw),
    BronzeSpec("hubspot_companies", "hubspot/companies", "crm", _export_reader("hubspot_companies")),
    BronzeSpec("hubspot_contacts", "hubspot/contacts", "crm", _export_reader("hubspot_contacts")),
    BronzeSpec("hubspot_deals", "hubspot/deals", "crm", _export_reader("hubspot_deals")),
    BronzeSpec("stripe_customers", "stripe/customers", "billing", _export_reader("stripe_customers")),
    BronzeSpec("stripe_subscriptions", "stripe/subscriptions", "billing", _export_reader("stripe_subscriptions")),
    BronzeSpec("stripe_invoices", "stripe/invoices", "billing", _export_reader("stripe_invoices")),
]


def read_bronze(spark: SparkSession, landing_root: str,
                specs: list[BronzeSpec] = BRONZE_SPECS) -> dict[str, DataFrame]:
    """Read every landed table named in ``specs`` under ``landing_root``."""
    root = landing_root.rstrip("/")
    return {s.table: s.reader(spark, f"{root}/{s.relpath}") for s in specs}


def write_ndjson(df: DataFrame, path: str, text_col: str | None = None) -> None:
    """Write rows as JSON lines (or a text column verbatim) – the landing format."""
    if text_col:
        df.select(F.col(text_col).alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").json(path)
