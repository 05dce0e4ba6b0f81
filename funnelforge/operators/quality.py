"""Data-quality checks as Spark jobs (declared tests -> failing keys / counts).

* ``unique``         non-NULL values occurring more than once (one aggregate)
* ``not_null``       NULL counts for many columns of a table in ONE pass
* ``accepted_values``values outside an allowed list
* ``unique_combination`` duplicated key tuples
* ``dq_report``      every declared test of the warehouse -> one result table
* ``results_equivalent`` result equivalence of two query results
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelforge.functions.contract import EVENT_NAMES
from funnelforge.session import scratch_path


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Q-1: (value, n) for every non-NULL value of ``col`` seen more than once."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q-2: (column_name, null_rows) for ``cols`` – a single aggregation pass."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot([], cols, "column_name", "null_rows")


def accepted_values_violations(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Q-3: (value, n) for values of ``col`` outside ``values`` (NULL is not tested)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(values))
            .groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")))


def unique_combination_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q-4: key tuples of ``cols`` that occur more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


@dataclass(frozen=True)
class Check:
    kind: str            # unique | not_null | accepted_values | unique_combination
    model: str           # warehouse attribute
    table: str           # published table name
    columns: tuple[str, ...]


# The declared tests of the published models.
DECLARED_CHECKS = [
    Check("unique", "stg_events", "stg_events", ("event_id",)),
    Check("not_null", "stg_events", "stg_events", ("event_id",)),
    Check("not_null", "stg_events", "stg_events", ("event_name",)),
    Check("accepted_values", "stg_events", "stg_events", ("event_name",)),
    Check("not_null", "stg_events", "stg_events", ("event_ts",)),
    Check("not_null", "dead_letter", "stg_events_dead_letter", ("failure_reason",)),
    Check("unique", "anon_to_user", "int_identity__anon_to_user", ("anonymous_id",)),
    Check("not_null", "anon_to_user", "int_identity__anon_to_user", ("anonymous_id",)),
    Check("not_null", "anon_to_user", "int_identity__anon_to_user", ("user_id",)),
    Check("unique", "user_to_account", "int_identity__user_to_account", ("user_id",)),
    Check("not_null", "user_to_account", "int_identity__user_to_account", ("user_id",)),
    Check("unique", "account_spine", "int_identity__account_spine", ("account_id",)),
    Check("not_null", "account_spine", "int_identity__account_spine", ("account_id",)),
    Check("unique", "fct_events", "fct_events", ("event_id",)),
    Check("not_null", "fct_events", "fct_events", ("event_id",)),
    Check("unique", "dim_accounts", "dim_accounts", ("account_id",)),
    Check("not_null", "dim_accounts", "dim_accounts", ("account_id",)),
    Check("unique_combination", "fct_mrr_monthly", "fct_mrr_monthly", ("invoice_month", "account_id")),
    Check("not_null", "fct_mrr_monthly", "fct_mrr_monthly", ("mrr",)),
    Check("unique", "fct_revenue_attribution", "fct_revenue_attribution", ("channel",)),
    Check("not_null", "fct_revenue_attribution", "fct_revenue_attribution", ("channel",)),
]

REPORT_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()), T.StructField("check_kind", T.StringType()),
    T.StructField("table_name", T.StringType()), T.StructField("column_name", T.StringType()),
    T.StructField("failing_rows", T.LongType()), T.StructField("status", T.StringType()),
])


def check_id(c: Check) -> str:
    return f"{c.kind}_{c.table}_{'__'.join(c.columns)}"


def _failures(c: Check, df: DataFrame) -> DataFrame:
    """One row (failing_rows) for a single check; the count of returned failures."""
    if c.kind == "unique":
        return unique_violations(df, c.columns[0]).agg(F.count(F.lit(1)).alias("failing_rows"))
    if c.kind == "accepted_values":
        return (accepted_values_violations(df, c.columns[0], EVENT_NAMES)
                .agg(F.count(F.lit(1)).alias("failing_rows")))
    if c.kind == "unique_combination":
        return (unique_combination_violations(df, list(c.columns))
                .agg(F.count(F.lit(1)).alias("failing_rows")))
    raise ValueError(c.kind)


def dq_report(w, checks: list[Check] = DECLARED_CHECKS) -> DataFrame:
    """Q-5: one row per declared test: (check_id, check_kind, table_name,
    column_name, failing_rows, status pass|fail).

    NOT NULL tests of one table are answered by one aggregation pass; each
    uniqueness-style test is one (partially aggregated) grouping.
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind == "not_null":
            by_model.setdefault(c.model, []).append(c)
        else:
            f = _failures(c, getattr(w, c.model))
            parts.append(f.select(F.lit(check_id(c)).alias("check_id"), F.lit(c.kind).alias("check_kind"),
                                  F.lit(c.table).alias("table_name"),
                                  F.lit(",".join(c.columns)).alias("column_name"), "failing_rows"))
    for model, cs in by_model.items():
        cols = [c.columns[0] for c in cs]
        counts = null_counts(getattr(w, model), cols)
        ids = F.create_map(*itertools.chain.from_iterable(
            (F.lit(c.columns[0]), F.lit(check_id(c))) for c in cs))
        parts.append(counts.select(ids[F.col("column_name")].alias("check_id"),
                                   F.lit("not_null").alias("check_kind"),
                                   F.lit(cs[0].table).alias("table_name"), "column_name",
                                   F.col("null_rows").alias("failing_rows")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failing_rows") == 0, "pass").otherwise("fail"))


def write_metrics(checks: list[Check]) -> dict[str, "F.Column"]:
    """Aggregates that answer the NOT NULL checks while a model is written."""
    return {check_id(c): F.count_if(F.col(c.columns[0]).isNull()) for c in checks if c.kind == "not_null"}


def observed_report(checks: list[Check], seen: dict[str, object]) -> list[tuple]:
    """Report rows of the checks that ``write_metrics`` has answered."""
    return [(check_id(c), c.kind, c.table, ",".join(c.columns), seen[check_id(c)], "fail" if seen[check_id(c)] else "pass")
            for c in checks if c.kind == "not_null"]


def failures(report: DataFrame) -> DataFrame:
    """Q-5 / triage input: only the failed checks."""
    return report.filter(F.col("status") == "fail")


# ---------------------------------------------------------------------------
# Q-6: result equivalence
# ---------------------------------------------------------------------------
def _normalized(df: DataFrame, places: int) -> DataFrame:
    """Float columns rounded half-to-even at ``places``; every value as text."""
    out = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            scale = float(10 ** places)
            c = F.rint(c.cast("double") * scale) / scale
        out.append(F.coalesce(c.cast("string"), F.lit("\u0000")).alias(f"c{i}"))
    return df.select(*out)


def _fingerprints(df: DataFrame) -> list:
    """Row count, then an order-insensitive digest per column: the sum of 64-bit
    hashes (as DECIMAL)."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.sum(F.xxhash64(c).cast("decimal(38,0)")).alias(c) for c in df.columns]).first()
    return list(row)


def difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that one side has more often: one grouping of both sides (no join),
    with columns matched by position; ``n`` > 0 where ``expected`` has more."""
    names = expected.columns
    both = (expected.withColumn("_n", F.lit(1))
            .unionByName(actual.toDF(*names).withColumn("_n", F.lit(-1))))
    return both.groupBy(*names).agg(F.sum("_n").alias("n")).filter(F.col("n") != 0)


def results_equivalent(expected: DataFrame, actual: DataFrame, places: int = 2) -> bool:
    """Q-6: same rows as multisets, ignoring column names, column order and
    extra columns of ``actual``; floats compared at ``places`` decimals.

    Both sides are written once.  Columns are paired by digests of their values
    (one aggregate per side).  Columns of one side with equal digests hold the same
    values; where their values also lie in the same rows they are interchangeable, so
    groups of identical columns are found first (one more aggregate) and only the
    arrangements of columns that differ row by row are tried.
    """
    ne, na = len(expected.columns), len(actual.columns)
    if ne > na:
        return False
    e, a = (_stored(_normalized(df, places), name) for df, name in ((expected, "expected"), (actual, "actual")))
    fe, fa = _fingerprints(e), _fingerprints(a)
    if fe[0] != fa[0]:
        return False
    ke, ka = _kinds(e, fe[1:]), _kinds(a, fa[1:])
    kinds = {k: [j for j in range(na) if ka[j] == k] for k in set(ka)}

    def assignments(i: int, given: dict[int, int], used: dict[int, int]):
        """The kind of actual columns for each kind of expected ones; copies of a
        column go to copies, while there are any."""
        if i == ne:
            yield given
            return
        if ke[i] in given:
            yield from assignments(i + 1, given, used)
            return
        copies = ke.count(ke[i])
        for k, columns in kinds.items():
            if fa[1 + columns[0]] == fe[1 + i] and used.get(k, 0) + copies <= len(columns):
                yield from assignments(i + 1, given | {ke[i]: k}, used | {k: used.get(k, 0) + copies})

    for given in assignments(0, {}, {}):
        if difference(e, a.select(*[F.col(f"c{kinds[given[k]][0]}").alias(f"c{i}") for i, k in enumerate(ke)])).isEmpty():
            return True
    return False


def _kinds(df: DataFrame, digests: list) -> list[int]:
    """Per column the first column that is equal to it in every row."""
    pairs = [(i, j) for j in range(len(digests)) for i in range(j) if digests[i] == digests[j]]
    if not pairs:
        return list(range(len(digests)))
    same = df.agg(*[F.min(F.col(f"c{i}") == F.col(f"c{j}")).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return [next((i for i in range(j) if (i, j) in pairs and same[f"p{i}_{j}"] is not False), j) for j in range(len(digests))]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------------------
# A-10 / A-11
# ---------------------------------------------------------------------------
def dead_letter_summary(*quarantines: tuple[str, DataFrame]) -> DataFrame:
    """A-10: (origin, failure_reason, n), largest first, over any number of
    quarantine tables given as (origin, DataFrame with failure_reason)."""
    parts = [df.select(F.lit(origin).alias("origin"), "failure_reason") for origin, df in quarantines]
    u = reduce(DataFrame.unionByName, parts)
    return (u.groupBy("origin", "failure_reason").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "origin", "failure_reason"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A-11: (table_name, row_count) for every table, as one Spark job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
