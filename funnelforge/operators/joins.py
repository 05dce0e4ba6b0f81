"""Join helpers shared by identity resolution and the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that a sketch of the join keys keeps track of, and that it may return.
TRACKED, RETURNED = 10_000, 200
#: A key is hot if it holds more than this share of a side's rows.
HOT_SHARE = 0.005
#: Tasks over which the rows of a hot key are spread, per share of ``HOT_SHARE``; at most ``MOST_SALTS``.
MOST_SALTS = 256


def left_join_spread_nulls(left: DataFrame, key: Column, salt: Column, right: DataFrame,
                           right_key: str, hot: dict[str, int] | None = None) -> DataFrame:
    """Left equi-join on ``key`` in which frequent keys do not pile up in one task.

    A NULL key can never match, but a plain join still hashes all NULL-key
    rows to one reducer.  Joining on ``(coalesce(key, salt), key IS NULL)``
    sends them wherever their (unique) salt hashes, while the second key
    column - constant FALSE on the right - guarantees they still match
    nothing.  One pass over the input, no union of filtered copies.

    ``hot`` (see ``hot_keys``) names frequent keys and over how many tasks to spread
    each: their rows on the left take one of so many salts by the hash of ``salt``,
    the few rows of such a key on the right are repeated once per salt.  Other rows
    keep salt 0, so nothing else is shuffled more than before.
    """
    l = (left.withColumn("_jk", F.coalesce(key, salt.cast("string")))
         .withColumn("_jn", key.isNull()))
    r = (right.withColumnRenamed(right_key, "_jk").filter(F.col("_jk").isNotNull())
         .withColumn("_jn", F.lit(False)))
    on = ["_jk", "_jn"]
    if hot:
        table = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
        salts = F.coalesce(F.try_element_at(table, F.col("_jk")), F.lit(1))
        l = l.withColumn("_js", F.when(F.col("_jn"), 0).otherwise(F.pmod(F.xxhash64(salt), salts).cast("int")))
        r = r.withColumn("_js", F.explode(F.sequence(F.lit(0), salts - 1)))
        on = [*on, "_js"]
    return l.join(r, on, "left").drop(*on)


def hot_keys(left: DataFrame, key: Column, share: float = HOT_SHARE) -> dict[str, int]:
    """The keys that hold more than ``share`` of the rows of ``left``, with the number
    of tasks that each is spread over.

    One pass with a mergeable sketch of the most frequent items (``approx_top_k``): the
    driver gets ``RETURNED`` keys at most, at any size of the data.  Its counts may be
    off, which changes how a key is spread, never the result of the join."""
    found = left.select(key.alias("k")).agg(
        F.expr(f"approx_top_k(k, {RETURNED}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {i["item"]: min(MOST_SALTS, 1 + int(i["count"] / (share * found.n))) for i in found.top or []
            if i["item"] is not None and i["count"] > share * found.n}
