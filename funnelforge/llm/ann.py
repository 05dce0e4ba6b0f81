"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

*Reduction.*  With M the largest norm, a vector x becomes (x, sqrt(M^2 - |x|^2))
and a query q becomes (q M / |q|, 0); then the nearest vector is that with the
largest inner product.

*Index.*  Each of ``tables`` tables hashes a vector by several 2-stable
projections, floor((a.x + b) / w); every vector is in one bucket of each table.
A query visits its own bucket and perturbed ones in the order of their estimated
success, the product over the projections of the normal probability that a
neighbour falls into that slot.  The best buckets of a product of lists come from
the best partial products, so they are found projection by projection.

*Fit.*  The number of projections follows the number of vectors.  The bucket
width and the number of probes are fitted on a bounded sample
(``sample_vectors`` vectors, ``sample_queries`` queries of it): as few probes as
reach ``target`` recall there.  If the most probes (``MAX_PROBES``) don't reach it, the
index gets fewer projections, so wider buckets; without any, all vectors are
scored exactly.  A sample's neighbours are farther away than the
full table's, so recall on all rows is higher.

*Search.*  Equal vectors are searched once and expand to their smallest ids
afterwards, which is exact.  Buckets are gathered in blocks of about
``block_bytes``; a bucket that is larger is split, and queries go to
blocks in groups of at most ``group_queries``, so no task holds an unbounded
group.  In a block each query scores the vectors of its buckets exactly; the best
of all blocks are merged.

Defined results: vectors that are null, zero, empty, or hold null or non-finite
components take no part, neither as query nor as candidate; vectors meet only
those of their own dimension; ties go to the smaller vec_id; repeated rows with
one id are one candidate each as given; with fewer candidates all are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

NEIGHBOURS = 20
TABLES = 4
TARGET = 0.94
SAMPLE_VECTORS, SAMPLE_QUERIES = 8192, 256
#: Vectors in a bucket that the number of projections aims at, and how a projection thins them out.
BUCKET, THINNING = 64, 3.3
MAX_PROBES = 2048
#: Bytes of vectors in a block, queries that go to a block together, and bytes of scores held at once.
BLOCK_BYTES, GROUP_QUERIES, SCORE_BYTES = 32 << 20, 8_192, 64 << 20
#: Queries whose probes are planned at once.
TOGETHER = 512
SEED = 7


class Index:
    """Projections of all tables for one dimension, and the fitted numbers."""

    def __init__(self, dim: int, norm: float, n_vectors: int, tables: int = TABLES):
        self.dim, self.norm, self.tables = dim, norm, tables
        self.k = max(4, math.ceil(math.log(max(2.0, n_vectors / BUCKET)) / math.log(THINNING)))
        rng = np.random.default_rng([SEED, dim])
        self.a = rng.standard_normal((tables, dim + 1, self.k))
        self.b = rng.random((tables, self.k))
        self.mix = rng.integers(1, 1 << 62, (tables, self.k)) * 2 + 1
        self.width, self.spread, self.probes = 1.0, 0.5, 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(0.0, self.norm ** 2 - (x * x).sum(axis=1))
        return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)

    def queried(self, q: np.ndarray) -> np.ndarray:
        scale = self.norm / np.sqrt((q * q).sum(axis=1))
        return np.concatenate([q * scale[:, None], np.zeros((len(q), 1))], axis=1)

    def slots(self, lifted: np.ndarray, t: int) -> np.ndarray:
        return lifted @ self.a[t] / self.width + self.b[t]

    def codes(self, slots: np.ndarray, t: int) -> np.ndarray:
        """One number per bucket."""
        with np.errstate(over="ignore"):
            h = (slots.astype(np.int64) * self.mix[t]).sum(axis=-1)
            h ^= (h >> 29) & 0x7FFFFFFFF
            return h * np.int64(0x94D049BB133111)

    def buckets(self, x: np.ndarray, t: int) -> np.ndarray:
        return self.codes(np.floor(self.slots(self.lifted(x), t)), t)

    def visits(self, q: np.ndarray, t: int, probes: int | None = None) -> np.ndarray:
        """Buckets (queries x probes) in the order of estimated success."""
        probes = probes or self.probes
        at = self.slots(self.queried(q), t)
        home = np.floor(at)
        low = at - home
        cdf = lambda z: 1 / (1 + np.exp(-1.702 * np.clip(z, -30, 30)))
        moves = np.array([0, -1, 1])
        # log chance that a neighbour's slot is home + move
        chance = np.stack([np.log(np.maximum(cdf((m + 1 - low) / self.spread) - cdf((m - low) / self.spread), 1e-12))
                           for m in moves], axis=-1)
        score = np.zeros((len(q), 1))
        slots = np.zeros((len(q), 1, 0), np.int8)
        rows = np.arange(len(q))[:, None]
        for j in range(self.k):
            both = score[:, :, None] + chance[:, j][:, None, :]
            flat = both.reshape(len(q), -1)
            keep = min(probes, flat.shape[1])
            best = np.argpartition(-flat, keep - 1, axis=1)[:, :keep] if keep < flat.shape[1] else np.broadcast_to(
                np.arange(keep), (len(q), keep))
            score = flat[rows, best]
            slots = np.concatenate([slots[rows, best // 3], moves[best % 3][:, :, None].astype(np.int8)], axis=2)
        order = np.argsort(-score, axis=1, kind="stable")
        return self.codes(home[:, None, :] + slots[rows, order], t)

    def fit(self, sample: np.ndarray, n_queries: int, k: int, target: float) -> float:
        """Width and probes from a sample; returns the recall there."""
        n_queries = min(n_queries, len(sample))
        queries = sample[:n_queries]
        scores = queries @ sample.T
        scores[np.arange(n_queries), np.arange(n_queries)] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return 1.0
        nearest = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        apart = self.lifted(sample)[nearest] - self.queried(queries)[:, None, :]
        distance = float(np.median(np.sqrt((apart ** 2).sum(axis=2)))) or self.norm
        self.width, self.spread = 1.8 * distance, 1 / 1.8
        wanted = [self.buckets(sample, t)[nearest] for t in range(self.tables)]
        most = min(MAX_PROBES, 3 ** self.k)
        place = np.full(nearest.shape, most)
        for t in range(self.tables):
            visits = self.visits(queries, t, most)
            for i in range(n_queries):
                order = np.argsort(visits[i], kind="stable")
                at = np.minimum(np.searchsorted(visits[i][order], wanted[t][i]), most - 1)
                hit = visits[i][order[at]] == wanted[t][i]
                place[i] = np.minimum(place[i], np.where(hit, order[at], most))
        ranks = np.sort(place.ravel())
        need = int(ranks[min(len(ranks) - 1, math.ceil(target * len(ranks)) - 1)])
        self.probes = min(most, need + 1)
        return float((place < self.probes).mean())


    def fit_to(self, sample: np.ndarray, n_queries: int, k: int, target: float) -> float:
        """``fit`` with as many projections as reach ``target``, none in the end:
        then one table of one bucket holds all vectors.  Returns the recall."""
        while (recall := self.fit(sample, n_queries, k, target)) < target and self.k:
            self.k -= 1
            self.a, self.b, self.mix = self.a[:, :, :self.k], self.b[:, :self.k], self.mix[:, :self.k]
        if not self.k:
            self.tables = 1
        return recall


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the vectors that take part."""
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
            .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                   & F.exists("vector", lambda x: x != 0)))


def _top_of_block(k: int):
    """The best candidates of each query among its buckets of one block."""

    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": pd.Series(dtype="int64"), "rep": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(candidates) or not len(queries):
            return empty
        order = np.argsort(candidates.bucket.to_numpy(), kind="stable")
        bucket = candidates.bucket.to_numpy()[order]
        ids, x = candidates.rep.to_numpy()[order], np.stack(candidates.vector.to_numpy()[order]).astype(np.float64)
        local, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(bucket))
        out = []
        together = max(16, SCORE_BYTES // (8 * len(ids)))
        for at in range(0, len(queries), together):
            part = queries.iloc[at:at + together]
            q = np.stack(part.vector.to_numpy()).astype(np.float64)
            lists = part.buckets.to_numpy()
            owner = np.repeat(np.arange(len(part)), [len(b) for b in lists])
            place = np.searchsorted(local, np.concatenate(lists))
            place[place == len(local)] = 0
            there = local[place] == np.concatenate(lists)
            owner, place = owner[there], place[there]
            by = np.argsort(place, kind="stable")
            owner, place = owner[by], place[by]
            scores = np.full((len(part), len(ids)), -np.inf)
            cuts = np.flatnonzero(np.diff(place, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(place))):
                own, span = owner[a:b], slice(first[place[a]], ends[place[a]])
                scores[own, span] = q[own] @ x[span].T
            keep = min(k, len(ids))
            best = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
            rows, cols = np.repeat(np.arange(len(part)), keep), best.ravel()
            real = np.isfinite(scores[rows, cols])
            rows, cols = rows[real], cols[real]
            exact = (q[rows] * x[cols]).sum(axis=1)  # the same sum whatever the block
            out.append(pd.DataFrame({"query": part["query"].to_numpy()[rows], "rep": ids[cols], "score": exact}))
        return pd.concat(out, ignore_index=True) if out else empty

    return run


def search(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20,
           k: int = NEIGHBOURS, tables: int = TABLES, target: float = TARGET, sample_vectors: int = SAMPLE_VECTORS,
           sample_queries: int = SAMPLE_QUERIES, block_bytes: int = BLOCK_BYTES,
           group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score for all queries (ids divisible by ``every``)."""
    usable = common.stored(_usable(vectors, id_col, vector_col).withColumn("dim", F.size("vector"))
                           .withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))), "vectors")
    ranked = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    # of equal vectors the k + 1 smallest ids can be among the nearest
    low = common.stored(usable.select("vec_id", "vector", "dim", ranked.alias("place")).where(F.col("place") <= k + 1), "equal-vectors")
    reps = low.where("place = 1").select(F.col("vec_id").alias("rep"), "vector", "dim")
    members = low.join(reps.select("rep", "vector"), "vector").select("rep", "vec_id")
    queries = (usable.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
               .join(reps.select("rep", "vector"), "vector").select("query_id", "rep"))
    found = None
    for row in usable.groupBy("dim").agg(F.max("norm").alias("norm"), F.count("*").alias("n")).orderBy("dim").collect():
        part = _search_dimension(reps.where(F.col("dim") == row.dim).drop("dim"), queries, Index(row.dim, row.norm, row.n, tables),
                                 k, target, sample_vectors, sample_queries, max(1, block_bytes // (8 * row.dim)), group_queries)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = common.stored(found.groupBy("query", "rep").agg(F.max("score").alias("score")), "found")
    nearest = Window.orderBy(F.desc("score"), "vec_id")
    listed = (found.join(members, "rep").withColumn("place", F.row_number().over(nearest.partitionBy("query")))
              .where(F.col("place") <= k + 1).select(F.col("query").alias("rep"), "vec_id", "score"))
    out = queries.join(listed, "rep").where("query_id <> vec_id")
    return (out.withColumn("rank", F.row_number().over(nearest.partitionBy("query_id")).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _search_dimension(reps: DataFrame, queries: DataFrame, index: Index, k: int, target: float, n_sample: int, n_queries: int,
                      block_rows: int, group_queries: int) -> DataFrame:
    """(query, rep, score): the best of every block for every distinct query vector."""
    spark = reps.sparkSession
    sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(n_sample).select("vector").toArrow()  # a bounded sample
    index.fit_to(_vectors(sample.column("vector").combine_chunks(), index.dim), n_queries, k, target)
    shared = common.Sent(spark, index)
    dim, n_tables = index.dim, index.tables

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = _vectors(batch.column("vector"), dim)
            for t in range(n_tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(own.buckets(x, t)), batch.column("rep"),
                     batch.column("vector")], ["t", "bucket", "rep", "vector"])

    indexed = common.stored(reps.select("rep", "vector").mapInArrow(insert, "t int, bucket bigint, rep bigint, vector array<double>"), "index")
    sizes = indexed.groupBy("t", "bucket").agg(F.count("*").alias("n"))
    n_rows = reps.count()
    n_blocks = max(1, math.ceil(n_rows / block_rows))
    wide = sizes.where(F.col("n") > block_rows).select("t", "bucket", F.ceil(F.col("n") / block_rows).cast("int").alias("parts"))
    # a bucket lies in one block; a bucket larger than a block has blocks of its own
    large = {(r.t, r.bucket): r.parts for r in wide.collect()}  # at most a row per block of the index
    own_blocks = spark.sparkContext.broadcast(large)
    asked = reps.join(queries.select("rep").distinct(), "rep", "left_semi")

    def block_of(bucket, part):
        return n_blocks + bucket % (1 << 30) * 1024 + part  # both sides: numbers or columns

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, index = own_blocks.value, shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                q = _vectors(batch.column("vector"), dim)
                rows: list[tuple] = []
                for t in range(n_tables):
                    for i, visits in enumerate(index.visits(q, t)):
                        blocks: dict[int, list[int]] = {}
                        for bucket, home in zip(visits.tolist(), (visits % n_blocks).tolist()):
                            parts = split.get((t, bucket))
                            for b in [home] if parts is None else [block_of(bucket, p) for p in range(parts)]:
                                blocks.setdefault(b, []).append(bucket)
                        rows += [(t, b, i, own) for b, own in blocks.items()]
                t_, b_, i_, own = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t_, pa.int32()), pa.array(b_, pa.int64()), batch.column("rep").take(pa.array(i_)),
                     batch.column("vector").take(pa.array(i_)), pa.array(own, pa.list_(pa.int64()))],
                    ["t", "block", "query", "vector", "buckets"])

    asks = common.stored(asked.select("rep", "vector").mapInArrow(
        probe, "t int, block bigint, query bigint, vector array<double>, buckets array<bigint>"), "asks")
    # a block meets the queries that ask for it: in parts where they are many
    busy = asks.groupBy("t", "block").agg(F.ceil(F.count("*") / F.lit(group_queries)).cast("int").alias("parts_asked"))
    asks = (asks.join(busy.where("parts_asked > 1"), ["t", "block"], "left")
            .withColumn("part", F.coalesce(F.pmod(F.xxhash64("query"), F.col("parts_asked")).cast("int"), F.lit(0))))
    block = F.when(F.col("parts").isNull(), F.pmod("bucket", F.lit(n_blocks))).otherwise(
        block_of(F.pmod("bucket", F.lit(1 << 30)), F.pmod(F.xxhash64("rep"), F.col("parts"))))
    rows = (indexed.join(wide, ["t", "bucket"], "left").withColumn("block", block.cast("long"))
            .join(busy, ["t", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts_asked") - 1))))
    keys = ["t", "block", "part"]
    return (rows.select(*keys, "bucket", "rep", "vector").groupBy(*keys)
            .cogroup(asks.select(*keys, "query", "vector", "buckets").groupBy(*keys))
            .applyInPandas(_top_of_block(k + 5), "query bigint, rep bigint, score double"))
