"""Benchmark decontamination: a distributed positional inverted index.

The corpus is indexed by shards: each Arrow batch of documents becomes one row
holding the sorted posting lists (word positions) of the terms that benchmark
items use.  Words outside that vocabulary can never take part in a match, so
their postings are left out.  The index is written once for the words of the whole
benchmark, the document counts of its terms are summed over all shards, and every
shard then intersects offset-adjusted lists, starting from the rarest terms of each
window.

The benchmark is the stated query set.  Long items are cut into pieces that share
``window - 1`` words, so a window lies whole in one; equal pieces are one.  The pieces
are split into blocks of about ``block_bytes`` of text; each block is searched against
all shards of the one index, so any benchmark size works.  A word takes two bytes of
text at least and a window under 300 bytes of memory, so twice 150 times the block
bounds what is broadcast; the vocabulary is checked against ``VOCABULARY_BYTES``.

Defined results: null or wordless text has no words and no hits; an item
without words has no window; repeated documents or items each count as given;
an empty benchmark hits nothing; columns besides the id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 10
SLOP = 2
NEAR_TERMS = 8
BLOCK_BYTES = 2 << 20
#: Words of a piece of an item.
PIECE_WORDS = 5_000
VOCABULARY_BYTES = 256 << 20
SHARD_DOCS = 4000

INDEX_SCHEMA = ("doc_ids array<bigint>, starts array<bigint>, terms array<int>, "
                "offsets array<int>, positions array<int>")
HIT_SCHEMA = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
              "contaminated boolean, n_near_items bigint, near_items array<string>")


def windows_of(words: list, size: int) -> list[tuple]:
    """All windows of ``size`` consecutive words; the whole of a shorter item."""
    if not words:
        return []
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def pieces_of(words: list[bytes], size: int) -> list[bytes]:
    """A text's words in pieces that hold each window of ``size`` words whole."""
    step = max(1, PIECE_WORDS - size + 1)
    starts = range(0, max(1, len(words) - size + 1), step)
    return [b" ".join(words[i:i + step + size - 1]) for i in starts] if words else []


class QueryBlock:
    """Windows of one block of benchmark pieces."""

    def __init__(self, items: list[tuple[str, bytes]], size: int, vocabulary: dict[bytes, int]):
        self.items: list[str] = []
        by_window: dict[tuple, set[int]] = {}
        for item_id, text in items:
            for w in windows_of([vocabulary[x] for x in text.split()], size):
                by_window.setdefault(w, set()).add(len(self.items))
            self.items.append(item_id)
        self.windows = [(w, sorted(by_window[w])) for w in sorted(by_window)]

    def order(self, counts: dict[int, int]) -> None:
        """Offsets of each window's words, rarest word first."""
        self.plans = [sorted(range(len(w)), key=lambda i: (counts.get(w[i], 0), w[i], i)) for w, _ in self.windows]


def index_shard(doc_ids: list, texts: list[bytes], vocabulary: dict[bytes, int]) -> dict:
    """Posting lists of one shard; a free position separates documents."""
    starts, at, parts = [0], 0, []
    get = vocabulary.get
    for text in texts:
        words = common.alnum_words(text)
        ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        known = np.flatnonzero(ids >= 0)
        parts.append((ids[known], (known + at).astype(np.int32)))
        at += len(words) + 1
        starts.append(at)
    ids = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int32)
    positions = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int32)
    order = np.argsort(ids, kind="stable")
    terms, first = np.unique(ids[order], return_index=True)
    return {"doc_ids": doc_ids, "starts": starts, "terms": terms.astype(np.int32),
            "offsets": np.append(first, len(ids)).astype(np.int32), "positions": positions[order]}


def present(postings: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``wanted`` are in the sorted ``postings``."""
    at = np.searchsorted(postings, wanted)
    at[at == len(postings)] = 0
    return postings[at] == wanted if len(postings) else np.zeros(len(wanted), bool)


def near(postings: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Which of ``wanted`` have a posting at most ``slop`` away."""
    if not len(postings):
        return np.zeros(len(wanted), bool)
    at = np.searchsorted(postings, wanted - slop)
    at[at == len(postings)] = len(postings) - 1
    return np.abs(postings[at] - wanted) <= slop


def search_shard(shard: dict, block: QueryBlock, slop: int, near_terms: int) -> tuple[list, list, list]:
    """Per document: hit ranges, items hit exactly, items met by proximity."""
    starts = np.asarray(shard["starts"], np.int64)
    lists = {t: shard["positions"][a:b] for t, a, b in
             zip(shard["terms"].tolist(), shard["offsets"][:-1].tolist(), shard["offsets"][1:].tolist())}
    none = np.empty(0, np.int64)
    n_docs = len(starts) - 1
    ranges, exact, close = [[] for _ in range(n_docs)], [set() for _ in range(n_docs)], [set() for _ in range(n_docs)]
    for (window, items), plan in zip(block.windows, block.plans):
        lead = lists.get(window[plan[0]], none)
        found = lead - plan[0]
        for i in plan[1:]:
            if not len(found):
                break
            found = found[present(lists.get(window[i], none), found + i)]
        if len(found):
            for d, p in zip((np.searchsorted(starts, found, "right") - 1).tolist(), found.tolist()):
                ranges[d].append((p, p + len(window)))
                exact[d].update(items)
        if len(window) >= near_terms:
            # at most len - near_terms words may be missing, so one of the rarest few is there
            allowed = len(window) - near_terms
            anchors = [lists[window[i]] - i for i in plan[:allowed + 1] if window[i] in lists]
            if sum(map(len, anchors)) == 0:
                continue
            at = np.unique(np.concatenate(anchors))
            # the anchor's own document bounds the match
            doc = np.searchsorted(starts, np.maximum(at, 0) + len(window) // 2, "right") - 1
            missing = np.zeros(len(at), np.int32)
            for i in plan:
                missing += ~near(lists.get(window[i], none), at + i, slop)
                keep = missing <= allowed
                if not keep.all():
                    at, doc, missing = at[keep], doc[keep], missing[keep]
                if not len(at):
                    break
            for d in set(np.clip(doc, 0, n_docs - 1).tolist()) if len(at) else ():
                close[d].update(items)
    return ranges, exact, close


def covered(ranges: list[tuple[int, int]]) -> int:
    """Number of positions inside any of the ranges."""
    total, reach = 0, -1
    for a, b in sorted(ranges):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def find_contamination(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", window: int = WINDOW, slop: int = SLOP,
                       near_terms: int = NEAR_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, words hit by benchmark windows, items found.

    ``near_items`` (and their number) are those of which a window has at least ``near_terms``
    words within ``slop`` words of their places (exact matches included).
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(item, piece) for item, text in zip(batch.column(0).to_pylist(), common.byte_texts(batch.column(1)))
                    for piece in pieces_of(common.alnum_words(text), window)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                                             ["item", "body"])

    pieces = common.stored(items.mapInArrow(common.frugal(cut), "item string, body binary").distinct(), "benchmark-pieces")
    words = common.stored(pieces.select(F.explode(F.split(F.decode("body", "UTF-8"), " ")).alias("word")).distinct(), "benchmark-words")
    size = words.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0
    if size > VOCABULARY_BYTES:
        raise ValueError(f"benchmark vocabulary: {size} bytes exceed the bound of {VOCABULARY_BYTES}")
    vocabulary = {r.word.encode(): i for i, r in enumerate(words.orderBy("word").collect())}
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    index = _index(spark, docs, vocabulary)
    per_term = index.where("size(terms) > 0").select(F.expr(
        "explode(transform(terms, (t, i) -> struct(t AS term, offsets[i + 1] - offsets[i] AS n)))").alias("x"))
    counts = {r.term: r.n for r in per_term.groupBy("x.term").agg(F.sum("x.n").alias("n")).collect()}  # a row per word
    total = pieces.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    parts = []
    for b in range(n_blocks):
        rows = [(r.item, bytes(r.body)) for r in pieces.where(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == b).collect()]
        block = QueryBlock(rows, window, vocabulary)  # about block_bytes of text
        block.order(counts)
        parts.append(_search(spark, index, block, slop, near_terms, 300 * block_bytes))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    if n_blocks > 1:  # a document's place in the stored index tells repeated ids apart
        found = found.groupBy("shard", "place").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("ranges")).alias("ranges"), F.flatten(F.collect_list("items")).alias("items"),
            F.flatten(F.collect_list("near_items")).alias("near_items"))
    return found.mapInArrow(common.frugal(_summarise), HIT_SCHEMA)


def _index(spark, docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """The positional index of the corpus, written once."""
    sent = common.broadcast_checked(spark, vocabulary, sum(len(w) + 64 for w in vocabulary), VOCABULARY_BYTES, "benchmark vocabulary")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        ids, texts = [], []

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({k: pa.array([v], pa.list_(
                pa.int64() if k in ("doc_ids", "starts") else pa.int32())) for k, v in index_shard(ids, texts, known).items()})

        for batch in batches:  # a shard is searched for all windows, so it spans several batches
            ids += batch.column(0).to_pylist()
            texts += common.byte_texts(batch.column(1))
            if len(ids) >= SHARD_DOCS:
                yield shard()
                ids, texts = [], []
        if ids:
            yield shard()

    return common.stored(docs.mapInArrow(common.frugal(build), INDEX_SCHEMA).withColumn("shard", F.monotonically_increasing_id()),
                         "positional-index")


def _search(spark, index: DataFrame, block: QueryBlock, slop: int, near_terms: int, limit: int) -> DataFrame:
    queries = common.broadcast_checked(spark, block, sum(16 * len(w) + 128 for w, _ in block.windows),
                                       limit, "benchmark windows")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {k: batch.column(k)[row].values.to_numpy(zero_copy_only=False)
                         for k in ("starts", "terms", "offsets", "positions")}
                ids, starts = batch.column("doc_ids")[row].as_py(), shard["starts"].tolist()
                ranges, exact, close = search_shard(shard, block, slop, near_terms)
                name = lambda s: [block.items[i] for i in sorted(s)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()), "shard": pa.array([batch.column("shard")[row].as_py()] * len(ids), pa.int64()),
                    "place": pa.array(range(len(ids)), pa.int64()),
                    "n_words": pa.array([b - a - 1 for a, b in zip(starts, starts[1:])], pa.int64()),
                    "ranges": pa.array([[list(x) for x in r] for r in ranges], pa.list_(pa.list_(pa.int64()))),
                    "items": pa.array([name(s) for s in exact], pa.list_(pa.string())),
                    "near_items": pa.array([name(a | b) for a, b in zip(exact, close)], pa.list_(pa.string()))})

    return index.mapInArrow(common.frugal(search), "doc_id bigint, shard bigint, place bigint, n_words bigint, "
                                    "ranges array<array<bigint>>, items array<string>, near_items array<string>")


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = [covered([tuple(x) for x in r]) for r in batch.column("ranges").to_pylist()]
        items = [sorted(set(x)) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"), "n_hit": pa.array(hit, pa.int64()),
            "n_items": pa.array(map(len, items), pa.int64()),
            "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items],
            "contaminated": pa.array([h > 0 for h in hit], pa.bool_()),
            "n_near_items": pa.array([len(set(x)) for x in batch.column("near_items").to_pylist()], pa.int64()),
            "near_items": pa.array([sorted(set(x)) for x in batch.column("near_items").to_pylist()], pa.list_(pa.string()))})


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark window; columns as they were."""
    keyed = documents.select(common.row_key().alias("row_key"), "text")
    found = find_contamination(keyed, benchmark, id_col="row_key").where("contaminated")
    return common.without(documents, found.select(F.col("doc_id").alias("row_key")))
