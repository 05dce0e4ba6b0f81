"""Best-fit packing of tokenised documents into sequences of a fixed size.

The plan needs only how many pieces there are of each length (at most
``size`` numbers), so it is made on the driver at any corpus size.  For each
length, longest first, exact complements are taken from an index of available
lengths: one piece, a pair, or a triple whose sum is exactly the gap, each as
often as the counts allow.  What remains is packed best-fit: every gap takes
the longest piece that fits.  Each step uses up a length, so the plan has a
few thousand runs at most ("this combination, so many times").

Pieces are then numbered within their length.  The numbering works on (length,
salt) groups whose counts are added up, so a length that holds a third of all
pieces does not meet in one task.  A piece finds its place by its number.

Defined results: null text is empty; every document ends with token 0, so an
empty one has the single piece ``[0]``; repeated documents are packed as often
as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SIZE = 2048
END_ID = 0
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id bigint, offset bigint"
#: Pieces numbered by one task, about.
GROUP_ROWS = 20_000
_END_OF_TEXT = "<|endoftext|>"


class Encoder:
    """Ids of a byte-level vocabulary, by its ranks; the vocabulary's own
    tokenizer takes over where a text is beyond the rank encoder."""

    def __init__(self, vocabulary: str | None, ranks: str | None):
        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                      special_tokens={_END_OF_TEXT: len(table)})
        self.slow = None

    def ids(self, text: str) -> list[int]:
        try:
            if _END_OF_TEXT in text:
                return self.fast.encode(text, allowed_special="all", disallowed_special=())
            return self.fast.encode_ordinary(text)
        except BaseException as e:  # the rank encoder panics on very long runs of white space
            if type(e).__name__ != "PanicException":
                raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.vocabulary)
        return self.slow.encode(text, add_special_tokens=False).ids


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return [(0, first)] * (first > 0) + [(s, size) for s in range(first, n, size)]


def pieces(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
           vocabulary: str | None = None, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document: where it starts and its ids' digest
    (with ``with_ids`` the ids themselves in ``ids``)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encoder.ids(text.as_py() or ""), END_ID], "<u4")
                for k, (start, n) in enumerate(cut(len(ids), size)):
                    part = ids[start:start + n]
                    rows.append((doc_id, k, start, n, zlib.crc32(part.tobytes()), *([part] if with_ids else [])))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(common.frugal(encode), PIECE_SCHEMA + (", ids array<bigint>" if with_ids else ""))


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Runs (lengths of one sequence, how many such) that use up ``counts``."""
    left = np.zeros(size + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    runs: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> None:
        need: dict[int, int] = {}
        for n in lengths:
            need[n] = need.get(n, 0) + 1
        times = min(int(left[n]) // k for n, k in need.items())
        for n, k in need.items():
            left[n] -= k * times
        runs.append((lengths, times))

    def pair(total: int, used: dict[int, int]) -> tuple[int, int] | None:
        """The available a >= b with a + b = total whose a is longest."""
        if total < 2:
            return None
        free = left[:total].copy()
        for n, k in used.items():
            if n < total:
                free[n] -= k
        half = total // 2
        longer = np.arange(total - 1, total - half - 1, -1)
        fits = (free[longer] > 0) & (free[total - longer] > 0)
        if total % 2 == 0:
            fits[-1] = free[half] > 1
        at = int(fits.argmax())
        return (int(longer[at]), total - int(longer[at])) if fits[at] else None

    def complement(first: int) -> tuple[int, ...] | None:
        gap = size - first
        used = {first: 1}
        if gap == 0:
            return ()
        if left[gap] - used.get(gap, 0) > 0:
            return (gap,)
        if found := pair(gap, used):
            return found
        for a in (np.flatnonzero(left[:max(gap - 1, 0)])[::-1]).tolist():
            own = used | {a: used.get(a, 0) + 1}
            if left[a] >= own[a] and (found := pair(gap - a, own)):
                return (a, *found)
        return None

    for first in range(size, 0, -1):
        while left[first] and (found := complement(first)) is not None:
            take(first, *found)
    for first in range(size, 0, -1):
        while left[first]:
            bin_, gap, used = [first], size - first, {first: 1}
            while gap:
                fitting = np.flatnonzero(left[:gap + 1])[::-1].tolist()
                n = next((n for n in fitting if left[n] > used.get(n, 0)), None)
                if n is None:
                    break
                bin_.append(n)
                used[n] = used.get(n, 0) + 1
                gap -= n
            take(*bin_)
    return runs


def _places(runs: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first number, first sequence and offset of each stretch of
    pieces that go to one place of one run."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for lengths, times in runs:
        offset = 0
        for n in lengths:
            rows.setdefault(n, []).append((used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r)) for n, r in rows.items()}


def pack(cut_pieces: DataFrame, *, size: int = SIZE) -> DataFrame:
    """Sequence and offset of every piece (columns of ``pieces``)."""
    spark = cut_pieces.sparkSession
    kept = common.stored(cut_pieces, "pieces")
    names = kept.columns
    counts = {r.length: r.n for r in kept.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= size rows
    runs = plan(counts, size)
    places = common.broadcast_checked(spark, _places(runs), 64 * sum(len(r) for r, _ in runs), 256 << 20,
                                      "packing plan")
    salts = max(1, max(counts.values(), default=0) // GROUP_ROWS)
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    numbered = (salted.withColumn("within", within).join(before, ["length", "salt"])
                .select(*names, (F.col("before") + F.col("within") - 1).alias("number")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                own = np.flatnonzero(length == n)
                first, base, at = table[n]
                k = np.searchsorted(first, number[own], "right") - 1
                sequence[own], offset[own] = base[k] + number[own] - first[k], at[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    return numbered.mapInArrow(common.frugal(place), schema + ", sequence_id bigint, offset bigint")


def pack_documents(documents: DataFrame, **options) -> DataFrame:
    """Cut and pack all documents; options as for ``pieces``."""
    size = options.get("size", SIZE)
    return pack(pieces(documents, **options), size=size)
