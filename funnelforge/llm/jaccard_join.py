"""Exact n-gram Jaccard join of whole texts, with set-relation skipping.

A text's set holds the 64-bit hashes of its distinct word n-grams.  Texts with
the same set form a class; classes are joined, and copies only count.

*Index.*  Shingles are ordered by how often they repeat (rarest first; the order
comes from repeats counted inside every task over all documents, and any order
gives the same result).  A class is listed under the shingles of its prefix, of
which similar classes share one.  Lists keep the position, so what follows a
shingle bounds the overlap, and whole blocks of a list (the rows of one hub) are
skipped by their bounds on size and remaining positions.

*Answers from similar sets.*  A class is first compared with one class only: of
those that lead its lists (listed most often), that which it meets most, in a
group of near copies usually their original.  If they link it
becomes a member of that hub and keeps its overlap with it.  From then on hubs
answer for their members: a pair of hubs in different components is compared
once, and by the kept overlaps its result bounds that of every pair of members,

    overlap(z, m) <= overlap(h, g) + (|z| - overlap(z, h)) + (|m| - overlap(m, g)),

so only members that this bound leaves open are compared themselves.  Before
that, in a few turns, every component compares some members with some of the
component that it meets most, so that a large group of near copies joins at a
cost in proportion to its size; all that still lies apart is compared in full.

Comparisons compute exact overlaps from the texts.  A set with many partners is
split over tasks by salting.  Components are the connected components of all
links; links inside a component that is already known need no comparison.

Defined results: null and wordless texts have no shingle and are linked with
nothing; shorter texts than ``width`` words are one shingle, the whole sequence;
repeated rows count as given (equal sets are linked); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WIDTH = 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
NEED, OF = 75, 100
#: Shingles counted at once in a task; repeats in a task that are reported.
COUNTED, REPEATS = 1_500_000, 3
#: Shingles that are ordered by their counts, at most (8 MB); all others come first.
ORDERED = 500_000
#: A class is first compared with classes that it meets in lists as many as this share of its size.
FIRST_MET = 0.05
#: Turns in which every component asks a few of another only.
TURNS, ASKED = 1, 4
#: Members that one task compares with a copy of their hub, about.
SALT_ROWS = 500
#: Likeliest open pairs of a member that are compared before all of them.
LIKELY = 2
#: Hub pairs with more member pairs than this compare their members in parts.
FEW_PAIRS = 64
#: Words a task keeps hashes of.
HELD = 150_000
_MIX = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1


class Shingler:
    """Sets of word n-gram hashes, sorted."""

    def __init__(self, width: int):
        self.width = width
        self.hashes = _WordHashes()
        self.powers = [pow(_MIX, k, 1 << 64) for k in range(width)]

    def __call__(self, text: bytes) -> np.ndarray:
        words = common.space_words(text)
        if not words:
            return np.empty(0, np.uint64)
        if len(self.hashes) > HELD:
            self.hashes.clear()
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        if len(words) < self.width:  # the length keeps it apart from n-grams
            return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(words))], np.uint64)
        n = len(words) - self.width + 1
        total = np.zeros(n, np.uint64)
        for k, power in enumerate(self.powers):
            total += h[k:k + n] * np.uint64(power)
        total ^= total >> np.uint64(31)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
        return np.unique(total)


class _WordHashes(dict):
    def __missing__(self, word):
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def set_key(shingles: np.ndarray) -> int:
    """The class of a set, as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)) - (1 << 63)


def signature(shingles: np.ndarray) -> bytes:
    """A bitmap of the set, of two to four bits a member."""
    bits = 1 << max(6, (2 * max(1, len(shingles)) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """At least so many members are in one of two sets only, by their bitmaps."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    if len(y) > len(x):  # equal low bits fall together
        y = np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def prefix_length(n: int, need: int = NEED, of: int = OF) -> int:
    """So many first shingles share one with every similar set's."""
    return n - -(-need * n // of) + 1


def enough(shared: Column, a: Column, b: Column) -> Column:
    """Whether ``shared`` common shingles make sets of sizes a and b similar."""
    return shared * (NEED + OF) >= (a + b) * NEED


def _survey(width: int):
    """Per document its class and size; per task the shingles that repeat in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        held: list[np.ndarray] = []
        n_held = 0

        def repeats() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
            found, n = found[n >= REPEATS], n[n >= REPEATS]
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64()), pa.array(found.view(np.int64)),
                 pa.array(n.astype(np.int64)), pa.nulls(len(n), pa.binary()), pa.array([False] * len(n), pa.bool_())],
                ["doc_id", "text_hash", "key", "n", "sketch", "is_doc"])

        for batch in batches:
            keys, sizes, sketches = [], [], []
            for text in common.byte_texts(batch.column(2)):
                own = shingle(text)
                keys.append(set_key(own))
                sketches.append(signature(own))
                sizes.append(len(own))
                held.append(own)
                n_held += len(own)
                if n_held >= COUNTED:
                    yield repeats()
                    held, n_held = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(sketches, pa.binary()), pa.array([True] * len(keys), pa.bool_())],
                ["doc_id", "text_hash", "key", "n", "sketch", "is_doc"])
        yield repeats()

    return run


def _prefixes(width: int, ordered):
    """(token, key, n, pos) of every document's prefix.  Of a token 40 bits are
    kept: a list may hold a few rows of another, which costs comparisons only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        known, times = ordered.value
        for batch in batches:
            tokens, keys, sizes = [], [], []
            seen = set()
            for text in common.byte_texts(batch.column(0)):
                own = shingle(text)
                key = set_key(own)
                if not len(own) or key in seen:
                    continue
                seen.add(key)
                n = prefix_length(len(own))
                if len(known):
                    at = np.searchsorted(known, own)
                    at[at == len(known)] = 0
                    count = np.where(known[at] == own, times[at], 0)
                    if count.any():
                        own = own[np.argsort(count, kind="stable")]
                tokens.append(own[:n])
                keys.append(key)
                sizes.append(len(own))
            lengths = np.array([len(t) for t in tokens], np.int64)
            place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            all_tokens = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((all_tokens >> np.uint64(24)).view(np.int64)),
                 pa.array(np.repeat(np.array(keys, np.int64), lengths)),
                 pa.array(np.repeat(np.array(sizes, np.int32), lengths)), pa.array(place.astype(np.int32))],
                ["token", "key", "n", "pos"])

    return run


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (token, n, key, pos): rows of lists with two classes at
    least."""
    tail: pa.Table | None = None  # the last list's only row so far
    open_list = False  # rows of the last list have been passed on
    last_key = last_token = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if tail is not None:
            rows = pa.concat_tables([tail, rows])
        token, key, n, pos = (rows.column(c).to_numpy() for c in ("token", "key", "n", "pos"))
        if not len(token):
            continue
        new = np.concatenate([[True], token[1:] != token[:-1]])
        same = np.concatenate([[False], (token[1:] == token[:-1]) & (key[1:] == key[:-1])])
        carried = open_list and token[0] == last_token
        if carried:
            new[0], same[0] = False, key[0] == last_key
        token, key, n, pos, new = (c[~same] for c in (token, key, n, pos, new))
        if not len(token):
            tail = None
            continue
        carried = carried and token[0] == last_token  # its rows here may all be repeats
        start = np.flatnonzero(new) if new[0] else np.concatenate([[0], np.flatnonzero(new)])
        size = np.diff(np.append(start, len(token)))
        grouped = np.repeat(size > 1, size)
        if carried:
            grouped[:size[0]] = True
        if size[-1] == 1 and not (carried and len(start) == 1):  # one class so far: it waits for the next rows
            grouped[-1] = False
            tail = pa.table({"token": token[-1:], "key": key[-1:], "n": n[-1:], "pos": pos[-1:]}, schema=batch.schema)
            open_list = False
        else:
            tail, open_list = None, True
        last_key, last_token = key[-1], token[-1]
        grouped &= _has_partner(size, n.astype(np.int64), pos.astype(np.int64), carried)
        yield pa.RecordBatch.from_arrays([pa.array(c[grouped]) for c in (token, key, n, pos)], ["token", "key", "n", "pos"])


def _has_partner(size: np.ndarray, n: np.ndarray, pos: np.ndarray, carried: bool) -> np.ndarray:
    """Which rows of the lists (of these sizes, rows sorted by n) may have a
    similar class in their list: one of a fitting size for which enough follows
    in the row's own set.  Lists that other batches share stay whole."""
    group = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(n))
    low = np.searchsorted(group * (1 << 40) + n, group * (1 << 40) + -(-NEED * n // OF))  # smallest fitting set
    after = np.minimum(place + 1, len(n) - 1)
    larger = (after > place) & (group[after] == group) & (OF * n >= NEED * n[after])
    partner = np.where(low < place, low, after)
    keep = ((low < place) | larger) & ((n - pos) * (NEED + OF) >= (n + n[partner]) * NEED)
    keep &= np.repeat(np.bincount(group, keep, len(size)) > 1, size)
    whole = np.zeros(len(size), bool)
    whole[-1] = True
    whole[0] |= carried
    return keep | np.repeat(whole, size)


def _compare(width: int):
    """From rows sorted by (a, salt, role): each hub's set, then its partners'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        hub, hub_set = None, None
        for batch in batches:
            found = []
            a, b, text = batch.column("a").to_pylist(), batch.column("b").to_pylist(), common.byte_texts(batch.column("text"))
            for x, y, t in zip(a, b, text):
                own = shingle(t)
                if y is None:
                    hub, hub_set = x, own
                elif hub != x:
                    raise ValueError(f"no text for set {x}")
                else:
                    found.append((x, y, len(hub_set), len(own), overlap(hub_set, own)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (list(zip(*found)) or [[]] * 5)], ["a", "b", "n_a", "n_b", "shared"])

    return run


def _most_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The overlap of each pair is at most what its bitmaps allow."""
    for batch in batches:
        apart = [least_difference(x.as_py(), y.as_py()) for x, y in zip(batch.column("sketch_a"), batch.column("sketch_b"))]
        most = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy() - np.array(apart, np.int64)) // 2
        yield batch.select(["a", "b", "n_a", "n_b"]).append_column("shared", pa.array(most, pa.int64()))


def compare(pairs: DataFrame, docs: DataFrame, speakers: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a, b, n_a, n_b, shared) of the distinct pairs (a, b): the exact overlap
    of pairs that may be similar, else an upper bound that rules them out.

    ``speakers`` names a document (doc_id, text_hash) for each class and holds
    its size and bitmap, which gives the bound; texts are read again for the
    classes of the other pairs only."""
    sketched = [speakers.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
                for s in "ab"]
    bounded = common.stored(pairs.join(sketched[0], "a").join(sketched[1], "b").mapInArrow(
        common.frugal(_most_shared), "a bigint, b bigint, n_a bigint, n_b bigint, shared bigint"), "pairs")
    pairs = bounded.where(_similar()).select("a", "b")
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = common.stored(speakers.join(keys, "key").select(
        F.col("doc_id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"), "key"), "wanted")
    side = F.broadcast(wanted) if wanted.count() <= common.SMALL_IDS else wanted
    text = common.stored(docs.join(side, docs["doc_id"].eqNullSafe(side["wanted_id"])
                                   & (docs["text_hash"] == side["wanted_hash"])).select("key", "text"), "class-texts")
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(SALT_ROWS)).cast("int").alias("salts"))
    hubs = (salts.join(text, salts["a"] == text["key"])
            .select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                    F.lit(None).cast("bigint").alias("b"), "text"))
    partners = (pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
                .join(text, F.col("b") == text["key"]).select("a", "salt", "b", "text"))
    rows = hubs.unionByName(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return common.stored(rows.select("a", "b", "text").mapInArrow(
        common.frugal(_compare(width)), "a bigint, b bigint, n_a bigint, n_b bigint, shared bigint"), "overlaps").distinct() \
        .unionByName(bounded.where(~_similar()))


def components(edges: DataFrame) -> DataFrame:
    """(key, comp) of all vertices of edges (a, b); comp is the smallest key."""
    both = common.stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                         .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = common.stored(both.groupBy(F.col("u").alias("key")).agg(F.least(F.min("v"), F.first("u")).alias("comp")), "labels")
    while True:
        seen = both.join(labels.select(F.col("key").alias("v"), F.col("comp").alias("near")), "v")
        nearest = seen.groupBy(F.col("u").alias("key")).agg(F.min("near").alias("near"))
        stepped = labels.join(nearest, "key").select("key", F.col("comp").alias("old"), F.least("comp", "near").alias("mid"))
        # a label's own label is nearer still
        jump = labels.select(F.col("key").alias("mid"), F.col("comp").alias("next"))
        moved = common.stored(stepped.join(jump, "mid", "left").select(
            "key", "old", F.least("mid", F.coalesce("next", "mid")).alias("comp")), "labels")
        labels = moved.select("key", "comp")
        if moved.where("old <> comp").isEmpty():
            return labels


def _hubs(known: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, hub, n, shared, comp): the hub that answers for a class, itself if none."""
    links = known.where(_similar())
    inner = links.select(F.col("b").alias("inner")).distinct()
    outer = links.join(inner, links["a"] == inner["inner"], "left_anti")  # hubs are members of no hub
    own = outer.groupBy(F.col("b").alias("key")).agg(F.max(F.struct("shared", F.col("a").alias("hub"))).alias("best"))
    return (sizes.join(own, "key", "left").join(components(links.select("a", "b")), "key", "left")
            .select("key", "n", F.coalesce("best.hub", "key").alias("hub"), F.coalesce("best.shared", "n").alias("shared"),
                    F.coalesce("comp", "key").alias("comp")))


def _similar() -> Column:
    return enough(F.col("shared"), F.col("n_a"), F.col("n_b"))


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (key, comp) after joining the components of linked classes (a, b)."""
    moved = components(_apart(links, comps).select(F.col("u").alias("a"), F.col("v").alias("b")))
    return common.stored(comps.join(moved.select(F.col("key").alias("comp"), F.col("comp").alias("to")), "comp", "left")
                         .select("key", F.coalesce("to", "comp").alias("comp")), "comps")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes in different components, with these as u and v."""
    return (pairs.join(comps.select(F.col("key").alias("a"), F.col("comp").alias("u")), "a")
            .join(comps.select(F.col("key").alias("b"), F.col("comp").alias("v")), "b").where("u <> v"))


def _questions(lists: DataFrame, comps: DataFrame, turn: int) -> DataFrame:
    """A few pairs (a, b) for every component that shares many lists with another:
    in each list some member of it with some member of the list's main component."""
    pick = F.struct(F.xxhash64("key", "token", F.lit(turn)).alias("h"), "key", "n")
    # dealt by token once, for all that follows per list
    parts = (lists.join(comps, "key").repartition("token").groupBy("token", "comp")
             .agg(F.count("*").alias("rows"), F.min(pick).alias("own")))
    main = parts.groupBy("token").agg(F.max(F.struct("rows", "comp", "own")).alias("main"), F.count("*").alias("comps"))
    asks = (parts.join(main.where("comps > 1"), "token").where("comp <> main.comp")
            .select("token", F.col("comp").alias("u"), F.col("main.comp").alias("v"), F.col("own.key").alias("b"),
                    F.col("main.own.key").alias("a"), F.col("own.n").alias("m"), F.col("main.own.n").alias("n"))
            .withColumn("h", F.xxhash64("token", F.lit(turn))))
    # the component that is met most, and of the pairs met there a few
    met = asks.groupBy("u", "v").agg(F.count("*").alias("lists"), F.max("m").alias("size"))
    best = (met.where(F.col("lists") >= F.col("size") * FIRST_MET).groupBy("u")
            .agg(F.max(F.struct("lists", "v")).alias("best")).select("u", "best.v"))
    few = F.row_number().over(Window.partitionBy("u").orderBy("h"))
    return (asks.where(enough(F.least("m", "n"), F.col("m"), F.col("n"))).join(best, ["u", "v"])
            .withColumn("place", few).where(F.col("place") <= ASKED).select("a", "b").distinct())


def join(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class key, text_hash."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                            F.col(text_col).alias("text"))
    survey = common.stored(docs.mapInArrow(
        common.frugal(_survey(width)), "doc_id bigint, text_hash bigint, key bigint, n bigint, sketch binary, is_doc boolean"), "survey")
    members = survey.where("is_doc").select("doc_id", "text_hash", "key", "n", "sketch")
    labels = _labels(spark, docs, members, survey.where("NOT is_doc").select(F.col("key").alias("token"), "n"), width)
    labelled = members.join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    least = labelled.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return (labelled.join(least, "comp", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "key", "text_hash"))


def _sized() -> Column:
    """Whether sets of sizes least_a..most_a and least_b..most_b can be similar."""
    return enough(F.col("most_a"), F.col("most_a"), F.col("least_b")) & enough(F.col("most_b"), F.col("most_b"), F.col("least_a"))


def _reach() -> Column:
    """Whether enough follows in both sets."""
    return enough(F.least("rest_a", "rest_b"), F.col("least_a"), F.col("least_b"))


def _sided(df: DataFrame, key: str, side: str) -> DataFrame:
    """``df`` with all columns but ``key`` named for one side of a join."""
    return df.select(*[F.col(c) if c == key else F.col(c).alias(f"{c}_{side}") for c in df.columns])


def _open_members(likely: int | None):
    """Pairs of a part of one hub's members with a part of others' that neither the
    hubs' overlap nor the bitmaps rule out; of those of each of the others only so
    many whose bitmaps leave most in common, if ``likely`` is given."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _open_pairs(left, right, likely)

    return run


def _open_pairs(left: pd.DataFrame, right: pd.DataFrame, likely: int | None) -> pd.DataFrame:
    out_a, out_b = [], []
    if len(left) and len(right):
        keys, m, inside, out = (left[c].to_numpy() for c in ("key_a", "m_a", "in_a", "out_a"))
        by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = left.sketch_a.map(len).to_numpy()
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            by_size[n] = own, np.stack([np.frombuffer(x, np.uint8) for x in left.sketch_a.to_numpy()[own]])
        for z in right.itertuples(index=False):
            shared = z.shared
            most = np.minimum(np.minimum(z.in_b, shared + out) + z.out_b, np.minimum(inside, shared + z.out_b) + out)
            alive = most * (NEED + OF) >= (m + z.m_b) * NEED
            sketch = np.frombuffer(z.sketch_b, np.uint8)
            open_, common_ = [], []
            for n, (own, rows) in by_size.items():
                own_alive = alive[own]
                if not own_alive.any():
                    continue
                own, rows = own[own_alive], rows[own_alive]
                x = sketch
                if len(x) > n:
                    x = np.bitwise_or.reduce(x.reshape(-1, n), axis=0)
                elif len(x) < n:
                    rows = np.bitwise_or.reduce(rows.reshape(len(rows), -1, len(x)), axis=1)
                apart = np.bitwise_count(rows ^ x).sum(axis=1, dtype=np.int64)
                fits = apart * (OF + NEED) <= (m[own] + z.m_b) * (OF - NEED)
                open_.append(own[fits])
                common_.append((m[own] + z.m_b - apart)[fits] / (m[own] + z.m_b)[fits])
            found = np.concatenate(open_) if open_ else np.empty(0, np.int64)
            if likely is not None and len(found) > likely:
                found = found[np.argsort(-np.concatenate(common_), kind="stable")[:likely]]
            out_a += keys[found].tolist()
            out_b += [z.key_b] * len(found)
    return pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})


def _few(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Open member pairs of open hub pairs with at most FEW_PAIRS member pairs.  A hub's
    members, FEW_PAIRS at most, come along as one array, and pairs that the bound rules
    out are never made into rows."""
    asked = pairs.select(F.col("a").alias("hub")).unionByName(pairs.select(F.col("b").alias("hub"))).distinct()
    packs = (kept.join(asked, "hub").groupBy("hub").agg(F.collect_list(F.struct(
        F.col("key"), F.col("n").alias("m"), F.col("shared").alias("inside"), (F.col("n") - F.col("shared")).alias("out"))).alias("members")))
    packed = [packs.select(F.col("hub").alias(s), F.col("members").alias(f"members_{s}")) for s in "ab"]

    def alive(x: Column, y: Column) -> Column:
        """Members x of a and y of b that may be similar, and are not both hubs."""
        shared = F.col("shared")
        return (~((x["key"] == F.col("a")) & (y["key"] == F.col("b")))
                & enough(F.least(y["inside"], shared + x["out"]) + y["out"], x["m"], y["m"])
                & enough(F.least(x["inside"], shared + y["out"]) + x["out"], x["m"], y["m"]))

    found = F.flatten(F.transform("members_a", lambda x: F.transform(
        F.filter("members_b", lambda y: alive(x, y)), lambda y: F.struct(x["key"].alias("a"), y["key"].alias("b")))))
    return pairs.join(packed[0], "a").join(packed[1], "b").select(F.inline(found))


def _many(pairs: DataFrame, h: DataFrame, g: DataFrame, spread: DataFrame, likely: int | None = None) -> DataFrame:
    """Open member pairs of open hub pairs with many members: parts of at most
    about SALT_ROWS members meet, each member is sent once to a part.  With
    ``likely``, so many for each member of the smaller side in a part."""
    parts = spread.select(F.col("hub").alias("a"), F.ceil(F.col("members") / SALT_ROWS).cast("int").alias("parts"))
    asking = pairs.join(g, "b")
    salts = asking.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")).join(parts, "a")
    left = (h.join(salts, "a").withColumn("part", F.pmod(F.xxhash64("key_a"), F.col("parts")).cast("int"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    right = (asking.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("key_b"), F.col("salts")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    on = ["a", "part", "salt"]
    return (left.select(*on, "key_a", "m_a", "in_a", "out_a", "sketch_a").groupBy(*on)
            .cogroup(right.select(*on, "key_b", "m_b", "in_b", "out_b", "shared", "sketch_b").groupBy(*on))
            .applyInPandas(_open_members(likely), "a bigint, b bigint"))


def _labels(spark: SparkSession, docs: DataFrame, members: DataFrame, repeats: DataFrame, width: int) -> DataFrame:
    """(key, comp) of all classes that share a list with another."""
    top = (repeats.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(ORDERED)).toArrow()
    tokens = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    ordered = spark.sparkContext.broadcast((tokens[order], top.column("n").to_numpy()[order]))
    rows = docs.select("text").mapInArrow(common.frugal(_prefixes(width, ordered)), "token bigint, key bigint, n int, pos int")
    lists = common.stored(
        rows.repartition("token").sortWithinPartitions("token", "n", "key", "pos")
        .mapInArrow(common.frugal(_shared_rows), "token bigint, key bigint, n int, pos int"), "lists")
    common.give_back(spark)  # the texts have been read; what follows is smaller
    sizes = common.stored(lists.groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("rows")), "class-sizes")
    # one document speaks for its class
    speakers = common.stored(
        members.join(sizes.select("key"), "key").groupBy("key").agg(F.min(F.struct("doc_id", "text_hash", "n", "sketch")).alias("row"))
        .select("key", "row.*"), "speakers")

    # first answers: of the classes that lead its lists (those listed most often), that which a class meets most
    led = lists.join(sizes.select("key", "rows"), "key").repartition("token")
    leader = led.groupBy("token").agg(F.max(F.struct("rows", "key", "n")).alias("lead"))
    met = (led.join(leader, "token").where((F.col("lead.key") != F.col("key"))
                                           & enough(F.least("n", "lead.n"), F.col("n"), F.col("lead.n")))
           .groupBy(F.col("lead.key").alias("a"), F.col("key").alias("b")).agg(F.count("*").alias("lists"), F.first("n").alias("n")))
    near = (met.where(F.col("lists") >= F.col("n") * FIRST_MET).groupBy("b")
            .agg(F.max(F.struct("lists", "a")).alias("most")).select("most.a", "b"))
    hubs = common.stored(_hubs(compare(near, docs, speakers, width), sizes), "hubs")
    common.give_back(spark)  # here and below: what was shuffled so far is not read again
    comps = hubs.select("key", "comp")
    for turn in range(TURNS):
        answers = compare(_questions(lists, comps, turn), docs, speakers, width)
        comps = _merged(comps, answers.where(_similar()).select("a", "b"))

    # hubs answer for their members: pairs of hubs that lie apart and may have similar members
    spread = hubs.groupBy("hub").agg(F.max(F.col("n") - F.col("shared")).alias("apart"), F.min("n").alias("least"),
                                     F.max("n").alias("most"), F.count("*").alias("members"))
    spread = common.stored(spread.join(comps.withColumnRenamed("key", "hub"), "hub"), "spread")
    one = Window.partitionBy("token")
    placed = (lists.select("token", "key", "n", (F.col("n") - F.col("pos")).alias("rest"))
              .join(hubs.select("key", "hub").join(comps, "key"), "key")
              .withColumn("x", F.min("comp").over(one)).withColumn("y", F.max("comp").over(one)).where("x <> y"))
    placed = common.stored(placed.groupBy("token", "comp", "hub").agg(
        F.max("rest").alias("rest"), F.min("n").alias("least"), F.max("n").alias("most")), "blocks")
    common.give_back(spark)
    by_comp = placed.repartition("token").groupBy("token", "comp").agg(*[f(c).alias(c) for f, c in (
        (F.max, "rest"), (F.min, "least"), (F.max, "most"))])
    left, right = (_sided(by_comp, "token", s) for s in "ab")
    met = common.stored(left.join(right, "token").where((F.col("comp_a") < F.col("comp_b")) & _sized() & _reach())
                        .select("token", "comp_a", "comp_b", F.least("least_a", "least_b").alias("size")), "met")
    n_hubs = spread.groupBy("comp").agg(F.count("*").alias("hubs"))
    apart = common.stored(
        met.groupBy("comp_a", "comp_b").agg((F.count("*") >= F.max("size") * FIRST_MET).alias("often"))
        .join(_sided(n_hubs, "", "a"), "comp_a").join(_sided(n_hubs, "", "b"), "comp_b")
        .select("comp_a", "comp_b", (F.col("often") | ((F.col("hubs_a") == 1) & (F.col("hubs_b") == 1))).alias("close")), "apart")
    # components that meet often or are one hub: all their hubs; others: the hubs that meet in a list
    left, right = (_sided(spread.select("comp", "hub", "least", "most"), "", s) for s in "ab")
    close = apart.where("close").join(left, "comp_a").join(right, "comp_b").where(_sized())
    left, right = (_sided(placed, "token", s) for s in "ab")
    far = (met.drop("size").join(apart.where("NOT close"), ["comp_a", "comp_b"])
           .join(left, ["token", "comp_a"]).join(right, ["token", "comp_b"]).where(_sized() & _reach()))
    meetings = (close.select("hub_a", "hub_b").unionByName(far.select("hub_a", "hub_b"))
                .select(F.least("hub_a", "hub_b").alias("a"), F.greatest("hub_a", "hub_b").alias("b")).distinct())
    asked = compare(meetings.select("a", "b"), docs, speakers, width)
    comps = _merged(comps, asked.where(_similar()).select("a", "b"))
    common.give_back(spark)

    # members that the hubs' overlap leaves open
    bounds = [spread.select(F.col("hub").alias(s), F.col("apart").alias(f"apart_{s}"), F.col("least").alias(f"least_{s}"),
                            F.col("members").alias(f"members_{s}")) for s in "ab"]
    open_ = (_apart(asked.where(~_similar()), comps).join(bounds[0], "a").join(bounds[1], "b")
             .where(enough(F.col("shared") + F.col("apart_a") + F.col("apart_b"), F.col("least_a"), F.col("least_b"))
                    & ((F.col("members_a") > 1) | (F.col("members_b") > 1)))
             .withColumn("swap", F.col("members_a") < F.col("members_b"))  # a has more members
             .select(F.when(F.col("swap"), F.col("b")).otherwise(F.col("a")).alias("a"),
                     F.when(F.col("swap"), F.col("a")).otherwise(F.col("b")).alias("b"), "shared",
                     (F.col("members_a") * F.col("members_b") > FEW_PAIRS).alias("many")))
    open_ = common.stored(open_, "open")
    kept = hubs.join(speakers.select("key", "sketch"), "key")
    h, g = (kept.select(F.col("hub").alias(s), F.col("key").alias(f"key_{s}"), F.col("n").alias(f"m_{s}"),
                        F.col("shared").alias(f"in_{s}"), (F.col("n") - F.col("shared")).alias(f"out_{s}"),
                        F.col("sketch").alias(f"sketch_{s}")) for s in "ab")
    # where many members are open, the likeliest pairs may join the components; the others are then not needed
    likeliest = compare(_many(open_.where("many"), h, g, spread, LIKELY).distinct(), docs, speakers, width)
    comps = _merged(comps, likeliest.where(_similar()).select("a", "b"))
    left = _apart(open_, comps).select(*open_.columns)
    few = _few(left.where("NOT many"), kept)
    inner = few.unionByName(_many(left.where("many"), h, g, spread)).distinct()
    within = compare(inner.join(likeliest.select("a", "b"), ["a", "b"], "left_anti"), docs, speakers, width)
    return _merged(comps, within.where(_similar()).select("a", "b"))


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id; columns as they
    were.  Of rows with equal id and text one stays; rows without id stay."""
    joined = common.stored(join(documents), "components")
    others = joined.where("doc_id IS NOT NULL AND doc_id <> component_id")
    out = common.without(documents, others.select(common.row_key(text_hash=F.col("text_hash")).alias("row_key")))
    repeated = joined.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return out
    return out.where("doc_id IS NULL").unionByName(out.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))
