"""Toxic passages as maximum-scoring segments of token log-odds.

Terms are words and their beginnings of 4 to 8 characters, so that an unseen
word is judged by the longest beginning that is known.  A term's weight is its
log-odds between toxic and clean training texts under an informative Dirichlet
prior (the term's share of the whole, ``prior`` times the total); it teaches if
the weight is large and significant.  Every token then scores its term's weight
less a small drift, and one linear scan (all maximal scoring segments) finds
the passages of a text.

Segment scores are made comparable by extreme-value statistics: lambda solves
sum(p(s) exp(lambda s)) = 1 over the token scores of clean training texts, K is
the maximum-likelihood scale of the clean texts' best segments, and a segment
of score S in a text of n words is expected K n exp(-lambda S) times by chance.
The evidence of a text is the summed excess of its significant segments; its
score is the isotonic share of toxic training texts at that evidence.

Identical texts teach once.  All significant terms are kept, whatever their number;
it is checked against ``TERM_BYTES`` before they are gathered.

Defined results: null, empty or wordless text has no passage and the lowest
score; without toxic or without clean training rows every score is 0; labels
that are null do not teach; a repeated label row counts once, and an id that is
labelled both ways counts as toxic; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHORTEST, LONGEST = 4, 8
#: Marks a whole word among the terms.
WHOLE = "\x03"
PRIOR = 0.05
MIN_WEIGHT, MIN_Z, MIN_SUPPORT = 1.0, 3.0, 3
#: Terms are held by every task: so many bytes at most, 80 a term.  Beyond that the
#: fit ends with an error; it never goes on with a part of the terms.
TERM_BYTES = 256 << 20
DRIFT = 0.3
CLIP = 8.0
EXPECTED = 0.05
THRESHOLD = 0.3
#: Labels up to this many rows (under 32 MB) are sent to all tasks; more are joined by a shuffle.
SMALL_LABELS = 1_000_000
HELD = 150_000


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class a word occurs."""
    counts = [Counter(), Counter()]

    def out():
        words = list(counts[0].keys() | counts[1].keys())
        named = [w.decode("utf-8", "replace").lower() for w in words]
        yield pa.RecordBatch.from_arrays(
            [pa.array(named, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)],
            ["word", "clean", "toxic"])

    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), common.byte_texts(batch.column(1))):
            counts[toxic].update(set(common.alnum_words(text)))
            if len(counts[0]) + len(counts[1]) > HELD:
                yield from out()
                counts = [Counter(), Counter()]
    yield from out()


def _terms(word: str) -> F.Column:
    """A word's beginnings and the whole of it, as an array."""
    return F.expr(
        f"concat(filter(transform(sequence({SHORTEST}, {LONGEST}), k -> if(length({word}) >= k, left({word}, k), null)), "
        f"x -> x IS NOT NULL), array(concat({word}, '{WHOLE}')))")


class Lexicon:
    """Weights of terms; a word takes that of its longest known term."""

    def __init__(self, weights: dict[str, float], drift: float):
        self.weights, self.drift = weights, drift

    def word(self, word: bytes) -> float:
        s, get = word.decode("utf-8", "replace").lower(), self.weights.get
        found = get(s + WHOLE)
        if found is None:
            for k in range(min(LONGEST, len(s)), SHORTEST - 1, -1):
                if (found := get(s[:k])) is not None:
                    break
        return (0.0 if found is None else max(-CLIP, min(CLIP, found))) - self.drift


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), by one linear scan."""
    positive = scores > 0
    if not positive.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], positive.view(np.int8), [0]])))
    stack: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, start, end, last with a lower sum before
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        low, high, begin = float(total[a]), float(total[b]), a
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= high:
                stack.append((low, high, begin, b, j))
                break
            low, begin = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, h - x) for x, h, s, e, _ in stack]


class _Scores(dict):
    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word):
        if len(self) > HELD:
            self.clear()
        found = self[word] = self.lexicon.word(word)
        return found


def _label_rows(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return (labels.where(f"`{label_col}` IS NOT NULL AND `{id_col}` IS NOT NULL")
            .groupBy(F.col(id_col).alias("label_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
            .where("toxic IN (0, 1)"))


def _with_labels(docs: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    side = F.broadcast(labels) if n <= SMALL_LABELS else labels
    return docs.join(side, docs["doc_id"] == side["label_id"]).drop("label_id")


def _all_terms(terms: DataFrame, before: int = 0) -> list:
    """All rows of ``terms``, after checking their number against ``TERM_BYTES``."""
    n = before + terms.count()
    if 80 * n > TERM_BYTES:
        raise ValueError(f"{n} terms exceed the bound of {TERM_BYTES // 80}")
    return terms.collect()


def fit_lexicon(labelled: DataFrame, *, prior: float = PRIOR,
                drift: float = DRIFT) -> tuple[Lexicon, float] | None:
    """The term weights, and lambda, from rows (toxic 0/1, text)."""
    words = common.stored(labelled.select("toxic", "text")
                          .mapInArrow(_presence, "word string, clean bigint, toxic bigint")
                          .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "term-words")
    whole = words.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).first()
    if not whole.clean or not whole.toxic:
        return None
    n0, n1 = float(whole.clean), float(whole.toxic)
    terms = (words.select(F.explode(_terms("word")).alias("term"), "clean", "toxic")
             .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .where(F.col("clean") + F.col("toxic") >= MIN_SUPPORT))
    alpha = (F.col("clean") + F.col("toxic")) * F.lit(prior)
    own1, own0 = F.col("toxic") + alpha * (n1 / (n0 + n1)), F.col("clean") + alpha * (n0 / (n0 + n1))
    all1, all0 = n1 + prior * n1, n0 + prior * n0
    weight = F.log(own1 / F.greatest(F.lit(all1) - own1, F.lit(0.5))) - F.log(own0 / F.greatest(F.lit(all0) - own0, F.lit(0.5)))
    weighed = common.stored(terms.select("term", weight.alias("weight"),
                                         (weight / F.sqrt(1 / own1 + 1 / own0)).alias("z")), "term-weights")
    strong = weighed.where((F.col("weight") >= MIN_WEIGHT) & (F.col("z") >= MIN_Z)).select("term", "weight")
    weights = {r.term: r.weight for r in _all_terms(strong)}
    lead = weighed.sparkSession.createDataFrame(
        [(t,) for t in sorted(weights) if not t.endswith(WHOLE)], "lead string")
    # longer terms under a strong beginning speak for themselves
    inner = (weighed.select("term", "weight", F.explode(_terms("term")).alias("lead"))
             .join(lead, "lead", "left_semi").groupBy("term").agg(F.first("weight").alias("weight")))
    for r in _all_terms(inner, len(weights)):
        weights.setdefault(r.term, r.weight)
    lexicon = Lexicon(weights, drift)
    return lexicon, _lambda(words, lexicon)


def _lambda(words: DataFrame, lexicon: Lexicon) -> float:
    """The positive root of sum(p(s) exp(x s)) = 1 over clean token scores."""
    shared = common.broadcast_checked(words.sparkSession, lexicon, 80 * len(lexicon.weights), 256 << 20, "term weights")

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        own = shared.value
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[round(10 * own.word(word.encode()))] += n
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())],
                                         ["s", "n"])

    rows = (words.select("word", "clean").where("clean > 0").mapInArrow(bins, "s bigint, n bigint")
            .groupBy("s").agg(F.sum("n").alias("n")).collect())  # a row per tenth of a score
    s, p = np.array([r.s / 10 for r in rows]), np.array([r.n for r in rows], float)
    p /= p.sum()
    if not (s > 0).any():
        return 1.0
    low, high = 1e-3, 1e-3
    while (p * np.exp(high * s)).sum() < 1 and high < 50:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * s)).sum() < 1 else (low, mid)
    return max(0.05, (low + high) / 2)


def find_segments(docs: DataFrame, lexicon: Lexicon | None) -> DataFrame:
    """Columns of ``docs`` but the text; number of words; best score; passages."""
    rest = [c for c in docs.columns if c != "text"]
    size = 80 * len(lexicon.weights) if lexicon else 0
    shared = common.broadcast_checked(docs.sparkSession, lexicon, size, 256 << 20, "term weights")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_lexicon = shared.value
        scores = _Scores(own_lexicon) if own_lexicon else None
        for batch in batches:
            n_words, best, found = [], [], []
            for text in common.byte_texts(batch.column("text")):
                words = common.alnum_words(text)
                own = segments(np.fromiter(map(scores.__getitem__, words), np.float64, len(words))) if scores is not None else []
                n_words.append(len(words))
                best.append(max((s for _, _, s in own), default=0.0))
                found.append([{"start": a, "end": b, "score": s} for a, b, s in own])
            passage = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(n_words, pa.int64()), pa.array(best, pa.float64()),
                 pa.array(found, pa.list_(passage))], [*rest, "n_words", "best", "passages"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"),
                        "n_words bigint, best double, passages array<struct<start: bigint, end: bigint, score: double>>"])
    return docs.mapInArrow(run, schema)


def isotonic(x: np.ndarray, n: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising curve of hits / n (pooled adjacent violators)."""
    blocks: list[list[float]] = []  # weight * x, weight, hits
    for a, b, c in zip(x.tolist(), n.tolist(), hits.tolist()):
        blocks.append([a * b, b, c])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    points = np.array([b[0] / b[1] for b in blocks])
    return points, np.array([(b[2] + 0.02) / (b[1] + 0.2) for b in blocks])


def score_toxicity(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", modulus: int = 4, held: int = 2, threshold: float = THRESHOLD,
                   **options) -> DataFrame:
    """doc_id, held_out, score, predicted and the significant passages
    (word ranges, segment score, number expected by chance)."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                            common.fold(id_col, modulus).alias("fold"))
    marked = common.stored(_label_rows(labels, id_col, label_col), "labels")
    n_labels = marked.count()
    teaching = _with_labels(docs.where(F.col("fold") != held), marked, n_labels)
    once = common.stored(
        teaching.where("text IS NOT NULL")
        .groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n"), "toxic").agg(F.min("doc_id").alias("label_id"))
        .select("label_id", "toxic"), "teaching-ids")
    fitted = fit_lexicon(_with_labels(docs.where(F.col("fold") != held), once, n_labels), **options)
    lexicon, scale = fitted or (None, 1.0)
    found = common.stored(find_segments(docs, lexicon), "segments")
    taught = _with_labels(found, once, n_labels)
    clean = taught.where("toxic = 0 AND n_words > 0").agg(
        F.count("*").alias("n"), F.sum(F.col("n_words") * F.exp(F.col("best") * -scale)).alias("m")).first()
    k = clean.n / clean.m if clean.n and clean.m else 1.0
    expected = lambda s: F.lit(k) * F.greatest("n_words", F.lit(1)) * F.exp(s * F.lit(-scale))
    rated = found.withColumn("passages", F.filter(F.transform("passages", lambda p: F.struct(
        p["start"].alias("start"), p["end"].alias("end"), p["score"].alias("score"), expected(p["score"]).alias("expected"))),
        lambda p: p["expected"] <= EXPECTED))
    evidence = F.when(F.size("passages") > 0, F.aggregate(
        "passages", F.lit(0.0), lambda a, p: a - F.log(p["expected"]))).otherwise(-F.log(expected(F.col("best"))))
    rated = rated.withColumn("evidence", F.when(F.col("n_words") > 0, F.greatest(F.lit(-60.0), F.least(F.lit(200.0), evidence)))
                             .otherwise(F.lit(-60.0)))
    curve = (_with_labels(rated, once, n_labels).groupBy(F.round(F.col("evidence") * 4).cast("int").alias("x"))
             .agg(F.count("*").alias("n"), F.sum("toxic").alias("hits")).orderBy("x").collect())  # under 1,100 rows
    if lexicon is None or not curve:
        score = F.lit(0.0)
    else:
        x, y = isotonic(*(np.array([r[c] for r in curve], float) for c in ("x", "n", "hits")))
        score = _interpolated(F.col("evidence") * 4, x.tolist(), y.tolist())
    return (rated.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))
            .select("doc_id", F.coalesce(F.col("fold") == held, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence", "passages"))


def _interpolated(value: F.Column, x: list[float], y: list[float]) -> F.Column:
    """Straight lines between the points, level outside."""
    out = F.lit(y[-1])
    for i in range(len(x) - 1, 0, -1):
        line = F.lit(y[i - 1]) + (value - F.lit(x[i - 1])) * F.lit((y[i] - y[i - 1]) / (x[i] - x[i - 1]))
        out = F.when(value < F.lit(x[i]), line).otherwise(out)
    return F.when(value < F.lit(x[0]), F.lit(y[0])).otherwise(out)
