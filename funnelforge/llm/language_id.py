"""Language identification with Kneser-Ney character language models.

Training counts the words of all labelled texts per language (combined inside
each task before the shuffle), then the character n-grams of those words: a
word is read as ``start c1 .. ck end`` and each symbol is predicted from up to
``order - 1`` symbols before it in the word.  Per language an interpolated
Kneser-Ney model is estimated from the highest-order counts; lower orders use
continuation counts.  All languages share one sorted array of n-gram hashes
with a row of log-probabilities and back-off weights per language, found by
binary search.  The order is the same at any corpus size; the tables grow with
the distinct n-grams, far slower than the texts, and models above the broadcast
bound are an error, never coarser models.

A text's cross-entropy in bits a symbol is taken over all its words; the
language with the lowest wins (ties: first name).  A text is rejected if it
has no letter, or if its cross-entropy lies more than ``reject_z`` standard
deviations above the mean of that language's training texts.

Defined results: null, empty or letterless text is ``und`` with score 0 and is
rejected; without any training row every text is ``und``; rows whose id is null
never teach and are not held out; repeated rows count as given; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ORDER = 5
#: Models are sent to all tasks up to this size.
SENT_BYTES = 512 << 20
REJECT_Z = 10.0
#: Symbols of evidence that count towards the score.
EVIDENCE = 20
START, END = "\x02", "\x03"
UNKNOWN = "und"
#: Symbols over which unseen characters share probability.
ALPHABET = 1 << 16
#: Entries that a task gathers before it passes counts on or starts its cache anew.
HELD = 150_000
#: New words, or texts, that are scored together.
TOGETHER = 4_000
_BASE, _WRAP = 0x9E3779B97F4A7C15, (1 << 64) - 1
_LETTERS = re.compile(r"[^\W\d_]+")


def letters(word: bytes) -> list[str]:
    """Lower-case runs of letters in a word (numerals like ``½`` are none)."""
    found = _LETTERS.findall(word.decode("utf-8", "replace").lower())
    return [r for r in found if r.isalpha() or any(map(str.isalpha, r))]


def _flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, own in counts.items():
        clean: Counter = Counter()
        for word, n in own.items():
            for run in letters(word):
                clean[run] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(clean), pa.string()), pa.array(clean.keys(), pa.string()),
             pa.array(clean.values(), pa.int64())], ["lang", "word", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), common.byte_texts(batch.column(1))):
            counts.setdefault(lang, Counter()).update(common.alnum_words(text))
            if sum(map(len, counts.values())) > HELD:
                yield from _flush(counts)
                counts = {}
    yield from _flush(counts)


def _grams(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out():
            for lang, own in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(own.keys(), pa.string()),
                     pa.array(own.values(), pa.int64())], ["lang", "gram", "n"])

        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = counts.setdefault(lang, Counter())
                s = START + word + END
                for i in range(2, len(s) + 1):
                    own[s[max(0, i - order):i]] += n
            if sum(map(len, counts.values())) > HELD:
                yield from out()
                counts.clear()
        yield from out()

    return count


def kneser_ney(top: dict[str, int], order: int) -> dict[str, tuple[float, float]]:
    """gram -> (log2 probability of its last symbol, log2 back-off weight as a
    context) from the highest-order counts.  Grams shorter than ``order`` begin
    with START.  The empty gram holds log2 of an unseen symbol's probability."""
    frame = pd.DataFrame({"gram": list(top), "n": np.array(list(top.values()), np.float64)})
    frame["len"] = frame.gram.str.len()
    levels: list[pd.DataFrame] = []
    for k in range(order, 0, -1):
        own = frame.loc[frame.len == k, ["gram", "n"]]
        if levels:  # distinct symbols that precede each gram; START counts as one
            shorter = levels[-1].gram.str[1:].value_counts()
            own = pd.concat([own, pd.DataFrame({"gram": shorter.index, "n": shorter.to_numpy(np.float64)})])
            own = own.groupby("gram", as_index=False, sort=False).n.sum()
        levels.append(own[own.gram != START])
    prob: dict[str, float] = {}
    weight: dict[str, float] = {}
    for level in reversed(levels):
        if level.empty:
            continue
        n = level.n.to_numpy()
        once, twice = float((n == 1).sum()), float((n == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts = level.gram.str[:-1]
        grouped = level.groupby(contexts).n.agg(["sum", "size"])
        gamma = discount * grouped["size"] / grouped["sum"]
        for context, g in gamma.items():
            weight[context] = math.log2(g)
        total = grouped["sum"].reindex(contexts).to_numpy()
        lower = np.array([prob[g[1:]] if len(g) > 1 else 1 / ALPHABET for g in level.gram])
        p = (n - discount) / total + gamma.reindex(contexts).to_numpy() * lower
        prob.update(zip(level.gram, p.tolist()))
    found = {g: (math.log2(p), weight.get(g, 0.0)) for g, p in prob.items()}
    found[START] = (0.0, weight.get(START, 0.0))
    found[""] = (weight.get("", 0.0) - math.log2(ALPHABET), 0.0)
    return found


def model_rows(lang: str, model: dict[str, tuple[float, float]]) -> pd.DataFrame:
    """A language's model by hashes: of each gram, of its context (all but the
    last symbol) and of what is left without the first symbol."""
    parts = []
    grams = sorted(model, key=len)
    sizes = np.array([len(g) for g in grams])
    for size in np.unique(sizes).tolist():
        own = [grams[i] for i in np.flatnonzero(sizes == size)]
        codes = np.frombuffer("".join(own).encode("utf-32-le", "replace"), np.uint32).reshape(len(own), size)
        parts.append(pd.DataFrame({
            "lang": lang, "size": size, "hash": _row_hashes(codes), "context": _row_hashes(codes[:, :-1]),
            "shorter": _row_hashes(codes[:, 1:]), "logp": [model[g][0] for g in own], "backoff": [model[g][1] for g in own]}))
    return pd.concat(parts, ignore_index=True)


def _row_hashes(codes: np.ndarray) -> np.ndarray:
    """The hash of each row of symbols, signed; 0 for no symbol."""
    if codes.shape[1] == 0:
        return np.zeros(len(codes), np.int64)
    acc, power = np.zeros(len(codes), np.uint64), 1
    for k in range(codes.shape[1]):
        acc += (codes[:, -1 - k].astype(np.uint64) + np.uint64(1)) * np.uint64(power)
        power = (power * _BASE + k) & _WRAP
    return _mixed(acc, codes.shape[1]).view(np.int64)


def _mixed(acc: np.ndarray, size: int) -> np.ndarray:
    mixed = (acc ^ (acc >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(size)
    return mixed ^ (mixed >> np.uint64(32))


def _estimate(order: int):
    def estimate(rows: pd.DataFrame) -> pd.DataFrame:
        return model_rows(rows.lang.iloc[0], kneser_ney(dict(zip(rows.gram, rows.n)), order))

    return estimate


def gram_hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """hashes[k - 1, i]: of the k symbols that end at i (whatever precedes)."""
    out = np.zeros((order, len(codes)), np.uint64)
    acc = np.zeros(len(codes), np.uint64)
    power = 1
    codes = codes.astype(np.uint64) + np.uint64(1)
    for k in range(order):
        acc[k:] += codes[:len(codes) - k] * np.uint64(power) if k else codes
        power = (power * _BASE + k) & _WRAP
        out[k] = _mixed(acc, k + 1)
    return out


class Model:
    """Sorted n-gram hashes with a row of values per language."""

    def __init__(self, rows: pa.Table, order: int):
        """``rows``: the columns of ``model_rows`` for all languages."""
        self.order = order
        lang = rows.column("lang").combine_chunks().dictionary_encode()
        names = lang.dictionary.to_pylist()
        self.languages = sorted(names)
        place = np.array([self.languages.index(x) for x in names])[lang.indices.to_numpy()]
        size, logp, backoff = (rows.column(c).to_numpy() for c in ("size", "logp", "backoff"))
        hashes, context, shorter = (rows.column(c).to_numpy().view(np.uint64) for c in ("hash", "context", "shorter"))
        none = size == 0
        self.unseen = np.zeros(len(self.languages), np.float32)
        self.unseen[place[none]] = logp[none]
        own = np.flatnonzero(~none)
        self.keys, first, row = np.unique(hashes[own], return_index=True, return_inverse=True)
        shape = (len(self.keys), len(self.languages))
        p, b = np.full(shape, np.nan, np.float32), np.zeros(shape, np.float32)
        p[row, place[own]], b[row, place[own]] = logp[own], backoff[own]
        self.logp, self.backoff = p, b
        first = own[first]
        for k in range(1, order + 1):  # a language without the gram backs off
            level = np.flatnonzero(size[first] == k)
            if not len(level):
                continue
            if k == 1:
                filled = np.broadcast_to(self.unseen, (len(level), len(self.languages)))
            else:
                at = self.find(context[first[level]])
                filled = np.where(at[:, None] >= 0, b[at], 0) + p[self.find(shorter[first[level]])]
            p[level] = np.where(np.isnan(p[level]), filled, p[level])

    def n_bytes(self) -> int:
        return self.keys.nbytes + self.logp.nbytes + self.backoff.nbytes

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(wanted), -1)
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, at, -1)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each word in each language, and its number of symbols."""
        runs = [letters(w) for w in words]
        text = "".join(START + r + END for own in runs for r in own)
        n = np.array([sum(len(r) + 1 for r in own) for own in runs], np.int64)
        bits = np.zeros((len(words), len(self.languages)), np.float64)
        if not text:
            return bits, n
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        begins = codes == ord(START)
        depth = np.arange(len(codes)) - np.maximum.accumulate(np.where(begins, np.arange(len(codes)), 0)) + 1
        hashes = gram_hashes(codes, self.order)
        place = np.flatnonzero(~begins)
        value = np.zeros((len(place), len(self.languages)), np.float32)
        pending = np.arange(len(place))
        for k in range(self.order, 0, -1):
            i = place[pending]
            deep = depth[i] >= k
            row = np.full(len(i), -1)
            row[deep] = self.find(hashes[k - 1, i[deep]])
            hit = row >= 0
            value[pending[hit]] += self.logp[row[hit]]
            if k > 1:  # what is left backs off from the context of k - 1 symbols
                miss = deep & ~hit
                context = self.find(hashes[k - 2, i[miss] - 1])
                value[pending[miss]] += np.where(context[:, None] >= 0, self.backoff[context], 0)
            pending = pending[~hit]
        value[pending] += self.unseen
        owner = np.repeat(np.arange(len(words)), n)
        for j in range(len(self.languages)):
            bits[:, j] = -np.bincount(owner, value[:, j], len(words))
        return bits, n


class _Words(dict):
    """Word -> its row in ``bits`` and ``n``; words are scored many at a time."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.bits, self.n = np.zeros((1024, len(model.languages))), np.zeros(1024, np.int64)

    def __missing__(self, word):
        row = self[word] = len(self)
        self.new.append(word)
        return row

    def score_new(self) -> None:
        if not self.new:
            return
        first = len(self) - len(self.new)
        while len(self) > len(self.n):
            self.bits, self.n = np.concatenate([self.bits, np.zeros_like(self.bits)]), np.concatenate([self.n, np.zeros_like(self.n)])
        self.bits[first:len(self)], self.n[first:len(self)] = self.model.words(self.new)
        self.new = []


def train(labelled: DataFrame, *, order: int = ORDER, model_bytes: int | None = None) -> Model | None:
    """Fit the models on all rows (lang, text) of ``labelled``; None without rows.
    The order is the one asked for, unless a caller sets ``model_bytes``: then it is
    the highest up to ``order`` whose tables surely fit."""
    words = (labelled.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
             .mapInArrow(common.frugal(_count_words), "lang string, word string, n bigint")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    grams = common.stored(words.mapInArrow(common.frugal(_grams(order)), "lang string, gram string, n bigint")
                          .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "char-grams")
    while True:
        size = grams.agg(F.count("*").alias("n"), F.countDistinct("lang").alias("langs")).first()
        if not size.n:
            return None
        # a gram stands for at most one new gram of each lower order
        if model_bytes is None or order == 1 or size.n * order * (8 + 8 * size.langs) <= model_bytes:
            break
        order -= 1
        grams = grams.groupBy("lang", F.expr(f"right(gram, {order})").alias("gram")).agg(F.sum("n").alias("n"))
    fitted = grams.groupBy("lang").applyInPandas(_estimate(order), "lang string, size int, hash bigint, context bigint, shorter bigint, "
                                                           "logp double, backoff double")
    return Model(fitted.toArrow(), order)  # as large as the models that are sent


def score(documents: DataFrame, model: Model | None, *, text_col: str = "text", limit: int = SENT_BYTES,
          evidence: int = EVIDENCE) -> DataFrame:
    """Every column of ``documents`` but the text, with ``lang_pred``, ``score``,
    ``bits`` (a symbol) and ``symbols``."""
    rest = [c for c in documents.columns if c != text_col]
    shared = None if model is None else common.broadcast_checked(
        documents.sparkSession, model, model.n_bytes(), limit, "language models")

    def rate(words: _Words, ids: np.ndarray) -> tuple[str, float, float | None, int]:
        total = int(words.n[ids].sum())
        if not total:
            return UNKNOWN, 0.0, None, 0
        h = words.bits[ids].sum(axis=0) / total
        best = int(h.argmin())
        odds = np.exp2(-(h - h[best]) * min(total, evidence))
        return words.model.languages[best], float(1 / odds.sum()), float(h[best]), total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value if shared else None
        words = _Words(model) if shared else None
        for batch in batches:
            rated, waiting = [], []
            for text in common.byte_texts(batch.column(text_col)):
                if words is None:
                    rated.append((UNKNOWN, 0.0, None, 0))
                    continue
                own = common.alnum_words(text)
                waiting.append(np.fromiter(map(words.__getitem__, own), np.int32, len(own)))
                if len(words.new) >= TOGETHER or len(waiting) >= TOGETHER:
                    words.score_new()
                    rated += [rate(words, ids) for ids in waiting]
                    waiting = []
                    if len(words) > HELD:
                        words = _Words(model)
            if waiting:
                words.score_new()
                rated += [rate(words, ids) for ids in waiting]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest),
                 *(pa.array(c, t) for c, t in zip(list(zip(*rated)) or [[]] * 4,
                                                  (pa.string(), pa.float64(), pa.float64(), pa.int64())))],
                [*rest, "lang_pred", "score", "bits", "symbols"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != text_col),
                        "lang_pred string, score double, bits double, symbols bigint"])
    return documents.mapInArrow(common.frugal(run), schema)


def identify(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             modulus: int = 3, held: int = 1, reject_z: float = REJECT_Z, **options) -> DataFrame:
    """Predict every text's language from models of the rows that are not held
    out: doc_id, held_out, lang_pred, score, bits, symbols, rejected."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                            F.col(text_col).alias("text"), common.fold(id_col, modulus).alias("fold"))
    model = train(rows.where(F.col("fold") != held), **options)
    seen = rows.select("doc_id", "text", common.row_key().alias("row_key"), F.coalesce(F.col("fold") == held, F.lit(False)).alias("held_out"),
                       F.when(F.col("fold") != held, F.col("lang")).alias("taught"))
    scored = common.stored(score(seen, model), "language-scores")
    usual = {r.lang_pred: r.top for r in scored.where("taught = lang_pred AND bits IS NOT NULL").groupBy("lang_pred")
             .agg((F.mean("bits") + F.lit(reject_z) * F.coalesce(F.stddev("bits"), F.lit(0.0))).alias("top"))
             .collect()}  # one row per language
    bound = F.lit(None).cast("double")
    for lang, top in sorted(usual.items()):
        bound = F.when(F.col("lang_pred") == lang, F.lit(top)).otherwise(bound)
    return scored.select("doc_id", "held_out", "lang_pred", "score", "bits", "symbols", "row_key",
                         ((F.col("lang_pred") == UNKNOWN) & F.col("bits").isNull()
                          | F.coalesce(F.col("bits") > bound, F.lit(False))).alias("rejected"))


def drop_rejected(documents: DataFrame) -> DataFrame:
    """The documents whose language is recognised; columns as they were."""
    return common.without(documents, identify(documents).where("rejected"))
