"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside tasks.

A task cuts its texts into words (the matches of the vocabulary's pattern), takes
the distinct ones it has not met yet and encodes them with one recursive query.
The query's state has a row per word and token: where its bytes start and end, the
token after it and the rank of the pair the two make.  A step contracts each
word's leftmost pair of least rank: the pair's left row goes, its right row takes
the merged token, the row before it gets a new neighbour, and the changed rows
join the merge table again; words without a pair leave the recursion.

Words of more than ``SHORT`` bytes go through a second recursive query that
contracts, per step, every place of the least rank from left to right.  In a
vocabulary whose tokens all encode to themselves by merges of rising rank (the
tests check this one) a merge never makes a pair of a lower rank, so the places of
one rank follow each other anyway and both queries agree; the second takes as many
steps as there are ranks in a word, not as there are bytes.  It stops every
``STEPS`` steps and goes on from its last state, so what it holds is bounded.

Decoding joins (text, position, id) rows to the vocabulary, sorts by position and
aggregates the tokens' bytes in that order.

Which code points are letters, digits or white space differs between releases of
Unicode, so the letters and digits are asked from the tiktoken library once, on the
driver, and sent along as ranges.

Nothing is shuffled: texts are encoded where they are read, a text with a third of
all bytes is one row like any other, and the words remembered by a task are
bounded (beyond that it keeps those in use; forgotten words are encoded again).

Defined results: null and empty texts have no ids and decode to nothing; special
tokens' names in a text are ordinary text; repeated rows are encoded as often as
they occur; an empty table gives an empty result; null ids are kept; other columns
are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RANKS = "byte_bpe_50k.tiktoken"
#: Before a space that no white space follows a word always starts, and white space
#: at the end of a stretch has white space or nothing behind it: the words of the
#: stretches are the words of the text.
STRETCH = r"(?= \S)"
#: Words up to this many bytes contract one pair a step.
SHORT = 64
#: Steps of the query for longer words until it starts anew from where it is.
STEPS = 16
#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 3_000_000
#: Words and stretches that a task remembers; beyond that all but those of the texts at
#: hand are forgotten.
REMEMBERED = 400_000
ENCODED_SCHEMA = "doc_id bigint, n_tokens bigint, ids binary"
DECODED_SCHEMA = "doc_id bigint, decoded binary"

_ONE_PAIR = """
WITH RECURSIVE state AS (
  SELECT word, s, e, token, next, (m.id::BIGINT << 40) | (s << 20) | e AS place, false AS done
  FROM start LEFT JOIN merges m ON m.pair = (token::BIGINT << 32) | next
  UNION ALL
  (WITH least AS (SELECT word, min(place) AS p FROM state WHERE NOT done GROUP BY word),
        pairs AS (SELECT word, p, (p >> 40)::INT AS merged, (p >> 20) & 1048575 AS ps, p & 1048575 AS pe FROM least),
        moved AS (SELECT word, CASE WHEN s = pe THEN ps ELSE s END AS s, e,
                         CASE WHEN s = pe THEN merged ELSE token END AS token,
                         CASE WHEN e = ps THEN merged ELSE next END AS next,
                         place, p IS NULL AS done, s = pe OR e = ps AS changed
                  FROM state JOIN pairs USING (word) WHERE NOT state.done AND (p IS NULL OR s <> ps))
   SELECT word, s, e, token, next, CASE WHEN changed THEN (m.id::BIGINT << 40) | (s << 20) | e ELSE place END, done
   FROM moved LEFT JOIN merges m ON m.pair = CASE WHEN changed THEN (token::BIGINT << 32) | next END))
SELECT word, token FROM state WHERE done ORDER BY word, s"""

_ALL_PLACES = f"""
WITH RECURSIVE state AS (
  SELECT word, pos, token, false AS done, 0 AS step FROM start
  UNION ALL
  SELECT word, pos, CASE WHEN taken THEN best ELSE token END, best IS NULL, step + 1 FROM (
    SELECT *, lag(taken, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone FROM (
      SELECT *, hit AND (pos - min(CASE WHEN hit THEN pos END) OVER (PARTITION BY word, run)) % 2 = 0 AS taken FROM (
        SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY word ORDER BY pos) AS run FROM (
          SELECT *, coalesce(id = best, false) AS hit FROM (
            SELECT p.*, m.id, min(m.id) OVER (PARTITION BY word) AS best FROM (
              SELECT word, row_number() OVER w AS pos, token, step, lead(token) OVER w AS next
              FROM state WHERE NOT done AND step < {STEPS} WINDOW w AS (PARTITION BY word ORDER BY pos)) p
            LEFT JOIN merges m ON m.pair = (p.token::BIGINT << 32) | p.next)))))
  WHERE NOT gone)
SELECT word, pos, token, done FROM state WHERE done OR step = {STEPS} ORDER BY word, pos"""

#: One thread aggregates the rows in the order they come in.  A token's bytes are kept
#: as the characters of the same numbers.
_DECODE = """
SELECT text, string_agg(chars, '') AS bytes
FROM (SELECT text, chars FROM tokens JOIN vocabulary USING (id) ORDER BY pos) GROUP BY text"""


def _ranges(points: list[int]) -> str:
    """Ascending code points as the inside of a character set."""
    cuts = [i for i in range(1, len(points)) if points[i] != points[i - 1] + 1]
    stretches = zip([0, *cuts], [*cuts, len(points)])
    return "".join(f"\\U{points[a]:08x}-\\U{points[b - 1]:08x}" for a, b in stretches)


_EVERY = [*range(0xD800), *range(0xE000, 0x110000)]


def _class_of_library(property_: str) -> list[int]:
    """The code points that tiktoken's own patterns take for ``property_``."""
    import tiktoken

    probe = tiktoken.Encoding("probe", pat_str=property_, mergeable_ranks={bytes([b]): b for b in range(256)},
                              special_tokens={})
    return [ord(c) for c in bytes(probe.encode_ordinary("".join(map(chr, _EVERY)))).decode()]


@dataclass(frozen=True)
class Patterns:
    """The vocabularies' pattern as the ``regex`` library reads it, the same with the
    letters and digits of the tiktoken library, and the code points on which the two
    libraries, or Python's own ``str.isalpha``, differ (inside of a set)."""

    plain: str
    exact: str
    differing: str


def word_patterns(pattern: str | None = None) -> Patterns:
    import public_tokenizers
    import regex

    pattern = pattern or public_tokenizers.PATTERN
    letters, digits = _class_of_library(r"\p{L}"), _class_of_library(r"\p{N}")
    every = "".join(map(chr, _EVERY))
    differing = set(letters).symmetric_difference(map(ord, regex.findall(r"\p{L}", every)))
    differing |= set(letters).symmetric_difference(c for c in _EVERY if chr(c).isalpha())
    differing |= set(digits).symmetric_difference(map(ord, regex.findall(r"\p{N}", every)))
    l, n = _ranges(letters), _ranges(digits)
    exact = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{l}{n}]").replace(r"\p{L}", f"[{l}]").replace(r"\p{N}", f"[{n}]")
    return Patterns(pattern, exact, _ranges(sorted(differing)))


class Codec:
    """The vocabulary in a DuckDB database of one task."""

    def __init__(self, patterns: Patterns | None = None, ranks: str | None = None):
        import duckdb
        import public_tokenizers
        import regex

        with open(ranks or public_tokenizers.path(RANKS), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.cut = re.compile(STRETCH).split
        if patterns is not None:
            self.plain, self.exact = regex.compile(patterns.plain).findall, regex.compile(patterns.exact).findall
            self.differs = re.compile(f"[{patterns.differing}]").search if patterns.differing else lambda text: None
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t))
                  if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, merged = np.array(merges, np.int64).reshape(-1, 3).T
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._table("merges", {"pair": (left << 32) | right, "id": merged.astype(np.int32)})
        self._table("vocabulary", {"id": pa.array(list(self.ranks.values()), pa.int64()),
                                   "chars": [t.decode("latin-1") for t in self.ranks]})
        self.known: dict[str, bytes] = {}  # ids of words, and of stretches of several words

    def _table(self, name: str, columns: dict) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _run(self, sql: str, name: str, columns: dict) -> list[np.ndarray]:
        self.con.register(name, pa.table(columns))
        out = self.con.sql(sql).to_arrow_table()
        self.con.unregister(name)
        return [c.to_numpy() for c in out.columns]

    def _learn(self, words: Iterable[str]) -> None:
        """Encode new words; tokens encode as themselves."""
        rest: dict[bool, list[str]] = {True: [], False: []}
        datas: dict[bool, list[bytes]] = {True: [], False: []}
        for word in words:
            data = word.encode()
            if data in self.ranks:
                self.known[word] = self.ranks[data].to_bytes(4, "little")
            else:
                short = len(data) <= SHORT
                rest[short].append(word)
                datas[short].append(data)
        for short, encode in ((True, self._short), (False, self._long)):
            if rest[short]:
                word, token = encode(datas[short])
                ids = token.astype("<u4").tobytes()
                ends = (4 * np.searchsorted(word, np.arange(len(rest[short])), "right")).tolist()
                self.known.update(zip(rest[short], map(ids.__getitem__, map(slice, [0, *ends], ends))))

    def _start(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        pos = np.arange(len(token)) - np.repeat(ends - lengths, lengths)
        return np.repeat(np.arange(len(words), dtype=np.int32), lengths), pos, token, ends

    def _short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        word, pos, token, ends = self._start(words)
        following = np.append(token[1:], -1).astype(np.int32)
        following[ends - 1] = -1
        return tuple(self._run(_ONE_PAIR, "start", {"word": word, "s": pos, "e": pos + 1, "token": token,
                                                    "next": following}))

    def _long(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k, data in enumerate(words):  # one at a time: each may be as long as a text
            word, pos, token, _ = self._start([data])
            while True:
                word, pos, token, done = self._run(_ALL_PLACES, "start", {"word": word, "pos": pos, "token": token})
                if done.all():
                    break
            found.append((np.full(len(token), k), token))
        return np.concatenate([w for w, _ in found]), np.concatenate([t for _, t in found])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self.cut(t) for t in texts]
        asked = set().union(*cut)
        if len(self.known) > REMEMBERED:  # frequent ones are among those asked for now
            self.known = {s: self.known[s] for s in asked.intersection(self.known)}
        new = asked.difference(self.known)
        if self.differs("".join(new)):
            several = {s: self.exact(s) for s in new}
        else:  # letters alone, after a space or not, are one word
            several = {s: self.plain(s) for s in new if not (s.isalpha() or s[:1] == " " and s[1:].isalpha())}
        words = new.difference(several).union(*several.values()).difference(self.known)
        self._learn(words)
        known = self.known
        for s, parts in several.items():
            if len(parts) != 1:
                known[s] = b"".join([known[w] for w in parts])
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each text's ids stand for."""
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        self.con.register("tokens", pa.table({"text": np.repeat(np.arange(len(ids)), lengths),
                                              "pos": np.arange(len(flat)), "id": flat}))
        found = dict(self.con.sql(_DECODE).fetchall()) if len(flat) else {}
        self.con.unregister("tokens")
        return [found.get(k, "").encode("latin-1") for k in range(len(ids))]


def _groups(batch: pa.RecordBatch, value) -> Iterator[tuple[list, list]]:
    """(ids, values) of a batch, in groups of about ``GROUP_CHARS``."""
    ids, values, size = [], [], 0
    for doc_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
        x = x.as_py() or value
        ids.append(doc_id)
        values.append(x)
        size += len(x)
        if size >= GROUP_CHARS:
            yield ids, values
            ids, values, size = [], [], 0
    if ids:
        yield ids, values


def _texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _encoded(documents: DataFrame, id_col: str, text_col: str, ranks: str | None, decoded: bool) -> DataFrame:
    patterns = word_patterns()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(patterns, ranks)
        for batch in batches:
            for doc_ids, texts in _groups(batch, ""):
                ids = codec.encode(texts)
                columns = {"doc_id": pa.array(doc_ids, pa.int64()),
                           "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                           "ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array(codec.decode(ids), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return _texts(documents, id_col, text_col).mapInArrow(common.frugal(run), ENCODED_SCHEMA + (", decoded binary" if decoded else ""))


def encode(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids) of every text; ids are little-endian unsigned 32-bit."""
    return _encoded(documents, id_col, text_col, ranks, decoded=False)


def round_trip(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """``encode`` and, from the ids, the ``decoded`` bytes, in one pass."""
    return _encoded(documents, id_col, text_col, ranks, decoded=True)


def decode(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", ranks: str | None = None) -> DataFrame:
    """(doc_id, decoded) of ids as ``encode`` writes them (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(None, ranks)
        for batch in batches:
            for doc_ids, ids in _groups(batch, b""):
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()),
                                                  "decoded": pa.array(codec.decode(ids), pa.binary())})

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(common.frugal(run), DECODED_SCHEMA)
