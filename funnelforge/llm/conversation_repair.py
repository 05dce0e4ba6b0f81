"""Conversation structure repair by depth-first branch-and-bound.

A conversation's rows are edited into the role pattern ``(s?(ua)+)?`` at least cost;
of equal costs the audit (the edits' initials in order) that is least in ASCII counts.
The search keeps an explicit stack of (row, role state, cost, audit so far); the least
cost of completing each (row, state) bounds it from below, complete solutions give the
incumbent (cost, audit), and a table per (row, state) drops a prefix that is no better
than one seen there.  An equally dear prefix is never the beginning of another (the
extra edits would be insertions, which cost), so comparing prefixes decides.

Scale: rows are damaged by built-in functions, identical ones become one row with a
count, and markers tell where a role and text come first in their conversation (an
aggregate; no join).  Rows and markers are dealt by ranges of (conversation, turn), so
a conversation with a third of all rows lies over many tasks.  A task reads its rows
in order.  A conversation that lies inside a task and has at most ``SEGMENT`` rows is
searched at once.  Others become segments: each is searched for every pair of role
states it can begin and end in.  A small fold over the segments' costs picks each
segment's states (of equal costs by the ranks of the audits), and a last pass reads
the segments in order, one at a time, to digest the repaired text.

Defined results: null role and text are one space; ``gaps`` ignores null turns; rows
of one turn are read by role, then by the md5 of their text; an empty role has no legal
place, like any other than s, u and a; repeated rows are duplicates; a null id is a
conversation of its own; conversations without rows after the damage give zeros, an
empty audit and the digest of nothing; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Rows and characters of a conversation that are searched together, about.
SEGMENT = 4_096
SEGMENT_CHARS = 4_000_000
WHITE = " \t\n\x0b\x0c\r"
INFINITE = 1 << 60

# Role states: nothing yet, after system, after user, after assistant (or complete).
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {("s", _START): _SYSTEM, ("u", _START): _USER, ("u", _SYSTEM): _USER, ("u", _ASSISTANT): _USER, ("a", _USER): _ASSISTANT}
#: The role that may come next in a state, and the state after it.
_NEXT = {q: (("assistant", _ASSISTANT) if q == _USER else ("user", _USER)) for q in range(4)}
#: Cost and edits that complete the pattern after the last row.
_CLOSE = {_START: (0, ""), _SYSTEM: (4, "II"), _USER: (2, "I"), _ASSISTANT: (0, "")}

RESULT_SCHEMA = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
                 "audit string, repaired_sha256 string")


@dataclass
class Row:
    """A row as the search sees it; ``extra`` further copies follow it."""
    initial: str
    fault: str       # "" or blank, duplicate, truncated
    extra: int = 0

    @property
    def gone(self) -> bool:
        return self.fault in ("blank", "duplicate")


def _edits(row: Row, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, edit, state after) that use up ``row``, in ASCII order."""
    copies = "D" * row.extra
    more = 3 * row.extra
    yield 3 + more, "D" + copies, state
    if not row.gone:
        kept = row.fault == "truncated"
        after = _AFTER.get((row.initial, state))
        if after is not None:
            yield kept + more, "K" + copies, after
        yield 2 + kept + more, "R" + copies, _NEXT[state][1]


def _bounds(rows: list[Row], last: list[int]) -> list[list[int]]:
    """Least cost of completing from each (row, state); ``last`` after all rows."""
    table = [last]
    for row in reversed(rows):
        here = [min(cost + table[-1][after] for cost, _, after in _edits(row, q)) for q in range(4)]
        for _ in range(2):  # insertions before the row
            here = [min(here[q], 2 + here[_NEXT[q][1]]) for q in range(4)]
        table.append(here)
    return table[::-1]


def search(rows: list[Row], start: int = _START, end: int | None = None) -> tuple[int, str] | None:
    """Least (cost, audit) of a way from state ``start`` through all rows: to a
    complete pattern, or with ``end`` to that state with nothing inserted after the
    last row.  None if there is none."""
    n = len(rows)
    bounds = _bounds(rows, [_CLOSE[q][0] if end is None else 0 if q == end else INFINITE for q in range(4)])
    best: tuple[int, str] | None = None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, q, cost, audit = stack.pop()
        if bounds[i][q] >= INFINITE:
            continue
        if best is not None and (cost + bounds[i][q], audit) > (best[0], best[1][:len(audit)]):
            continue
        if (i, q) in seen and seen[i, q] <= (cost, audit):
            continue
        seen[i, q] = (cost, audit)
        if i == n:
            close, edits = _CLOSE[q] if end is None else (0, "")
            found = (cost + close, audit + edits)
            best = found if best is None else min(best, found)
            continue
        ways = [(cost + c, audit + e, i + 1, after) for c, e, after in _edits(rows[i], q)]
        ways.append((cost + 2, audit + "I", i, _NEXT[q][1]))
        ways.sort(key=lambda w: (w[0] + bounds[w[2]][w[3]], w[1]), reverse=True)  # most promising on top
        stack.extend((j, after, c, a) for c, a, j, after in ways)
    return best


def apply_audit(rows: list[Row], texts: list[tuple[str, str]], audit: str, state: int = _START) -> tuple[list[str], int]:
    """``role:text`` lines that the edits leave, and the state after them."""
    out, i, left = [], 0, 0
    for edit in audit:
        if left:  # a further copy, deleted
            left -= 1
            continue
        role, after = _NEXT[state]
        if edit == "I":
            out.append(f"{role}:")
            state = after
            continue
        if edit == "K":
            out.append(":".join(texts[i]))
            state = _AFTER[rows[i].initial, state]
        elif edit == "R":
            out.append(f"{role}:{texts[i][1]}")
            state = after
        left = rows[i].extra
        i += 1
    return out, state


@dataclass
class Stretch:
    """Rows of one conversation in order, with what the counts need."""
    rows: list[Row] = field(default_factory=list)
    texts: list[tuple[str, str]] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict(blank=0, duplicate=0, truncated=0, illegal=0, turns=0))
    low: int | None = None
    high: int | None = None

    def add(self, turn: int | None, role: str, text: str, copies: int, first: bool) -> None:
        stripped = text.strip(WHITE)
        fault = "blank" if not stripped else "duplicate" if not first else "" if stripped[-1] in ".!?" else "truncated"
        row = Row(role[:1], fault, copies - 1)
        c = self.counts
        if fault:
            c[fault] += 1
        c["blank" if fault == "blank" else "duplicate"] += row.extra
        if self.rows:
            c["illegal"] += self.rows[-1].initial + row.initial not in LEGAL
        c["illegal"] += row.extra  # a copy follows its like
        if turn is not None and turn != self.high:
            c["turns"] += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows.append(row)
        self.texts.append((role, text))


LEGAL = {"su", "ua", "au"}


def _gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


_PARTS = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("gaps", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
    ("audit", pa.string()), ("repaired_sha256", pa.string()), ("first", pa.string()), ("last", pa.string()),
    ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("ways", pa.list_(pa.struct([("q", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("audit", pa.string())]))),
    ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.string()), ("extra", pa.int64())])))])
_PARTS_SCHEMA = (f"part int, seq int, whole boolean, {RESULT_SCHEMA}, first string, last string, low bigint, high bigint, "
                 "turns bigint, ways array<struct<q:int,after:int,cost:bigint,rank:int,audit:string>>, "
                 "rows array<struct<role:string,text:string,fault:string,extra:bigint>>")


def _whole(s: Stretch) -> dict:
    cost, audit = search(s.rows)
    lines, _ = apply_audit(s.rows, s.texts, audit)
    c = s.counts
    return {"whole": True, "gaps": _gaps(s.low, s.high, c["turns"]), **{k: c[k] for k in ("blank", "duplicate", "truncated", "illegal")},
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def _segment(s: Stretch) -> dict:
    ways = [(q, after, *found) for q in range(4) for after in range(4) if (found := search(s.rows, q, after))]
    ranks = {a: k for k, a in enumerate(sorted({w[3] for w in ways}))}
    return {"whole": False, **s.counts, "low": s.low, "high": s.high,
            "first": s.rows[0].initial if s.rows else None, "last": s.rows[-1].initial if s.rows else None,
            "ways": [dict(q=q, after=after, cost=cost, rank=ranks[a], audit=a) for q, after, cost, a in ways],
            "rows": [dict(role=t[0], text=t[1], fault=r.fault, extra=r.extra) for r, t in zip(s.rows, s.texts)]}


def _read_range(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A task's rows in order: finished conversations and segments."""
    schema = pa.schema([("conv_id", id_type), *_PARTS])
    part, seq = TaskContext.get().partitionId(), 0
    done: list[dict] = []
    now, current, size = None, None, 0
    begun_here = first = False  # first: a marker came just before this row

    def record(conv, found: dict) -> list[pa.RecordBatch]:
        """Finished conversations leave in groups, segments hold texts and leave at once."""
        nonlocal seq, done
        done.append({"conv_id": conv, "part": part, "seq": seq} | found)
        seq += 1
        if found["whole"] and len(done) < 1_000:
            return []
        out, done = [pa.RecordBatch.from_pylist(done, schema)], []
        return out

    for batch in batches:
        for conv, turn, role, text, copies, marker in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or conv != now:
                if current is not None:
                    yield from record(now, _whole(current) if begun_here else _segment(current))
                begun_here = current is not None  # a task's first may have begun in the one before
                now, current, size = conv, Stretch(), 0
            if not marker and copies:
                if len(current.rows) >= SEGMENT or size >= SEGMENT_CHARS:
                    yield from record(now, _segment(current))
                    begun_here, current, size = False, Stretch(), 0
                current.add(turn, role, text, copies, first)
                size += len(text)
            first = marker
    if current is not None:
        yield from record(now, _segment(current))  # may go on in the next task
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def damaged(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage; a dropped row keeps its
    conversation with no copies."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(as_text(id_col), F.lit(":"), as_text(turn_col)).cast("binary")) % 20
    dropped = F.col("code") == 0
    rows = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), as_text(role_col).alias("role"),
                                as_text(text_col).alias("text"), code.alias("code"))
    text = (F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return rows.select(
        "conv_id", F.when(~dropped, F.col("turn")).alias("turn"),
        F.when(dropped, "").when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(dropped, "").otherwise(text).alias("text"),
        F.when(dropped, 0).when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _fold(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Segments in order, conversation by conversation: the states each begins and
    ends in, and the conversation's counts on its last segment."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("q", pa.int32()), ("after", pa.int32()), ("final", pa.bool_()),
                        ("conv_id", id_type), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                        ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64())])

    def finish(conv, places, back, states, c, low, high) -> Iterator[pa.RecordBatch]:
        end = min(states, key=lambda q: (states[q][0] + _CLOSE[q][0], states[q][1]))
        chosen, q = [], end
        for came in reversed(back):
            chosen.append((came[q], q))
            q = came[q]
        last = len(places) - 1
        for at in range(0, len(places), 10_000):
            rows = []
            for k, ((part, seq), (q, after)) in enumerate(zip(places[at:at + 10_000], chosen[::-1][at:at + 10_000]), at):
                row = {"part": part, "seq": seq, "q": q, "after": after, "final": k == last}
                if k == last:
                    row |= {"conv_id": conv, "gaps": _gaps(low, high, c["turns"]), **{x: c[x] for x in ("blank", "duplicate", "truncated", "illegal")},
                            "cost": states[end][0] + _CLOSE[end][0]}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema)

    key = None
    for batch in batches:
        for r in batch.to_pylist():
            if key != (r["conv_id"],):
                if key is not None:
                    yield from finish(key[0], places, back, states, c, low, high)
                key, places, back, states = (r["conv_id"],), [], [], {_START: (0, 0)}
                c, low, high, last = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0), None, None, None
            for k in c:
                c[k] += r[k]
            c["turns"] -= high is not None and high == r["low"]
            if r["first"] is not None:  # null: a segment without rows
                c["illegal"] += last is not None and last + r["first"] not in LEGAL
                last = r["last"]
            low, high = (r["low"] if low is None else low), (high if r["high"] is None else r["high"])
            best: dict[int, tuple] = {}
            for w in r["ways"]:
                if w["q"] in states:
                    cost, rank = states[w["q"]]
                    found = (cost + w["cost"], (rank, w["rank"]), w["q"])
                    if w["after"] not in best or found < best[w["after"]]:
                        best[w["after"]] = found
            order = {rank: k for k, rank in enumerate(sorted({b[1] for b in best.values()}))}
            states = {q: (b[0], order[b[1]]) for q, b in best.items()}
            back.append({q: b[2] for q, b in best.items()})
            places.append((r["part"], r["seq"]))
    if key is not None:
        yield from finish(key[0], places, back, states, c, low, high)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chosen segments in order: audit and digest of each conversation's repaired text."""
    audits, sha, any_line = [], hashlib.sha256(), False
    for batch in batches:
        for i in range(len(batch)):
            r = batch.slice(i, 1).to_pylist()[0]
            rows = [Row(x["role"][:1], x["fault"], x["extra"]) for x in r["rows"]]
            lines, _ = apply_audit(rows, [(x["role"], x["text"]) for x in r["rows"]], r["audit"], r["q"])
            edits = r["audit"]
            if r["final"]:
                close = _CLOSE[r["after"]][1]
                lines += [f"{role}:" for role in ("user", "assistant")[-len(close):]] if close else []
                edits += close
            audits.append(edits)
            for line in lines:
                sha.update((("\n" if any_line else "") + line).encode())
                any_line = True
            if r["final"]:
                yield pa.RecordBatch.from_pydict({"part": pa.array([r["part"]], pa.int32()), "seq": pa.array([r["seq"]], pa.int32()),
                                                  "audit": ["".join(audits)], "repaired_sha256": [sha.hexdigest()]})
                audits, sha, any_line = [], hashlib.sha256(), False


def repair(conversations: DataFrame, **columns: str) -> DataFrame:
    """One row per conversation: what was wrong, the cheapest edits and the digest of
    what they give (``conv_id`` and the columns of ``RESULT_SCHEMA``)."""
    return repair_rows(damaged(conversations, **columns))


def repair_rows(rows: DataFrame) -> DataFrame:
    """``repair`` for rows (conv_id, turn, role, text, copies) as they are."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_field = rows.schema["conv_id"]
    id_type, id_sql = to_arrow_type(id_field.dataType), f"conv_id {id_field.dataType.simpleString()}"
    kept = common.stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
                         .withColumn("digest", F.md5("text")), "conversation-rows")
    # where a role and text come first: a marker that is read just before that row
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    markers = (kept.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"))
               .select("conv_id", F.col("first.turn").alias("turn"), "role", F.lit(None).cast("string").alias("text"),
                       F.lit(0).cast("long").alias("copies"), "digest", F.lit(True).alias("marker")))
    dealt = (kept.withColumn("marker", F.lit(False)).unionByName(markers)
             .repartitionByRange("conv_id", "turn", "role", "digest")
             .sortWithinPartitions("conv_id", "turn", "role", "digest", F.col("marker").desc())
             .select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), "copies", "marker"))
    parts = common.stored(dealt.mapInArrow(lambda b: _read_range(b, id_type), f"{id_sql}, {_PARTS_SCHEMA}"), "conversation-parts")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    segments = parts.where(~F.col("whole"))
    light = (segments.select("conv_id", "part", "seq", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last",
                             F.transform("ways", lambda w: F.struct(w["q"].alias("q"), w["after"].alias("after"), w["cost"].alias("cost"),
                                                                    w["rank"].alias("rank"))).alias("ways"))
             .repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"))
    fold_schema = f"part int, seq int, q int, after int, final boolean, {id_sql}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    chosen = common.stored(light.mapInArrow(lambda b: _fold(b, id_type), fold_schema), "conversation-states")
    way = F.filter("ways", lambda w: (w["q"] == F.col("q")) & (w["after"] == F.col("after")))[0]
    told = (segments.join(chosen.select("part", "seq", "q", "after", "final"), ["part", "seq"])
            .select("conv_id", "part", "seq", "q", "after", "final", way["audit"].alias("audit"), "rows")
            .repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"))
    digests = told.drop("conv_id").mapInArrow(_digest, "part int, seq int, audit string, repaired_sha256 string")
    long_ones = chosen.where("final").join(digests, ["part", "seq"]).select(*names)
    return parts.where("whole").select(*names).unionByName(long_ones)
