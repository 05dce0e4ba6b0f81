"""Conversation repair against every possible edit of small conversations."""

import hashlib
import os
import random
import re
import sys
import zlib

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_oracles import rows_key  # noqa: E402

from funnelforge.llm import conversation_repair as repair  # noqa: E402
from funnelforge.llm import queries  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, cost long, audit string, part int, marker string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else text.translate({ord(c): None for c in ".!?"}) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def plain(rows):
    """One conversation's rows after the damage: by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = re.sub(r"[ \t\n\x0b\x0c\r]+\Z", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def exhaustive():
        """Shortest-path relaxation: (row, state) -> best completion, to a fixpoint."""
        table = {(i, q): (10**9, "", ()) for i in range(len(rows) + 1) for q in ("", "s", "u", "a")}
        changed = True
        while changed:
            changed = False
            for i in range(len(rows), -1, -1):
                for q in ("", "s", "u", "a"):
                    role = "assistant" if q == "u" else "user"
                    ways = [(0, "", ())] if i == len(rows) and q in ("", "a") else []
                    c, a, t = table[i, role[0]]
                    ways.append((c + 2, "I" + a, (f"{role}:", *t)))
                    if i < len(rows):
                        _, _, own, text = rows[i]
                        c, a, t = table[i + 1, q]
                        ways.append((c + 3, "D" + a, t))
                        if faults[i] not in ("blank", "duplicate"):
                            more = faults[i] == "truncated"
                            if (own[:1], q) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")}:
                                c, a, t = table[i + 1, own[0]]
                                ways.append((c + more, "K" + a, (f"{own}:{text}", *t)))
                            c, a, t = table[i + 1, role[0]]
                            ways.append((c + 2 + more, "R" + a, (f"{role}:{text}", *t)))
                    found = min(ways, key=lambda w: w[:2])
                    if found[:2] < table[i, q][:2] or (found[0] < 10**9 and table[i, q][0] >= 10**9):
                        table[i, q], changed = found, True
        return table[0, ""]

    cost, audit, lines = exhaustive()
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    kept = damage(rows)
    return {c: plain([r for r in kept if r[0] == c]) for c in {r[0] for r in rows}}


def found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def some_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "open end", " ", "", None, "Tail. \n", "…", "x.\t", "Yes."]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(0, longest)):
            turn = rng.choice([t, t, t, t, t + 1, None])
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         f"{rng.choice(texts)}" if rng.random() < 0.5 else f"{t} {rng.choice(['a.', 'b'])}"))
    return rows


def framed(frame, rows, parts=3):
    return frame([(*r, 1, "x", 2, None) for r in rows], SCHEMA, parts)


def test_search_equals_all_edits():
    rng = random.Random(7)
    for _ in range(1500):
        rows = [(1, i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", f"{i}.", f"{i}"])) for i in range(rng.randint(0, 7))]
        stretch, seen = repair.Stretch(), set()
        for _, turn, role, text in rows:
            stretch.add(turn, role, text, 1, (role, text) not in seen)
            seen.add((role, text))
        cost, audit = repair.search(stretch.rows)
        assert (cost, audit) == plain(rows)[5:7], rows
        lines, _ = repair.apply_audit(stretch.rows, stretch.texts, audit)
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))


def test_long_search_stays_small():
    """Thousands of rows, each with a choice: the search visits a few nodes a row."""
    rows = [repair.Row("sua"[i % 3], "truncated" if i % 5 == 0 else "") for i in range(6000)]
    cost, audit = repair.search(rows)
    assert len(audit) >= 6000 and cost > 0


def test_equals_plain_version(frame):
    rows = some_rows(1, 120, 9) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    assert found(repair.repair(framed(frame, rows))) == expected(rows)


@pytest.mark.parametrize("segment", [1, 2, 5])
def test_conversations_over_segments_and_tasks(frame, spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = some_rows(2, 12, 6) + [(50, t, "user" if t % 3 else "assistant", f"{t}." if t % 7 else "again") for t in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(repair.repair(framed(frame, rows))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_turn_repeated_rows_and_long_text(frame):
    same = [(1, 5, "user", "Hello there.")] * 40 + [(1, 6, "assistant", "Hi " + "very " * 50_000 + "long.")] * 2
    rows = same + [(2, None, None, None), (3, 1, "user", ""), (4, None, "user", "Q?"), (4, None, "assistant", "A.")]
    assert found(repair.repair(framed(frame, rows))) == expected(rows)


def test_empty_table(frame):
    assert repair.repair(framed(frame, [])).collect() == []


def test_everything_dropped(frame):
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    got = found(repair.repair(framed(frame, [(9, gone, "user", "Hi.")])))
    assert got == {9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_sql_of_the_query_with_odd_rows(frame):
    rows = some_rows(3, 60, 7)
    df = framed(frame, rows)
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"turn": "Int64"}))
    want = con.sql(queries.oracle_sql()["op13_conversation_repair"])
    got = repair.repair(df)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_key(got.columns, [tuple(r) for r in got.collect()]) == rows_key(want.columns, want.fetchall())
