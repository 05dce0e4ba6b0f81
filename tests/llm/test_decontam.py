import hashlib
import random
import re

from funnelforge.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, body in items:
            v = words(body)
            n = min(10, len(v))
            for q in range(len(v) - n + 1) if v else ():
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[q:q + n]:
                        hit |= set(range(p, p + n))
                        found.add(str(item_id))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def test_equals_brute_force(frame):
    rnd = random.Random(4)
    base = ["of", "the", "Ünter", "a1", "zz", "K9"]
    items = [(i, " ".join(rnd.choices(base, k=n))) for i, n in enumerate([3, 10, 14, 30, 0, 1])]
    items += [(9, None), (10, items[3][1]), (11, "Lone-word's, test ... of phrase " * 3)]
    docs = [(i, ", ".join(rnd.choices(base, k=rnd.randrange(60)))) for i in range(30)]
    docs += [(40, "x " + items[3][1].upper() + "\x00y"), (41, None), (42, ""), (43, items[2][1]), (43, items[2][1]),
             (44, "a1 " * 5000 + items[8][1]), (None, "zz zz")]
    got = decontam.find_contamination(
        frame([(a, b, "extra") for a, b in docs], "doc_id bigint, text string, item string"),
        frame(items, "item_id bigint, text string")).drop("n_near_items", "near_items").collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items)
    blocks = decontam.find_contamination(frame(docs, "doc_id bigint, text string"),
                                         frame(items, "item_id bigint, text string"), block_bytes=150)
    assert sorted(map(tuple, blocks.drop("n_near_items", "near_items").collect()), key=repr) == brute(docs, items)


def test_empty_tables_and_proximity(frame):
    docs = frame([(1, "one two three four five six seven eight nine ten eleven"),
                  (2, "one two three four x five six seven eight nine ten")], "doc_id bigint, text string")
    none = frame([], "item_id bigint, text string")
    assert {r.n_hit for r in decontam.find_contamination(docs, none).collect()} == {0}
    item = frame([(5, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    assert decontam.find_contamination(frame([], "doc_id bigint, text string"), item).collect() == []
    got = {r.doc_id: (r.n_hit, r.n_near_items, r.near_items) for r in decontam.find_contamination(docs, item).collect()}
    assert got == {1: (10, 1, ["5"]), 2: (0, 1, ["5"])}
    assert [r.doc_id for r in decontam.drop_contaminated(docs, item).collect()] == [2]


def test_long_and_repeated_items_over_many_blocks(frame, monkeypatch):
    monkeypatch.setattr(decontam, "PIECE_WORDS", 25)
    rnd = random.Random(6)
    body = [f"w{rnd.randrange(400)}" for _ in range(300)]
    items = [(1, " ".join(body))] * 5 + [(1, "another text of one and the same item id here"), (2, " ".join(body[100:111]))]
    docs = [(i, " ".join(body[i * 7:i * 7 + 5 + i])) for i in range(40)] + [(7, " ".join(body))] * 2
    got = decontam.find_contamination(frame(docs, "doc_id bigint, text string"), frame(items, "item_id bigint, text string"), block_bytes=300)
    assert sorted(map(tuple, got.drop("n_near_items", "near_items").collect()), key=repr) == brute(docs, items)
