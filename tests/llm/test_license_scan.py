import random
import re
import textwrap

from funnelforge.llm import common
from funnelforge.llm import license_scan as ls

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    w = words(text)
    places = [(i, label) for phrase, label in ls.PHRASES for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def test_base_places_equal_brute_force(frame):
    rnd = random.Random(8)
    vocabulary = ["MIT", "mit", "License", "license", "Apache", "general", "public", "é", "x1"]
    docs = [(i, rnd.choice([" ", ", ", "\n", "--"]).join(rnd.choices(vocabulary, k=rnd.randrange(80)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "mit license mit license"), (102, "mit license mit license"),
             (103, "word " * 30_000 + "General Public\x00License"), (None, "submit license")]
    got = ls.scan(frame([(*d, "labels") for d in docs], "doc_id bigint, text string, labels string")).collect()
    key = lambda x: tuple(map(repr, x))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == \
        sorted(((d, *brute(t)) for d, t in docs), key=key)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)
    assert ls.scan(frame([], "doc_id bigint, text string")).collect() == []


def test_join_equals_all_pairs():
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = [(f"t{i}", " ".join(rnd.sample(vocabulary, rnd.randrange(1, 12)))) for i in range(25)]
    frequency = {w.encode(): rnd.randrange(100) for w in vocabulary}
    for containment in (0.5, 0.8, 0.85, 1.0):
        index = ls.TemplateIndex(templates, frequency, containment)
        for _ in range(150):
            block = [w.encode() for w in rnd.choices(vocabulary + ["other"], k=rnd.randrange(1, 40))]
            want = set()
            for t, (_, text) in enumerate(templates):
                own = set(text.encode().split())
                if len(own & set(block)) / len(own) >= containment - 1e-12:
                    want.add(t)
            assert {t for t, _ in index.join(block)} == want


def test_labels_of_statements(frame):
    long = "word " * 500 + "licensed under CC BY-NC 4.0 and so on " + "word " * 500
    docs = [(1, "A.\nLicensed under CC BY-NC 4.0."), (2, "Licensed under CC BY 4.0.\nb"), (3, long),
            (4, "This work is licensed under the GNU General Public License, version 3."), (5, "all is well")]
    got = {r.doc_id: r.labels for r in ls.scan(frame(docs, "doc_id bigint, text string")).collect()}
    assert got == {1: "cc-by-nc", 2: "cc-by", 3: "cc-by-nc", 4: "gpl", 5: ""}


def test_every_passage_lies_in_a_block():
    text = b" ".join(b"w%d" % i for i in range(500))
    held = [(at, len(b)) for _, at, b in ls.blocks(text, 32)]
    assert all(any(a <= s and s + 32 <= a + n for a, n in held) for s in range(500 - 32 + 1))
    assert common.alnum_words(b"A-z\xc3\x89") == [b"a", b"z\xc3\x89"]


def test_wrapped_statements(frame):
    templates = [(label, text) for label, text in ls.TEMPLATES if len(text) > 80]
    docs = [(i, "intro\n\n" + "\n".join(" * " + x for x in textwrap.wrap(text, 40)) + "\n" + "word " * 100 + "\nend")
            for i, (_, text) in enumerate(templates)]
    far = "word " * 90 + "\nLicensed\nunder CC BY-NC\n\n4.0.\n" + "word " * 90
    docs += [(100, far), (101, "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0."), (102, "all is well\nrights or not")]
    got = {r.doc_id: r for r in ls.scan(frame(docs, "doc_id bigint, text string")).collect()}
    assert all(label in got[i].labels.split(",") for i, (label, _) in enumerate(templates))
    assert got[100].labels == "cc-by-nc" and got[101].labels == "cc-by,cc-by-nc" and got[102].labels == ""
    assert {(m.line, m.word) for m in got[0].matches} == {(0, 0)}
    assert {(m.line, m.word) for m in got[100].matches} == {(0, 32), (0, 64)}
    assert sorted((m.label, m.line) for m in got[101].matches) == [(x, n) for x in ("cc-by", "cc-by-nc", "cc-by-sa") for n in (0, 1)]
