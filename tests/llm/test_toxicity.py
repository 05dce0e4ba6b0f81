import random

import numpy as np

from funnelforge.llm import toxicity as tox


def brute_segments(scores):
    """Recursive definition: the best segment, then left and right of it."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-9 or (abs(total - best) <= 1e-9 and at and j - i < at[1] - at[0] - 1):
                best, at = total, (i, j + 1)
    if at is None:
        return []
    left, right = brute_segments(scores[:at[0]]), brute_segments(scores[at[1]:])
    return left + [(*at, best)] + [(a + at[1], b + at[1], s) for a, b, s in right]


def test_segments_equal_recursive_definition():
    rnd = random.Random(3)
    for n in (0, 1, 2, 7, 20, 35):
        for _ in range(60):
            scores = np.array([rnd.choice([-3.17, -1.3, -0.41, 0.73, 1.09, 2.23]) + rnd.random() / 1000 for _ in range(n)])
            got, want = tox.segments(scores), brute_segments(list(scores))
            assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
            assert np.allclose([s for *_, s in got], [s for *_, s in want])
    long = np.tile([1.0, -0.5, 1.0, -9.0], 50_000)
    assert len(tox.segments(long)) == 50_000


def test_isotonic_curve_rises():
    x, y = tox.isotonic(np.arange(6.0), np.full(6, 10.0), np.array([0, 3, 1, 5, 4, 10.0]))
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()


def corpus(n=600):
    rnd = random.Random(5)
    plain = ["table", "window", "river", "stone", "garden", "music", "letter", "people", "thing", "under"]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        words = rnd.choices(plain, k=40)
        if bad:
            words[10:10] = rnd.choices(["vilezor", "vilezan", "vilezit", "nastoq"], k=3)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_edges(frame):
    rows, labels = corpus()
    rows += [(9000, None), (9001, ""), (9002, "..."), (9003, "window vilezor " * 3 + "stone " * 20_000), (None, "nastoq vilezor"),
             (9004, "table vilezummm window nastoq river"), (3, rows[3][1])]
    labels += [(9000, 1, 1), (3, None, None), (3, 1, 0), (3, 1, 0), (77777, 0, 1)]
    docs = frame([(a, b, 0.1, "x") for a, b in rows], "doc_id bigint, text string, score double, toxic string")
    got = tox.score_toxicity(docs, frame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].predicted == int(i % 6 == 0) for i in range(600))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert by_id[9004].predicted == 1  # an unseen word with a known beginning
    assert by_id[9000].passages == [] and by_id[9001].score == by_id[9002].score <= min(r.score for r in got)
    place = rows[12][1].split().index(next(w for w in rows[12][1].split() if w.startswith(("vilez", "nastoq"))))
    assert any(p.start <= place < p.end for p in by_id[12].passages)


def test_without_labels(frame):
    docs = frame([(1, "some text"), (2, None)], "doc_id bigint, text string")
    none = frame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in tox.score_toxicity(docs, none).collect()} == {0.0}
    assert tox.score_toxicity(frame([], "doc_id bigint, text string"), none).collect() == []
