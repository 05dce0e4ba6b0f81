"""Whitening against a plain numpy version."""

import math

import numpy as np
import pytest

from funnelforge.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, copies int, key string"


def plain(rows, components=16, weights="one"):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} and the axes' order."""
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v)) for i, v in rows
          if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in xs}) if weights == "one" else sorted(x for _, x in xs)
    if not fit:
        return {}
    n, s = len(fit), [sum(col) for col in zip(*fit)]
    offsets = {x: [n * a - b for a, b in zip(x, s)] for x in set(fit)}
    d = np.array([offsets[x] for x in fit]) / n
    v = d.T @ d / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1], p[:, ::-1]
    out = {}
    for i, x in xs:
        for k in range(min(components, len(e))):
            if e[k] > e[0] * len(e) * 2.3e-16 and e[0] > 0:
                out[i, k + 1] = (n, sum(o * o for o in offsets[x]), abs(np.array(offsets[x]) / n @ p[:, k] / math.sqrt(e[k])),
                                 e[k] / np.trace(v))
    return out


def check(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want)
    for r in got:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(white, rel=1e-7, abs=1e-8)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error <= 1e-4


def vectors(seed, n, d, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=d) * np.arange(1, d + 1)).tolist()) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(copies)]


def rows_of(rows):
    return [(i, v, 1, "x", 2, None) for i, v in rows]


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_equals_plain_version_with_copies_and_odd_rows(frame, weights, monkeypatch):
    monkeypatch.setattr(whitening, "HOT_COPIES", 10)  # the copied vector is broadcast
    rows = vectors(1, 80, 20, copies=60) + [(900, None), (901, []), (902, [1.0] * 19 + [None]), (903, [math.nan] + [0.0] * 19),
                                            (904, [math.inf] + [0.0] * 19), (905, [-math.inf] * 20), (906, [1.0, 2.0])]
    got = whitening.whiten(frame(rows_of(rows), SCHEMA), weights=weights).collect()
    check(got, plain([r for r in rows if r[0] < 900], weights=weights))
    signs = {r.vec_id: np.sign(r.whitened) for r in got if r.component == 3 and r.vec_id in (0, 80, 139)}
    assert len(set(signs.values())) == 1


def test_fewer_dimensions_repeated_rows_and_null_ids(frame):
    rows = vectors(2, 30, 3) + [(5, [9.0, 9.0, 9.0])]
    got = whitening.whiten(frame(rows_of([*rows, (None, rows[3][1])]), SCHEMA)).collect()
    assert max(r.component for r in got) == 3 and len(got) == 32 * 3
    own, none = ([round(r.whitened, 12) for r in sorted(got, key=lambda r: r.component) if r.vec_id == i] for i in (3, None))
    assert own == none
    assert len({r.n for r in got}) == 1 and got[0].n == 31


def test_no_variance_and_empty(frame):
    assert whitening.whiten(frame(rows_of([(i, [1.0, 2.0]) for i in range(5)]), SCHEMA)).collect() == []
    assert whitening.whiten(frame([], SCHEMA)).collect() == []
    assert whitening.whiten(frame(rows_of([(1, None)]), SCHEMA)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_constant_direction_has_no_component(frame):
    rows = [(i, [float(i % 7), 1.0, float(i % 5)]) for i in range(35)]
    got = whitening.whiten(frame(rows_of(rows), SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, plain(rows))


def test_very_large_entries(frame):
    rows = [(0, [1e30, 0.0]), (1, [0.0, 1.0]), (2, [-1e30, 0.5]), (3, [4.0, 2.0])]
    got = whitening.whiten(frame(rows_of(rows), SCHEMA)).collect()
    assert {r.deviation for r in got if r.vec_id == 0} == {None}
    assert all(math.isfinite(r.whitened) for r in got)


def test_query_equals_plain_version(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.op12_whitening(spark, SF).collect(), plain(rows))
