import numpy as np
import pytest

from funnelforge.llm import ann


def brute(rows, k=20):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
          and any(v)]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            near = sorted(((-(x * y).sum(), i) for i, y in ok if i != q and len(y) == len(x)))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def run(frame, rows, **options):
    df = frame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, score int")
    got = {}
    for r in ann.search(df, **options).orderBy("query_id", "rank").collect():
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def test_recall_and_order_on_clusters(frame):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16)) * 2
    x = (centres[rng.integers(0, 40, 1500)] + 0.5 * rng.standard_normal((1500, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want, got = brute(rows), run(frame, rows, sample_vectors=700, block_bytes=300 * 128, group_queries=40)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        for i, s in found:
            assert s == pytest.approx(float(x[q].astype(float) @ x[i].astype(float)), rel=1e-12, abs=1e-12)


def test_copies_and_unusable_vectors(frame):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(300)]  # one vector holds most rows
    rows += [(1000 + i, rng.standard_normal(3).astype(np.float32).tolist()) for i in range(60)]
    rows += [(2000, None), (2020, [0.0, 0.0, 0.0]), (2040, [1.0, None, 2.0]), (2060, [1.0, float("nan"), 2.0]),
             (2080, [float("inf"), 1.0, 1.0]), (2100, []), (None, [9.0, 9.0, 9.0]), (2120, [1.0, 2.0]), (2121, [2.0, 1.0])]
    want, got = brute(rows), run(frame, rows, target=1.0, block_bytes=50 * 24)
    got.setdefault(2120, [])
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_empty_and_few(frame):
    assert run(frame, []) == {}
    assert run(frame, [(0, [1.0, 0.0])]) == {}
    assert run(frame, [(0, [1.0, 0.0]), (7, [1.0, 1.0])]) == {0: [(7, 1.0)]}


@pytest.mark.parametrize("most", [0, 2])
def test_recall_where_probes_do_not_reach_it(frame, monkeypatch, most):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "MAX_PROBES", max(1, most))
    if not most:  # not even buckets of one projection
        monkeypatch.setattr(ann.Index, "fit", lambda self, *_: 1.0 if self.k == 0 else 0.0)
    want, got = brute(rows), run(frame, rows, block_bytes=300 * 128)
    hits = [len({i for i, _ in got.get(q, ())} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= (0.9 if most else 1.0)


def test_visits_come_in_order_of_success():
    index = ann.Index(6, 3.0, 10_000)
    index.width, index.spread = 1.5, 0.6
    rng = np.random.default_rng(1)
    q = rng.standard_normal((5, 6))
    full, part = index.visits(q, 0, 3 ** index.k), index.visits(q, 0, 20)
    assert full.shape == (5, 3 ** index.k) and (np.sort(part, axis=1) == np.sort(full[:, :20], axis=1)).all()
    home = index.codes(np.floor(index.slots(index.queried(q), 0)), 0)
    assert all(home[i] in full[i, :1 + index.k] or home[i] in full[i] for i in range(5))
