import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from funnelforge.llm import jaccard_join as jj

WORD = re.compile("[^\x20\x09-\x0d]+")


def sets(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    own = [sets(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 75 * len(own[i] | own[j]):
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    least = {}
    for (doc_id, _), g in zip(docs, group):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(((d, len(s), least.get(g) if s else d) for (d, _), s, g in zip(docs, own, group)), key=repr)


def near_copies(rnd, words, n, edits):
    out = []
    for _ in range(n):
        own = list(words)
        for _ in range(rnd.randrange(edits)):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(10_000)}"
        out.append(" ".join(own))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for n, copies, edits in ((60, 25, 5), (100, 20, 9), (30, 15, 3), (200, 12, 12), (8, 10, 3)):
        texts += near_copies(rnd, rnd.choices(vocabulary, k=n), copies, edits)
    drift = rnd.choices(vocabulary, k=80)  # a chain: neighbours link, the ends don't
    for _ in range(20):
        drift = drift[2:] + rnd.choices(vocabulary, k=2)
        texts.append(" ".join(drift))
    line = " ".join(rnd.choices(vocabulary, k=12))  # a line that many unlike texts share
    texts += [line + " " + " ".join(rnd.choices(vocabulary, k=rnd.randrange(60))) for _ in range(40)]
    texts += [" ".join(rnd.choices(["a", "B", "c"], k=rnd.randrange(9))) for _ in range(60)]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(frame, seed):
    docs = corpus(seed) + [(900, None), (901, ""), (902, " \t"), (903, None), (904, "One  two"), (905, "one\x0btwo"), (906, "é " * 30_000),
                           (907, "É " * 30_000), (7, "same id other text"), (None, "one two"), (908, "t " * 4), (909, "t t t t")]
    got = jj.join(frame([(*d, 1) for d in docs], "doc_id bigint, text string, component_id int", parts=5))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(docs)


def test_members_inside_their_hubs(frame):
    """Originals h and g share a core and are not similar; every member lies
    inside its original, and one, which lost most of h's footer, is similar to g."""
    texts = []
    for group in range(4):
        core = [f"c{group}_{i}" for i in range(84)]
        h, g = ([f"{side}{group}_{i}" for i in range(n)] for side, n in (("h", 24), ("g", 20)))
        texts += [" ".join(core[cut:] + footer) for footer in (h, g) for cut in range(5)]  # truncated copies
        texts.append(" ".join(core + h[:5]))
    random.Random(1).shuffle(texts)
    docs = list(enumerate(texts))
    got = jj.join(frame(docs, "doc_id bigint, text string", parts=5))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(docs)


def test_empty_and_keep_one(frame):
    empty = frame([], "doc_id bigint, text string")
    assert jj.join(empty).collect() == [] and jj.keep_one(empty).collect() == []
    docs = frame([(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (3, None, "z"), (4, "", "z"), (4, "", "z"), (None, "q", None)],
                 "doc_id bigint, text string, key string")
    kept = jj.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, None], key=repr)


def test_lists_across_batches():
    """Every pair that sizes and positions allow survives; no single rows do."""
    rnd = random.Random(5)
    size = {k: rnd.randrange(4, 60) for k in range(40)}
    rows = sorted({(rnd.randrange(30), size[k], k): rnd.randrange(jj.prefix_length(size[k])) for k in list(size) * 8}.items())
    rows = [(*k, p) for k, p in rows]
    rows = sorted(rows + rnd.sample(rows, 20))  # repeats of a class in a list
    table = pa.table({"token": pa.array([r[0] for r in rows], pa.int64()), "key": pa.array([r[2] for r in rows], pa.int64()),
                      "n": pa.array([r[1] for r in rows], pa.int32()), "pos": pa.array([r[3] for r in rows], pa.int32())})
    once = sorted(set(rows))
    lists, must = {}, set()
    for t, n, k, p in once:
        for m, other, q in lists.setdefault(t, []):
            if 175 * min(n, m) >= 75 * (n + m) and 175 * min(n - p, m - q) >= 75 * (n + m):
                must |= {(t, k), (t, other)}
        lists[t].append((n, k, p))
    for batch in (1, 2, 7, 1000):
        batches = [pa.RecordBatch.from_pydict({c: table.column(c).combine_chunks()[i:i + batch] for c in table.column_names})
                   for i in range(0, len(rows), batch)]
        got = [r for b in jj._shared_rows(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert len(got) == len({r[:2] for r in got}) and {r[:4] for r in got} <= {(t, k, n, p) for t, n, k, p in once}
        assert must <= {r[:2] for r in got}
        assert all(len(lists[r[0]]) > 1 for r in got)


def test_bitmaps_never_rule_out_similar_sets():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([rng.permutation(a)[:rng.integers(0, len(a) + 1)],
                                      rng.integers(0, 1 << 63, rng.integers(0, 200)).astype(np.uint64)]))
        assert jj.least_difference(jj.signature(a), jj.signature(b)) <= len(a) + len(b) - 2 * jj.overlap(a, b)


def test_prefix_and_overlap():
    for n in range(1, 200):
        for m in range(n, 300):
            need = -(-75 * (n + m) // 175)
            if need <= n:  # sets of these sizes can be similar
                assert jj.prefix_length(n) >= n - need + 1 and jj.prefix_length(m) >= m - need + 1
    a, b = np.array([1, 5, 9, 11], np.uint64), np.array([0, 5, 11, 12, 13], np.uint64)
    assert jj.overlap(a, b) == jj.overlap(b, a) == 2 and jj.overlap(a, a[:0]) == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(205, 203), (203, 204)]
    got = {r.key: r.comp for r in jj.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 203: 203, 204: 203, 205: 203}


def test_likeliest_open_members():
    """So many pairs for each of the smaller side, those with most in common; without a
    number all that may be similar."""
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(150)]
    shingle = jj.Shingler(5)
    hub = shingle(" ".join(words).encode())
    sides = []
    for s, n in (("a", 60), ("b", 20)):
        own = [shingle(t.encode()) for t in near_copies(rnd, words, n, 8)]
        inside = [jj.overlap(hub, x) for x in own]
        sides.append(pd.DataFrame({f"key_{s}": range(n), f"m_{s}": [len(x) for x in own], f"in_{s}": inside,
                                   f"out_{s}": [len(x) - i for x, i in zip(own, inside)], f"sketch_{s}": [jj.signature(x) for x in own]}))
        sides[-1].attrs["sets"] = own
    left, right = sides
    right["shared"] = len(hub)
    every, few = jj._open_members(None)(left, right), jj._open_members(2)(left, right)
    a, b = left.attrs["sets"], right.attrs["sets"]
    similar = {(i, j) for i in range(60) for j in range(20) if 175 * jj.overlap(a[i], b[j]) >= 75 * (len(a[i]) + len(b[j]))}
    every, few = set(zip(every.a, every.b)), set(zip(few.a, few.b))
    assert similar <= every and few <= every and len(few) == sum(min(2, sum(j == k for _, j in every)) for k in range(20))
    apart = {(i, j): jj.least_difference(left.sketch_a[i], right.sketch_b[j]) / (left.m_a[i] + right.m_b[j]) for i, j in every}
    assert all(apart[x] <= apart[y] for x in few for y in every - few if x[1] == y[1])
