import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from funnelforge.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def texts():
    rnd = random.Random(6)
    alphabet = ["a", "b.c", "@", ".", "-", "+1", "4", "44", "255", "256", "007", " ", "(", ")", "é", "\U0001F600", "_", "%",
                "4539578763621486", "5500-0000-0000-0004", "192.168.0.1", "x@y.org", "+49 30 1234567", "\n", ""]
    rows = [(i, "".join(rnd.choices(alphabet, k=rnd.randrange(60)))) for i in range(400)]
    return rows + [
        (1000, None), (1001, ""), (1002, "a@b.c_d@e.f@g.h"), (1003, "1.2.3.4.5.6.7.8 1.2.3 0255.01.1.1 1.1.1.1111"),
        (1004, "x@" + "a." * 20_000 + "b"), (1005, "9" * 50_000), (1006, "1 " * 30_000), (1007, "+1" + "." * 50_000),
        (1008, "a" * 100_000), (1009, " ".join(f"u{i}@h.org" for i in range(1500))), (1010, "x@y.zz q"),
        (1011, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and more'), (None, "me@x.org"), (5, "me@x.org"),
        (5, "me@x.org")] + [(2000 + i, f'my secret: "{rnd.getrandbits(160):040x}" ok') for i in range(20)]


def test_base_spans_equal_brute_force(frame):
    rows = texts()
    got = pii.find_personal_data(frame([(*r, 7) for r in rows], "doc_id bigint, text string, spans int", parts=4)).collect()
    want = []
    for doc_id, text in rows:
        spans = brute(text)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        want.append((doc_id, *[sum(k == x for k, *_ in spans) for x in BASE], hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        if doc_id != 5:
            listed = by_id[doc_id].spans.split(",")
            assert {f"{k}:{s}:{e}" for k, s, e in brute(text)} <= set(listed)
    assert by_id[1011].spans == "secret:9:49"


def test_empty_and_without_candidates(frame):
    assert pii.find_personal_data(frame([], "doc_id bigint, text string")).collect() == []
    got = pii.find_personal_data(frame([(1, "nothing here"), (2, None)], "doc_id bigint, text string")).collect()
    assert {r.spans for r in got} == {""}


def test_redaction_replaces_spans_only(frame):
    rows = [(1, "see me@x.org, 192.168.0.1.", "a", 27), (2, "clean text", "b", 10), (3, None, None, None),
            (4, "é 4539578763621486 \U0001F600 +49 30 1234567!", "c", 5), (4, "", "c", 0)]
    docs = frame(rows, "doc_id bigint, text string, kind string, n_chars bigint")
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        (1, "see <EMAIL>, <IP>.", "a", 18), (2, "clean text", "b", 10), (3, None, None, None),
        (4, "é <CARD> \U0001F600 <PHONE>!", "c", 19), (4, "", "c", 0)], key=repr)


def test_em_separates_two_voters(spark):
    rows = [([1, 1, 1, 0], 60), ([1, 1, 0, 0], 20), ([-1, -1, 0, 0], 70), ([-1, -1, 0, -1], 50), ([1, -1, 0, 0], 4)]
    patterns = spark.createDataFrame([("email", v, n) for v, n in rows], "kind string, votes array<int>, n bigint")
    theta = pii._reliabilities(patterns).first().theta
    assert theta[0] == pytest.approx(0.4, abs=0.08) and theta[1] > 0.9 and theta[3] < 0.1
    p = patterns.select("votes", pii._posterior(F.col("votes"), F.array(*map(F.lit, theta))).alias("p")).collect()
    assert all((r.p > 0.9) == (r.votes[0] == 1 and r.votes[1] == 1) for r in p if r.votes[:2] != [1, -1])


def test_no_python_in_the_plan(frame):
    docs = frame([(1, "a@b.org")], "doc_id bigint, text string")
    for df in (pii.with_candidates(docs), pii.redact(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
