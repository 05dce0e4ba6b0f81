import math
import random

import numpy as np
import pyarrow as pa

from funnelforge.llm import language_id as lid

EN = "the quick brown fox jumps over the lazy dog and then this thing went there with them".split()
DE = "der schnelle braune fuchs springt über den faulen hund und dann ging dieses ding".split()


def grams(words, order):
    out = {}
    for w in words:
        s = lid.START + w + lid.END
        for i in range(2, len(s) + 1):
            g = s[max(0, i - order):i]
            out[g] = out.get(g, 0) + 1
    return out


def test_probabilities_sum_to_one_and_match_recursion():
    top = grams(EN * 2 + EN[:5], 3)
    model = lid.kneser_ney(top, 3)
    symbols = {g[-1] for g in model if g and g != lid.START}
    assert math.isclose(sum(2 ** model[s][0] for s in symbols)
                        + (lid.ALPHABET - len(symbols)) * 2 ** model[""][0], 1, rel_tol=1e-9)

    def p(context, c):
        if context + c in model and context + c != lid.START:
            return 2 ** model[context + c][0]
        if not context:
            return 2 ** model[""][0]
        return 2 ** model.get(context, (0, 0))[1] * p(context[1:], c)

    for context in ("th", "t", "xq", lid.START, lid.START + "t"):
        known = sum(p(context, c) for c in symbols)
        assert math.isclose(known + (lid.ALPHABET - len(symbols)) * p(context, "￿"), 1, rel_tol=1e-6)
    # the vectorised scorer follows the same back-off
    rows = pa.Table.from_pandas(lid.model_rows("en", model))
    bits, n = lid.Model(rows, 3).words([b"then", "zß9qu".encode(), b"123"])
    for i, runs in enumerate((["then"], ["zß", "qu"], [])):
        want = 0.0
        for run in runs:
            s = lid.START + run + lid.END
            want -= sum(math.log2(p(s[max(0, k - 2):k], s[k])) for k in range(1, len(s)))
        assert np.isclose(bits[i, 0], want, rtol=1e-4) and n[i] == sum(len(r) + 1 for r in runs)


def test_predictions_and_edges(frame):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(EN if i % 2 else DE, k=30)), "en" if i % 2 else "de") for i in range(200)]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "123 !! \u00bd \u2167", "en"), (1003, "the dog " * 4000, None),
             (1004, "zzqx xqzz wqxz kjxq " * 20, None), (None, "der fuchs über", None), (7, rows[7][1], "en")]
    docs = frame([(*r, 0.5, True) for r in rows], "doc_id bigint, text string, lang string, score double, fold boolean")
    got = lid.identify(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[r[0]].lang_pred == r[2] for r in rows[:200])
    assert {by_id[i].lang_pred for i in (1000, 1001, 1002)} == {"und"}
    assert all(by_id[i].score == 0 and by_id[i].rejected for i in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == "en" and by_id[None].lang_pred == "de" and by_id[None].held_out is False
    assert by_id[1004].rejected and not by_id[1003].rejected
    kept = lid.drop_rejected(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {1000, 1001, 1002, 1004}


def test_without_training_rows(frame):
    docs = frame([(1, "some words", None)], "doc_id bigint, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lid.identify(docs).collect()] == [("und", 0.0)]
    assert lid.identify(frame([], "doc_id bigint, text string, lang string")).collect() == []


def test_order_follows_the_size_bound(frame):
    docs = frame([(1, "some words there", "en"), (2, "andere worte dort", "de")], "doc_id bigint, text string, lang string")
    assert lid.train(docs, order=4).order == 4
    assert lid.train(docs, order=4, model_bytes=2500).order < 4


def test_order_is_the_same_at_any_size(frame):
    """So many languages and n-grams once lowered the order."""
    docs = frame([(i, " ".join(EN + DE), f"l{i:03}") for i in range(350)], "doc_id bigint, text string, lang string")
    model = lid.train(docs)
    assert model.order == lid.ORDER and len(model.languages) == 350
