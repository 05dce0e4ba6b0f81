import random

import corpus_pipeline as cp


def test_decisions_take_effect(spark, tmp_path):
    rnd = random.Random(2)
    vocabulary = ["the", "river", "of", "stone", "and", "garden", "with", "music", "letters", "people", "under", "window"]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randrange(20, 80))) for _ in range(80)]
    item = "a rare question of which nobody in here knows the right answer today"
    special = {200: texts[0], 201: texts[0] + " end", 202: f"{texts[1]} {item} {texts[2]}", 203: None, 204: "12 34",
               205: f"{texts[3][:60]} write me@mail.org or 192.168.0.7 now"}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in [*enumerate(texts), *special.items()]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    out, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, out, str(tmp_path))
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns, name
            out.write.parquet(f"{tmp_path}/{k}.parquet")
            out = spark.read.parquet(f"{tmp_path}/{k}.parquet")
            seen.append({r.doc_id: r.text for r in out.collect()})
    everyone = {r[0] for r in rows}
    assert everyone - seen[0].keys() == {203, 204}
    assert seen[0].keys() - seen[1].keys() == {200, 201}
    assert seen[1].keys() - seen[2].keys() == {202}
    assert seen[3].keys() == seen[2].keys()
    assert {i for i in seen[3] if seen[3][i] != seen[2][i]} == {205}
    assert "write <EMAIL> or <IP> now" in seen[3][205]
    packed = out.collect()
    assert {r.doc_id for r in packed} == seen[3].keys()
    whole = cp.run(spark, str(tmp_path)).collect()
    assert sorted(r[:5] for r in map(tuple, whole)) == sorted(r[:5] for r in map(tuple, packed))
