"""The pipeline's stages on a small corpus with planted cases."""

import numpy as np

import corpus_pipeline
from claimloom.llm.queries import ORACLE_SQL, queries


def test_stages(spark, tmp_path):
    rng = np.random.default_rng(9)
    words = [f"{a}{b}{c}" for a in "klmnprst" for b in "aeiou" for c in "rstz"]
    prose = lambda n: list(rng.choice(words, n))
    rows, labels = [], []
    for i in range(400):
        text = prose(120)
        if toxic := i % 5 == 0:
            for at in (10, 50, 90):
                text[at] = "stinkard"
        rows.append((i, " ".join(text), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(toxic)))
    base = prose(200)
    near = [*base[:100], "changed", *base[101:]]
    rows += [(1000, " ".join(base), "en", "s0", 0), (1001, "  ".join(base), "en", "s1", 0), (1002, " ".join(near), "en", "s2", 0), (1003, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        assert docs.columns == columns or name == "packing"
    toxic = {r[0] for r in labels if r[2]}
    assert len(toxic & set(ids["toxicity"])) <= 4 and len(set(ids["toxicity"]) - toxic) >= 320
    assert set(ids["toxicity"]) - set(ids["exact_dedup"]) == {1001}
    assert set(ids["exact_dedup"]) - set(ids["ngram_jaccard_join"]) == {1002}
    assert set(ids["mixing"]) <= set(ids["ngram_jaccard_join"]) and set(ids["packing"]) == set(ids["mixing"])


def test_all_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries()) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(queries())
