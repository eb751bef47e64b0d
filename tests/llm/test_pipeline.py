"""The pipeline's stages against plain versions, and its edge cases."""
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp

from .conftest import HARD, documents, save
from .test_pairs import brute_documents
from .test_text_operators import base_spans

SF = "/root/testdata/sf0.001"


def test_stage_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "personal_data", "mix", "encode"]


def test_stages_on_the_table(spark, word_bpe):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = cp.language(spark, docs, SF)
    assert one.columns == docs.columns and one.count() == docs.count()     # all are clean prose
    two = cp.near_duplicates(spark, docs, SF)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id for r in two.collect()} == {d for d, n, c, k in brute_documents(rows, 5, 80) if k or not n}
    three = cp.personal_data(spark, docs, SF)
    assert three.columns == docs.columns and three.count() == docs.count()
    assert not [r for r in three.collect() if base_spans(r.text) or r.n_chars != len(r.text)]
    same = {r.doc_id: r.text for r in docs.collect() if not base_spans(r.text)}
    assert all(r.text == same[r.doc_id] for r in three.collect() if r.doc_id in same)
    four = cp.mix(spark, docs, SF)
    assert four.columns == docs.columns
    per = {r.source: (r.n, r.t) for r in docs.groupBy("source").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n"), F.count("*").alias("t")).collect()}
    assert {r.doc_id for r in four.collect()} <= {r.doc_id for r in docs.collect()} and len(per) > 1
    assert four.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    five = cp.encode(spark, docs, SF).collect()
    lib = Tokenizer.from_file(word_bpe)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(np.frombuffer(r.ids, "<u4").tolist() == lib.encode(text[r.doc_id], add_special_tokens=False).ids for r in five)


def test_language_scores_each_text_once(spark):
    plan = cp.language(spark, documents(spark, HARD), SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_run(spark, tmp_path):
    out = cp.run(spark, SF)
    assert out.count() > 0 and "ids" in out.columns
    # hard rows and columns of clashing names pass every stage
    hard = documents(spark, HARD).withColumns({c: F.lit("x") for c in ("language", "pii", "mix", "copy", "rid", "taken")})
    for name, stage in cp.STAGES[:-1]:
        assert set(hard.columns) <= set(stage(spark, hard, SF).columns), name
    for name, stage in cp.STAGES:
        stage(spark, documents(spark, HARD), SF).collect()
    empty = cp.run(spark, save(documents(spark, HARD).limit(0), tmp_path, "documents"))
    assert empty.collect() == [] and empty.columns == out.columns


def test_near_duplicate_groups_leave_one_each(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(100))) for i in range(5, 9)] + [(1, "other text of more than five words"), (2, None), (3, "")]
    got = sorted(str(r.doc_id) for r in cp.near_duplicates(spark, documents(spark, rows), SF).collect())
    assert got == ["1", "2", "3", "5"]
