"""Every stage on odd rows and on the given documents, held against what the operator should decide."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from shelfwise.llm.common import written
from tests.llm.conftest import SF
from tests.llm.test_groups import plain_fingerprint, roots
from tests.llm.test_text import plain_leaks

STAGE = dict(pipeline.STAGES)


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing",
    ]


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    for docs in (odd, nothing):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in pipeline.STAGES[:-1]:
            after = written(stage(spark, docs, SF), name)
            assert after.columns == docs.columns and after.count() <= docs.count()
            if docs.count():
                assert after.count() > 0
            docs = after
        assert (STAGE["best_fit_packing"](spark, docs, SF).count() > 0) == (docs.count() > 0)


def test_language_stage_keeps_all_text(spark, odd, documents):
    assert STAGE["language_id"](spark, documents, SF).exceptAll(documents).count() == 0
    assert STAGE["language_id"](spark, documents, SF).count() == documents.where("text rlike '\\\\p{L}'").count()
    kept = [r.doc_id for r in STAGE["language_id"](spark, odd, SF).collect()]
    assert not {1, 2, 3, 10} & set(kept) and len(kept) == odd.count() - 4


def test_one_document_of_each_group(spark, documents):
    rows = documents.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    import numpy as np

    root = roots(np.array([[(a ^ b).bit_count() <= 2 for b in fps] for a in fps]))
    want = {min(rows[j].doc_id for j in np.flatnonzero(root == g)) for g in set(root)}
    got = [r.doc_id for r in STAGE["simhash_near_dedup"](spark, documents.unionAll(documents.limit(20)), SF).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_leaks_go(spark, documents):
    short = documents.where("length(text) < 6000")
    leaks = {d for d, _ in plain_leaks(short.collect(), spark.read.parquet(f"{SF}/benchmark.parquet").collect())}
    kept = {r.doc_id for r in STAGE["benchmark_decontamination"](spark, short, SF).collect()}
    assert kept == {r.doc_id for r in short.collect()} - leaks


def test_secrets_are_masked(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    after = STAGE["secret_scan"](spark, docs, SF)
    assert after.count() == docs.count()
    secret = r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}"
    assert docs.where(F.col("text").rlike(secret)).count() > 0
    assert after.where(F.col("text").rlike(secret)).count() == 0
    same = after.alias("a").join(docs.alias("b"), "doc_id").where("a.text = b.text").count()
    assert same == docs.where(~F.col("text").rlike(secret)).count()


def test_whole_run(spark):
    got = pipeline.run(spark, SF).toPandas()
    assert len(got) > 0 and (got.groupby("sequence_id").length.sum() <= 4096).all()


def test_columns_named_like_its_own(spark, documents):
    docs = documents.limit(40).withColumns({n: F.lit("mine") for n in ("_key", "_all", "_text", "_places")})
    for name, stage in pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert {tuple(r) for r in docs.select("_key", "_all", "_text", "_places").distinct().collect()} == {("mine",) * 4}
