"""Each stage against what its operator finds, on a small capture and on odd tables."""

import os

import pytest

import corpus_pipeline
from gleanwell.llm import workload
from gleanwell.llm.decontamination import overlaps
from gleanwell.llm.mixing import mix
from gleanwell.llm.near_dups import near_duplicates
from gleanwell.llm.quality_rules import judge

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="captured tables are not here")


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_take_effect_one_after_the_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, FOLDER).cache()
        assert out.columns == docs.columns and out.schema == docs.schema
        if name == "quality_rules":
            want = ids(judge(left, into="q").where("q.kept"))
        elif name == "near_dedup":
            want = ids(near_duplicates(left, 80).where("kept"))
        elif name == "decontamination":
            want = sorted(set(ids(left)) - set(ids(overlaps(left, benchmark))))
        else:
            want = ids(mix(left, corpus_pipeline.MIXTURE_BUDGET).where("selected"))
        assert ids(out) == want and (len(want) < left.count() or name != "quality_rules")
        left = out
    final = corpus_pipeline.STAGES[-1][1](spark, left, FOLDER)
    assert ids(final) == ids(left) and final.select("shard", "slot").distinct().count() == left.count()


def test_run_and_queries(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
    assert sorted(int(k[2:].split("_")[0]) for k in workload.QUERIES) == list(range(1, 14))


def test_stages_on_odd_and_empty_tables(spark, odd, empty):
    for frame in (odd, empty):
        left = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, FOLDER)
            assert left.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() == frame.count()
