"""The pipeline stage by stage against the operators' plain rules, and the registered queries' schemas."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
import __spark_entry__  # noqa: E402
from pathcredit.llm import quality  # noqa: E402
from pathcredit.llm.common import materialize  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, before, SF))
        assert after.columns == docs.columns, name
        ids = {r[0] for r in after.select("doc_id").collect()}
        came = {r[0] for r in before.select("doc_id").collect()}
        if name == "quality":
            good = quality.score_quality(docs, labels).where("predicted = 1")
            assert ids == {r[0] for r in good.select("doc_id").collect()}
        elif name == "near_duplicates":
            found = __spark_entry__.queries()["op7_simhash"]
            groups = found(spark, SF).where(f"doc_id in ({','.join(map(str, came))})").collect()
            # Components of what is left may be parts of the whole table's, never joined ones.
            assert len(ids) >= len({r["component_id"] for r in groups}) and ids <= came
            assert len({r["fingerprint"] for r in groups if r["doc_id"] in ids}) == len(ids)
        elif name == "decontamination":
            hits = __spark_entry__.queries()["op9_decontamination"](spark, SF).collect()
            assert ids == came - {r["doc_id"] for r in hits}
        else:
            assert ids == came and after.count() == before.count()
        before = after
    shards = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert {r["doc_id"] for r in shards} == {r[0] for r in before.select("doc_id").collect()}
    assert {r["shard"] for r in shards} == set(range(8))


def test_run_returns_the_sharded_rows(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "shard", "slot"} <= set(got.columns)
    rows = got.collect()
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_every_operator_has_a_query():
    names = [k for k in __spark_entry__.queries() if k.startswith("op")]
    assert [k.split("_")[0] for k in names] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in __spark_entry__.queries()
