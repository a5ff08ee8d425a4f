"""The pipeline's stages, each against what its operator says of its input."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark):
    import corpus_pipeline as cp
    from basewise.llm import decontamination, line_dedup, packing, simhash_similar, toxicity

    docs, held = spark.read.parquet(f"{SF}/documents.parquet"), {}
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    for name, stage in cp.STAGES:
        after = spark.createDataFrame(stage(spark, docs, SF).collect() or [], stage(spark, docs, SF).schema)
        if name != "packing":
            assert after.columns == docs.columns
        ids = lambda df: {r.doc_id for r in df.collect()}
        if name == "toxicity":
            lost = {r.doc_id for r in toxicity.op8_toxicity(docs, labels).where("predicted = 1").collect()}
            assert ids(after) == ids(docs) - lost and lost
        elif name == "line_dedup":
            want = {r.doc_id: r.text for r in line_dedup.op10_lines(docs).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == want and after.where("n_chars <> length(text)").count() == 0
        elif name == "near_dedup":
            groups = {}
            for r in simhash_similar.similar(docs).collect():
                groups.setdefault(r.component, []).append(r.doc_id)
            assert ids(after) == {min(g) for g in groups.values()} and after.count() == len(groups)
        elif name == "decontamination":
            assert ids(after) == ids(docs) - ids(decontamination.op3_contaminated(docs, items))
        else:
            told = {r.doc_id: r.doc_tokens for r in after.collect()}
            pieces = {}
            for r in after.collect():
                pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
            assert pieces == told and set(told) == ids(docs)
            assert packing.SCHEMA.split()[0] == after.columns[0]
        held[name], docs = after, after
    # How documents meet in sequences follows the files; what is packed doesn't.
    packed = lambda df: {(r.doc_id, r.doc_tokens) for r in df.collect()}
    assert packed(cp.run(spark, SF)) == packed(held["packing"])
