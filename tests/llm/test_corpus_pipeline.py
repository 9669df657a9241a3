"""The pipeline's stages, each on odd rows, and the whole against the operators' own results."""

import corpus_pipeline
from pyspark.sql import functions as F

from skein.llm import decontamination, language_id, simhash, toxicity
from skein.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(written(stage(spark, steps[-1], SF), name))
    for before, after in zip(steps, steps[1:-1]):
        assert after.columns == docs.columns and after.exceptAll(before).isEmpty() and after.count() <= before.count()
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in steps]
    accepted = language_id.classify(docs, language_id.fit(docs, ~language_id.held_out())).where("accepted")
    assert ids[1] == {r.doc_id for r in accepted.collect()}
    model = toxicity.fit(steps[1], spark.read.parquet(f"{SF}/labels.parquet"), ~toxicity.held_out())
    assert ids[2] == {r.doc_id for r in toxicity.score(steps[1], model).where("predicted = 0").collect()}
    near = simhash.near_duplicates(steps[2]).collect()
    assert ids[3] == {r.component_id for r in near}
    clean = decontamination.scan(steps[3], spark.read.parquet(f"{SF}/benchmark.parquet")).where("not contaminated")
    assert ids[4] == {r.doc_id for r in clean.collect()} == ids[5]
    assert sorted(map(str, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(map(str, steps[5].drop("sequence_id", "offset").collect()))


def test_stages_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "some words of a text that is here", "en", None, 3), (2, "some words of a text that is here", "en", None, 3)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(1) for c in ("score", "accepted", "fp", "n_hit", "row_", "root")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns and stage(spark, odd.limit(0), SF).count() == 0
    near = dict(corpus_pipeline.STAGES)["simhash"](spark, odd, SF)
    assert sorted(r.doc_id for r in near.collect()) == [1, 2]
    assert dict(corpus_pipeline.STAGES)["packing"](spark, odd, SF).count() == len(rows)
