"""The pipeline's stages on a small corpus."""

import random

import corpus_pipeline
from clickflow.llm import quality_rules, weighted_minhash
from tests.llm.cases import SF, both, empty, prose, words


def test_stages_in_order(spark):
    docs = both(spark)
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema == docs.schema, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append(docs.count())
    good = quality_rules.quality_rules(both(spark)).where("kept").count()
    assert seen[1] == good < seen[0]
    assert seen[2] < seen[1] and seen[3] == seen[2]
    assert not any("hunter2" in (r.text or "") for r in docs.collect())
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert packed.agg({"length": "sum"}).first()[0] > sum(len(words(r.text)) for r in docs.collect())


def test_run_reads_documents_and_stages_take_empty_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0


def test_near_stage_keeps_one_of_each_class(spark):
    docs = quality_rules.keep_good(both(spark))
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    classes = weighted_minhash.near_duplicates(docs).select("class_id").distinct().count()
    assert kept.select("doc_id").distinct().count() == classes


def test_near_stage_keeps_one_row_of_each_class(spark):
    """Repeated rows, null ids, and an id with several texts."""
    rng = random.Random(3)
    a, b, c, d = (prose(rng, 120, 5000) for _ in range(4))
    near = lambda text: text.replace(text.split()[60], "changed", 1)
    rows = [(1, a), (1, a), (1, a), (None, near(a)), (None, b), (None, b), (None, near(b)), (2, c), (2, d), (2, near(c)), (3, d)]
    rows += [(None, None), (None, ""), (4, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF)
    assert kept.schema == docs.schema
    found = [(r.doc_id, r.text) for r in kept.collect()]
    classes = [{(1, a)}, {(None, b), (None, near(b))}, {(2, c), (2, near(c))}, {(2, d)}, {(None, None), (None, "")}, {(4, " ")}]
    assert len(found) == len(classes) and all(sum(f in k for f in found) == 1 for k in classes)
