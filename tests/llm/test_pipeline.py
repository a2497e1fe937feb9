import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dedup import brute_removal, groups
from tests.llm.test_near_copies import brute_set, similar
from tidemark.llm import bpe, decontaminate, mil_quality
from tidemark.llm.common import in_fold, table

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    learnt = ~in_fold(5, 0)
    model = mil_quality.learn(docs.where(learnt), table(spark, SF, "labels").where(learnt))
    good = {r.doc_id for r in mil_quality.score(docs, model).where("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    sets = {i: brute_set(t or "") for i, t in texts.items()}
    least = groups(sorted(texts), lambda a, b: similar(sets[a], sets[b]))
    texts = {i: t for i, t in texts.items() if least[i] == i}
    removed = brute_removal(list(texts.items()), 20)
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) <= set(texts)
    tokenizer, words = bpe.tokenizer(bpe.default_path()), decontaminate.WordIds()
    for i, text in texts.items():
        if i not in got:  # emptied, or an item of the benchmark aligns with the whole text
            best = max(decontaminate.align(words(t.encode()), words(text.encode()), decontaminate.Setup())[0]
                       / (2 * len(words(t.encode()))) for t in items)
            assert removed[i][0] == removed[i][1] > 0 or best >= 0.5
        elif not removed[i][1]:
            assert got[i].ids == tokenizer.encode(text)
            assert not any(t in text for t in items)
    assert len(got) > 0.6 * docs.count()


def test_stages_keep_the_columns(spark, edge):
    docs = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == edge.columns, name
        assert docs.schema["n_chars"].dataType == edge.schema["n_chars"].dataType
    assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_empty_input(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_hot_group_of_copies(spark):
    """A third of all rows are copies of one text: one stays, the others go."""
    text = F.when(F.col("id") % 3 == 0, F.lit("one text of many copies " * 9)).otherwise(
        F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.xxhash64("id", F.lit(i))) for i in range(25)]))
    docs = spark.range(900).select(F.col("id").alias("doc_id"), text.alias("text"))
    left = corpus_pipeline.one_per_group(spark, docs, SF)
    assert left.count() == 601
    assert left.where("doc_id % 3 = 0").count() == 1
