import pytest

import corpus_pipeline
from gridspan.llm import exact_dedup, ngram_join, quality_classifier, toxicity
from gridspan.llm.common import documents
from gridspan.llm.queries import ORACLES, QUERIES, labels
from tests.conftest import CHECK, SMALL
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, name):
    got = QUERIES[name](spark, CHECK).toPandas()
    assert differences(got, connect(CHECK).execute(ORACLES[name]).df()) is None and len(got)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_per_document(spark, name):
    got, n = QUERIES[name](spark, SMALL), documents(spark, SMALL).count()
    assert got.select("doc_id").distinct().count() == n
    assert name.startswith("op3") or got.count() == n


def test_pipeline_equals_its_stages_and_every_stage_decides(spark):
    docs = documents(spark, SMALL)
    toxic = {r["doc_id"] for r in toxicity.toxicity(docs, labels(spark, SMALL)).filter("predicted = 1").collect()}
    one = docs.filter(~docs["doc_id"].isin(list(toxic)))
    kept = [r["doc_id"] for r in quality_classifier.classify(one, labels(spark, SMALL)).filter("kept").collect()]
    two = one.filter(one["doc_id"].isin(kept))
    kept = [r["doc_id"] for r in exact_dedup.exact_duplicates(two).filter("kept").collect()]
    three = two.filter(two["doc_id"].isin(kept))
    kept = {r["doc_id"] for r in ngram_join.near_duplicates(three, 5, 80, 100).filter("component_id = doc_id").collect()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == kept
    assert docs.count() > one.count() > two.count() > three.count() > len(kept) > 0
