import pytest
from pyspark.sql import functions as F

from gridspan.llm import katz
from gridspan.llm.common import documents

from .conftest import ODD
from .test_katz_order import SMALL, _model, _same

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _answers(spark, docs, monkeypatch, bucket):
    """Bytes of all answers, while owners have ``bucket`` tokens."""
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
    sizes, stage = [], katz.stage

    def sized(df, label):
        out = stage(df, label)
        if label == "katz-answers":
            sizes.append(out.agg(F.sum(F.length("blob"))).first()[0])
        return out

    with monkeypatch.context() as patch:
        patch.setattr(katz, "stage", sized)
        katz.katz_scores(docs, order=3)
    return sizes[0]


def test_answers_take_few_bytes_a_token(spark, monkeypatch):
    source = documents(spark, SMALL).limit(100)
    tokens = sum(len((r["text"] or "").split()) + 1 for r in source.collect())
    few, many = (_answers(spark, source, monkeypatch, b) for b in (tokens // 8, tokens // 64))
    # 13.8 and 18.9 bytes a token; they were 17.7 and 22.2.
    assert few < 16 * tokens and many < 21 * tokens


def test_shuffles_are_dropped_and_the_setting_is_as_before(spark, docs, monkeypatch):
    seen, stage = [], katz.stage

    def noted(df, label):
        seen.append(spark.conf.get(CLEANUP, None))
        return stage(df, label)

    monkeypatch.setattr(katz, "stage", noted)
    before = spark.conf.get(CLEANUP, None)
    katz.katz_scores(docs(*ODD), order=3)
    assert set(seen) == {"true"} and spark.conf.get(CLEANUP, None) == before


@pytest.mark.parametrize("common, often", [(1.0, 1.0), (0.0, 0.0), (1e-3, 1e-3)])
def test_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch, common, often):
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 6000)
    monkeypatch.setattr(katz, "HISTORY_TOKENS", 3000)
    monkeypatch.setattr(katz, "COMMON", common)
    monkeypatch.setattr(katz, "OFTEN", often)
    source = documents(spark, SMALL).limit(60)
    want, _ = _model([(r["doc_id"], r["text"]) for r in source.collect()], 3)
    _same(katz.katz_scores(source, order=3).collect(), want)
