from pyspark.sql import functions as F

from gridspan.llm import katz

from .test_katz_histories import ASK, LEARN
from .test_katz_order import _model, _same

ROWS = [(k, " ".join(f"w{(k * j * j + j * i) % 97}" for j in range(60))) for i, k in enumerate(LEARN[:50] + ASK[:10])]


def test_a_slice_and_an_owner_share_one_blob(spark, docs, monkeypatch):
    """Blobs are as many as slices times owners; training and held-out texts of a slice had one each."""
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 400)
    kept, stage = [], katz.stage

    def noted(df, label):
        out = stage(df, label)
        if label == "katz-answers":
            kept.append(out)
        return out

    monkeypatch.setattr(katz, "stage", noted)
    scores = katz.katz_scores(docs(*ROWS).coalesce(2), order=3)
    most = kept[0].filter("slice >= 0").groupBy("slice", "bucket").agg(F.sum((F.col("ids").isNull()).cast("int")).alias("n"))
    assert most.agg(F.max("n")).first()[0] == 1
    _same(scores.collect(), _model(ROWS, 3)[0])


def test_slices_and_owners_are_few():
    """Slices of 2 MB and owners of 500,000 tokens made 28 million blobs of 6 GB."""
    tokens, text = 115_000_000 * 12, 870_000_000 * 12
    assert (text // katz.SLICE_BYTES) * (tokens // katz.BUCKET_TOKENS) < 3_000_000
