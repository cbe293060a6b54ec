import zlib

import pytest

from gridspan.llm import katz

from .test_katz_order import _model, _same

LEARN, ASK = ([k for k in range(400) if (zlib.crc32(str(k).encode()) % 7 == 2) == held] for held in (False, True))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_only_longest_histories_that_are_asked_for_are_kept(spark, docs, monkeypatch, order):
    rows = [(k, " ".join(f"w{(k * j * j + j) % 41}" for j in range(30))) for k in LEARN[:60]]
    rows += [(ASK[0], "w1 w2 never w3"), (ASK[1], rows[0][1][:20] + " w7"), (ASK[2], None), (None, "w1 w2 w3"), (LEARN[0], "w1 w2 w5")]
    sizes, stage = {}, katz.stage

    def counted(df, label):
        out = stage(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(katz, "stage", counted)
    _same(katz.katz_scores(docs(*rows), order=order).collect(), _model(rows, order)[0])
    held = [["<s>", *(t or "").split(), "</s>"] for k, t in rows if k in ASK]
    asked = {tuple(r[i - order + 1:i]) for r in held for i in range(order - 1, len(r))}
    assert sizes["katz-longest"] <= len(asked)
