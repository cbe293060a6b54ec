import numpy as np
import pytest
import sentencepiece

from gridspan.llm import piece_lattice
from gridspan.llm.common import documents
from gridspan.llm.queries import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


def test_share_that_differs_from_the_library(spark):
    """The scores of this BPE model are merge ranks, so the best sum is not the library's encoding."""
    lattice, library = piece_lattice.Lattice(MODEL, 1), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [r["text"] or "" for r in documents(spark, SMALL).collect()]
    best = [np.frombuffer(f[0][1], "<u4").tolist() for f in lattice.encode(texts)]
    theirs = library.encode(texts)
    differ = sum(a != b for a, b in zip(best, theirs)) / len(texts)
    more = sum(map(len, best)) / sum(map(len, theirs))
    print(f"{differ:.4f} of {len(texts)} documents differ, {sum(map(len, best))} against {sum(map(len, theirs))} pieces")
    assert differ > 0.95 and more == pytest.approx(1.14, abs=0.05)
