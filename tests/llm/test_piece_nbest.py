import zlib

import numpy as np

from gridspan.llm import piece_lattice
from gridspan.llm.queries import tokenizer_file

from .conftest import ODD

MODEL = tokenizer_file("piece_bpe_32k.model")


def test_rows_have_all_n_segmentations(spark, docs):
    lattice = piece_lattice.Lattice(MODEL, 3)
    for r in piece_lattice.encode_pieces(docs(*ODD, (9, "the cat sat")), MODEL, with_ids=True).collect():
        found = r["nbest_ids"]
        assert len(found) == len(r["nbest_scores"]) == len({tuple(i) for i in found}) and list(found[0]) == list(r["ids"])
        assert r["nbest_n_pieces"] == [len(i) for i in found] and r["nbest_n_pieces"][0] == r["n_pieces"]
        raw = [np.array(i, "<u4").tobytes() for i in found]
        assert r["nbest_ids_crc32"] == [zlib.crc32(i) for i in raw] and r["nbest_ids_crc32"][0] == r["ids_crc32"]
        text = dict((k, t or "") for k, t, *_ in [*ODD, (9, "the cat sat")])[r["doc_id"]]
        assert all(lattice.decode(i) == text for i in raw)
        assert r["doc_id"] != 9 or len(found) == 3
