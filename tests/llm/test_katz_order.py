import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridspan.llm import katz
from gridspan.llm.common import documents
from gridspan.llm.queries import QUERIES

from .conftest import ODD

SMALL = "/root/testdata/sf0.001"


def _model(rows, order):
    """Recursive backoff in plain Python with every word a symbol: the scores, and the largest error of a sum over all symbols."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = [["<s>", *(t or "").translate(low).split(), "</s>"] for _, t in rows]
    train = [k is None or zlib.crc32(str(k).encode()) % 7 != 2 for k, _ in rows]
    one = Counter(w for r, t in zip(runs, train) if t for w in r[1:])
    total = sum(one.values()) + len(one) + 1  # one more for all words never met
    count = [None, None] + [Counter(tuple(r[i - k + 1:i + 1]) for r, t in zip(runs, train) if t
                                    for i in range(k - 1, len(r))) for k in range(2, order + 1)]
    d = [None, None] + [katz.discounts(np.array([sum(n == q for n in c.values()) for q in range(1, katz.TOP + 2)], float))
                        for c in count[2:]]
    after = defaultdict(dict)
    for c in count[2:]:
        for g, n in c.items():
            after[g[:-1]][g[-1]] = n
    size = {h: sum(a.values()) for h, a in after.items()}
    weights = {}

    def seen(h, w):
        n = after[h][w]
        return n * (d[len(h) + 1][n - 1] if n <= katz.TOP else 1) / (size[h] + 1)

    def weight(h):
        if h not in weights:
            weights[h] = (1 - sum(seen(h, w) for w in after[h])) / max(1e-12, 1 - sum(p(h[1:], w) for w in after[h]))
        return weights[h]

    def p(h, w):
        if not h:
            return (one[w] + 1) / total
        if h not in after:
            return p(h[1:], w)
        return seen(h, w) if w in after[h] else weight(h) * p(h[1:], w)

    off = max((abs(sum(p(h, w) for w in [*one, "never met"]) - 1) for h in sorted(after, key=str)[::max(1, len(after) // 20)]
               if len(after[h]) < len(one) / 2), default=0)
    return [(k, len(r) - 1, sum(math.log10(p(tuple(r[max(0, i - order + 1):i]), r[i])) for i in range(1, len(r))))
            for (k, _), r in zip(rows, runs)], off


def _same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted([(r["doc_id"], r["n_tokens"], r["score"]) for r in got], key=key)
    want = sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], rtol=1e-9, atol=1e-6)


@pytest.mark.parametrize("order", [3, 4])
def test_orders_equal_the_plain_model(spark, order, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 6000)  # many owners, and split ones
    source = documents(spark, SMALL).limit(60)
    want, off = _model([(r["doc_id"], r["text"]) for r in source.collect()], order)
    assert off < 1e-9
    _same(katz.katz_scores(source, order=order).collect(), want)


def test_odd_rows_at_order_three(spark, docs):
    _same(katz.katz_scores(docs(*ODD), order=3).collect(), _model([r[:2] for r in ODD], 3)[0])
    assert katz.katz_scores(docs(), order=3).count() == 0


def test_query_keeps_every_word_and_backs_off_from_order_three(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SMALL).collect()]
    _same(QUERIES["op8_katz_scores"](spark, SMALL).collect(), _model(rows, 3)[0])
    assert katz.SHARE == 0
