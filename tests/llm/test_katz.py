import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridspan.llm import katz
from gridspan.llm.common import documents

from .conftest import ODD

SMALL = "/root/testdata/sf0.001"


def _plain(rows, share):
    """The same model word by word: the scores, and how far any distribution is from one."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for _, t, *_ in rows]
    train = [k is None or zlib.crc32(str(k).encode()) % 7 != 2 for k, *_ in rows]
    count = Counter(w for ws, t in zip(texts, train) if t for w in ws)
    n, ends = sum(count.values()), sum(train)
    tokens, types = n + ends, len(count) + (ends > 0)
    often = {w for w, c in count.items() if c >= max(1, share * n)}
    sym = lambda w: w if w in often else 0
    c1 = Counter({0: 0, 1: ends, 2: ends})
    for w, c in count.items():
        c1[sym(w)] += c
    names = [*sorted(often), 0, 1]
    p1 = {x: (c1[x] + 1) / sum(c1[y] + 1 for y in names) for x in names}
    runs = [[2, *map(sym, ws), 1] for ws in texts]
    pairs = Counter(p for r, t in zip(runs, train) if t for p in zip(r, r[1:]))
    d = katz.discounts(np.array([sum(v == r for v in pairs.values()) for r in range(1, katz.TOP + 2)], float))
    after = defaultdict(dict)
    for (h, w), r in pairs.items():
        after[h][w] = r * (d[r - 1] if r <= katz.TOP else 1) / (c1[h] + 1)
    weight = {h: (1 - sum(after[h].values())) / max(1e-12, 1 - sum(p1[w] for w in after[h])) for h in [*names, 2]}
    p = lambda h, w: after[h][w] if w in after[h] else weight[h] * p1[w]
    off = max(abs(sum(p(h, w) for w in names) - 1) for h in [2, *names[:60]] if len(after[h]) < len(names))
    rest, kinds = n - sum(count[w] for w in often), len(count) - len(often)
    out = []
    for (key, *_), ws, run in zip(rows, texts, runs):
        base = sum(math.log10((count[w] + 1) / (tokens + types + 1)) for w in ws) + math.log10((ends + 1) / (tokens + types + 1))
        score = sum(math.log10(p(a, b)) for a, b in zip(run, run[1:]))
        score += sum(math.log10((count[w] + 1) / (rest + kinds + 1)) for w in ws if w not in often)
        out.append((key, len(ws) + 1, sum(count[w] > 0 for w in ws) + (ends > 0), tokens, base, score))
    return out, off


def _check(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted([(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got], key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9, atol=1e-7)


@pytest.mark.parametrize("share", [2e-6, 1e-3])
def test_scores_equal_the_plain_model_and_sum_to_one(spark, share, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 3000)  # many owners, and split ones
    source = documents(spark, SMALL)
    want, off = _plain([(r["doc_id"], r["text"]) for r in source.collect()], share)
    assert off < 1e-9
    got = katz.katz_scores(source, share=share).collect()
    _check(got, want)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows_and_empty_table(docs):
    _check(katz.katz_scores(docs(*ODD)).collect(), _plain(ODD, katz.SHARE)[0])
    assert katz.katz_scores(docs()).count() == 0
