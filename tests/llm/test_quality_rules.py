import random
import re
from collections import Counter

from gridspan.llm import quality_rules

from .conftest import ODD


def _measure(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = Counter(x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), sum(v - 1 for v in lines.values()), len(hit))


def test_measures_against_plain_python(docs):
    random.seed(3)
    texts = [r[1] for r in ODD] + ["a b c d e f g h " * k for k in range(1, 4)] + [
        " ".join(random.choice("ab") for _ in range(n)) + "\nx\nx\n \n" for n in (7, 8, 9, 30, 60)]
    got = quality_rules.measures(docs(*enumerate(texts))).collect()
    for r in got:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == _measure(texts[r["doc_id"]])


def test_bad_host_takes_its_documents_and_null_host_does_not(docs):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good, None, "good") for i in range(60)] + [(100 + i, "short", None, "bad") for i in range(60)] + [
        (200, good, None, "bad"), (201, good, None, None), (202, "short", None, None)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs(*rows)).collect()}
    assert len(got) == len(rows)
    assert got[0]["kept"] and got[201]["kept"] and not got[202]["kept"]
    assert got[200]["host_rejected"] and not got[200]["base_failed"] and not got[200]["kept"]


def test_sparse_host_is_shrunk(docs):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good, None, f"h{i % 20}") for i in range(400)] + [(500, "short", None, "new"), (501, good, None, "new")]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs(*rows)).collect()}
    assert got[501]["kept"]


def test_odd_rows_and_empty_table(docs):
    assert quality_rules.quality_rules(docs(*ODD)).count() == len(ODD)
    assert quality_rules.quality_rules(docs()).count() == 0
