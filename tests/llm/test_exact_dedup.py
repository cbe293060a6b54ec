from gridspan.llm import exact_dedup

from .conftest import ODD


def test_groups_nulls_ties_and_repeats(docs):
    got = exact_dedup.exact_duplicates(docs(*ODD)).collect()
    assert len(got) == len(ODD)
    of = {}
    for r in got:
        of.setdefault(r["text_sha256"], []).append(r)
    assert sorted(len(g) for g in of.values()) == [1, 1, 2, 4]
    for group in of.values():
        assert sum(r["kept"] for r in group) == 1
        assert {r["group_size"] for r in group} == {len(group)}
    assert {r["keep_id"] for r in got if r["doc_id"] in (3, 4, None)} == {3}
    assert {r["keep_id"] for r in got if r["doc_id"] in (1, 2)} == {1}


def test_heavy_and_light_paths_agree(docs):
    rows = [(i, "same" if i % 3 == 0 else f"text {i % 40}") for i in range(300)]
    found = [sorted(exact_dedup.exact_duplicates(docs(*rows), support=s).collect()) for s in (0.001, 0.2, 0.9)]
    assert found[0] == found[1] == found[2]
    assert {r["digest"] for r in exact_dedup.heavy_winners(
        exact_dedup._digests(docs(*rows), "text", "doc_id"), 0.2).collect()} == {
            r["text_sha256"] for r in found[0] if r["group_size"] == 100}


def test_filter_keeps_whole_rows(docs):
    source = docs(*ODD)
    for support in (0.001, 0.3):
        got = exact_dedup.drop_exact_copies(source, support=support)
        assert got.columns == source.columns
        assert sorted(r["doc_id"] for r in got.collect()) == [1, 3, 7, 8]


def test_empty_table(docs):
    assert exact_dedup.exact_duplicates(docs()).count() == 0
    assert exact_dedup.drop_exact_copies(docs()).count() == 0
