import random

from gridspan.llm import language_id, quality_classifier, toxicity

from .conftest import ODD


def test_language_profiles_on_held_out_rows(docs):
    random.seed(1)
    words = {"en": "the and of to that with from this have which".split(), "de": "der die und nicht mit auf ist eine werden auch".split()}
    rows = [(i, " ".join(random.choices(words[g], k=30)), g) for i in range(200) for g in [("en", "de")[i % 2]]]
    rows += [(900, None, "en"), (901, "12 ... 5", None), (902, "the that which", None)]
    got = {r["doc_id"]: r for r in language_id.language_id(docs(*rows)).collect()}
    assert len(got) == len(rows) and any(r["held_out"] for r in got.values())
    assert all(got[i]["lang_pred"] == g for i, _, g in rows[:200])
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[902]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_odd_rows_and_nothing_to_learn(docs):
    assert language_id.language_id(docs(*ODD)).count() == len(ODD)
    got = language_id.language_id(docs((1, "a b"), (2, None))).collect()
    assert {r["lang_pred"] for r in got} == {"und"}
    assert language_id.language_id(docs()).count() == 0


def _talk(i, bad):
    random.seed(i)
    words = [f"w{random.randrange(200)}" for _ in range(40)]
    if bad:
        words[random.randrange(40)] = random.choice(["Dreadful,", "AWFUL", "nasty."])
    return " ".join(words)


def test_toxicity_on_held_out_rows(docs, labels):
    rows = [(i, _talk(i, i % 4 == 0)) for i in range(800)]
    mark = labels("toxic", *[(i, int(i % 4 == 0)) for i in range(800)], (None, 1), (5, None))
    got = toxicity.toxicity(docs(*rows), mark).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 800 and len(held) > 100
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) >= 0.97 * len(held)
    kept = toxicity.drop_toxic(docs(*rows), mark)
    assert kept.columns == docs().columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["predicted"] == 0}


def test_pair_of_terms_weighs_more_than_its_parts(docs, labels):
    def text(i):
        random.seed(i)
        extra = (["alpha"] if i % 2 else []) + (["omega"] if (i // 2) % 2 else [])
        return " ".join(random.sample([f"w{k}" for k in range(50)], 6) + extra)
    mark = labels("toxic", *[(i, int(bool(i % 2) == bool((i // 2) % 2))) for i in range(2000)])
    fit = toxicity.Fit(terms=60, epochs=30)
    got = [r for r in toxicity.toxicity(docs(*[(i, text(i)) for i in range(2000)]), mark, fit=fit).collect() if r["held_out"]]
    assert sum(r["predicted"] == int(bool(r["doc_id"] % 2) == bool((r["doc_id"] // 2) % 2)) for r in got) > 0.9 * len(got)


def test_toxicity_odd_rows_and_no_labels(docs, labels):
    mark = labels("toxic", (3, 1), (7, 0))
    got = toxicity.toxicity(docs(*ODD), mark).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    none = labels("toxic")
    assert {r["predicted"] for r in toxicity.toxicity(docs(*ODD), none).collect()} == {0}
    assert toxicity.toxicity(docs(), mark).count() == 0
    assert toxicity.drop_toxic(docs(*ODD), none).count() == len(ODD)


def test_quality_on_held_out_rows(docs, labels):
    def text(i):
        random.seed(i)
        return " ".join(("%s$$$" if i % 5 == 0 else "%s") % f"word{random.randrange(99)}" for _ in range(40))
    rows = [(i, text(i), "en", f"h{i % 7}") for i in range(600)] + [(700, None), (701, "", None, "new")]
    mark = labels("quality", *[(i, int(i % 5 != 0)) for i in range(600)])
    got = {r["doc_id"]: r for r in quality_classifier.classify(docs(*rows), mark).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["kept"] == (i % 5 != 0) for i in range(600))
    kept = quality_classifier.drop_bad(docs(*rows), mark)
    assert kept.columns == docs().columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def test_sites_are_shrunk_to_their_host_and_hosts_to_all(spark):
    rows = [("big", "a", 1.0)] * 90 + [("big", "b", 0.0)] * 3 + [("bad", "a", 0.0)] * 80 + [("few", "a", 0.0)]
    m, hosts, paths = quality_classifier.site_rates(spark.createDataFrame(rows, "host string, path string, y double"))
    h = {r["host"]: r["host_rate"] for r in hosts.collect()}
    p = {(r["host"], r["path"]): r["path_rate"] for r in paths.collect()}
    assert h["bad"] < 0.1 < h["few"] < m < h["big"]
    assert p["big", "b"] < h["big"] <= p["big", "a"]


def test_quality_odd_rows_and_no_labels(docs, labels):
    mark = labels("quality", (3, 1), (7, 0))
    assert quality_classifier.classify(docs(*ODD), mark).count() == len(ODD)
    got = quality_classifier.classify(docs(*ODD), labels("quality")).collect()
    assert all(abs(r["score"] - 0.5) < 1e-9 and r["kept"] for r in got)
    assert quality_classifier.classify(docs(), mark).count() == 0
    assert quality_classifier.drop_bad(docs(*ODD), labels("quality")).count() == len(ODD)
