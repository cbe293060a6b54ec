"""The bias of the factorization machine is learned, and its margins are those of the formula."""

import numpy as np

from gridspan.llm import toxicity


def test_texts_without_known_terms_are_clean_when_half_of_the_labels_are_toxic():
    draw = np.random.default_rng(5)
    rows, label = [], np.arange(4000) % 2.0
    for i, toxic in enumerate(label):
        own = 100_000 + 20 * i + np.arange(20)  # met in one text only
        rows.append(np.append(own, draw.integers(0, 100)) if toxic else own)
    machine = toxicity.train(rows[:3200], label[:3200], toxicity.Fit())
    rest = rows[3200:]
    docs = np.repeat(np.arange(len(rest)), [len(r) for r in rest])
    margin = machine.margins(docs, np.concatenate(rest), len(rest))
    assert machine.bias < 0
    assert (margin[label[3200:] == 0] < 0).all() and (margin[label[3200:] == 1] >= 0).mean() > 0.95


def test_margins_equal_the_sum_over_all_pairs():
    draw = np.random.default_rng(6)
    places = np.sort(draw.choice(1 << toxicity.BITS, 40, replace=False))
    machine = toxicity.Machine(places, -0.7, draw.normal(size=40), draw.normal(size=(40, 3)))
    rows = [np.sort(draw.choice(places, k, replace=False)) for k in (0, 1, 2, 9, 40)] + [places[:3] + 1]
    got = machine.margins(np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows), len(rows))
    at = {int(p): i for i, p in enumerate(places)}
    for value, row in zip(got, rows):
        met = [at[int(p)] for p in row if int(p) in at]
        want = machine.bias + sum(machine.weight[i] for i in met) + sum(
            float(machine.vectors[i] @ machine.vectors[j]) for a, i in enumerate(met) for j in met[a + 1:])
        assert abs(value - want) < 1e-9


def test_no_rows_give_the_smallest_rate():
    machine = toxicity.train([], np.zeros(0), toxicity.Fit())
    assert abs(1 / (1 + np.exp(-machine.bias)) - 1e-3) < 1e-9 and not len(machine.places)
