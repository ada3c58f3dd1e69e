"""Labels reach every mention of an entity, however often it stands and however its digits are grouped."""

import itertools
import random

import numpy as np
import pytest

from calltrail.llm import pii


def field(none):
    own = pii.SkipChainField(np.zeros((pii.N_FEATURES, 5)), np.zeros((5, 5)))
    own.weights[0, 0] = none
    return own


def added(text, none=2.0):
    ((_, found),) = pii.label_texts([text], field(none))
    return sorted((pii.KINDS[k], text[a:b]) for k, a, b in found)


@pytest.mark.parametrize("n", [1, 4, 19, 300])
def test_all_repeats_are_found(n):
    assert added("Call +15551234567 now. " + "or some other words 15551234567 " * n) == [("phone", "15551234567")] * n


@pytest.mark.parametrize("seen", ["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567"])
def test_grouped_digits_are_one_mention(seen):
    forms = ["15551234567", "1 555 123 4567", "1 (555) 123-4567", "1.555.123.4567", "1-555-123-4567"]
    text = f"Call {seen} now; " + "; ".join(f"or call {f}, ticket 20240117" for f in forms)
    assert added(text) == sorted(("phone", f) for f in forms)
    assert ("phone", "(555) 123-4567") in added(f"Call {seen} now; or (555) 123-4567.", 1.0)
    assert added("card 4111 1111 1111 1111, again 4111.1111.1111.1111") == [("card", "4111.1111.1111.1111")]


def test_neighbours_stay_apart():
    text = "Call +15551234567 or card 4111111111111111. Both: 4111-1111 1111.1111 15551234567 77, order 2 15551234567 3"
    assert added(text) == [("card", "4111-1111 1111.1111"), ("phone", "15551234567"), ("phone", "15551234567")]
    assert pii.label_texts(["x", text, "+15551234567 15551234567"], field(2.0))[1] == pii.label_texts([text], field(2.0))[0]


def exact(field, scores, edges, kinds):
    """Marginals by summing over all labellings."""
    tables = [field.chain, field.same, field.similar]
    n, m = scores.shape
    out = np.zeros((n, m))
    for y in itertools.product(range(m), repeat=n):
        p = np.exp(sum(scores[i, y[i]] for i in range(n)) + sum(tables[k][y[a], y[b]] for (a, b), k in zip(edges, kinds, strict=True)))
        for i in range(n):
            out[i, y[i]] += p
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize(("edges", "within"), [([(0, 1), (1, 2), (1, 3), (3, 4)], 1e-3), ([(0, 1), (1, 2), (2, 0), (2, 3)], 0.06), ([(0, 4), (1, 4), (2, 4), (3, 4), (0, 1), (2, 3)], 0.06)])
def test_messages_give_exact_marginals(edges, within):
    """On trees they are exact, with loops near."""
    r = np.random.default_rng(3)
    for _ in range(5):
        own = pii.SkipChainField(np.zeros((pii.N_FEATURES, 5)), r.normal(0, 0.5, (5, 5)), 1.5, 0.8)
        n = max(map(max, edges)) + 1
        scores, kinds = r.normal(0, 1, (n, 5)), r.integers(0, 3, len(edges))
        got = own.marginals(scores, np.array(edges), kinds, np.zeros(len(edges), np.int64))
        assert np.abs(got - exact(own, scores, edges, kinds)).max() < within


def test_unmatched_mentions_are_no_examples():
    rows = list(pii.training_rows("Call +15551234567, again 15551234567 or +15551234567; ticket 20240117."))
    seen = [r.split(":")[3:] for r in rows]
    assert seen == [["4", "-", "4"], ["4", "-", "4"], ["-", "4", "4"]] * 2 + [["-", "-", "0"]]


def test_fitted_field_finds_held_out_mentions(spark):
    """Half of the mentions stand in a form that no pattern matches; other numbers look just like them."""
    r = random.Random(5)
    phone = lambda: f"1{r.randint(200, 999)}{r.randint(200, 999)}{r.randint(1000, 9999)}"
    texts, truth = [], []
    for k in range(240):
        own, other = phone(), phone()
        tail = f"later {own} and the order {other}." if k % 2 else f"or +{own} again, order {other}."
        texts.append(f"text {k}: call +{own} today, {tail} ip 10.0.{k % 200}.7")
        truth.append({(own, k % 2)})
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, *texts[:50], None, ""])], "doc_id BIGINT, text STRING")
    field_ = pii.fit_field(df)
    assert field_.same[0, 0] > 5
    hit = wrong = wanted = 0
    for text, own in zip(texts, truth, strict=True):
        ((_, more),) = pii.label_texts([text], field_)
        names = [text[a:b] for _, a, b in more]
        for number, late in own:
            wanted += late
            hit += late and number in names
            wrong += sum(n != number for n in names)
    assert hit >= 0.95 * wanted and wrong == 0
    assert np.abs(pii.fit_field(df.limit(0)).weights).sum() == 4.0
