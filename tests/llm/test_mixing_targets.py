"""Raking until targets are met, against a plain loop, and targets that cannot be."""

import random
from collections import defaultdict

import pytest

from listinglake.llm import mixing

TARGET = "dimension string, value string, share double"
CELL = "source string, lang string, topic string, tokens bigint"


def plain_rake(cells, targets, rounds=3000):
    weights = {key: float(tokens) for *key, tokens in cells for key in [tuple(key)]}
    for _ in range(rounds):
        for place, name in enumerate(mixing.DIMENSIONS):
            have = defaultdict(float)
            for key, weight in weights.items():
                have[key[place]] += weight
            for key in weights:
                share = targets.get((name, key[place]), 0.0)
                weights[key] *= share / have[key[place]] if have[key[place]] else 0.0
    return weights


def test_sources_of_nearly_one_language_each(spark):
    rng = random.Random(1)
    cells = [
        (f"s{s}", f"l{lang}", topic, 1 + int(rng.random() * (50_000 if lang == s % 4 else 6000)))
        for s in range(60)
        for lang in range(4)
        for topic in ("a", "b", "c")
    ]
    drawn = [rng.expovariate(1) for _ in range(60)]
    targets = {("source", f"s{s}"): x / sum(drawn) for s, x in enumerate(drawn)}
    targets |= {("lang", f"l{k}"): x for k, x in enumerate((0.4, 0.3, 0.2, 0.1))}
    targets |= {("topic", "a"): 0.5, ("topic", "b"): 0.3, ("topic", "c"): 0.2}
    frame = spark.createDataFrame(cells, CELL)
    given = spark.createDataFrame([(*key, share) for key, share in targets.items()], TARGET)
    goal = mixing.reachable(frame, given)
    fitted = mixing.rake(frame, goal)
    assert mixing.unmet(fitted, goal, 1e-9).count() == 0
    wanted = plain_rake(cells, targets)
    for row in fitted.collect():
        assert row.weight == pytest.approx(wanted[row.source, row.lang, row.topic], rel=1e-6, abs=1e-12)
    chance = mixing.chances(fitted).collect()
    tokens = {tuple(key): n for *key, n in cells}
    spent = sum(c.chance * tokens[c.source, c.lang, c.topic] for c in chance)
    assert spent == pytest.approx(mixing.BUDGET * sum(tokens.values()), rel=1e-9)


def test_targets_that_cannot_be_met_are_reported(spark, documents, caplog):
    """A value without tokens, one without a target, and shares that contradict each other."""
    cells = [("s0", "en", "a", 10), ("s1", "de", "a", 30), ("s1", "fr", "a", 30), ("s2", "de", "a", 0)]
    frame = spark.createDataFrame(cells, CELL)
    shares = [("source", "s0", 0.4), ("source", "s1", 0.4), ("source", "s2", 0.2)]
    shares += [("lang", "en", 0.5), ("lang", "de", 0.5), ("topic", "a", 1.0)]
    goal = mixing.reachable(frame, spark.createDataFrame(shares, TARGET))
    fitted = mixing.rake(frame, goal)
    assert {(r.source, r.lang): round(r.weight, 9) for r in fitted.collect()} == {
        ("s0", "en"): 0.5, ("s1", "de"): 0.5, ("s1", "fr"): 0.0, ("s2", "de"): 0.0,
    }
    missed = {(r.dimension, r.value): (r.wanted, round(r.reached, 9)) for r in mixing.unmet(fitted, goal).collect()}
    assert missed == {("source", "s0"): (0.4, 0.5), ("source", "s1"): (0.4, 0.5), ("source", "s2"): (0.2, 0.0)}
    docs = documents([(k, "word " * 9) for k in range(6)])
    against = [("source", "s0", 1.0), ("source", "s1", 0.0), ("lang", "xx", 1.0), ("topic", "prose", 1.0)]
    rows = mixing.mix(docs, spark.createDataFrame(against, TARGET)).collect()
    assert "cannot be met" in caplog.text and all(r.weight == 0 and not r.kept for r in rows)


def test_contradicting_shares_end(spark):
    cells = [("s0", "en", "a", 10), ("s1", "de", "a", 30)]
    frame = spark.createDataFrame(cells, CELL)
    shares = [("source", "s0", 0.4), ("source", "s1", 0.6), ("lang", "en", 0.7), ("lang", "de", 0.3), ("topic", "a", 1.0)]
    goal = mixing.reachable(frame, spark.createDataFrame(shares, TARGET))
    fitted = mixing.rake(frame, goal)
    assert {r.value for r in mixing.unmet(fitted, goal).collect()} == {"s0", "s1"}
