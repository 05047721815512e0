"""Operators 1, 2 and 4 against enumeration and plain loops."""

import math
import random
from collections import Counter
from itertools import permutations

import numpy as np

from starmart.llm import quality_classifier, sharding, toxicity


def test_matrix_has_the_frequencies_of_all_deals():
    """Every order of the rows, cut into shards, is one deal; the matrix counts rows by partition and shard."""
    counts, sizes = [2, 1, 2], [3, 2]
    of_row = [p for p, n in enumerate(counts) for _ in range(n)]
    shard_of_place = [s for s, n in enumerate(sizes) for _ in range(n)]
    deals = Counter()
    for order in permutations(range(5)):
        m = [[0] * len(sizes) for _ in counts]
        for place, row in enumerate(order):
            m[of_row[row]][shard_of_place[place]] += 1
        deals[str(m)] += 1
    total, n = sum(deals.values()), 20_000
    drawn = Counter(str(sharding.communication_matrix(counts, sizes, seed)) for seed in range(n))
    assert set(drawn) == set(deals)
    for m, k in deals.items():
        p = k / total
        assert abs(drawn[m] / n - p) < 5 * math.sqrt(p * (1 - p) / n), m


def test_large_hypergeometric_draw_by_its_probabilities(monkeypatch):
    """The inversion used beyond numpy's population, on a population that can be enumerated."""
    monkeypatch.setattr(sharding, "NUMPY_POPULATION", 0)
    good, bad, sample, n = 7, 5, 6, 20_000
    rng = np.random.default_rng(3)
    drawn = Counter(sharding.hypergeometric(rng, good, bad, sample) for _ in range(n))
    for k in range(max(0, sample - bad), min(good, sample) + 1):
        p = math.comb(good, k) * math.comb(bad, sample - k) / math.comb(good + bad, sample)
        assert abs(drawn[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n), k


def _risk(w, b, x, positive, prior):
    f = x @ w + b
    keep, as_negative = np.log1p(np.exp(-f)), np.log1p(np.exp(f))
    return prior * keep[positive].mean() + max(0.0, as_negative[~positive].mean() - prior * as_negative[positive].mean())


def test_risk_descent_equals_numeric_descent():
    """The whole fit on a tiny sample against the same steps on derivatives taken by differences of the risk."""
    rng = np.random.default_rng(5)
    truth = rng.random(60) < 0.4
    x = rng.normal(size=(60, 2)) + np.where(truth[:, None], 0.8, -0.8)
    positive = truth & (rng.random(60) < 0.5)
    prior, steps, rate, l2 = 0.3, 60, 0.05, 1e-3
    model = quality_classifier.fit_linear(x, quality_classifier._pu_gradient(positive, prior), l2=l2, steps=steps, rate=rate)
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    p, m, v = np.zeros(3), np.zeros(3), np.zeros(3)
    for t in range(1, steps + 1):
        g = np.array([(_risk(*(lambda q: (q[:2], q[2]))(p + e), z, positive, prior) - _risk(*(lambda q: (q[:2], q[2]))(p - e), z, positive, prior)) / 2e-5 for e in np.eye(3) * 1e-5])
        g[:2] += l2 * p[:2]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(np.append(model.weights, model.bias), p, atol=5e-3)
    assert _risk(model.weights, model.bias, z, positive, prior) < _risk(np.zeros(2), 0.0, z, positive, prior)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(6)
    for share in (0.15, 0.4, 0.7):
        truth = rng.random(6000) < share
        unlabelled = rng.normal(size=(6000, 3)) + np.where(truth[:, None], 1.5, -1.5)
        x = np.concatenate([rng.normal(size=(3000, 3)) + 1.5, unlabelled])
        positive = np.arange(9000) < 3000
        order = rng.permutation(9000)
        assert abs(quality_classifier.estimate_prior(x[order], positive[order]) - share) < 0.06, share


def test_label_model_step_equals_loops(spark):
    """One step of expectation and maximisation over all rows, in plain loops over rows and voters."""
    rng = random.Random(7)
    voters = toxicity.Voters.build(["badword", "awfulword", "terrible*"])
    terms = len(voters.terms)
    rows = [([rng.randrange(terms) for _ in range(rng.choice([0, 0, 1, 3]))], [math.log1p(rng.randint(1, 60)), rng.random(), rng.random() * 0.5, rng.choice([0.0, 0.0, 0.2])]
             + [rng.random() for _ in range(toxicity.NUMBERS - 4)]) for _ in range(80)]
    df = spark.createDataFrame(rows, "hits array<int>, numbers array<double>").repartition(4)
    got = toxicity.fit_label_model(df, voters, steps=1)

    start, v = toxicity.LabelModel.start(len(voters)), len(voters)
    fired = []
    for hits, numbers in rows:
        count = np.zeros((1, terms))
        for h in hits:
            count[0, h] += 1
        fired.append(voters.fired(count, np.array([numbers]))[0])
    post = []
    for f in fired:
        odds = math.log(start.share / (1 - start.share))
        for j in range(v):
            if f[j]:
                odds += math.log(start.toxic[j] / start.clean[j])  # no correlations yet, so no damping
        post.append(1 / (1 + math.exp(-odds)))
    n, toxic = len(rows), sum(post)
    rate = [(sum(p * f[j] for p, f in zip(post, fired, strict=True)) + start.toxic[j]) / (toxic + 1) for j in range(v)]
    other = [(sum((1 - p) * f[j] for p, f in zip(post, fired, strict=True)) + start.clean[j]) / (n - toxic + 1) for j in range(v)]
    for j in range(v):
        for k in range(v):
            both = sum(p * f[j] * f[k] for p, f in zip(post, fired, strict=True)) / toxic
            spread = math.sqrt(max(rate[j] * (1 - rate[j]), 1e-9) * max(rate[k] * (1 - rate[k]), 1e-9))
            want = 0.0 if j == k else min(1.0, max(0.0, (both - rate[j] * rate[k]) / spread))
            assert abs(got.correlation[j, k] - want) < 1e-6
    speaks = [min(rate[j], other[j]) if j == v - 1 else max(rate[j], other[j]) for j in range(v)]
    assert abs(got.share - min(0.9, max(1e-4, toxic / n))) < 1e-9
    assert np.allclose(got.toxic, np.clip(speaks, 1e-5, 0.999)) and np.allclose(got.clean, np.clip(other, 1e-6, 0.999))
