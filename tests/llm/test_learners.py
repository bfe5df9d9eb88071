"""What the trained operators compute, against plain loops; and what they reach on rows they have not seen."""

import random
from math import exp, log, sqrt

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from pageflow.llm import language, quality, rules
from pageflow.llm.words import texts_of

TEXTS = ["good words here", "bad bad words", "", "good good good here", "a b c d", "bad words again and again", "über größe", "x"]
LABELS = [1, 0, 1, 1, 0, 0, 1, 0]


def test_leader_updates_one_feature_at_a_time():
    texts = texts_of(pa.array(TEXTS))
    families = quality.features(texts, bits=10)
    rows = []
    for k in range(len(TEXTS)):
        numbers = [int(x) for f, b in families for x in f[b[k] : b[k + 1]]]
        n_words = len(TEXTS[k].split())
        assert len(numbers) == 2 * n_words + 2 * max(n_words - 1, 0)
        rows.append({x: quality.SCALE * numbers.count(x) / len(numbers) for x in numbers} | {1024: 1.0})
    z, n = {}, {}

    def weight(x):
        if abs(z.get(x, 0.0)) <= quality.L1:
            return 0.0
        pull = z[x] - (quality.L1 if z[x] > 0 else -quality.L1)
        return -pull / ((quality.BETA + sqrt(n[x])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for row, label in zip(rows, LABELS, strict=True):
            held = {x: weight(x) for x in row}
            miss = 1 / (1 + exp(-sum(held[x] * v for x, v in row.items()))) - label
            for x, v in row.items():
                g, before = miss * v, n.get(x, 0.0)
                z[x] = z.get(x, 0.0) + g - (sqrt(before + g * g) - sqrt(before)) / quality.ALPHA * held[x]
                n[x] = before + g * g
    learned = quality.fit_ftrl(texts, np.array(LABELS), np.zeros(1025), bits=10)
    assert np.allclose(learned, [weight(x) for x in range(1025)], atol=1e-9) and np.count_nonzero(learned) > 10
    margins = quality.margins(texts, learned, bits=10)
    assert np.allclose(margins, [sum(weight(x) * v for x, v in row.items()) for row in rows])


def test_estimation_of_rules_in_plain_loops():
    rng = random.Random(6)
    patterns = [[rng.randrange(3) for _ in range(5)] for _ in range(30)]
    counts = [rng.randrange(1, 50) for _ in patterns]
    on_good, on_bad, share = [0.02] * 5, [0.4] * 5, 0.9
    for _ in range(rules.ROUNDS):
        belief = []
        for votes in patterns:
            good, bad = share, 1 - share
            for k, vote in enumerate(votes):
                if vote != 1:
                    good *= on_good[k] if vote == 0 else 1 - on_good[k]
                    bad *= on_bad[k] if vote == 0 else 1 - on_bad[k]
            belief.append(good / (good + bad))
        for k in range(5):
            seen = [(v[k] == 0, b, c) for v, b, c in zip(patterns, belief, counts, strict=True) if v[k] != 1]
            on_good[k] = (sum(c * b for blame, b, c in seen if blame) + 0.1) / (sum(c * b for _, b, c in seen) + 5)
            on_bad[k] = (sum(c * (1 - b) for blame, b, c in seen if blame) + 2) / (sum(c * (1 - b) for _, b, c in seen) + 5)
            on_good[k], on_bad[k] = min(max(on_good[k], 0.0005), 0.05), min(max(on_bad[k], 0.1), 0.95)
        share = min(max((sum(c * b for b, c in zip(belief, counts, strict=True)) + 9) / (sum(counts) + 10), 0.5), 0.98)
    assert np.allclose(rules.estimate(np.array(patterns), np.array(counts, float)), belief)


def plain_probabilities(network, codes):
    tables, offset, out, bias = network.parts()
    found = []
    for row in codes.tolist():
        pooled = []
        for table in tables:
            for f in range(language.FILTERS):
                pooled.append(max(sum(float(table[k][row[at + k]][f]) for k in range(len(table))) for at in range(len(row) - len(table) + 1)))
        hidden = [max(p + float(o), 0.0) for p, o in zip(pooled, offset, strict=True)]
        raw = [sum(h * float(w) for h, w in zip(hidden, out[:, k], strict=True)) + float(bias[k]) for k in range(network.languages)]
        total = sum(exp(r - max(raw)) for r in raw)
        found.append([exp(r - max(raw)) / total for r in raw])
    return np.array(found)


@pytest.fixture(scope="module")
def examples():
    codes, _, _ = language.windows(texts_of(pa.array(["the small ring is round and old", "der kleine Ring ist rund und alt"])))
    return codes


def test_network_in_plain_loops(examples):
    network = language.Network.start(3)
    assert np.allclose(language.Scorer(network).probabilities(examples), plain_probabilities(network, examples), atol=1e-4)


def test_gradient_is_the_slope_of_the_loss(examples):
    network = language.Network(language.Network.start(2).flat.astype(np.float64), 2)
    labels = np.array([0, 1])
    slope = language._gradient(network, examples, labels)

    def loss(flat):
        found = language.Scorer(language.Network(flat, 2)).probabilities(examples)
        return -sum(log(found[k, x]) for k, x in enumerate(labels)) / len(labels)

    steepest = np.argsort(-np.abs(slope))[:25]
    for at in steepest:
        up, down = network.flat.copy(), network.flat.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - slope[at]) < 1e-3 * max(1, abs(slope[at]))


def test_languages_of_rows_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count(F.lit(1)).alias("n")).first()
    assert right["n"] > 20 and right["right"] >= 0.95


def test_quality_of_rows_not_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    good, bad = ([r["score"] for r in found if r["quality"] == k] for k in (1, 0))
    assert len(good) > 2 and len(bad) > 0
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) >= 0.85 * len(good) * len(bad)
