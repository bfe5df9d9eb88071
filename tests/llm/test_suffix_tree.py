"""The suffix tree against a plain one of dictionaries, and its growth with the corpus."""

import pickle
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import log, log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageflow.llm import suffix_tree
from pageflow.session import pin

LEAST = 4


def sequence(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return b"".join(w.encode() + b" " for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)) + b"\n"


def trained(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 != 1


class Plain:
    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for text in texts:
            whole = b"\n" * suffix_tree.DEPTH + sequence(text)
            for at in range(suffix_tree.DEPTH, len(whole)):
                for depth in range(suffix_tree.DEPTH + 1):
                    self.counts[whole[at - depth : at]][whole[at]] += 1
        self.alphabet = len(set(b"".join(sequence(t) for t in texts)) | {10, 32})
        # bytes that never occur share one symbol
        self.uniform, self.unknown = 1 / (self.alphabet + 1), 256 - self.alphabet
        self.nodes = {b""}
        for context, follow in self.counts.items():
            held = sum(follow.values())
            if context and held >= LEAST:
                shorter = self.counts[context[1:]]
                above = sum(shorter.values())
                divergence = sum(n * log(n / held / (shorter[x] / above)) for x, n in follow.items())
                if divergence > 0.5 * len(follow) * log(held) + 4.0:
                    self.nodes.update(context[k:] for k in range(len(context)))

    def share(self, context, x):
        below = self.share(context[1:], x) if context else self.uniform
        follow = self.counts.get(context, Counter())
        return (follow[x] + suffix_tree.PRIOR * below) / (sum(follow.values()) + suffix_tree.PRIOR)

    def score(self, text):
        whole, total = b"\n" * suffix_tree.DEPTH + sequence(text), 0.0
        for at in range(suffix_tree.DEPTH, len(whole)):
            depth = next(d for d in range(suffix_tree.DEPTH, -1, -1) if whole[at - d : at] in self.nodes)
            total += log10(self.share(whole[at - depth : at], whole[at]))
            if not self.counts[b""][whole[at]] and whole[at] not in (10, 32):
                total -= log10(self.unknown)
        return total


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = ["the", "small", "Ring", "rings", "of", "ringing", "über", "a", "band", "bands"]
    rows = [(n, " ".join(rng.choices(words, k=rng.randrange(30)))) for n in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "ZZZ \U0001f600 qqq"), (None, "the small ring"), (3, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("code", F.lit("x")).withColumn("row", F.lit(1))
    return df.repartition(3)


@pytest.mark.parametrize("ranked", [1 << 20, 40, 1])
def test_scores_against_a_plain_tree(docs, ranked):
    """Also with nearly all windows scored by the join."""
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    tree = Plain([text for key, text in rows if trained(key)])
    assert len(tree.nodes) > 40
    found = sorted(((r["doc_id"], r["score"]) for r in suffix_tree.score_documents(docs, LEAST, ranked).collect()), key=repr)
    expected = sorted(((key, tree.score(text)) for key, text in rows), key=repr)
    assert [k for k, _ in found] == [k for k, _ in expected]
    assert np.allclose(sorted(v for _, v in found), sorted(v for _, v in expected), rtol=1e-9)


def test_the_tree_grows_with_the_corpus(spark):
    rng = random.Random(9)

    def nodes(n):
        words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(n)]
        rows = [(" ".join(rng.choices(words, k=200)), True) for _ in range(n)]
        texts = spark.createDataFrame(rows, "text string, train boolean")
        symbols = suffix_tree.alphabet(suffix_tree.count_bytes(texts))
        return suffix_tree.grow(suffix_tree.count_windows(texts, symbols).cache())[0].count()

    assert nodes(240) > 3 * nodes(40) > 300


def test_nothing_to_learn_from(spark):
    out = next(n for n in range(50) if not trained(n))
    found = suffix_tree.score_documents(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).first()
    assert found["train_tokens"] == 0 and found["n_known"] == 0 and found["score"] < 0
    assert suffix_tree.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_table_of_frequent_windows_is_not_sent():
    """Its codes and values are; every executor and the driver keep a copy of what is sent on disk."""
    codes, values = np.arange(0, 300_000, 3), np.linspace(-9, 0, 100_000)
    sent = pickle.dumps(suffix_tree.Lookup(codes, values))
    assert len(sent) < 1.1 * (codes.nbytes + values.nbytes)
    found = pickle.loads(sent).get(np.arange(300_000))
    assert np.array_equal(found[::3], values) and np.isnan(found[1::3]).all()


def test_windows_shuffle_as_arrays(spark, docs):
    """A row per stem and task, not per window; and a stem in several rows gives the same nodes."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.lit(True).alias("train"))
    symbols = suffix_tree.alphabet(suffix_tree.count_bytes(texts))
    counted = pin(suffix_tree.count_windows(texts, symbols), "test-counted")
    windows = counted.select(F.sum(F.size("steps"))).first()[0]
    assert counted.count() == counted.select("stem").distinct().count() < windows / 3
    cut = pin(suffix_tree.count_windows(texts, symbols, record=1), "test-cut")
    assert cut.count() > counted.count() and cut.select(F.sum(F.size("steps"))).first()[0] == windows
    whole, parts = (sorted(map(tuple, suffix_tree.grow(c, LEAST).nodes.collect())) for c in (counted, cut))
    assert whole == parts and len(whole) > 40


def test_one_worker_a_task_adds_up_and_grows(spark, docs):
    """Each Python step of a stage is a worker of its own, and idle ones keep what they hold."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.lit(True).alias("train"))
    symbols = suffix_tree.alphabet(suffix_tree.count_bytes(texts))
    apart = suffix_tree.grow(suffix_tree.count_windows(texts, symbols), LEAST)
    counted = suffix_tree.count_windows(texts, symbols, record=1, least=LEAST)
    after_shuffle = counted._jdf.queryExecution().optimizedPlan().toString().split("Repartition")[0]
    assert after_shuffle.count("MapInArrow") == 1
    together = suffix_tree.grow(counted, LEAST)
    nodes, same = (sorted(map(tuple, t.nodes.collect())) for t in (apart, together))
    assert nodes == same and len(nodes) > 40
    assert all(np.array_equal(x, y) for u, v in zip(apart.upper, together.upper, strict=True) for x, y in zip(u, v, strict=True))


def test_a_worker_holds_little_of_the_frequent_windows():
    """Four bytes a place of the table, not sixteen: each worker of an executor builds one."""
    codes = np.arange(0, 3 << 18, 3)
    lookup = suffix_tree.Lookup(codes, codes / 2)
    held = sum(x.nbytes for x in vars(lookup).values() if isinstance(x, np.ndarray))
    assert held <= 4 * (4 * len(codes)) + 16 * len(codes) + 1000
    assert np.array_equal(lookup.get(codes), codes / 2) and np.isnan(lookup.get(codes + 1)).all()
    assert np.isnan(suffix_tree.Lookup(codes[:0], codes[:0] / 2).get(codes)).all()


def test_adding_up_holds_little_beside_the_parts():
    rng = np.random.default_rng(1)
    held = suffix_tree._Tallies()
    for _ in range(10):
        codes = np.unique(rng.integers(0, 1 << 40, 100_000))
        held.add(codes, np.ones(len(codes), np.int64))
    size = 16 * held.waiting
    tracemalloc.start()
    try:
        codes, _ = held.take()
        most = tracemalloc.get_traced_memory()[1]  # parts made before are not in it
    finally:
        tracemalloc.stop()
    assert len(codes) > 900_000 and most < 2.7 * size
