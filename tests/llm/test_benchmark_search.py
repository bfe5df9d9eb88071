"""Benchmark search against a plain search of every stretch of words, and its recall at the committed values."""

import random
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from pageflow.llm import decontaminate


def words(text):
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text.lower())


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for k, y in enumerate(b):
            row.append(before[k] + 1 if x == y else max(before[k + 1], row[-1]))
    return row[-1]


def holds(text, item):
    """Whether any stretch twice as long as the item has enough of it, or a good part and the answer."""
    own, inside = words(item), words(text)
    answer = words([s for s in re.split("[.!?]", item) if re.search(r"\w", s)][-1])
    width = 2 * len(own) + 2 * decontaminate.STEP_WORDS
    for at in range(0, max(1, len(inside) - len(own) + 1), 4):
        stretch = inside[at : at + width]
        if len(set(own) & set(stretch)) < 0.3 * len(set(own)):
            continue
        share = common(own, stretch) / len(own)
        if share >= decontaminate.FULL_SHARE or (share >= decontaminate.PART_SHARE and common(answer, stretch) >= decontaminate.ANSWER_SHARE * len(answer)):
            return True
    return False


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")


def planted(spark, benchmark, share, twin, seed=5):
    """A text per item with a share of its words changed, some behind a scrambled twin, amid the small documents."""
    rng = random.Random(seed)
    filler = [r["text"].split() for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 1500").orderBy("doc_id").limit(40).collect()]
    rows = []
    for n, item in enumerate(benchmark.orderBy("item_id").collect()):
        own = item["text"].split()
        changed = list(own)
        for at in rng.sample(range(len(own)), round(share * len(own))):
            changed[at] = f"other{rng.randrange(10**6)}"
        around = rng.choice(filler)
        before = rng.sample(own, len(own)) if twin else []
        rows.append((10_000 + n, " ".join([*around[:60], *before, *changed, *around[60:150]]), item["item_id"], item["text"]))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs.unionByName(spark.createDataFrame([r[:2] for r in rows], docs.schema)), rows


@pytest.mark.parametrize("share, twin, recall", [(0.0, False, 1.0), (0.1, False, 0.95), (0.2, False, 0.9), (0.2, True, 0.9)])
def test_reworded_items_are_found(spark, benchmark, share, twin, recall):
    docs, rows = planted(spark, benchmark, share, twin)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    expected = {(doc, item) for doc, text, item, whole in rows if holds(text, whole)}
    assert len(expected) >= 0.9 * len(rows)
    assert len(found & expected) >= recall * len(expected)


def test_nothing_is_found_that_does_not_hold_an_item(spark, benchmark):
    docs, _ = planted(spark, benchmark, 0.3, False)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    found = decontaminate.find_leaks(docs, benchmark).collect()
    assert found and all(holds(texts[r["doc_id"]], items[r["item_id"]]) for r in found)


def test_awkward_rows(spark, benchmark):
    item = benchmark.orderBy("item_id").first()
    rows = [(1, item["text"], "x"), (1, item["text"], "x"), (None, item["text"], "x"), (2, None, None), (3, "", ""), (4, "!!! ...", "y"), (5, "short", "z"),
            (6, "other words " * 30_000 + item["text"], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, terms string").withColumn("bad_id", F.lit(1)).withColumn("cosine", F.lit(2))
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()]
    assert sorted(found, key=repr) == sorted([(n, item["item_id"]) for n in (1, 1, None, 6)], key=repr)
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0 == decontaminate.find_leaks(docs, benchmark.limit(0)).count()
    unknown = spark.createDataFrame([(1, None), (2, "..."), (3, "")], "item_id long, text string")
    assert decontaminate.find_leaks(docs, unknown).count() == 0
