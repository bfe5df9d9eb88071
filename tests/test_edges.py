from functools import reduce

import pytest
from pyspark.sql import functions as F

from pageflow import operators as op
from pageflow.plans import fixtures as fx
from pageflow.schemas import EDGE_KEY
from pageflow.sources.lines import valid_edges

from conftest import SF, rows

SCHEMA = "referrer string, resource string, type string, count bigint, n int"


def edges(spark, *data):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(data)], SCHEMA)


def test_upsert_adds_counts_and_keeps_first_type(spark):
    df = edges(spark, ("a", "b", "link", 2), ("a", "b", "other", 3), ("b", "a", "x", 1))
    found = op.fold_edges(df.orderBy(F.desc("n")), ["n"])
    assert rows(found, "referrer", "resource", "type", "count") == [("a", "b", "link", 5), ("b", "a", "x", 1)]


def test_last_write_wins(spark):
    df = edges(spark, ("b", "a", "link", 2), ("b", "a", "link", 3), ("b", "a", "other", 9))
    assert rows(op.last_write_wins(df, ["n"])) == [("a", "b", "link", 3), ("a", "b", "other", 9)]


def test_trending_and_pairs(spark):
    df = edges(spark, ("a", "x", "link", 2), ("b", "x", "link", 3))
    assert rows(op.trending(df)) == [("x", 5)]
    assert rows(op.pairs(df)) == [("a", "x"), ("b", "x")]
    assert rows(op.symmetric_pairs(df)) == [("a", "x"), ("b", "x"), ("x", "a"), ("x", "b")]


def test_word_count_keeps_empty_words(spark):
    df = spark.createDataFrame([("a  a",)], "line string")
    assert rows(op.word_count(df, "line")) == [("", 1), ("a", 2)]


def test_key_report(spark):
    df = edges(spark, ("a", "b", "link", 2), ("a", "b", "other", 3), ("b", "a", "x", 1))
    assert rows(op.key_report(df, EDGE_KEY)) == [(3, 2, 1)]
    assert rows(op.key_report(df.limit(0), EDGE_KEY)) == [(0, 0, 0)]


@pytest.mark.parametrize("parts", [2, 7])
def test_folding_in_parts_changes_nothing(spark, parts):
    rows_in = valid_edges(fx.traffic_lines(spark, SF))
    whole = op.fold_edges(rows_in, fx.ORDER)
    partials = [
        op.fold_edges(rows_in.where(F.abs(F.hash("id", "pos")) % parts == k), fx.ORDER) for k in range(parts)
    ]
    merged = op.merge_edges(reduce(lambda a, b: a.unionByName(b), partials))
    assert rows(merged) == rows(whole)


def test_traffic_is_conserved_and_keys_are_unique(spark):
    rows_in = valid_edges(fx.traffic_lines(spark, SF))
    table = op.fold_edges(rows_in, fx.ORDER)
    assert table.agg(F.sum("count")).first()[0] == rows_in.agg(F.sum("count")).first()[0]
    assert op.key_report(table, EDGE_KEY).first()["n_excess"] == 0


def test_hot_pair_leaves_each_task_as_one_row(spark):
    plan = op.fold_edges(valid_edges(fx.traffic_lines(spark, SF)), fx.ORDER)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_pairs_are_sorted_by_a_hash_first(spark):
    """Names start alike; sorted by them, most comparisons would read two whole rows."""
    plan = op.fold_edges(edges(spark, ("a", "b", "link", 2)), ["n"])._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "- Sort [" in line]
    assert sorts and all(line.split("- Sort [")[1].split()[0].endswith("L") for line in sorts)  # a long, no name


def test_word_pairs_are_made_without_a_lambda(spark):
    texts = [(1, "a b\tc  d"), (2, "one"), (3, ""), (4, None), (None, "x y"), (5, " a"), (1, "a b\tc  d")]
    found = fx.bigram_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    pairs = [(1, 1, "a", "b_c"), (1, 2, "b_c", ""), (1, 3, "", "d")] * 2 + [(5, 1, "", "a"), (None, 1, "x", "y")]
    expected = [(fx.TEXTS, key, pos, "\t".join([a, b, "link", "1"])) for key, pos, a, b in pairs]
    assert rows(found, "src", "id", "pos", "value") == sorted(expected, key=lambda t: [(v is not None, v) for v in t])
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_index_needs_one_shuffle_and_is_distinct(spark):
    index = op.build_index(valid_edges(fx.traffic_lines(spark, SF)))
    assert index._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert op.key_report(index, ("word", "resource")).first()["n_excess"] == 0


def test_new_index_rows(spark):
    known = spark.createDataFrame([("a", "a b")], "word string, resource string")
    seen = spark.createDataFrame([("a", "a b"), ("b", "a b"), ("b", "a b")], "word string, resource string")
    assert rows(op.new_index_rows(known, seen)) == [("b", "a b")]
