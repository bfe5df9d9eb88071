"""Search semantics on a few pages, and the stored layouts."""

import json
import sys

import pytest
from pyspark.sql import functions as F

from pageflow import operators as op
from pageflow.plans.store import open_bucketed_tables, write_bucketed_tables, write_point_tables, write_search_tables

from conftest import rows

EDGES = [
    ("other-search", "abba", "external", 50),
    ("abba", "abba  band ", "link", 7),
    ("abba", "abba gold", "link", 7),
    ("abba gold", "abba", "link", 9),
    ("other-empty", "the the", "external", 4),
    ("abba", "other search", "link", 3),
    ("other-search", "other search", "external", 2),
    ("abba", "i walrus", "link", 1),
    ("abba", "bandana abba", "link", 1),
    ("abba", "gold the rush", "link", 2),
]


@pytest.fixture(scope="module")
def tables(spark):
    edges = spark.createDataFrame(EDGES, "referrer string, resource string, type string, count bigint")
    return op.SearchTables.of(edges, op.build_index(edges))


def prepared(spark, *terms):
    return op.prepare_terms(spark.createDataFrame([(t,) for t in terms], "term string"))


def selected(spark, tables, term):
    found = op.select_pages(tables.index, prepared(spark, term)).collect()
    return found[0]["selected"] if found else None


def related(spark, tables, term):
    return [r[0] for r in rows(op.related_pages(tables.index, prepared(spark, term)), "resource")]


def test_related_is_or_and_fallback_is_and_by_substring(spark, tables):
    assert related(spark, tables, "abba gold") == [
        "abba", "abba  band ", "abba gold", "bandana abba", "gold the rush"
    ]
    assert selected(spark, tables, "abba gold") == "abba gold"
    assert selected(spark, tables, "gold rush") == "gold the rush"
    assert selected(spark, tables, "gold rus") == "gold the rush"


def test_collapsed_term_reaches_uncollapsed_page_only_by_fallback(spark, tables):
    best = op.select_pages(tables.index, prepared(spark, "ABBA band")).first()
    assert (best["selected"], best["is_exact"]) == ("abba  band ", False)
    assert op.select_pages(tables.index, prepared(spark, "ABBA")).first()["is_exact"]


def test_stop_words_stay_in_the_term(spark, tables):
    assert "abba" in related(spark, tables, "the abba")
    assert selected(spark, tables, "the abba") is None
    assert selected(spark, tables, "the gold") == "gold the rush"


def test_pages_of_stop_words_are_not_indexed(spark, tables):
    assert related(spark, tables, "the the") == []


def test_small_i_is_indexed(spark, tables):
    assert related(spark, tables, "I") == ["i walrus"]


def test_sentinels_are_indexed_by_their_words_only(spark, tables):
    assert related(spark, tables, "other-search") == ["other search"]


def test_ties_go_to_the_first_word_then_the_name(spark, tables):
    assert op.select_first(tables.index, prepared(spark, "gold abba")).first()["selected"] == "abba gold"
    ranked = op.ranked_pages(tables.index, prepared(spark, "gold gold abba"))
    assert rows(ranked, "rank", "resource", "matches") == [
        (1, "abba gold", 3), (2, "gold the rush", 2), (3, "abba", 1), (4, "abba  band ", 1), (5, "bandana abba", 1)
    ]


def test_incoming_and_outgoing_are_ranked_by_count(spark, tables):
    resolved = op.resolve_terms(tables.index, prepared(spark, "abba"))
    into = op.by_traffic(op.incoming(tables, resolved), "referrer")
    assert rows(into, "rank", "referrer", "count") == [(1, "other-search", 50), (2, "abba gold", 9)]
    out = op.by_traffic(op.outgoing(tables, resolved), "resource")
    assert rows(out, "rank", "resource", "count")[:3] == [(1, "abba  band ", 7), (2, "abba gold", 7), (3, "other search", 3)]


def test_direct_lookup_needs_no_index(spark, tables):
    found = op.direct_lookup(tables, prepared(spark, "Other Search!", "!!!"))
    assert rows(found, "section", "referrer") == [("incoming", "abba"), ("incoming", "other-search")]


def answer(df, term, section):
    pages = op.response_text(df).where(F.col("term") == term)
    return [r[section] for r in pages.orderBy("page").collect()]


def test_response(spark, tables):
    terms = spark.createDataFrame([("abba",), ("!!!",), ("nothing",), ("the abba",)], "term string")
    found = op.search(tables, terms, page_rows=2).cache()
    assert answer(found, "abba", "related") == ["Abba Band , Abba Gold", "Bandana Abba", ""]
    assert answer(found, "abba", "incoming") == ["other-search|Abba|external|50, Abba Gold|Abba|link|9", "", ""]
    assert [p.count(", ") + 1 for p in answer(found, "abba", "outgoing")] == [2, 2, 2]
    states = {(r["term"], r["status"], r["selected"]) for r in found.collect()}
    assert states == {
        ("abba", "ok", "Abba"), ("!!!", "invalid", None), ("nothing", "ok", None), ("the abba", "ok", None)
    }
    for term in ("!!!", "nothing"):
        assert all(answer(found, term, s) == [""] for s in ("related", "incoming", "outgoing"))
    assert sum(found.where("term = 'the abba'").select(F.size("related")).toPandas().iloc[:, 0]) == 4
    assert found.where("size(related) > 2 OR size(incoming) > 2 OR size(outgoing) > 2").count() == 0


def test_json_answers(spark, tables):
    terms = spark.createDataFrame([("abba gold",), ("!!!",), ("nothing",)], "term string")
    answers = {r["term"]: json.loads(r["json"]) for r in op.response_json(op.search(tables, terms)).collect()}
    assert answers["!!!"] == {"error": "Search term is required"}
    assert answers["nothing"] == {
        "relatedResources": [],
        "selectedResourceData": {"selectedResource": None, "incoming": [], "outgoing": []},
    }
    assert answers["abba gold"] == {
        "relatedResources": ["Abba", "Abba Band ", "Bandana Abba", "Gold The Rush"],
        "selectedResourceData": {
            "selectedResource": "Abba Gold",
            "incoming": [{"referrer": "Abba", "resource": "Abba Gold", "type": "link", "count": 7}],
            "outgoing": [{"referrer": "Abba Gold", "resource": "Abba", "type": "link", "count": 9}],
        },
    }


def test_stored_layouts_answer_alike_and_prune(spark, tables, tmp_path):
    stored = write_search_tables(tables.by_resource.rows, f"file://{tmp_path}/s", buckets=5)
    terms = spark.createDataFrame([("abba",), ("gold rush",)], "term string")
    plain = op.response_text(op.search(tables, terms))
    assert rows(op.response_text(op.search(stored, terms))) == rows(plain)
    one = stored.by_referrer.find_one("abba gold")
    assert rows(one) == [("abba gold", "abba", "link", 9)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    found = op.related_pages(stored.index, prepared(spark, "abba"))
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_many_terms_join_by_shuffle_alike(spark, tables, monkeypatch):
    terms = spark.createDataFrame([("abba",), ("gold rush",), ("abba gold",), ("!!!",)], "term string")
    expected = rows(op.response_text(op.search(tables, terms)))
    joins, searching = sys.modules["pageflow.operators.joins"], sys.modules["pageflow.operators.search"]
    split = joins.split_join
    for module in (joins, searching):
        monkeypatch.setattr(module, "fits_broadcast", lambda *args: False)
    monkeypatch.setattr(joins, "split_join", lambda big, lookup, on, _, spread: split(big, lookup, on, 1, spread))
    assert rows(op.response_text(op.search(tables, terms))) == expected


def test_hot_referrer_covers_several_files(many_partitions, tmp_path):
    spark = many_partitions
    edges = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("r"), "id")).alias("referrer"),
        F.concat(F.lit("p"), "id").alias("resource"),
        F.lit("link").alias("type"),
        F.col("id").alias("count"),
    )
    stored = write_search_tables(edges, f"file://{tmp_path}/s", buckets=3)
    hot = stored.by_referrer.rows.where("referrer = 'hot'").select(F.input_file_name().alias("f")).distinct()
    assert hot.count() > 2
    assert stored.by_referrer.rows.count() == 4000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_by_shuffle_do_not_store_the_table(spark, tables):
    wanted = spark.createDataFrame([("abba", 1), ("gold the rush", 2)], "resource string, term int")
    found = tables.by_resource.find(wanted, fits=False)
    assert rows(found) == rows(tables.by_resource.find(wanted, fits=True))
    assert "join-lookup" in plan_of(found) and "join-big" not in plan_of(found)


def test_a_layout_counts_and_reads_wanted_buckets_only(spark, tables, tmp_path):
    stored = write_search_tables(tables.by_resource.rows, f"file://{tmp_path}/s", buckets=50)
    found = stored.by_resource.find(spark.createDataFrame([("abba", 1)], "resource string, term int"), fits=False)
    assert rows(found, "referrer") == [("abba gold",), ("other-search",)]
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(found)


@pytest.fixture(scope="module")
def bucketed(spark, tables, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('bucketed')}"
    write_bucketed_tables(tables.by_resource.rows, "search_test", root, buckets=8, slices=4)
    return open_bucketed_tables(spark, "search_test")


def test_bucketed_tables_answer_alike(spark, tables, bucketed):
    terms = spark.createDataFrame([("abba",), ("gold rush",), ("abba gold",), ("!!!",), (None,)], "term string")
    expected = rows(op.response_text(op.search(tables, terms)))
    assert rows(op.response_text(op.search(bucketed, terms))) == expected
    assert rows(op.response_text(op.search(bucketed, terms, broadcast_rows=0))) == expected
    assert rows(bucketed.by_referrer.find_one("abba gold"), "resource") == [("abba",)]


@pytest.mark.parametrize("many", [3, 300_000])
def test_bucketed_tables_are_not_moved(spark, bucketed, many):
    wanted = spark.range(many).select(F.concat(F.lit("page "), "id").alias("resource"), F.col("id").alias("term"))
    found = bucketed.by_resource.find(wanted, fits=False)
    side = plan_of(found).split("FileScan")[0]
    assert "SortMergeJoin" in side and "Exchange" not in side
    assert plan_of(found).count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 8 out of 8" in plan_of(found)


def test_a_hot_page_lies_in_several_buckets(spark, tmp_path):
    edges = spark.range(2000).select(
        F.concat(F.lit("r"), "id").alias("referrer"), F.lit("hot").alias("resource"), F.lit("link").alias("type"), F.col("id").alias("count")
    )
    stored = write_bucketed_tables(edges, "hot_test", f"file://{tmp_path}/b", buckets=8, slices=4)
    files = stored.by_resource.rows.select(F.input_file_name()).distinct().count()
    assert 2 <= files <= 4
    assert stored.by_resource.find(spark.sql("SELECT 'hot' AS resource, 1 AS term"), fits=False).count() == 2000


def test_top_pages_are_the_first_of_the_ranking(spark, tables):
    asked = prepared(spark, "gold gold abba", "abba", "nothing")
    top = op.top_pages(tables.index, asked, k=2)
    ranked = op.ranked_pages(tables.index, asked).where("rank <= 2")
    assert rows(top, "term", "rank", "resource", "matches") == rows(ranked, "term", "rank", "resource", "matches")
    assert plan_of(top).count("WindowGroupLimit") == 2


def read_by_scan(df):
    """Rows that leave the scan of the row groups it reads, before the filter."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    leaves, n = execution.executedPlan().collectLeaves(), 0
    for k in range(leaves.size()):
        n += leaves.apply(k).metrics().apply("numOutputRows").value()
    return n


def test_point_lookups_skip_row_groups_by_either_end(spark, tmp_path):
    edges = spark.range(200_000).select(
        F.concat(F.lit("from "), F.hash("id")).alias("referrer"), F.concat(F.lit("to "), F.xxhash64("id")).alias("resource"),
        F.lit("link").alias("type"), F.col("id").alias("count"),
    ).coalesce(2)
    stored = write_point_tables(edges, f"file://{tmp_path}/p", group_bytes=256 << 10)
    row = edges.where("id = 777").first()
    for table, value in ((stored.by_resource, row["resource"]), (stored.by_referrer, row["referrer"])):
        found = table.find_one(value)
        assert rows(found, "count") == [(777,)] and 0 < read_by_scan(found) < 60_000
    # an absent page lies between the bounds of every row group; only the filters rule it out
    assert read_by_scan(stored.by_resource.find_one("to 1absent")) < 60_000
    assert read_by_scan(stored.by_resource.find_one("to 1absent")) == 0
    plain = f"file://{tmp_path}/plain"
    stored.by_resource.rows.write.option("parquet.block.size", 256 << 10).parquet(plain)
    assert read_by_scan(spark.read.parquet(plain).where("resource = 'to 1absent'")) > 100_000
