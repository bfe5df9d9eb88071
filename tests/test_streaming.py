import gzip

import pytest
from pyspark.sql import functions as F

from pageflow import operators as op
from pageflow.plans import catalog, fixtures as fx
from pageflow.plans.store import EdgeStore, create_tables, open_search_tables, write_bucketed_tables, write_search_tables
from pageflow.sources.lines import accepted, normalise, parse_lines, parse_pairs, rejected, valid_edges
from pageflow.sources.ledger import append_ledger
from pageflow.sources.topic import stream_files
from pageflow.plans.ingest import ingest_stream
from pageflow.sources.ledger import read_ledger_table
from pageflow.streaming import (
    BatchCounters, answer_stream, console_stream, edge_stream, index_stream, overwrite_stream, pair_stream, total_stream,
    trending_stream, word_count_stream,
)
from pageflow.streaming.answers import answers
from pageflow.streaming.metrics import load_once_stream
from pageflow.streaming.state import open_windows

from conftest import SF, rows

ORD = "src INT, id BIGINT, pos INT"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Damaged lines as six files."""
    path = f"file://{tmp_path_factory.mktemp('lines')}/in"
    lines = fx.dirty_lines(fx.traffic_lines(spark, SF)).repartition(6, "id")
    lines.write.parquet(path)
    return path, lines.schema


def batch_edges(spark, path):
    found = normalise(accepted(parse_lines(spark.read.parquet(path))))
    return rows(op.fold_edges(found, fx.ORDER).drop("ord"))


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch(spark, staged, tmp_path, files):
    path, schema = staged
    store = EdgeStore(f"file://{tmp_path}/store", ORD)
    run(edge_stream(stream_files(spark, path, schema, files), store, f"file://{tmp_path}/cp", once=True))
    expected = batch_edges(spark, path)
    assert rows(store.edges(spark)) == expected

    lines = spark.read.parquet(path)
    bad = spark.read.parquet(store.quarantine).count()
    assert bad == lines.count() - accepted(parse_lines(lines)).count() > 0


def test_replayed_batch_counts_once(spark, tmp_path):
    store = EdgeStore(f"file://{tmp_path}/store", "n INT")
    def batch(*data):
        return op.fold_edges(
            spark.createDataFrame(data, "referrer string, resource string, type string, count bigint, n int"), ["n"]
        )

    first = batch(("a", "b", "link", 2, 1))
    second = batch(("a", "b", "other", 3, 2), ("c", "d", "link", 1, 3))
    for number, partial in ((0, first), (1, second), (1, second), (0, first)):
        store.write_delta(partial, number)
    assert rows(store.edges(spark)) == [("a", "b", "link", 5), ("c", "d", "link", 1)]

    store.write_delta(batch(("a", "b", "late", 10, 0)), 2)
    assert rows(store.edges(spark)) == [("a", "b", "late", 15), ("c", "d", "link", 1)]


def test_a_rebased_store_goes_on_where_the_old_one_stopped(spark, staged, tmp_path):
    path, schema = staged
    lines, source = spark.read.parquet(path), f"file://{tmp_path}/in"
    store = EdgeStore(f"file://{tmp_path}/store", ORD)
    half = F.abs(F.hash("id", "pos")) % 2
    for k in (0, 1):
        lines.where(half == k).write.mode("append").parquet(source)
        run(edge_stream(stream_files(spark, source, schema), store, f"file://{tmp_path}/cp", once=True))
        if k == 0:
            store = store.rebase(spark, f"file://{tmp_path}/store2")
    assert rows(store.edges(spark)) == batch_edges(spark, path)
    assert rows(store.read_deltas(spark).select("batch_id").distinct()) == [(-1,), (1,)]


def test_empty_store(spark, tmp_path):
    store = EdgeStore(f"file://{tmp_path}/none", ORD)
    assert store.edges(spark).count() == 0


def test_restarted_stream_takes_only_new_files(spark, staged, tmp_path):
    path, schema = staged
    store = EdgeStore(f"file://{tmp_path}/store", ORD)
    source = f"{tmp_path}/in"
    lines = spark.read.parquet(path)
    half = F.abs(F.hash("id", "pos")) % 2
    for k in (0, 1):
        lines.where(half == k).write.mode("append").parquet(f"file://{source}")
        run(edge_stream(stream_files(spark, f"file://{source}", schema), store, f"file://{tmp_path}/cp", once=True))
    assert rows(store.edges(spark)) == batch_edges(spark, path)
    assert store.read_deltas(spark).select("batch_id").distinct().count() == 2


def test_pairs_to_two_sinks(spark, staged, tmp_path):
    path, schema = staged
    table, documents, aside = (f"file://{tmp_path}/{n}" for n in "tda")
    source = stream_files(spark, path, schema, 3)
    query = pair_stream(source, table, documents, f"file://{tmp_path}/cp", once=True, aside_path=aside)
    run(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == spark.read.parquet(path).count()
    parsed = parse_pairs(spark.read.parquet(path))
    expected = rows(op.pairs(accepted(parsed)))
    assert rows(spark.read.parquet(table), "referrer", "resource") == expected
    assert rows(spark.read.json(documents), "referrer", "resource") == expected
    assert rows(spark.read.schema("value string").parquet(aside)) == rows(rejected(parsed), "value")


def test_a_pair_needs_two_fields_only(spark):
    lines = spark.createDataFrame([(v,) for v in ("a\tb", "a\tb\tlink\tx", "a", "\ta", "a\t\tlink\t1", None)], "value string")
    assert rows(op.pairs(accepted(parse_pairs(lines)))) == [("a", "b"), ("a", "b")]


def test_a_batch_is_fetched_once(spark, staged, tmp_path):
    path, schema = staged
    store = EdgeStore(f"file://{tmp_path}/store", ORD)
    query = edge_stream(stream_files(spark, path, schema, 2), store, f"file://{tmp_path}/cp", once=True)
    run(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == spark.read.parquet(path).count()


def test_a_later_batch_never_changes_a_type(spark, tmp_path):
    """Of a topic's messages the batch counts first, whatever the producer's clock says."""
    schema = "value string, timestamp timestamp, partition int, offset bigint"
    store, source = EdgeStore(f"file://{tmp_path}/store"), f"file://{tmp_path}/in"
    for value, time in (("a\tb\tlink\t2", "2024-01-02 00:00:00"), ("a\tb\tother\t3", "2024-01-01 00:00:00")):
        row = spark.sql(f"SELECT '{value}' AS value, timestamp'{time}' AS timestamp, 0 AS partition, 0L AS offset")
        row.write.mode("append").parquet(source)
        run(edge_stream(stream_files(spark, source, schema), store, f"file://{tmp_path}/cp", once=True))
    assert rows(store.edges(spark)) == [("a", "b", "link", 5)]


@pytest.mark.parametrize("files", [1, 3])
def test_totals_and_index_from_the_state_store(spark, staged, tmp_path, files):
    """Two runs, so that the second takes up the state of the first."""
    path, schema = staged
    lines, source = spark.read.parquet(path), f"file://{tmp_path}/in"
    totals, index = f"file://{tmp_path}/totals", f"file://{tmp_path}/index"
    half = F.abs(F.hash("id", "pos")) % 2
    for k in (0, 1):
        lines.where(half == k).write.mode("append").parquet(source)
        arriving = stream_files(spark, source, schema, files)
        run(total_stream(arriving, totals, list(fx.ORDER), f"file://{tmp_path}/cp1", once=True))
        run(index_stream(arriving, index, f"file://{tmp_path}/cp2", once=True))
    expected = batch_edges(spark, path)
    assert rows(op.newest_totals(spark.read.parquet(totals)), "referrer", "resource", "type", "count") == expected
    edges = spark.createDataFrame(expected, "referrer string, resource string, type string, count bigint")
    assert rows(spark.read.parquet(index)) == rows(op.build_index(edges))
    # a batch writes the pairs it changed, not the table
    batches = {r["batch_id"]: r["count"] for r in spark.read.parquet(totals).groupBy("batch_id").count().collect()}
    assert len(batches) >= 2 and max(batches.values()) < len(expected)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_layouts_open_in_the_buckets_they_were_written_in(spark, tmp_path):
    data = [("r", f"page {k}", "link", k) for k in range(50)]
    edges = spark.createDataFrame(data, "referrer string, resource string, type string, count bigint")
    write_search_tables(edges, f"file://{tmp_path}/layout", buckets=5)
    tables = open_search_tables(spark, f"file://{tmp_path}/layout")
    wanted = spark.createDataFrame([(f"page {k}",) for k in range(50)], "resource string")
    assert tables.by_resource.find(wanted).count() == 50
    assert tables.by_resource.find_one("page 7").count() == 1


def test_keyed_overwrite_stream(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for n, count in enumerate((2, 7, 3)):
        spark.sql(f"SELECT 'a\tb\tlink\t{count}' AS value, {n} AS n").write.mode("append").parquet(source)
    stream = stream_files(spark, source, spark.read.parquet(source).schema, files_per_trigger=1)
    run(overwrite_stream(stream, out, ["n"], f"file://{tmp_path}/cp", once=True))
    written = spark.read.parquet(out)
    assert written.select("batch_id").distinct().count() == 3
    assert rows(op.newest_writes(written).drop("ord")) == [("b", "a", "link", 3)]


def test_word_counts_are_per_batch(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    for text in ("a b", "a  a"):
        spark.createDataFrame([(text,)], "line string").coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(spark, source, spark.read.parquet(source).schema, files_per_trigger=1)
    run(word_count_stream(stream, "line", f"file://{tmp_path}/out", f"file://{tmp_path}/cp", once=True))
    counted = spark.read.parquet(f"file://{tmp_path}/out")
    assert counted.select("batch_id").distinct().count() == 2
    assert rows(counted, "word", "n") == [("", 1), ("a", 1), ("a", 2), ("b", 1)]


def test_a_trigger_counts_many_batches_each_on_its_own(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    data = [(text,) for text in ("a b", "a  a", "b b", None, "a")]
    spark.createDataFrame(data, "line string").coalesce(1).write.option("maxRecordsPerFile", 2).parquet(source)
    stream = stream_files(spark, source, spark.read.parquet(source).schema, files_per_trigger=2)
    batches = stream.select("line", F.col("_metadata.file_name").alias("batch"))
    run(word_count_stream(batches, "line", f"file://{tmp_path}/out", f"file://{tmp_path}/cp", once=True, within=["batch"]))
    counted = spark.read.parquet(f"file://{tmp_path}/out")
    assert counted.select("batch_id").distinct().count() == 2
    assert rows(counted, "word", "n") == [("", 1), ("a", 1), ("a", 3), ("b", 1), ("b", 2)]
    assert counted.where("word = 'a'").select("batch").distinct().count() == 2


def test_batches_of_a_table_share_triggers(spark, tmp_path, monkeypatch):
    texts = spark.range(40).selectExpr("id AS doc_id", "concat('w', id % 3, ' x') AS text").coalesce(1)
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    started = []
    monkeypatch.setattr(catalog, "BATCH_ROWS", 5)
    monkeypatch.setattr(catalog, "word_count_stream", lambda *a, **k: started.append(word_count_stream(*a, **k)) or started[-1])
    assert rows(catalog.batched_word_count(spark, str(tmp_path))) == [("w0", 14), ("w1", 13), ("w2", 13), ("x", 40)]
    assert len([p for p in started[0].recentProgress if p["numInputRows"]]) == 1  # eight files


def test_windows_close_behind_the_watermark(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    data = [
        ("2024-01-01 00:01:00", "x\tA\tlink\t2"), ("2024-01-01 00:09:00", "y\ta\tlink\t3"),
        ("2024-01-01 00:12:00", "y\ta\tlink\t5"), ("2024-01-01 00:25:00", "y\tb\tlink\t1"), ("2024-01-01 00:03:00", "bad"),
    ]
    df = spark.createDataFrame(data, "t string, value string").selectExpr("timestamp(t) AS ts", "value")
    df.write.parquet(source)
    run(trending_stream(
        stream_files(spark, source, df.schema), "ts", f"file://{tmp_path}/out", f"file://{tmp_path}/cp", once=True
    ))
    found = spark.read.parquet(f"file://{tmp_path}/out").selectExpr("string(window_start)", "search_term", "traffic_count")
    assert rows(found) == [("2024-01-01 00:00:00", "a", 5)]


def test_open_and_closed_windows_are_all_windows(spark, tmp_path):
    source, out, progress = (f"file://{tmp_path}/{n}" for n in ("in", "out", "cp"))
    data = [(f"2024-01-01 0{h}:{m:02}:00", f"x\tp{m % 3}\tlink\t{m + 1}") for h in range(3) for m in range(0, 60, 7)]
    df = spark.createDataFrame(data, "t string, value string").selectExpr("timestamp(t) AS ts", "value")
    df.write.parquet(source)
    run(trending_stream(stream_files(spark, source, df.schema), "ts", out, progress, once=True))
    closed, still = spark.read.parquet(out), open_windows(spark, progress)
    assert closed.count() and still.count()
    whole = op.trending_by_window(valid_edges(df), "ts")
    assert rows(closed.unionByName(still)) == rows(whole)


def test_counters_of_a_running_stream(spark, tmp_path):
    source, out, progress = (f"file://{tmp_path}/{n}" for n in ("in", "out", "cp"))
    loads = [
        [(1, "10:00", "a\tb\tlink\t2"), (2, "10:30", "a\tb\tlink\t3"), (3, "10:30", "bad")],
        [(2, "10:30", "a\tb\tlink\t3"), (4, "10:05", "a\tb\tlink\t9"), (5, "10:25", "c\td\tlink\t1")],
    ]
    counters = BatchCounters()
    spark.streams.addListener(counters)
    try:
        for load in loads:
            df = spark.createDataFrame(load, "id int, t string, value string").selectExpr("id", "timestamp('2024-01-01 ' || t) AS ts", "value")
            df.coalesce(1).write.mode("append").parquet(source)
            counters.wait(load_once_stream(stream_files(spark, source, df.schema), "id", "ts", out, progress, once=True))
    finally:
        spark.streams.removeListener(counters)
    found = rows(counters.table(spark), "n_lines", "n_valid", "n_quarantined", "traffic", "n_late")
    assert found == sorted([(3, 2, 1, 5, 0), (3, 3, 0, 13, 1)])
    assert rows(spark.read.parquet(out), "id", "count") == [(1, 2), (2, 3), (5, 1)]


def test_terms_are_answered_as_they_arrive(spark, tmp_path):
    data = [("other-search", "abba", "link", 5), ("abba", "abba gold", "link", 3), ("abba gold", "abba", "link", 2)]
    edges = spark.createDataFrame(data, "referrer string, resource string, type string, count bigint")
    batches = [[("abba",), ("nothing",), ("!!!",)], [("abba gold",), ("abba",), ("abba",), (None,)]]
    every = spark.createDataFrame(sum(batches, []), "term string")
    kinds = {
        "plain": op.SearchTables.of(edges, op.build_index(edges)),
        "folders": write_search_tables(edges, f"file://{tmp_path}/layout", buckets=3),
        "bucketed": write_bucketed_tables(edges, "answer_test", f"file://{tmp_path}/bucketed", buckets=4, slices=2),
    }
    expected = rows(op.response_text(op.search(kinds["plain"], every)))
    for name, tables in kinds.items():
        source, path, progress = (f"file://{tmp_path}/{name}-{n}" for n in ("in", "out", "cp"))
        for terms in batches:
            spark.createDataFrame(terms, "term string").coalesce(1).write.mode("append").parquet(source)
            run(answer_stream(stream_files(spark, source, every.schema), tables, path, progress, once=True))
        assert rows(op.response_text(answers(spark.read.parquet(path)))) == expected, name


def test_a_growing_folder_is_ingested_once(spark, tmp_path):
    root, path, ledger, progress, archive = (f"file://{tmp_path}/{n}" for n in ("dumps", "out", "ledger", "cp", "archive"))

    def dump(month, *values):
        folder = tmp_path / "dumps" / month
        folder.mkdir(parents=True)
        with gzip.open(folder / f"clickstream-enwiki-{month}.tsv.gz", "wt") as out:
            out.write("\n".join(values) + "\n")

    def load():
        run(ingest_stream(spark, root, path, ledger, progress, archive=archive))
        return rows(spark.read.parquet(path), "month", "batch_id", "referrer", "resource", "count", "n_lines")

    dump("2020-01", "a\tb\tlink\t1", "a\tb\tlink\t2", "bad")
    dump("2020-02", "a\tb\tlink\t5")
    first = [("2020-01", 0, "a", "b", 3, 2), ("2020-02", 0, "a", "b", 5, 1)]
    assert load() == first and load() == first
    dump("2020-03", "c\td\tlink\t7")
    dump("2020-04", "bad")
    assert load() == [*first, ("2020-03", 1, "c", "d", 7, 1)]
    assert rows(read_ledger_table(spark, ledger)) == [("2020-01",), ("2020-02",), ("2020-03",)]
    dump("2020-05", "c\td\tlink\t7")
    load()
    archived = {f.name[-14:-7] for f in (tmp_path / "archive").rglob("*.gz")}
    assert {"2020-01", "2020-02"} <= archived


def test_console_sink(spark, staged, tmp_path):
    path, schema = staged
    query = console_stream(valid_edges(stream_files(spark, path, schema)), f"file://{tmp_path}/cp", once=True)
    run(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == spark.read.parquet(path).count()


def test_catalog_tables(spark, tmp_path):
    folder = f"file://{tmp_path}/ledger"
    append_ledger(spark.createDataFrame([("2018-01",)], "date string"), folder)
    for _ in range(2):
        create_tables(spark, "pageflow_test", {"dates": folder})
    assert rows(spark.table("pageflow_test.dates")) == [("2018-01",)]
    spark.sql("DROP DATABASE pageflow_test CASCADE")
