"""Every query of the library over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import operators as op
from ..functions.text import display_name
from ..schemas import DESTINATION_KEY, EDGE_KEY, INDEX_KEY
from ..session import pin, spread, work_path
from ..sources.ledger import (
    anchor_texts, append_ledger, export_ledger, listed_months, merge_ledger, new_months, read_ledger_file, read_ledger_table,
)
from ..sources.lines import (
    DUMP_ORDER, accepted, normalise, parse_lines, parse_pairs, read_dumps, read_folder, rejected, valid_edges,
)
from ..sources.topic import publish_to_files, stream_files
from ..functions.sql import register_functions
from ..streaming.answers import answer_stream, answers
from ..streaming.jobs import (
    edge_stream, index_stream, overwrite_stream, pair_stream as pairs_to_sinks, total_stream, trending_stream, word_count_stream,
)
from ..streaming.metrics import BatchCounters, load_once_stream
from ..streaming.state import open_windows
from . import fixtures as fx
from .ingest import ingest_metrics, ingest_months, ingest_stream as load_new_files
from .store import EdgeStore, write_bucketed_tables, write_point_tables, write_search_tables

LINE_ORD = "src INT, id BIGINT, pos INT"
ORDER = list(fx.ORDER)

Query = Callable[[SparkSession, str], DataFrame]


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


# --- lines and edges ---------------------------------------------------------


def clean_edges(spark: SparkSession, sf: str) -> DataFrame:
    return valid_edges(fx.traffic_lines(spark, sf))


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return fx.dirty_lines(fx.traffic_lines(spark, sf))


def edge_table(spark: SparkSession, sf: str) -> DataFrame:
    return op.fold_edges(clean_edges(spark, sf), ORDER).drop("ord")


def parse_lenient(spark: SparkSession, sf: str) -> DataFrame:
    rows = accepted(parse_lines(dirty(spark, sf))).drop("value")
    return _long(rows, "src", "pos")


def parse_strict(spark: SparkSession, sf: str) -> DataFrame:
    rows = accepted(parse_lines(dirty(spark, sf), strict=True)).drop("value")
    return _long(rows, "src", "pos")


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = rejected(parse_lines(dirty(spark, sf), strict=True))
    return _long(rows.select("src", "id", "pos", "value"), "src", "pos")


def normalize_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _long(normalise(accepted(parse_lines(dirty(spark, sf)))).drop("value"), "src", "pos")


def edge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return edge_table(spark, sf)


def trending_topics(spark: SparkSession, sf: str) -> DataFrame:
    return op.trending(clean_edges(spark, sf))


def last_write_wins(spark: SparkSession, sf: str) -> DataFrame:
    return op.last_write_wins(clean_edges(spark, sf), ORDER)


def pair_projection(spark: SparkSession, sf: str) -> DataFrame:
    return op.pairs(accepted(parse_pairs(dirty(spark, sf))))


def symmetric_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Both directions, appended to a table by two loads: the page lines, then the catalogue lines."""
    path = work_path(spark, "symmetric")
    for lines in (fx.page_lines(fx.table(spark, sf, "pages")), fx.catalogue_lines(fx.table(spark, sf, "part"))):
        op.symmetric_pairs(accepted(parse_pairs(fx.dirty_lines(lines)))).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    edges = pin(edge_table(spark, sf), "edges")
    tables = {
        "referrer_resource": (edges, EDGE_KEY),
        "search_index": (op.build_index(edges), INDEX_KEY),
        "resource_destination": (last_write_wins(spark, sf), DESTINATION_KEY),
        "trending_topics": (op.trending(edges), ("search_term",)),
    }
    reports = [op.key_report(t, k).withColumn("table_name", F.lit(n)) for n, (t, k) in tables.items()]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return op.word_count(spread(fx.table(spark, sf, "documents").select("text")), "text")


# --- index and search --------------------------------------------------------


def page_index(spark: SparkSession, sf: str) -> DataFrame:
    return op.build_index(clean_edges(spark, sf))


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    return pin(op.prepare_terms(fx.search_terms(spark, sf)), "terms")


def _keyed_index(spark: SparkSession, sf: str) -> op.Keyed:
    return op.Keyed(page_index(spark, sf), "word", "resource")


def _pinned_tables(edges: DataFrame, index_too: bool = False) -> op.SearchTables:
    """Edges stored for the two lookups at their ends; the index too where it is read more than once."""
    stored = pin(edges, "edges")
    index = op.build_index(stored)
    return op.SearchTables.of(stored, pin(index, "index") if index_too else index)


def _resolved(spark: SparkSession, sf: str, tables: op.SearchTables) -> DataFrame:
    return op.resolve_terms(tables.index, _terms(spark, sf))


def search_index(spark: SparkSession, sf: str) -> DataFrame:
    return page_index(spark, sf)


def index_increment(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows that the catalogue lines add to an index of the page lines."""
    known = op.build_index(valid_edges(fx.page_lines(fx.table(spark, sf, "pages"))))
    added = op.build_index(valid_edges(fx.catalogue_lines(fx.table(spark, sf, "part"))))
    return op.new_index_rows(known, added, distinct=True)


def term_tokens(spark: SparkSession, sf: str) -> DataFrame:
    prepared = op.prepare_terms(fx.search_terms(spark, sf))
    words = prepared.select("term", "norm", "status", F.posexplode("words").alias("position", "word"))
    return _long(words, "position")


def search_related(spark: SparkSession, sf: str) -> DataFrame:
    return _long(op.related_pages(_keyed_index(spark, sf), _terms(spark, sf)), "first_word")


def search_select(spark: SparkSession, sf: str) -> DataFrame:
    return op.select_pages(_keyed_index(spark, sf), _terms(spark, sf))


def search_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return _long(op.ranked_pages(_keyed_index(spark, sf), _terms(spark, sf)), "first_word", "rank")


TOP_PAGES = 10


def search_top(spark: SparkSession, sf: str) -> DataFrame:
    return _long(op.top_pages(_keyed_index(spark, sf), _terms(spark, sf), TOP_PAGES), "first_word", "rank")


def sql_index(spark: SparkSession, sf: str) -> DataFrame:
    """The word index in SQL text alone, by the functions that :func:`register_functions` gives a session."""
    register_functions(spark)
    return spark.sql(
        """
        SELECT w.word, p.resource
        FROM (
          SELECT DISTINCT norm_resource(l.resource) AS resource
          FROM {lines} AS t, LATERAL line_fields(t.value) AS l
          WHERE l.count IS NOT NULL AND l.referrer <> '' AND l.resource <> '') AS p,
        LATERAL index_words(p.resource) AS w
        """,
        lines=fx.traffic_lines(spark, sf),
    )


def search_first(spark: SparkSession, sf: str) -> DataFrame:
    return op.select_first(_keyed_index(spark, sf), _terms(spark, sf))


def direct_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return op.direct_lookup(_pinned_tables(edge_table(spark, sf)), _terms(spark, sf))


def search_incoming(spark: SparkSession, sf: str) -> DataFrame:
    tables = _pinned_tables(edge_table(spark, sf))
    found = op.incoming(tables, _resolved(spark, sf, tables))
    return _long(op.by_traffic(found, "referrer").drop("status"), "rank")


def search_outgoing(spark: SparkSession, sf: str) -> DataFrame:
    tables = _pinned_tables(edge_table(spark, sf))
    found = op.outgoing(tables, _resolved(spark, sf, tables))
    return _long(op.by_traffic(found, "resource").drop("status"), "rank")


def title_case(spark: SparkSession, sf: str) -> DataFrame:
    edges = clean_edges(spark, sf)
    names = edges.select(F.explode(F.array("referrer", "resource")).alias("name")).distinct()
    return names.withColumn("display", display_name(F.col("name")))


def traffic_series(spark: SparkSession, sf: str) -> DataFrame:
    tables = _pinned_tables(edge_table(spark, sf))
    return _long(op.traffic_series(tables, _resolved(spark, sf, tables)), "rank")


RESPONSE_PAGE_ROWS = 100


def _answers(spark: SparkSession, sf: str, tables: op.SearchTables) -> DataFrame:
    return op.response_text(op.search(tables, fx.search_terms(spark, sf), RESPONSE_PAGE_ROWS))


def search_json(spark: SparkSession, sf: str) -> DataFrame:
    tables = _pinned_tables(edge_table(spark, sf), index_too=True)
    return op.response_json(op.search(tables, fx.search_terms(spark, sf), RESPONSE_PAGE_ROWS))


def _limited(tables: op.SearchTables, **limits: int) -> op.SearchTables:
    return op.SearchTables(*(replace(t, **limits) for t in (tables.by_resource, tables.by_referrer, tables.index)))


def search_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The same answers with every lookup joined by shuffle, and keys of more than a few rows cut."""
    tables = _pinned_tables(edge_table(spark, sf), index_too=True)
    limited = _limited(tables, broadcast_rows=0, rows_per_split=20)
    return op.response_text(op.search(limited, fx.search_terms(spark, sf), RESPONSE_PAGE_ROWS, broadcast_rows=0))


def _bucketed_tables(spark: SparkSession, sf: str) -> op.SearchTables:
    edges = pin(edge_table(spark, sf), "edges")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-edges.count() // 1_000_000))
    root = work_path(spark, "bucketed")
    return write_bucketed_tables(edges, "pages_" + root[-32:], root, buckets)


def search_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same answers from tables in Spark's buckets, with lookups as if there were too many to broadcast."""
    tables = _limited(_bucketed_tables(spark, sf), broadcast_rows=0)
    return op.response_text(op.search(tables, fx.search_terms(spark, sf), RESPONSE_PAGE_ROWS, broadcast_rows=0))


#: Words and pages looked up one by one, present ones and absent ones.
POINT_WORDS = ("small", "brand", "ring", "absent", "r")
POINT_PAGES = ("small ring", "economy brushed", "promo", "other-search", "absent")


def point_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Single lookups in one sorted copy of the edges, by either end, and in the index."""
    tables = write_point_tables(pin(edge_table(spark, sf), "edges"), work_path(spark, "points"))
    nothing = spark.createDataFrame([], "looked_up STRING, section STRING, referrer STRING, resource STRING")
    for word in POINT_WORDS:
        found = tables.index.find_one(word)
        nothing = nothing.unionByName(found.select(F.col("word").alias("looked_up"), F.lit("word").alias("section"), F.lit("").alias("referrer"), "resource"))
    for section, table in (("incoming", tables.by_resource), ("outgoing", tables.by_referrer)):
        for page in POINT_PAGES:
            found = table.find_one(page)
            nothing = nothing.unionByName(found.select(F.lit(page).alias("looked_up"), F.lit(section).alias("section"), "referrer", "resource"))
    return nothing


def search_response(spark: SparkSession, sf: str) -> DataFrame:
    """One set of terms over a fresh edge table: writing layouts first would cost more than it saves."""
    return _answers(spark, sf, _pinned_tables(edge_table(spark, sf), index_too=True))


def search_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same answers from the stored layouts that serve many searches."""
    edges = pin(edge_table(spark, sf), "edges")
    buckets = max(1, -(-edges.count() // 1_000_000))
    return _answers(spark, sf, write_search_tables(edges, work_path(spark, "store"), buckets))


# --- months ------------------------------------------------------------------


def extract_anchors(spark: SparkSession, sf: str) -> DataFrame:
    anchors = anchor_texts(fx.table(spark, sf, "pages").select("page_id", "html"))
    return _long(anchors, "position")


def months_to_load(spark: SparkSession, sf: str) -> DataFrame:
    return new_months(listed_months(fx.month_listing(spark, sf)), fx.loaded_months(spark, sf))


def updated_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger table after the new months are recorded, through its text form and back."""
    table, text = work_path(spark, "ledger"), work_path(spark, "ledger-text")
    append_ledger(fx.loaded_months(spark, sf), table)
    fresh = pin(new_months(listed_months(fx.month_listing(spark, sf)), read_ledger_table(spark, table)), "fresh")
    append_ledger(fresh, table)
    # the table is read again, not united with its earlier reading: Spark takes two scans of one path for the same
    export_ledger(merge_ledger(read_ledger_table(spark, table), fresh), text)
    return read_ledger_file(spark, text)


def _staged_dumps(spark: SparkSession, sf: str) -> str:
    """Lines as gzip dumps, one folder per month; files of a month in arrival order."""
    root = work_path(spark, "dumps")
    _write_dumps(pin(fx.dated_lines(fx.traffic_lines(spark, sf)), "dated"), root)
    return root


def _write_dumps(dated: DataFrame, root: str) -> None:
    (
        dated.repartitionByRange("month", *ORDER)
        .sortWithinPartitions("month", *ORDER)
        .select("value", "month")
        .write.mode("append")
        .partitionBy("month")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 5_000_000)
        .text(root)
    )


def dump_edge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert of staged dumps: the first line of a pair, by month, file and place, gives its type."""
    lines = read_dumps(spark, _staged_dumps(spark, sf), ordered=True)
    return op.fold_edges(valid_edges(lines), ["month", *DUMP_ORDER]).drop("ord")


def ingest_listed(spark: SparkSession, sf: str) -> DataFrame:
    """Names of a listing against staged dumps: traffic published, and whether the ledger has the name afterwards.

    Listed are the months of the dumps and one without a file; the ledger holds the first already.
    """
    root, ledger, published = (_staged_dumps(spark, sf), work_path(spark, "ledger"), work_path(spark, "published"))
    months = fx.dated_lines(fx.traffic_lines(spark, sf)).select("month").distinct()
    listed = months.union(spark.sql("SELECT '2019-13-extra'"))
    listing = listed.select(F.concat(F.lit("<A href='x'><b>"), "month", F.lit("/</b></A>")).alias("html"))
    append_ledger(spark.sql("SELECT '2018-01' AS date"), ledger)
    done = ingest_months(
        spark, listing, ledger, root, lambda lines: lines.write.text(published), file_pattern="*.txt.gz"
    )
    recorded = read_ledger_table(spark, ledger).select("date", F.lit("recorded").alias("state"))
    traffic = valid_edges(spark.read.text(published)).agg(F.sum("count").alias("n")).select(F.lit("lines").alias("date"), F.lit("traffic").alias("state"), "n")
    states = recorded.unionByName(done.missing.select("date", F.lit("missing").alias("state")))
    return states.withColumn("n", F.lit(None).cast("bigint")).unionByName(traffic)


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Dumps of the first half year, loaded; then those of the second, by a stream that takes new files only."""
    root, path, ledger, progress = (work_path(spark, n) for n in ("growing", "loaded", "ledger", "progress"))
    for part in ("month <= '2018-06'", "month > '2018-06'"):
        _write_dumps(fx.dated_lines(fx.traffic_lines(spark, sf)).where(part), root)
        load_new_files(spark, root, path, ledger, progress, "*.txt.gz", archive=work_path(spark, "archive")).awaitTermination()
    months = spark.read.parquet(path).groupBy("month", "batch_id").agg(F.sum("n_lines").alias("n_lines"), F.sum("count").alias("traffic"))
    return months.join(read_ledger_table(spark, ledger).withColumnRenamed("date", "month"), "month")


def monthly_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """Lines staged as gzip dumps, one folder per month, scanned back as one table."""
    return (
        valid_edges(read_dumps(spark, _staged_dumps(spark, sf)))
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("count").alias("traffic"))
    )


# --- streams -----------------------------------------------------------------


def _stage(lines: DataFrame) -> tuple[str, int]:
    """Write lines as a folder to stream from; returns it with the file count for about four micro-batches."""
    spark = lines.sparkSession
    path = work_path(spark, "lines")
    spread(lines).write.parquet(path)
    files = spark.read.schema(lines.schema).parquet(path).rdd.getNumPartitions()
    return path, max(1, files // 4)


def _table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table as a stream. The pattern fits the file or folder of that name only."""
    schema = fx.table(spark, sf, name).schema
    return stream_files(spark, f"{sf}/{name}.parque[t]", schema)


def _in_two_runs(spark: SparkSession, sf: str, run) -> None:
    """Lines of the pages, then those of the catalogue: ``run`` starts the stream anew for each half."""
    lines = dirty(spark, sf)
    path = work_path(spark, "lines")
    for part in (F.col("src") == fx.PAGES, F.col("src") == fx.CATALOGUE):
        spread(lines.where(part)).write.mode("append").parquet(path)
        run(stream_files(spark, path, lines.schema, 4)).awaitTermination()


def _streamed_store(spark: SparkSession, sf: str) -> EdgeStore:
    store, progress = EdgeStore(work_path(spark, "store"), LINE_ORD), work_path(spark, "progress")
    _in_two_runs(spark, sf, lambda lines: edge_stream(lines, store, progress, once=True))
    return store


def stream_edge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed_store(spark, sf).edges(spark)


def stream_state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with the totals in the state store, which the second run takes up again."""
    path, progress = work_path(spark, "totals"), work_path(spark, "progress")
    _in_two_runs(spark, sf, lambda lines: total_stream(lines, path, ORDER, progress, once=True))
    return op.newest_totals(spark.read.parquet(path))


def stream_index(spark: SparkSession, sf: str) -> DataFrame:
    path, progress = work_path(spark, "index"), work_path(spark, "progress")
    _in_two_runs(spark, sf, lambda lines: index_stream(lines, path, progress, once=True))
    return spark.read.parquet(path)


def stream_search(spark: SparkSession, sf: str) -> DataFrame:
    """Search over layouts written from the table that a stream has filled."""
    edges = pin(_streamed_store(spark, sf).edges(spark), "edges")
    buckets = max(1, -(-edges.count() // 1_000_000))
    return _answers(spark, sf, write_search_tables(edges, work_path(spark, "store"), buckets))


def stream_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Terms that arrive as files, answered batch by batch against bucketed tables."""
    terms, path = work_path(spark, "terms"), work_path(spark, "answers")
    fx.search_terms(spark, sf).repartition(4).write.parquet(terms)
    arriving = stream_files(spark, terms, spark.read.parquet(terms).schema, files_per_trigger=2)
    answer_stream(arriving, _bucketed_tables(spark, sf), path, work_path(spark, "progress"), once=True).awaitTermination()
    return op.response_text(answers(spark.read.parquet(path), RESPONSE_PAGE_ROWS))


def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of a stream over three loads of events; most events of the later loads are late."""
    lines = fx.numbered_event_lines(fx.table(spark, sf, "events"))
    path, out, progress = (work_path(spark, n) for n in ("events", "loaded", "progress"))
    counters = BatchCounters()
    spark.streams.addListener(counters)
    try:
        for k in range(3):
            lines.where(F.col("event_id") % 3 == k).write.mode("append").parquet(path)
            source = stream_files(spark, path, lines.schema)
            counters.wait(load_once_stream(source, "event_id", "ts", out, progress, once=True))
    finally:
        spark.streams.removeListener(counters)
    found = counters.table(spark)
    # batches without input close windows; loads are numbered without them
    load = F.row_number().over(Window.orderBy("batch_id")).cast("bigint").alias("load")
    return found.select(load, "n_lines", "n_valid", "n_quarantined", "traffic", "n_late")


def stream_last_write_wins(spark: SparkSession, sf: str) -> DataFrame:
    lines = dirty(spark, sf)
    path, files = _stage(lines)
    out = work_path(spark, "overwrites")
    source = stream_files(spark, path, lines.schema, files)
    overwrite_stream(source, out, ORDER, work_path(spark, "progress"), once=True).awaitTermination()
    return op.newest_writes(spark.read.parquet(out)).drop("ord")


def pair_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs in both sinks, and the lines without a pair that were set aside."""
    lines = dirty(spark, sf)
    path, files = _stage(lines)
    table, documents, aside = (work_path(spark, n) for n in ("pairs", "documents", "aside"))
    source = stream_files(spark, path, lines.schema, files)
    pairs_to_sinks(source, table, documents, work_path(spark, "progress"), once=True, aside_path=aside).awaitTermination()
    pair = "referrer STRING, resource STRING, batch_id BIGINT"
    rows = spark.read.schema(pair).parquet(table).withColumn("sink", F.lit("table"))
    rows = rows.unionByName(spark.read.schema(pair).json(documents).withColumn("sink", F.lit("documents"))).drop("batch_id")
    left = spark.read.schema("value STRING").parquet(aside)
    return rows.unionByName(
        left.select(F.lit(None).cast("string").alias("referrer"), F.col("value").alias("resource"), F.lit("aside").alias("sink"))
    )


BATCH_ROWS = 1000
#: Batches that one trigger takes.
BATCHES_AT_ONCE = 256


def batched_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts by batches of at most ``BATCH_ROWS`` texts, added up over the batches.

    A batch is a file. A trigger takes up to ``BATCHES_AT_ONCE`` of them and counts each on its own.
    """
    texts = fx.table(spark, sf, "documents").select("text")
    path, out = work_path(spark, "texts"), work_path(spark, "words")
    texts.write.option("maxRecordsPerFile", BATCH_ROWS).parquet(path)
    source = stream_files(spark, path, texts.schema, files_per_trigger=BATCHES_AT_ONCE)
    batches = source.select("text", F.col("_metadata.file_name").alias("batch"))
    word_count_stream(batches, "text", out, work_path(spark, "progress"), once=True, within=["batch"]).awaitTermination()
    return spark.read.parquet(out).groupBy("word").agg(F.sum("n").alias("n"))


def _run_trending(spark: SparkSession, sf: str) -> tuple[str, str]:
    out, progress = work_path(spark, "trending"), work_path(spark, "progress")
    lines = fx.event_lines(_table_stream(spark, sf, "events"))
    trending_stream(lines, "ts", out, progress, once=True).awaitTermination()
    return out, progress


def _shown_windows(windows: DataFrame) -> DataFrame:
    shown = "yyyy-MM-dd HH:mm:ss"
    return windows.select(
        F.date_format("window_start", shown).alias("window_start"),
        F.date_format("window_end", shown).alias("window_end"),
        "search_term",
        "traffic_count",
    )


def trending_windowed(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that the watermark has closed; those still open are :func:`trending_open`."""
    return _shown_windows(spark.read.parquet(_run_trending(spark, sf)[0]))


def trending_open(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that the stream has not given out yet, as its state holds them."""
    return _shown_windows(open_windows(spark, _run_trending(spark, sf)[1]))


def publish_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "published")
    publish_to_files(dirty(spark, sf), path)
    return read_folder(spark, path, suffix=".txt.gz")


def load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "accepted")
    parsed = parse_lines(dirty(spark, sf))
    return ingest_metrics(parsed, lambda rows: normalise(accepted(rows)).write.parquet(path))


# --- volume ------------------------------------------------------------------


def volume_edges(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread(fx.table(spark, sf, "documents").select("doc_id", "text"))
    return op.fold_edges(valid_edges(fx.bigram_lines(documents)), ORDER).drop("ord")


def volume_search_index(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread(fx.table(spark, sf, "documents").select("doc_id", "text"))
    return op.build_index(valid_edges(fx.bigram_lines(documents)))


def volume_search_response(spark: SparkSession, sf: str) -> DataFrame:
    tables = _pinned_tables(volume_edges(spark, sf), index_too=True)
    return op.response_text(op.search(tables, fx.text_terms(spark, sf), RESPONSE_PAGE_ROWS))


# --- registry ----------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "parse_lenient": parse_lenient,
    "parse_strict": parse_strict,
    "quarantine": quarantine,
    "normalize_edges": normalize_edges,
    "edge_upsert": edge_upsert,
    "trending_topics": trending_topics,
    "last_write_wins": last_write_wins,
    "pair_projection": pair_projection,
    "symmetric_pairs": symmetric_pairs,
    "key_uniqueness": key_uniqueness,
    "word_count": word_count,
    "search_index": search_index,
    "index_increment": index_increment,
    "term_tokens": term_tokens,
    "search_related": search_related,
    "search_select": search_select,
    "search_ranked": search_ranked,
    "search_first": search_first,
    "search_top": search_top,
    "sql_index": sql_index,
    "direct_lookup": direct_lookup,
    "search_incoming": search_incoming,
    "search_outgoing": search_outgoing,
    "title_case": title_case,
    "traffic_series": traffic_series,
    "search_response": search_response,
    "search_stored": search_stored,
    "search_json": search_json,
    "search_shuffled": search_shuffled,
    "search_bucketed": search_bucketed,
    "point_reads": point_reads,
    "extract_anchors": extract_anchors,
    "new_months": months_to_load,
    "updated_ledger": updated_ledger,
    "monthly_traffic": monthly_traffic,
    "dump_edge_upsert": dump_edge_upsert,
    "ingest_months": ingest_listed,
    "ingest_stream": ingest_stream,
    "stream_edge_upsert": stream_edge_upsert,
    "stream_state_upsert": stream_state_upsert,
    "stream_index": stream_index,
    "stream_search": stream_search,
    "stream_answers": stream_answers,
    "stream_metrics": stream_metrics,
    "stream_last_write_wins": stream_last_write_wins,
    "pair_stream": pair_stream,
    "batched_word_count": batched_word_count,
    "trending_windowed": trending_windowed,
    "trending_open": trending_open,
    "publish_lines": publish_lines,
    "ingest_metrics": load_metrics,
    "volume_edge_upsert": volume_edges,
    "volume_search_index": volume_search_index,
    "volume_search_response": volume_search_response,
}


def top_pairs(spark: SparkSession, sf: str, k: int = 20) -> DataFrame:
    """The report of the busiest pairs."""
    busiest = edge_table(spark, sf).orderBy(F.desc("count"), "referrer", "resource")
    return busiest.limit(k)
