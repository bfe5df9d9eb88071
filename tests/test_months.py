import gzip

import pytest

from pageflow.plans.ingest import ingest_metrics, ingest_months
from pageflow.sources import (
    anchor_texts, export_ledger, listed_months, merge_ledger, new_months, parse_lines, read_dumps, read_folder,
    read_ledger_file, read_ledger_table,
)
from pageflow.sources.ledger import append_ledger
from pageflow.operators import fold_edges
from pageflow.sources.lines import DUMP_ORDER, dump_path, valid_edges
from pageflow.sources.topic import PRODUCER_OPTIONS, reader_options

from conftest import rows


def months(spark, first, last):
    return spark.sql(
        "SELECT date_format(d, 'yyyy-MM') AS date FROM "
        f"(SELECT explode(sequence(date'{first}-01', date'{last}-01', interval 1 month)) AS d)"
    )


def test_new_months_and_union(spark):
    ledger, online = months(spark, "2018-02", "2024-11"), months(spark, "2017-11", "2024-11")
    assert (ledger.count(), online.count()) == (82, 85)
    assert [r[0] for r in new_months(online, ledger).collect()] == ["2017-11", "2017-12", "2018-01"]
    assert [r[0] for r in merge_ledger(ledger, new_months(online, ledger)).collect()] == [
        r[0] for r in online.orderBy("date").collect()
    ]


def test_listing(spark):
    html = (
        '<a href="../">../</a> <a href="x">2018-01/</a><a>/2018-02</a><A>2018-03/</A><a> 2018-04/</a><a>readme</a>'
        "<a><b>2018-05/</b></a><abbr>2018-06</abbr><A\nHREF=x>2018-07</a\n>"
    )
    page = spark.createDataFrame([(1, html)], "id int, html string")
    assert rows(anchor_texts(page), "position", "anchor") == [
        (0, ".."), (1, "2018-01"), (2, "2018-02"), (3, "2018-03"), (4, " 2018-04"), (5, "readme"), (6, "2018-05"), (7, "2018-07")
    ]
    assert rows(listed_months(page)) == [("2018-01",), ("2018-02",), ("2018-03",), ("2018-05",), ("2018-07",)]


def test_ledger_forms(spark, tmp_path):
    table, text = f"file://{tmp_path}/table", f"file://{tmp_path}/text"
    assert read_ledger_table(spark, table).count() == 0
    assert read_ledger_file(spark, text).count() == 0
    append_ledger(months(spark, "2018-01", "2018-03"), table)
    append_ledger(months(spark, "2018-03", "2018-04"), table)
    export_ledger(read_ledger_table(spark, table), text)
    assert [r[0] for r in read_ledger_file(spark, text).collect()] == ["2018-01", "2018-02", "2018-03", "2018-04"]


def write_dump(root, month, lines, edition="xx"):
    path = dump_path(str(root), month, edition)
    (root / month).mkdir(parents=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write("\n".join(lines))


def test_dumps_are_scanned_together_with_their_month(spark, tmp_path):
    write_dump(tmp_path, "2018-01", ["a\tb\tlink\t1", " c\td\tlink\t2 "])
    write_dump(tmp_path, "2018-02", ["e\tf\tlink\t3"])
    paths = [f"file://{dump_path(str(tmp_path), m, 'xx')}" for m in ("2018-01", "2018-02")]
    expected = [("2018-01", "a\tb\tlink\t1"), ("2018-01", "c\td\tlink\t2"), ("2018-02", "e\tf\tlink\t3")]
    assert rows(read_dumps(spark, paths)) == expected
    assert rows(read_dumps(spark, paths, partitions=4)) == expected
    assert rows(read_folder(spark, f"file://{tmp_path}/2018-02", ".tsv.gz")) == [("e\tf\tlink\t3",)]


def test_only_months_that_were_read_are_recorded(spark, tmp_path):
    write_dump(tmp_path / "dumps", "2018-01", ["a\tb\tlink\t1"])
    listing = spark.createDataFrame([("<a>2018-01/</a><a>2018-02/</a><a>20-notes/</a>",)], "html string")
    ledger, root = f"file://{tmp_path}/ledger", f"file://{tmp_path}/dumps"
    published = f"file://{tmp_path}/published"

    def publish(lines):
        lines.write.mode("append").text(published)

    def ingest(**options):
        done = ingest_months(spark, listing, ledger, root, publish, **options)
        return rows(done.loaded), rows(done.missing)

    assert ingest() == ([("2018-01",)], [("20-notes",), ("2018-02",)])
    assert rows(read_ledger_table(spark, ledger)) == [("2018-01",)]
    assert rows(spark.read.text(published)) == [("a\tb\tlink\t1",)]
    assert ingest() == ([], [("20-notes",), ("2018-02",)])
    write_dump(tmp_path / "dumps", "2018-02", ["c\td\tlink\t1"])
    assert ingest(partitions=2) == ([("2018-02",)], [("20-notes",)])
    write_dump(tmp_path / "dumps", "20-notes", ["e\tf\tlink\t1"])
    assert ingest() == ([("20-notes",)], [])
    assert rows(read_ledger_table(spark, ledger)) == [("20-notes",), ("2018-01",), ("2018-02",)]


def test_listing_without_any_dump(spark, tmp_path):
    listing = spark.createDataFrame([("<a>2018-01/</a>",)], "html string")
    done = ingest_months(spark, listing, f"file://{tmp_path}/ledger", f"file://{tmp_path}/none", lambda lines: None)
    assert (rows(done.loaded), rows(done.missing)) == ([], [("2018-01",)])


def test_dump_lines_keep_their_order(spark, tmp_path):
    write_dump(tmp_path, "2018-01", [f"a\tb\t{'other' if k else 'link'}\t1" for k in range(5)])
    write_dump(tmp_path, "2018-02", ["a\tb\tlate\t1"])
    lines = read_dumps(spark, f"file://{tmp_path}", ordered=True)
    folded = fold_edges(valid_edges(lines), ["month", *DUMP_ORDER]).drop("ord")
    assert rows(folded) == [("a", "b", "link", 6)]


def test_metrics_of_a_load(spark, tmp_path):
    lines = spark.createDataFrame([("a\tb\tlink\t4",), ("bad",), ("a\tc\tlink\t6",)], "value string")
    found = ingest_metrics(parse_lines(lines), lambda rows: rows.write.parquet(f"file://{tmp_path}/out"))
    assert rows(found) == [(3, 2, 1, 10)]


def test_topic_options():
    options = reader_options("host:1", "lines", "earliest", 1000)
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "1000"
    assert reader_options("host:1", "lines")["startingOffsets"] == "latest"
    assert PRODUCER_OPTIONS["kafka.acks"] == "all" and PRODUCER_OPTIONS["kafka.compression.type"] == "gzip"
