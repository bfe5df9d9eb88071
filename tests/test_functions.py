from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pageflow.functions import (
    display_name,
    index_tokens,
    norm_referrer,
    norm_resource,
    norm_term,
    strip_line,
    term_words,
    title_case,
)
from pageflow.functions.sql import register_functions
from pageflow.schemas import STOP_WORDS
from pageflow.session import dropping_pins, pin
from pageflow.sources.ledger import decoded
from pageflow.sources.lines import accepted, parse_lines, rejected

from conftest import rows


def apply(spark, function, text):
    return spark.createDataFrame([(text,)], "t string").select(function(F.col("t")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "function, text, expected",
    [
        (norm_resource, "Beyoncé_(album)", "beyonc   album "),
        (norm_resource, "C++", "c  "),
        (norm_resource, "other-search", "other search"),
        (norm_resource, "a\U0001f600b", "a b"),
        (norm_referrer, "other-search", "other-search"),
        (norm_referrer, "AT&T", "at t"),
        (norm_term, "Beyoncé (Album)!", "beyonc album"),
        (norm_term, "!!!", ""),
        (norm_term, "\u212aelvin", "kelvin"),
        (norm_resource, "\u212aelvin", " elvin"),
        (title_case, "abba  band ", "Abba Band "),
        (title_case, "3d-print_x", "3d Print X"),
        (title_case, " x", " X"),
        (display_name, "other-empty", "other-empty"),
        (strip_line, "  a\tb  \t\x1c", "a\tb"),
    ],
)
def test_text(spark, function, text, expected):
    assert apply(spark, function, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("i am the walrus", ["i", "am", "walrus"]),
        ("other search", ["other", "search"]),
        ("the the", []),
        ("I am", ["am"]),
        ("THE Cat cat", ["cat"]),
        ("  x  y x ", ["x", "y"]),
        ("", []),
    ],
)
def test_index_tokens(spark, text, expected):
    assert apply(spark, index_tokens, text) == expected


def test_blank_term_gives_one_empty_word(spark):
    assert apply(spark, lambda c: term_words(norm_term(c)), "!!!") == [""]
    assert apply(spark, lambda c: term_words(norm_term(c)), "The  the cat") == ["the", "the", "cat"]


def test_stop_list_size():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 55


LINES = [
    ("a\tb\tlink\t5", True, True),
    ("a\tb\tlink", False, False),
    ("a\tb\tlink\t5\t9", True, False),
    ("  a\tb\tlink\t5\t", True, True),
    ("\tb\tlink\t5", False, False),
    ("a\t\tlink\t5", False, False),
    ("a\tb\tlink\tx", False, False),
    ("a\tb\tlink\t5.7", False, False),
    ("a\tb\tlink\t-3", True, True),
    ("a\tb\tlink\t99999999999999999999", False, False),
    ("", False, False),
    (None, False, False),
]


@pytest.mark.parametrize("strict", [False, True])
def test_every_line_is_accepted_or_rejected(spark, strict):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(LINES)], "id int, value string")
    parsed = parse_lines(df, strict)
    good = [r["id"] for r in accepted(parsed).orderBy("id").collect()]
    bad = [r["id"] for r in rejected(parsed).orderBy("id").collect()]
    assert good == [i for i, line in enumerate(LINES) if line[2 if strict else 1]]
    assert sorted(good + bad) == list(range(len(LINES)))


def test_fields_are_positional(spark):
    df = spark.createDataFrame([("a\tb\tlink\t5\t9",)], "value string")
    assert rows(accepted(parse_lines(df)), "referrer", "resource", "type", "count") == [("a", "b", "link", 5)]


def test_filter_is_not_pushed_below_the_split(spark):
    df = spark.createDataFrame([("a\tb\tlink\t5",)], "value string")
    plan = accepted(parse_lines(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_functions_of_sql_text_are_the_same(spark):
    register_functions(spark)
    register_functions(spark)
    names = ["Ab_c (The D)", "other-empty", "  a  b ", "I the i", "ünï-x", "", None, "a--b__c", "K\u212a"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    df.createOrReplaceTempView("sql_names")
    for name, function in {
        "norm_resource": norm_resource, "norm_referrer": norm_referrer, "norm_term": norm_term, "index_tokens": index_tokens,
        "title_case": title_case, "display_name": display_name, "strip_line": strip_line,
    }.items():
        text = spark.sql(f"SELECT name, {name}(name) AS x FROM sql_names")
        assert rows(text) == rows(df.select("name", function(F.col("name")).alias("x"))), name
    both = spark.sql("SELECT w.* FROM sql_names, LATERAL both_ways(name, 'z') AS w WHERE name = 'a--b__c'")
    assert rows(both) == [("a--b__c", "z"), ("z", "a--b__c")]
    words = spark.sql("SELECT t.position, t.word FROM sql_names, LATERAL term_words(name) AS t WHERE name = 'I the i'")
    assert rows(words) == [(0, "i"), (1, "the"), (2, "i")]
    lines = spark.createDataFrame([("a\tb\tlink\t3",), ("\u2003a\tb\tlink\tx \n",), ("a",)], "value string")
    lines.createOrReplaceTempView("sql_lines")
    fields = spark.sql("SELECT f.* FROM sql_lines, LATERAL line_fields(value) AS f")
    assert rows(fields) == sorted([("a", "b", "link", 3, 4), ("a", "b", "link", None, 4), ("a", None, None, None, 1)], key=lambda t: [(v is not None, v) for v in t])


@pytest.mark.parametrize(
    "text, expected",
    [("a &amp; b", "a & b"), ("&lt;&gt;&quot;&apos;", "<>\"'"), ("&amp;lt;", "&lt;"), ("&#38;lt;", "&lt;"), ("&#x1F600;!", "😀!"), ("&#228;", "ä"),
     ("&#0; &#xD800; &#9999999;", "\ufffd \ufffd \ufffd"), ("a & b &unknown; &;", "a & b &unknown; &;"), ("", ""), (None, None), ("&&amp;", "&&")],
)
def test_character_references(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(decoded(F.col("t"))).first()[0] == expected


def test_pinned_tables_can_be_dropped(spark, tmp_path):
    kept = pin(spark.range(3), "kept")
    with dropping_pins(spark):
        gone = pin(spark.range(5), "gone")
        assert gone.count() == 5
        path = gone.inputFiles()[0].removeprefix("file:")
        assert Path(path).exists()
    assert not Path(path).parent.exists() and kept.count() == 3
