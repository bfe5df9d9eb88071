"""Traffic lines derived from the given tables with plain expressions.

Every line source has ``value`` and the arrival order ``(src, id, pos)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import SENTINEL_REFERRERS

ORDER = ("src", "id", "pos")

# Links as the given pages write them; the walk is defined on these.
LINK_TEXT = "<a[^>]*>([^<]*)</a>"
PAGES, CATALOGUE, TEXTS = 0, 1, 2

# Terms the tables do not hold: unknown, blank, repeated words, stop words,
# foreign letters, and single words common in links and texts.
EXTRA_TERMS = (
    "zzzz no such page",
    "!!!",
    "",
    "ring ring small",
    "the small ring",
    "Small_Ring_(Brand#12)",
    "brand",
    "The that, Ist",
    "de la las los",
    "für",
    "r",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SENTINEL_ARRAY = "array(" + ", ".join(f"'{s}'" for s in SENTINEL_REFERRERS) + ")"


def _sentinel(number: str) -> str:
    return f"get({SENTINEL_ARRAY}, int({number} % {len(SENTINEL_REFERRERS)}))"


def page_lines(pages: DataFrame) -> DataFrame:
    """A walk over each page's links in order; titles take three written forms in turn."""
    titled = pages.select(
        "page_id", F.regexp_extract_all("html", F.lit(LINK_TEXT), F.lit(1)).alias("links")
    ).selectExpr(
        "page_id AS id",
        """transform(links, (text, at) -> CASE at % 3
             WHEN 0 THEN text
             WHEN 1 THEN concat(text, '_', get(links, at - 1))
             ELSE concat(text, '_(', get(links, at - 1), ')') END) AS titles""",
    )
    walk = titled.selectExpr(
        "id",
        """inline(transform(titles, (name, at) ->
             struct(at + 1 AS pos, get(titles, at - 1) AS previous, name)))""",
    )
    return walk.selectExpr(
        f"{PAGES} AS src",
        "id",
        "pos",
        f"""concat_ws('\t',
              if(pos = 1, {_sentinel("id")}, previous),
              name,
              CASE WHEN pos = 1 THEN 'external' WHEN (id div 10) % 5 = 0 THEN 'other' ELSE 'link' END,
              string(10 + (id * 7 + pos * 13) % 100)) AS value""",
    )


def catalogue_lines(part: DataFrame) -> DataFrame:
    """A walk per part: entry page, its type, its name, its name with the brand in brackets."""
    named = part.selectExpr("p_partkey", "p_type", "p_size", "p_brand", "replace(p_name, ' ', '_') AS name")
    steps = named.selectExpr(
        "p_partkey AS id",
        "p_size",
        f"""stack(3,
              1, {_sentinel("p_partkey")}, p_type, 'external',
              2, p_type, name, 'link',
              3, name, concat(name, '_(', p_brand, ')'), 'link') AS (pos, a, b, kind)""",
    )
    return steps.selectExpr(
        f"{CATALOGUE} AS src", "id", "pos", "concat_ws('\t', a, b, kind, string(p_size + pos)) AS value"
    )


def traffic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_lines(table(spark, sf_dir, "pages")).unionByName(catalogue_lines(table(spark, sf_dir, "part")))


def dirty_lines(lines: DataFrame) -> DataFrame:
    """The same lines with five kinds of damage, chosen by ``id * 37 + pos``."""
    return lines.selectExpr(
        *[c for c in lines.columns if c != "value"],
        r"""CASE
              WHEN (id * 37 + pos) % 17 = 0 THEN regexp_replace(value, '\t[^\t]*$', '')
              WHEN (id * 37 + pos) % 19 = 0 THEN concat(regexp_replace(value, '\t[^\t]*$', ''), '\tx')
              WHEN (id * 37 + pos) % 23 = 0 THEN concat(value, '\textra')
              WHEN (id * 37 + pos) % 29 = 0 THEN concat('  ', value, '\t')
              WHEN (id * 37 + pos) % 31 = 0 THEN regexp_replace(value, '^[^\t]*\t', '\t')
              ELSE value END AS value""",
    )


def bigram_lines(documents: DataFrame) -> DataFrame:
    """Every adjacent pair of words of every text as one line."""
    words = documents.select(
        "doc_id", F.split(F.regexp_replace("text", "[\t\n\r]", "_"), " ").alias("words")
    )
    steps = words.selectExpr(
        "doc_id AS id",
        "posexplode(arrays_zip(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1))) AS (at, pair)",
    )
    return steps.selectExpr(
        f"{TEXTS} AS src", "id", "at + 1 AS pos", "concat_ws('\t', pair.`0`, pair.`1`, 'link', '1') AS value"
    )


def event_lines(events: DataFrame) -> DataFrame:
    """One line per event, with its event time."""
    return events.selectExpr(
        "timestamp(ts) AS ts", f"concat_ws('\t', {_sentinel('event_id')}, event_type, 'link', '1') AS value"
    )


def numbered_event_lines(events: DataFrame) -> DataFrame:
    """The same with the event's number; every seventeenth line has lost its count."""
    count = "if(event_id % 17 = 0, '', '1')"
    return events.selectExpr(
        "event_id", "timestamp(ts) AS ts", f"concat_ws('\t', {_sentinel('event_id')}, event_type, 'link', {count}) AS value"
    )


def search_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, brands and types of the catalogue, whose vocabularies do not grow with the table, and extra terms."""
    part = table(spark, sf_dir, "part")
    vocabulary = part.select(
        F.explode(F.array(F.upper("p_name"), F.col("p_brand"), F.col("p_type"))).alias("term")
    )
    listed = ", ".join(f"'{t}'" for t in EXTRA_TERMS)
    extra = spark.sql(f"SELECT explode(array({listed}, CAST(NULL AS STRING))) AS term")
    return vocabulary.unionByName(extra).distinct()


def text_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same terms and all words of the benchmark items, which the texts hold as words."""
    held = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("term"))
    return search_terms(spark, sf_dir).unionByName(held).distinct()


def month_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages with one month folder per order date."""
    orders = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    return orders.select(month.alias("month")).distinct().select(
        F.concat(F.lit('<a href="'), "month", F.lit('/">'), "month", F.lit("/</a>")).alias("html")
    )


def loaded_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger that lags the orders by a year."""
    orders = table(spark, sf_dir, "orders")
    earlier = F.date_format(F.add_months("o_orderdate", -12), "yyyy-MM")
    return orders.select(earlier.alias("date")).distinct()


def dated_lines(lines: DataFrame) -> DataFrame:
    """Lines with the month of the dump they belong to, spread over a year."""
    month = F.date_format(F.add_months(F.lit("2018-01-01").cast("date"), (F.col("id") % 12).cast("int")), "yyyy-MM")
    return lines.withColumn("month", month)
