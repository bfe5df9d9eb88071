"""Month listing and the ledger of months already loaded."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import LEDGER, LINE, MONTH_PREFIX

# Tags in either case; what stands between them may hold tags and line ends.
ANCHOR = r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>"
INNER_TAG = "<[^>]*>"


# The named character references that are decoded.
NAMED_CHARACTERS = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}


def decoded(text: Column) -> Column:
    """Text with its character references decoded once: the named ones above, and decimal and hexadecimal ones.

    What follows each ``&`` is looked at by itself, so a decoded ``&`` starts no new reference.
    A number that is no character gives the replacement character; anything else stays.
    """

    def character(number: Column) -> Column:
        known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        code = F.when(known, number).otherwise(0xFFFD)
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def after_ampersand(part: Column) -> Column:
        name = F.regexp_extract(part, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-z]{2,4});", 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(name.startswith("#"), F.substr(name, F.lit(2)))
        found = F.when(name == "", F.lit(None).cast("string"))
        for word, meant in NAMED_CHARACTERS.items():
            found = found.when(name == word, F.lit(meant))
        found = found.when(name.startswith("#"), character(number.cast("bigint")))
        after = F.substr(part, F.length(name) + 2)
        return F.when(found.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(found, after))

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), after_ampersand)
    return F.when(F.contains(text, F.lit("&")), F.concat(parts[0], F.array_join(rest, ""))).otherwise(text)


def anchor_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per anchor, with its text freed of tags, decoded, and freed of ``/`` at both ends; other columns are kept."""
    kept = [c for c in pages.columns if c != html]
    found = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(1))
    return pages.select(*kept, F.posexplode(found).alias("position", "raw")).select(
        *kept, "position", F.btrim(decoded(F.regexp_replace("raw", INNER_TAG, "")), F.lit("/")).alias("anchor")
    )


def listed_months(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct months offered by listing pages."""
    return (
        anchor_texts(pages, html)
        .where(F.col("anchor").startswith(MONTH_PREFIX))
        .select(F.col("anchor").alias("date"))
        .distinct()
    )


def new_months(online: DataFrame, ledger: DataFrame) -> DataFrame:
    return online.select("date").distinct().join(ledger.select("date"), "date", "left_anti").orderBy("date")


def merge_ledger(ledger: DataFrame, loaded: DataFrame) -> DataFrame:
    return ledger.select("date").union(loaded.select("date")).distinct().orderBy("date")


def read_ledger_table(spark: SparkSession, path: str) -> DataFrame:
    """Months of the ledger table; an absent table is an empty ledger."""
    try:
        return spark.read.schema(LEDGER).parquet(path).distinct()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def read_ledger_file(spark: SparkSession, path: str) -> DataFrame:
    """Months of a ledger text file, one per line; an absent file is an empty ledger."""
    try:
        return spark.read.schema(LINE).text(path).select(F.col("value").alias("date"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def append_ledger(loaded: DataFrame, path: str) -> None:
    """Record months. Appending one twice is harmless: readers take distinct dates."""
    loaded.select("date").distinct().coalesce(1).write.mode("append").parquet(path)


def export_ledger(ledger: DataFrame, path: str) -> None:
    """Sorted text form. A ledger has one row per calendar month, so one file is enough."""
    ledger.select("date").distinct().orderBy("date").coalesce(1).write.mode("overwrite").text(path)
