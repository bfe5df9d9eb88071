"""The corpus pipeline: five operators applied to ``documents`` one after the other.

Each stage reads what its predecessor kept and returns the columns of
``documents``; the last adds what the mix says of each row. An operator is given
the columns it reads and all others packed into one, so columns of any name,
also of those that an operator adds or uses, come out as they went in. Rows with
null ids, null texts and repeated rows pass through the stages as the operators
define: a null text or one without a letter has no language and goes first, of
repeated rows one stays, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageflow.llm import decontaminate, jaccard, language, mixing, secret_links
from pageflow.session import pin

#: Texts whose most likely language scores lower are rejected, as are texts without a letter.
LEAST_LANGUAGE_SCORE = 0.5
#: Near copies: five words, and the least similarity of near-duplicate stages.
COPY_WORDS, COPY_PERCENT = 5, 80

READ = ("doc_id", "text", "lang", "source")
PACKED = "other_columns"

#: A trained network, hashes of passages and a latent space are nothing that SQL can express.
ORACLE_SQL = None


def _named(*path: str) -> Column:
    return F.col(".".join("`" + name.replace("`", "``") + "`" for name in path))


def _packed(docs: DataFrame) -> DataFrame:
    others = [_named(c) for c in docs.columns if c not in READ]
    return docs.select(*READ, F.struct(*others, F.lit(0).alias("no column")).alias(PACKED))


def _unpacked(rows: DataFrame, columns: list[str], added: tuple[str, ...] = ()) -> DataFrame:
    """``columns`` in their order, and the added ones, by another name where that is taken."""
    free = {c: c for c in added}
    for name in added:
        while free[name] in columns:
            free[name] = "mix_" + free[name]
    return rows.select(
        *[_named(c) if c in READ else _named(PACKED, c).alias(c) for c in columns], *[F.col(c).alias(free[c]) for c in added]
    )


def _filtered(docs: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return _unpacked(keep(_packed(docs)), docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    certain = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return _filtered(docs, lambda rows: language.identify(rows).where(certain))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _filtered(docs, lambda rows: jaccard.keep_first(rows, COPY_PERCENT, COPY_WORDS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _filtered(docs, lambda rows: decontaminate.drop_leaking_rows(rows, benchmark))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _filtered(docs, secret_links.drop_secret_rows)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = mixing.repeat_rows(mixing.mix_sources(mixing.with_size(_packed(docs))))
    return _unpacked(rows, docs.columns, ("size", "source_size", "target", "copies", "taken", "copy"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
