"""Secret scan with multipart credential linking.

Strong findings are reported as they are. Weak ones (identifiers, random-looking
values, endpoints) mean little alone; they are reported only where parts that
complement each other lie close together in one scope, which is a stretch of
text without a blank line. Parts meet in an interval join over buckets of the
text, against the first and last place of each role in a bucket, so that a text
full of parts of one kind does not make pairs of them.

Only DataFrame functions are used. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import dropping_pins, pin

# The strong kinds in order, the pattern of assignments, and least lengths.
STRONG = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST = {"assign": 12, "access": 18, "hex": 16}

REACH = 300


@dataclass(frozen=True)
class Kind:
    """``group`` holds what is measured; ``pattern`` may already demand ``least`` characters of group 0."""

    name: str
    role: str
    pattern: str
    group: int = 0
    least: int = 1


KINDS = (
    # A failing match still uses up its text, so the length of an assigned value is tested afterwards.
    Kind("assign", "secret", ASSIGN, 1, LEAST["assign"]),
    # A failing match of these two ends where its run of characters ends: asking for the length at once is the same.
    Kind("access", "id", r"AKIA[A-Z0-9]{%d,}" % (LEAST["access"] - 4)),
    Kind("hex", "secret", r"[0-9a-f]{%d,}" % LEAST["hex"]),
    Kind("linked_id", "id", r"""\b(?:A(?:SIA|ROA|IDA)[A-Z0-9]{12,}|(?:client_id|user(?:name)?|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,})"""),
    Kind("linked_secret", "secret", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}"),
    Kind("linked_endpoint", "endpoint", r"""(?:https?|ftp|s3|jdbc|amqp|redis|mysql|postgres(?:ql)?|mongodb)://[^\s"'<>]+"""),
    Kind("break", "break", r"\n[\x20\x09\r]*\n"),
)


def _matches(text: Column, kind: Kind) -> Column:
    """Per match of a pattern: code points since the last one, own length, length of the measured group."""
    pattern = F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern, -1), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    held = F.transform(F.regexp_extract_all(text, pattern, F.lit(kind.group)), F.char_length) if kind.group else whole
    found = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), whole.alias("length"), held.alias("held")
    )
    return F.when(F.rlike(text, pattern), found)


def scan_parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (``row``, ``doc_id``, ``text_hash``), and all parts (``row``, ``kind``, ``role``, ``start``, ``end``).

    ``row`` numbers the rows of ``docs``, so that repeated ids do not mix.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    weak = F.lit(False)
    for kind in KINDS[3:-1]:
        weak = weak | F.rlike(text, F.lit(kind.pattern))
    columns = [_matches(text, k).alias(k.name) for k in KINDS[:-1]]
    columns.append(F.when(weak, _matches(text, KINDS[-1])).alias("break"))
    found = pin(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), *columns),
        "secret-matches",
    )
    kinds = F.array(
        *[F.struct(F.lit(k.name).alias("kind"), F.lit(k.role).alias("role"), F.lit(k.least).alias("least"), F.col(k.name).alias("at")) for k in KINDS]
    )
    each = (
        found.where(F.coalesce(*[F.col(k.name) for k in KINDS]).isNotNull())
        .select("row", F.explode(kinds).alias("k"))
        .select("row", "k.kind", "k.role", "k.least", F.posexplode("k.at").alias("n", "m"))
    )
    sofar = Window.partitionBy("row", "kind").orderBy("n")
    end = F.sum(F.col("m.gap") + F.col("m.length")).over(sofar)
    parts = each.withColumn("end", end).where(F.col("m.held") >= F.col("least"))
    return found.select("row", "doc_id", "text_hash"), parts.select(
        "row", "kind", "role", (F.col("end") - F.col("m.length")).alias("start"), "end"
    )


def link_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Findings of :func:`scan_parts`: strong ones, and weak ones with complements in reach.

    A weak secret needs an identifier within ``reach`` code points (start to
    start) in its scope, a weak identifier needs a secret, an endpoint both.
    Complements may be strong or weak. A weak part that overlaps a strong one of
    the same text is no part. A scope ends at a blank line.
    """
    strong = F.col("kind").isin(*STRONG)
    by_start = Window.partitionBy("row").orderBy("start", "end")
    before, after = by_start.rowsBetween(Window.unboundedPreceding, -1), by_start.rowsBetween(1, Window.unboundedFollowing)
    covered = (F.coalesce(F.max(F.when(strong, F.col("end"))).over(before), F.lit(0)) > F.col("start")) | (
        F.coalesce(F.min(F.when(strong, F.col("start"))).over(after), F.col("end")) < F.col("end")
    )
    scoped = (
        parts.withColumn("scope", F.sum((F.col("kind") == "break").cast("int")).over(by_start))
        .withColumn("covered", ~strong & covered)
        .where((F.col("kind") != "break") & ~F.col("covered"))
        .drop("covered")
        .withColumn("bucket", F.floor(F.col("start") / reach))
    )
    place = ["row", "scope", "bucket"]
    roles = scoped.groupBy(*place).agg(
        *[f(F.when(F.col("role") == r, F.col("start"))).alias(f"{r}_{n}") for r in ("id", "secret", "endpoint") for n, f in (("first", F.min), ("last", F.max))]
    )
    weak = scoped.where(~strong).withColumn(
        "bucket", F.explode(F.array(*[F.col("bucket") + step for step in (-1, 0, 1)]))
    )

    def near(role: str) -> Column:
        # the first and last place of a role in a bucket are enough: in the own bucket any place is in reach
        return F.max(
            (F.abs(F.col(f"{role}_first") - F.col("start")) <= reach) | (F.abs(F.col(f"{role}_last") - F.col("start")) <= reach)
        )

    has_id, has_secret = F.coalesce("near_id", F.lit(False)), F.coalesce("near_secret", F.lit(False))
    linked = (
        weak.join(roles, place)
        .groupBy("row", "kind", "role", "start", "end")
        .agg(near("id").alias("near_id"), near("secret").alias("near_secret"))
        .where(
            F.when(F.col("role") == "secret", has_id).when(F.col("role") == "id", has_secret).otherwise(has_id & has_secret)
        )
        .select("row", "kind", "start", "end")
    )
    return parts.where(strong).select("row", "kind", "start", "end").unionByName(linked)


def find_secrets(docs: DataFrame, reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """Rows (``row``, ``doc_id``, ``text_hash``) and findings (``row``, ``kind``, ``start``, ``end``) of ``docs``.

    A null or empty text has no findings. Repeated rows are rows of their own;
    ids may be null. Other columns of ``docs`` are not read. Texts of any length
    are scanned whole. An empty table gives two empty tables.
    """
    rows, parts = scan_parts(docs)
    return rows, pin(link_parts(pin(parts, "secret-parts"), reach), "secret-findings")


def digest(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: counts of the strong kinds, the hash of their spans, and all spans."""
    rows, findings = find_secrets(docs, reach)
    span = F.concat_ws(":", "kind", "start", "end")
    order = F.array_position(F.array(*[F.lit(k.name) for k in KINDS]), F.col("kind"))
    keyed = F.struct("start", order.alias("order"), "end", span.alias("span"))
    strong = F.col("kind").isin(*STRONG)

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: s["span"]), ",")

    per_row = findings.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in STRONG],
        F.collect_list(F.when(strong, keyed)).alias("base"),
        F.collect_list(keyed).alias("all"),
    )
    empty = F.lit("")
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in STRONG],
        F.sha2(F.coalesce(joined("base"), empty), 256).alias("base_sha256"),
        F.coalesce(joined("all"), empty).alias("spans"),
    )


def drop_secret_rows(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` without the rows in which anything was found.

    Rows are told apart by id and text, so equal rows share their fate, as they
    share their findings. Columns named ``bad_id`` or ``bad_hash`` are not allowed. What
    the scan has stored is deleted.
    """
    with dropping_pins(docs.sparkSession):
        rows, findings = find_secrets(docs, reach)
        found = findings.select("row").distinct().join(rows, "row")
        bad = pin(found.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct(), "secrets", keep=True)
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64("text") == F.col("bad_hash"))
    return docs.join(bad, same, "left_anti")
