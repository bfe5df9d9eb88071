"""Search: terms, related pages, the selected page, and its traffic.

Every step takes a table of terms; one term is the special case. A term is its
own key. Results keep one row per finding until the last step, which cuts the
numbered rows of a term into arrays of bounded length.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import display_name, is_sentinel, norm_term, term_words, title_case
from ..session import pin
from .joins import BROADCAST_ROWS, ROWS_PER_SPLIT, fits_broadcast, lookup_join
from .ranking import number_rows

RELATED, INCOMING, OUTGOING = "related", "incoming", "outgoing"
SECTIONS = (RELATED, INCOMING, OUTGOING)
PAGE_ROWS = 1000


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Keyed:
    """A table found by one column; ``other`` is the column that tells rows of a key apart.

    With ``buckets`` set, its files lie in ``bucket`` folders by the hash of the
    key, and a lookup names the bucket too, so other folders are not read. No key
    is blank; saying so makes the lookup side selective, which is what lets Spark
    prune folders at run time.
    """

    rows: DataFrame
    key: str
    other: str
    buckets: int | None = None
    broadcast_rows: int = BROADCAST_ROWS
    rows_per_split: int = ROWS_PER_SPLIT

    def find(self, wanted: DataFrame, fits: bool | None = None) -> DataFrame:
        """Rows whose key is wanted, with the columns of ``wanted``. The table itself is never copied to storage."""
        fits = fits_broadcast(wanted, self.broadcast_rows) if fits is None else fits
        limits = (self.broadcast_rows, self.rows_per_split, fits, [self.other])
        if self.buckets is None:
            return lookup_join(self.rows, wanted, self.key, *limits)
        placed, rows = self._placed(wanted), self.rows
        if not fits:
            # at most one number per bucket; the folders of others are not listed, counted or read
            rows = rows.where(F.col("bucket").isin([r[0] for r in placed.select("bucket").distinct().collect()]))
        return lookup_join(rows, placed, ["bucket", self.key], *limits).drop("bucket")

    def match(self, wanted: DataFrame) -> DataFrame:
        """:meth:`find` in one plan: nothing is measured or stored beforehand, so ``wanted`` may be a stream."""
        if self.buckets is None:
            return self.rows.join(wanted, self.key)
        return self.rows.join(self._placed(wanted), ["bucket", self.key]).drop("bucket")

    def _placed(self, wanted: DataFrame) -> DataFrame:
        return wanted.where(F.col(self.key) != "").withColumn("bucket", bucket_of(F.col(self.key), self.buckets))

    def find_one(self, value: str) -> DataFrame:
        found = self.rows.where(F.col(self.key) == value)
        if self.buckets is None:
            return found
        return found.where(F.col("bucket") == bucket_of(F.lit(value), self.buckets)).drop("bucket")


@dataclass(frozen=True)
class Bucketed(Keyed):
    """A table that Spark itself keeps in buckets by ``(key, slice)``.

    The slice is a hash of the other column, so the rows of a hot key lie in
    ``slices`` buckets. A lookup of any size is dealt to the buckets' places, once
    per slice, and each task joins one bucket as it lies: the table is not moved,
    and no key has to be counted first.
    """

    slices: int = 1

    def find(self, wanted: DataFrame, fits: bool | None = None) -> DataFrame:
        if fits_broadcast(wanted, self.broadcast_rows) if fits is None else fits:
            return self.rows.drop("slice").join(F.broadcast(wanted), self.key)
        return self.match(wanted)

    def match(self, wanted: DataFrame) -> DataFrame:
        copies = wanted.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(self.slices - 1))))
        return self.rows.join(copies.hint("merge"), [self.key, "slice"]).drop("slice")

    def find_one(self, value: str) -> DataFrame:
        return self.rows.where(F.col(self.key) == value).drop("slice")


@dataclass(frozen=True)
class SearchTables:
    """What a search reads: edges laid out by each end, and the word index."""

    by_resource: Keyed
    by_referrer: Keyed
    index: Keyed

    @classmethod
    def of(cls, edges: DataFrame, index: DataFrame) -> SearchTables:
        return cls(
            Keyed(edges, "resource", "referrer"), Keyed(edges, "referrer", "resource"), Keyed(index, "word", "resource")
        )


def prepare_terms(terms: DataFrame) -> DataFrame:
    """Distinct terms with their normal form, query words and status; a missing or blank term is invalid."""
    return normal_terms(terms.select("term").distinct())


def normal_terms(terms: DataFrame) -> DataFrame:
    """The same for each row of ``terms`` as it is; other columns are kept."""
    return (
        terms.withColumn("norm", norm_term(F.col("term")))
        .withColumn("words", term_words(F.col("norm")))
        .withColumn("status", F.when(F.coalesce("norm", F.lit("")) == "", "invalid").otherwise("ok"))
    )


def query_words(prepared: DataFrame) -> DataFrame:
    """One row per query word; a repeated word stays repeated."""
    return prepared.select("*", F.posexplode("words").alias("position", "word"))


def hits(index: Keyed, prepared: DataFrame, fits: bool | None = None) -> DataFrame:
    """One row per query word and page that holds it."""
    return index.find(query_words(prepared), fits)


def related_pages(index: Keyed, prepared: DataFrame) -> DataFrame:
    """Pages that hold any word of the term, with the place of the first word that hit."""
    return hits(index, prepared).groupBy("term", "resource").agg(F.min("position").alias("first_word"))


def fitting(found: DataFrame) -> DataFrame:
    """Add to hits whether the page is the term itself, and whether it contains every word as a substring."""
    contains_all = F.forall("words", lambda w: F.contains(F.col("resource"), w))
    return found.withColumn("exact", F.col("resource") == F.col("norm")).withColumn("contains_all", contains_all)


def select_fitting(found: DataFrame) -> DataFrame:
    """The selected page of each term among its hits with :func:`fitting`."""
    order = F.struct(
        (~F.col("exact")).alias("fallback"),
        F.length("resource").alias("length"),
        F.col("position").alias("first_word"),
        F.col("resource").alias("resource"),
    )
    return (
        found.where("exact OR contains_all")
        .groupBy("term")
        .agg(F.min(order).alias("best"))
        .select("term", F.col("best.resource").alias("selected"), (~F.col("best.fallback")).alias("is_exact"))
    )


def select_pages(index: Keyed, prepared: DataFrame) -> DataFrame:
    """One page per term: the exact match, else the shortest page containing every word as a substring."""
    return select_fitting(fitting(hits(index, prepared)))


def select_first(index: Keyed, prepared: DataFrame) -> DataFrame:
    """The first related page, unranked."""
    first = F.struct(F.col("position").alias("first_word"), F.col("resource").alias("resource"))
    return (
        hits(index, prepared)
        .groupBy("term")
        .agg(F.min(first).alias("best"))
        .select("term", F.col("best.resource").alias("selected"))
    )


def ranked_pages(index: Keyed, prepared: DataFrame) -> DataFrame:
    """Related pages ranked by the number of query words that hit; rank 1 is the selection."""
    counted = (
        hits(index, prepared)
        .groupBy("term", "resource")
        .agg(F.count(F.lit(1)).alias("matches"), F.min("position").alias("first_word"))
    )
    return number_rows(
        counted, ["term"], [F.desc("matches"), F.asc("first_word"), F.asc("resource")]
    ).withColumn("is_selected", F.col("rank") == 1)


def top_pages(index: Keyed, prepared: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` of each term's ranked pages.

    Each task keeps ``k`` rows per term before anything is moved for the ranking, so neither a term
    with very many pages nor their numbering costs more than the count of hits does.
    """
    counted = (
        hits(index, prepared)
        .groupBy("term", "resource")
        .agg(F.count(F.lit(1)).alias("matches"), F.min("position").alias("first_word"))
    )
    order = Window.partitionBy("term").orderBy(F.desc("matches"), F.asc("first_word"), F.asc("resource"))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _resolve(prepared: DataFrame, selection: DataFrame) -> DataFrame:
    return pin(prepared.join(selection.select("term", "selected"), "term", "left"), "resolved")


def resolve_terms(index: Keyed, prepared: DataFrame) -> DataFrame:
    """Prepared terms with their selected page; terms without one keep NULL."""
    return _resolve(prepared, select_pages(index, prepared))


def _selected_as(resolved: DataFrame, end: str) -> DataFrame:
    return resolved.where(F.col("selected").isNotNull()).select(
        "term", "status", "selected", F.col("selected").alias(end)
    )


def incoming(tables: SearchTables, resolved: DataFrame, fits: bool | None = None) -> DataFrame:
    """Edges that lead to each term's selected page."""
    found = tables.by_resource.find(_selected_as(resolved, "resource"), fits)
    return found.select("term", "status", "selected", "resource", "referrer", "type", "count")


def outgoing(tables: SearchTables, resolved: DataFrame, fits: bool | None = None) -> DataFrame:
    """Edges that leave each term's selected page.

    A page name holds no hyphen, so it never equals a sentinel: those referrers,
    the busiest of all, are left out before the join.
    """
    pages = replace(tables.by_referrer, rows=tables.by_referrer.rows.where(~is_sentinel(F.col("referrer"))))
    found = pages.find(_selected_as(resolved, "referrer"), fits)
    return found.select("term", "status", "selected", "resource", "referrer", "type", "count")


def by_traffic(edges: DataFrame, other_end: str) -> DataFrame:
    """Rank each term's edges by count, ties by the name at the other end."""
    return number_rows(edges, ["term"], [F.desc("count"), F.asc(other_end)])


def displayed(edges: DataFrame) -> DataFrame:
    return edges.withColumn("resource", display_name(F.col("resource"))).withColumn(
        "referrer", display_name(F.col("referrer"))
    )


def traffic_series(tables: SearchTables, resolved: DataFrame) -> DataFrame:
    """Chart series: counts labelled by referrer for incoming and by resource for outgoing traffic."""
    rows = ranked_findings(_edge_sections(tables, resolved, fits_broadcast(_selected_as(resolved, "resource"))))
    label = F.when(F.col("section") == INCOMING, F.col("referrer")).otherwise(F.col("resource"))
    return rows.select("term", "section", "rank", label.alias("label"), "count")


def direct_lookup(tables: SearchTables, prepared: DataFrame) -> DataFrame:
    """Traffic of the page named exactly like the normalised term, without the index."""
    named = prepared.where(F.col("status") == "ok").withColumn("selected", F.col("norm"))
    wanted = named.select("term", "status", "selected")
    fields = ["term", F.col("section"), "resource", "referrer", "type", "count"]
    return (
        incoming(tables, wanted).withColumn("section", F.lit(INCOMING)).select(*fields)
        .unionByName(outgoing(tables, wanted).withColumn("section", F.lit(OUTGOING)).select(*fields))
    )


def _edge_sections(tables: SearchTables, resolved: DataFrame, fits: bool) -> DataFrame:
    def section(edges: DataFrame, name: str, other_end: str) -> DataFrame:
        return edges.select(
            "term", "status", "selected", F.lit(name).alias("section"),
            F.col("count").alias("weight"), F.col(other_end).alias("tie"),
            "resource", "referrer", "type", "count",
        )

    return section(incoming(tables, resolved, fits), INCOMING, "referrer").unionByName(
        section(outgoing(tables, resolved, fits), OUTGOING, "resource")
    )


def ranked_findings(findings: DataFrame) -> DataFrame:
    ranked = number_rows(findings, ["term", "section"], [F.desc("weight"), F.asc("tie")])
    return displayed(ranked.drop("weight", "tie"))


def findings(tables: SearchTables, resolved: DataFrame, found: DataFrame, fits: bool) -> DataFrame:
    """All findings of all terms, one row each, to be ranked by ``weight`` (falling) and ``tie`` within ``(term, section)``.

    Related pages come in the order their words were looked up, without the
    selected page; edges come by count. ``found`` are the stored hits of the
    terms, ``fits`` tells whether their query words may be broadcast; a term has a
    word at least, so what is looked up here is no larger.
    """
    related = (
        lookup_join(
            found.select("term", "position", "resource"), resolved.select("term", "status", "selected"), "term",
            fits=fits, spread=["resource", "position"],
        )
        .where(~F.col("resource").eqNullSafe(F.lower("selected")))
        .groupBy("term", "status", "selected", "resource")
        .agg(F.min("position").alias("first_word"))
        .select(
            "term", "status", "selected", F.lit(RELATED).alias("section"),
            (-F.col("first_word")).cast("bigint").alias("weight"), F.col("resource").alias("tie"),
            "resource", F.lit(None).cast("string").alias("referrer"), F.lit(None).cast("string").alias("type"),
            F.lit(None).cast("bigint").alias("count"),
        )
    )
    return related.unionByName(_edge_sections(tables, resolved, fits))


def response_rows(tables: SearchTables, resolved: DataFrame, found: DataFrame, fits: bool) -> DataFrame:
    """:func:`findings` in display form with their ``rank``."""
    return ranked_findings(findings(tables, resolved, found, fits))


def response_pages(rows: DataFrame, resolved: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """One nested answer per term and page; pages in order are the whole answer.

    Page ``n`` holds the findings ranked ``n * page_rows + 1`` and on of all three
    sections, so no array has more than ``page_rows`` elements however much
    traffic a page has. Every term has page 0, empty where nothing was found.
    """
    placed = rows.select(
        "term", "status", "selected",
        F.floor((F.col("rank") - 1) / F.lit(page_rows)).cast("bigint").alias("page"),
        "section",
        F.struct("rank", "resource", "referrer", "type", "count").alias("entry"),
    )
    empty = resolved.select(
        "term", "status", "selected", F.lit(0).cast("bigint").alias("page"),
        F.lit(None).cast("string").alias("section"),
        F.lit(None).cast(placed.schema["entry"].dataType).alias("entry"),
    )

    def collected(section: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("section") == section, F.col("entry")))).alias(section)

    def without_rank(section: str) -> Column:
        fields = ("referrer", "resource", "type", "count")
        return F.transform(section, lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias(section)

    return (
        placed.unionByName(empty)
        .groupBy("term", "status", "selected", "page")
        .agg(*[collected(s) for s in SECTIONS])
        .select(
            "term", "status", "page", title_case(F.col("selected")).alias("selected"),
            F.transform(RELATED, lambda e: e["resource"]).alias(RELATED),
            without_rank(INCOMING),
            without_rank(OUTGOING),
        )
    )


def response_json(pages: DataFrame) -> DataFrame:
    """Answers as JSON text; an invalid term gets an error object."""
    answer = F.to_json(
        F.struct(
            F.col(RELATED).alias("relatedResources"),
            F.struct(F.col("selected").alias("selectedResource"), INCOMING, OUTGOING).alias("selectedResourceData"),
        ),
        {"ignoreNullFields": "false"},
    )
    # fixed value: the answer to a missing term
    error = F.lit('{"error":"Search term is required"}')
    return pages.select("term", "page", F.when(F.col("status") == "ok", answer).otherwise(error).alias("json"))


def response_text(pages: DataFrame) -> DataFrame:
    """Answers as lines of text: names joined by comma and blank, edges with their fields joined by bars."""

    def edges(section: str) -> Column:
        line = F.transform(
            section,
            lambda e: F.concat_ws("|", e["referrer"], e["resource"], e["type"], e["count"].cast("string")),
        )
        return F.array_join(line, ", ").alias(section)

    return pages.select(
        "term", "status", "page", "selected",
        F.array_join(RELATED, ", ").alias(RELATED), edges(INCOMING), edges(OUTGOING),
    )


def search(
    tables: SearchTables, terms: DataFrame, page_rows: int = PAGE_ROWS, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Answer every term: status, selected page, and pages of related, incoming and outgoing findings.

    Up to ``broadcast_rows`` query words are sent to all tasks, more are joined by shuffles.
    """
    prepared = pin(prepare_terms(terms), "terms")
    # a term's rows repeat its words and, later, its selected page, which is no longer than what was asked for the index
    fits = fits_broadcast(query_words(prepared.withColumn("wanted", F.col("norm"))), broadcast_rows)
    found = pin(
        fitting(hits(tables.index, prepared, fits)).select("term", "position", "resource", "exact", "contains_all"), "hits"
    )
    resolved = _resolve(prepared, select_fitting(found))
    return response_pages(response_rows(tables, resolved, found, fits), resolved, page_rows)
