"""Each operator on a small table of awkward rows, against plain Python versions where results are fixed."""

import hashlib
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from pageflow.llm import decontaminate, jaccard, language, main_text, mixing, quality, rules, sampling, shipping, suffix_tree, warc
from pageflow.llm.words import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{n % 977} and{n}" for n in range(4000))
PARTS = [f"the {n} quick brown foxes jump over lazy dog number {n * 7} today" for n in range(12)]
TEXTS = [
    None,
    "",
    " \t\n",
    "one two",
    "One two",
    "ONE  two\n",
    " ".join(PARTS),
    " ".join([*PARTS[:-1], PARTS[-1] + " extra"]),
    " ".join(PARTS[:6]),
    LONG,
    LONG.replace("word5 ", "other "),
    "über größe naïve 😀 text\n\nsame line\nsame line\n" + "again and again we say the same eight words here " * 4,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "en" if n % 2 else None, "a" if n % 3 else None, "x", 1) for n, t in enumerate(TEXTS)]
    rows += [(6, TEXTS[6], "en", "b", "x", 1), (None, TEXTS[6], "en", "b", "x", 1), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string, row int").repartition(3)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fold(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- similarity join


def grams(text, n=4):
    w = words(lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(rows, percent=85):
    sets = [grams(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def test_similar_groups_against_all_pairs(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted_rows(jaccard.similar_groups(docs), "doc_id", "n_shingles", "component_id") == components(rows)


def test_similar_groups_of_random_texts(spark):
    random = np.random.default_rng(3)
    rows, base = [], []
    for n in range(150):
        if not base or random.random() < 0.3:
            base.append([str(random.integers(60)) for _ in range(random.integers(1, 120))])
        text = list(base[random.integers(len(base))])
        for _ in range(random.integers(0, 4)):
            text[random.integers(len(text))] = "changed"
        rows.append((n, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted_rows(jaccard.similar_groups(df), "doc_id", "n_shingles", "component_id") == components(rows)


def test_keep_first_leaves_one_of_each_group(docs):
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = {c for _, n, c in components(rows) if n}
    assert [i for i in ids if i is not None and words(TEXTS[i])] == sorted(expected, key=repr)


# --- benchmark search


def test_benchmark_items_are_found_and_clean_rows_stay(spark):
    item = "what is the name of the long river that flows through the old town in the far north of the country"
    benchmark = spark.createDataFrame(
        [(1, item, "the long river"), (2, None, None), (3, "", "")], "item_id long, text string, answer string"
    )
    reworded = item.replace("old town", "old city").replace("far north", "north")
    rows = [(1, f"{PARTS[1]} {item} the long river {PARTS[2]}", 0), (2, reworded + " the long river", 0), (3, PARTS[3], 0), (4, None, 0), (5, "", 0), (1, PARTS[4], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    # the latent space needs a corpus; none of its documents holds the item
    corpus = spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit(0).alias("item_id"))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs.union(corpus), benchmark).collect()}
    assert found == {(1, 1), (2, 1)}
    left = decontaminate.drop_leaking_rows(docs.union(corpus), benchmark)
    assert left.columns == docs.columns
    assert left.where("doc_id >= 1000").count() == corpus.count()
    assert sorted_rows(left.where("doc_id < 1000"), "doc_id", "text") == sorted([(1, PARTS[4]), (3, PARTS[3]), (4, None), (5, "")], key=repr)
    assert decontaminate.drop_leaking_rows(docs.limit(0), benchmark).count() == 0
    assert decontaminate.drop_leaking_rows(docs, benchmark.limit(0)).count() == len(rows)


def test_common_length_is_the_longest_common_subsequence():
    random = np.random.default_rng(5)
    for _ in range(30):
        a, b = (random.integers(0, 6, random.integers(1, 90)).astype(np.uint16) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_length(a, b) == table[-1, -1]


# --- quality rules and scores


def base_signals(text):
    w = words(text)
    found = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {k for i in range(len(w) - 7) if found[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(inside), failed


def test_rule_signals_against_plain_counts(docs):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = rules.judge(docs)
    assert sorted_rows(judged, *names) == sorted([(r["doc_id"], *base_signals(r["text"])) for r in docs.collect()], key=repr)
    assert judged.where("kept AND base_failed").count() == 0
    assert rules.judge(docs.limit(0)).count() == 0


def test_quality_scores_every_row(spark, docs):
    labels = spark.createDataFrame([(n, n % 2) for n in range(12)] + [(None, 1), (3, None)], "doc_id long, quality int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in found if r["doc_id"] is not None)
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_suffix_tree_base_score(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # the end of a text is no word, so that it cannot be mistaken for one
    tokens = [[*words(lower(t)), None] for _, t in rows]
    scored = suffix_tree.score_documents(docs).collect()
    held_out = {r["doc_id"]: r["held_out"] for r in scored}
    assert all(held_out[d] == (fold(d, 5) == 1) for d, _ in rows if d is not None)
    # with null ids the fold is the engine's own choice
    count = Counter(w for (d, _), ts in zip(rows, tokens, strict=True) if not held_out[d] for w in ts)
    n, v = sum(count.values()), len(count)
    expected = sorted(
        (repr(d), len(ts), sum(count[w] > 0 for w in ts), n, round(sum(log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts), 6))
        for (d, _), ts in zip(rows, tokens, strict=True)
    )
    found = sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in scored)
    assert found == expected and all(r["score"] < 0 for r in scored)
    assert suffix_tree.score_documents(docs.limit(0)).count() == 0


# --- languages


def test_language_of_every_row(spark, docs):
    found = language.digest(docs).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["lang_pred"] == "und" for r in found if r["doc_id"] in (0, 1, 2))
    assert all(r["lang_pred"] == "en" for r in found if r["doc_id"] in (3, 4, 6))
    assert language.digest(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.digest(docs.where("lang IS NULL")).collect()} == {"und"}


# --- mixing


def test_mix_comes_near_its_targets(docs):
    sized = mixing.with_size(docs)
    assert sorted_rows(sized, "doc_id", "size") == sorted([(r["doc_id"], len(words(r["text"]))) for r in docs.collect()], key=repr)
    mixed = mixing.mix_sources(sized).collect()
    assert len(mixed) == docs.count()
    totals, caps = Counter(), {}
    for r in mixed:
        assert r["taken"] <= 3 * r["size"]
        totals[r["source"]] += r["taken"]
        caps[r["source"]] = (r["target"], r["source_size"])
    biggest = max(r["size"] for r in mixed)
    assert all(abs(totals[s] - t) <= biggest and t <= 3 * size + 1e-6 for s, (t, size) in caps.items())
    assert sum(t for t, _ in caps.values()) == pytest.approx(sum(r["size"] for r in mixed))
    assert mixing.repeat_rows(mixing.mix_sources(mixing.with_size(docs.limit(0)))).count() == 0


# --- pages


def test_warc_round_trip(spark):
    big = "<p>" + "é" * 600 + "</p>"
    rows = [(1, "http://a.b/1", big), (2, None, big), (3, "http://a.b/3", None), (4, "u", ""), (5, "u", "<b>x</b>"), (6, "u", "<b>x</b>"), (7, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    found = warc.round_trip(spark, pages)
    expected = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        again = html == big and page_id != 7
        expected.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", 7 if again else None))
    assert sorted_rows(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(expected, key=repr)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_main_text_keeps_the_article_only(spark):
    article = "".join(f"<p>This is paragraph {n} of the article, with &amp; enough words, commas, and sense to be read.</p>" for n in range(5))
    html = (
        "<html><head><title>t</title><script>var x = 1;</script></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>More</a></li></ul></nav>"
        f"<div class='content'><article>{article}</article></div><footer>Copyright by someone</footer></body></html>"
    )
    pages = spark.createDataFrame([(1, "u", html, 0), (2, None, None, 0), (3, "u", "", 0), (1, "u", html, 0)], "page_id long, url string, html string, n_chars int")
    found = sorted_rows(main_text.extract_pages(pages), "page_id", "text", "n_chars")
    text = "\n".join(f"This is paragraph {n} of the article, with & enough words, commas, and sense to be read." for n in range(5))
    assert found == sorted([(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0)], key=repr)
    assert main_text.extract_pages(pages.limit(0)).count() == 0


def test_texts_have_plain_offsets():
    texts = Texts(np.frombuffer(b"ab cd", np.uint8), np.array([0, 2, 5]))
    assert len(texts) == 2


def test_every_archive_is_read_by_a_task_of_its_own(spark, tmp_path):
    pages = spark.range(600).select(
        F.concat(F.lit("p/"), "id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("html")
    ).repartition(3)
    folder = f"file://{tmp_path}/warc"
    archives = warc.write_archives(pages, folder, archive_bytes=20_000)
    n = archives.count()
    read = warc.read_archives(archives, folder, id_type="string")
    assert n >= 10 and read.rdd.getNumPartitions() == n
    tasks = read.select(F.spark_partition_id().alias("task"), "page_id").groupBy("task").count()
    assert tasks.count() >= n * 0.9
    assert sorted_rows(read, "page_id") == sorted_rows(pages, "page_id")


def test_archives_listed_in_many_parts_are_read_by_a_task_each(spark, tmp_path):
    pages = spark.range(60).select("id", F.lit("u").alias("url"), F.lit("x").alias("html")).withColumnRenamed("id", "page_id")
    folder = f"file://{tmp_path}/warc"
    archives = warc.write_archives(pages, folder, archive_bytes=1).repartition(20)
    tasks = warc.read_archives(archives, folder).select(F.spark_partition_id().alias("task")).distinct()
    assert archives.count() >= 20 and tasks.count() == archives.count()


def test_text_ids_in_archives(spark):
    same = "x" * 1200
    pages = spark.createDataFrame([("a b", None, same), ("", "u", same), ("<ü>:%", "u", "y"), (None, "u", same)], "page_id string, url string, html string")
    found = sorted_rows(warc.round_trip(spark, pages), "page_id", "record_type", "refers_to", "verified")
    assert found == sorted(
        [("a b", "response", None, True), ("", "revisit", "a b", True), ("<ü>:%", "response", None, True), (None, "revisit", "a b", True)], key=repr
    )


# --- work of the similarity join


def test_a_template_is_not_paired(spark):
    """Copies of one template with some words of their own: nothing links, and work grows with the copies."""
    template = " ".join(f"t{n}" for n in range(100))

    def met(copies):
        rows = [(n, template + "".join(f" own{n}x{k}" for k in range(9 + n % 3))) for n in range(copies)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        held = jaccard.posted_sets(docs, jaccard.count_frequent(docs, 4), 4, 85).withColumnRenamed("row", "node")
        posted = jaccard._unpacked(jaccard.shared_postings(held, 85).withColumnRenamed("packed", "packed_x"), "x")
        postings = posted.select("gram", "node", F.col("node").alias("component"), F.col("size_x").alias("size"), F.col("at_x").alias("at"))
        assert sorted_rows(jaccard.similar_groups(docs), "doc_id", "component_id") == sorted(((n, n) for n in range(copies)), key=repr)
        return jaccard.meeting_rows(postings, 85).count()

    assert met(300) <= 2 * met(150) + 100


def test_repeated_rows_do_not_enlarge_a_sample(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 9).alias("text"), F.lit("en").alias("lang")
    )
    one = sampling.one_per_id(rows, "lang")
    assert one.count() == 1001 and one.where("doc_id = 7").count() == 1


def test_batches_end_by_size(spark):
    """A batch of rows with long texts is cut, rows are not; a limit that the session states is left alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    long_texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 8000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "b"])

    try:
        spark.conf.unset(key)
        found = shipping.map_arrow(long_texts, sizes, "n long, b long").collect()
        assert sum(r["n"] for r in found) == 3000 and max(r["b"] for r in found) < 2 * shipping.BATCH_BYTES
        spark.conf.set(key, str(1 << 30))
        assert shipping.map_arrow(long_texts, sizes, "n long, b long").count() == 1
    finally:
        spark.conf.unset(key)
