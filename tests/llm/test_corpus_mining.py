"""Filter audit, phrases and repeated strings, each against a plain Python version on awkward rows."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageflow.llm import collocations, filter_audit, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{n % 977} and{n}" for n in range(4000))
MANY = " ".join(f"term{n} of {n % 40}" for n in range(120))
TEXTS = [
    None, "", " \t\n", "one two", "one two", "ONE TWO three", MANY, MANY, MANY + " more", MANY + "#", LONG, LONG + " %",
    "the same " * 150, "über größe 😀 " * 90, "A" + MANY, "UPPER CASE TEXT " * 80, "a" * 3000, "ab" * 900 + "cd" * 900,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, ["en", "de", None][n % 3], ["a", "b", None, ""][n % 4]) for n, t in enumerate(TEXTS)]
    rows += [(6, MANY, "en", "a"), (6, MANY, "en", "b"), (None, MANY, "de", "a"), (None, None, None, None), (100, "one two", "en", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("part", "flags", "n", "kept", "_id", "row", "low", "key", "word", "anchor", "_hash", "ranges"):
        df = df.withColumn(name, F.lit("x"))
    return df.withColumn("a b.c", F.lit(1)).repartition(3)


def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- filter audit


def fails(text):
    words = WORD.findall(text)
    return "".join(
        letter
        for letter, bad in zip(
            "ABCD",
            (
                len(words) < 200,
                100 * len(set(words)) < 50 * len(words),
                100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                re.search("[#$%&*|]", text) is not None,
            ),
            strict=True,
        )
        if bad
    )


def audited(rows, labels):
    least = {}
    for key, text, _, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    flagged = []
    for key, text, _, source in rows:
        again = key is not None and key > least[text or ""]
        good = any(k == key and q == 1 for k, q, _ in labels if k is not None)
        toxic = any(k == key and t == 1 for k, _, t in labels if k is not None)
        flagged.append((source or "", fails(text or "") + "E" * again, good, toxic))
    out, shapley = [], Counter()
    for order in permutations("ABCDE"):
        for part in {f[0] for f in flagged}:
            mine = [f for f in flagged if f[0] == part]
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                failing = [f for f in mine if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                shapley[part, letter] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(f[1] == letter for f in mine),
                            sum(f[2] for f in gone), sum(f[3] for f in gone)))
    return sorted(((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out), key=repr)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_against_every_order_run(spark, docs):
    labels = [(6, 1, 0), (6, 0, 1), (3, 0, 1), (None, 1, 1), (9, None, None), (77, 1, 1), (12, 1, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    assert found(filter_audit.audit(docs, table), *AUDIT) == audited(plain(docs), labels)


def test_audit_of_an_empty_table_and_of_one_text(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    same = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(" ".join(f"w{n}" for n in range(250))).alias("text"), F.lit("s").alias("source"))
    last = filter_audit.audit(same, labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (last["kept"], last["removed"], last["unique_fails"]) == (1, 499, 499)


def test_trie_holds_the_least_id_of_each_text():
    random.seed(3)
    texts = ["".join(random.choices("ab", k=random.randrange(9))).encode() for _ in range(600)]
    trie, numbers, least = filter_audit.Trie(), {}, {}
    for key, text in zip(random.sample(range(600), 600), texts, strict=True):
        assert numbers.setdefault(text, trie.insert(text, key)) == trie.insert(text, None)
        least[text] = min(key, least.get(text, key))
    assert {t: trie.least[n] for t, n in numbers.items()} == least and len(trie.least) == len(least)


def test_range_bounds_tell_texts_with_one_long_beginning_apart(spark):
    texts = spark.range(400).select(F.concat(F.lit("same beginning " * 50), F.lpad(F.col("id").cast("string"), 5, "0")).alias("text"))
    bounds = filter_audit.range_bounds(texts, 8, 400 * 755)
    assert 4 <= len(bounds) <= 16 and all(750 < len(b) <= 755 for b in bounds)


def test_range_bounds_of_a_sample_over_many_tasks(many_partitions):
    texts = many_partitions.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("text"))
    before = many_partitions.conf.get("spark.sql.shuffle.partitions")
    many_partitions.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        bounds = filter_audit.range_bounds(texts, 60, 4000 * 64)
    finally:
        many_partitions.conf.set("spark.sql.shuffle.partitions", before)
    assert 30 <= len(bounds) <= 90 and max(map(len, bounds)) < 8


# --- phrases


def phrases(rows, least, share, top):
    counts, total = {1: Counter(), 2: Counter(), 3: Counter()}, Counter()
    for _, text, lang, _ in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size, held in counts.items():
                held.update((lang or "und", *words[k : k + size]) for k in range(len(words) - size + 1))
    kept = {p: a for size in (2, 3) for p, a in counts[size].items() if a >= least}
    out = []
    for p, a in kept.items():
        lang, words = p[0], p[1:]
        if any(q[0] == lang and len(q) == 4 and words in (q[1:3], q[2:4]) and 100 * b >= share * a for q, b in kept.items() if len(p) == 3):
            continue
        cuts = []
        for k in range(1, len(words)):
            x, y = counts[k][lang, *words[:k]], counts[len(words) - k][lang, *words[k:]]
            cuts.append((1000000 * a * a // (x * y), k, x, y))
        score, _, x, y = min(cuts)
        out.append((lang, " ".join(words), a, x, y, total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], n, *r[1:]) for n, r in enumerate(mine[:top], 1)]
    return sorted(ranked, key=repr)


PHRASES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("ranked, most_bits", [(1 << 18, 27), (7, 10), (1, 6)])
def test_phrases_against_plain_counts(docs, ranked, most_bits):
    """Also with nearly everything counted under its hash, and a bit table that rules nothing out."""
    expected = phrases(plain(docs), 3, 50, 60)
    assert len(expected) > 100
    assert found(collocations.top_phrases(docs, least=3, top=60, ranked=ranked, most_bits=most_bits), *PHRASES) == expected


def test_no_phrases(spark, docs):
    assert collocations.top_phrases(docs.limit(0)).count() == 0
    assert collocations.top_phrases(docs.where("doc_id = 3")).count() == 0


def test_large_counts_stay_exact(spark):
    a = 10**14 + 7
    best = spark.range(1).select(F.lit(a).alias("n"), F.lit(a + 1).alias("x"), F.lit(a + 3).alias("y")).select(
        *collocations._scored("n", [("x", "y"), ("y", "y")])
    ).first()["best"]
    assert best["score"] == min(10**6 * a * a // ((a + 1) * (a + 3)), 10**6 * a * a // ((a + 3) ** 2))


def test_tiles_count_like_a_counter():
    rng = np.random.default_rng(5)
    left = np.concatenate((rng.integers(0, 300, 60_000), rng.integers(0, 5000, 3000)))
    right = np.concatenate((rng.integers(0, 40, 60_000), rng.integers(0, 5000, 3000)))
    x, y, n = collocations.count_cells(left, right, 5000)
    assert dict(zip(zip(x.tolist(), y.tolist(), strict=True), n.tolist(), strict=True)) == Counter(zip(left.tolist(), right.tolist(), strict=True))
    assert [len(c) for c in collocations.count_cells(left[:0], right[:0], 1)] == [0, 0, 0]


# --- repeated strings


def removed(rows, length):
    seen = Counter()
    data = [(key, (text or "").encode()) for key, text in rows]
    for _, text in data:
        seen.update(text[k : k + length] for k in range(len(text) - length + 1))
    out = []
    for key, text in data:
        gone = bytearray(len(text))
        for k in range(len(text) - length + 1):
            if seen[text[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        left = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((key, len(text), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


DIGEST = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def noise(rng, size):
    return "".join(rng.choices("abcdefgh  é", k=size))


@pytest.fixture(scope="module")
def copied():
    """Texts with shared passages of all lengths round the limit, near copies, and strings that repeat themselves."""
    rng = random.Random(11)
    passages = [noise(rng, size) for size in (20, 39, 40, 41, 60, 200)]
    template = noise(rng, 700)
    texts = []
    for n in range(60):
        text = noise(rng, rng.randrange(150)) + rng.choice(passages) + noise(rng, rng.randrange(100)) + rng.choice(passages)
        texts.append(text)
        at = rng.randrange(700)
        texts.append(template[:at] + str(n) + template[at + rng.randrange(3) :])
    return [*texts, texts[0], "x" * 90, "xy" * 70, "x" * 39, "z" * 41, "😀" * 30, "q" + "😀" * 12, template, template + "!"]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 600])
@pytest.mark.parametrize("gram", [8, 32])
def test_removed_bytes_against_all_windows(spark, copied, shard_bytes, gram):
    rows = list(enumerate(copied)) + [(7, copied[3]), (7, copied[7]), (None, copied[9]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    result = suffix_dedup.remove_repeats(docs, length=40, gram=gram, shard_bytes=shard_bytes)
    assert found(result, *DIGEST) == removed(rows, 40)


def test_removed_bytes_of_awkward_rows(docs):
    rows = [(r[0], r[1]) for r in plain(docs)]
    result = suffix_dedup.remove_repeats(docs, text_too=True)
    assert found(result, *DIGEST) == removed(rows, 400)
    assert {r["kept"] for r in result.where("doc_id = 16").collect()} == {""}
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_a_text_longer_than_a_block(spark):
    rng = random.Random(2)
    shared = noise(rng, 900)
    long = "".join(rng.choices("abcdefghijklmnop", k=suffix_dedup.BLOCK - 500)) + shared + "".join(rng.choices("abcdefghijklmnop", k=5000))
    docs = spark.createDataFrame([(1, long), (2, "left of it " + shared), (3, "ab")], "doc_id long, text string")
    result = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    size = len(shared.encode())
    assert result == {1: (size, 1), 2: (size, 1), 3: (0, 0)}


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_suffix_array_and_common_prefixes(letters):
    rng = random.Random(7)
    part = "".join(rng.choices(letters, k=300))
    data = (part + "x" + part[100:] + "abcabc" * 40 + part[:180] + "\0" + part[50:200] + "\0\0z").encode()
    order = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8)).tolist()
    assert order == sorted(range(len(data)), key=lambda p: data[p:])
    for most in (10, 40, 64):
        shared = suffix_dedup.common_prefixes(np.frombuffer(data, np.uint8), np.array(order), most).tolist()
        for at, (p, q) in enumerate(zip(order, order[1:], strict=False), 1):
            if max(p, q) + most <= len(data):
                assert shared[at] == next((k for k in range(most) if data[p + k] != data[q + k]), most)
