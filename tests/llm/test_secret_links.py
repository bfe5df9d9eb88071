"""Secret scan: spans against a plain scan, linking, and the SQL twin on made-up texts."""

import hashlib
import re

import duckdb
import pytest

from pageflow.llm import secret_links
from pageflow.llm.oracle import ORACLE

KEY, VALUE = "AKIA" + "B" * 16, "aB3" * 9
TEXTS = [
    None,
    "",
    "no secret here, token = short, AKIA123",
    "päss 😀 password=token:abcdefghijklmnop PASSWD: 'abcdefghijkl' " + "0123456789abcdef" * 2,
    f"{KEY} then {VALUE} at https://host.example/x?y=1",
    f"{VALUE} alone",
    f"{KEY}\n \n{VALUE}",
    f"{KEY}{' x' * 200} {VALUE}",
    f"{VALUE} {VALUE} login: someone https://a.b/c",
    f"user=me and secret: {VALUE}",
    f"\n\n{KEY} {VALUE} {'y ' * 5000}{KEY} {VALUE}",
    "ASIA" + "Q" * 14 + f" s3://bucket/key {VALUE}",
]
ASSIGN = re.compile(secret_links.ASSIGN)


def base_spans(text):
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    for order, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 18), (2, "hex", "[0-9a-f]+", 16)):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [s for _, _, s in sorted(found)]


def linked_spans(text, reach=300):
    """Pairs of all parts, straight from the definition."""
    strong = [(*map(int, s.split(":")[1:]), "id" if s.startswith("access") else "secret", "") for s in base_spans(text)]
    weak = []
    for kind in secret_links.KINDS[3:-1]:
        pattern = kind.pattern
        for m in re.finditer(pattern, text):
            if not any(a < m.end() and m.start() < e for a, e, _, _ in strong):
                weak.append((m.start(), m.end(), kind.role, kind.name))
    out = []
    for a, e, role, name in weak:
        roles = set()
        for b, _, other, _ in strong + weak:
            if abs(a - b) <= reach and not re.search(r"\n[ \t\r]*\n", text[min(a, b) : max(a, b)]):
                roles.add(other)
        need = {"secret": {"id"}, "id": {"secret"}, "endpoint": {"id", "secret"}}[role]
        if need <= roles:
            out.append(f"{name}:{a}:{e}")
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "clash") for n, t in enumerate(TEXTS)] + [(None, TEXTS[4], "x"), (4, TEXTS[4], "x"), (4, TEXTS[5], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_digest_against_a_plain_scan(docs):
    expected = []
    for row in docs.collect():
        text = row["text"] or ""
        base, linked = base_spans(text), linked_spans(text)
        joined = sorted(base + linked, key=lambda s: (int(s.split(":")[1]), [k.name for k in secret_links.KINDS].index(s.split(":")[0])))
        counts = [sum(s.startswith(k) for s in base) for k in secret_links.STRONG]
        expected.append((row["doc_id"], *counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(joined)))
    found = [tuple(r) for r in secret_links.digest(docs).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert sum("linked" in r[-1] for r in found) >= 5


def test_sql_twin(docs):
    sql = duckdb.connect()
    sql.register("documents", docs.toPandas())
    cursor = sql.execute(ORACLE["op4_secret_links"])
    names = [c[0] for c in cursor.description]
    found = [tuple(r) for r in secret_links.digest(docs).select(*names).collect()]

    def tidy(rows):
        return sorted([tuple(None if v != v else v for v in r) for r in rows], key=repr)

    assert tidy(found) == tidy(cursor.fetchall())


def test_dropping_keeps_clean_rows(docs):
    left = [(r["doc_id"], r["text"]) for r in secret_links.drop_secret_rows(docs).collect()]
    assert sorted(left, key=repr) == sorted([(n, TEXTS[n]) for n in (0, 1, 2, 5)] + [(4, TEXTS[5])], key=repr)


def test_empty_table(spark, docs):
    assert secret_links.digest(docs.limit(0)).count() == 0
