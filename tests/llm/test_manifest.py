"""Merkle manifest and proofs against trees built in plain Python."""

import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from tallybeat.llm import merkle, queries, twins

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, n int"


def h(text):
    return sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars):
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(levels, place):
    out = []
    for level in levels[:-1]:
        run = place - place % 3
        out.append(("".join(level[run:place]), "".join(level[place + 1 : run + 3])))
        place //= 3
    return out


def plain(rows):
    if not rows:
        return
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for own in by_source.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    trees = {s: tree([leaf(*r) for r in own]) for s, own in by_source.items()}
    top = tree([trees[s][-1][0] for s in order])
    root = top[-1][0]
    for number, source in enumerate(order):
        for place, (doc_id, text, *rest) in enumerate(by_source[source]):
            steps = path(trees[source], place) + path(top, number)
            copy = text
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                copy = text.replace("\n", "")
            node = leaf(doc_id, copy, *rest)
            for left, right in steps:
                node = h(left + node + right)
            proof = h("".join(a + b for a, b in steps))
            yield doc_id, leaf(doc_id, text, *rest), trees[source][-1][0], root, proof, node, node == root


def digests(found):
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("left"), F.col("right")), "folded_root", "verified"
    )


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"line {i}\nnext {i % 5}", "en", "hot", i) for i in range(300)]
    out += [(i, "one text\n" if i % 2 else None, None, f"s{i % 9}", None) for i in range(300, 340)]
    out += [(None, f"no id {i}\n", "en", None, 3) for i in range(4)] + [(400, "", "é", "é", 0), (401, "x", "en", "", 1)]
    out += [(7, f"again\n{i % 3}", "en", "hot", 1) for i in range(30)]  # one id, repeated rows
    return out + [(500, "long " * 200_000 + "\n", "en", "alone", 1_000_001)]


@pytest.mark.parametrize("every", [1, 2, 4])
def test_against_plain(spark, rows, every):
    docs = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA).repartition(5)
    found = digests(merkle.audit(docs, every)).collect()
    assert Counter(map(tuple, found)) == Counter(plain(rows))
    assert 0 < sum(r.verified for r in found) < len(found)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 27, 28, 82])
def test_sizes(spark, size):
    rows = [(i, f"t{i}", "en", "a", i) for i in range(size)]
    docs = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)
    assert Counter(map(tuple, digests(merkle.audit(docs, 2)).collect())) == Counter(plain(rows))


def test_proofs_are_whole_and_any_change_shows(spark, rows):
    """The manifest itself returns siblings; another leaf, or another id's proof, does not fold."""
    small = rows[:40]
    docs = spark.createDataFrame([(*r, "clash", "clash", 1) for r in small], SCHEMA)
    leaves = docs.select("doc_id", "source", merkle.document_leaf(F.col("text")).alias("leaf"))
    found = merkle.manifest(leaves, every=2)
    assert found.columns == ["doc_id", "source", "leaf", "subroot", "root", "left", "right"]
    assert merkle.verified(found, F.col("leaf")).filter("verified").count() == 40
    assert merkle.verified(found, F.sha2("leaf", 256)).filter("verified").count() == 0
    sizes = found.select(F.explode(F.zip_with("left", "right", lambda a, b: F.length(a) + F.length(b)))).distinct()
    assert {r[0] for r in sizes.collect()} <= {0, 64, 128}


def test_twin_on_odd_rows(spark, rows, tmp_path):
    """The SQL twin states the same over nulls, ties and repeats."""
    docs = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows[:-1]], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    relation = database.sql(twins.MANIFEST)
    found = queries.op13_manifest(spark, str(tmp_path))
    assert relation.columns == found.columns
    assert Counter(relation.fetchall()) == Counter(map(tuple, found.collect()))
