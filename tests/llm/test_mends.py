"""Cases that need whole results: ties, short documents in many shards, very long texts."""

import time
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import plan_of
from pyspark.sql import functions as F

import corpus_pipeline
from tallybeat.llm import bpe, components, forest, langid, mixing, pii, rules, secrets, text


def test_nearest_with_many_ties(spark):
    """Vectors of zeros and ones have few different scores; with all rows as candidates nothing is missed."""
    rng = np.random.default_rng(4)
    vectors = rng.integers(0, 2, (1500, 16))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors) if v.any()] + [(7, [1.0] * 16), (3000, [1.0] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    s = forest.Settings(visits=1e9, rows=400, queries=40)
    found = {}
    for r in forest.nearest(table, F.col("vec_id") % 20 == 0, 20, s).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    for i, v in rows:
        if i % 20 == 0:
            scores = matrix @ np.array(v)
            best = sorted((-s, int(j)) for s, j in zip(scores, ids) if j != i)[:20]
            assert [found[i][n + 1] for n in range(20)] == [(j, -s) for s, j in best]


@pytest.mark.parametrize(("words", "count"), [(2, 400), (1, 700), (3, 50)])
def test_mix_of_short_documents_comes_near_its_target(spark, words, count):
    """A small source of short texts, dealt over more shards than it has blocks."""
    rows = [(i, "w " * words, "a") for i in range(count)] + [(10_000 + i, "x " * 100, "b") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    taken, target = Counter(), {}
    for r in mixing.mix(docs, shard_words=2000).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    for source in target:
        assert abs(taken[source] - target[source]) <= 32, (source, taken, target)
    assert target["+a"] == pytest.approx(3 * words * count)


@pytest.fixture(scope="module")
def long_text():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(3000)]
    picked = rng.integers(0, len(words), 200_000)
    return " ".join(f"m{i}@mail.example.com" if i % 11 == 0 else words[w] for i, w in enumerate(picked))


def test_text_of_200000_words(spark, long_text):
    """Work follows the text: seconds, not a square of its words or of its matches."""
    docs = spark.createDataFrame([(1, long_text), (2, "")], "doc_id long, text string").cache()
    docs.count()
    begin = time.perf_counter()
    found = pii.scan(docs).filter("doc_id = 1").first()
    assert found.email == len(found.spans) == 18_182
    assert all(long_text[s.start : s.end].endswith("@mail.example.com") for s in found.spans[::500])
    secrets.scan(docs).collect()
    assert rules.rule_report(docs).filter("doc_id = 1").first().n_words == 200_000
    assert time.perf_counter() - begin < 120


def test_placed_and_replaced_across_runs(spark):
    """More matches than a run holds, at its border and beyond; chains of overlapping spans."""
    for n in (1, 255, 256, 257, 513, 1000):
        line = "".join(f"{'é' * (i % 3)}{i} " for i in range(n))
        row = spark.createDataFrame([(line,)], "t string").withColumn("f", text.found(F.col("t"), "[0-9]+"))
        row = row.withColumn("at", text.placed(F.col("t"), "[0-9]+", F.col("f")))
        row = row.withColumn("spans", text.as_spans(F.col("at"), "n", 0))
        got = row.select("at", text.replaced(F.col("t"), F.col("spans"), lambda s: F.lit("#")).alias("r")).first()
        assert [line[m.start : m.end] for m in got["at"]] == [str(i) for i in range(n)]
        assert got.r == "".join(f"{'é' * (i % 3)}# " for i in range(n))
    spans = [(2, 0, 5, "k"), (3, 0, 9, "k"), (4, 0, 6, "k"), (9, 0, 10, "k"), (12, 0, 13, "k")]
    frame = spark.createDataFrame([("0123456789abcdef", spans)], f"t string, s {text.SPAN}")
    assert frame.select(text.replaced(F.col("t"), F.col("s"), lambda s: F.lit("#"))).first()[0] == "01##ab#def"


def test_components_merge_step_by_step(spark):
    """Labels after links in three parts are those of all links at once."""
    rng = np.random.default_rng(6)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))]
    chain = [(1000 + i, 1001 + i) for i in range(60)]
    parts = [links[:100], links[100:200] + chain[::2], links[200:] + chain[1::2], []]
    table = lambda rows: spark.createDataFrame(rows, "u long, v long")
    labels = components.components(table(parts[0]))
    for part in parts[1:]:
        labels = components.merged(labels, table(part))
    found = Counter(map(tuple, labels.collect()))
    assert found == Counter(map(tuple, components.components(table(links + chain)).collect()))
    assert components.components(table([])).count() == 0
    assert components.merged(components.components(table([])), table([(2, 1)])).count() == 2


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like those that the stages make for themselves come through as they were given."""
    names = "_key _times _source _id _copy _size _taken _rows _spans _body _lettered _text_key given key party worded score lang_pred".split()
    fields = ", ".join(f"{n} string" for n in names)
    rows = [(i, f"the old house by the river number {i} was sold to a quiet family " * 6, "en", "a", 5, *names) for i in range(30)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {fields}")
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, docs, "")
        assert found.columns == docs.columns, name
        assert {tuple(r[n] for n in names) for r in found.collect()} == {tuple(names)}, name
        assert stage(spark, docs.limit(0), "").count() == 0, name


def test_long_word_and_plan_without_constants(spark):
    """A word of 20,000 letters takes a heap's time; the ranks are not spelled out in the plan."""
    ranks = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    by_bytes = {piece: rank for rank, piece in ranks.pieces.items()}
    own = tiktoken.Encoding("own", pat_str=ranks.pattern, mergeable_ranks=by_bytes, special_tokens={})
    texts = ["abcdefgh" * 2500, None, "", "one two  two", "语" * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = bpe.round_trip(rows, ranks, with_ids=True)
    assert "Subquery" not in plan_of(found) and len(plan_of(found)) < 20_000
    assert {r.doc_id: r.ids for r in found.collect()} == {i: own.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_scoring_holds_a_slice_of_the_texts(spark):
    """A batch of 20 MB of texts is scored by parts, with the code lengths of each text alone."""
    rows = [(i, w * 40, lang) for i, (w, lang) in enumerate([("the cat sat ", "en"), ("le chat dort ", "fr")] * 8)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = pa.array([f"le chat {i} sat on the mat, " * 700 for i in range(1000)] + ["", "the cat", "x" * 2 * langid.CHUNK])
    tracemalloc.start()
    bits = langid.total_bits(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6 and bits.shape == (1003, 2)
    for i in (0, 500, 1000, 1001, 1002):
        assert np.allclose(bits[i], langid.total_bits(model, texts.slice(i, 1))[0])
    assert langid.total_bits(model, texts.slice(0, 0)).shape == (0, 2)
