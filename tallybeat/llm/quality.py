"""Quality and toxicity from weak labels.

Overlapping heuristics vote good, bad or nothing on every document. A weak-label model
with one hidden class counts the vote patterns of the whole corpus, at most three to the
power of the labellers, and estimates by expectation maximisation how often each labeller
is right. Where some documents carry labels by hand, a bounded number of them trains one
more labeller, which may be wrong like the others. Its posteriors label a bounded sample, on which a linear scorer over hashed
words is fitted; the scorer then judges every document by its words alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.llm.text import WORD, drawn, whole
from tallybeat.llm.wordhash import BLANK, MARKS, MIX1, MIX2, buffers, slices, word_hashes, word_ranges
from tallybeat.sources.tables import staged

#: Hash bits; documents, about, that the scorer is fitted on; steps and step size of the fit.
BITS, SAMPLE_DOCS, STEPS, RATE, SPARSE = 18, 4_000, 200, 2.0, 0.002
#: Bytes of a word's beginning that are a feature of longer words; fewest texts of a feature.
STEMS, FEWEST = (6, 8), 3
#: Most documents with labels by hand that train a labeller, about.
LABEL_DOCS = 4_000
#: Words of abuse.
ABUSE = "idiot stupid moron loser scum trash worthless dumb jerk imbecile vermin pathetic disgusting clown filth creep liar".split()


def vote(bad: Column, good: Column) -> Column:
    """0 bad, 1 good, -1 no vote."""
    return F.when(bad, 0).when(good, 1).otherwise(-1)


def quality_votes(text: Column) -> dict[str, Column]:
    n = F.regexp_count(text, F.lit(WORD))
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    shouts = F.regexp_count(text, F.lit(r"!!+"))
    bars = F.regexp_count(text, F.lit(r"\|"))
    ends = F.regexp_count(text, F.lit(r"[.?!](?=\s|$)"))
    upper = F.length(F.regexp_replace(text, r"\P{Lu}", ""))
    return {
        "symbols": vote(symbols * 4 > n, symbols * 50 <= n),
        "shouting": vote(shouts * 10 > n, shouts == 0),
        "bars": vote(bars * 10 > n, bars == 0),
        "sentences": vote(ends * 60 < n, (ends * 25 >= n) & (ends * 2 < n)),
        "capitals": vote(upper * 3 > F.length(text), upper * 10 < F.length(text)),
        "size": vote(n < 10, n >= 40),
    }


#: Votes on toxicity, where 0 means toxic; a list that finds nothing has no
#: opinion. The lists make one labeller: each for itself would count the same words again.
TOXIC_VOTES = ["listed", "taught_toxic"]


def label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """Probability of good for each vote pattern, from patterns and their counts.

    Expectation maximisation over the share of good documents and, for each labeller and
    class, how its votes fall. It starts from the majority, which tells the classes apart.
    """
    votes = np.array([p for p, _ in patterns])
    count = np.array([n for _, n in patterns], float)
    if not votes.shape[1]:
        return {p: 0.5 for p, _ in patterns}
    # A firm start: one class is rare, and soft guesses of the other would swamp it.
    good = np.where((votes == 0).sum(axis=1) * 2 > (votes == 1).sum(axis=1), 0.02, 0.98)
    for _ in range(rounds):
        weight = np.stack([count * (1 - good), count * good])
        prior = (weight.sum(axis=1) + 1) / (count.sum() + 2)
        log = np.log(prior)[:, None] + np.zeros((2, len(votes)))
        for j in range(votes.shape[1]):
            for c in (0, 1):
                share = np.array([weight[c][votes[:, j] == v].sum() + 0.5 for v in (-1, 0, 1)])
                log[c] += np.log(share / share.sum())[votes[:, j] + 1]
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return {p: float(g) for (p, _), g in zip(patterns, good, strict=True)}


def posteriors(rows: DataFrame, votes: list[str], out: str) -> DataFrame:
    """``rows`` with the posterior of good: the patterns are few, so their join is by value."""
    found = [(tuple(r[v] for v in votes), r["n"]) for r in rows.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).collect()]
    if not found:
        return rows.withColumn(out, F.lit(0.5))
    known = rows.sparkSession.createDataFrame(
        [(*p, g) for p, g in label_model(found).items()], ", ".join(f"{v} int" for v in votes) + f", {out} double"
    )
    return rows.join(F.broadcast(known), votes)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words, beginnings of words and closing marks: text number, feature."""
    ranges, begin, end, sizes = word_ranges(texts, lower=True, blank=MARKS)
    of = [np.repeat(np.arange(len(sizes)), sizes)]
    h = [ranges.hashed(begin, end)]
    for stem in STEMS:
        long_ = end - begin > stem
        h.append(ranges.hashed(begin[long_], begin[long_] + stem) * MIX2)
        of.append(of[0][long_])
    data, bounds = buffers(texts)
    ranges, begin, end, sizes = word_ranges(texts, lower=True, blank=BLANK)
    closed = MARKS[data[bounds[0] + end - 1]]
    h.append(ranges.hashed(np.maximum(begin, end - 2)[closed], end[closed]) * MIX1)
    of.append(np.repeat(np.arange(len(sizes)), sizes)[closed])
    pair = np.unique((np.concatenate(of) << BITS) | (np.concatenate(h) >> np.uint64(64 - BITS)).astype(np.int64))
    return pair >> BITS, pair & ((1 << BITS) - 1)


def fit(texts: pa.Array, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a sparse logistic scorer for soft targets, classes balanced.

    Proximal gradient steps, shorter for frequent features, on features of several texts.
    """
    parts = [(low, features(texts[low:high])) for low, high in slices(texts)]
    row = np.concatenate([np.zeros(0, np.int32), *[(low + r).astype(np.int32) for low, (r, _) in parts]])
    column = np.concatenate([np.zeros(0, np.int32), *[c.astype(np.int32) for _, (_, c) in parts]])
    del parts
    spread = np.bincount(column, minlength=1 << BITS)
    often = spread[column] >= FEWEST
    row, column = row[often], column[often]
    n = max(len(target), 1)
    share = np.clip(target.mean(), 0.01, 0.99) if len(target) else 0.5
    balance = (target / share + (1 - target) / (1 - share)) / 2
    scale = RATE / np.sqrt(np.maximum(spread, 1) / n)
    w, b = np.zeros(1 << BITS), 0.0
    for _ in range(STEPS):
        z = b + np.bincount(row, w[column], minlength=len(target))
        error = balance * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / n
        w = w - scale * np.bincount(column, error[row], minlength=1 << BITS)
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * SPARSE, 0)
        b -= RATE * error.sum()
    return w, b


def hashes_of(words: list[str]) -> np.ndarray:
    return word_hashes(pa.array(words), lower=True, blank=MARKS)[0]


def taught_vote(model: tuple[np.ndarray, float] | None, row: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
    """1 or 0 where a trained labeller is sure, else -1."""
    if model is None:
        return np.full(n, -1, np.int32)
    p = chance(model, row, column, n)
    return np.where(p >= 0.6, 1, np.where(p <= 0.4, 0, -1)).astype(np.int32)


def chance(model: tuple[np.ndarray, float], row: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
    weights, offset = model
    return 1 / (1 + np.exp(-np.clip(offset + np.bincount(row, weights[column], minlength=n), -50, 50)))


def sampled(texts: DataFrame, rows: int, most: int) -> DataFrame:
    """About ``most`` of ``rows`` distinct texts by a hash of the text, each once, whatever their ids."""
    return texts.filter(drawn(most / max(rows, 1), "text_key")).dropDuplicates(["text_key"])


def fitted(sample: DataFrame, targets: list[str]) -> list[tuple[np.ndarray, float] | None]:
    """A scorer for each target of a bounded (text, targets); None without rows."""
    table = sample.select("text", *targets).toArrow()
    if not table.num_rows:
        return [None for _ in targets]
    texts = pa.concat_arrays(table.column("text").chunks)
    return [fit(texts, table.column(t).to_numpy().astype(float)) for t in targets]


def taught(texts: DataFrame, labels: DataFrame | None) -> list[tuple[np.ndarray, float] | None]:
    """Labellers of quality and of mildness from documents labelled by hand."""
    if labels is None:
        return [None, None]
    gold = labels.filter("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), (1 - F.max("toxic")).alias("mild")
    )
    share = LABEL_DOCS / max(gold.count(), 1)
    known = texts.filter(drawn(share, "doc_id")).join(gold.filter(drawn(share, "doc_id")), "doc_id")
    return fitted(sampled(known, known.select("text_key").distinct().count(), LABEL_DOCS), ["quality", "mild"])


def judge(docs: DataFrame, labels: DataFrame | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, quality, toxic, quality_label, toxic_label, kept: one row per row of ``docs``.

    Needs doc_id and text, and of ``labels`` doc_id, quality and toxic (0 or 1); other
    columns are not read. A document is kept if its quality is at least a half and its
    toxicity, by words and by weak label, below a half. Null and empty texts have no words
    and are judged by their size; null ids are judged and sampled like others; rows that repeat
    get equal scores; without labels the trained labellers do not vote; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    own_votes = quality_votes(F.col("text"))
    teachers = spark.sparkContext.broadcast(taught(texts, labels))
    abuse = hashes_of(ABUSE)
    native, names = list(own_votes), [*own_votes, *TOXIC_VOTES, "taught_quality"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(2)):
                part = batch.slice(low, high - low)
                h, sizes = word_hashes(part.column(2), lower=True, blank=MARKS)
                of = np.repeat(np.arange(len(sizes)), sizes)
                hits = np.bincount(of[np.isin(h, abuse)], minlength=len(sizes))
                row, column = features(part.column(2))
                quality, mild = (taught_vote(m, row, column, len(sizes)) for m in teachers.value)
                found = [np.where(hits > 0, 0, -1).astype(np.int32)]
                kept = [part.column(i) for i in range(part.num_columns) if i != 2]
                yield pa.RecordBatch.from_arrays(
                    kept + [pa.array(x) for x in (*found, mild, quality)], ["doc_id", "text_key", *names]
                )

    voted = staged(
        texts.select("doc_id", "text_key", "text", *[x.cast("int").alias(k) for k, x in own_votes.items()]).mapInArrow(
            votes, f"doc_id {kind}, text_key bigint, " + ", ".join(f"{v} int" for v in names)
        ),
        "quality-votes",
    )
    labelled = staged(
        posteriors(posteriors(voted, [*native, "taught_quality"], "good"), TOXIC_VOTES, "mild").select(
            "doc_id", "text_key", "good", "mild"
        ),
        "quality-labels",
    )
    by_text = labelled.groupBy("text_key").agg(F.max("good").alias("good"), F.max("mild").alias("mild"))
    distinct = by_text.count()
    scorers = fitted(sampled(texts, distinct, sample_docs).join(by_text, "text_key"), ["good", "mild"])
    if distinct and None in scorers:
        raise RuntimeError("no text was sampled for the scorers")
    models = spark.sparkContext.broadcast(scorers)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                row, column = features(part.column(1))
                good, mild = (
                    np.full(high - low, 0.5) if m is None else chance(m, row, column, high - low) for m in models.value
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(good), pa.array(1 - mild)],
                    ["doc_id", "text_key", "quality", "toxic"],
                )

    scored = texts.mapInArrow(score, f"doc_id {kind}, text_key bigint, quality double, toxic double")
    weak = labelled.dropDuplicates(["doc_id", "text_key"]).withColumnsRenamed({"doc_id": "weak_id", "text_key": "weak_key"})
    own = F.col("doc_id").eqNullSafe(F.col("weak_id")) & (F.col("text_key") == F.col("weak_key"))
    return scored.join(weak, own).select(
        "doc_id",
        "quality",
        "toxic",
        F.col("good").alias("quality_label"),
        (1 - F.col("mild")).alias("toxic_label"),
        ((F.col("quality") + F.col("good") >= 1) & (F.col("toxic") < 0.5) & (F.col("mild") > 0.5)).alias("kept"),
    )
