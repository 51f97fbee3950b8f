"""Secrets: fixed patterns, and random strings told from identifiers by two Markov models.

A first-order character model of secrets and one of ordinary identifiers are counted from
labelled samples; a long token whose log-likelihood ratio is above a margin is a secret.
The counts are sums over character pairs, bounded by the square of the alphabet, so the
model is one literal array in the plan and scoring stays inside the scan.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.llm import text as t
from tallybeat.sources.tables import staged

#: The kinds in order, their patterns, least length of what counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8

#: Tokens that the models judge, and the characters of identifiers.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_-]{5,}"
#: Documents, about, whose words are samples of identifiers; pseudo-count of each pair;
#: log-likelihood ratio (nats) above which a token is a secret.
SAMPLE_DOCS, SMOOTH, MARGIN = 2000, 0.5, 10.0
WIDTH = 128


def base_matches(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and the placed matches: assign, access, hex, tokens."""
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "tokens": TOKEN}
    rows = docs.select("doc_id", t.whole(F.col("text")).alias("text"))
    rows = rows.withColumns({f"{k}_found": t.found(F.col("text"), p) for k, p in patterns.items()})
    rows = rows.withColumns({k: t.placed(F.col("text"), p, F.col(f"{k}_found")) for k, p in patterns.items()})
    value = lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 1))
    return rows.select(
        "doc_id",
        F.filter("assign", lambda m: value(m) >= LEAST_VALUE).alias("assign"),
        "access",
        "hex",
        "tokens",
    )


def pair_counts(samples: DataFrame) -> DataFrame:
    """(label, text) -> label, pair, n; a pair is two ASCII codes as one number."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("text") - 1),
        lambda i: F.ascii(F.col("text").substr(i, F.lit(1))) * WIDTH + F.ascii(F.col("text").substr(i + 1, F.lit(1))),
    )
    return (
        samples.filter(F.col("text").rlike(r"^[\x01-\x7F]{2,}$"))
        .select("label", F.explode(pairs).alias("pair"))
        .groupBy("label", "pair")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def train(samples: DataFrame, smooth: float = SMOOTH) -> list[float] | None:
    """Log-likelihood ratios by pair from (label, text): label 1 random, 0 ordinary.

    Counts are of at most two times 128 x 128 pairs. Without samples of both labels
    there is no model: None.
    """
    counts: dict[int, dict[int, int]] = {0: {}, 1: {}}
    for row in pair_counts(samples).collect():
        counts[row.label][row.pair] = row.n
    if not counts[0] or not counts[1]:
        return None
    alphabet = 64.0

    def log_model(own: dict[int, int]) -> list[float]:
        after = [0.0] * WIDTH
        for pair, n in own.items():
            after[pair // WIDTH] += n
        return [
            math.log((own.get(p, 0) + smooth) / (after[p // WIDTH] + smooth * alphabet)) for p in range(WIDTH * WIDTH)
        ]

    return [round(a - b, 4) for a, b in zip(log_model(counts[1]), log_model(counts[0]), strict=True)]


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of an ASCII token."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    codes = F.transform(F.array_remove(F.split(token, ""), ""), lambda c: F.ascii(c))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        codes,
        start,
        lambda acc, c: F.struct(
            c.alias("last"),
            (acc["sum"] + F.when(acc["last"] < 0, 0.0).otherwise(F.get(table, acc["last"] * WIDTH + c))).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )


def labelled(docs: DataFrame, matched: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Samples: what the fixed patterns found is random, words of some documents are ordinary.

    Documents are chosen by a hash of id and text, about ``sample_docs`` of them; words that
    hold a digit and a letter both are left to the models.
    """
    rows = matched.count()
    chosen = docs.filter(t.drawn(sample_docs / max(rows, 1), "doc_id", t.whole(F.col("text"))))
    ordinary = chosen.select(F.explode(t.found(t.whole(F.col("text")), IDENTIFIER)).alias("text")).filter(
        ~F.col("text").rlike("[0-9]")
    )
    secret = matched.select(
        F.explode(
            F.concat(
                F.transform("assign", lambda m: F.regexp_extract(m["match"], ASSIGN, 1)),
                F.transform("access", lambda m: m["match"]),
                F.transform("hex", lambda m: m["match"]),
            )
        ).alias("text")
    )
    return secret.select(F.lit(1).alias("label"), "text").unionByName(ordinary.select(F.lit(0).alias("label"), "text"))


def scan(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, margin: float = MARGIN, samples: DataFrame | None = None
) -> DataFrame:
    """doc_id, base (spans of the patterns), spans (base and modelled), one row per document.

    Needs doc_id and text; other columns are not read. Null and empty texts have no spans,
    ids may be null or repeat, an empty table gives an empty result. A token that meets a
    base span is not judged. ``samples`` (label, text) replaces the corpus's own labels;
    where one label has no sample, no token is judged a secret.
    """
    matched = staged(base_matches(docs), "secret-matches")
    base = t.in_order(
        t.as_spans(F.col("assign"), "assign", 0), t.as_spans(F.col("access"), "access", 1), t.as_spans(F.col("hex"), "hex", 2)
    )
    rows = matched.withColumn("base", base)
    model = train(samples if samples is not None else labelled(docs, matched, sample_docs))
    judged = F.array().cast(t.SPAN)
    if model is None:
        warnings.warn("secrets: a label has no samples, so no token is judged", stacklevel=2)
    if model:
        secret = F.filter(
            "tokens",
            lambda m: ~t.overlaps(F.col("base"), m["start"], m["end"]) & (ratio(m["match"], model) > margin),
        )
        judged = t.as_spans(secret, "random", 3)
    return rows.select("doc_id", "base", t.in_order(F.col("base"), judged).alias("spans"))


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with redacted texts; rows without a span stay as they are.

    Columns may have any name; nulls, repeated rows and empty tables are as in ``scan``.
    """
    found = scan(docs.select(F.struct("doc_id", F.xxhash64(t.whole(F.col("text"))).alias("key")).alias("doc_id"), "text"), **options)
    spans = (
        found.filter(F.size("spans") > 0)
        .select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.key").alias("_key"), F.col("spans").alias("_spans"))
        .dropDuplicates(["_id", "_key"])
    )
    # All given columns travel as one, so no name among them can clash.
    keyed = docs.select(F.struct("*").alias("given"), "doc_id", "text", F.xxhash64(t.whole(F.col("text"))).alias("key"))
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("_spans")))
    given = [text.alias("text") if c == "text" else F.col("given")[c].alias(c) for c in docs.columns]
    return keyed.join(spans, own, "left").select(*given)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span, or chain of overlapping spans, replaced by a mark."""
    return t.replaced(text, spans, lambda s: F.lit(mark))
