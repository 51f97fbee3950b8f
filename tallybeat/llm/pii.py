"""Personal data: fixed patterns, and terms that give a protected value away.

A protected value is one that the patterns find (an address, a number). A term that
shares documents with a value discloses it if seeing the term tells the value: their pointwise
mutual information, from documents that hold the term and documents that hold both, comes
near the information of the value itself. Such terms are marked wherever they stand.

Counts cover all rows and whole documents, without the values themselves. Words and pairs
are counted once per row with a partial sum before the shuffle, so frequent words travel as
one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.llm import text as t
from tallybeat.sources.tables import staged

#: The kinds in order with their patterns. The look-behinds only skip starts
#: at which no match can begin that began not earlier, so a long run costs no square.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

#: A term: letters only, in lower case.
TERM = r"\p{L}{4,}"
#: Share of a value's information that a term must give; distinct texts it must do so in.
DISCLOSED, LINES = 0.9, 3


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    figures = F.transform(F.reverse(F.array_remove(F.split(number, ""), "")), lambda d: d.cast("int"))
    doubled = F.transform(
        figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m["match"], r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False))),
    "card": lambda m: F.length(digits(m["match"])).between(12, 19) & luhn(digits(m["match"])),
    "phone": lambda m: F.length(digits(m["match"])).between(9, 15),
}


def base_matches(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, the valid matches by kind, their distinct values, and the terms outside them.

    ``row_key`` is a hash of the text, so that rows with one doc_id stay apart.
    """
    rows = docs.select("doc_id", t.whole(F.col("text")).alias("text")).withColumn("row_key", F.xxhash64("text"))
    rows = rows.withColumns({f"{k}_found": t.found(F.col("text"), p) for k, p in PATTERNS.items()})
    rows = rows.withColumns({f"{k}_at": t.placed(F.col("text"), p, F.col(f"{k}_found")) for k, p in PATTERNS.items()})
    rows = rows.withColumns({k: F.filter(f"{k}_at", VALID[k]) for k in PATTERNS})
    rows = rows.withColumn("values", F.array_distinct(F.transform(F.concat(*PATTERNS), lambda m: F.lower(m["match"]))))
    base = t.in_order(*[t.as_spans(F.col(k), k, i) for i, k in enumerate(PATTERNS)])
    rows = rows.withColumn("outside", sanitised(F.col("text"), base, lambda s: F.lit(" ")))
    return rows.select("doc_id", "row_key", *PATTERNS, "values", terms(F.col("outside")).alias("terms"))


def terms(text: Column) -> Column:
    return F.array_distinct(t.found(F.lower(text), TERM))


def disclosing(matched: DataFrame, disclosed: float = DISCLOSED, lines: int = LINES) -> DataFrame:
    """term, value, pmi, information: terms whose PMI with a value reaches the share of its information.

    All four counts are of rows, whatever their ids; equal texts are met once and weighed
    by their rows. A pair needs ``lines`` distinct texts, so that copies of one document
    prove nothing; values in fewer texts are out before any pair is made. With n_value
    rows, a pair has at most n_value rows, so a term in more than
    n_value * (n / n_value) ** (1 - disclosed) rows cannot reach the share.
    """
    n = matched.count()
    bearing = staged(
        matched.filter(F.size("values") > 0)
        .groupBy("row_key")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("values").alias("values"), F.first("terms").alias("terms")),
        "pii-bearing",
    )
    each = bearing.select("row_key", "copies", F.explode("values").alias("value"))
    held = staged(
        each.groupBy("value")
        .agg(F.sum("copies").alias("n_value"), F.count(F.lit(1)).alias("texts"))
        .filter((F.col("texts") >= lines) & (F.col("n_value") < n))
        .select("value", "n_value"),
        "pii-values",
    )
    most = held.agg(F.max(F.col("n_value") * F.pow(F.lit(float(n)) / F.col("n_value"), F.lit(1 - disclosed)))).first()[0]
    if most is None:
        return held.select(F.col("value").alias("term"), "value", F.lit(0.0).alias("pmi"), F.lit(0.0).alias("information")).limit(0)
    wanted = each.join(held, "value").groupBy("row_key").agg(F.collect_list("value").alias("held"))
    both = (
        bearing.join(wanted, "row_key")
        .select("copies", "held", F.explode("terms").alias("term"))
        .select("copies", "term", F.explode("held").alias("value"))
        .groupBy("term", "value")
        .agg(F.sum("copies").alias("together"), F.count(F.lit(1)).alias("texts"))
        .filter(F.col("texts") >= lines)
    )
    spread = (
        matched.select(F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_term"))
        .filter(F.col("n_term").between(lines, int(most) + 1))
    )
    return (
        both.join(spread, "term")
        .join(held, "value")
        .withColumns(
            {
                "pmi": F.log2(F.col("together") * F.lit(float(n)) / (F.col("n_term") * F.col("n_value"))),
                "information": F.log2(F.lit(float(n)) / F.col("n_value")),
            }
        )
        .filter(F.col("pmi") >= F.col("information") * disclosed)
        .select("term", "value", "pmi", "information")
    )


def scan(docs: DataFrame, disclosed: float = DISCLOSED, lines: int = LINES) -> DataFrame:
    """doc_id, email, ip, card, phone (counts), base and spans, one row per document.

    Needs doc_id and text; other columns are not read. Null and empty texts have no spans;
    ids may be null or repeat, rows with equal id and text get equal results; an empty
    table gives an empty result. ``spans`` adds, as kind ``term``, every whole word that
    discloses a value and meets no base span.
    """
    matched = staged(base_matches(docs), "pii-matches")
    base = t.in_order(*[t.as_spans(F.col(k), k, i) for i, k in enumerate(PATTERNS)])
    rows = matched.select("doc_id", "row_key", *[F.size(k).cast("long").alias(k) for k in PATTERNS], base.alias("base"))
    told = staged(disclosing(matched, disclosed, lines).select("term").distinct(), "pii-terms")
    if told.isEmpty():
        return rows.drop("row_key").withColumn("spans", F.col("base"))
    texts = docs.select("doc_id", t.whole(F.col("text")).alias("text")).withColumn("row_key", F.xxhash64("text"))
    held = (
        texts.select("doc_id", "row_key", F.explode(terms(F.col("text"))).alias("term"))
        .join(told, "term")
        .groupBy("doc_id", "row_key")
        .agg(F.sort_array(F.collect_set("term")).alias("held"))
        .withColumnsRenamed({"doc_id": "held_id", "row_key": "held_key"})
    )
    own = F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("row_key") == F.col("held_key"))
    # The terms that a text holds are looked for in it as whole words, in any case.
    wanted = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("held", "|"), F.lit(r")(?!\p{L})"))
    places = (
        texts.join(held, own)
        .withColumn("wanted", wanted)
        .withColumn("hits", t.found(F.col("text"), F.col("wanted")))
        .withColumn("places", t.placed(F.col("text"), F.col("wanted"), F.col("hits")))
        .select(
            "held_id",
            "held_key",
            F.filter("places", lambda m: F.array_contains("held", F.lower(m["match"]))).alias("places"),
        )
        .dropDuplicates(["held_id", "held_key"])
    )
    free = F.filter(
        F.coalesce("places", F.array().cast(t.MATCH)), lambda m: ~t.overlaps(F.col("base"), m["start"], m["end"])
    )
    return rows.join(places, own, "left").select(
        "doc_id", *PATTERNS, "base", t.in_order(F.col("base"), t.as_spans(free, "term", len(PATTERNS))).alias("spans")
    )


def marked(span: Column) -> Column:
    return F.concat(F.lit("["), span["kind"], F.lit("]"))


def sanitised(text: Column, spans: Column, mark: Callable[[Column], Column] = marked) -> Column:
    """The text with values replaced by their kind and terms generalised to ``[term]``, or by other marks."""
    return t.replaced(text, spans, mark)
