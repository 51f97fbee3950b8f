"""Line-first quality rules.

Every line is judged on its own: navigation, boilerplate, symbols, shouting and missing
punctuation fail it. A document goes if the lines that stay hold too few of its words.
Counts of the whole text (symbols, repeated lines, repeated passages) come first and have
limits of their own.

Everything is a column of the row, so nothing is shuffled and a long text costs n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.llm.text import WORD, whole, words

SYMBOLS = "#*$%&|<>"
#: Words in a window; fewest words; most repeated words and most lost words of 100.
WINDOW, FEWEST, REPEATED, LOST = 8, 20, 30, 50

#: A line fails that holds, or is, one of these.
NAVIGATION = r"(?:[|>\xBB•][^|>\xBB•]*){3}"
BOILERPLATE = (
    r"(?i)^\s*(?:licensed under|released under|this work is licensed|all rights reserved|copyright\b|\(c\)|\xA9"
    r"|terms of (?:use|service)|privacy policy|cookie|subscribe|sign (?:in|up)|log in|click here|read more|share this)"
)
#: So many symbols, or words ending in !!, of all words; a letter case of its own.
SYMBOL = r"[#*$%&|<>]"
SHOUTED = r"!!+(?=\s|$)"
#: The end of a sentence, with closing marks behind it; below so many words a line needs none.
ENDED = r"[.!?:;…。！？][\"')\]”’\xBB]*\s*$"
SHORT = 8


def line_stays(line: Column) -> Column:
    """Whether a line passes all rules; a line without a word passes."""
    n = F.regexp_count(line, F.lit(WORD))
    symbols = F.regexp_count(line, F.lit(SYMBOL))
    return ~(
        line.rlike(NAVIGATION)
        | line.rlike(BOILERPLATE)
        | (symbols * 3 > n)
        & (symbols > 2)
        | (F.regexp_count(line, F.lit(SHOUTED)) * 2 > n)
        | (n >= SHORT) & ~line.rlike(ENDED)
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text (never null), and the counts of ``rule_report``."""
    rows = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn("words", words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({"n_words": F.size("words").cast("long"), "lines": lines})
    at = F.when(F.col("n_words") > WINDOW, F.sequence(F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")))
    rows = rows.withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn(
        "windows", F.transform(at, lambda i: F.xxhash64(F.slice("word_hashes", i, WINDOW)))
    )
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn(
        "sorted_windows",
        F.when(again, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    same = lambda s, j: F.coalesce(F.get("sorted_windows", j)["h"] == s["h"], F.lit(False))
    rows = rows.withColumn(
        "twice",
        F.sort_array(
            F.transform(F.filter("sorted_windows", lambda s, i: same(s, i - 1) | same(s, i + 1)), lambda s: s["i"])
        ),
    )
    covered = F.aggregate(
        F.transform("twice", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("twice", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return rows.select(
        "doc_id",
        "text",
        "lines",
        "n_words",
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def rule_report(docs: DataFrame, lost: int = LOST) -> DataFrame:
    """doc_id, text of the lines that stay, the counts, words_left, base_failed, kept.

    Needs doc_id and text. A null or empty text has no words: base_failed, not kept. Ids
    may be null or repeat: each row is judged alone. Other columns are not read, an empty
    table gives an empty result. A document is kept if it has ``FEWEST`` words, not more
    than ``REPEATED`` of 100 in repeated windows, and its remaining lines hold at least
    100 - ``lost`` of 100 words.
    """
    rows = measured(docs).withColumn("good", F.filter("lines", line_stays))
    left = F.aggregate("good", F.lit(0).cast("long"), lambda a, x: a + F.regexp_count(x, F.lit(WORD)))
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return (
        rows.withColumns({"words_left": left, "base_failed": failed})
        .withColumn("kept", ~F.col("base_failed") & (100 * F.col("words_left") >= (100 - lost) * F.col("n_words")))
        .withColumn("clean_text", F.array_join("good", "\n"))
        .drop("text", "lines", "good")
    )
