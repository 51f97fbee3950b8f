"""Words, matches and their positions as columns, without Python.

A null text counts as empty everywhere. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters between words, and a word.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Type of the matches that ``matches`` returns.
MATCH = "array<struct<start:int,end:int,match:string>>"
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def drawn(share: float, *keys: Column | str) -> Column:
    """Whether a row is in a sample of about ``share``, by 63 bits of a hash of the keys."""
    low = F.xxhash64(*keys).bitwiseAND(F.lit(2**63 - 1))
    return low <= F.lit(min(2**63 - 1, int(share * 2**63)))


def words(text: Column) -> Column:
    """The words of a text in order, unchanged."""
    return F.array_remove(F.split(F.translate(text, BLANKS[1:], " " * 5), " "), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def found(text: Column, pattern: str | Column) -> Column:
    """All matches, leftmost and non-overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))


#: Matches whose places are summed up at once: appending to a list copies it, so lists stay short.
_RUN = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _runs(items: Column) -> Column:
    begins = F.sequence(F.lit(1), F.size(items), F.lit(_RUN))
    return F.transform(begins, lambda i: F.slice(items, i, F.lit(_RUN)))


def placed(text: Column, pattern: str | Column, all_found: Column) -> Column:
    """``found`` with positions: what lies between the matches tells where they are.

    The text is split by the same pattern, but only where something was found. Positions are
    running sums over short runs of matches, so the work follows the matches.
    """
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        gaps, all_found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), m.alias("match"))
    )

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        here = F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.when(x["match"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))
        )

    def run(acc: Column, part: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), F.array().cast(MATCH).alias("out"))
        return let(
            F.aggregate(part, begin, step),
            lambda own: F.struct(own["at"].alias("at"), F.concat(acc["out"], F.array(own["out"])).alias("out")),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{MATCH}>").alias("out"))
    whole_text = let(pairs, lambda p: F.flatten(F.aggregate(_runs(p), start, run)["out"]))
    return F.when(F.size(all_found) == 0, F.array().cast(MATCH)).otherwise(whole_text)


def as_spans(matches: Column, kind: str, rank: int) -> Column:
    """Matches as spans of one kind; ``rank`` orders kinds that start together."""
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    ).cast(SPAN)


def in_order(*spans: Column) -> Column:
    return F.sort_array(F.concat(*spans))


def written(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (s["end"] > start))


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """The text with each span, or chain of overlapping spans, replaced by the mark of its first.

    Spans are in order. Each run of them is worked on in its own piece of the text, so the work
    follows the text and the spans, not their product.
    """

    def run(acc: Column, part: Column) -> Column:
        begin = acc["at"]
        until = F.greatest(begin, F.array_max(F.transform(part, lambda s: s["end"])))

        def step(own: Column, s: Column, piece: Column) -> Column:
            gap = F.substring(piece, own["at"] - begin + 1, s["start"] - own["at"])
            fresh = F.struct(s["end"].alias("at"), F.concat(own["out"], gap, mark(s)).alias("out"))
            more = F.struct(F.greatest(own["at"], s["end"]).alias("at"), own["out"].alias("out"))
            return F.when(s["start"] >= own["at"], fresh).otherwise(more)

        none = F.struct(begin.alias("at"), F.lit("").alias("out"))
        made = let(
            F.substring(text, begin + 1, until - begin),
            lambda piece: F.aggregate(part, none, lambda own, s: step(own, s, piece)),
        )
        return let(
            made, lambda m: F.struct(m["at"].alias("at"), F.concat(acc["out"], F.array(m["out"])).alias("out"))
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.substring(text, acc["at"] + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(
        let(spans, lambda all_: F.aggregate(_runs(all_), start, run, lambda acc: F.concat(F.array_join(acc["out"], ""), rest(acc))))
    )
