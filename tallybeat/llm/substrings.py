"""Repeated passages by recompression.

The words of a document are replaced, round by round, by names of what they spell: short
runs of one symbol by a name of symbol and length, then pairs (a, b) by a name of both
where a falls in the left and b in the right half of the alphabet of that round. Names are
hashes, so all tasks give equal pairs equal names without asking each other.

What a round does inside a passage depends on the passage alone, but for symbols at its
edges that a neighbour outside might take. Dropping exactly those, every window of words
keeps a range of symbols that any equal window keeps too, wherever it stands. The least of
the names of neighbouring symbols in that range is the window's anchor: equal windows have
equal anchors at equal places. A few successive windows share one anchor and make a
segment, about one for six or seven words; segments, not windows, are shuffled, and those of an
anchor that stands alone are gone after a count of names. Segments that agree wholly
repeat; where they agree in part, their windows are compared.

Segments with a common anchor are joined to the first of their kind, never to each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.llm.text import whole
from tallybeat.llm.wordhash import MIX1, MIX2, Ranges, mixed, slices, word_hashes
from tallybeat.sources.tables import staged

#: Words in a window; rounds; most words in a symbol; symbols that name an anchor.
WINDOW, ROUNDS, SPAN, NAMED = 20, 2, 6, 3
LAST = 2**63 - 1
#: More windows than a segment can have, a power of two; their number is packed below the
#: start of a segment.
PACKED = 8
MOST_WINDOWS = 1 << PACKED
#: Most repeated ids that are listed; if there are more, every row has a text key.
LISTED = 10_000


def renamed_runs(names, spans, docs, l, r):
    """Short runs of one symbol become one; the first and last run of a window are left out.

    What can be seen of the run at an edge decides: where that is too long to be joined, no
    continuation outside changes anything.
    """
    n = len(names)
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (docs[1:] != docs[:-1])
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    end = np.append(first[1:], n)
    size = end - first
    joins = (size > 1) & (size * spans[first] <= SPAN)
    l2, r2 = l + (spans[l] <= SPAN), r - (spans[r - 1] <= SPAN)
    long_ = size[run] > 1
    of = np.flatnonzero(long_[l] | long_[r - 1])
    if len(of):
        lo, hi = l[of], r[of]
        ahead = np.minimum(end[run[lo]], hi) - lo
        behind = hi - np.maximum(first[run[hi - 1]], lo)
        l2[of] = np.where(ahead * spans[lo] <= SPAN, lo + ahead, lo)
        r2[of] = np.where(behind * spans[hi - 1] <= SPAN, hi - behind, hi)
    if not joins.any():
        return names, spans, docs, np.arange(n), l2, r2
    keep = new | ~joins[run]
    inside = joins[run]
    name = np.where(inside, mixed(mixed(names * MIX2) + size[run].astype(np.uint64)), names)[keep]
    span = np.where(inside, size[run] * spans, spans)[keep]
    return name, span, docs[keep], np.cumsum(keep) - 1, l2, r2


def renamed_pairs(names, spans, docs, l, r, turn):
    """Pairs of a left and a right symbol become one; edge symbols that might pair are left out."""
    right = (mixed(names * MIX1 + np.uint64(2 * turn + 1)) >> np.uint64(63)).astype(bool)
    joins = np.zeros(len(names), bool)
    joins[:-1] = ~right[:-1] & right[1:] & (docs[1:] == docs[:-1]) & (spans[1:] + spans[:-1] <= SPAN)
    open_ = spans + 1 <= SPAN
    l2 = l + (right[l] & open_[l])
    r2 = r - (~right[r - 1] & open_[r - 1])
    second = np.zeros(len(names), bool)
    second[1:] = joins[:-1]
    keep = ~second
    at = np.cumsum(keep) - 1
    partner = np.append(names[1:], np.uint64(0))
    wide = np.append(spans[1:], 0)
    name = np.where(joins, mixed(mixed(names * MIX1 + np.uint64(turn + 1)) * MIX2 + partner), names)[keep]
    span = np.where(joins, spans + wide, spans)[keep]
    return name, span, docs[keep], at, l2, r2


def least_of(value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the first least value in each [lo, hi): two overlapping powers of two."""
    size = hi - lo
    out = lo.copy()
    best = np.arange(len(value))
    width = 1
    while True:
        of = np.flatnonzero((size >= width) & (size < 2 * width))
        if len(of):
            one, two = best[lo[of]], best[hi[of] - width]
            out[of] = np.where(value[one] <= value[two], one, two)
        if not (size >= 2 * width).any():
            return out
        one, two = best[: len(best) - width], best[width:]
        best = np.where(value[one] <= value[two], one, two)
        width *= 2


def anchors(h: np.ndarray, docs: np.ndarray, starts: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """For each window: the name of its anchor and the word at which the anchor begins."""
    names, spans = mixed(h * MIX2 + np.uint64(1)), np.ones(len(h), np.int64)
    begin = np.arange(len(h))
    l, r = starts.copy(), starts + width
    live = np.arange(len(starts))
    best_name, best_at = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)

    def choose(which: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """The least name of ``NAMED`` symbols in a row within [lo, hi), or of all if fewer."""
        chain = names
        for k in range(1, NAMED + 1):
            of = np.flatnonzero(hi - lo >= k if k == NAMED else hi - lo == k)
            if len(of):
                at = least_of(chain, lo[of], hi[of] - k + 1)
                best_name[which[of]], best_at[which[of]] = chain[at], begin[at]
            if k < NAMED:
                chain = mixed(chain[:-1] * MIX1 + names[k:]) if len(chain) > 1 else chain

    for turn in range(-1, ROUNDS):
        step = renamed_runs(names, spans, docs, l, r) if turn < 0 else renamed_pairs(names, spans, docs, l, r, turn)
        name, span, doc, at, l2, r2 = step
        gone = l2 >= r2
        if gone.any():
            choose(live[gone], l[gone], r[gone])
        stay = ~gone
        live, l, r = live[stay], at[l2[stay]], at[r2[stay] - 1] + 1
        kept = np.append(True, at[1:] != at[:-1])
        names, spans, docs, begin = name, span, doc, begin[kept]
        if not len(live):
            break
    if len(live):
        choose(live, l, r)
    return best_name, best_at


def segments(texts: pa.Array, width: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Segments in order: text number, start, anchor name, hash of its words, windows."""
    h, sizes = word_hashes(texts)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    starts = np.arange(max(len(h) - width + 1, 0))
    starts = starts[docs[starts] == docs[starts + width - 1]]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    name, at = anchors(h, docs, starts, width)
    head = np.ones(len(starts), bool)
    head[1:] = (at[1:] != at[:-1]) | (name[1:] != name[:-1]) | (docs[starts[1:]] != docs[starts[:-1]])
    of = np.flatnonzero(head)
    n = np.diff(np.append(of, len(head)))
    begin, name = starts[of], name[of]
    doc = docs[begin]
    segment = Ranges(h).hashed(begin, begin + n + width - 1)
    return doc, begin - first[doc], name.view(np.int64), segment.view(np.int64), n


def repeated_ids(docs: DataFrame) -> DataFrame | None:
    """uid of the ids that several rows have; None if they are more than ``LISTED``."""
    ids = docs.select(F.col("doc_id").cast("long").alias("uid")).filter("uid is not null")
    several = staged(ids.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("uid"), "substring-ids")
    return several if several.count() <= LISTED else None


def keyed(docs: DataFrame, several: DataFrame | None) -> DataFrame:
    """uid, text_key, text: rows of one id and different texts stay apart; null ids come last.

    The key is a whole 64-bit hash, so that even the rows of a very common id keep apart.
    An id of one row needs none: its key is 0, which takes no room where segments travel.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("uid"), whole(F.col("text")).alias("text"))
    key = F.xxhash64("text")
    if several is not None:
        rows = rows.join(F.broadcast(several.withColumnRenamed("uid", "several")), F.col("uid") == F.col("several"), "left")
        key = F.when((F.col("uid") == LAST) | F.col("several").isNotNull(), key).otherwise(0)
    return rows.select("uid", key.alias("text_key"), "text")


def described(rows: DataFrame, width: int) -> DataFrame:
    """name, segment, uid, mark, text_key: a row per segment; a mark packs start and windows."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for low, high in slices(batch.column(2)):
                doc, start, name, segment, n = segments(batch.column(2)[low:high], width)
                mark = start * MOST_WINDOWS + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (name, segment, uid[low + doc], mark, key[low + doc])],
                    ["name", "segment", "uid", "mark", "text_key"],
                )

    return rows.mapInArrow(describe, "name bigint, segment bigint, uid bigint, mark bigint, text_key bigint")


def windows_of(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """name, window (64-bit hash), place: every window of the wanted segments."""
    lists = wanted.groupBy("uid", "text_key").agg(F.collect_set(F.struct("name", "mark")).alias("parts"))
    rows = rows.join(lists, ["uid", "text_key"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for low, high in slices(batch.column(2)):
                h, sizes = word_hashes(batch.column(2)[low:high])
                first = np.cumsum(sizes) - sizes
                parts = batch.column(3)[low:high]
                of = np.repeat(np.arange(high - low), np.asarray(parts.value_lengths()))
                flat = parts.flatten()
                name, mark = flat.field("name").to_numpy(), flat.field("mark").to_numpy()
                n, start = mark % MOST_WINDOWS, mark // MOST_WINDOWS
                start = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                of = np.repeat(of, n)
                begin = first[of] + start
                mark = start * MOST_WINDOWS + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(name, n)),
                        pa.array(Ranges(h).hashed(begin, begin + width).view(np.int64)),
                        pa.array(ids[low + of]),
                        pa.array(mark),
                        pa.array(keys[low + of]),
                    ],
                    ["name", "window", "uid", "mark", "text_key"],
                )

    return rows.select("uid", "text_key", "text", "parts").mapInArrow(
        explode, "name bigint, window bigint, uid bigint, mark bigint, text_key bigint"
    )


def after(first: Column) -> Column:
    """Whether a row is later than the first place; equal ids and starts are not."""
    later = F.expr(f"shiftright(mark, {PACKED})") > F.shiftright(first["mark"], PACKED)
    return (F.col("uid") > first["uid"]) | (F.col("uid") == first["uid"]) & later


def repeated(texts: DataFrame, width: int = WINDOW) -> DataFrame:
    """uid, text_key, start, size: runs of words that windows seen earlier cover, of ``keyed`` rows."""
    rows = described(texts, width)
    place = F.struct("uid", "mark", "text_key")
    several = staged(
        rows.groupBy("name").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("name"), "substring-names"
    )
    shared = staged(rows.join(several, "name", "left_semi"), "substring-segments")
    kinds = staged(shared.groupBy("name", "segment").agg(F.min(place).alias("first")), "substring-kinds")
    whole_ = shared.join(kinds, ["name", "segment"]).filter(after(F.col("first")))
    partly = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("name")
    wanted = kinds.join(partly, "name", "left_semi").select(
        "name", "first.uid", "first.mark", "first.text_key"
    )
    windows = staged(windows_of(texts, wanted, width), "substring-windows")
    earliest = (
        windows.groupBy("name", "window")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") < F.col("last"))
        .select("name", "window", "first")
    )
    single = windows.join(earliest, ["name", "window"]).filter(after(F.col("first")))
    return (
        whole_.select("uid", "text_key", "mark")
        .unionByName(single.select("uid", "text_key", "mark"))
        .select(
            "uid",
            "text_key",
            F.expr(f"shiftright(mark, {PACKED})").cast("int").alias("start"),
            F.expr(f"mark % {MOST_WINDOWS} + {width - 1}").cast("int").alias("size"),
        )
    )


def covered(n: int, ranges: list) -> np.ndarray:
    """Which of n words the ranges cover."""
    edges = np.zeros(n + 1, np.int32)
    for x in ranges:
        edges[x["start"]] += 1
        edges[min(n, x["start"] + x["size"])] -= 1
    return np.cumsum(edges[:n]) > 0


def removed(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, kept_sha256: one row per row of ``docs``.

    Needs doc_id (an integer) and text; other columns are not read. Null and empty texts
    have no words. Texts of fewer than ``width`` words keep all. Null ids come after all
    others; rows that share an id do not make each other's windows earlier unless they
    start at different words. An empty table gives an empty result. Kept words are joined
    by one space.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = keyed(docs, repeated_ids(docs))
    found = (
        repeated(texts, width)
        .groupBy("uid", "text_key")
        .agg(F.collect_set(F.struct("start", "size")).alias("ranges"))
        .withColumnsRenamed({"uid": "found_uid", "text_key": "found_key"})
    )
    rows = (
        texts
        .join(found, (F.col("uid") == F.col("found_uid")) & (F.col("text_key") == F.col("found_key")), "left")
        .select(F.nullif("uid", F.lit(LAST)).cast(kind).alias("doc_id"), "text", "ranges")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                n, gone, texts, digests = [], [], [], []
                for text, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = text.encode().split()
                    left = words
                    if ranges:
                        out = covered(len(words), ranges)
                        left = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                    joined = b" ".join(left)
                    n.append(len(words))
                    gone.append(len(words) - len(left))
                    texts.append(joined.decode())
                    digests.append(hashlib.sha256(joined).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
                )

    return rows.mapInArrow(
        cut, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string"
    )
