"""Byte-level BPE in Spark: ranked merges folded over the bytes of distinct words.

Words are the matches of the tokenizer's pattern, found by Spark. Tasks take them in Arrow batches:
the distinct words of a batch are folded, and numpy deals their ids out to where the words stand.
The pieces of a word start as its single bytes; each step of the fold joins the leftmost pair of
neighbours whose bytes have the lowest rank.

A task keeps the words that it folded, up to a number; which they are changes the time, never the
ids. Nothing is shuffled, and the driver holds the ranks alone.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tallybeat.llm.text import whole

#: White space as the tokenizer understands it (Unicode White_Space), in a Java class.
SPACE = r"\t-\r\x20\x85\xA0  -     　"
#: Most words that a task keeps folded, and words handled at once.
FOLDED, CHUNK = 150_000, 1 << 18


@dataclass(frozen=True)
class Ranks:
    """Bytes by rank, and the pattern that cuts texts into words."""

    pieces: dict[int, bytes]
    pattern: str


def load(path: str, pattern: str) -> Ranks:
    """Read a file of base64 bytes and rank; the file is a vocabulary, bounded by itself."""
    with open(path, "rb") as lines:
        pieces = {int(rank): base64.b64decode(word) for word, rank in map(bytes.split, lines)}
    return Ranks(pieces, pattern)


def java_pattern(pattern: str) -> str:
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def fold(word: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """Ids of one word.

    Each piece is known by where it begins. Pairs wait in a heap by rank, then place; one whose
    pieces have been joined otherwise is passed over. So n bytes take about n log n steps.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    ends, befores = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapify(pairs)
    while pairs:
        _, begin, end = heappop(pairs)
        middle = ends[begin]
        if not 0 < middle < n or ends[middle] != end:
            continue
        ends[begin], ends[middle] = end, 0
        if end < n:
            befores[end] = begin
        for low, high in ((befores[begin], end), (begin, ends[end] if end < n else 0)):
            if low >= 0 and high and (rank := ranks.get(word[low:high])) is not None:
                heappush(pairs, (rank, low, high))
    found, at = [], 0
    while at < n:
        found.append(ranks.get(word[at : ends[at]]))
        at = ends[at]
    return [i for i in found if i is not None]


def dealt(flat: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists that lie end to end, the picked ones end to end, and their sizes."""
    n = sizes[picks]
    ends = np.cumsum(n)
    before = (np.cumsum(sizes) - sizes)[picks] - (ends - n)
    return flat[np.repeat(before, n) + np.arange(ends[-1] if len(ends) else 0)], n


def parts(words: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Consecutive rows with about ``CHUNK`` words, or one row if it has more."""
    begins = words.offsets.to_numpy()[:-1].astype(np.int64)
    bounds = np.flatnonzero(np.diff((begins - begins[:1]) // CHUNK, prepend=-1)).tolist()
    yield from zip(bounds, [*bounds[1:], len(words)])


def lists(offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each row's values begin and end, given the same for its items and their sizes."""
    return np.append(0, np.cumsum(sizes))[offsets].astype(np.int32)


def encode(docs: DataFrame, ranks: Ranks, folded: int = FOLDED, with_bytes: bool = False) -> DataFrame:
    """doc_id, ids (array<int>): the ids of each whole text.

    Needs doc_id and text; other columns are not read. Null and empty texts have no ids;
    ids of documents may be null or repeat: each row is encoded alone; an empty table
    gives an empty result. ``with_bytes`` adds ids_bytes, the ids as unsigned 32-bit integers with
    the lowest byte first, and decoded, the bytes that the ids stand for.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks.pieces)

    def batches_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        by_bytes = {piece: rank for rank, piece in pieces.items()}
        every = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        piece_bytes = np.frombuffer(b"".join(every), np.uint8)
        piece_sizes = np.array([len(piece) for piece in every])
        known: dict[bytes, list[int]] = {}

        def ids_of(word: bytes) -> list[int]:
            ids = known.get(word)
            if ids is None:
                ids = fold(word, by_bytes)
                if len(known) < folded:
                    known[word] = ids
            return ids

        for batch in batches:
            for low, high in parts(batch.column(1)):
                part = batch.slice(low, high - low)
                words = part.column(1)
                distinct = words.flatten().dictionary_encode()
                own = [ids_of(word) for word in distinct.dictionary.cast(pa.binary()).to_pylist()]
                flat = np.array([i for ids in own for i in ids], np.int32)
                sizes = np.array([len(ids) for ids in own], np.int64)
                ids, n = dealt(flat, sizes, distinct.indices.to_numpy())
                offsets = words.offsets.to_numpy()
                places = lists(offsets - offsets[0], n)
                columns = [part.column(0), pa.ListArray.from_arrays(places, pa.array(ids))]
                if with_bytes:
                    decoded, n = dealt(piece_bytes, piece_sizes, ids)
                    little = ids.astype("<u4").view(np.uint8)
                    columns += [binaries(places * 4, little), binaries(lists(places, n), decoded)]
                yield pa.RecordBatch.from_arrays(columns, found.names)

    words = F.regexp_extract_all(whole(F.col("text")), F.lit(java_pattern(ranks.pattern)), F.lit(0))
    found = StructType([docs.schema["doc_id"]]).add("ids", ArrayType(IntegerType()))
    if with_bytes:
        found = found.add("ids_bytes", "binary").add("decoded", "binary")
    return docs.select("doc_id", words.alias("words")).mapInArrow(batches_of_ids, found)


def binaries(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def round_trip(docs: DataFrame, ranks: Ranks, with_ids: bool = False, **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, and the ids if asked for."""
    encoded = encode(docs, ranks, with_bytes=True, **options)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("ids_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *["ids"] * with_ids,
    )
