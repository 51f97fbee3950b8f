"""Language identification by prediction by partial matching.

For each language the bytes of labelled texts give a variable-order context tree: how
often each symbol followed each context of 0 to ``ORDER`` bytes. A symbol that a context
has seen costs -log2(count / (symbols + distinct)), an escape to the next shorter context
costs -log2(distinct / (symbols + distinct)), and what the empty context has not seen
costs 8 bits more. A text belongs to the language whose tree gives it the shortest code.

The trees are fitted on a bounded sample and frozen; scoring needs no shuffle. A context
and its symbol fit one integer, so equal keys mean equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybeat.llm.text import whole
from tallybeat.sources.tables import staged

#: Longest context in bytes; documents per language that the trees are fitted on, about.
ORDER, PER_LANG = 4, 400
#: Bytes handled at once, whatever the texts' lengths.
CHUNK = 1 << 18
#: Below this share of the evidence, or above so many bits a byte, a text has no language.
LEAST_SCORE, MOST_BITS = 0.4, 9.0
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte after the first ``ORDER``, it and its ``order`` predecessors as a number."""
    n = len(data) - ORDER
    out = np.zeros(n, np.uint64)
    for back in range(order, -1, -1):
        out = (out << np.uint64(8)) | data[ORDER - back : ORDER - back + n].astype(np.uint64)
    return out


def with_starts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each after ``ORDER`` zero bytes, and where each text begins, less ``ORDER``."""
    if not len(texts):
        return np.zeros(ORDER, np.uint8), np.zeros(0, np.int64)
    zeros, nothing = (pa.scalar(x, pa.large_binary()) for x in (bytes(ORDER), b""))
    led = pc.binary_join_element_wise(zeros, texts.cast(pa.large_binary()).fill_null(b""), nothing)
    bounds = np.frombuffer(led.buffers()[1], np.int64, len(led) + 1, 8 * led.offset)
    return np.frombuffer(led.buffers()[2], np.uint8)[bounds[0] : bounds[-1]], bounds[:-1] - bounds[0]


def sliced(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of about ``CHUNK`` bytes, or one text if it is longer."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // CHUNK, prepend=-1)).tolist()
    for low, high in zip(bounds, [*bounds[1:], len(texts)]):
        yield texts.slice(low, high - low)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> lang, order, gram, n, summed within a batch."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang in sorted(set(langs)):
            data, begins = with_starts(batch.column(1).filter(pa.array([x == lang for x in langs])))
            starts = np.zeros(len(data) - ORDER, bool)
            for pad in range(ORDER):
                after = begins[1:] - 1 - pad
                starts[after] = True
            for order in range(ORDER + 1):
                keys, n = np.unique(grams(data, order)[: len(starts)][~starts], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array([order] * len(keys), pa.int32()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "order", "gram", "n"],
                )


@dataclass(frozen=True)
class Tables:
    """Open-addressed look-up of grams of one order: keys, rows, costs by language."""

    keys: np.ndarray
    rows: np.ndarray
    costs: np.ndarray

    @staticmethod
    def slots(grams_: np.ndarray, size: int) -> np.ndarray:
        return ((grams_ * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray, costs: np.ndarray) -> Tables:
        size = 1 << max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        table, rows = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        waiting, at = np.arange(len(keys)), cls.slots(keys, size)
        while len(waiting):
            free = rows[at[waiting]] < 0
            _, first = np.unique(at[waiting[free]], return_index=True)
            placed = waiting[free][first]
            rows[at[placed]], table[at[placed]] = placed, keys[placed]
            waiting = np.setdiff1d(waiting, placed)
            at[waiting] = np.where(rows[at[waiting]] >= 0, (at[waiting] + 1) % size, at[waiting])
        return cls(table, rows, costs)

    def find(self, grams_: np.ndarray) -> np.ndarray:
        """Row of each gram, -1 if there is none."""
        at = self.slots(grams_, len(self.keys))
        out = self.rows[at]
        open_ = np.flatnonzero((out >= 0) & (self.keys[at] != grams_))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.keys)
            out[open_] = self.rows[at[open_]]
            open_ = open_[(out[open_] >= 0) & (self.keys[at[open_]] != grams_[open_])]
        return out


@dataclass(frozen=True)
class Model:
    """``symbols[k]``: bits of a byte after a known context of k bytes, when that context
    and byte occur in any language; ``escapes[k]``: bits to leave a context of k bytes."""

    langs: list[str]
    symbols: list[Tables]
    escapes: list[Tables]

    def bits(self, data: np.ndarray, order: int = ORDER, where: np.ndarray | None = None) -> np.ndarray:
        """Code length of each byte in every language, by the longest context that is known."""
        own = grams(data, order) if where is None else where & np.uint64((1 << (8 * order + 8)) - 1)
        found = self.symbols[order].find(own)
        out = self.symbols[order].costs[found]
        rest = np.flatnonzero(found < 0)
        if len(rest):
            context = self.escapes[order].find(own[rest] >> np.uint64(8))
            escape = np.where(context[:, None] >= 0, self.escapes[order].costs[context], np.float32(0))
            shorter = self.bits(data, order - 1, own[rest]) if order else np.full((len(rest), len(self.langs)), 8.0, np.float32)
            out[rest] = escape + shorter
        return out


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """Trees from (doc_id, text, lang) of documents that are not held out.

    About ``per_lang`` documents of each language are chosen by 63 bits of a hash of their id and
    text, however many there are, so the counts that reach the driver are bounded by the sample
    and the number of languages.
    Without a labelled text there is no model: None.
    """
    rows = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    sizes = staged(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langid-sizes")
    draw = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(2**63 - 1)) / F.lit(2.0**63)
    chosen = rows.join(sizes, "lang").filter(draw * F.col("n") < per_lang).filter(F.length("text") > 0)
    counted = (
        chosen.select(F.col("lang").cast("string"), F.col("text").cast("string"))
        .mapInArrow(count_grams, "lang string, order int, gram bigint, n bigint")
        .groupBy("lang", "order", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    if not counted.num_rows:
        return None
    named = counted["lang"].combine_chunks().dictionary_encode()
    given = named.dictionary.to_pylist()
    langs = sorted(given)
    lang = np.searchsorted(langs, given)[named.indices.to_numpy()]
    orders, all_grams, all_n = (counted[c].to_numpy() for c in ("order", "gram", "n"))
    symbols: list[Tables] = []
    escapes: list[Tables] = []
    known: dict[int, np.ndarray] = {}
    for order in range(ORDER + 1):
        part = np.flatnonzero(orders == order)
        keys, row = np.unique(all_grams[part].astype(np.uint64), return_inverse=True)
        seen = np.zeros((len(keys), len(langs)))
        seen[row, lang[part]] = all_n[part]
        contexts, context = np.unique(keys >> np.uint64(8), return_inverse=True)
        total, kinds = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
        np.add.at(total, context, seen)
        np.add.at(kinds, context, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            leave = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            cost = -np.log2(seen / (total + kinds)[context])
        if order:
            under = symbols[order - 1]
            rows_below = under.find(keys & np.uint64((1 << (8 * order)) - 1))
            below = known[order - 1][rows_below]
        else:
            below = np.full(seen.shape, 8.0)
        cost = np.where(seen > 0, cost, leave[context] + below)
        known[order] = cost
        symbols.append(Tables.of(keys, cost.astype(np.float32)))
        escapes.append(Tables.of(contexts, leave.astype(np.float32)))
    del counted, named, orders, all_grams, all_n
    pa.default_memory_pool().release_unused()
    return Model(langs, symbols, escapes)


def total_bits(model: Model, texts: pa.Array) -> np.ndarray:
    """Code length of each text in every language, for about ``CHUNK`` bytes at a time."""
    return np.vstack([np.zeros((0, len(model.langs))), *[slice_bits(model, part) for part in sliced(texts)]])


def slice_bits(model: Model, texts: pa.Array) -> np.ndarray:
    """``total_bits`` of a few texts; a long one passes in chunks."""
    data, begins = with_starts(texts)
    ends = np.append(begins[1:] - ORDER, len(data) - ORDER)
    out = np.zeros((len(texts), len(model.langs)))
    for low in range(0, max(len(data) - ORDER, 0), CHUNK):
        part = data[low : low + CHUNK + ORDER]
        bits = model.bits(part)
        running = np.vstack([np.zeros((1, len(model.langs))), np.cumsum(bits, axis=0, dtype=np.float64)])
        a = np.clip(begins - low, 0, len(bits))
        b = np.clip(ends - low, 0, len(bits))
        out += running[b] - running[a]
    return out


def identify(docs: DataFrame, model: Model | None, keep: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte: one row per row of ``docs``.

    Needs doc_id and text; other columns are not read, but carried along if ``keep``; they
    may have any name but the three that are added. A null or empty text, or one without a
    letter, is ``und`` with score 0; without a model every text is. The score is the share
    of the best language if each language's weight falls by half for every 1/16 bit per
    byte that its code is longer. Ties go to the first language in order; null ids are
    not held out; rows that repeat get equal results; an empty table gives an empty one.
    """
    kept = docs if keep else docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    body = whole(kept["text"])
    given = [f for f in kept.schema if keep or f.name != "text"]
    # What is behind the given columns goes by its place, under names not among them: whether there is
    # a letter, and the text unless it is among the given ones.
    own_name = "_" * (1 + max(map(len, kept.columns)))
    rows = kept.select(
        *[kept[f.name] for f in given],
        body.rlike(r"\p{L}").alias(f"{own_name}lettered"),
        *[body.alias(f"{own_name}body")] * (not keep),
    )
    text_at = [f.name for f in given].index("text") if keep else len(given) + 1
    added = ["lang_pred", "score", "bits_per_byte"]
    if model is None:
        return rows.select(
            *[f.name for f in given],
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("bits_per_byte"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.langs, UNKNOWN], object)
        for batch in batches:
            lettered = batch.column(len(given)).to_numpy(zero_copy_only=False)
            texts = batch.column(text_at).fill_null("")
            bits = total_bits(own, texts)
            rate = bits / np.maximum(pc.binary_length(texts).to_numpy(), 1)[:, None]
            best = rate.argmin(axis=1)
            least = rate.min(axis=1)
            share = 1 / np.exp2(-16 * (rate - least[:, None])).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(given)],
                    pa.array(names[np.where(lettered, best, -1)], pa.string()),
                    pa.array(np.where(lettered, share, 0.0)),
                    pa.array(least),
                ],
                [*[f.name for f in given], *added],
            )

    found = StructType(list(given)).add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return rows.mapInArrow(predict, found)
