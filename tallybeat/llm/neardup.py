"""Near duplicates by min-max hashing.

A document is the set of its word shingles. Each permutation of the hashes gives two
values, the least and the greatest, so the signature of 2 p values costs p evaluations;
each value of two documents agrees with their Jaccard similarity as its probability.
Documents that agree in all values of a band share a bucket.

Documents with equal sets form a class, found by a hash of the set, and one row stands for
the class from there on. Links are confirmed on the full sets. Buckets do not compare all
their members: members meet one hub each per round, and a round only looks at buckets that
still hold more than one component. What hubs leave open is settled by the members' rare
shingles, of which two similar sets must share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.llm.components import components, merged
from tallybeat.llm.text import whole
from tallybeat.llm.wordhash import MIX1, MIX2, mixed, slices, word_hashes
from tallybeat.sources.tables import staged

#: Rounds of hubs before the exact finish.
HUB_ROUNDS = 1


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle, similarity in hundredths, bands of ``rows`` values each.

    With 32 bands of 5 a pair at 0.8 is missed with a chance of 3 in a million.
    """

    words: int = 5
    similar: int = 80
    bands: int = 32
    rows: int = 5
    seed: int = 7


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words make one shingle of all."""
    h, sizes = word_hashes(texts, lower=True)
    sets = []
    for end, size in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
        own = h[end - size : end]
        if not size:
            sets.append(own)
            continue
        width = min(words, size)
        x = np.full(size - width + 1, np.uint64(width))
        for i in range(width):
            x = mixed(x * MIX1 + own[i : size - width + 1 + i])
        sets.append(np.unique(x))
    return sets


def signatures(sets: list[np.ndarray], s: Settings) -> np.ndarray:
    """One row of 2 p values for each of the sets, none of them empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])[:-1]])
    draw = np.random.default_rng(s.seed)
    p = -(-s.bands * s.rows // 2)
    factors = draw.integers(0, 1 << 63, p, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(sets), 2 * p), np.uint64)
    for i, factor in enumerate(factors):
        v = flat * factor
        out[:, 2 * i] = np.minimum.reduceat(v, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(v, starts)
    return out


def band_keys(values: np.ndarray, s: Settings) -> np.ndarray:
    """A 64-bit key for each band of each row; bands have keys of their own."""
    parts = values[:, : s.bands * s.rows].reshape(len(values), s.bands, s.rows)
    key = np.broadcast_to(np.arange(1, s.bands + 1, dtype=np.uint64) * MIX2, parts.shape[:2]).copy()
    for i in range(s.rows):
        key = mixed(key * MIX1 + parts[:, :, i])
    return key.view(np.int64)


def described(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, text_key, n_shingles, class_id, bands; the last two null without a word."""
    rows = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn("text_key", F.xxhash64("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                sets = shingle_sets(part.column(1), s.words)
                full = [x for x in sets if len(x)]
                keys = iter(band_keys(signatures(full, s), s)) if full else iter(())
                ids = [int.from_bytes(blake2b(x.tobytes(), digest_size=8).digest(), "big", signed=True) if len(x) else None for x in sets]
                bands = [next(keys) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(ids, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_key", "n_shingles", "class_id", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "text_key").mapInArrow(
        describe, f"doc_id {kind}, text_key bigint, n_shingles bigint, class_id bigint, bands array<bigint>"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """class_id, shingles of the classes in ``wanted`` (text_key, class_id)."""
    texts = docs.select(whole(F.col("text")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    rows = texts.join(wanted, "text_key").select("class_id", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                sets = [x.view(np.int64) for x in shingle_sets(part.column(1), words)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["class_id", "shingles"]
                )

    return rows.mapInArrow(build, "class_id bigint, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar."""
    near = pairs.join(sets.select(F.col("class_id").alias("u"), F.col("shingles").alias("a")), "u").join(
        sets.select(F.col("class_id").alias("v"), F.col("shingles").alias("b")), "v"
    )
    shared = F.size(F.array_intersect("a", "b"))
    either = F.size("a") + F.size("b") - F.col("shared")
    return near.withColumn("shared", shared).filter(100 * F.col("shared") >= similar * either).select("u", "v")


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def labelled(members: DataFrame, comp: DataFrame) -> DataFrame:
    """``members`` with the component of each class, in buckets that hold several."""
    rows = members.join(comp.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
    open_ = rows.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return rows.join(open_.filter(F.col("lo") < F.col("hi")).select("band"), "band", "left_semi")


def rare_pairs(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Pairs of different components that share one of their rarest shingles.

    A set of n must share one of its n - ceil(similar n / 100) + 1 first shingles, in any
    order common to all, with every set that similar; the order here is by how many open
    classes hold a shingle. A shingle that one component holds alone makes no pair. At the
    first shared shingle all that follows must still be enough: its places in both sets
    bound what they can share.
    """
    classes = members.groupBy("class_id").agg(F.first("component").alias("component"))
    held = classes.join(sets, "class_id").select(
        "class_id", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")
    )
    spread = held.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("classes"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    ranked = (
        held.join(spread, "shingle")
        .groupBy("class_id", "component", "n")
        .agg(F.sort_array(F.collect_list(F.struct("classes", "shingle", (F.col("lo") < F.col("hi")).alias("mixed")))).alias("s"))
    )
    first = F.slice("s", 1, (F.col("n") - F.ceil(F.col("n") * similar / 100) + 1).cast("int"))
    after = lambda x, i: F.struct(x["shingle"].alias("shingle"), (F.col("n") - i).alias("bound"), x["mixed"].alias("mixed"))
    prefix = ranked.select(
        "class_id", "component", "n", F.explode(F.filter(F.transform(first, after), lambda x: x["mixed"])).alias("x")
    ).select("class_id", "component", "n", F.col("x.shingle").alias("shingle"), F.col("x.bound").alias("bound"))
    other = prefix.select(
        "shingle", *[F.col(c).alias(f"other_{c}") for c in ("class_id", "component", "n", "bound")]
    )
    enough = F.least("bound", "other_bound") * (100 + similar) >= similar * (F.col("n") + F.col("other_n"))
    return (
        prefix.join(other, "shingle")
        .filter((F.col("component") < F.col("other_component")) & enough)
        .select(*ordered(F.col("class_id"), F.col("other_class_id")))
        .distinct()
    )


def classes_linked(docs: DataFrame, rows: DataFrame, s: Settings) -> DataFrame:
    """node, component: the classes that confirmed links connect, with the least class of each component.

    Each turn searches only the links it has found, between the components of the turn before.
    """
    buckets = rows.select("class_id", F.explode("bands").alias("band"))
    several = (
        buckets.groupBy("band")
        .agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"))
        .filter(F.col("lo") < F.col("hi"))
        .select("band", F.col("lo").alias("hub"))
    )
    members = staged(buckets.join(several, "band").distinct(), "neardup-members")
    wanted = members.select("class_id").distinct().join(
        rows.groupBy("class_id").agg(F.min("text_key").alias("text_key")), "class_id"
    )
    sets = staged(full_sets(docs, wanted, s.words).dropDuplicates(["class_id"]), "neardup-sets")
    pairs = members.filter(F.col("class_id") != F.col("hub")).select(*ordered(F.col("class_id"), F.col("hub"))).distinct()
    tested = staged(pairs, "neardup-pairs")
    comp = staged(components(confirmed(tested, sets, s.similar)), "neardup-components")
    members = members.select("band", "class_id")
    for turn in range(HUB_ROUNDS + 1):
        open_ = staged(labelled(members, comp), "neardup-open")
        if open_.isEmpty():
            break
        if turn < HUB_ROUNDS:
            drawn = F.struct(F.xxhash64("band", "class_id", F.lit(turn)).alias("draw"), "class_id", "component")
            hubs = open_.groupBy("band").agg(F.min(drawn).alias("hub"))
            pairs = (
                open_.join(hubs, "band")
                .filter(F.col("component") != F.col("hub.component"))
                .select(*ordered(F.col("class_id"), F.col("hub.class_id")))
                .distinct()
            )
        else:
            pairs = rare_pairs(open_, sets, s.similar)
        fresh = staged(pairs.join(tested, ["u", "v"], "left_anti"), "neardup-pairs")
        found = staged(confirmed(fresh, sets, s.similar), "neardup-links")
        tested = tested.unionByName(fresh)
        if not found.isEmpty():
            comp = staged(merged(comp, found), "neardup-components")
        members = open_.select("band", "class_id")
    return comp


def groups(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """doc_id, text_key, n_shingles, class_id, component_id, kept: one row per row of ``docs``.

    Needs doc_id and text; other columns are not read. A null, empty or wordless text has
    no shingles and is linked with nothing: its component is itself. Rows with equal sets
    are one class, rows that repeat share their fate. A null doc_id never names a component:
    a component of such rows alone has a null id, and null ids are not kept. An empty
    table gives an empty result. ``class_id`` is 64 bits of a hash of the set.
    """
    s = s or Settings()
    rows = staged(described(docs, s), "neardup-rows")
    comp = classes_linked(docs, rows, s).withColumnRenamed("node", "class_id")
    classes = (
        rows.filter(F.col("class_id").isNotNull())
        .groupBy("class_id")
        .agg(F.min("doc_id").alias("first_id"))
        .join(comp, "class_id", "left")
        .withColumn("component", F.coalesce("component", "class_id"))
    )
    least = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = classes.join(least, "component").select("class_id", "component", "component_id")
    return (
        rows.drop("bands")
        .join(named, "class_id", "left")
        .withColumn("component_id", F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def deduplicated(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``docs`` with one row of each component; rows without a word stay.

    The row with the smallest doc_id stays, null last, then by a hash of its text; of rows
    that agree in both, any one, as their texts are equal. Columns may have any name; an empty
    table stays empty.
    """
    found = groups(docs, s)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    stay = (
        found.filter(F.col("class_id").isNotNull())
        .groupBy("component")
        .agg(F.min(order).alias("row"))
        .select(F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key"))
    )
    # All given columns travel as one, so no name among them can clash.
    keyed = docs.select(
        F.struct("*").alias("given"),
        "doc_id",
        F.xxhash64(whole(F.col("text"))).alias("text_key"),
        whole(F.col("text")).rlike(r"[^\x20\x09-\x0D]").alias("worded"),
    )
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    one = keyed.filter("worded").join(stay, own, "left_semi").dropDuplicates(["doc_id", "text_key"])
    return one.unionByName(keyed.filter("not worded")).select("given.*")
