"""Mixing sources to target weights by highest quotients.

The words of each source are cut into blocks of equal size. Sainte-Lague apportionment
gives every source its number of blocks, then deals the blocks of a source to groups of
shards and the blocks of a group to its shards. In a shard the documents stand in seeded
order; their words, over and over, form the line of blocks of which the quota is taken.

Work per document is one scan for its size and one shuffle by (source, shard); a source
with a third of all rows is spread over as many shards as the corpus has. What one task
orders is a shard, 1,024 shards, the groups of a source, or the sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybeat.llm.text import whole, word_count
from tallybeat.sources.tables import staged

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: No target is above so many times the source's size.
MOST = 3
#: Words in a block; words of the whole corpus for which there is one shard; shards in a group.
BLOCK, SHARD, GROUP = 32, 250_000, 1024
SEED = "mix"


def seeded(*parts: Column) -> Column:
    """The first 60 bits of an md5 of the parts, null spelled as its own value."""
    text = F.concat_ws("/", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Never null; sorts by code point with null last."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit("-"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> and target: shares by weight, none above ``most`` sizes.

    The level (words per weight) rises until the targets add up: each round pins the
    sources whose share is above their bound and deals what is left to the others by
    weight. A round is one sum; the rounds end when no source is newly pinned.
    """
    order = Window.orderBy("source")
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = staged(
        sources.withColumn("weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1)), "mix-sources"
    )
    bound = F.col("source_size") * most
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, pinned = 0.0, -1
    while True:
        over = (F.col("weight") * F.lit(level) > bound) if pinned >= 0 else F.lit(False)
        row = weighed.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.sum(F.when(over, bound).otherwise(0)).alias("held"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if row.n == pinned or not row.free:
            break
        level, pinned = (total - row.held) / row.free, row.n
    return weighed.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), bound.cast("double")))


def apportion(parties: DataFrame, keys: list[str], within: list[str], seats: Column) -> DataFrame:
    """Add ``quota``: the ``seats`` of each ``within`` group go to the highest votes / (2k + 1).

    A party with votes v wins about v / d seats for a divisor d near the votes of one
    seat. Seats that any divisor within the possible error gives are sure; only the few
    after them compete, so the work follows the parties, not the seats. Equal quotients
    go to the smaller key. No votes, no seats.
    """
    every = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    slack = F.count(F.lit(1)).over(every) / 2 + 1
    share = F.col("votes") / F.col("all_votes")
    low = F.round(share * F.greatest(F.col("seats") - F.col("slack"), F.lit(0.0))).cast("long")
    high = F.round(share * (F.col("seats") + F.col("slack"))).cast("long") + 1
    open_ = (
        parties.withColumns({"all_votes": F.sum("votes").over(every), "slack": slack, "seats": seats})
        .filter((F.col("votes") > 0) & (F.col("seats") > 0))
        .withColumns({"sure": F.greatest(low - 1, F.lit(0)), "high": high})
    )
    ranked = (
        open_.withColumn("left", F.col("seats") - F.sum("sure").over(every))
        .withColumn("k", F.explode(F.expr("sequence(sure, high)")))
        .withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))
        .withColumn("place", F.row_number().over(every.orderBy(F.desc("quotient"), *keys, "k")))
    )
    won = ranked.groupBy(*keys).agg(
        (F.first("sure") + F.count(F.when(F.col("place") <= F.col("left"), 1))).alias("quota")
    )
    return parties.join(won, keys, "left").withColumn("quota", F.coalesce("quota", F.lit(0)))


def levelled(quotas: DataFrame, block: int, most: int) -> DataFrame:
    """Add ``wanted``, the words each line gives: its blocks, as far as it has room, and what evens out.

    A line gives at most ``most`` times its words. What its source wants beyond the blocks
    that fit, or less than them, goes to or from all lines of the source by one share of
    their room, or of what they give. Parts of a word are rounded by a seeded draw, so a source
    misses its target by about the square root of its number of lines, in words.
    """
    given = F.least(F.col("quota") * block, F.col("line") * most)
    lines = quotas.withColumn("given", given).withColumn("room", F.col("line") * most - F.col("given"))
    missing = (F.first("target") - F.sum("given")).alias("missing")
    sources = lines.groupBy("source").agg(missing, F.sum("given").alias("gives"), F.sum("room").alias("rooms"))
    sources = sources.select(
        "source",
        F.when((F.col("missing") > 0) & (F.col("rooms") > 0), F.least(F.col("missing") / F.col("rooms"), F.lit(1.0)))
        .otherwise(0.0)
        .alias("more"),
        F.when((F.col("missing") < 0) & (F.col("gives") > 0), F.least(-F.col("missing") / F.col("gives"), F.lit(1.0)))
        .otherwise(0.0)
        .alias("less"),
    )
    draw = seeded(F.lit("line"), F.col("source"), F.col("shard")) / F.lit(float(2**60))
    rounded = lambda part, share: F.least(F.floor(part * share + draw), part)
    wanted = F.col("given") + rounded(F.col("room"), F.col("more")) - rounded(F.col("given"), F.col("less"))
    return lines.join(sources, "source").withColumn("wanted", wanted).drop("given", "room", "more", "less")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    shard_words: int = SHARD,
    group: int = GROUP,
) -> DataFrame:
    """doc_id, text_key, size, source, source_size, target, taken, quota: one row per row of ``docs``.

    Needs doc_id, text and source; other columns are not read. Null and empty texts have
    size 0 and nothing is taken of them; null sources are one source, the last; shard and
    order are drawn from id and text, so rows that share an id, or have none, are spread;
    rows that repeat are shared out one by one. An
    empty table gives an empty result. ``taken`` counts repeats and is at most ``most``
    sizes; the taken words of a source differ from its target by about the square root of its
    shards, in words, however short its documents (``levelled``).
    """
    sized = staged(
        docs.select(
            F.col("doc_id"),
            F.xxhash64(whole(F.col("text"))).alias("text_key"),
            source_key(F.col("source")).alias("source"),
            word_count(whole(F.col("text"))).alias("size"),
        ),
        "mix-sizes",
    )
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    sharded = sized.withColumn("shard", seeded(F.lit("shard"), F.col("doc_id"), F.col("text_key")) % F.lit(shards))

    by_source = apportion(
        sources.withColumn("votes", F.col("target")), ["source"], [], F.lit(round(total / block)).cast("long")
    ).select("source", "source_size", "target", F.col("quota").alias("source_quota"))
    per_shard = staged(
        sharded.groupBy("source", "shard").agg(F.sum("size").alias("votes")), "mix-shards"
    ).withColumn("part", F.floor(F.col("shard") / group))
    parts = apportion(
        per_shard.groupBy("source", "part").agg(F.sum("votes").alias("votes")).join(by_source, "source"),
        ["source", "part"],
        ["source"],
        F.col("source_quota"),
    ).select("source", "part", "source_size", "target", F.col("quota").alias("part_quota"))
    quotas = staged(
        apportion(
            per_shard.join(parts, ["source", "part"]), ["source", "part", "shard"], ["source", "part"], F.col("part_quota")
        ).select("source", "shard", "source_size", "target", "quota", F.col("votes").alias("line")),
        "mix-quotas",
    )

    quotas = levelled(quotas, block, most)

    line = Window.partitionBy("source", "shard").orderBy(
        seeded(F.lit("doc"), F.col("doc_id"), F.col("text_key")), "doc_id", "text_key"
    )
    wanted = F.col("wanted")
    rounds = F.when(F.col("line") > 0, F.floor(wanted / F.col("line"))).otherwise(0)
    rest = wanted - rounds * F.col("line")
    before = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1))
    return (
        sharded.join(quotas, ["source", "shard"])
        .withColumns({"before": F.coalesce(before, F.lit(0)), "rounds": rounds, "rest": rest})
        .withColumn(
            "taken",
            F.col("rounds") * F.col("size")
            + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))),
        )
        .select("doc_id", "text_key", "size", "source", "shard", "source_size", "target", "quota", F.col("taken").cast("long").alias("taken"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each document as often as the mix takes it.

    Copies are the taken words by the document's size, rounded to the nearest whole
    number (half up), so the document that a shard's line cuts is whole or out. All
    columns stay as they are, whatever their names; nulls, repeated rows and empty tables are
    as in ``mix``, and a document without a word is never taken.
    """
    copies = (
        mix(docs, **options)
        .select("doc_id", F.col("text_key").alias("_key"), F.col("size").alias("_size"), F.col("source").alias("_source"), "taken")
        .groupBy("doc_id", "_key", "_size", "_source")
        .agg(F.sum("taken").alias("_taken"), F.count(F.lit(1)).alias("_rows"))
        .withColumnsRenamed({"doc_id": "_id"})
    )
    # All given columns travel as one, so no name among them can clash.
    keyed = docs.select(
        F.struct("*").alias("given"),
        "doc_id",
        F.xxhash64(whole(F.col("text"))).alias("key"),
        source_key(F.col("source")).alias("party"),
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")) & (F.col("party") == F.col("_source"))
    )
    times = F.floor(F.col("_taken") / (F.col("_rows") * F.col("_size")) + 0.5).cast("int")
    return (
        keyed.join(copies.filter(F.col("_taken") > 0), same)
        .withColumn("_times", times)
        .withColumn("_copy", F.explode(F.expr("array_repeat(0, _times)")))
        .select("given.*")
    )
