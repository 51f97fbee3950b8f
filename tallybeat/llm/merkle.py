"""Merkle manifest of a dataset: leaves, a tree per group, a tree over the groups, proofs.

Every node is the SHA-256 of its children in a row, three by three; the last run of a level may be
shorter. Only every few levels are written (checkpoints). A proof needs the nodes between:
each aligned subtree makes them again from the written nodes below it, hands out the siblings of
its paths, and forgets them. So a subtree is the unit of work: it holds at most 3 ** ``every`` nodes
whatever the size of its group, and a group of any size is many subtrees.

Places within a group come from one range sort and the numbers of rows per sorted part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.sources.tables import staged

FAN = 3
#: Levels from one written level to the next: subtrees of 81 nodes.
EVERY = 4


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(start: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    steps = F.arrays_zip(left.alias("left"), right.alias("right"))
    return F.aggregate(steps, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def siblings_digest(left: Column, right: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), ""), 256)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``at``, their place in their ``group`` from 0, and ``n``, its number of rows.

    Needs ``group``, a string without nulls. Sorted parts are written with their part and row
    number; a part holds a third of a hot group at most as it holds of any rows, and rows equal
    in all of ``order`` are dealt over parts by a draw. What is summed up is one row per
    part and group.
    """
    draw = F.xxhash64(F.monotonically_increasing_id())
    sort = ["group", *order, "draw"]
    parts = rows.withColumn("draw", draw).repartitionByRange(*sort).sortWithinPartitions(*sort).drop("draw")
    parts = staged(
        parts.withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.shiftright("row", 33)),
        "merkle-sorted",
    )
    counts = parts.groupBy("group", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    sums = counts.selectExpr(
        "group",
        "part",
        "first - coalesce(sum(rows) OVER (PARTITION BY group ORDER BY part "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift",
        "sum(rows) OVER (PARTITION BY group) AS n",
    )
    return parts.join(sums, ["group", "part"]).withColumn("at", F.col("row") - F.col("shift")).drop("row", "part", "shift")


def levels_above(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _steps(n: int, done: int, every: int) -> int:
    """Levels that a subtree climbs which begins ``done`` levels above the leaves."""
    return max(0, min(every, levels_above(n) - done))


def _climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The levels of a subtree from its lowest nodes to its top."""
    out = [nodes]
    for _ in range(levels):
        low = out[-1]
        out.append([sha256("".join(low[i : i + FAN]).encode()).hexdigest() for i in range(0, len(low), FAN)])
    return out


def _subtrees(nodes: DataFrame, every: int, *payload: str) -> DataFrame:
    """One row per aligned subtree: its nodes in order, at most FAN ** every."""
    size = F.lit(FAN**every).cast("bigint")
    node = F.struct("at", "hash", *payload)
    return (
        nodes.withColumn("tree", F.floor(F.col("at") / size))
        .groupBy("group", "n", "tree")
        .agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    )


def _tops(nodes: DataFrame, done: int, every: int) -> DataFrame:
    """The next written level: the top of every subtree."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [
                _climb(own, _steps(n, done, every))[-1][0]
                for n, own in zip(batch.column("n").to_pylist(), batch.column("hashes").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("n"), batch.column("tree"), pa.array(hashes, pa.string())],
                ["group", "n", "at", "hash"],
            )

    trees = _subtrees(nodes, every)
    return trees.select("group", "n", "tree", F.col("nodes.hash").alias("hashes")).mapInArrow(
        tops, "group string, n bigint, at bigint, hash string"
    )


def grow(leaves: DataFrame, every: int = EVERY) -> list[DataFrame]:
    """The written levels above numbered leaves (group, n, at, hash), up to one node per group."""
    most = leaves.agg(F.max("n")).first()[0] or 1
    levels, done = [], 0
    while done < levels_above(most):
        below = levels[-1] if levels else leaves.select("group", "n", "at", "hash")
        levels.append(staged(_tops(below, done, every), "merkle-level"))
        done += every
    return levels


def _paths(nodes: DataFrame, above: DataFrame, done: int, every: int, payload: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """The siblings of every node's path: those in its subtree, then those above its top.

    ``above`` (group, tree, left, right and the ``carried`` columns) has a row per subtree. The nodes
    within are made again here, and dropped with the batch.
    """
    trees = _subtrees(nodes, every, *payload).join(above, ["group", "tree"])
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    kinds |= {f.name: f.dataType.simpleString() for f in above.schema}
    schema = [f"{c} {kinds[c]}" for c in ("group", "n", "at", "hash", *payload, *carried)]

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 16):  # a batch of paths is much longer than its nodes
                part = batch.slice(begin, 16)
                lefts, rights = [], []
                up = zip(part.column("n").to_pylist(), part.column("left").to_pylist(), part.column("right").to_pylist())
                flat = part.column("nodes").flatten()
                hashes, first = flat.field("hash").to_pylist(), 0
                sizes = part.column("nodes").value_lengths().to_pylist()
                for size, (n, left, right) in zip(sizes, up):
                    tree = _climb(hashes[first : first + size], _steps(n, done, every))
                    for i in range(size):
                        own_left, own_right, place = [], [], i
                        for level in tree[:-1]:
                            run = place - place % FAN
                            own_left.append("".join(level[run:place]))
                            own_right.append("".join(level[place + 1 : run + FAN]))
                            place //= FAN
                        lefts.append(own_left + left)
                        rights.append(own_right + right)
                    first += size
                tree_of = pa.array([i for i, size in enumerate(sizes) for _ in range(size)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(tree_of) for c in ("group", "n")),
                        *(flat.field(c) for c in ("at", "hash", *payload)),
                        *(part.column(c).take(tree_of) for c in carried),
                        pa.array(lefts, pa.list_(pa.string())),
                        pa.array(rights, pa.list_(pa.string())),
                    ],
                    ["group", "n", "at", "hash", *payload, *carried, "left", "right"],
                )

    return trees.mapInArrow(paths, ", ".join([*schema, "left array<string>", "right array<string>"]))


def proofs(
    leaves: DataFrame, levels: list[DataFrame], starts: DataFrame, payload: Sequence[str] = (), every: int = EVERY
) -> DataFrame:
    """The leaves with ``left`` and ``right``, the siblings of their path, from the lowest level up.

    ``starts`` (group, left, right and more columns, which all leaves of the group get) has the
    path from the top of each group on.
    """
    carried = [c for c in starts.columns if c not in ("group", "left", "right")]
    above = starts.withColumn("tree", F.lit(0).cast("bigint"))
    written = [leaves, *levels[:-1]] if levels else [leaves]
    for k in reversed(range(len(written))):
        found = _paths(written[k], above, k * every, every, payload if k == 0 else (), carried)
        above = found.select("group", F.col("at").alias("tree"), "left", "right", *carried)
    return found


def manifest(rows: DataFrame, payload: Sequence[str] = (), every: int = EVERY) -> DataFrame:
    """doc_id, source, leaf, the payload, subroot, root and the proof of every row.

    Needs doc_id, source and leaf (hex, see ``leaf``); no other column but the payload is read. The
    leaves of a source ascend by doc_id (null first), then by leaf; sources ascend by their
    UTF-8 bytes, null first. ``left`` and ``right`` are arrays by level, from the leaf up to the
    root: the siblings before and behind, joined; both empty where a node is alone in its run. Rows
    equal in id, source and leaf take consecutive places, so which of them has which
    proof is free; all are valid. An empty table gives an empty result.
    """
    group = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("+"), "source"))
    given = list(dict.fromkeys(["doc_id", *payload]))
    inner = rows.select(*given, group.alias("group"), F.col("leaf").alias("hash"))
    leaves = staged(numbered(inner, ["doc_id", "hash"]), "merkle-leaves")
    levels = grow(leaves, every)
    tops = levels[-1] if levels else leaves.select("group", "n", "at", "hash")

    # The same over the groups: their tops are the leaves of one tree.
    outer = tops.select(F.lit("").alias("group"), F.col("group").alias("source_group"), "hash")
    heads = staged(numbered(outer, ["source_group"]), "merkle-heads")
    over = grow(heads, every)
    root = (over[-1] if over else heads).select("group", F.col("hash").alias("root"))
    none = F.array().cast("array<string>")
    starts = proofs(heads, over, root.withColumns({"left": none, "right": none}), ["source_group"], every)
    starts = staged(
        starts.select(F.col("source_group").alias("group"), F.col("hash").alias("subroot"), "root", "left", "right"),
        "merkle-starts",
    )
    found = proofs(leaves, levels, starts, given, every)
    source = F.when(F.col("group") != "", F.substr("group", F.lit(2)))
    return found.select(
        *given, source.alias("source"), F.col("hash").alias("leaf"), "subroot", "root", "left", "right"
    )


def verified(found: DataFrame, claim: Column) -> DataFrame:
    """With ``folded_root``, what a claimed leaf and the proof give, and whether it is the root."""
    checked = found.withColumn("folded_root", folded(claim, F.col("left"), F.col("right")))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaf(text: Column) -> Column:
    return leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)


def tampered(text: Column) -> Column:
    """A text without its line breaks."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def audit(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """The manifest of documents with the check of a copy that was tampered with.

    Needs doc_id, source, lang, n_chars and text; other columns are not read, nulls in any are
    part of the leaf. In the copy, texts whose doc_id has an even crc32 lost their line breaks (a
    null id has none, so its text is untouched); each copy's leaf is folded with the original
    proof. Texts are read once; only digests are written or shuffled.
    """
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    own = document_leaf(F.col("text"))
    broken = even & F.coalesce(F.contains("text", F.lit("\n")), F.lit(False))
    claim = F.when(broken, document_leaf(tampered(F.col("text"))))
    rows = staged(docs.select("doc_id", "source", own.alias("leaf"), claim.alias("claim")), "merkle-digests")
    return verified(manifest(rows, ["claim"], every), F.coalesce("claim", "leaf"))
