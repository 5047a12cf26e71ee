"""Sharding by a weighted hash tree: region, rack, shard.

On every level each child draws ``-ln(u) / weight``, where ``u`` in (0, 1) is a hash of the
key and the child's path, and the least draw wins. A draw depends on nothing but the key and
the child, so a changed weight moves rows only to or from the subtree that holds it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surtido.llm.common import stored

# (region, rack, shard) -> weight
Tree = Mapping[tuple[int, int, int], float]

# Ranges of the hash within a shard that are numbered one by one; 8 shards have 8,192.
SLOT_RANGES = 1024


def balanced_tree(shards: int, per_rack: int = 2, racks_per_region: int = 2) -> Tree:
    """Shards 0 to n - 1, filled in order into racks and regions."""
    return {(s // (per_rack * racks_per_region), s // per_rack % racks_per_region, s): 1.0
            for s in range(shards)}


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree and one more shard, in a region of its own.

    The weights of the present regions stay, so rows can move into the new region only,
    and there is one shard in it.
    """
    regions = {path[0] for path in tree}
    shard = max((path[2] for path in tree), default=-1) + 1
    return {**tree, (max(regions, default=-1) + 1, 0, shard): weight}


def _draw(key: Column, path: Sequence[int], weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit("/".join(map(str, path)))), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(uniform) / F.lit(float(weight))


def _level(key: Column, parent: Column | None, tree: Tree, depth: int) -> Column:
    """The winning child of the chosen parent; a child's weight is that of its shards."""
    weights: dict[tuple[int, ...], float] = {}
    for path, weight in tree.items():
        weights[path[:depth]] = weights.get(path[:depth], 0.0) + weight
    choices: dict[tuple[int, ...], list[Column]] = {}
    for path, weight in sorted(weights.items()):
        if weight > 0:
            choices.setdefault(path[:-1], []).append(F.struct(
                _draw(key, path, weight).alias("draw"),
                F.array(*map(F.lit, path)).alias("path")))
    best = None
    for before, draws in choices.items():
        won = (F.least(*draws) if len(draws) > 1 else draws[0])["path"]
        if parent is None:
            return won
        hit = parent == F.array(*map(F.lit, before))
        best = F.when(hit, won) if best is None else best.when(hit, won)
    return best


def assign(df: DataFrame, key: Column, tree: Tree, name: str) -> DataFrame:
    """The rows with the shard of their key in column ``name``.

    The key is hashed as text; rows without a key share one shard. One level is one
    projection, so a level's draws are made once for the subtree that was chosen.
    """
    if not any(weight > 0 for weight in tree.values()):
        raise ValueError("the tree has no shard with a weight above 0")
    at, text = f"{name}_path", key.cast("string")
    for depth in (1, 2, 3):
        df = df.withColumn(at, _level(text, F.col(at) if depth > 1 else None, tree, depth))
    return df.withColumn(name, F.col(at)[2].cast("int")).drop(at)


def number(df: DataFrame, shard: str, by: Sequence[str], slot: str) -> DataFrame:
    """The rows with a number in their shard, from 0 and without gaps.

    A shard is cut into ranges by a hash of ``by``; the counts of the ranges give their
    first numbers, and only the rows of one range are sorted together. Rows equal in all
    of ``by`` may exchange their numbers.
    """
    part, first = f"{slot}_part", f"{slot}_first"
    df = df.withColumn(part, F.pmod(F.xxhash64(*by, F.lit(slot)), F.lit(SLOT_RANGES)).cast("int"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = df.groupBy(shard, part).agg(F.count(F.lit(1)).alias("n")).select(
        shard, part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first))
    within = F.row_number().over(Window.partitionBy(shard, part).orderBy(*by))
    return df.withColumn(slot, within).join(starts, [shard, part]).withColumn(
        slot, F.col(first) + F.col(slot) - 1).drop(part, first)


def shard_documents(docs: DataFrame, tree: Tree, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: its shard now, in the grown tree, and its number in the shard.

    ``doc_id, size, text_crc32, shard, slot, grown_shard``. A null text has size 1 and
    checksum 0; repeated rows get numbers of their own; an empty table gives no rows;
    other columns are left out.
    """
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"))
    rows = assign(rows, F.col("doc_id"), tree, "shard")
    rows = stored(assign(rows, F.col("doc_id"), grow(tree), "grown_shard"))
    return number(rows, "shard", ("doc_id", "text_crc32", "size"), "slot")
