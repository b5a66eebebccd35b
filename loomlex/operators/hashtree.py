"""Hash trees over tables: two tables are compared from the root down, and only key ranges that differ are joined.

A row falls into a leaf by a hash of its keys. A leaf's digest is made of its rows' digests in any order, a node's of its
children's; a recorded table's tree can be kept with it, so that the table itself is read only where it differs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: Bits of the leaves' numbers, and of a step from a level to the next: 1, 64 and 4,096 nodes.
BITS, STEP = 12, 6
TREE = "level int, node long, digest string"


def leaf(keys: list[str], bits: int = BITS) -> Column:
    """A row's leaf; equal keys share one, whatever their types' nulls."""
    return F.pmod(F.xxhash64(*(F.struct(F.col(f"`{k}`").isNull(), F.col(f"`{k}`")) for k in keys)), F.lit(1 << bits))


def tree(rows: DataFrame, keys: list[str], bits: int = BITS, step: int = STEP) -> DataFrame:
    """TREE of a table; an empty one has no nodes. Columns count by name, so that their order is no difference."""
    digest = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(rows.columns))), {"ignoreNullFields": "false"}), 256)
    part = lambda a: F.conv(F.substring("_d", a, 15), 16, 10)
    own = rows.select(leaf(keys, bits).alias("node"), digest.alias("_d")).groupBy("node")
    held = own.agg(F.sha2(F.concat_ws(":", F.count(F.lit(1)), F.sum(part(1).cast("decimal(20,0)")), F.sum(part(16).cast("decimal(20,0)")), F.bit_xor(part(31).cast("long"))), 256).alias("digest"))
    level = -(-bits // step)
    out = now = stored(held.select(F.lit(level).alias("level"), "node", "digest"), "hash-tree")
    while level:
        level -= 1
        said = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("node").cast("string"), 20, "0"), "digest"))), " ")
        now = now.groupBy(F.shiftright("node", step).alias("node")).agg(F.sha2(said, 256).alias("digest")).select(F.lit(level).alias("level"), "node", "digest")
        out = out.unionAll(now)
    return out


def leaves_apart(a: DataFrame, b: DataFrame, step: int = STEP) -> DataFrame:
    """(leaf) of two trees whose digests differ: a level's nodes are compared only below nodes that differ."""
    top = max((df.agg(F.max("level")).first()[0] or 0) for df in (a, b))
    apart = None
    for level in range(top + 1):
        x, y = (df.where(F.col("level") == level).select("node", F.col("digest").alias(c)) for df, c in ((a, "_a"), (b, "_b")))
        if apart is not None:
            x, y = (df.join(apart, F.shiftright(F.col("node"), step) == F.col("_up"), "left_semi") for df in (x, y))
        found = x.join(y, "node", "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(F.col("node").alias("_up"))
        apart = stored(found, "nodes-apart")
        if apart.isEmpty():
            break
    return apart.select(F.col("_up").alias("leaf"))


def narrowed(recorded: DataFrame, anew: DataFrame, keys: list[str], known: DataFrame | None = None, bits: int = BITS, step: int = STEP) -> tuple[DataFrame, DataFrame]:
    """Both tables' rows of the leaves that differ; known: the recorded table's tree, where it is kept."""
    held = known if known is not None else tree(recorded, keys, bits, step)
    # At most a row for each leaf.
    apart = F.broadcast(leaves_apart(held, tree(anew, keys, bits, step), step))
    at = [F.col("_leaf") == F.col("leaf")]
    return tuple(df.withColumn("_leaf", leaf(keys, bits)).join(apart, at, "left_semi").drop("_leaf") for df in (recorded, anew))


def same(recorded: DataFrame, anew: DataFrame, keys: list[str]) -> bool:
    """Whether two tables hold the same rows, by their roots alone."""
    roots = [tree(df, keys).where("level = 0").select("digest").first() for df in (recorded, anew)]
    return reduce(lambda a, b: a == b, roots)
