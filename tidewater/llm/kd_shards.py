"""K-d tree sharding by document metadata (operator 10), DataFrame code only.

Every row is a point over numeric metadata dimensions with its bytes as the
weight. A node of the tree that has to become ``k`` leaves is split along its
widest dimension (range relative to the whole table's range) at the weighted
quantile ``floor(k/2) / k`` -- the weighted median for even ``k`` -- until every
node is one leaf, which then holds the target bytes.

The quantile is found by distributed histograms: per round one aggregate over
the narrow (id, size, dimensions) table sums the bytes of equal cells of each node's
open interval; all nodes share ``CELLS`` cells (two each at least), so the driver
sees a bounded number of sums, and narrows each node to the cell that holds its
quantile. Rounds end when that cell weighs less than ``TOLERANCE`` of a leaf or is
a single key. A level of the tree is searched for all its nodes at once.

Dimensions become integer keys with ``JITTER`` low bits from a hash of the id and
a row number, so one value that holds a third of all rows (a hot source, one
language, rows without an id) can still be split anywhere inside. Equal texts
are not kept together.

Slots: rows are numbered inside (shard, hash bucket) and the buckets' counts
are summed up per shard, so no task sorts a whole shard.

Defined results: a null dimension is its own value below all others; a null
text weighs nothing but its 8 bytes; null ids and repeated rows are placed like
any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import cut

CELLS = 1 << 15
JITTER = 20
TOLERANCE = 1 / 500
BUCKET_ROWS = 50_000


def numeric_key(value: Column, salt: Column) -> Column:
    """Integer key of a non-negative number below 2^42 (null: 0)."""
    jitter = F.pmod(salt, F.lit(1 << JITTER))
    return F.coalesce(F.shiftleft(value.cast("long") + 1, JITTER), F.lit(0).cast("long")) + jitter


def category_key(value: Column, salt: Column) -> Column:
    """Integer key of a text category: a stable place on a line of 2^20."""
    return numeric_key(F.pmod(F.xxhash64(value), F.lit(1 << 20)) * F.when(value.isNotNull(), 1), salt)


def node_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table of tree nodes to join the rows with: at most one row per leaf. It is
    made by the JVM from one literal; rows given to Spark from Python would start
    Python workers."""
    names = [column.split()[0] for column in schema.split(", ")]
    kind = ", ".join(":".join(column.split()) for column in schema.split(", "))
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>"))))


def find_splits(points: DataFrame, leaves: dict[int, int], span: list[int]) -> dict[int, tuple[int, int]]:
    """Dimension and threshold (keys below go left) of every node that becomes
    more than one leaf; nodes without rows have none.

    All nodes are searched at once. A round sums the weight of equal cells of
    each node's open interval of keys; ``CELLS`` cells are shared by the nodes,
    so what reaches the driver is bounded whatever their number."""
    spark = points.sparkSession
    todo = node_table(spark, [(n,) for n, k in leaves.items() if k > 1], "node int")
    here = points.join(todo, "node", "left_semi").select("node", "weight", "keys")
    key = lambda i: F.col("keys")[i]
    dims = range(len(span))
    ranges = here.groupBy("node").agg(F.sum("weight").alias("w"), *[F.min(key(i)).alias(f"lo_{i}") for i in dims],
                                      *[F.max(key(i)).alias(f"hi_{i}") for i in dims]).collect()
    search = {}
    for r in ranges:
        dim = max(dims, key=lambda i: ((r[f"hi_{i}"] - r[f"lo_{i}"]) / max(1, span[i]), -i))
        k = leaves[r["node"]]
        # keys in [lo, hi) are still open; ``below`` is the weight of all keys under lo
        search[r["node"]] = {"dim": dim, "lo": r[f"lo_{dim}"], "hi": r[f"hi_{dim}"] + 1, "below": 0,
                             "goal": r["w"] * (k // 2) / k, "stop": r["w"] / k * TOLERANCE}
    live = dict(search)
    while live:
        cells = max(2, CELLS // len(live))
        for s in live.values():
            s["step"] = max(1, -(-(s["hi"] - s["lo"]) // cells))
        table = node_table(spark, [(n, s["dim"], s["lo"], s["hi"], s["step"]) for n, s in live.items()],
                           "node int, dim int, lo long, hi long, step long")
        placed = here.join(table, "node").select("node", "weight", F.get("keys", F.col("dim")).alias("key"), "lo", "hi", "step")
        inside = placed.filter((F.col("key") >= F.col("lo")) & (F.col("key") < F.col("hi")))
        cell = F.expr("(key - lo) div step").alias("cell")
        sums: dict[int, dict] = {}
        for r in inside.groupBy("node", cell).agg(F.sum("weight").alias("w")).collect():
            sums.setdefault(r["node"], {})[r["cell"]] = r["w"]
        for n, s in list(live.items()):
            total, start, step = s["below"], s["lo"], s["step"]
            for c in sorted(sums.get(n, {})):
                w = sums[n][c]
                if total + w >= s["goal"]:
                    s["below"], s["lo"], s["hi"] = total, start + c * step, min(s["hi"], start + (c + 1) * step)
                    if w <= s["stop"] or step == 1:
                        # cut on the side of this last cell that comes closer to the goal
                        s["cut"] = s["lo"] if s["goal"] - total <= total + w - s["goal"] else s["hi"]
                        del live[n]
                    break
                total += w
            else:
                s["cut"] = s["hi"]
                del live[n]
    return {n: (s["dim"], s["cut"]) for n, s in search.items()}


def place(points: DataFrame, dims: list[str], shards: int) -> DataFrame:
    """``points`` with the column ``shard``. Level by level each row joins its
    node's split and goes left or right; the narrow rows of a level are kept in
    shared storage, so plans stay short however deep the tree is."""
    whole = points.agg(*[(F.max(d) - F.min(d)).alias(d) for d in dims]).first()
    span = [whole[d] or 1 for d in dims]
    points = points.withColumn("keys", F.array(*dims)).drop(*dims).withColumn("node", F.lit(0))
    leaves = {0: shards}
    while max(leaves.values()) > 1:
        splits = find_splits(points, leaves, span)
        table = node_table(points.sparkSession, [(n, d, at, leaves[n] // 2) for n, (d, at) in splits.items()],
                           "node int, dim int, at long, half int")
        right = F.get("keys", F.col("dim")) >= F.col("at")
        points = cut(points.join(table, "node", "left")
                     .withColumn("node", F.when(right, F.col("node") + F.col("half")).otherwise(F.col("node")))
                     .drop("dim", "at", "half"))
        leaves = {child: k for n, m in leaves.items() for child, k in ((n, max(1, m // 2)), (n + m // 2, m - m // 2))}
    return points.withColumnRenamed("node", "shard").drop("keys")


def kd_shards(docs: DataFrame, numeric: list[str], categories: list[str], shards: int | None = None,
              target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size (text bytes + 8), text_crc32, shard, slot.

    Give the number of leaves (``shards``) or the bytes a leaf should reach. The
    salt that parts rows of equal dimensions has a row number in it, as ids may be
    null or repeat."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    salt = F.xxhash64(F.col(id_col), F.monotonically_increasing_id(), F.lit("kd"))
    dims = [f"d{i}" for i in range(len(numeric) + len(categories))]
    keys = [numeric_key(F.col(c), salt) for c in numeric] + [category_key(F.col(c), salt) for c in categories]
    points = cut(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("weight"),
                             F.crc32(text.cast("binary")).alias("text_crc32"),
                             *[k.alias(d) for k, d in zip(keys, dims)]))
    total = points.agg(F.sum("weight").alias("w"), F.count("*").alias("n")).first()
    leaves = shards or max(1, -(-(total["w"] or 0) // target_bytes))
    placed = place(points, dims, leaves)
    buckets = max(1, -(-(total["n"] or 0) // (leaves * BUCKET_ROWS)))
    return number_slots(placed, buckets).select("doc_id", F.col("weight").alias("size"), "text_crc32", "shard", "slot")


def number_slots(placed: DataFrame, buckets: int) -> DataFrame:
    """Add ``slot``: 0, 1, ... inside every shard, by (bucket, id)."""
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
               .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")
    ranked = placed.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(offsets, ["shard", "bucket"]).withColumn("slot", (F.col("offset") + F.col("rank")).cast("long"))
