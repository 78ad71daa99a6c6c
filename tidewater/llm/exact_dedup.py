"""Exact de-duplication with a heavy-hitter split (operator 2).

1. Every text is normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one
   space) and digested with SHA-256; from here on only (id, digest) rows move.
2. Misra-Gries: every partition keeps ``counters`` digest counters. Summed over
   the partitions, a digest's counter is at most its true count and at least
   that count minus ``n / (counters + 1)``. Keeping sums of at least
   ``(share - 1 / (counters + 1)) * n`` therefore keeps every digest that holds
   ``share`` of the rows or more, and at most ``1 / (share - 1/(counters + 1))``
   digests in all, whatever the input: the bound that allows the broadcast.
3. The candidates are verified: their exact counts and winners come from one
   map-side aggregate over the (id, digest) rows.
4. Rows of frequent digests meet the broadcast winners map-side; only the
   remaining digests are shuffled, and none of them holds ``share`` of the rows.

Defined results: a null text counts as empty (so null and empty texts are
equal); null ids sort after all others and are kept only if their group has
no other id; of repeated rows (same id, same text) one stays; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import cut, map_arrow, parted, worker_cache

by_value(__name__)

SHARE = 1 / 1000
COUNTERS = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def summarise(counters: int):
    """Misra-Gries over a partition, fed batch by batch: counts are added,
    then the (counters + 1)-th largest is taken from all (mergeable form)."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        worker_cache("exact dedup")                      # let go of other operators' tables
        held: dict = {}
        for batch in batches:
            for x in pc.value_counts(batch.column(0)).to_pylist():
                held[x["values"]] = held.get(x["values"], 0) + x["counts"]
            if len(held) > counters:
                drop = sorted(held.values(), reverse=True)[counters]
                held = {k: v - drop for k, v in held.items() if v > drop}
        yield pa.RecordBatch.from_pydict({"digest": pa.array(list(held), pa.string()),
                                          "seen": pa.array(list(held.values()), pa.int64())})

    return run


def frequent_digests(rows: DataFrame, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """Digests that may hold ``share`` of the rows: all that do, and no more
    than ``1 / (share - 1/(counters + 1))`` in total."""
    n = rows.count()
    least = max(2.0, (share - 1 / (counters + 1)) * n)
    sums = map_arrow(rows.select("digest"), summarise(counters), "digest string, seen long")
    # a digest seen once in a partition can only matter if its sum reaches the bound
    return sums.groupBy("digest").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= least).select("digest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE,
                 counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, frequent."""
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"))
               .withColumn("row", F.monotonically_increasing_id()))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    group = [F.min(order).alias("first"), F.count("*").alias("group_size")]
    frequent = F.broadcast(cut(frequent_digests(rows, share, counters)))
    winners = cut(rows.join(frequent, "digest", "left_semi").groupBy("digest").agg(*group))  # exact, a bounded table
    heavy = rows.join(F.broadcast(winners), "digest").withColumn("frequent", F.lit(True))
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    rest = light.join(light.groupBy("digest").agg(*group), "digest").withColumn("frequent", F.lit(False))
    return heavy.unionByName(rest).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("group_size").cast("long"),
        (F.col("row") == F.col("first.row")).alias("kept"), F.col("digest").alias("text_sha256"), "frequent")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE,
                      counters: int = COUNTERS) -> DataFrame:
    """The input's columns, one row of each group of equal texts (smallest id).

    Copies of frequent texts are removed map-side against the broadcast
    winners before anything is shuffled. Of the rest only rows whose digest occurs
    again are shuffled (``common.parted``) and ranked per digest, with Spark's group
    limit ahead of the shuffle."""
    from pyspark.sql import Window

    names = docs.columns
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("id"),
                       digest(F.col(text_col)).alias("digest"))
    rows = cut(work.select(F.col("id").alias("doc_id"), "digest"))
    frequent = F.broadcast(cut(frequent_digests(rows, share, counters)))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
    winners = cut(rows.join(frequent, "digest", "left_semi").groupBy("digest").agg(F.min(order).alias("first"))
                  .select("digest", F.col("first.doc_id").alias("keep_id"), F.lit(True).alias("hot")))
    left = (work.join(F.broadcast(winners), "digest", "left")
            .filter(F.col("hot").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))))
    again = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    single, others = parted(left.select("digest", "id", "row"), "digest", again)
    first = Window.partitionBy("digest").orderBy(F.col("id").asc_nulls_last())
    return (single.select("row").unionByName(others.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select("row"))
            .select("row.*"))
