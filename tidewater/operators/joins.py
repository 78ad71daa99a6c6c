"""Lookup joins (J1-J14) and the size-checked broadcast they rely on.

Every lookup in the reference is a hash-map probe of a small table. In Spark
that is a broadcast hash join -- but only while the small side really is
small. ``bounded_broadcast`` hints a broadcast only when the optimizer's size
estimate, and for tables read from files the bytes of their rows in memory, are
under a bound; otherwise the side is joined by shuffle (sort-merge or shuffled
hash) and AQE may still switch to a broadcast at run time from the measured size.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Default ceiling for an explicit broadcast hint: 64 MiB estimated.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (None when unavailable)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception as e:  # pragma: no cover - Spark Connect has no JVM handle
        log.warning("no size estimate, joining by shuffle: %s", e)
        return None


def input_bytes(df: DataFrame) -> int | None:
    """Estimated size of what a plan reads, without what its joins make of it
    (None when unavailable)."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except Exception as e:  # pragma: no cover - Spark Connect has no JVM handle
        log.warning("no input size, keeping the tables: %s", e)
        return None


# Files up to this estimate are taken as small whatever they unfold to: 1 MiB.
SMALL_FILE_BYTES = 1024 * 1024
# What may stand above the files of a plan whose rows are counted: counting then
# needs no more than their footers, or one pass over the columns of a filter.
COUNTED_NODES = {"Project", "Filter", "LogicalRelation"}


def file_rows_bytes(df: DataFrame) -> int | None:
    """Bytes in memory of the rows that a plan takes from one table in files, by
    their number: the optimizer knows the files' size only, and a column file
    holds rows in a small part of the bytes that they unfold to. None if the plan
    is of another kind."""
    try:
        nodes, todo = [], [df._jdf.queryExecution().optimizedPlan()]
        while todo:
            plan = todo.pop()
            nodes.append(str(plan.nodeName()).split(" ")[0])
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
        if nodes[-1] != "LogicalRelation" or not COUNTED_NODES.issuperset(nodes):
            return None
        return df.count() * (8 * len(df.columns) + int(df._jdf.schema().defaultSize()))
    except Exception as e:  # pragma: no cover - Spark Connect has no JVM handle
        log.warning("rows not counted, going by the estimate: %s", e)
        return None


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a size check; unhinted beyond the bound. The driver
    collects the rows and builds the hash table, so files count as unfolded."""
    size = estimated_bytes(df)
    if size is not None and min(SMALL_FILE_BYTES, max_bytes) < size <= max_bytes:
        size = max(size, file_rows_bytes(df) or 0)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


# Ceiling for a hash table that one task of a shuffled join holds: 256 MiB.
DEFAULT_HASHED_BYTES = 256 * 1024 * 1024


def bounded_hash(df: DataFrame, size: int, max_bytes: int = DEFAULT_HASHED_BYTES) -> DataFrame:
    """Hint to join by shuffle and hash, without sorting either side, when the
    share of one shuffle partition in ``size`` bytes is under a bound; unhinted
    (sorted, may spill) beyond it. For keys that hardly repeat."""
    share = size // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if share <= max_bytes else df


def semi_join(facts: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """Facts whose key exists in ``keys_df``."""
    return facts.join(bounded_broadcast(keys_df.select(*keys).distinct()), keys, "left_semi")


def anti_join(facts: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``facts`` whose key is absent from ``keys_df`` (reject side)."""
    return facts.join(bounded_broadcast(keys_df.select(*keys).distinct()), keys, "left_anti")


def lookup(facts: DataFrame, table: DataFrame, keys: list[str] | dict[str, str], how: str = "left") -> DataFrame:
    """Keyed lookup: ``keys`` maps fact columns to table columns (or a shared
    list). The table must be unique on its key (use ``last_wins`` first)."""
    if isinstance(keys, list):
        return facts.join(bounded_broadcast(table), keys, how)
    cond = None
    for fk, tk in keys.items():
        c = facts[fk] == table[tk]
        cond = c if cond is None else cond & c
    out = facts.join(bounded_broadcast(table), cond, how)
    return out.drop(*[table[tk] for tk in keys.values()])


def materialized(df: DataFrame) -> DataFrame:
    """Persist a dimension-sized frame that several joins reuse and run it
    once. Afterwards the optimizer sees its real in-memory size, so
    ``bounded_broadcast`` decides on measured bytes instead of the
    multiplied estimate of a join chain. Lost partitions are recomputed from
    lineage (no local checkpoint)."""
    from pyspark import StorageLevel

    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    p.count()
    return p
