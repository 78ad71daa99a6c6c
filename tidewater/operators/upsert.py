"""Idempotent loads without a table format.

Everything is a join on a natural key or a deterministic id followed by a
union; the result is written to a new folder (or a dynamic partition
overwrite), never read and overwritten in one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dedup import keep_first
from tidewater.operators.joins import bounded_broadcast


def get_or_create(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows to create (distinct candidates whose key is not present) and
    the resulting table (existing plus created)."""
    new = candidates.distinct().dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")
    return new, existing.unionByName(new, allowMissingColumns=True)


def skip_existing(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """K5: entities already written are not written again."""
    return candidates.join(existing.select(*keys).distinct(), keys, "left_anti")


def refresh(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Forced refresh -- every key of either side; a value of ``new``
    replaces the old one, a NULL in ``new`` keeps the old value. Adds
    ``_origin`` (both / new / old)."""
    value_cols = [c for c in new.columns if c not in keys]
    old_cols = set(old.columns)
    n = new.select(*keys, *[F.col(c).alias("_n_" + c) for c in value_cols], F.lit(True).alias("_in_new"))
    o = old.select(*keys, *[F.col(c).alias("_o_" + c) for c in value_cols if c in old_cols],
                   *[F.col(c) for c in old.columns if c not in keys and c not in value_cols],
                   F.lit(True).alias("_in_old"))
    j = n.join(o, keys, "full")
    merged = [F.coalesce(F.col("_n_" + c), F.col("_o_" + c)).alias(c) if c in old_cols else F.col("_n_" + c).alias(c)
              for c in value_cols]
    origin = (F.when(F.col("_in_new") & F.col("_in_old"), "both").when(F.col("_in_new"), "new").otherwise("old"))
    extra = [c for c in old.columns if c not in keys and c not in value_cols]
    return j.select(*keys, *merged, *extra, origin.alias("_origin"))


# K8 write modes
NONE = "NONE"
DELETE_BEFORE_UPLOAD = "DELETE_BEFORE_UPLOAD"
DETERMINISTIC_ID = "DETERMINISTIC_ID"


def apply_write_mode(existing: DataFrame, incoming: DataFrame, mode: str, ds_col: str, identity: list[str],
                     order: list[str] | None = None) -> DataFrame:
    """K8: the observation table after loading ``incoming``. ``identity`` is the
    natural key of an observation (datastream key, time): hashed ids may clash
    across datastreams and never decide what is dropped.

    * NONE: append everything (duplicates possible);
    * DELETE_BEFORE_UPLOAD: drop the existing rows of every datastream that
      ``incoming`` touches, then append;
    * DETERMINISTIC_ID: append only rows whose identity is not present yet,
      the first in ``order`` of several (a replayed batch adds nothing).

    The stored form of the same modes is ``sinks.tables.ObservationTable``.
    """
    if mode == NONE:
        return existing.unionByName(incoming)
    if mode == DELETE_BEFORE_UPLOAD:
        touched = incoming.select(ds_col).distinct()     # one row per datastream; broadcast only if measured small
        return existing.join(bounded_broadcast(touched), ds_col, "left_anti").unionByName(incoming)
    if mode == DETERMINISTIC_ID:
        fresh = keep_first(incoming, identity, order or identity).join(existing.select(*identity), identity, "left_anti")
        return existing.unionByName(fresh)
    raise ValueError(f"unknown write mode {mode}")


def reconcile(expected: DataFrame, visible: DataFrame, keys: list[str]) -> DataFrame:
    """K9: expected rows per key against rows read back; a row per key with
    both counts and ``ok`` (visible >= expected)."""
    e = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    v = visible.groupBy(*keys).agg(F.count(F.lit(1)).alias("visible"))
    j = e.join(v, keys, "full").fillna(0, ["expected", "visible"])
    return j.withColumn("ok", F.col("visible") >= F.col("expected"))


def assert_reconciled(report: DataFrame) -> None:
    """K9: fail with the first mismatching keys (a bounded sample)."""
    bad = report.filter(~F.col("ok"))
    sample = bad.limit(5).collect()
    if sample:
        raise AssertionError(f"rows missing after write, e.g. {[r.asDict() for r in sample]}")


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Several district files as one table."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not in ``right`` (multiset)."""
    return left.exceptAll(right)
