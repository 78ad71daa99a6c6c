"""Navigation joins over the entity model.

Navigation is an equi-join or a filter on a natural key (``thing_key``,
``datastream_key``, ``definition``): ids have a limited number of slots and may
clash, so they are output only. Child-side counts are aggregated before they meet the parent
(partial aggregation on the large side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import bounded_broadcast


def children_of(child: DataFrame, fk: str, parent_id) -> DataFrame:
    """Children of one parent (``getThingDatastreams(id)`` and kin)."""
    return child.filter(F.col(fk) == F.lit(parent_id))


def child_counts(parent: DataFrame, pk: str, child: DataFrame, fk: str, out: str) -> DataFrame:
    """J17 for every parent at once: number of children, 0 when none."""
    c = child.groupBy(F.col(fk).alias(pk)).agg(F.count(F.lit(1)).alias(out))
    return parent.join(c, pk, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def expand(child: DataFrame, fk: str, parent: DataFrame, pk: str, as_name: str) -> DataFrame:
    """Child rows with their parent nested as a struct (``$expand``)."""
    cols = [c for c in parent.columns]
    p = parent.select(F.col(pk).alias("_pk"), F.struct(*[F.col(c) for c in cols]).alias(as_name))
    return child.join(bounded_broadcast(p), child[fk] == p["_pk"], "left").drop("_pk")


def observations_by_property(obs: DataFrame, ds: DataFrame, definition: str | None = None) -> DataFrame:
    """Observations reached through Datastream/ObservedProperty; with a
    definition, only that property's observations."""
    d = ds.select("datastream_key", "definition")
    if definition is not None:
        d = d.filter(F.col("definition") == F.lit(definition))
    return obs.join(bounded_broadcast(d), "datastream_key")


def datastreams_by_property_name(ds: DataFrame, props: DataFrame, name: str) -> DataFrame:
    """Datastreams whose ObservedProperty has this name."""
    p = props.filter(F.col("name") == F.lit(name)).select("definition")
    return ds.join(bounded_broadcast(p), "definition", "left_semi")


def orphans(parents: DataFrame, pk: str, children: DataFrame, fk: str) -> DataFrame:
    """Parents with no child left."""
    return parents.join(children.select(F.col(fk).alias(pk)).distinct(), pk, "left_anti")
