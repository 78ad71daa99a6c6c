"""Deletes as table rewrites.

A delete is a ``left_anti`` join against the keys to remove; the survivors
are written to a new folder or over the affected partitions only. The
cascade produces a delete plan frame first, so a dry run is just not
writing it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import bounded_broadcast
from tidewater.session import cut


def delete_observations_of(obs: DataFrame, datastreams: DataFrame, ds_col: str = "datastream_key") -> DataFrame:
    """Observations that survive deleting every observation of the given
    datastreams, by natural key: hashed ids may clash."""
    return obs.join(bounded_broadcast(datastreams.select(ds_col).distinct()), ds_col, "left_anti")


# Dependency order for emptying whole collections.
DELETE_ORDER = ["Observations", "Datastreams", "Sensors", "ObservedProperties", "Locations", "Things",
                "FeaturesOfInterest"]


def empty_collections(tables: dict) -> list[str]:
    """Clear stored collections (anything with ``clear()``) in dependency
    order; returns the names in the order they were emptied."""
    done = [name for name in DELETE_ORDER if name in tables]
    for name in done:
        tables[name].clear()
    return done


def delete_by_id(df: DataFrame, id_col: str, entity_id) -> DataFrame:
    """Drop one entity (a value or a scalar subquery; nothing if absent)."""
    return df.filter(~F.col(id_col).eqNullSafe(F.lit(entity_id)) | F.col(id_col).isNull())


def update_by_id(df: DataFrame, id_col: str, entity_id, changes: dict[str, Column]) -> DataFrame:
    """Patch one entity: the given columns change on that row only."""
    out = df
    hit = F.col(id_col).eqNullSafe(F.lit(entity_id)) & F.col(id_col).isNotNull()
    for c, v in changes.items():
        out = out.withColumn(c, F.when(hit, v).otherwise(F.col(c)))
    return out


@dataclass
class CascadeResult:
    plan: DataFrame          # entity, iot_id, action
    parts: dict              # entity -> frame of ids to delete
    observations: DataFrame  # survivors
    datastreams: DataFrame
    things: DataFrame
    locations: DataFrame


def cascade_by_property_name(props: DataFrame, datastreams: DataFrame, observations: DataFrame,
                             things: DataFrame, locations: DataFrame, name: str) -> CascadeResult:
    """Delete the observations and datastreams of every ObservedProperty
    called ``name``, then the Things left without any datastream (J20) and
    their Locations. ``plan`` lists what goes (dry run = do not write the
    survivors).

    All joins are on the natural keys ``definition``, ``datastream_key`` and
    ``thing_key``; ids are only reported. The doomed datastreams and the orphans
    are dimension-sized and computed once (in the shared checkpoint folder), so
    every branch reads them instead of working them out again."""
    p = props.filter(F.col("name") == F.lit(name)).select("definition").distinct()
    gone_ds = cut(datastreams.join(bounded_broadcast(p), "definition", "left_semi").select(
        "datastream_id", "datastream_key", "thing_key"))
    gone_keys = bounded_broadcast(gone_ds.select("datastream_key"))
    gone_obs = observations.join(gone_keys, "datastream_key", "left_semi")
    left_ds = datastreams.join(gone_keys, "datastream_key", "left_anti")
    affected = gone_ds.select("thing_key").distinct()
    orphan = cut(things.join(affected, "thing_key", "left_semi")
                 .join(left_ds.select("thing_key").distinct(), "thing_key", "left_anti").select("thing_key", "thing_id"))
    gone_loc = locations.join(bounded_broadcast(orphan.select("thing_key")), "thing_key", "left_semi")
    plan = (gone_obs.select(F.lit("Observation").alias("entity"), F.col("obs_id").alias("iot_id"))
            .unionByName(gone_ds.select(F.lit("Datastream").alias("entity"), F.col("datastream_id").alias("iot_id")))
            .unionByName(orphan.select(F.lit("Thing").alias("entity"), F.col("thing_id").alias("iot_id")))
            .unionByName(gone_loc.select(F.lit("Location").alias("entity"), F.col("location_id").alias("iot_id")))
            .withColumn("action", F.lit("delete")))
    return CascadeResult(
        plan=plan,
        parts={"Observation": gone_obs.select(F.col("obs_id").alias("iot_id")),
               "Datastream": gone_ds.select(F.col("datastream_id").alias("iot_id")),
               "Thing": orphan.select(F.col("thing_id").alias("iot_id")),
               "Location": gone_loc.select(F.col("location_id").alias("iot_id"))},
        observations=observations.join(gone_keys, "datastream_key", "left_anti"),
        datastreams=left_ds,
        things=things.join(orphan.select("thing_key"), "thing_key", "left_anti"),
        locations=locations.join(orphan.select("thing_key"), "thing_key", "left_anti"))


def plan_counts(result: CascadeResult) -> DataFrame:
    """X3 dry-run report: rows to delete per entity kind (0 included)."""
    from functools import reduce
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("entity"), F.lit("delete").alias("action"), "n")
             for k, df in result.parts.items()]
    return reduce(DataFrame.unionByName, parts)
