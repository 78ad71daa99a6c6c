"""Endpoint report over the entity model (A11-A18): entity tables in, one
small frame per statistic out. Works on any entity tables with the model's
columns -- the ones built from a catalogue here, or ones read back from a
published folder (``sources.entities``)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import stats
from tidewater.plans import entities, mapping
from tidewater.plans.catalog import Catalog


@dataclass
class EntityTables:
    things: DataFrame
    locations: DataFrame
    datastreams: DataFrame
    sensors: DataFrame
    observed_properties: DataFrame
    observations: DataFrame


def build(cat: Catalog) -> EntityTables:
    """Entity tables of one mapping run; datastreams get the phenomenonTime
    interval of their observations (A18), NULL when they have none."""
    obs = mapping.map_observations(cat)
    ds = entities.datastreams(cat)
    pt = stats.phenomenon_interval(obs, ["datastream_key"], "phenomenon_ts").select("datastream_key", "phenomenonTime")
    ds = ds.join(pt, "datastream_key", "left")
    return EntityTables(entities.things(cat), entities.locations(cat), ds, entities.sensors(cat),
                        entities.observed_properties(cat), obs)


def counts(t: EntityTables, skip_observations: bool = False) -> DataFrame:
    return stats.collection_counts({
        "Things": t.things, "Locations": t.locations, "Datastreams": t.datastreams, "Sensors": t.sensors,
        "ObservedProperties": t.observed_properties,
        "Observations": None if skip_observations else t.observations})


def location_points(t: EntityTables) -> DataFrame:
    return stats.geojson_points(t.locations.select("location_id", F.to_json("location").alias("_g")),
                                "location_id", "_g")


def bbox(t: EntityTables) -> DataFrame:
    return stats.bbox(location_points(t))


def elevation(t: EntityTables) -> DataFrame:
    return stats.elevation_stats(location_points(t), "location_id")


def periods(t: EntityTables) -> DataFrame:
    return stats.period_stats(t.datastreams, "datastream_id", "phenomenonTime")


def per_datastream_counts(t: EntityTables) -> DataFrame:
    return stats.counts_per_datastream(t.datastreams.select("datastream_key", "datastream_id", "observed_property_id"),
                                       t.observations, "datastream_key", "datastream_key")


def observation_counts(t: EntityTables) -> DataFrame:
    return stats.count_stats(per_datastream_counts(t), "datastream_id")


def tallies(t: EntityTables) -> DataFrame:
    return stats.datastream_tallies(t.datastreams)


def observed_properties(t: EntityTables) -> DataFrame:
    return stats.observed_property_stats(t.observed_properties.select("observed_property_id", "name", "definition"),
                                         t.datastreams.select("datastream_id", "observed_property_id"),
                                         per_datastream_counts(t))
