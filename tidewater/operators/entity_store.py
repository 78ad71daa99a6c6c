"""Entities in a versioned store.

Every kind is a table of a ``GenerationStore`` with a natural key; a step reads
one snapshot and publishes its tables together, so a job that stops half-way
leaves the store as it was.

Deletes over several tables write their plan first (the keys to delete, in the
generation that also lists the tables still to do) and then one table after the
other, in dependency order. A job that stops in between is taken up by
``resume``, which reads the plan and goes on with the next table; readers see in
the note of a snapshot which tables are still to come.

Observations may be kept in an ``ObservationTable`` beside the store: a cascade then
rewrites only the folders of the doomed datastreams. Such a delete may be repeated,
so a job that stops between it and the note does it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators import upsert
from tidewater.operators.cleanup import DELETE_ORDER, delete_by_id, update_by_id
from tidewater.operators.joins import bounded_broadcast
from tidewater.session import cut
from tidewater.sinks.generations import GenerationStore, Snapshot
from tidewater.sinks.tables import ObservationTable

# Natural key of every kind of entity.
KEYS = {
    "Workspaces": ["workspace"],
    "ProcessingLevels": ["workspace", "level_code"],
    "Things": ["thing_key"],
    "Locations": ["thing_key"],
    "Sensors": ["sensor_key"],
    "ObservedProperties": ["definition"],
    "Units": ["symbol"],
    "ResultQualifiers": ["workspace", "qualifier_code"],
    "Datastreams": ["datastream_key"],
    "Observations": ["datastream_key", "phenomenon_time"],
}
PLAN = "DeletePlan"
# Tables of a cascade in the order they are emptied.
CASCADE = ["Observations", "Datastreams", "Things", "Locations"]


class EntityStore:
    """``observations``: the table of Observations, if they are not one of the
    store's own."""

    def __init__(self, store: GenerationStore, observations: ObservationTable | None = None):
        self.store, self.observations = store, observations

    def read(self, kind: str, snapshot: Snapshot | None = None) -> DataFrame:
        if kind == "Observations" and self.observations is not None:
            return self.observations.read()
        return self.store.read(kind, snapshot)

    def _kinds(self, snapshot: Snapshot) -> set[str]:
        return set(snapshot.tables) | ({"Observations"} if self.observations is not None else set())

    def ensure(self, candidates: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Get or create. Candidates whose key is stored are left alone, the
        others are added with the number of this generation in ``created_in``;
        all kinds appear together. Returns what was created, by kind."""
        base = self.store.snapshot()
        created, changes = {}, {}
        for kind, rows in candidates.items():
            rows = rows.withColumn("created_in", F.lit(base.number + 1).cast("long"))
            if kind in base.tables:
                new, table = upsert.get_or_create(rows, self.read(kind, base), KEYS[kind])
            else:
                new = table = rows.dropDuplicates(KEYS[kind])
            created[kind] = cut(new)
            if kind not in base.tables or not created[kind].isEmpty():
                changes[kind] = created[kind] if kind not in base.tables else self.read(kind, base).unionByName(created[kind], allowMissingColumns=True)
        if changes:
            self.store.commit(changes, base)
        return created

    def refresh(self, new: dict[str, DataFrame]) -> Snapshot:
        """Forced refresh. Values of ``new`` replace stored ones, NULL keeps
        them, absent entities are inserted; all kinds change together."""
        base = self.store.snapshot()
        changes = {}
        for kind, rows in new.items():
            rows = rows.dropDuplicates(KEYS[kind])
            if kind in base.tables:
                merged = upsert.refresh(rows, self.read(kind, base), KEYS[kind]).drop("_origin")
            else:
                merged = rows
            changes[kind] = merged
        return self.store.commit(changes, base)

    def patch(self, kind: str, id_col: str, entity_id, changes: dict[str, Column]) -> Snapshot:
        """Change columns of one entity."""
        base = self.store.snapshot()
        return self.store.commit({kind: update_by_id(self.read(kind, base), id_col, entity_id, changes)}, base)

    def remove(self, kind: str, id_col: str, entity_id) -> Snapshot:
        """Delete one entity."""
        base = self.store.snapshot()
        return self.store.commit({kind: delete_by_id(self.read(kind, base), id_col, entity_id)}, base)

    # ------------------------------------------------------- deletes by plan
    def plan_cascade(self, property_name: str) -> Snapshot:
        """Store the plan to delete everything about the ObservedProperties of
        a name: their Datastreams with all Observations, and the Things that are
        left without Datastreams with their Locations."""
        base = self.store.snapshot()
        props = self.read("ObservedProperties", base).filter(F.col("name") == property_name).select("definition").distinct()
        series = self.read("Datastreams", base)
        doomed = cut(series.join(bounded_broadcast(props), "definition", "left_semi").select("datastream_key", "thing_key"))
        left = series.join(doomed.select("datastream_key"), "datastream_key", "left_anti")
        orphans = cut(doomed.select("thing_key").distinct().join(left.select("thing_key").distinct(), "thing_key", "left_anti"))
        keys = doomed.select("datastream_key").distinct()
        plan = None
        for kind, rows in (("Observations", keys), ("Datastreams", keys), ("Things", orphans), ("Locations", orphans)):
            part = rows.select(F.lit(kind).alias("entity"), F.col(rows.columns[0]).alias("key"))
            plan = part if plan is None else plan.unionByName(part)
        return self.store.commit({PLAN: plan}, base, note={"to_do": [k for k in CASCADE if k in self._kinds(base)]})

    def plan_clear(self) -> Snapshot:
        """Store the plan to empty all collections, dependent ones first."""
        base = self.store.snapshot()
        first = [k for k in DELETE_ORDER if k in self._kinds(base)]
        rest = [k for k in KEYS if k in base.tables and k not in first]
        return self.store.commit({}, base, note={"to_do": first + rest, "clear": True})

    def resume(self, steps: int | None = None) -> list[str]:
        """Carry on with a stored delete plan, one generation per table; returns
        the tables done. ``steps`` stops after so many (to hand over)."""
        done = []
        while steps is None or len(done) < steps:
            base = self.store.snapshot()
            to_do = base.note.get("to_do", [])
            if not to_do:
                break
            kind, rest = to_do[0], to_do[1:]
            apart = kind == "Observations" and self.observations is not None
            key = "datastream_key" if kind in ("Observations", "Datastreams") else "thing_key"
            changes = {}
            if base.note.get("clear"):
                if apart:
                    self.observations.clear()
                else:
                    changes[kind] = self.read(kind, base).limit(0)
            else:
                keys = self.read(PLAN, base).filter(F.col("entity") == kind).select(F.col("key").alias(key))
                if apart:
                    self.observations.delete(keys)
                else:
                    changes[kind] = self.read(kind, base).join(bounded_broadcast(keys), key, "left_anti")
            self.store.commit(changes, base, note={**base.note, "to_do": rest} if rest else {})
            done.append(kind)
        return done

    def cascade(self, property_name: str) -> list[str]:
        """X3 executed. A plan left by a stopped job is finished first."""
        done = self.resume()
        self.plan_cascade(property_name)
        return done + self.resume()

    def clear(self) -> list[str]:
        """X2 executed. A plan left by a stopped job is finished first."""
        done = self.resume()
        self.plan_clear()
        return done + self.resume()
