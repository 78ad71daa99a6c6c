"""Stored tables that change in one step.

    <root>/data/<table>/<generation>-<unique>/   parquet, never changed once written
    <root>/generations/<number>.json             which folder each table has, a note

A change writes new folders and then publishes a small generation file by rename.
Readers take the newest generation and stay on it: they see all tables before the
change or all after it. A job that dies before publishing leaves folders that no
generation names; ``recover`` removes them. One job writes at a time: a second one
that started from the same generation fails on publishing and can run again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.sources.hadoop import Folders


@dataclass(frozen=True)
class Snapshot:
    """One generation: number, folder and schema per table, and a note."""

    number: int
    tables: dict = field(default_factory=dict)
    note: dict = field(default_factory=dict)


class GenerationStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.folders = spark, root.rstrip("/"), Folders(spark)

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest generation (0: nothing stored), or a given one."""
        published = [int(n[:-5]) for n in self.folders.names(f"{self.root}/generations") if n[:-5].isdigit() and n.endswith(".json")]
        if number is None:
            number = max(published, default=0)
        if not number:
            return Snapshot(0)
        return Snapshot(number, **json.loads(self.folders.read_text(self._pointer(number))))

    def _pointer(self, number: int) -> str:
        return f"{self.root}/generations/{number:012d}.json"

    def read(self, table: str, snapshot: Snapshot | None = None) -> DataFrame:
        at = (snapshot or self.snapshot()).tables[table]
        return self.spark.read.schema(T.StructType.fromJson(at["schema"])).parquet(f"{self.root}/{at['folder']}")

    def commit(self, changes: dict[str, DataFrame], base: Snapshot | None = None, note: dict | None = None) -> Snapshot:
        """Store new contents of some tables as the generation after ``base`` (the
        newest); other tables stay as they are. The frames may read ``base``."""
        base = base or self.snapshot()
        tables = dict(base.tables)
        for name, rows in changes.items():
            folder = f"data/{name}/{base.number + 1:012d}-{uuid.uuid4().hex[:12]}"
            rows.write.parquet(f"{self.root}/{folder}")
            tables[name] = {"folder": folder, "schema": json.loads(rows.schema.json())}
        new = Snapshot(base.number + 1, tables, base.note if note is None else note)
        self._publish(new)
        return new

    def _publish(self, new: Snapshot) -> None:
        self.folders.write_text(self._pointer(new.number), json.dumps({"tables": new.tables, "note": new.note}))

    def recover(self) -> list[str]:
        """Remove what a job left that died before publishing; no other job may
        be writing. Returns the folders removed."""
        known = {t["folder"] for n in self.folders.names(f"{self.root}/generations") if n.endswith(".json")
                 for t in self.snapshot(int(n[:-5])).tables.values()}
        gone = []
        for table in self.folders.names(f"{self.root}/data"):
            for name in self.folders.names(f"{self.root}/data/{table}"):
                if f"data/{table}/{name}" not in known:
                    self.folders.delete(f"{self.root}/data/{table}/{name}")
                    gone.append(f"data/{table}/{name}")
        return gone
