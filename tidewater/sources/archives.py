"""Zip archives of observation files.

The archives are listed by Spark (path and length only). A task opens its
archives one after the other, streams the CSV entries record by record and
emits them in batches of ``BATCH`` rows: nothing is held but the open entry's
buffer, and nothing passes through the driver. Archives up to ``INLINE`` bytes
come as a ``binaryFile`` row; larger ones, which no row can hold, are opened as
seekable files through Arrow's file systems. Entry names that would escape the
extraction folder (``..`` parts, absolute paths) fail the job, as the reference
refuses them.
"""

from __future__ import annotations

import csv
import io
import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater._shipping import by_value

by_value(__name__)

from tidewater.operators.joins import bounded_broadcast
from tidewater.sources.csv_tables import choose_delimiter
from tidewater.sources.stores import file_system

BATCH = 10_000
INLINE = 256 << 20


def unsafe_entry(name: str) -> bool:
    parts = name.replace("\\", "/").split("/")
    return name.startswith("/") or any(p == ".." for p in parts) or (len(name) > 1 and name[1] == ":")


def entry_records(archive: str, stream, columns: list[str], want: str | None):
    """(entry, entry number, line, cells) of every record of the CSV entries."""
    with zipfile.ZipFile(stream) as z:
        names = sorted(n for n in z.namelist() if not n.endswith("/"))
        for n in names:
            if unsafe_entry(n):
                raise ValueError(f"archive entry escapes the target folder: {archive}!{n}")
        for number, n in enumerate(names):
            base = n.rsplit("/", 1)[-1].lower()
            if not base.endswith(".csv") or (want and want not in base):
                continue
            with io.TextIOWrapper(z.open(n), "utf-8-sig", newline="") as text:
                head = text.readline()
                if not head.strip():
                    continue
                sep = choose_delimiter(head)
                at = {c.strip(): i for i, c in enumerate(next(csv.reader([head], delimiter=sep)))}
                places = [at.get(c) for c in columns]
                for line, cells in enumerate(row for row in csv.reader(text, delimiter=sep) if row):
                    yield n, number, line, [cells[i] if i is not None and i < len(cells) else None for i in places]


def read_zip_csv(spark: SparkSession, path_glob: str, columns: list[str], name_contains: str | None = None,
                 damaged: bool = False) -> DataFrame:
    """Records of the CSV entries of every archive as text columns, plus
    ``_archive``, ``_entry``, ``_line`` and the arrival order ``_ord``: the
    struct (archive path, entry number, line), which sorts as it is.

    A damaged archive (cut short, bad checksum, not UTF-8) fails the job, or with
    ``damaged`` ends with a row whose ``_error`` says why (see
    ``read_whole_archives``)."""
    want = name_contains.lower() if name_contains else None

    def records(batches):
        import pyarrow as pa

        def batch(rows):
            cells = [pa.array([r[4][i] for r in rows], pa.string()) for i in range(len(columns))]
            return pa.RecordBatch.from_arrays(
                cells + [pa.array([r[k] for r in rows], t)
                         for k, t in ((0, pa.string()), (1, pa.string()), (2, pa.int64()), (3, pa.int64()), (5, pa.string()))],
                names=[*columns, "_archive", "_entry", "_number", "_line", "_error"])

        for given in batches:
            for path, content in zip(given.column(0).to_pylist(), given.column(1)):
                if content.is_valid:
                    stream = pa.BufferReader(content.as_buffer())
                else:
                    store, name = file_system(path)
                    stream = store.open_input_file(name)
                rows = []
                with stream:
                    try:
                        for record in entry_records(path, stream, columns, want):
                            rows.append((path, *record, None))
                            if len(rows) == BATCH:
                                yield batch(rows)
                                rows = []
                    except (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError) as e:
                        if not damaged:
                            raise
                        rows.append((path, None, None, None, [None] * len(columns), f"{type(e).__name__}: {e}"[:200]))
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path_glob)
    small = files.filter(F.col("length") <= INLINE).select("path", "content")
    large = files.filter(F.col("length") > INLINE).select("path", F.lit(None).cast("binary").alias("content"))
    texts = ", ".join(f"`{c}` string" for c in columns)
    out = small.unionByName(large).mapInArrow(records, f"{texts}, _archive string, _entry string, _number long, _line long, _error string")
    out = out if damaged else out.drop("_error")
    return out.withColumn("_ord", F.struct(F.col("_archive").alias("file"), F.col("_number").alias("split"),
                                           F.col("_line").alias("row"))).drop("_number")


def read_whole_archives(spark: SparkSession, path_glob: str, columns: list[str], name_contains: str | None = None
                        ) -> tuple[DataFrame, DataFrame]:
    """The records of the archives that can be read to their end, and
    (archive, reason) of the others, of which no record is kept. The archives are
    expanded once, to the shared checkpoint folder."""
    from tidewater.session import cut

    found = cut(read_zip_csv(spark, path_glob, columns, name_contains, damaged=True))
    rejects = cut(found.filter(F.col("_error").isNotNull()).select(F.col("_archive").alias("archive"), F.col("_error").alias("reason")))
    bad = bounded_broadcast(rejects.select(F.col("archive").alias("_archive")).distinct())
    return found.filter(F.col("_error").isNull()).join(bad, "_archive", "left_anti").drop("_error"), rejects
