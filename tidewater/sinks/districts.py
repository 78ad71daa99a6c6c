"""District files written by tasks: one CSV file (or zip archive) per district
and stretch of arrival, in the shape the folder source reads.

The writer varies what real folders vary: the delimiter, a byte-order mark,
names with spaces, quoted cells. Files hold a bounded stretch of arrival, carry
its number in their name and so sort in arrival order. Rows go to the opened
file or zip entry as they come. Each file is written under a private name and
moved when complete, so a repeated task is harmless.
"""

from __future__ import annotations

import contextlib
import csv
import io
import itertools
import operator
import uuid
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.sources.stores import file_system

by_value(__name__)

DELIMITERS = (";", ",", "\t")


def put_file(store, path: str, chunk: int, columns: list[str], rows, zipped: bool) -> int:
    """Write one file row by row; returns the number of rows."""
    folder, _ = path.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    attempt, n = f"{folder}/_{uuid.uuid4().hex}", 0
    with contextlib.ExitStack() as stack:
        out = stack.enter_context(store.open_output_stream(attempt))
        if zipped:
            archive = stack.enter_context(zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED))
            out = stack.enter_context(archive.open("osservazioni.csv", "w", force_zip64=True))
        if chunk % 2:
            out.write(b"\xef\xbb\xbf")
        text = stack.enter_context(io.TextIOWrapper(out, "utf-8", newline=""))
        table = csv.writer(text, delimiter=DELIMITERS[chunk % len(DELIMITERS)], lineterminator="\n")
        table.writerow(columns)
        for r in rows:
            table.writerow(r)
            n += 1
    store.move(attempt, path)
    return n


def cells(column):
    """The texts of an Arrow column (None for nulls); many times faster than ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False)


def write_district_files(raw: DataFrame, root: str, width: int, columns: list[str], zipped: bool = False) -> DataFrame:
    """Write ``raw`` below ``root`` in files of ``width`` arrival numbers per
    district; returns (file, n_rows) of every file. ``_ord`` must be a number."""
    d = raw.select(F.coalesce(columns[0], F.lit("UNKNOWN")).alias("_d"), F.floor(F.col("_ord") / width).alias("_c"), "_ord",
                   *columns)
    d = d.repartition("_d", "_c").sortWithinPartitions("_d", "_c", "_ord").drop("_ord")

    def run(batches):
        import pyarrow as pa

        store, base = file_system(root)
        rows = (r for b in batches for r in zip(zip(cells(b.column(0)), b.column(1).to_pylist()), zip(*map(cells, b.columns[2:]))))
        for (district, chunk), own in itertools.groupby(rows, operator.itemgetter(0)):
            name = f"osservazioni {chunk:09d}.{'zip' if zipped else 'csv'}"
            n = put_file(store, f"{base}/Distretto {district}/{name}", chunk, columns, map(operator.itemgetter(1), own), zipped)
            yield pa.RecordBatch.from_pydict({"file": [name], "n_rows": pa.array([n], pa.int64())})

    return d.mapInArrow(run, "file string, n_rows long")
