"""District CSV folders (S1-S9, S16, U1): lookup tables at the root, one
folder per district holding station, series and observation files.

* every cell is read as text (explicit all-string schema from the header),
  typed later (P7);
* the delimiter is sniffed from each file's header line (S8): ``;`` when it
  has more ``;`` than ``,``, else tab when present, else ``,``. The header is
  peeked on the driver through the Hadoop FileSystem API (a few KB per file,
  as Spark's own CSV header handling does); the data itself is read by one
  distributed ``read.csv`` per (delimiter, header) group and ``unionByName``;
* a UTF-8 byte-order mark is dropped (Spark's CSV reader does so for the
  data; the peeked header is cleaned here);
* a quoted cell may hold line breaks: files with a line of unpaired quotes are
  read as multi-line records, one task per file; all other files stay splittable;
* arrival order ``_ord`` is the struct (file path, split start, row id). It sorts
  as it is, nothing is packed into bits, and no number of files, splits or rows
  makes two rows equal. (file, split) is the bucket of the skew-safe ranks.
"""

from __future__ import annotations

import fnmatch
import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater._shipping import by_value

by_value(__name__)

log = logging.getLogger(__name__)

# File names of the lookup tables.
LOOKUP_FILES = {
    "compartments": "COMPARTIMENTO.csv",
    "flag_quality": "FLAG_QUALITY.csv",
    "general_metadata": "GENERAL_METADATA.csv",
    "quantities": "TIPO_GRANDEZZA.csv",
    "instruments": "TIPO_STRUMENTO.csv",
    "units": "UNITA_MISURA_UDM.csv",
    "organisations": "ENTE_COMPILATORE_rev.csv",
}
# Routing of district files by name (case-blind substring).
ROUTES = {"observations": "osservazioni", "series": "serie", "stations": "stazioni"}
# Folders the multi-file scan skips.
SKIP_DIRS = {"processed", "sta"}
SERIES_REQUIRED = ["COMPARTIMENTO", "ALIAS_STAZIONE", "ALIAS_BACINO", "GRANDEZZA"]
SERIES_OPTIONAL = ["TIPO_GRANDEZZA", "VERSION", "INTERPOLATION_TYPE", "AGGREGATION_PERIOD",
                   "INTENDED_TIME_SPACING", "INTENDED_TIME_SPACING_UNIT"]
BOM = "﻿"


def choose_delimiter(header: str) -> str:
    """``;`` if more ``;`` than ``,``; else tab if present; else ``,``."""
    if header.count(";") > header.count(","):
        return ";"
    if "\t" in header:
        return "\t"
    return ","


def split_header(header: str, sep: str) -> list[str]:
    """Column names of a header line (quotes removed, trimmed, BOM dropped)."""
    import csv

    h = header.lstrip(BOM).rstrip("\r\n")
    return [c.strip() for c in next(csv.reader([h], delimiter=sep))]


class _Fs:
    """Listing and header peeks through the Hadoop FileSystem API."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return bool(fs.exists(p))

    def qualified(self, path: str) -> str:
        """The path as listings give it, with its file system."""
        p, fs = self._fs(path)
        return fs.makeQualified(p).toString()

    def list(self, root: str) -> list[str]:
        """All files under ``root``, at any depth, sorted, skipping the
        ``processed`` and ``sta`` folders (S4, S5)."""
        out: list[str] = []
        p, fs = self._fs(root)
        todo = [p] if fs.exists(p) else []
        while todo:
            for st in fs.listStatus(todo.pop()):
                name = st.getPath().getName()
                if not st.isDirectory():
                    out.append(st.getPath().toString())
                elif name not in SKIP_DIRS:
                    todo.append(st.getPath())
        return sorted(set(out))


def inspect_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, header, goes_on, invalid) of every file with a line, in one
    distributed pass: its first line, whether some line has an odd number of
    quotes (so that a record goes on in the next line), and whether some line is
    not UTF-8. ``file`` is the path as listings give it, without its scheme."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_path"), F.struct(
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")).alias("_at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.groupBy("_path").agg(F.min_by("value", "_at").alias("header"),
                                       F.max(F.pmod(quotes, F.lit(2)) == 1).alias("goes_on"),
                                       F.max(~F.is_valid_utf8("value")).alias("invalid"))
    return found.select(plain_path("_path").alias("file"), "header", "goes_on", "invalid")


def plain_path(path: str):
    """A path that Spark reports, unescaped and without ``file:``."""
    decoded = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def sorted_out(spark: SparkSession, paths: list[str], required: list[str] | None = None) -> tuple[dict, list[tuple[str, str]]]:
    """The readable files by (delimiter, header, records over several
    lines), and (file, reason) of the others. Only what names a file and its
    shape reaches the driver, which needs both to plan the reads."""
    found = {r["file"]: r for r in inspect_files(spark, paths).toLocalIterator()} if paths else {}
    groups: dict[tuple[str, tuple[str, ...], bool], list[str]] = {}
    rejects = []
    for path in paths:
        seen = found.get(re.sub("^file:/+", "/", path))
        line = (seen["header"] if seen else "").lstrip(BOM)
        if not line.strip():
            rejects.append((path, "empty file"))
            continue
        if seen["invalid"]:
            rejects.append((path, "not UTF-8"))
            continue
        sep = choose_delimiter(line)
        cols = split_header(line, sep)
        if missing := [c for c in required or () if c not in cols]:
            rejects.append((path, "lacks columns " + ", ".join(missing)))
            continue
        groups.setdefault((sep, tuple(cols), seen["goes_on"]), []).append(path)
    for path, reason in rejects:
        log.warning("file skipped, %s: %s", reason, path)
    return groups, rejects


def read_text_table(spark: SparkSession, paths: list[str], required: list[str] | None = None,
                    with_order: bool = False, modified_after: str | None = None,
                    rejects: list | None = None) -> DataFrame | None:
    """All-string read of CSV files with per-file delimiter and header. Files
    without a line, with bytes that are not UTF-8 or without a required column are
    skipped with a warning (S9) and added to ``rejects`` as (file, reason);
    ``modified_after`` keeps only files changed after that time."""
    groups, bad = sorted_out(spark, paths, required)
    if rejects is not None:
        rejects += bad
    if not groups:
        return None
    frames = []
    for (sep, cols, multi_line), files in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        df = (spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", "UTF-8").option("escape", "\"")
              .option("mode", "PERMISSIVE").option("multiLine", multi_line))
        if modified_after:
            df = df.option("modifiedAfter", modified_after)
        df = df.csv(files)
        if with_order:
            df = df.withColumn("_ord", F.struct(F.col("_metadata.file_path").alias("file"),
                                                F.col("_metadata.file_block_start").alias("split"),
                                                F.monotonically_increasing_id().alias("row")))
        frames.append(df)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


class DistrictFolder:
    """Source with the same table methods as ``driver.DriverTables`` over a
    folder of district CSV files."""

    def __init__(self, spark: SparkSession, root: str, modified_after: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.modified_after = modified_after
        self._fs = _Fs(spark)
        self._files = self._fs.list(self.root)
        #: (file, reason) of the files that reads so far have skipped.
        self.rejects: list[tuple[str, str]] = []

    # Route district files by name
    def district_files(self, kind: str) -> list[str]:
        word = ROUTES[kind]
        out = []
        for f in self._files:
            name = f.rsplit("/", 1)[-1]
            parent = f[len(self._fs.qualified(self.root)):].strip("/").split("/")
            if len(parent) != 2:  # lookup tables live at the root, district files one folder below
                continue
            if word in name.lower() and name.lower().endswith(".csv"):
                out.append(f)
        return out

    def files_matching(self, pattern: str) -> list[str]:
        """Recursive glob on file names, sorted, de-duplicated."""
        return sorted({f for f in self._files if fnmatch.fnmatch(f.rsplit("/", 1)[-1], pattern)})

    def _lookup(self, key: str, optional: bool = False) -> DataFrame:
        path = f"{self.root}/{LOOKUP_FILES[key]}"
        hit = [f for f in self._files if f.endswith("/" + LOOKUP_FILES[key])]
        if not hit:
            if optional:
                return None
            raise FileNotFoundError(path)
        df = read_text_table(self.spark, hit[:1], with_order=True)
        if df is None or df.limit(1).count() == 0:   # S1: a lookup table without rows is an error
            raise ValueError(f"lookup table {path} has no rows")
        return df

    def general_metadata(self) -> DataFrame:
        return self._lookup("general_metadata").drop("_ord")

    def quantities(self) -> DataFrame:
        return self._lookup("quantities")

    def instruments(self) -> DataFrame:
        return self._lookup("instruments")

    def units(self) -> DataFrame:
        return self._lookup("units")

    def flag_quality(self) -> DataFrame:
        return self._lookup("flag_quality")

    def compartments(self) -> DataFrame:
        return self._lookup("compartments")

    def organisations(self) -> DataFrame:
        return self._lookup("organisations")

    def stations(self) -> DataFrame:
        df = read_text_table(self.spark, self.district_files("stations"), with_order=True)
        return df

    def _series_all(self) -> DataFrame:
        df = read_text_table(self.spark, self.district_files("series"), required=SERIES_REQUIRED, with_order=True,
                             rejects=self.rejects)
        if df is None:  # S16: absent optional file -> empty frame with the schema
            schema = T.StructType([T.StructField(c, T.StringType()) for c in SERIES_REQUIRED + SERIES_OPTIONAL])
            return self.spark.createDataFrame([], schema).withColumn("_ord", F.lit(0).cast("long"))
        for c in SERIES_OPTIONAL:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        return df

    def series(self) -> DataFrame:
        return self._series_all()

    def series_b(self) -> DataFrame:
        return self._series_all()

    def raw_observations(self) -> DataFrame:
        return read_text_table(self.spark, self.district_files("observations"), with_order=True,
                               modified_after=self.modified_after, rejects=self.rejects)
