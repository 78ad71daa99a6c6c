"""Named queries over stored tables: folders that change, entity stores, deletes
that survive a stop, batch records, resumed exports, replaced folders, run totals.

Each writes to a fresh scratch folder, goes through the change or the stop that it
is about, and returns what is then read back from storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.plans import mapping
from tidewater.plans.registry import _file_width, catalog, query
from tidewater.session import cut
from tidewater.sources.hadoop import Folders, list_files
from tidewater.streaming.incremental import scratch


# ------------------------------------------------ folders that change
def _numbered_files(spark, sf_dir):
    """The raw rows with the number of their district file, and the rows per file."""
    src = catalog(spark, sf_dir).source
    width = _file_width(src.table("events").agg(F.max("event_id")).first()[0] or 0)
    return src.raw_observations().withColumn("_c", F.floor(F.col("_ord") / width)), width


def _write_files(raw, root, width, which):
    from tidewater.sinks.districts import write_district_files
    from tidewater.sources.driver import OBSERVATION_COLUMNS
    return cut(write_district_files(raw.filter(F.pmod("_c", F.lit(4)).isin(which)), root, width, OBSERVATION_COLUMNS))


def _file_number(name: str):
    return F.regexp_extract(name, r"(\d+)\.csv$", 1).cast("long")


def _folder_load(spark, sf_dir, base):
    from tidewater.sources.csv_tables import read_text_table
    from tidewater.streaming.file_ledger import FILE, FolderLoad
    cat = catalog(spark, sf_dir)
    root = f"{base}/files"

    def load_files(paths):
        raw = read_text_table(spark, paths, with_order=True)
        named = mapping.map_observations(cat, raw)
        decoded = F.url_decode(F.replace(F.col("_ord.file"), F.lit("+"), F.lit("%2B")))
        return named.select("datastream_key", "phenomenon_time", "result", "flag", F.col("_ord.split").alias("file_split"),
                            F.col("_ord.row").alias("file_row"), F.regexp_extract(decoded, r"/files/(.*)$", 1).alias(FILE))

    schema = T.StructType.fromDDL("datastream_key string, phenomenon_time string, result double, flag string, "
                                  "file_split long, file_row long")
    return root, FolderLoad(spark, f"{base}/table", root, schema, load_files, ["datastream_key", "phenomenon_time"],
                            ["file_split", "file_row"], "*.csv")


def _after_changes(spark, sf_dir):
    """A folder loaded, then with a quarter of its files rewritten, a quarter
    removed and a quarter added, loaded again, and once more as it is."""
    base = scratch(spark, "changing")
    root, load = _folder_load(spark, sf_dir, base)
    raw, width = _numbered_files(spark, sf_dir)
    raw = cut(raw)
    runs = []
    _write_files(raw, root, width, [0, 1, 2])
    runs.append(cut(load.run()))
    _write_files(raw.withColumn("FLAG_VALORE", F.lit("Z99")), root, width, [1])
    for r in list_files(spark, root).filter(F.pmod(_file_number("name"), F.lit(4)) == 2).select("path").toLocalIterator():
        Folders(spark).delete(r[0])
    _write_files(raw, root, width, [3])
    runs.append(cut(load.run()))
    runs.append(cut(load.run()))
    return load, runs


@query
def changed_files(spark, sf_dir) -> DataFrame:
    """The observations of a folder whose files were rewritten, removed and
    added between two loads; only the changed files were read again."""
    load, _ = _after_changes(spark, sf_dir)
    return load.read().select("datastream_key", "phenomenon_time", F.round("result", 2).alias("result"), "flag")


@query
def changed_file_states(spark, sf_dir) -> DataFrame:
    """Files per run and state, and the rows stored by the loads (before
    and after compaction) against those that count."""
    from functools import reduce
    load, runs = _after_changes(spark, sf_dir)
    stored, live = load._stored().count(), load.live().count()
    load.compact()
    parts = [r.select(F.lit(i).alias("run"), "state", "n") for i, r in enumerate(runs, 1)]
    parts.append(spark.range(1).select(F.lit(3).alias("run"), F.lit("rows that count").alias("state"), F.lit(live).alias("n")))
    parts.append(spark.range(1).select(F.lit(3).alias("run"), F.lit("rows stored").alias("state"), F.lit(stored).alias("n")))
    parts.append(load._stored().agg(F.count(F.lit(1)).alias("n")).select(F.lit(4).alias("run"), F.lit("rows stored").alias("state"), "n"))
    return reduce(DataFrame.unionByName, parts)


@query
def stale_targets(spark, sf_dir) -> DataFrame:
    """District files against their prepared copies; only files without a
    copy or newer than their own copy are read. Files and rows read by reason."""
    from tidewater.sources.csv_tables import read_text_table
    from tidewater.streaming.file_ledger import stale_sources
    base = scratch(spark, "stale")
    raw, width = _numbered_files(spark, sf_dir)
    raw = cut(raw)
    _write_files(raw, f"{base}/sources", width, [0, 1, 2, 3])
    _write_files(raw, f"{base}/targets", width, [0, 1, 2])
    folders, noon = Folders(spark), 1_700_000_000_000
    for r in list_files(spark, f"{base}/sources").select("path").toLocalIterator():
        folders.touch(r[0], noon)
    late = {0: 3_600_000, 1: -3_600_000, 2: 0}           # fresh, stale and equally old copies
    for r in list_files(spark, f"{base}/targets").select("path", F.pmod(_file_number("name"), F.lit(4)).alias("k")).toLocalIterator():
        folders.touch(r[0], noon + late[r[1]])
    stale = cut(stale_sources(list_files(spark, f"{base}/sources"), list_files(spark, f"{base}/targets")))
    paths = [r[0] for r in stale.select("path").orderBy("path").toLocalIterator()]
    decoded = F.url_decode(F.replace(F.col("_ord.file"), F.lit("+"), F.lit("%2B")))
    name = F.regexp_extract(decoded, r"/sources/(.*)$", 1)
    rows = read_text_table(spark, paths, with_order=True).groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return (stale.join(rows, "name", "left").groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows")))


# ------------------------------------------- entities
def _kinds_seen(spark, sf_dir):
    """Entities of every kind as the mapped observations name them; ``old``:
    seen before the split."""
    from tidewater.plans.registry import SPLIT_EXISTING, _mapped
    cat = catalog(spark, sf_dir)
    d = cat.datastreams().select("datastream_key", "thing_key", F.col("COMPARTIMENTO").alias("workspace"),
                                 F.col("VERSION").alias("level_code"), F.col("SIGLA_STRUMENTO").alias("sensor_key"),
                                 F.col("TIPO_GRANDEZZA").alias("definition"), F.col("uom_symbol").alias("symbol"))
    g = _mapped(spark, sf_dir).select("datastream_key", F.col("flag").alias("qualifier_code"),
                                      (F.col("phenomenon_time") < SPLIT_EXISTING).alias("old"))
    return cut(g.groupBy("datastream_key", "qualifier_code").agg(F.max("old").alias("old")).join(d, "datastream_key"))


@query
def stored_get_or_create(spark, sf_dir) -> DataFrame:
    """Workspaces, processing levels, sites, sensors, properties, units,
    qualifiers and datastreams of two loads in a stored, versioned table each; a
    run between them dies before it publishes, a last run finds nothing new.
    Returns every stored entity with the generation that created it."""
    from functools import reduce

    from tidewater.operators.entity_store import KEYS, EntityStore
    from tidewater.sinks.generations import GenerationStore

    class Dying(GenerationStore):
        def _publish(self, new):
            raise InterruptedError("stopped before publishing")

    seen, root = _kinds_seen(spark, sf_dir), scratch(spark, "entities-stored")
    kinds = [k for k in KEYS if k not in ("Locations", "Observations")]
    rows = lambda df: {k: df.select(*KEYS[k]).distinct() for k in kinds}
    store = EntityStore(GenerationStore(spark, root))
    store.ensure(rows(seen.filter("old")))
    try:
        EntityStore(Dying(spark, root)).ensure(rows(seen))
    except InterruptedError:
        store.store.recover()
    store.ensure(rows(seen))
    store.ensure(rows(seen))
    return reduce(DataFrame.unionByName, [
        store.read(k).select(F.lit(k).alias("kind"), F.concat_ws("|", *KEYS[k]).alias("entity_key"), "created_in") for k in kinds])


def _numbered_entities(spark, sf_dir):
    """(key columns, id, name) per kind, with a number ``k`` to choose by."""
    from tidewater.plans import entities
    cat = catalog(spark, sf_dir)
    station = F.substring("ALIAS_STAZIONE", 10, 9).cast("int")
    things = entities.things(cat)
    series = entities.datastreams(cat)
    places = entities.locations(cat).join(things.select("thing_key", "ALIAS_STAZIONE"), "thing_key")
    sensors = entities.sensors(cat).join(series.select("datastream_id", "datastream_key", "ALIAS_STAZIONE"), "datastream_id")
    props = entities.observed_properties(cat)
    return {
        "Things": things.select("thing_key", F.col("thing_id").alias("iot_id"), "name", station.alias("k")),
        "Locations": places.select("thing_key", F.col("location_id").alias("iot_id"), "name", station.alias("k")),
        "Sensors": sensors.select(F.col("datastream_key").alias("sensor_key"), F.col("sensor_id").alias("iot_id"), "name", station.alias("k")),
        "ObservedProperties": props.select("definition", F.col("observed_property_id").alias("iot_id"), "name", F.length("definition").alias("k")),
        "Datastreams": series.select("datastream_key", F.col("datastream_id").alias("iot_id"), "name", station.alias("k")),
    }


@query
def stored_refresh(spark, sf_dir) -> DataFrame:
    """A forced refresh of Things, Locations, Sensors,
    ObservedProperties and Datastreams in storage (a NULL keeps the old value,
    absent ones are inserted), then one Thing renamed and one Datastream deleted
    by id; everything read back."""
    from functools import reduce

    from tidewater.operators.entity_store import KEYS, EntityStore
    from tidewater.sinks.generations import GenerationStore
    all_rows = {k: cut(df) for k, df in _numbered_entities(spark, sf_dir).items()}
    store = EntityStore(GenerationStore(spark, scratch(spark, "refresh")))
    store.refresh({k: df.filter("k % 3 <> 0").drop("k") for k, df in all_rows.items()})
    renewed = F.when(F.col("k") % 5 != 0, F.concat("name", F.lit(" (2)")))
    store.refresh({k: df.filter("k % 3 <> 1").withColumn("name", renewed).drop("k") for k, df in all_rows.items()})
    first = store.read("Things").agg(F.min("thing_key")).first()[0]
    last = store.read("Datastreams").agg(F.max("datastream_key")).first()[0]
    if first is not None:
        store.patch("Things", "thing_key", first, {"name": F.lit("Renamed station")})
    if last is not None:
        store.remove("Datastreams", "datastream_key", last)
    return reduce(DataFrame.unionByName, [
        store.read(k).select(F.lit(k).alias("kind"), F.col(KEYS[k][0]).alias("entity_key"), "iot_id", "name") for k in all_rows])


def _filled_store(spark, sf_dir, name):
    from tidewater.operators.entity_store import EntityStore
    from tidewater.plans import entities
    from tidewater.plans.registry import _mapped
    from tidewater.sinks.generations import GenerationStore
    from tidewater.sinks.tables import ObservationTable
    cat, base = catalog(spark, sf_dir), scratch(spark, name)
    obs = _mapped(spark, sf_dir).select("datastream_key", "phenomenon_time", "obs_id")
    table = ObservationTable(spark, f"{base}/observations", obs.schema, buckets=8)
    table.append(obs)
    store = EntityStore(GenerationStore(spark, f"{base}/entities"), table)
    store.store.commit({
        "ObservedProperties": entities.observed_properties(cat).select("definition", "name"),
        "Datastreams": entities.datastreams(cat).select("datastream_key", "thing_key", "definition"),
        "Things": entities.things(cat).select("thing_key", "name"),
        "Locations": entities.locations(cat).select("thing_key", "lon", "lat")})
    return store


@query
def executed_cascade(spark, sf_dir) -> DataFrame:
    """The cascade delete by ObservedProperty name carried out on stored
    tables; the job stops between two tables and another one resumes the stored
    plan. Survivors of all tables, read back."""
    from functools import reduce

    from tidewater.operators.entity_store import EntityStore
    from tidewater.plans.registry import PROPERTY_TO_DELETE
    store = _filled_store(spark, sf_dir, "cascade")
    store.plan_cascade(PROPERTY_TO_DELETE)
    store.resume(steps=2)
    again = EntityStore(store.store, store.observations)
    again.resume()
    keys = {"Observations": "datastream_key", "Datastreams": "datastream_key", "Things": "thing_key", "Locations": "thing_key",
            "ObservedProperties": "definition"}
    return reduce(DataFrame.unionByName, [
        again.read(k).groupBy(F.col(c).alias("entity_key")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(k).alias("kind"), "entity_key", "n") for k, c in keys.items()])


@query
def emptied_collections(spark, sf_dir) -> DataFrame:
    """All collections of a store emptied in dependency order, with a stop
    after the second; rows before, at the stop and after."""
    from functools import reduce
    store = _filled_store(spark, sf_dir, "emptied")
    kinds = ["Observations", "Datastreams", "ObservedProperties", "Locations", "Things"]
    counts = lambda: cut(reduce(DataFrame.unionByName, [
        store.read(k).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k in kinds]))
    seen = [("before", counts())]
    store.plan_clear()
    done = store.resume(steps=2)
    seen.append(("stop", counts()))
    done += store.resume()
    seen.append(("end", counts()))
    position = F.create_map(*[F.lit(x) for i, k in enumerate(done, 1) for x in (k, i)])[F.col("kind")]
    return reduce(DataFrame.unionByName, [df.select(position.alias("position"), "kind", F.lit(when).alias("at"), "n") for when, df in seen])


# --------------------------------------------------------- batch records (K9)
@query
def batch_records(spark, sf_dir) -> DataFrame:
    """K9: batches in three loads, one of them tried again (it adds nothing);
    then the files of one load are lost and those of another doubled. Every batch
    with the rows expected and visible, and what is wrong with it."""
    from tidewater.plans.registry import _batched
    from tidewater.sinks.batch_log import BatchLog
    b = cut(_batched(spark, sf_dir).select("obs_id", "datastream_key", "phenomenon_time", "batch_no"))
    log = BatchLog(spark, scratch(spark, "batch-log"), b.schema)
    loads = [cut(log.load(b.filter(F.pmod("batch_no", F.lit(3)) == k))) for k in (0, 1, 2)]
    again = log.load(b.filter(F.pmod("batch_no", F.lit(3)) == 1))
    if not again.isEmpty():
        raise AssertionError("a retried batch was stored again")
    folders = Folders(spark)
    of = lambda k: f"{log.root}/rows/load={(loads[k].select('load').first() or ['none'])[0]}"
    for name in folders.names(of(1)):
        if name.startswith("part-"):
            folders.delete(f"{of(1)}/{name}")
    copies = spark.read.schema(b.schema).parquet(of(2)) if folders.exists(of(2)) else b.limit(0)
    cut(copies).write.mode("append").parquet(of(2))
    v = log.verify()
    return v.select("datastream_key", "batch_no", "expected", "inserted", "status",
                    (F.size("missing_files") > 0).alias("file_missing"), (F.size("unknown_files") > 0).alias("file_unknown"))


# --------------------------------------------------- resumed exports (K4)
@query
def resumed_export(spark, sf_dir) -> DataFrame:
    """K4: an export stopped and resumed twice. The observations before the split
    are published; of the later ones first those of half the datastreams, then all
    that are missing. Batch documents and their requests, read back."""
    from tidewater.plans import entities
    from tidewater.plans.registry import RESUME_SPLIT, SHOWCASE_BATCH, _mapped_once
    from tidewater.sinks.publish import published_files, published_requests, resume_export
    cat = catalog(spark, sf_dir)
    g = _mapped_once(spark, sf_dir, F.col("obs_id").alias("iot_id"), "datastream_key", "datastream_id",
                     F.col("phenomenon_time").alias("phenomenonTime"), "result", "_ord")
    root, body = scratch(spark, "resumed"), {"iot_id": "bigint", "phenomenonTime": "string", "result": "double"}
    series = entities.datastreams(cat).select("datastream_key", "thing_key")
    half = F.pmod(F.length("datastream_key"), F.lit(2)) == 0
    for part in (F.col("phenomenonTime") < RESUME_SPLIT, (F.col("phenomenonTime") >= RESUME_SPLIT) & half, F.lit(True)):
        cut(resume_export(spark, root, g.filter(part), series, "phenomenonTime", body, "_ord", SHOWCASE_BATCH))
    listed = published_files(spark, root).select(
        F.regexp_extract("folder", r"([^/]+)/observations$", 1).alias("datastream_folder"), F.col("file").alias("file_name"))
    per_folder = published_requests(spark, root, "iot_id:bigint").groupBy(
        F.regexp_extract("folder", r"([^/]+)/observations$", 1).alias("datastream_folder")).agg(F.count(F.lit(1)).alias("n_requests"),
                                                                                                F.count_distinct("iot_id").alias("n_ids"))
    return (listed.groupBy("datastream_folder").agg(F.count(F.lit(1)).alias("n_files"), F.count_distinct("file_name").alias("n_names"),
                                                    F.max("file_name").alias("last_file"))
            .join(per_folder, "datastream_folder", "left"))


# ------------------------------------------------------ replaced files (K1)
@query
def replaced_files(spark, sf_dir) -> DataFrame:
    """K1: a folder of raw rows rewritten in sorted order in its own place, after
    attempts that stopped at every step; the rows seen by a reader at each stop,
    and the position of each row in its series in the end."""
    from tidewater.operators import sorting
    from tidewater.operators.ordered import rank_within
    from tidewater.sinks.files import current_folder, replace_folder, write_sorted
    from tidewater.sources.csv_tables import _Fs, read_text_table
    from tidewater.sources.driver import DriverTables
    cols = [*sorting.TEXT_KEYS, "ANNO", "MESE", "GIORNO", "ORA", "VALORE"]
    target = f"{scratch(spark, 'replaced')}/observations"
    raw = DriverTables(spark, sf_dir).raw_observations()
    write_sorted(raw.select(*cols, F.col("_ord").alias("ARRIVAL")).orderBy(F.desc("ARRIVAL")), target, sep=";")

    def rows():
        files = [f for f in _Fs(spark).list(current_folder(spark, target)) if f.endswith(".csv")]
        return read_text_table(spark, files, with_order=True)

    def rewrite(folder):
        write_sorted(sorting.sorted_observations(rows().drop("_ord").withColumn("_ord", F.col("ARRIVAL").cast("long"))), folder, sep=";")

    expected = raw.count()
    for stop in ("written", "intent", "moved", "placed", None):
        replace_folder(spark, target, rewrite, stop)
        if rows().count() != expected:
            raise AssertionError(f"a reader saw part of the rows after step {stop}")
    back = cut(rows().select(*cols, "_ord"))
    return (rank_within(back, sorting.TEXT_KEYS, "_ord", "position")
            .select(*[F.coalesce(c, F.lit("")).alias(c) for c in cols], "position"))


# ---------------------------------------------------- damaged files
def _damage(spark, root, glob, which, how):
    """Spoil the files whose number has a remainder in ``which``: ``cut`` keeps
    the first half, ``bytes`` appends a line that is not UTF-8."""
    from tidewater.sources.stores import file_system

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = file_system(path)
                with store.open_input_file(name) as f:
                    data = f.read()
                with store.open_output_stream(name) as f:
                    f.write(data[:len(data) // 2] if how == "cut" else data + b"\xff\xfe;x\n")
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["path"])

    number = F.regexp_extract("name", r"(\d+)\.[a-z]+$", 1).cast("long")
    files = list_files(spark, root, glob).filter(F.pmod(number, F.lit(4)).isin(which)).select("path")
    cut(files.mapInArrow(run, "path string"))


@query
def quarantined_files(spark, sf_dir) -> DataFrame:
    """District CSV files and archives of which some are spoilt (bytes that
    are not UTF-8, a column missing, cut short): files per state with its reason,
    and the rows that the readable ones give."""
    from tidewater.sinks.districts import write_district_files
    from tidewater.sources.archives import read_whole_archives
    from tidewater.sources.csv_tables import DistrictFolder, read_text_table
    from tidewater.sources.driver import OBSERVATION_COLUMNS
    base = scratch(spark, "damaged")
    raw, width = _numbered_files(spark, sf_dir)
    raw = cut(raw)
    of = lambda *k: raw.filter(F.pmod("_c", F.lit(4)).isin(*k))
    cut(write_district_files(of(0, 1, 2), f"{base}/csv", width, OBSERVATION_COLUMNS))
    cut(write_district_files(of(3), f"{base}/csv", width, [c for c in OBSERVATION_COLUMNS if c != "VALORE"]))
    cut(write_district_files(raw, f"{base}/zip", width, OBSERVATION_COLUMNS, zipped=True))
    _damage(spark, f"{base}/csv", "*.csv", [1], "bytes")
    _damage(spark, f"{base}/zip", "*.zip", [2, 3], "cut")
    rejects: list = []
    rows = read_text_table(spark, DistrictFolder(spark, f"{base}/csv").district_files("observations"), ["VALORE"], rejects=rejects)
    csv_bad = (spark.createDataFrame([(r,) for _, r in rejects], "reason string").groupBy("reason").agg(F.count(F.lit(1)).alias("n_files"))
               .select(F.lit("csv").alias("source"), "reason", "n_files", F.lit(0).cast("long").alias("n_rows")))
    good, zip_bad = read_whole_archives(spark, f"{base}/zip/*/", OBSERVATION_COLUMNS, "osservazioni")
    total = lambda df, source, n: df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(source).alias("source"), F.lit("readable").alias("reason"), F.lit(n).cast("long").alias("n_files"), "n_rows")
    n_csv = list_files(spark, f"{base}/csv", "*.csv").count() - len(rejects)
    n_zip = good.select("_archive").distinct().count()
    bad = zip_bad.groupBy(F.regexp_extract("reason", r"^(\w+)", 1).alias("reason")).agg(F.count(F.lit(1)).alias("n_files"))
    return (csv_bad.unionByName(total(rows, "csv", n_csv)).unionByName(total(good, "zip", n_zip))
            .unionByName(bad.select(F.lit("zip").alias("source"), "reason", "n_files", F.lit(0).cast("long").alias("n_rows"))))


# ------------------------------------------------------------ run totals
@query
def prepare_totals(spark, sf_dir) -> DataFrame:
    """Totals of a prepare-and-map run, counted by the passes that write:
    archives expanded and sorted into CSV files, the rows mapped into stored
    tables, the entities written. No pass counts anything a second time."""
    from tidewater.operators import sorting
    from tidewater.plans import entities
    from tidewater.plans.totals import RunTotals
    from tidewater.sinks.districts import write_district_files
    from tidewater.sources.archives import read_zip_csv
    from tidewater.sources.driver import OBSERVATION_COLUMNS
    cat, base = catalog(spark, sf_dir), scratch(spark, "totals")
    raw, width = _numbered_files(spark, sf_dir)
    cut(write_district_files(raw, f"{base}/raw", width, OBSERVATION_COLUMNS, zipped=True))
    totals = RunTotals()
    expanded = read_zip_csv(spark, f"{base}/raw/*/", OBSERVATION_COLUMNS, "osservazioni")
    ordered = sorting.sorted_observations(expanded)
    ordered = totals.watch(ordered, files_sorted=F.count(F.when(F.col("_line") == 0, 1)), rows_sorted=F.count(F.lit(1)))
    ordered.write.option("header", True).parquet(f"{base}/sorted")
    mapped = mapping.map_all(cat, spark.read.parquet(f"{base}/sorted"))
    mapped = totals.watch(mapped.select("datastream_key", "result", "reject_reason"),
                          observations_mapped=F.count(F.when(F.col("reject_reason").isNull(), 1)),
                          observations_rejected=F.count(F.when(F.col("reject_reason").isNotNull(), 1)))
    mapped.write.parquet(f"{base}/mapped")
    totals.watch(entities.things(cat), things=F.count(F.lit(1))).write.parquet(f"{base}/things")
    totals.watch(entities.datastreams(cat), datastreams=F.count(F.lit(1))).write.parquet(f"{base}/datastreams")
    return totals.frame(spark)


# ------------------------------------- records of the service load (path B)
@query
def service_sites(spark, sf_dir) -> DataFrame:
    """J11, J15 (path B): the site records of the load."""
    from tidewater.plans import service_entities as S
    from tidewater.plans.registry import _groups_b
    return S.sites(catalog(spark, sf_dir), _groups_b(spark, sf_dir))


@query
def service_datastreams(spark, sf_dir) -> DataFrame:
    """J12-J15 (path B): the datastream records of the load."""
    from tidewater.plans import service_entities as S
    from tidewater.plans.registry import _groups_b
    return S.datastreams(catalog(spark, sf_dir), cut(_groups_b(spark, sf_dir)), "Complete")


@query
def service_lookups(spark, sf_dir) -> DataFrame:
    """J15 (path B): processing level, sensors, observed properties, units and
    result qualifiers that the loaded rows use, stored by get-or-create and read
    back; and how many datastream records refer to each."""
    from functools import reduce

    from tidewater.plans import service_entities as S
    from tidewater.plans.registry import _groups_b
    from tidewater.sinks.generations import GenerationStore
    cat = catalog(spark, sf_dir)
    frames = {"ProcessingLevels": (S.processing_levels(cat), "level_code", "explanation", "level_code"),
              "Sensors": (S.sensors(cat), "method_code", "name", "method_code"),
              "ObservedProperties": (S.observed_properties(cat), "code", "name", "property_code"),
              "Units": (S.units(cat), "symbol", "name", "unit_symbol"),
              "ResultQualifiers": (S.result_qualifiers(cat), "code", "description", None)}
    store = GenerationStore(spark, scratch(spark, "service"))
    store.commit({k: f[0] for k, f in frames.items()})
    ds = cut(S.datastreams(cat, cut(_groups_b(spark, sf_dir)), "Complete"))
    out = []
    for kind, (_, key, label, ref) in frames.items():
        rows = store.read(kind).select(F.lit(kind).alias("kind"), F.col(key).alias("code"), F.col(label).alias("label"))
        if ref:
            used = ds.groupBy(F.col(ref).alias("code")).agg(F.count(F.lit(1)).alias("n_datastreams"))
            rows = rows.join(used, "code", "left").select("kind", "code", "label", F.coalesce("n_datastreams", F.lit(0).cast("long")).alias("n_datastreams"))
        else:
            rows = rows.withColumn("n_datastreams", F.lit(None).cast("long"))
        out.append(rows)
    return reduce(DataFrame.unionByName, out)


# --------------------------------------------------- found files
@query
def found_files(spark, sf_dir) -> DataFrame:
    """The files of a district folder found by name and by pattern at
    any depth, and the rows of a lookup file that is absent, then there."""
    from tidewater.sources.csv_tables import DistrictFolder
    from tidewater.sources.driver import OBSERVATION_COLUMNS
    base = scratch(spark, "found")
    raw, width = _numbered_files(spark, sf_dir)
    raw = cut(raw)
    _write_files(raw, base, width, [0, 1])
    _write_files(raw, f"{base}/deep/er", width, [2])
    _write_files(raw, f"{base}/processed", width, [3])       # a folder that scans skip
    before = DistrictFolder(spark, base)
    absent = before.series().count()
    series = catalog(spark, sf_dir).source.series()
    put = series.select("COMPARTIMENTO", "ALIAS_STAZIONE", "ALIAS_BACINO", "GRANDEZZA", "VERSION")
    put.repartition(3).write.option("header", True).option("sep", ";").csv(f"{base}/_tmp")
    for i, name in enumerate(n for n in Folders(spark).names(f"{base}/_tmp") if n.startswith("part-")):
        Folders(spark).rename(f"{base}/_tmp/{name}", f"{base}/Distretto A/Serie temporali {i}.csv")
    Folders(spark).delete(f"{base}/_tmp")
    after = DistrictFolder(spark, base)
    raw_columns = set(after.raw_observations().columns) - {"_ord"} == set(OBSERVATION_COLUMNS)
    return spark.createDataFrame([
        ("observation files one folder deep", len(after.district_files("observations"))),
        ("observation files by pattern", len(after.files_matching("osservazioni*.csv"))),
        ("files by an exact pattern", len(after.files_matching("osservazioni 000000002.csv"))),
        ("observation columns as written", int(raw_columns)),
        ("series rows without a file", absent),
        ("series rows", after.series().count())], "what string, n long")
