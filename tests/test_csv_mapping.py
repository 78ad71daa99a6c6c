"""The CSV folder source and the observation mapping on the FIXTURES.md
edge cases."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import write_fixture
from tidewater.plans import entities, loader, mapping
from tidewater.plans.catalog import Catalog
from tidewater.sources.csv_tables import DistrictFolder, choose_delimiter, split_header


@pytest.fixture(scope="module")
def cat(spark, tmp_path_factory):
    root = write_fixture(str(tmp_path_factory.mktemp("district")))
    return Catalog(DistrictFolder(spark, root))


def test_delimiter_rule():
    assert choose_delimiter("a;b;c,d") == ";"
    assert choose_delimiter("a\tb") == "\t"
    assert choose_delimiter("a,b;c") == ","
    assert split_header("﻿A;\"B\";C\r\n", ";") == ["A", "B", "C"]


def test_routing_and_skips(cat):
    src = cat.source
    assert [f.rsplit("/", 1)[-1] for f in src.district_files("observations")] == ["OSSERVAZIONI_BA.csv",
                                                                                 "OSSERVAZIONI_BO.csv"]
    assert len(src.files_matching("SERIE*.csv")) == 2


def test_metadata_old_spelling(cat):
    assert cat.meta["Reference_Author"] == "Servizio" and cat.time_zone == "Europe/Rome"


def test_stations_last_wins(cat):
    st = {r.ALIAS_STAZIONE: r for r in cat.stations().collect()}
    assert float(st["CANOSA"].lon) == 16.0667 and float(st["CANOSA"].elevation) == 105.5
    assert float(st["ASCOLI (S.) - D'ORO"].elevation) == -3 and st["SENZA SERIE"].elevation is None


def test_series_file_without_required_column_is_skipped(cat):
    assert cat.source.series().count() == 4


def test_mapping_reasons(cat):
    m = mapping.map_all(cat)
    got = {r.TABELLA_ORDINE: r.reject_reason for r in m.collect()}
    assert got["r01"] is None and got["r06"] is None and got["r07"] is None and got["r08"] is None
    assert got["r02"] == "invalid_datetime" and got["r03"] == "invalid_datetime"
    assert got["r04"] == "bad_hour" and got["r05"] == "bad_date_part"
    assert got["r09"] == "bad_value" and got["r10"] == "bad_value"
    assert got["r11"] == "unknown_organisation" and got["r12"] == "unknown_series"
    assert got["r18"] == "unknown_series"


def test_mapped_values(cat):
    g = {r.citation.split("Posizione nella Pagina ")[1].split(".")[0]: r for r in mapping.map_observations(cat).collect()}
    assert g["r01"].phenomenon_time == "1930-01-01T08:00:00Z" and g["r01"].result == 12.5
    assert g["r06"].result == -9999.0          # no-data sentinel kept (D9)
    assert g["r07"].result == 12.5 and g["r08"].result == 1234.5
    assert g["r08"].flag_label == "XX9"         # unknown flag keeps its code (J2)
    assert g["r01"].flag_label == ('Giornaliero: Valore validato; Massimo: Valore validato ripetuto; '
                                   'Media; oraria: Valore "orario"')
    assert g["r13"].flag_label == "Giornaliero: Valore corretto"   # literal P*_EC (D22)
    assert g["r13"].obs_id == g["r01"].obs_id   # same series and time -> same id (D5)
    assert g["r14"].phenomenon_time == "1890-06-01T08:10:04Z"
    assert g["r15"].phenomenon_time == "2021-03-28T01:30:00Z"
    assert g["r01"].citation.startswith("Servizio. Annali. Compartimento di Bari. Anno 1930. Parte I. Pagina 1.")
    assert g["r01"].editor_role == "editor, publisher"


def test_entities(cat):
    things = {r.name: r for r in entities.things(cat).collect()}
    assert set(things) == {"CANOSA", "ASCOLI (S.) - D'ORO", "SENZA SERIE"}   # D4
    parties = things["CANOSA"].properties.responsibleParties
    assert [p.code for p in parties] == ["UIBA", "UIBO"] and parties[1].email is None
    assert parties[0].role == ["editor", "publisher"]
    ds = {r.datastream_key: r for r in entities.datastreams(cat).collect()}
    assert set(ds) == {"BA-OFANTO-CANOSA-PIOGGIA", "BA-OFANTO-CANOSA-TEMP_MEDIA"}   # LIVELLO has no unit
    assert ds["BA-OFANTO-CANOSA-PIOGGIA"].unitOfMeasurement.symbol == "mm"
    locs = {r.name: r.location.coordinates for r in entities.locations(cat).collect()}
    assert locs["SENZA SERIE"] == [15.0, 41.5] and locs["CANOSA"] == [16.0667, 41.2214, 105.5]
    ops = entities.observed_properties(cat).collect()
    assert len(ops) == 3 and {o.name for o in ops} >= {"Amount of precipitation"}


def test_path_b_series_defaults(cat):
    t = loader.timed(cat)
    groups = t.select(*loader.GROUP_KEYS).distinct()
    d = {r.ALIAS_STAZIONE + "/" + r.GRANDEZZA: r for r in
         loader.series_defaults(groups, cat.source.series_b(), cat.source.quantities()).collect()}
    a = d["ASCOLI (S.) - D'ORO/PIOGGIA"]          # blank-basin, lower-case row as fallback
    assert a.has_series_entry and (a.time_aggregation_interval, a.time_aggregation_interval_unit) == (2, "days")
    c = d["CANOSA/TEMP_MEDIA"]
    assert (c.intended_time_spacing, c.intended_time_spacing_unit, c.aggregation_statistic) == (12, "hours", "Average")
    p = d["CANOSA/PIOGGIA"]
    assert (p.time_aggregation_interval, p.time_aggregation_interval_unit, p.sampled_medium) == (1, "days", "Air")


def test_path_b_load_dedup(cat):
    o = loader.load_observations(cat)
    canosa = o.filter(F.col("datastream_key") == "BA-OFANTO-CANOSA-PIOGGIA")
    times = [r.phenomenon_ts for r in canosa.collect()]
    assert len(times) == len(set(times))
    first = canosa.filter(F.col("phenomenon_ts") == "1930-01-01 08:00:00").first()
    assert first.result == 12.5 and first.result_qualifier_codes == ["P00"]   # first wins (W1)


def test_site_tags(cat):
    tags = loader.organisation_tags(cat.source.raw_observations(), cat.source.organisations())
    v = {(r.ALIAS_STAZIONE, r.tag): r.value for r in tags.collect()}
    canosa = [x for (st, _), x in sorted(v.items()) if st == "CANOSA"]
    assert "name: Ufficio Idrografico di Bari, email: uiba@example.org, role: editor, role:  publisher" in canosa
    assert "name: Ufficio di Forlì, individual: Neri, role: owner" in canosa
    assert v[("CANOSA", "organization_1")] == "name: NOPE"     # unknown organisation: its code


def test_lookup_rules(spark, tmp_path):
    from tidewater.operators import lookups
    (tmp_path / "UNITA_MISURA_UDM.csv").write_text("SIGLA_STRUMENTO,UDM,DESCRIZIONE_UDM\n", encoding="utf-8")
    src = DistrictFolder(spark, str(tmp_path))
    with pytest.raises(ValueError):
        src.units()
    blank = spark.createDataFrame([(" ", "x")], "k string, v string")
    with pytest.raises(Exception):
        lookups.keyed_table(blank, ["k"]).collect()
    two = spark.createDataFrame([("a", "b")] * 2, "TerritoryName string, TimeZone string")
    with pytest.raises(lookups.LookupTableError):
        lookups.general_metadata(two)


def test_folder_reader_keeps_every_record_and_its_order(spark, tmp_path):
    """Spaces in paths, quoted line breaks, deep files and equal positions in
    several files: nothing is lost and arrival order is total."""
    from tidewater.sources.csv_tables import read_text_table
    d = tmp_path / "Distretto di Prova"
    (d / "a" / "b" / "c").mkdir(parents=True)
    (d / "osservazioni 1.csv").write_text('A;B\n1;"two\nlines"\n2;x\n')
    (d / "osservazioni 2.csv").write_text('A;B\n3;"say ""hi"""\n4;y\n')
    (d / "a" / "b" / "c" / "osservazioni 3.csv").write_text("A;B\n5;z\n")
    src = DistrictFolder(spark, str(tmp_path))
    assert len(src.files_matching("osservazioni*.csv")) == 3
    got = src.raw_observations().orderBy("_ord")
    assert [(r.A, r.B) for r in got.select("A", "B").collect()] == [("1", "two\nlines"), ("2", "x"), ("3", 'say "hi"'), ("4", "y")]
    everything = read_text_table(spark, src.files_matching("osservazioni*.csv"), with_order=True)
    assert everything.select("_ord").distinct().count() == 5
