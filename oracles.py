"""DuckDB oracle SQL for the registered queries.

The driver pre-registers the parquet tables as views; every oracle is one SQL
string built from the CTEs below. The fixed lookup rows are rendered from the
same Python lists the Spark side reads, so both engines see identical inputs.
"""

from __future__ import annotations

from tidewater.functions import ids
from tidewater.sources import driver as D


def _lit(v) -> str:
    if v is None:
        return "NULL::VARCHAR"
    return "'" + str(v).replace("'", "''") + "'"


def _values(name: str, cols: list[str], rows: list[tuple]) -> str:
    body = ",\n    ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"{name}({', '.join(cols)}) AS (VALUES\n    {body})"


def _dec_text(u: str, d: int, sep: str) -> str:
    den = 10 ** d
    return (f"concat(CASE WHEN ({u}) < 0 THEN '-' ELSE '' END, CAST(abs({u}) // {den} AS VARCHAR), '{sep}', "
            f"lpad(CAST(abs({u}) % {den} AS VARCHAR), {d}, '0'))")


META = dict(zip(D.METADATA_COLUMNS, D.METADATA_ROW))
ZONE = META["TimeZone"]

ELEV_TEXT = ("CASE WHEN c_custkey % 7 = 0 THEN '' ELSE "
             + _dec_text("CAST(round(c_acctbal * 100) AS BIGINT)", 2, ".") + " END")

BASE = [
    _values("quantity_t", D.QUANTITY_COLUMNS, D.QUANTITY_ROWS),
    _values("instrument_t", D.INSTRUMENT_COLUMNS, D.INSTRUMENT_ROWS),
    _values("unit_t", D.UNIT_COLUMNS, D.UNIT_ROWS),
    _values("flag_t", D.FLAG_COLUMNS, D.FLAG_ROWS),
    _values("segment_t", D.SEGMENT_COLUMNS, D.SEGMENT_ROWS),
    """sites AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey, r.r_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    """compartment_t AS (
  SELECT r_name AS COMPARTIMENTO, 'Distretto ' || r_name AS NOME_COMPARTIMENTO FROM region WHERE NOT contains(r_name, ' '))""",
    """org_t AS (
  SELECT 'ENTE' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS SIGLA_ENTE_COMPILATORE,
         'Ufficio ' || n_name AS NOME_ENTE_COMPILATORE,
         CASE n_regionkey WHEN 0 THEN 'editor,publisher' WHEN 1 THEN 'owner' WHEN 2 THEN 'editor, pointOfContact'
              WHEN 3 THEN 'publisher' ELSE 'custodian' END AS RUOLO_ENTE_COMPILATORE,
         CASE WHEN n_regionkey = 4 THEN '' ELSE lower(n_name) || '@example.org' END AS EmailpuntoContatto,
         CASE WHEN n_nationkey % 10 = 0 THEN 'Y' WHEN n_nationkey = 5 THEN 'y' ELSE 'N' END AS GENERAL
  FROM nation)""",
    f"""station_t AS (
  SELECT r_name AS COMPARTIMENTO, n_name AS ALIAS_BACINO, c_name AS ALIAS_STAZIONE,
         {_dec_text('6500 + (c_custkey % 1301) * 5', 3, ',')} AS X_LONG,
         {_dec_text('36600 + (c_custkey % 997) * 8', 3, ',')} AS Y_LAT,
         {ELEV_TEXT} AS Z_MSLM, c_custkey AS ord
  FROM sites)""",
    """stations AS (
  SELECT COMPARTIMENTO, ALIAS_BACINO, ALIAS_STAZIONE,
         TRY_CAST(replace(trim(X_LONG), ',', '.') AS DECIMAL(18,6)) AS lon,
         TRY_CAST(replace(trim(Y_LAT), ',', '.') AS DECIMAL(18,6)) AS lat,
         TRY_CAST(replace(trim(Z_MSLM), ',', '.') AS DECIMAL(18,6)) AS elevation
  FROM station_t)""",
    """series_t AS (
  SELECT s.r_name AS COMPARTIMENTO, s.c_name AS ALIAS_STAZIONE, s.n_name AS ALIAS_BACINO, q.TIPO_GRANDEZZA,
         g.GRANDEZZA, g.VERSION, g.INTERPOLATION_TYPE, g.AGGREGATION_PERIOD, g.INTENDED_TIME_SPACING,
         g.INTENDED_TIME_SPACING_UNIT
  FROM sites s JOIN segment_t g ON s.c_mktsegment = g.c_mktsegment JOIN quantity_t q ON q.GRANDEZZA = g.GRANDEZZA)""",
    """flag_label_t AS (
  SELECT FLAG_VALORE, string_agg(TIPO_VALORE || ': ' || DESCRIZIONE_FLAG, '; ' ORDER BY TIPO_VALORE || ': ' || DESCRIZIONE_FLAG) AS flag_label
  FROM flag_t GROUP BY FLAG_VALORE)""",
    """class_label_t AS (
  SELECT SIGLA_STRUMENTO, min(CATEGORIA_STRUMENTO) AS class_label FROM instrument_t GROUP BY SIGLA_STRUMENTO)""",
    """ds AS (
  SELECT st.COMPARTIMENTO, st.ALIAS_BACINO, st.ALIAS_STAZIONE, se.GRANDEZZA, se.VERSION, q.SIGLA_STRUMENTO,
         q.TIPO_GRANDEZZA, q.SAMPLE_MEDIUM, q.INTERPOLATION_TYPE, q.AGGREGATION_PERIOD, q.DESCRIZIONE_GRANDEZZA,
         u.UDM AS uom_symbol, u.DESCRIZIONE_UDM AS uom_name, cl.class_label, st.lon, st.lat, st.elevation,
         concat_ws('-', st.COMPARTIMENTO, st.ALIAS_BACINO, st.ALIAS_STAZIONE) AS thing_key,
         concat_ws('-', st.COMPARTIMENTO, st.ALIAS_BACINO, st.ALIAS_STAZIONE, se.GRANDEZZA) AS datastream_key
  FROM stations st
  JOIN series_t se ON se.COMPARTIMENTO = st.COMPARTIMENTO AND se.ALIAS_BACINO = st.ALIAS_BACINO AND se.ALIAS_STAZIONE = st.ALIAS_STAZIONE
  JOIN quantity_t q ON q.GRANDEZZA = se.GRANDEZZA
  JOIN unit_t u ON u.SIGLA_STRUMENTO = q.SIGLA_STRUMENTO
  LEFT JOIN class_label_t cl ON cl.SIGLA_STRUMENTO = q.SIGLA_STRUMENTO)""",
    f"""ds_ids AS (
  SELECT *, {ids.duck_entity_id('thing_key', ids.THING_OFFSET)} AS thing_id,
         {ids.duck_entity_id('thing_key', ids.LOCATION_OFFSET)} AS location_id,
         {ids.duck_entity_id('datastream_key', ids.DATASTREAM_OFFSET)} AS datastream_id,
         {ids.duck_entity_id('datastream_key', ids.SENSOR_OFFSET)} AS sensor_id,
         {ids.duck_entity_id('TIPO_GRANDEZZA', ids.OBSERVED_PROPERTY_OFFSET)} AS observed_property_id
  FROM ds)""",
    f"""raw_obs AS (
  SELECT s.r_name AS COMPARTIMENTO, s.n_name AS ALIAS_BACINO, s.c_name AS ALIAS_STAZIONE, e.event_type AS GRANDEZZA,
         CASE WHEN e.k % 2 = 0 THEN 'I' ELSE 'II' END AS PARTE_ANNALE,
         CAST(e.k % 40 + 10 AS VARCHAR) AS PAGINA, CAST(e.k % 12 + 1 AS VARCHAR) AS TABELLA_ORDINE,
         s.c_name AS NOME_STAZIONE_ANNALE, s.n_name AS NOME_BACINO_ANNALE,
         CASE WHEN e.event_type IN ('view', 'click') THEN (CASE WHEN e.k % 2 = 0 THEN 'PLV' ELSE 'PLG' END)
              WHEN e.event_type IN ('purchase', 'signup') THEN (CASE WHEN e.k % 2 = 0 THEN 'TMM' ELSE 'TMG' END)
              ELSE 'IDR' END AS TIPO_STRUMENTO_ANNALE,
         {ELEV_TEXT.replace('c_custkey', 's.c_custkey').replace('c_acctbal', 's.c_acctbal')} AS QUOTA_STRUMENTO_ANNALE,
         CAST(year(e.ts) AS VARCHAR) AS ANNO,
         CASE WHEN e.event_id % 97 = 0 THEN '02' ELSE lpad(CAST(month(e.ts) AS VARCHAR), 2, '0') END AS MESE,
         CASE WHEN e.event_id % 97 = 0 THEN '30' ELSE lpad(CAST(day(e.ts) AS VARCHAR), 2, '0') END AS GIORNO,
         CASE WHEN e.event_id % 97 = 1 THEN '24:00' WHEN e.event_id % 97 = 4 THEN strftime(e.ts, '%H%M')
              ELSE strftime(e.ts, '%H:%M') END AS ORA,
         CASE WHEN e.event_id % 97 = 2 THEN replace(printf('%.2f', e.value), '.', ',')
              WHEN e.event_id % 97 = 3 THEN '' ELSE printf('%.2f', e.value) END AS VALORE,
         upper(substr(e.event_type, 1, 1)) || '0' || CAST(e.k % 6 AS VARCHAR) AS FLAG_VALORE,
         'ENTE' || lpad(CAST(e.k % 30 AS VARCHAR), 2, '0') AS SIGLA_ENTE_COMPILATORE,
         CASE WHEN e.k % 7 = 0 THEN '' ELSE 'Editor ' || CAST(e.k % 7 AS VARCHAR) END AS NOME_COMPILATORE,
         e.event_id AS ord, e.ts AS src_ts, e.value AS src_value, e.user_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
  LEFT JOIN sites s ON s.c_custkey = e.user_id)""",
    """typed_obs AS (
  SELECT *,
         CASE WHEN v_s IS NULL OR v_s = '' OR upper(v_s) = 'NA' THEN NULL
              WHEN length(v_s) - length(replace(v_s, ',', '')) = 1 THEN TRY_CAST(replace(replace(v_s, '.', ''), ',', '.') AS DOUBLE)
              ELSE TRY_CAST(replace(v_s, ',', '.') AS DOUBLE) END AS result
  FROM (SELECT *, TRY_CAST(trim(ANNO) AS INTEGER) AS year, TRY_CAST(trim(MESE) AS INTEGER) AS month,
               TRY_CAST(trim(GIORNO) AS INTEGER) AS day,
               CASE WHEN instr(ORA, ':') > 0 THEN TRY_CAST(split_part(ORA, ':', 1) AS INTEGER) END AS hour,
               CASE WHEN instr(ORA, ':') > 0 THEN TRY_CAST(split_part(ORA, ':', 2) AS INTEGER) END AS minute,
               replace(trim(VALORE), chr(160), '') AS v_s
        FROM raw_obs))""",
    f"""mapped_all AS (
  SELECT o.*, d.datastream_key, d.datastream_id, f.flag_label AS flag_label0, c.NOME_COMPARTIMENTO AS district,
         g.NOME_ENTE_COMPILATORE AS editor_organization, g.RUOLO_ENTE_COMPILATORE AS editor_role,
         CASE WHEN o.ALIAS_STAZIONE IS NULL THEN 'unknown_station' WHEN d.datastream_key IS NULL THEN 'unknown_series'
              WHEN o.year IS NULL OR o.month IS NULL OR o.day IS NULL THEN 'bad_date_part'
              WHEN o.hour IS NULL OR o.minute IS NULL THEN 'bad_hour'
              WHEN o.result IS NULL THEN 'bad_value'
              WHEN o.local_ts IS NULL THEN 'invalid_datetime'
              WHEN c.NOME_COMPARTIMENTO IS NULL THEN 'unknown_compartment'
              WHEN g.NOME_ENTE_COMPILATORE IS NULL THEN 'unknown_organisation' END AS reject_reason,
         timezone('UTC', timezone('{ZONE}', o.local_ts)) AS phenomenon_ts
  FROM (SELECT *, CASE WHEN year BETWEEN 1 AND 9999 AND month BETWEEN 1 AND 12 AND day >= 1
                        AND day <= day(last_day(make_date(year, month, 1)))
                        AND hour BETWEEN 0 AND 23 AND minute BETWEEN 0 AND 59
                       THEN make_timestamp(year, month, day, hour, minute, 0) END AS local_ts
        FROM typed_obs) o
  LEFT JOIN ds_ids d ON d.COMPARTIMENTO = o.COMPARTIMENTO AND d.ALIAS_BACINO = o.ALIAS_BACINO
        AND d.ALIAS_STAZIONE = o.ALIAS_STAZIONE AND d.GRANDEZZA = o.GRANDEZZA
  LEFT JOIN flag_label_t f ON f.FLAG_VALORE = o.FLAG_VALORE
  LEFT JOIN compartment_t c ON c.COMPARTIMENTO = o.COMPARTIMENTO
  LEFT JOIN org_t g ON g.SIGLA_ENTE_COMPILATORE = o.SIGLA_ENTE_COMPILATORE)""",
    f"""obs AS (
  SELECT *, {ids.duck_observation_id('datastream_key', 'phenomenon_time')} AS obs_id
  FROM (SELECT *, strftime(phenomenon_ts, '%Y-%m-%dT%H:%M:%SZ') AS phenomenon_time,
               coalesce(flag_label0, FLAG_VALORE) AS flag_label,
               '{META['Reference_Author']}. {META['Reference_Title']}. Compartimento di ' || district || '. Anno ' ||
               CAST(year AS VARCHAR) || '. Parte ' || PARTE_ANNALE || '. Pagina ' || PAGINA ||
               '. Posizione nella Pagina ' || TABELLA_ORDINE || '. Disponibile online: {META['DataSource']}' AS citation
        FROM mapped_all WHERE reject_reason IS NULL))""",
]


BASE += [
    """series_b AS (
  SELECT CASE WHEN s.c_mktsegment = 'FURNITURE' THEN lower(s.r_name) ELSE s.r_name END AS COMPARTIMENTO,
         s.c_name AS ALIAS_STAZIONE, CASE WHEN s.c_mktsegment = 'BUILDING' THEN '' ELSE s.n_name END AS ALIAS_BACINO,
         q.TIPO_GRANDEZZA, g.GRANDEZZA, g.VERSION, g.INTERPOLATION_TYPE, g.AGGREGATION_PERIOD, g.INTENDED_TIME_SPACING,
         g.INTENDED_TIME_SPACING_UNIT
  FROM sites s JOIN segment_t g ON s.c_mktsegment = g.c_mktsegment JOIN quantity_t q ON q.GRANDEZZA = g.GRANDEZZA)""",
    f"""timed_b AS (
  SELECT *, timezone('UTC', timezone('{ZONE}', local_ts)) AS phenomenon_ts
  FROM (SELECT *, CASE WHEN year BETWEEN 1 AND 9999 AND month BETWEEN 1 AND 12 AND day >= 1
                        AND day <= day(last_day(make_date(year, month, 1)))
                        AND hour BETWEEN 0 AND 23 AND minute BETWEEN 0 AND 59
                       THEN make_timestamp(year, month, day, hour, minute, 0) END AS local_ts
        FROM typed_obs)
  WHERE local_ts IS NOT NULL)""",
]


def with_base(select_sql: str) -> str:
    return "WITH " + ",\n".join(BASE) + "\n" + select_sql
