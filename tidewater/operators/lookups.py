"""Lookup-table preparation.

Lookup tables are read as text and reduced to one row per key before they are
joined; the joins themselves are in ``plans``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import role_list
from tidewater.operators.dedup import last_wins

# The two spellings of the citation columns in the metadata file.
CITATION_SPELLINGS = {"Reference_Author": ["Reference_Author", "Referece_Author"],
                      "Reference_Title": ["Reference_Title", "Referece_Title"]}


class LookupTableError(ValueError):
    """A lookup table breaks a loader rule (blank key, no rows, blank value)."""


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Trimmed key parts; a blank part fails the job when the rows are read."""
    out = df
    for k in keys:
        out = out.withColumn(k, F.trim(F.col(k)))
    blank = None
    for k in keys:
        b = F.col(k).isNull() | (F.col(k) == "")
        blank = b if blank is None else blank | b
    # assert_true yields NULL when the check passes; as a filter predicate it
    # cannot be pruned away like an unused column would be
    return out.filter(F.assert_true(~blank, F.lit("blank key in lookup table")).isNull())


def key_rows(df: DataFrame, keys: list[str], strict: bool = True) -> DataFrame:
    """Key-checked rows. With ``strict=False`` rows with a blank key part are
    dropped instead of failing (the series file, whose blank-basin rows only
    path B uses)."""
    if strict:
        return require_keys(df, keys)
    t = df
    for k in keys:
        t = t.withColumn(k, F.trim(F.col(k)))
    return t.filter(" AND ".join(f"coalesce(`{k}`, '') <> ''" for k in keys))


def keyed_table(df: DataFrame, keys: list[str], order: str = "_ord", strict: bool = True) -> DataFrame:
    """S1 + W5: key-checked table, repeated key -> last row wins."""
    t = key_rows(df, keys, strict)
    if order in t.columns:
        return last_wins(t, keys, [order])
    return t.dropDuplicates(keys)


def general_metadata(meta: DataFrame) -> dict[str, str]:
    """S3: the single metadata row as a dict. Exactly one row; no blank header
    or value; either spelling of the citation columns is accepted. The row is
    configuration (13 short texts), read once on the driver."""
    rows = meta.limit(2).collect()
    if len(rows) != 1:
        raise LookupTableError(f"general metadata must have exactly one row, found {len(rows)}")
    d = {k.strip(): (v.strip() if isinstance(v, str) else v) for k, v in rows[0].asDict().items()}
    for canon, names in CITATION_SPELLINGS.items():
        for n in names:
            if d.get(n):
                d[canon] = d[n]
                break
    for k, v in d.items():
        if not k or v is None or v == "":
            raise LookupTableError(f"blank metadata field {k!r}")
    return d


def flag_descriptions(flags: DataFrame) -> DataFrame:
    """A2: per flag code, ``TIPO_VALORE: DESCRIZIONE`` of all its rows joined by
    ``; `` in sorted order (D6). Input made unique on (type, flag) first (S1)."""
    t = keyed_table(flags, ["TIPO_VALORE", "FLAG_VALORE"])
    return (t.groupBy("FLAG_VALORE")
            .agg(F.array_join(F.sort_array(F.collect_list(
                F.concat(F.col("TIPO_VALORE"), F.lit(": "), F.col("DESCRIZIONE_FLAG")))), "; ")
                 .alias("flag_label")))


def class_labels(instruments: DataFrame) -> DataFrame:
    """One class label per instrument class (smallest label, D6)."""
    return (instruments.groupBy("SIGLA_STRUMENTO")
            .agg(F.min("CATEGORIA_STRUMENTO").alias("class_label")))


def instrument_classes(instruments: DataFrame) -> DataFrame:
    """A4: distinct instrument classes."""
    return instruments.select("SIGLA_STRUMENTO").distinct()


def organisations(orgs: DataFrame) -> DataFrame:
    """Editor organisations keyed by code, with the general flag (P10) and the
    role array (F17); blank email -> NULL so JSON writers drop it."""
    t = keyed_table(orgs, ["SIGLA_ENTE_COMPILATORE"])
    return t.select(
        "SIGLA_ENTE_COMPILATORE", "NOME_ENTE_COMPILATORE", "RUOLO_ENTE_COMPILATORE",
        F.nullif(F.trim(F.col("EmailpuntoContatto")), F.lit("")).alias("email"),
        role_list("RUOLO_ENTE_COMPILATORE").alias("roles"),
        (F.upper(F.trim(F.col("GENERAL"))) == "Y").alias("is_general"))


def general_parties(orgs: DataFrame):
    """The array of general organisations as a scalar subquery column
    (evaluated once, attached to every row without a join)."""
    o = organisations(orgs).filter("is_general")
    party = F.struct(F.col("SIGLA_ENTE_COMPILATORE").alias("code"),
                     F.col("NOME_ENTE_COMPILATORE").alias("name"),
                     F.col("roles").alias("role"), F.col("email").alias("email"))
    return o.agg(F.sort_array(F.collect_list(party)).alias("parties")).scalar()
