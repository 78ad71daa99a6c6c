"""Scalar text expressions.

Every builder returns a ``Column`` made of built-in functions only, so the
expressions stay inside whole-stage codegen on the fact path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quantity URIs with a known human label (F16).
KNOWN_QUANTITY_LABELS = {
    "http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/210": "Amount of precipitation",
    "http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/224":
        "Air temperature (at specified distance from reference surface)",
}

# Characters that may not appear in a folder name.
PATH_UNSAFE_CLASS = r'[:/\\<>"|?*]'

MISSING = "(missing)"
EMPTY = "(empty)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decimal_comma_strict(x, precision: int = 18, scale: int = 6) -> Column:
    """every ``,`` becomes ``.``, then a decimal; bad text -> NULL."""
    return F.expr(f"try_cast(replace(trim({_sql(x)}), ',', '.') as decimal({precision},{scale}))")


def decimal_comma_lenient(x) -> Column:
    """trim, drop no-break spaces; blank or ``NA`` -> NULL; with exactly one
    comma the dots are thousands separators; otherwise all commas become dots;
    unparseable -> NULL."""
    s = F.replace(F.trim(_c(x)), F.lit("\u00a0"), F.lit(""))
    n_commas = F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
    one_comma = F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    many = F.replace(s, F.lit(","), F.lit("."))
    txt = F.when(n_commas == 1, one_comma).otherwise(many)
    return (F.when(s.isNull() | (s == "") | (F.upper(s) == "NA"), F.lit(None).cast("double"))
            .otherwise(txt.try_cast("double")))


def key_text(*parts) -> Column:
    """entity key ``a-b-c``; NULL parts are written as ``null`` (as string
    concatenation does) instead of being skipped by ``concat_ws``."""
    return F.concat_ws("-", *[F.coalesce(_c(p).cast("string"), F.lit("null")) for p in parts])


def norm_key_part(x) -> Column:
    """trim, blank or ``nan`` -> '', upper case."""
    t = F.trim(_c(x).cast("string"))
    return F.when(t.isNull() | (t == "") | (F.lower(t) == "nan"), F.lit("")).otherwise(F.upper(t))


def optional_text(x) -> Column:
    """trimmed text, blank -> NULL."""
    return F.nullif(F.trim(_c(x).cast("string")), F.lit(""))


def citation(author, title, district_name, year, part, page, position, source) -> Column:
    """reference citation of one observation."""
    return F.concat(
        _c(author), F.lit(". "), _c(title), F.lit(". Compartimento di "), _c(district_name),
        F.lit(". Anno "), _c(year).cast("string"), F.lit(". Parte "), _c(part),
        F.lit(". Pagina "), _c(page), F.lit(". Posizione nella Pagina "), _c(position),
        F.lit(". Disponibile online: "), _c(source))


def site_description(compartment, basin, station) -> Column:
    """Thing / Location description."""
    return F.concat(F.lit("Compartimento: "), _c(compartment), F.lit(", bacino: "), _c(basin),
                    F.lit(", stazione: "), _c(station))


def series_name(station, quantity_text, max_len: int | None = None) -> Column:
    """datastream name ``station - quantity text``; path B cuts it."""
    n = F.concat(_c(station), F.lit(" - "), _c(quantity_text))
    return F.substring(n, 1, max_len) if max_len else n


def quantity_label(uri) -> Column:
    """F16: label of a quantity URI; unknown URIs label themselves."""
    out = _c(uri)
    expr = None
    for k, v in KNOWN_QUANTITY_LABELS.items():
        expr = (F.when(_c(uri) == k, F.lit(v)) if expr is None else expr.when(_c(uri) == k, F.lit(v)))
    return expr.otherwise(out)


def role_list(role_text) -> Column:
    """comma list of roles -> array of trimmed parts."""
    return F.transform(F.split(_c(role_text), ","), lambda r: F.trim(r))


def unit_text(symbol, name) -> Column:
    """``symbol (name)``; one of them alone when the other is blank or equal;
    ``(empty)`` when both blank; ``(missing)`` when the unit itself is absent
    (both NULL is treated as a missing unit object)."""
    s, n = _c(symbol), _c(name)
    s_ok = s.isNotNull() & (F.trim(s) != "")
    n_ok = n.isNotNull() & (F.trim(n) != "")
    return (F.when(s.isNull() & n.isNull(), F.lit(MISSING))
            .when(~s_ok & ~n_ok, F.lit(EMPTY))
            .when(s_ok & n_ok & (s == n), s)
            .when(s_ok & n_ok, F.concat(s, F.lit(" ("), n, F.lit(")")))
            .when(s_ok, s)
            .otherwise(n))


def missing_or_empty(x) -> Column:
    """NULL -> ``(missing)``, blank -> ``(empty)``, else trimmed text."""
    t = F.trim(_c(x).cast("string"))
    return F.when(t.isNull(), F.lit(MISSING)).when(t == "", F.lit(EMPTY)).otherwise(t)


def blank_to_missing(x) -> Column:
    """F23 variant used for observationType: NULL or blank -> ``(missing)``."""
    t = F.trim(_c(x).cast("string"))
    return F.when(t.isNull() | (t == ""), F.lit(MISSING)).otherwise(t)


def qualifier_codes(flag) -> Column:
    """flag -> one-element array; blank -> NULL."""
    t = F.trim(_c(flag))
    return F.when(t.isNotNull() & (t != ""), F.array(t))


def property_code(props) -> Column:
    """``variableCode`` property, else ``code``."""
    p = _c(props)
    return F.coalesce(p.getItem("variableCode"), p.getItem("code"))


def path_safe(x) -> Column:
    """Folder-safe key; NULL -> ``null``."""
    return F.regexp_replace(F.coalesce(_c(x), F.lit("null")), PATH_UNSAFE_CLASS, "_")


def _sql(x) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("decimal_comma_strict takes a column name")
