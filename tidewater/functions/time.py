"""Time expressions (F6-F10), built-in functions only.

The session time zone is UTC; local wall times are converted explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_wall_time(year, month, day, hour, minute) -> Column:
    """Calendar-checked local wall time; NULL for 30 February, hour 24 and
    other impossible values (P8)."""
    return F.try_make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), _c(minute), F.lit(0))


def local_to_utc(local_ts, zone) -> Column:
    """local wall time in ``zone`` -> UTC instant. A time in the spring gap
    moves forward by the gap, an ambiguous autumn time takes the earlier offset
    (the java.time rule)."""
    z = F.lit(zone) if isinstance(zone, str) else zone
    return F.to_utc_timestamp(_c(local_ts).cast("timestamp"), z)


def instant_text(ts) -> Column:
    """UTC instant as ISO-8601 text ``yyyy-MM-ddTHH:mm:ssZ`` (session zone UTC)."""
    return F.date_format(_c(ts), ISO_INSTANT)


def split_hour(text) -> tuple[Column, Column]:
    """``H:M`` -> (hour, minute) integers; NULL when there is no ``:`` or a
    part is not a number (P7)."""
    t = _c(text)
    has_colon = F.instr(t, ":") > 0
    h = F.when(has_colon, F.substring_index(t, ":", 1).try_cast("int"))
    m = F.when(has_colon, F.substring_index(F.substring_index(t, ":", 2), ":", -1).try_cast("int"))
    return h, m


def normalize_instant(text) -> Column:
    """append ``Z`` when the text carries no zone."""
    v = F.trim(_c(text))
    last_dash = F.length(v) - F.locate("-", F.reverse(v)) + 1
    has_zone = (v.endswith("Z") | v.contains("+")
                | ((F.locate("-", F.reverse(v)) > 0) & (last_dash - 1 > 10)))
    return F.when(has_zone, v).otherwise(F.concat(v, F.lit("Z")))


def parse_instant(text) -> Column:
    """Instant text (with zone designator or offset) -> timestamp; NULL if bad."""
    n = normalize_instant(text)
    return F.coalesce(
        F.try_to_timestamp(n, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX")),
        F.try_to_timestamp(n, F.lit("yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS]XXX")))


def parse_interval(text) -> tuple[Column, Column, Column]:
    """F8: ``instant`` or ``start/end`` -> (start, end, duration seconds).

    Reversed halves are swapped; a ``P...`` half, bad text, or either half
    unparseable gives NULL for all three. An instant has duration 0.
    """
    v = F.trim(_c(text))
    is_pair = F.instr(v, "/") > 0
    a_txt = F.when(is_pair, F.split_part(v, F.lit("/"), F.lit(1))).otherwise(v)
    b_txt = F.when(is_pair, F.substr(v, F.instr(v, "/") + 1)).otherwise(v)
    period_half = is_pair & (a_txt.startswith("P") | b_txt.startswith("P"))
    a, b = parse_instant(a_txt), parse_instant(b_txt)
    ok = ~period_half & a.isNotNull() & b.isNotNull() & v.isNotNull() & (v != "")
    start = F.when(ok, F.least(a, b))
    end = F.when(ok, F.greatest(a, b))
    dur = F.when(ok, F.unix_timestamp(F.greatest(a, b)) - F.unix_timestamp(F.least(a, b)))
    return start, end, dur


def duration_text(seconds) -> Column:
    """``Ny + Nd`` (365-day years), ``Nd``, ``Nd Nh Nm Ns``, ``Nh Nm Ns``,
    ``Nm Ns`` or ``Ns``."""
    s = _c(seconds)
    sign = F.when(s < 0, F.lit("-")).otherwise(F.lit(""))
    t = F.abs(s)
    days = F.floor(t / 86400).cast("long")
    rem = t % 86400
    years, ydays = F.floor(days / 365).cast("long"), days % 365
    hh, mm, ss = F.floor(rem / 3600).cast("long"), F.floor((rem % 3600) / 60).cast("long"), rem % 60
    hms = F.concat(hh.cast("string"), F.lit("h "), mm.cast("string"), F.lit("m "), ss.cast("string"), F.lit("s"))
    body = (F.when(years > 0, F.concat(years.cast("string"), F.lit("y + "), ydays.cast("string"), F.lit("d")))
            .when((days > 0) & (rem == 0), F.concat(days.cast("string"), F.lit("d")))
            .when(days > 0, F.concat(days.cast("string"), F.lit("d "), hms))
            .when(hh > 0, hms)
            .when(mm > 0, F.concat(mm.cast("string"), F.lit("m "), ss.cast("string"), F.lit("s")))
            .otherwise(F.concat(ss.cast("string"), F.lit("s"))))
    return F.when(s.isNotNull(), F.concat(sign, body))


# ISO-8601 period grammar with optional Y, M, D and T H, M, S parts.
ISO_PERIOD_PATTERN = r"^P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"


def iso_period_parts(text) -> Column:
    """F10 step 1: struct(ok, y, mo, d, h, mi, s) of an ISO period text; put it
    in its own column so the regex runs once per row (``add_iso_period``)."""
    p = F.upper(F.trim(_c(text)))
    ok = p.rlike(ISO_PERIOD_PATTERN)
    names = ["y", "mo", "d", "h", "mi", "s"]
    fields = [F.coalesce(ok, F.lit(False)).alias("ok")]
    for i, n in enumerate(names, start=1):
        g = F.regexp_extract(p, ISO_PERIOD_PATTERN, i)
        fields.append(F.when(ok & (g != ""), g.try_cast("long")).otherwise(F.lit(0).cast("long")).alias(n))
    return F.struct(*fields)


def iso_period_from_parts(parts) -> tuple[Column, Column]:
    """F10 step 2: (value, unit) from ``iso_period_parts``.

    Years or months only when alone; otherwise the total in seconds, expressed
    in the largest unit that divides it (days, hours, minutes, seconds). Zero,
    blank or bad text -> (NULL, NULL).
    """
    q = _c(parts)
    ok, y, mo, d, h, mi, s = (q[n] for n in ["ok", "y", "mo", "d", "h", "mi", "s"])
    total = ((d * 24 + h) * 60 + mi) * 60 + s
    value = (F.when(~ok, None)
             .when(y > 0, F.when((mo + d + h + mi + s) == 0, y))
             .when(mo > 0, F.when((d + h + mi + s) == 0, mo))
             .when(total == 0, None)
             .when(total % 86400 == 0, total / 86400)
             .when(total % 3600 == 0, total / 3600)
             .when(total % 60 == 0, total / 60)
             .otherwise(total)).cast("long")
    unit = (F.when(~ok, None)
            .when(y > 0, F.when((mo + d + h + mi + s) == 0, F.lit("years")))
            .when(mo > 0, F.when((d + h + mi + s) == 0, F.lit("months")))
            .when(total == 0, None)
            .when(total % 86400 == 0, F.lit("days"))
            .when(total % 3600 == 0, F.lit("hours"))
            .when(total % 60 == 0, F.lit("minutes"))
            .otherwise(F.lit("seconds")))
    return value, unit


def add_iso_period(df, text_col: str, value_out: str, unit_out: str):
    """F10 on a DataFrame: parts in one projection, value and unit in the
    next (the regex is not re-evaluated per branch)."""
    tmp = f"_iso_{value_out}"
    v, u = iso_period_from_parts(tmp)
    return df.withColumn(tmp, iso_period_parts(text_col)).withColumn(value_out, v).withColumn(unit_out, u).drop(tmp)


def iso_period(text) -> tuple[Column, Column]:
    """F10 as two columns in one expression (small inputs; prefer
    ``add_iso_period`` on large frames)."""
    return iso_period_from_parts(iso_period_parts(text))
