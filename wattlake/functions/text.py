"""Scalar cleaning functions (C1-C21), all built-in expressions.

Every parse is the ``try_`` form: ANSI mode is on, so a plain cast or
``to_date`` would fail the job on the first bad cell instead of yielding NULL.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# French abbreviated month tokens of the booking export, in calendar order,
# and the English token each is replaced with before parsing (case-sensitive).
FRENCH_MONTHS = [
    ("janv.", "Jan"), ("févr.", "Feb"), ("mars", "Mar"), ("avr.", "Apr"),
    ("mai", "May"), ("juin", "Jun"), ("juil.", "Jul"), ("août", "Aug"),
    ("sept.", "Sep"), ("oct.", "Oct"), ("nov.", "Nov"), ("déc.", "Dec"),
]
# French booking headers and the silver column names they become.
BOOKING_HEADERS = {
    "Nom": "room_id",
    "Nom Entier": "room_name",
    "Date": "raw_date",
    "Date de début": "start_time",
    "Date de fin": "end_time",
    "Rés.-no": "reservation_id",
    "Type de réservation": "reservation_type",
    "Codes": "reservation_code",
    "Nom de l'utilisateur": "reserved_by",
    "Sigle de salle remplacée": "alt_room_id",
    "Nom entier de la salle remplacée": "alt_room_name",
    "Classe": "class",
    "Activité": "activity_type",
    "Professeur": "instructor",
    "Division": "department",
    "Poste de dépenses": "expense_category",
    "Remarque": "remarks",
    "Annotation": "comments",
}
# Booking columns whose missing values become the EMPTY placeholder.
PLACEHOLDER_COLUMNS = [
    "room_id", "instructor", "department", "activity_type",
    "reservation_type", "reservation_code", "reserved_by",
    "alt_room_id", "class", "expense_category", "remarks", "comments",
]
PLACEHOLDER = "EMPTY"
MISSING_TOKENS = ["nan", "None", ""]
# Silver booking columns, in output order.
BOOKING_COLUMNS = [
    "date", "room_id", "start_time", "end_time", "reservation_id",
    "reservation_type", "reservation_code", "reserved_by", "alt_room_id",
    "activity_type", "instructor", "department", "class",
    "expense_category", "remarks", "comments",
]
SENTINEL_DATE = "1900-01-01"
REDACTED = "ANONYMIZED"
NO_ERROR = "No Error"
# times of day as the feeds write them (H:MM, HH:MM, with or without seconds), and normalised ones that exist
CLOCK_PATTERN = r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?\z"
VALID_CLOCK_PATTERN = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_eu_date(c) -> Column:
    """``dd.MM.yyyy`` (single digits accepted), invalid -> NULL."""
    return F.try_to_date(F.trim(_c(c)), "d.M.yyyy")


def parse_short_date(c) -> Column:
    """``dd.MM.yy`` -> 20yy, invalid -> NULL."""
    return F.try_to_date(F.trim(_c(c)), "d.M.yy")


def parse_iso_utc(c) -> Column:
    """ISO-8601 text with ``Z`` or ``+hh:mm`` offset -> UTC timestamp.

    The session zone is UTC, so the instant prints as UTC wall time.
    """
    return F.try_to_timestamp(F.trim(_c(c)))


def french_date(c) -> Column:
    """C4 + C5: ``05 janv. 2023`` -> DATE; unparseable -> 1900-01-01."""
    s = F.trim(_c(c))
    for fr, en in FRENCH_MONTHS:
        s = F.replace(s, F.lit(fr), F.lit(en))
    return F.coalesce(F.try_to_date(s, "d MMM yyyy"), F.lit(SENTINEL_DATE).cast("date"))


def eu_decimal(c) -> Column:
    """``12,5`` -> 12.5; invalid, ``nan`` or empty -> NULL (never NaN)."""
    v = F.replace(F.trim(_c(c)), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(~F.isnan(v), v)


def to_double(c) -> Column:
    """Numeric coercion of a text cell, invalid -> NULL."""
    v = F.trim(_c(c).cast("string")).try_cast("double")
    return F.when(~F.isnan(v), v)


def date_iso(c) -> Column:
    """DATE -> ``yyyy-MM-dd`` text."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def ts_time(c) -> Column:
    """Timestamp -> ``HH:mm:ss`` text."""
    return F.date_format(_c(c), "HH:mm:ss")


def strip_quotes(c) -> Column:
    """Drop every double quote, then trim."""
    return F.trim(F.replace(_c(c), F.lit('"'), F.lit("")))


def fill_placeholder(c) -> Column:
    """C11: NULL, '', 'nan', 'None' -> EMPTY."""
    col = _c(c)
    return F.when(col.isNull() | col.isin(*MISSING_TOKENS), F.lit(PLACEHOLDER)).otherwise(col)


def rename_headers(df, mapping: dict = BOOKING_HEADERS):
    """C9 + C10: clean header text, then translate the known headers."""
    cleaned = {c: c.replace('"', "").strip() for c in df.columns}
    df = df.withColumnsRenamed({k: v for k, v in cleaned.items() if k != v})
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_existing(df, wanted: list[str]):
    """Keep the wanted columns that exist, in wanted order."""
    return df.select([c for c in wanted if c in df.columns])


def zfill(c, width: int) -> Column:
    """Python ``str.zfill`` for unsigned text: left-pad with 0, never truncate.

    ``%Ns`` pads with spaces without truncating; ``\\G `` then turns only the
    leading spaces into zeros. The input is referenced once, so the caller's
    expression is never duplicated (NULL input gives 'null' text: guard it).
    """
    return F.regexp_replace(F.format_string(f"%{width}s", _c(c)), r"\G ", "0")


def normalize_time(c, bare_hour: bool = False) -> Column:
    """``H:MM`` / ``HH:MM`` / ``HH:MM:SS`` -> ``HH:MM:SS``.

    ``bare_hour`` also accepts ``H`` (rooms variant). Like Python ``zfill``
    the text is left-padded and never truncated. A chain of regex rewrites covers every text;
    digits of the usual forms, which nearly all rows have, are completed without it (the chain took
    4 to 5 us of CPU a row, and filters on the result are evaluated again below it).
    """
    text = s = F.trim(_c(c).cast("string"))
    clock = F.lpad(F.when(F.length(text) <= 5, F.concat(text, F.lit(":00"))).otherwise(text), 8, "0")
    if bare_hour:
        s = F.regexp_replace(s, r"^$", "00")
        s = F.regexp_replace(s, r"^([^:])$", "0$1")
        s = F.regexp_replace(s, r"^([^:]+)$", "$1:00:00")
    s = F.regexp_replace(s, r"^([^:]*:[^:]*)$", "$1:00")
    return F.when(text.rlike(CLOCK_PATTERN), clock).when(_c(c).isNotNull(), zfill(s, 8))


def hour_key(c) -> Column:
    """C14: hour text ``split(':')[0].zfill(2)``."""
    return F.when(_c(c).isNotNull(), zfill(F.split_part(F.trim(_c(c).cast("string")), F.lit(":"), F.lit(1)), 2))


def hour_num(c) -> Column:
    """C14: hour number, 0 when the text has none."""
    return F.coalesce(hour_key(c).try_cast("int"), F.lit(0))


def error_label(code) -> Column:
    """Code 0 / missing -> 'No Error', compared as a number (Q6)."""
    col = _c(code)
    num = col.cast("string").try_cast("double")
    return (F.when(col.isNull() | (num == 0) | F.isnan(num), F.lit(NO_ERROR))
            .otherwise(col.cast("string")))


def kw(c) -> Column:
    """C17: W -> kW."""
    return _c(c) / F.lit(1000.0)


def balance_kw(production_w, consumption_w) -> Column:
    """C17: production minus consumption in kW."""
    return kw(production_w) - kw(consumption_w)


def date_time_ts(date_col, time_col) -> Column:
    """DATE + time text -> TIMESTAMP_NTZ, invalid -> NULL.

    A time that exists is added to its day; only other texts are formatted and parsed again (and mostly are NULL).
    """
    d, t = _c(date_col), normalize_time(time_col, True)
    part = lambda i: t.substr(i, 2).cast("int")
    parsed = F.try_to_timestamp(F.concat_ws(" ", date_iso(d), t), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    known = t.rlike(VALID_CLOCK_PATTERN) & F.year(d).between(1, 9999)
    return F.when(known, d.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), part(1), part(4), part(7))).otherwise(parsed)


def redact(c) -> Column:
    """Any non-empty person name -> ANONYMIZED."""
    col = _c(c)
    return F.when(F.trim(col) != "", F.lit(REDACTED)).otherwise(col)


def default_run_date(offset_days: int = 0) -> Column:
    """C20: yesterday (UTC session) minus ``offset_days``; the reference used a 1,095-day lag (Q19)."""
    return F.date_sub(F.current_date(), 1 + offset_days)


def map_into_year(c, year: int) -> Column:
    """C20: same month/day in ``year``; Feb 29 -> Feb 28 of a non-leap year."""
    d = _c(c)
    first = F.make_date(F.lit(year), F.month(d), F.lit(1))
    return F.make_date(F.lit(year), F.month(d), F.least(F.dayofmonth(d), F.dayofmonth(F.last_day(first))))


def calendar_parts(ts) -> dict[str, Column]:
    """Year ... Second of a timestamp."""
    t = _c(ts)
    return {"Year": F.year(t), "Month": F.month(t), "Day": F.dayofmonth(t),
            "Hour": F.hour(t), "Minute": F.minute(t), "Second": F.second(t)}
