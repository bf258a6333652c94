"""Reusable column expressions (``Column -> Column``).

These are the building blocks every plan composes.  All of them are built-in
Spark SQL functions, so they stay inside whole-stage codegen; there is no
Python UDF anywhere in the package.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow import config

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Every character with the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip_all_whitespace(c: ColumnOrName) -> Column:
    """Strip every Unicode whitespace character at both ends (ingest clean-up).

    SQL ``trim`` only removes spaces; cell values from a sheet export are
    stripped of tabs, newlines and non-breaking spaces as well.  Only the ends
    are looked at, where a regular expression would try every character, and a
    cell that begins and ends with a printable ASCII character is left as it is.
    """
    text = _c(c)
    solid = lambda t: (t >= F.lit("!")) & (t < F.lit("\x7f"))  # noqa: E731 - compared by bytes: about the first character
    return F.when(solid(text) & solid(F.substring(text, -1, 1)), text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def has_text(columns: Iterable[ColumnOrName]) -> Column:
    """Whether any cell, stripped or not, holds more than white space; never NULL."""
    return F.btrim(F.concat_ws("", *[_c(c) for c in columns]), F.lit(WHITE_SPACE)) != ""


def blank_to_null(c: ColumnOrName) -> Column:
    """``nullif(trim(c), '')``."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def to_decimal(c: ColumnOrName, precision: int, scale: int, default=None) -> Column:
    """Tolerant numeric parse: blank or bad text gives ``default`` (NULL by default)."""
    parsed = blank_to_null(c).try_cast(DecimalType(precision, scale))
    if default is None:
        return parsed
    return F.coalesce(parsed, F.lit(default).cast(DecimalType(precision, scale)))


#: Texts that a cast reads as the first of the formats does, without a formatter.
PLAIN_DATE = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"
PLAIN_TIMESTAMP = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def parse_timestamp(c: ColumnOrName, formats: Iterable[str] = config.TIMESTAMP_FORMATS) -> Column:
    """Multi-format timestamp parse; the first format that parses wins.

    The result is a naive business time (TIMESTAMP_NTZ): the text is read as
    UTC and counted from the epoch, so no session zone and no clock change
    touches it.
    """
    formats, trimmed = tuple(formats), F.trim(_c(c))
    s = F.concat(trimmed, F.lit(" +00:00"))
    instant = F.coalesce(*[F.try_to_timestamp(s, F.lit(f"{f} xxx")) for f in formats])
    parsed = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if formats[:1] != config.TIMESTAMP_FORMATS[:1]:
        return parsed
    return F.when(trimmed.rlike(PLAIN_TIMESTAMP), trimmed.try_cast("timestamp_ntz")).otherwise(parsed)


def naive_ts(ts: _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal, built from text so no time zone is applied."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def parse_date(c: ColumnOrName, formats: Iterable[str] = config.DATE_FORMATS) -> Column:
    """Multi-format date parse of a non-blank cell; blank gives NULL."""
    formats, s = tuple(formats), blank_to_null(c)
    parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)).cast("date") for f in formats])
    if formats[:1] != config.DATE_FORMATS[:1]:
        return parsed
    return F.when(s.rlike(PLAIN_DATE), s.try_cast("date")).otherwise(parsed)


def canonical_type(c: ColumnOrName) -> Column:
    """``purchase%`` -> Purchase, ``sale%`` -> Sale, anything else trimmed as is."""
    norm = F.lower(F.trim(_c(c)))
    return (
        F.when(norm.startswith("purchase"), F.lit(config.PURCHASE))
        .when(norm.startswith("sale"), F.lit(config.SALE))
        .otherwise(F.trim(_c(c)))
    )


def default_payment_mode(payment: ColumnOrName, mode: ColumnOrName) -> Column:
    """A non-zero payment with a blank mode is Cash."""
    m = blank_to_null(mode)
    return F.when((_c(payment) != 0) & m.isNull(), F.lit("Cash")).otherwise(m)


def resolve_business_date(ts: ColumnOrName, date_raw: ColumnOrName, run_date: _dt.date) -> Column:
    """Typed-in business date unless it is blank or equals the run date; else the timestamp's date.

    ``run_date`` is an explicit parameter (never ``current_date()``) so that a
    re-run on another day gives the same answer.
    """
    d = _c(date_raw)
    return F.when(d.isNotNull() & (d != F.lit(run_date)), d).otherwise(_c(ts).cast("date"))


def transaction_key(ts: ColumnOrName, ttype: ColumnOrName, vendor: ColumnOrName,
                    customer: ColumnOrName, payment: ColumnOrName) -> Column:
    """md5 of ``ts|type|vendor|customer|payment`` with NULL parts as empty strings."""
    parts = [
        F.coalesce(_c(ts).cast("string"), F.lit("")),
        F.coalesce(_c(ttype), F.lit("")),
        F.coalesce(_c(vendor), F.lit("")),
        F.coalesce(_c(customer), F.lit("")),
        F.coalesce(_c(payment).cast("string"), F.lit("")),
    ]
    return F.md5(F.concat_ws("|", *parts))


def pick_by_name(name: ColumnOrName, mapping: Mapping[str, ColumnOrName]) -> Column:
    """Simple CASE: pick the column whose label equals ``name``; no match gives NULL."""
    out = None
    for label, col in mapping.items():
        out = (F.when if out is None else out.when)(_c(name) == F.lit(label), _c(col))
    return out


def round_half_away(x: ColumnOrName, digits: int = 2) -> Column:
    """Round a DOUBLE half away from zero on its scaled value: ``sign(x)*floor(|x|*10^d+0.5)/10^d``.

    This is the rounding the source engine applies to doubles (Spark's
    ``round`` rounds the exact binary value instead and differs on ties).
    """
    p = float(10 ** digits)
    v = _c(x)
    return F.signum(v) * F.floor(F.abs(v) * p + F.lit(0.5)) / F.lit(p)


def fiscal_year_start(d: ColumnOrName, start_month: int = config.FISCAL_YEAR_START_MONTH) -> Column:
    """First day of the fiscal year containing ``d`` (April by default)."""
    y = F.year(_c(d)) - F.when(F.month(_c(d)) < start_month, 1).otherwise(0)
    return F.make_date(y, F.lit(start_month), F.lit(1))


def week_start(d: ColumnOrName) -> Column:
    """Monday of the week."""
    return F.trunc(_c(d), "week")


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(_c(d), "month")


def format_rs(x: ColumnOrName, decimals: int = 0) -> Column:
    """Presentation: currency prefix and thousands separators."""
    return F.concat(F.lit("₹"), F.format_number(_c(x).cast("double"), decimals))


def cond_sum(cond: Column, value: ColumnOrName) -> Column:
    """``sum(case when cond then value else 0 end)``."""
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(0)))
