"""Column expressions (scalar functions).

Everything here returns a ``pyspark.sql.Column`` built from built-in functions, so it
stays inside whole-stage codegen and never leaves the JVM. ANSI mode stays on: every
conversion of untrusted text goes through ``try_cast`` / ``try_*``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from txflow.functions import values as V

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- numbers ----------------------------------------------------------------

def parse_decimal_comma(col: ColumnOrName, to: str = "double") -> Column:
    """'12,5' -> 12.5; surrounding spaces ignored; unparsable -> NULL (CLN1).
    Every ',' becomes '.', as the job's regex replace does; no regex runs."""
    return F.trim(F.translate(_c(col), ",", ".")).try_cast(to)


def parse_amount_or_zero(col: ColumnOrName) -> Column:
    """Producer variant of CLN1: unparsable or missing -> 0.0."""
    return F.coalesce(parse_decimal_comma(col), F.lit(0.0))


def tolerant_cast(col: ColumnOrName, to: str) -> Column:
    """Cast that yields NULL instead of failing under ANSI (CLN2)."""
    return _c(col).try_cast(to)


def money(col: ColumnOrName) -> Column:
    """Round to cents, half up (CLN18), as the batch reports do."""
    return F.round(_c(col), 2)


def money_half_even(col: ColumnOrName) -> Column:
    """Round a float to cents, ties to even: the summing view's ``round(amount, 2)``
    on a Float64 column (that engine rounds floats half to even)."""
    return F.bround(_c(col), 2)


# --- time ---------------------------------------------------------------------

def parse_timestamp(col: ColumnOrName) -> Column:
    """Text -> TIMESTAMP_NTZ (wall clock, no zone); bad text -> NULL (CLN3)."""
    return _c(col).try_cast("timestamp_ntz")


def epoch_to_timestamp(col: ColumnOrName) -> Column:
    """Epoch seconds -> TIMESTAMP (CLN14, CLN16). Zone-free: no text round trip."""
    return F.timestamp_seconds(_c(col))


def to_wall_clock(col: ColumnOrName) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ in the session zone (UTC in this library)."""
    return _c(col).cast("timestamp_ntz")


def to_instant(col: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP (watermarks need the latter)."""
    return _c(col).cast("timestamp")


def timestamp_to_epoch(col: ColumnOrName) -> Column:
    """TIMESTAMP -> whole epoch seconds."""
    return F.unix_seconds(to_instant(col))


def clock_fallback(epoch: ColumnOrName, now: Column | None = None) -> Column:
    """``timestamp = 0``, or none, means "not set": use ``now`` instead (CLN15)."""
    now = F.current_timestamp() if now is None else now
    e = F.coalesce(_c(epoch), F.lit(0))
    return F.when(e == 0, now).otherwise(epoch_to_timestamp(e))


# --- text -------------------------------------------------------------------

# The white space of the batch job's regex class \s (Java, default flags): blank, tab,
# newline, vertical tab, form feed, carriage return. Deleting these characters is what
# regexp_replace(c, '\s+', '') does, without running a regex per row.
WHITE_SPACE = " \t\n\x0b\f\r"


def strip_all_space(col: ColumnOrName) -> Column:
    """Remove every white space character, as replacing the regex \\s+ by '' does."""
    return F.translate(_c(col), WHITE_SPACE, "")


def strip_edges(col: ColumnOrName) -> Column:
    """Trim every kind of white space at both ends (``trim`` only strips blanks)."""
    return F.btrim(_c(col), F.lit(WHITE_SPACE))


def city_as_written(col: ColumnOrName) -> Column:
    """initcap then trim of blanks (CLN4, as the batch job does it)."""
    return F.trim(F.initcap(_c(col)))


def category_as_written(col: ColumnOrName) -> Column:
    """initcap, drop all white space, upper, trim (CLN4, as the batch job does it)."""
    return F.trim(F.upper(strip_all_space(F.initcap(_c(col)))))


def normalized_category(col: ColumnOrName) -> Column:
    """upper(no white space) -- the key used by the summing view."""
    return F.upper(strip_all_space(_c(col)))


def category_multiif(col: ColumnOrName) -> Column:
    """'' / 'N/A' / 'NULL' (after normalising) -> 'UNKNOWN' (CLN9).

    A missing value counts as '' (the OLAP columns are not nullable, so an absent
    field arrives as the empty default).
    """
    norm = normalized_category(F.coalesce(_c(col), F.lit("")))
    expr = None
    for marker in V.NO_CATEGORY:
        cond = norm == F.lit(marker)
        expr = F.when(cond, F.lit(V.NO_CATEGORY_LABEL)) if expr is None else expr.when(cond, F.lit(V.NO_CATEGORY_LABEL))
    return expr.otherwise(norm)


def null_if_in(col: ColumnOrName, markers: Iterable[str]) -> Column:
    c = _c(col)
    return F.when(c.isin(list(markers)), F.lit(None).cast("string")).otherwise(c)


def recode(col: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Dictionary recode (CLN6). For dictionaries of thousands of entries join a
    broadcast lookup frame instead of growing this CASE."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return c if expr is None else expr.otherwise(c)


def intended_city(col: ColumnOrName) -> Column:
    """Trim all white space, initcap, sentinels (any case) -> NULL, recode, fill."""
    c = F.initcap(strip_edges(col))
    sentinel = F.upper(c).isin("", "N/A", "NULL", "UNKNOWN")
    c = F.when(sentinel, F.lit(None).cast("string")).otherwise(c)
    return F.coalesce(recode(c, V.CITY_NAMES), F.lit(V.UNKNOWN_LABEL))


def intended_category(col: ColumnOrName) -> Column:
    """Upper-cased, white space removed; N/A, NULL, '', UNKNOWN and missing -> UNKNOWN."""
    c = normalized_category(col)
    missing = c.isNull() | c.isin("", "N/A", "NULL", "UNKNOWN")
    return F.when(missing, F.lit(V.NO_CATEGORY_LABEL)).otherwise(c)


# --- reproducible pick ------------------------------------------------------

PICK_PRIME = 1000003


def pick(key: ColumnOrName, choices: list[str], salt: int = 0) -> Column:
    """Reproducible stand-in for ``random.choice``: the same key and salt always
    pick the same element; keys spread evenly over the choices (CLN12)."""
    idx = F.pmod(_c(key).cast("bigint") * F.lit(PICK_PRIME) + F.lit(salt), F.lit(len(choices)))
    return F.element_at(F.array(*[F.lit(x) for x in choices]), (idx + 1).cast("int"))
