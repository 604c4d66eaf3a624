"""Column-expression helpers. Everything here builds native Catalyst
expressions, so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PACIFIC = "America/Los_Angeles"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fmt2(c: str | Column) -> Column:
    """Python ``f"{v:.2f}"``: half-even on the exact binary value, no grouping,
    ``nan`` for NaN. ``format_number`` with a pattern matches it; ``format_string``
    rounds half-up on the decimal text and differs."""
    c = col(c)
    return F.when(F.isnan(c), F.lit("nan")).otherwise(F.call_function("format_number", c, F.lit("0.00")))


def fmt2_join(arr: str | Column, sep: str = " ") -> Column:
    """``sep.join(f"{v:.2f}" for v in arr)``."""
    return F.array_join(F.transform(col(arr), fmt2), sep)


def long_date_text(ts: str | Column) -> Column:
    """``strftime('%B %d, %Y, %H:%M, %A')``."""
    return F.date_format(col(ts).cast("timestamp"), "MMMM dd, yyyy, HH:mm, EEEE")


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since the epoch as DOUBLE (micro-second precision)."""
    return F.unix_micros(col(ts).cast("timestamp")) / F.lit(1_000_000.0)


def from_epoch(seconds: str | Column) -> Column:
    return F.timestamp_micros((col(seconds) * 1_000_000).cast("long"))


def pacific_local(seconds: str | Column) -> Column:
    """Wall-clock time in US/Pacific for epoch seconds (DST aware)."""
    return F.from_utc_timestamp(from_epoch(seconds), PACIFIC)


def pacific_day(seconds: str | Column) -> Column:
    return F.date_format(pacific_local(seconds), "yyyy-MM-dd")


def pacific_stamp(seconds: str | Column) -> Column:
    """``strftime('%Y-%m-%d %H:%M:%S %Z')`` in US/Pacific. The zone letters are
    derived from the offset because pattern ``z`` prints the session zone."""
    utc = from_epoch(seconds)
    local = F.from_utc_timestamp(utc, PACIFIC)
    offset_h = (F.unix_seconds(local) - F.unix_seconds(utc)) / 3600
    abbrev = F.when(offset_h == -7, F.lit("PDT")).otherwise(F.lit("PST"))
    return F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(" "), abbrev)


def portable_hash(*parts: str | Column) -> Column:
    """Deterministic 60-bit hash that an SQL engine can reproduce:
    first 15 hex digits of md5 over ``'|'``-joined parts, as BIGINT."""
    text = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def portable_uniform(*parts: str | Column) -> Column:
    """Uniform in (0, 1), never 0, from :func:`portable_hash`."""
    return (portable_hash(*parts).cast("double") + 1.0) / F.lit(float(2**60 + 1))


PY_WS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"


def py_strip(c: str | Column) -> Column:
    """Python ``str.strip()``: all leading/trailing (unicode) whitespace, not only blanks."""
    return F.regexp_replace(col(c), f"^{PY_WS}+|{PY_WS}+$", "")


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm2(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity in double; a zero vector gives NULL."""
    return F.try_divide(dot(a, b), norm2(a) * norm2(b))


def round6(c: str | Column) -> Column:
    return F.round(col(c), 6)


def py_round(c: str | Column, ndigits: int) -> Column:
    """Python ``round(x, n)`` for n >= 1 and |x| >= 10**-n, such as log timestamps:
    half-even on the exact binary value.
    ``format_number`` with a pattern does that (``bround`` rounds the shortest
    decimal text instead, so ties such as 1704097739.36385 differ)."""
    v = col(c).cast("double")
    text = F.call_function("format_number", v, F.lit("0." + "0" * ndigits))
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), v).otherwise(text.try_cast("double"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and apply ``body`` to it. Filter pushdown inlines
    column aliases into predicates, so an expensive expression referenced k
    times can be computed k times; binding it as a lambda argument prevents that."""
    return F.element_at(F.transform(F.array(value), body), 1)
