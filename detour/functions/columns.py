"""Column expressions shared by the operators. All built-in, JVM-side, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from detour.fixed import ALTERNATIVES_TEXT, GRIDLOCK_TEXT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_default(c, default) -> Column:
    """Missing key or null -> default (F1)."""
    return F.coalesce(_c(c), F.lit(default))


def title_from_id(c) -> Column:
    """``hammersmith-city`` -> ``Hammersmith City``.

    ``initcap`` upper-cases after blanks only; Python's ``title`` also after other
    non-letters (``king's`` -> ``King'S``). Equal once dashes become blanks and ids
    are lower-case words, which is the shape of every line id.
    """
    return F.initcap(F.regexp_replace(_c(c), "-", " "))


def _has_fraction(ts: Column) -> Column:
    return F.date_format(ts, "SSSSSS") != F.lit("000000")


def iso_utc(ts) -> Column:
    """UTC ISO-8601 text as ``datetime.isoformat()`` writes it.

    Microseconds are written only when non-zero, offset always ``+00:00``.
    Requires ``spark.sql.session.timeZone=UTC``.
    """
    ts = _c(ts)
    return F.when(ts.isNull(), F.lit(None)).when(
        _has_fraction(ts), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


def py_timestamp_str(ts) -> Column:
    """Timestamp text as ``str(datetime)`` writes it."""
    ts = _c(ts)
    return F.when(ts.isNull(), F.lit(None)).when(
        _has_fraction(ts), F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))


def json_payload(*cols, keep_nulls: bool = True) -> Column:
    """Row -> JSON text (F6). Nulls are written as ``null`` like a JSON encoder does."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[_c(c) for c in cols]), opts)


def preview(c, n: int = 200) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(c), 1, n)


def gridlock_label(flag) -> Column:
    """Display text for the gridlock flag (F8)."""
    return F.when(_c(flag), F.lit(GRIDLOCK_TEXT)).otherwise(F.lit(ALTERNATIVES_TEXT))
