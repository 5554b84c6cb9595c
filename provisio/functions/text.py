"""Text helpers (C-15 … C-20, P-22, P-26): number and money formatting,
templates, dates.

Numbers are rounded half away from zero to the shown digits with plain
floating-point arithmetic (``floor(|x|·10^d + 0.5)``) before formatting, so
the text does not depend on how an engine's formatter or ``round`` treats
values whose decimal form is an exact half.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import col_

__all__ = ["round_half_away", "fmt_pct1", "fmt_pct2", "fmt_fixed", "fmt_signed_pct0", "fmt_thousands", "fmt_money",
           "fill_text", "display_feature_name", "padded_id"]


def round_half_away(x: Column, digits: int) -> Column:
    """Round half away from zero with IEEE arithmetic only."""
    f = float(10 ** digits)
    up = lambda v: F.floor(v * f + 0.5).cast("double")
    return F.when(x < 0, -up(-x)).otherwise(up(x)) / f


def fmt_pct1(x: str | Column) -> Column:
    """C-16: ``{:.1%}`` — 0.1234 → ``'12.3%'``."""
    return F.format_string("%.1f%%", round_half_away(col_(x) * 100.0, 1))


def fmt_pct2(x: str | Column) -> Column:
    """C-16: ``{:.2%}`` — 0.1234 → ``'12.34%'``."""
    return F.format_string("%.2f%%", round_half_away(col_(x) * 100.0, 2))


def fmt_fixed(x: str | Column, digits: int) -> Column:
    """C-16: ``{:.nf}``."""
    return F.format_string(f"%.{digits}f", round_half_away(col_(x), digits))


def fmt_signed_pct0(x: str | Column) -> Column:
    """C-16: ``{:+.0%}`` — −0.5 → ``'-50%'``, 0.1 → ``'+10%'``."""
    return F.format_string("%+.0f%%", round_half_away(col_(x) * 100.0, 0))


def fmt_thousands(x: str | Column) -> Column:
    """C-16: ``{:,.0f}`` — thousands separators, no decimals."""
    return F.format_number(round_half_away(col_(x), 0), 0)


def fmt_money(x: str | Column) -> Column:
    """C-17: NULL or 0 → ``'N/A'``; above 1e9 → ``'x.xx B'``; else thousands.
    Exactly 1e9 and all negatives use the thousands form (the test is ``>``)."""
    v = col_(x)
    return (F.when(v.isNull() | (v == 0), F.lit("N/A"))
            .when(v > 1e9, F.format_string("%.2f B", round_half_away(v / 1e9, 2)))
            .otherwise(fmt_thousands(v)))


def fill_text(template: str, value: Column) -> Column:
    """C-18: a whole text with one ``%s``, filled in; NULL for a NULL value."""
    return F.when(value.isNotNull(), F.format_string(template, value))


def display_feature_name(name: str | Column) -> Column:
    """P-26: ``industry_X`` → ``Sector: X`` for display."""
    return F.replace(col_(name), F.lit("industry_"), F.lit("Sector: "))


def padded_id(prefix: str, key: str | Column, width: int) -> Column:
    """P-22: ``PREFIX_%0wd`` ids (width is a minimum; longer keys are not cut)."""
    return F.format_string(f"{prefix}%0{width}d", col_(key))
