"""Rule tables compiled into native CASE expressions.

Builders take their rules from the tables in ``patronage.config``. The DuckDB
twins don't use them: they state the rules on their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronage import config


def _sql_str(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _spark_str(value: str) -> str:
    """Spark SQL string literal (backslash is an escape character there)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lit_sql(v) -> str:
    """SQL literal valid in both Spark and DuckDB; floats stay doubles."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return _sql_str(v)


def first_match(cases: Sequence[tuple[Column, object]], otherwise) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE otherwise END``."""
    expr = None
    for cond, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    fallback = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return fallback if expr is None else expr.otherwise(fallback)


# ---------------------------------------------------------------------------
# RFM segment rules
# ---------------------------------------------------------------------------

def _bounds_col(bounds: dict, scores: dict[str, Column]) -> Column:
    parts = []
    for name, (low, high) in bounds.items():
        c = scores[name]
        if low == high:
            parts.append(c == low)
            continue
        if low > 1:
            parts.append(c >= low)
        if high < 5:
            parts.append(c <= high)
    if not parts:
        return F.lit(True)
    cond = parts[0]
    for p in parts[1:]:
        cond = cond & p
    return cond


def _condition_col(cond, scores) -> Column:
    if isinstance(cond, dict):
        return _bounds_col(cond, scores)
    out = None
    for alt in cond:
        c = _bounds_col(alt, scores)
        out = c if out is None else (out | c)
    return out


def segment_col(r: Column | str, f: Column | str, m: Column | str,
                rules=config.SQL_SEGMENT_RULES,
                fallback: str = config.SEGMENT_FALLBACK) -> Column:
    """RFM segment label from 1-5 scores, first matching rule wins. Given
    column names, the CASE is built as one SQL expression."""
    if isinstance(r, str) and isinstance(f, str) and isinstance(m, str):
        return F.expr(segment_sql(r, f, m, rules, fallback))
    scores = {"r": r, "f": f, "m": m}
    return first_match([(_condition_col(c, scores), label) for label, c in rules], fallback)


def _bounds_sql(bounds: dict, scores: dict[str, str]) -> str:
    parts = []
    for name, (low, high) in bounds.items():
        c = scores[name]
        if low == high:
            parts.append(f"{c} = {low}")
            continue
        if low > 1:
            parts.append(f"{c} >= {low}")
        if high < 5:
            parts.append(f"{c} <= {high}")
    return "(" + (" AND ".join(parts) or "TRUE") + ")"


def segment_sql(r: str, f: str, m: str, rules=config.SQL_SEGMENT_RULES,
                fallback: str = config.SEGMENT_FALLBACK) -> str:
    scores = {"r": r, "f": f, "m": m}
    whens = []
    for label, cond in rules:
        if isinstance(cond, dict):
            text = _bounds_sql(cond, scores)
        else:
            text = "(" + " OR ".join(_bounds_sql(a, scores) for a in cond) + ")"
        whens.append(f"WHEN {text} THEN {_sql_str(label)}")
    return "CASE " + " ".join(whens) + f" ELSE {_sql_str(fallback)} END"


# ---------------------------------------------------------------------------
# Product categoriser: ordered (label, regex) list on a normalised description
# ---------------------------------------------------------------------------

def category_col(description: Column | str, rules=config.CATEGORY_RULES,
                 fallback: str = config.FALLBACK_CATEGORY) -> Column:
    """First rule whose regex occurs in ``description`` (NULL -> fallback).
    ``description`` may be a Column or a Spark SQL expression (one call)."""
    if isinstance(description, str):
        whens = " ".join(f"WHEN {description} RLIKE {_spark_str(p)} THEN {_sql_str(label)}"
                         for label, p in rules)
        return F.expr(f"CASE {whens} ELSE {_sql_str(fallback)} END")
    return first_match([(description.rlike(pattern), label) for label, pattern in rules], fallback)


# ---------------------------------------------------------------------------
# Lookups with a default
# ---------------------------------------------------------------------------

def lookup_col(key: Column | str, pairs: Iterable[tuple[object, object]], default) -> Column:
    """``CASE key WHEN k THEN v ... ELSE default``; with ``key`` a column name
    or SQL expression it is built as one SQL expression."""
    if isinstance(key, str) and not isinstance(default, Column):
        return F.expr(lookup_sql(key, pairs, default))
    key = F.col(key) if isinstance(key, str) else key
    return first_match([(key == k, v) for k, v in pairs], default)


def lookup_sql(key: str, pairs: Iterable[tuple[object, object]], default) -> str:
    whens = " ".join(f"WHEN {key} = {lit_sql(k)} THEN {lit_sql(v)}" for k, v in pairs)
    return f"CASE {whens} ELSE {lit_sql(default)} END"


def non_merch_col(stock_code: Column) -> Column:
    """True for postage, fees and other non-merchandise stock codes."""
    cond = stock_code.isin(list(config.NON_MERCH_CODES))
    for prefix in config.NON_MERCH_PREFIXES:
        cond = cond | stock_code.startswith(prefix)
    return cond


def roi_band_col(roi: Column | str) -> Column:
    if isinstance(roi, str):
        return F.expr(roi_band_sql(roi))
    return first_match([(roi >= t, label) for t, label in config.ROI_BANDS],
                       config.ROI_BAND_FALLBACK)


def roi_band_sql(roi: str) -> str:
    whens = " ".join(f"WHEN {roi} >= {t} THEN {_sql_str(label)}" for t, label in config.ROI_BANDS)
    return f"CASE {whens} ELSE {_sql_str(config.ROI_BAND_FALLBACK)} END"
