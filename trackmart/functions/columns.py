"""Column helpers: null policy, tolerant casts, exact trimming, JSON fields.

All helpers return built-in Column expressions, so they stay inside
whole-stage code generation; there is no Python UDF anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.schemas import ERROR_QUOTA, PANDAS_NA, PY_WS, TOPIC_SUFFIX


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- trimming and text ------------------------------------------------------

def py_strip(c: str | Column) -> Column:
    """Trim exactly the characters Python's ``str.strip()`` removes (X-01)."""
    return F.btrim(col(c), F.lit(PY_WS))


def strip_fill(c: str | Column) -> Column:
    """NULL -> '' then trim (N-03 + X-01)."""
    return py_strip(F.coalesce(col(c), F.lit("")))


def na_tokens_to_null(c: str | Column, tokens: Iterable[str] = PANDAS_NA) -> Column:
    """Text NA tokens become NULL; compared untrimmed, as the CSV reader does."""
    c = col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def topic_query(c: str | Column) -> Column:
    """``"<name> Topic"`` (X-07)."""
    return F.concat(col(c), F.lit(TOPIC_SUFFIX))


def percent_text(c: str | Column, digits: int = 2) -> Column:
    """``'{:.2f}%'`` formatting (X-06)."""
    return F.format_string(f"%.{digits}f%%", col(c))


def percent(part: str | Column, whole: str | Column) -> Column:
    """``part / whole * 100`` (X-03); NULL when whole is 0."""
    return col(part) / F.nullif(col(whole), F.lit(0)) * 100.0


# --- null policy ------------------------------------------------------------

def fill(c: str | Column, value, data_type: T.DataType | str | None = None) -> Column:
    """Typed ``fillna`` for one column (N-01, N-03..N-05)."""
    lit = F.lit(value)
    if data_type is not None:
        lit = lit.cast(data_type)
    return F.coalesce(col(c), lit)


def fill_map(columns: Iterable[str], fills: Mapping[str, object]) -> dict[str, Column]:
    """``fillna(dict)`` restricted to the columns that exist."""
    present = set(columns)
    return {k: fill(k, v) for k, v in fills.items() if k in present}


def sentinel_to_null(c: str | Column, sentinel=-1) -> Column:
    """``replace(-1, NaN)`` (N-06)."""
    return F.nullif(col(c), F.lit(sentinel))


def any_null(cols: Iterable[str | Column]) -> Column:
    """True when any of ``cols`` is NULL (N-07 row mask)."""
    out = None
    for c in cols:
        e = col(c).isNull()
        out = e if out is None else (out | e)
    return out if out is not None else F.lit(False)


def nan_to_null(c: str | Column) -> Column:
    """Floating NaN becomes NULL (the reference has a single missing marker)."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


# --- tolerant casts ---------------------------------------------------------

def coerce_double(c: str | Column) -> Column:
    """``to_numeric(errors='coerce')``: bad text -> NULL (C-01)."""
    return col(c).try_cast("double")


def coerce_long(c: str | Column) -> Column:
    """Numeric text or double -> bigint, truncating toward zero (C-01 + C-02).

    Whole numbers stay exact; only text such as ``'19400.0'`` or ``'1e3'``
    that is no bigint goes through double.
    """
    return F.coalesce(col(c).cast("string").try_cast("bigint"), coerce_double(c).try_cast("bigint"))


def coerce_int(c: str | Column) -> Column:
    """Nullable int (C-03)."""
    return coerce_double(c).try_cast("int")


def coerce_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """``to_datetime(errors='coerce', utc=True)`` (C-04).

    Without ``fmt`` every ISO-8601 form Spark knows is accepted row by row
    (offsets are converted to UTC); with ``fmt`` only that pattern is.
    """
    c = col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def count_coerced(src: str | Column, dst: str | Column) -> Column:
    """Aggregate: values present before and missing after a coercion."""
    return F.sum((col(src).isNotNull() & col(dst).isNull()).cast("bigint"))


# --- lookup helpers ---------------------------------------------------------

def is_match(c: str | Column) -> Column:
    """Matched-row predicate of the join report: not NULL and not 0 (F-06, X-05)."""
    c = col(c)
    return F.coalesce(c.isNotNull() & (c != 0), F.lit(False))


def label(c: str | Column, mapping: Mapping) -> Column:
    """Dictionary lookup, missing key -> NULL (J-05), as a literal map."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*items), col(c)) if items else F.lit(None)


def json_long(c: str | Column, field: str, default: int = 0) -> Column:
    """``stats.get(field, 0)`` on a JSON text; missing or non-numeric -> default (X-08)."""
    raw = F.get_json_object(col(c), f"$.{field}")
    return F.coalesce(coerce_long(raw), F.lit(default).cast("bigint"))


def hidden_to_sentinel(hidden: str | Column, value: str | Column) -> Column:
    """Hidden counter -> -1 (X-09)."""
    return F.when(F.coalesce(col(hidden), F.lit(False)), F.lit(-1).cast("bigint")).otherwise(col(value))


def error_tag(status: str | Column, detail: str | Column) -> Column:
    """Error text stored in ``channel_id_found`` for a failed lookup (X-10)."""
    status, detail = col(status), col(detail)
    return (F.when(status == "quota", F.lit(ERROR_QUOTA))
            .when(status == "http", F.concat(F.lit("Error: HTTP "), detail))
            .when(status == "other", F.concat(F.lit("Error: "), detail)))


def is_quota_error(message: str | Column) -> Column:
    """Substring test on an error message (X-10)."""
    return col(message).contains("quotaExceeded")
