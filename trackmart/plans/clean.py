"""Cleaners for the three sources (E-01..E-03, E-12) and the coercion report.

Each cleaner is a single projection/filter chain over the input: one scan,
no shuffle except the full-row dedup of the track table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.functions.columns import (any_null, coerce_long, coerce_timestamp, count_coerced,
                                         fill, py_strip, sentinel_to_null, strip_fill)
from trackmart.operators.relational import columns_of_kind, dedup_rows, drop_null_rows
from trackmart.schemas import (AWARD_DATES, AWARD_PLACEHOLDERS, AWARD_TEXT, CHANNEL_COUNTS,
                               CHANNEL_TEXT, TRACK_KEYS_NOT_NULL)


def clean_tracks(raw: DataFrame, required: list[str] = TRACK_KEYS_NOT_NULL) -> DataFrame:
    """E-01: full-row dedup -> drop rows missing a required field -> every
    text column NULL->'' and trimmed.

    The dedup runs before the trim, so ``'a'`` and ``'a '`` both survive.
    """
    df = dedup_rows(raw)
    df = drop_null_rows(df, required)
    text = columns_of_kind(df, "text")
    return df.withColumns({c: strip_fill(c) for c in text}) if text else df


def clean_awards(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """E-02: dates parsed to UTC timestamps (bad -> NULL) -> rows without a
    nominee dropped -> placeholders for artist/workers/img (N-02) -> text
    trimmed (NULL title/category stay NULL)."""
    df = raw.withColumns({c: coerce_timestamp(F.col(c).cast("string"), date_format)
                          for c in AWARD_DATES if c in raw.columns})
    df = drop_null_rows(df, ["nominee"])
    df = df.withColumns({c: fill(c, v) for c, v in AWARD_PLACEHOLDERS.items() if c in df.columns})
    return df.withColumns({c: py_strip(F.col(c).cast("string")) for c in AWARD_TEXT if c in df.columns})


def coercion_report(raw: DataFrame, date_format: str | None = None,
                    required: list[str] | None = None) -> DataFrame:
    """One row of counts for the date coercion of ``clean_awards`` (C-04) and
    the rows missing a required field (N-07)."""
    dates = [c for c in AWARD_DATES if c in raw.columns]
    parsed = raw.select(*[F.col(c).alias(f"src_{c}") for c in dates],
                        *[coerce_timestamp(F.col(c).cast("string"), date_format).alias(f"dst_{c}")
                          for c in dates],
                        any_null(required or ["nominee"]).alias("__missing"))
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in dates:
        aggs += [F.count(f"src_{c}").alias(f"{c}_before"), F.count(f"dst_{c}").alias(f"{c}_after"),
                 count_coerced(f"src_{c}", f"dst_{c}").alias(f"{c}_coerced")]
    aggs.append(F.sum(F.col("__missing").cast("bigint")).alias("rows_missing_required"))
    out = parsed.agg(*aggs)
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in out.columns])


def normalize_counts(df: DataFrame, sentinel_columns=("subscriber_count",)) -> DataFrame:
    """E-12 / numeric part of E-03: coerce to bigint, truncating (C-02), -1 ->
    NULL on the hidden-able counter (N-06), NULL -> 0 (N-04)."""
    out = {}
    for c in CHANNEL_COUNTS:
        if c not in df.columns:
            continue
        v = coerce_long(c)
        if c in sentinel_columns:
            v = sentinel_to_null(v, -1)
        out[c] = fill(v, 0, "bigint")
    return df.withColumns(out) if out else df


def clean_channels(raw: DataFrame) -> DataFrame:
    """E-03: counts normalised (see ``normalize_counts``), text NULL->'' and
    trimmed; no row is removed."""
    df = normalize_counts(raw)
    return df.withColumns({c: strip_fill(F.col(c).cast("string")) for c in CHANNEL_TEXT if c in df.columns})
