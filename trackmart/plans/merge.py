"""E-04: enrich tracks with channel statistics and award nominations.

Plan shape (see ``explain``): tracks ⟕ channels on ``artists =
artist_query`` -> ⟕ awards on ``(artists, track_name) = (artist,
nominee)`` -> latest row per ``track_id``.

Scale notes
-----------
* The awards side is reduced to its single best row per ``(artist,
  nominee)`` *before* the join. Because the final per-track order compares
  the award columns first, the row kept per track is the same as after the
  full 1:N fan-out, but the join becomes N:1: no fan-out, and a hot award
  key (a third of all nominations under one artist) is collapsed map-side
  by the partial window limit before it is shuffled.
* No broadcast hint: AQE broadcasts a side when its measured size is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a sort-merge
  join (with skew splitting) otherwise.
* Dedup per ``track_id`` uses ``row_number() = 1`` over a total order, so a
  partial ``WindowGroupLimit`` runs before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.functions.columns import coerce_int, fill, is_match
from trackmart.operators.relational import (add_defaults, latest_per_key, left_enrich,
                                            match_report, rename_present, select_present,
                                            total_order)
from trackmart.schemas import (AWARD_COLUMNS, AWARD_DEFAULTS, AWARD_KEYS, AWARD_RENAMES, CHANNEL_DEFAULTS,
                               TRACK_AWARD_KEYS)

DEFAULT_TIE_BREAK = ("track_genre", "album_name")


def _award_order() -> list[Column]:
    return [F.col("grammy_year").desc_nulls_last(), F.col("grammy_category").asc_nulls_last(),
            F.col("grammy_winner").desc_nulls_last()]


def join_channels(tracks: DataFrame, channels: DataFrame | None) -> DataFrame:
    """First join (J-01) or, without usable channels, constant defaults (J-03)."""
    if channels is None or "artist_query" not in channels.columns:
        return add_defaults(tracks, CHANNEL_DEFAULTS)
    if "artists" not in tracks.columns:
        raise KeyError("tracks have no 'artists' column to join channel statistics on")
    fills = {c: v for c, (v, _) in CHANNEL_DEFAULTS.items()}
    out = left_enrich(tracks, channels, ["artists"], ["artist_query"], suffix="_yt", fills=fills)
    counts = {c: F.col(c).try_cast("bigint") for c, (_, t) in CHANNEL_DEFAULTS.items()
              if t == "bigint" and c in out.columns}
    return out.withColumns(counts)


def prepare_awards(awards: DataFrame | None) -> DataFrame | None:
    """Select/rename the award fields; None when they cannot be joined."""
    if awards is None:
        return None
    sel = select_present(awards, AWARD_COLUMNS)
    if not sel.columns:
        return None
    sel = rename_present(sel, AWARD_RENAMES)
    if not all(k in sel.columns for k in AWARD_KEYS):
        return None
    if "grammy_year" not in sel.columns:
        raise KeyError("awards have join keys but no 'year' column to order nominations by")
    sel = add_defaults(sel, AWARD_DEFAULTS)
    return sel.withColumns({
        "grammy_year": coerce_int("grammy_year"),
        "grammy_category": fill(F.col("grammy_category").cast("string"), ""),
        "grammy_winner": fill(F.col("grammy_winner").cast("boolean"), False),
    })


def best_award_per_key(awards: DataFrame) -> DataFrame:
    """One row per ``(grammy_artist, grammy_nominee)``: the latest year, then
    category, then a win. Rows tied on all three are identical in output."""
    return latest_per_key(awards, AWARD_KEYS, _award_order(), complete_order=False)


def merge_all(*, tracks: DataFrame, awards: DataFrame | None = None,
              channels: DataFrame | None = None,
              tie_break: Sequence[str] = DEFAULT_TIE_BREAK) -> DataFrame:
    """Enriched track table (E-04). Arguments are keyword-only, so the
    three inputs cannot be passed in the wrong order.

    ``awards=None`` (or awards without rows, usable columns or keys; one
    ``limit 1`` probe) keeps every track row and adds ``grammy_year`` NULL, ``grammy_category`` '' and
    ``grammy_winner`` false without dedup; ``channels=None`` adds '' / 0
    channel columns.
    """
    if tracks is None:  # F-08: the base input is required; optional sides may be None
        raise ValueError("tracks are required")
    enriched = join_channels(tracks, channels)
    prepared = prepare_awards(awards)
    if prepared is None or not all(k in enriched.columns for k in TRACK_AWARD_KEYS) or prepared.isEmpty():
        return add_defaults(enriched, AWARD_DEFAULTS, overwrite=True)
    best = best_award_per_key(prepared)
    merged = left_enrich(enriched, best, TRACK_AWARD_KEYS, AWARD_KEYS, suffix="_grammy",
                         fills={"grammy_category": "", "grammy_winner": False})
    if "track_id" not in merged.columns:
        return merged
    lead = _award_order() + [F.col(c).asc_nulls_last() for c in tie_break if c in merged.columns]
    used = ["grammy_year", "grammy_category", "grammy_winner", *[c for c in tie_break if c in merged.columns]]
    order = total_order(merged.drop(*used), lead, exclude=["track_id"])
    return latest_per_key(merged, ["track_id"], order, complete_order=False)


def merge_report(*, tracks: DataFrame, awards: DataFrame | None = None,
                 channels: DataFrame | None = None) -> DataFrame:
    """Match rates of both joins (J-08), as the reference logs them: rows
    with a non-zero subscriber count after join 1, and rows with an award
    year after join 2 (counting the 1:N fan-out, before dedup); and the rows
    that share their ``track_id`` with another before the dedup (D-04). The
    fan-out is counted from per-key award counts, never materialised."""
    enriched = join_channels(tracks, channels)
    first = match_report(enriched, is_match("subscriber_count"), "channels")
    prepared = prepare_awards(awards)
    if prepared is None:
        return first
    per_key = prepared.groupBy(*AWARD_KEYS).agg(F.count(F.lit(1)).alias("__n"),
                                                 F.count("grammy_year").alias("__with_year"))
    keys = [*TRACK_AWARD_KEYS, *(["track_id"] if "track_id" in enriched.columns else [])]
    joined = left_enrich(enriched.select(*keys), per_key, TRACK_AWARD_KEYS, AWARD_KEYS)
    rows = F.coalesce(F.col("__n"), F.lit(1))
    second = joined.agg(F.coalesce(F.sum("__with_year"), F.lit(0)).cast("bigint").alias("matched_rows"),
                        F.sum(rows).cast("bigint").alias("total_rows")) \
                   .select(F.lit("awards").alias("join"), "matched_rows", "total_rows")
    out = first.unionByName(second)
    if "track_id" not in enriched.columns:
        return out
    per_track = joined.groupBy("track_id").agg(F.sum(rows).alias("n"))
    shared = per_track.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("matched_rows"),
                           F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"))
    return out.unionByName(shared.select(F.lit("shared_track_id").alias("join"), "matched_rows", "total_rows"))
