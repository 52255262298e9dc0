"""E-10: the whole run — three extracts, three cleans, the merge, the
typed load with its row-count check — as one driver program building lazy
plans. The typed Parquet/table output is also the store step (SK-10).
Sources are read in parallel stages by Spark; nothing is handed between
processes; errors propagate instead of becoming empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.plans.clean import clean_awards, clean_channels, clean_tracks
from trackmart.plans.merge import merge_all, merge_report
from trackmart.schemas import AWARDS, AWARDS_RAW, CHANNELS, CHANNELS_RAW, MERGED, TRACKS
from trackmart.sources.io import BatchLog, EmptyInput, conform, read_csv, read_jdbc, read_table, write_table
from trackmart.sources.pushdown import read_database
from trackmart.streaming.incremental import current_results


@dataclass
class Source:
    """Where one input comes from: ``fmt`` is csv, parquet, table, jdbc or
    database (``SCHEMA.TABLE``, with aggregates pushed down). ``options``: for
    csv the arguments of ``read_csv`` (``multiline``, ``na_tokens``), for jdbc
    and database ``url`` and connection properties."""
    location: str
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        if self.fmt == "csv":
            return read_csv(spark, self.location, schema, **self.options)
        if self.fmt == "jdbc":
            if "url" not in self.options:
                raise ValueError(f"jdbc source {self.location!r} needs a url")
            df = read_jdbc(spark, self.options["url"], table=self.location,
                           properties={k: v for k, v in self.options.items() if k != "url"})
        else:
            df = read_table(spark, self.location, None if self.fmt == "table" else self.fmt)
        return conform(df, schema) if schema is not None else df


@dataclass
class RunConfig:
    tracks: Source
    output: str
    awards: Source | None = None
    channels: Source | None = None
    output_format: str = "parquet"
    output_jdbc: dict | None = None
    strict_count: bool = False


def extract_and_clean(spark: SparkSession, cfg: RunConfig) -> dict[str, DataFrame | None]:
    tracks = clean_tracks(cfg.tracks.read(spark, TRACKS))
    awards = clean_awards(cfg.awards.read(spark, AWARDS_RAW)) if cfg.awards else None
    if awards is not None:
        awards = conform(awards, AWARDS)
    channels = read_clean_channels(spark, cfg.channels) if cfg.channels else None
    return {"tracks": tracks, "awards": awards, "channels": channels}


def read_clean_channels(spark: SparkSession, source: Source) -> DataFrame:
    """Channel statistics (lookup results or their checkpoint) cleaned (E-03)."""
    raw = source.read(spark)
    raw = raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None)).try_cast(
        "string").alias(f.name) for f in CHANNELS_RAW.fields])  # counts as text: a double would lose digits
    return conform(clean_channels(raw), CHANNELS)


def build(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """The merged, typed table as a lazy plan."""
    parts = extract_and_clean(spark, cfg)
    merged = merge_all(tracks=parts["tracks"], awards=parts["awards"], channels=parts["channels"])
    return conform(merged, MERGED)


def report(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    parts = extract_and_clean(spark, cfg)
    return merge_report(tracks=parts["tracks"], awards=parts["awards"], channels=parts["channels"])


def run(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Build, write with the target schema, verify the count. Raises
    ``EmptyInput`` when there is nothing to load: an empty track source is
    caught before anything runs (a ``limit 1`` scan); tracks that cleaning
    removes entirely are caught by the count observed while writing, so the
    merge itself is computed only once."""
    if cfg.tracks.read(spark).isEmpty():
        raise EmptyInput(f"the track source {cfg.tracks.location} is empty")
    return write_table(build(spark, cfg), cfg.output, schema=MERGED, fmt=cfg.output_format,
                       jdbc=cfg.output_jdbc, strict=cfg.strict_count, empty_check="after")


# --- notebook steps: raw load, clean + typed load ---------------------------------

CLEANERS = {
    "tracks": (TRACKS, clean_tracks, TRACKS),
    "awards": (AWARDS_RAW, clean_awards, AWARDS),
    "channels": (None, None, CHANNELS),
}


def load_raw(spark: SparkSession, source: Source, target: str, mode: str = "overwrite",
             fmt: str = "parquet", jdbc: dict | None = None) -> DataFrame:
    """Raw load (SC-01..SC-03, SK-03/SK-04, SK-07): the CSV is split by
    Spark's file partitioning instead of a chunk loop and written once;
    returns the count check row."""
    return write_table(source.read(spark), target, mode=mode, fmt=fmt, jdbc=jdbc)


def clean_and_load(spark: SparkSession, kind: str, source: Source, target: str,
                   fmt: str = "parquet", jdbc: dict | None = None) -> DataFrame:
    """Clean one source and overwrite its typed clean table (SK-02) with the
    count check; ``kind`` is tracks, awards or channels."""
    raw_schema, cleaner, clean_schema = CLEANERS[kind]
    if kind == "channels":
        clean = read_clean_channels(spark, source)
    else:
        clean = cleaner(source.read(spark, raw_schema))
    return write_table(clean, target, schema=clean_schema, fmt=fmt, jdbc=jdbc)


def load_lookup_results(log: BatchLog, target: str, fmt: str = "parquet", jdbc: dict | None = None) -> DataFrame:
    """Typed overwrite of the current lookup results (SK-05) after their
    numeric normalisation (E-12), with the count check."""
    return write_table(current_results(log), target, schema=CHANNELS, fmt=fmt, jdbc=jdbc, strict=True)
