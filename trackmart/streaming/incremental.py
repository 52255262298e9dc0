"""Incremental channel-statistics lookup (E-09), checkpointed.

The reference keeps a CSV of finished lookups, computes the pending
artists (universe minus checkpoint), looks each one up, upserts the results
and rewrites the CSV. Here:

* the checkpoint is a ``BatchLog`` (one Parquet partition per batch,
  latest batch wins per artist), so a re-run of a failed batch replaces only
  its own partition and nothing being read is overwritten; with ``buckets``
  it is a ``KeyedStore``, where a batch reads only the buckets of its artists
  and old batches are compacted;
* pending artists are a left anti join; of these a batch takes the ones whose
  answers have landed (a status row of the batch, or without a status table a
  search answer), the others stay pending for a later batch;
* the lookups are joins against the landed responses (``plans.enrich``) and
  failures are tagged per artist;
* ``start_landed_stream`` drives the same batch from Structured Streaming:
  each micro-batch of newly landed lookup-status files becomes one batch,
  written with ``foreachBatch`` under the stream's own checkpoint, so a lost
  executor or driver resumes where it stopped (``availableNow`` trigger for
  scheduled runs). The landed tables are read anew in every micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.functions.columns import topic_query
from trackmart.operators.relational import pending_keys
from trackmart.plans.clean import normalize_counts
from trackmart.plans.enrich import assemble_lookup, one_status, tag_failures, two_tier_lookup
from trackmart.schemas import CHANNEL_SEARCH, CHANNEL_STATS, CHECKPOINT, LOOKUP_STATUS, VIDEO_STATS, VIDEOS
from trackmart.session import stored
from trackmart.sources.io import BatchLog
from trackmart.sources.keyed_store import KeyedStore


@dataclass
class LandedResponses:
    """The lookup service's answers, as tables."""
    search: DataFrame
    stats: DataFrame
    videos: DataFrame
    video_stats: DataFrame


def checkpoint_log(spark: SparkSession, root: str, buckets: int | None = None) -> BatchLog | KeyedStore:
    """The checkpoint of finished lookups, keyed by ``artist_query``: one folder
    a batch, or with ``buckets`` a compacted store for many batches."""
    if buckets:
        return KeyedStore(spark, root, CHECKPOINT, ["artist_query"], buckets)
    return BatchLog(spark, root, CHECKPOINT, ["artist_query"])


def pending_artists(universe: DataFrame, log: BatchLog | KeyedStore, batch_id: int) -> DataFrame:
    """Artists not finished by any batch before ``batch_id`` (J-04),
    excluding those whose earlier lookup failed: failures are recorded and
    never retried, as in the reference. Only earlier batches count, so a
    re-run or replay of batch ``batch_id`` sees the same pending set and
    rewrites the same partition."""
    artists = universe.select(F.col(universe.columns[0]).alias("artist_query"))
    return pending_keys(artists, log.earlier(batch_id, artists), "artist_query")


def landed_artists(todo: DataFrame, landed: LandedResponses, status: DataFrame | None) -> DataFrame:
    """The pending artists whose answers have landed: with a status table the
    artists it names, without one those that have a search answer."""
    if status is not None:
        names = status.select("artist_query")
    else:
        answered = landed.search.select("query")
        names = (todo.join(answered, F.col("artist_query") == F.col("query"), "left_semi")
                 .unionByName(todo.join(answered, topic_query(F.col("artist_query")) == F.col("query"), "left_semi")))
    return todo.join(names.distinct(), "artist_query", "left_semi")


def lookup_batch(universe: DataFrame, log: BatchLog | KeyedStore, landed: LandedResponses, batch_id: int,
                 status: DataFrame | None = None) -> DataFrame:
    """Results of batch ``batch_id``: pending artists with landed answers,
    enriched from the landed responses, failures tagged. ``status`` holds
    the outcomes of this batch."""
    outcome = one_status(status) if status is not None else None
    # landed first: of the checkpoint only what concerns these artists is needed
    artists = universe.select(F.col(universe.columns[0]).alias("artist_query"))
    todo = pending_artists(landed_artists(artists, landed, outcome), log, batch_id)
    # stored once: the two joins, two semi joins and the final join read it
    found = stored(two_tier_lookup(todo, landed.search).select("artist_query", "channel_id"), f"found-{batch_id}")
    results = assemble_lookup(todo, landed.search, landed.stats, landed.videos, landed.video_stats, found)
    return tag_failures(results, outcome) if outcome is not None else results


def run_batch(universe: DataFrame, log: BatchLog | KeyedStore, landed: LandedResponses, batch_id: int,
              status: DataFrame | None = None) -> DataFrame:
    """E-09: compute one batch, store it as partition ``batch_id``, and
    return the current checkpoint with counts normalised (SC-08). Of
    ``status`` only the rows of this batch count."""
    own = None if status is None else status.filter(F.col("batch_id") == batch_id)
    log.write_batch(lookup_batch(universe, log, landed, batch_id, own), batch_id)
    if isinstance(log, KeyedStore):
        log.compact()
    return current_results(log)


def current_results(log: BatchLog | KeyedStore) -> DataFrame:
    """Latest result per artist with the pre-load normalisation (E-12):
    counts NULL -> 0 and bigint, text NULL -> ''."""
    latest = log.read_latest().drop("batch_id")
    out = normalize_counts(latest)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ["channel_id_found", "channel_title_verified"]})


@dataclass
class LandedPaths:
    """Parquet folders of the landed answers and of the artists to look up.
    A frame keeps the file list it was made with, so a stream takes paths."""
    search: str
    stats: str
    videos: str
    video_stats: str
    universe: str

    def read(self, spark: SparkSession) -> tuple[DataFrame, LandedResponses]:
        schemas = {"search": CHANNEL_SEARCH, "stats": CHANNEL_STATS, "videos": VIDEOS, "video_stats": VIDEO_STATS}
        tables = {name: spark.read.schema(schema).parquet(getattr(self, name)) for name, schema in schemas.items()}
        return spark.read.parquet(self.universe), LandedResponses(**tables)


def start_landed_stream(spark: SparkSession, status_dir: str, paths: LandedPaths, log: BatchLog | KeyedStore,
                        stream_checkpoint: str | None = None, available_now: bool = True):
    """Run one batch for every micro-batch of lookup-status files landing in
    ``status_dir``. Batch id = micro-batch id + 1, and the stream checkpoint
    belongs to the log (default: next to it), so a replayed micro-batch
    recomputes the same pending set and overwrites its own partition
    (idempotent sink)."""
    stream = spark.readStream.schema(LOOKUP_STATUS).parquet(status_dir)
    stream_checkpoint = stream_checkpoint or f"{log.root}_stream_checkpoint"

    def each(batch: DataFrame, epoch_id: int) -> None:
        batch_id = int(epoch_id) + 1
        universe, landed = paths.read(batch.sparkSession)
        log.write_batch(lookup_batch(universe, log, landed, batch_id, batch), batch_id)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", stream_checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
