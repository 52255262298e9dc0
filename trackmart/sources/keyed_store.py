"""A keyed table of batches with bucketed deltas and compaction (SK-06, SC-08,
D-06): the checkpoint of finished lookups where batches are many.

Rows are dealt to ``buckets`` by a hash of their key. A batch is one folder
with a sub-folder per bucket that it has rows for; a manifest names the live
folders and buckets, and its commit is what makes a batch visible. Of a key
the row of the greatest batch counts.

* Reading some keys touches only their buckets; a batch writes only its own.
* ``compact`` merges the buckets that have gathered many deltas into a base
  and may run beside readers and writers: they keep their snapshot, and it
  commits only if what it merged is still live.
* A batch that is run again replaces its own delta. Once compacted it is
  sealed: running it again changes nothing.
* ``vacuum`` deletes folders that no kept manifest names.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.operators.relational import latest_per_key
from trackmart.sources.io import conform
from trackmart.sources.manifest import CommitConflict, Manifest

RETRIES = 20


class KeyedStore:
    """``schema`` has ``batch_id``; ``keys`` are columns of it. NULL keys are
    keys like others. Of several rows of one key in a batch the first under
    the order of all other columns counts. The number of buckets is fixed when
    the store is made: choose it so that a bucket is a task's work (some
    hundred MB)."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)
        self._rows = T.StructType([f for f in schema.fields if f.name != "batch_id"])
        self.manifest = Manifest(spark, self.root)
        state = self.manifest.current()[1]
        if state is not None and state["keys"] != self.keys:
            raise ValueError(f"{root} is keyed by {state['keys']}")
        self.buckets = state["buckets"] if state is not None else buckets

    # A segment is a folder, the batch it holds (None: a base) and its live buckets.

    def state(self) -> tuple[int, dict]:
        version, state = self.manifest.current()
        return version, state or {"buckets": self.buckets, "keys": self.keys, "sealed": None, "segments": []}

    def bucket(self, columns: list[str] | None = None) -> Column:
        """The bucket of a key, from its own columns or from ``columns``."""
        own = [F.col(c).cast(self.schema[k].dataType) for k, c in zip(self.keys, columns or self.keys, strict=True)]
        return F.pmod(F.xxhash64(*own), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """Rows to a fresh folder, one sub-folder a bucket; the buckets made."""
        name = uuid.uuid4().hex
        dealt = rows.withColumn("bucket", self.bucket())
        dealt.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/data/{name}")
        made = [int(f.split("=")[1]) for f in self.manifest.folders(f"data/{name}") if f.startswith("bucket=")]
        return name, sorted(made)

    def _commit(self, change) -> bool:
        """Apply ``change(state)`` to the newest state until it commits; a
        change that gives None is void."""
        for _ in range(RETRIES):
            version, state = self.state()
            state = change(state)
            if state is None:
                return False
            try:
                self.manifest.commit(version, state)
                return True
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.root}: {RETRIES} commits of others came first")

    def write_batch(self, df: DataFrame, batch_id: int) -> bool:
        """Store a batch, replacing what it stored before; an empty one clears
        it. False if the batch is sealed."""
        batch_id = int(batch_id)
        sealed = self.state()[1]["sealed"]
        if sealed is not None and batch_id <= sealed:
            return False
        rows = conform(df, self._rows).withColumn("batch_id", F.lit(batch_id).cast(self.schema["batch_id"].dataType))
        name, made = self._write(latest_per_key(conform(rows, self.schema), self.keys, []))

        def change(state: dict) -> dict | None:
            if state["sealed"] is not None and batch_id <= state["sealed"]:
                return None
            segments = [s for s in state["segments"] if s["batch"] != batch_id]
            return {**state, "segments": segments + ([{"folder": name, "batch": batch_id, "buckets": made}] if made else [])}
        return self._commit(change)

    def _paths(self, state: dict, buckets: set[int] | None = None, before: int | None = None) -> list[str]:
        return [f"{self.root}/data/{s['folder']}/bucket={b}" for s in state["segments"]
                if before is None or s["batch"] is None or s["batch"] < before
                for b in s["buckets"] if buckets is None or b in buckets]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read_all(self) -> DataFrame:
        """Every live row, older ones of a key included until compaction."""
        return self._read(self._paths(self.state()[1]))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, [F.col("batch_id").desc()])

    def read_latest(self) -> DataFrame:
        """The row of the greatest batch of every key."""
        return self._latest(self.read_all())

    def touched(self, wanted: DataFrame, columns: list[str] | None = None) -> set[int]:
        """The buckets of the keys in ``wanted``: at most ``buckets`` numbers."""
        return {r[0] for r in wanted.select(self.bucket(columns).alias("b")).distinct().collect()}

    def earlier(self, batch_id: int, wanted: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """Rows of batches before ``batch_id`` in the buckets of ``wanted``."""
        rows = self._read(self._paths(self.state()[1], self.touched(wanted, columns), int(batch_id)))
        return rows.filter(F.col("batch_id") < int(batch_id))

    def lookup(self, wanted: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """The latest row of each key in ``wanted`` (its ``columns``, in the
        order of the keys); only their buckets are read."""
        columns = columns or self.keys
        rows = self._read(self._paths(self.state()[1], self.touched(wanted, columns)))
        names = {c: f"__w{i}" for i, c in enumerate(columns)}
        asked = wanted.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
        cond = None
        for k, n in zip(self.keys, names.values(), strict=True):
            e = F.col(k).eqNullSafe(F.col(n))
            cond = e if cond is None else cond & e
        return self._latest(rows.join(asked, cond, "left_semi"))

    def deltas(self) -> Counter:
        """How many deltas each bucket has."""
        return Counter(b for s in self.state()[1]["segments"] if s["batch"] is not None for b in s["buckets"])

    def compact(self, least: int = 4) -> int:
        """Merge the buckets that have ``least`` deltas or more into one base;
        returns how many. The batches merged are sealed. 0 if a batch that was
        merged was run again meanwhile; then nothing changes."""
        _, state = self.state()
        full = {b for b, n in self.deltas().items() if n >= least}
        if not full:
            return 0
        merged = {(s["folder"], b) for s in state["segments"] for b in s["buckets"] if b in full}
        upto = max(s["batch"] for s in state["segments"] if s["batch"] is not None)
        name, made = self._write(self._latest(self._read(self._paths(state, full))))

        def change(now: dict) -> dict | None:
            live = {(s["folder"], b) for s in now["segments"] for b in s["buckets"]}
            if not merged <= live:
                return None
            kept = [{**s, "buckets": [b for b in s["buckets"] if (s["folder"], b) not in merged]} for s in now["segments"]]
            return {**now, "sealed": max(upto, now["sealed"] if now["sealed"] is not None else upto),
                    "segments": [{"folder": name, "batch": None, "buckets": made}] + [s for s in kept if s["buckets"]]}
        return len(full) if self._commit(change) else 0

    def vacuum(self, keep: int = 8) -> int:
        """Forget all but the newest ``keep`` states and delete the folders that
        none of them names. Not beside a running write, whose folder is not
        named yet. Returns how many folders went."""
        named = {s["folder"] for state in self.manifest.forget(keep) for s in state["segments"]}
        gone = [f for f in self.manifest.folders("data") if f not in named]
        for f in gone:
            self.manifest.remove(f"data/{f}")
        return len(gone)
