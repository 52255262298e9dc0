"""Atomic publish (SK-01, SK-02, SK-05): a table whose versions become visible
by one manifest commit, after their rows were written and counted.

A load that fails, dies, or is empty leaves the version before it as it was,
and readers of an older version finish with it. ``swap_path`` and
``swap_table`` do the like for plain folders and catalog tables, which have no
manifest: the new table is complete and checked before the old one goes, but
the swap is two renames.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.sources.manifest import CommitConflict, Manifest


class EmptyInput(ValueError):
    """Raised instead of silently writing or merging an empty table."""


class PublishedTable:
    """A Parquet table at ``root`` that is replaced or appended to atomically."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, self.root)

    def publish(self, df: DataFrame, schema: T.StructType | None = None, mode: str = "overwrite", allow_empty: bool = False) -> int:
        """Write ``df`` as the next version and return its number.

        Rows go to a folder of their own and are counted while written and
        again from storage; ``EmptyInput`` or ``RuntimeError`` leave the table
        as it was. An append names the folders of the version before it too,
        and is applied again if another writer committed meanwhile; a replace
        is too, so the last one to finish wins.
        """
        if mode not in ("overwrite", "append"):
            raise ValueError(f"mode {mode!r}")
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        version, state = self.manifest.current()
        kind = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        if mode == "append" and state is not None and T.StructType.fromJson(state["schema"]) != kind:
            raise ValueError(f"{self.root} has other columns")
        name, watch = uuid.uuid4().hex, Observation(f"publish_{uuid.uuid4().hex[:8]}")
        try:
            df.observe(watch, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/data/{name}")
            written = watch.get.get("rows", 0)
            if not written and not allow_empty:
                raise EmptyInput(f"nothing to publish to {self.root}")
            rows = self.spark.read.schema(kind).parquet(f"{self.root}/data/{name}").count()
            if rows != written:
                raise RuntimeError(f"{self.root}: wrote {written} rows, found {rows}")
        except Exception:
            self.manifest.remove(f"data/{name}")
            raise
        while True:
            before = state["parts"] if mode == "append" and state is not None else []
            new = {"schema": kind.jsonValue(), "parts": before + [{"folder": name, "rows": rows}]}
            try:
                return self.manifest.commit(version, new)
            except CommitConflict:
                version, state = self.manifest.current()

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or a kept older one."""
        state = self.manifest.read(version) if version is not None else self.manifest.current()[1]
        if state is None:
            raise FileNotFoundError(f"{self.root} has no version")
        return self.spark.read.schema(T.StructType.fromJson(state["schema"])).parquet(*[f"{self.root}/data/{p['folder']}" for p in state["parts"]])

    def rows(self, version: int | None = None) -> int:
        """Counted rows of a version, from its manifest."""
        state = self.manifest.read(version) if version is not None else self.manifest.current()[1]
        return sum(p["rows"] for p in state["parts"]) if state else 0

    def history(self) -> DataFrame:
        """``(version, rows, parts)`` of the kept versions."""
        states = [(v, self.manifest.read(v)) for v in self.manifest.versions()]
        return self.spark.createDataFrame([(v, sum(p["rows"] for p in s["parts"]), len(s["parts"])) for v, s in states],
                                          "version bigint, rows bigint, parts bigint")

    def vacuum(self, keep: int = 2) -> int:
        """Forget all but the newest ``keep`` versions and delete folders that
        none of them names, those of failed loads too; not beside a running
        load. Returns how many folders went."""
        named = {p["folder"] for s in self.manifest.forget(keep) for p in s["parts"]}
        gone = [f for f in self.manifest.folders("data") if f not in named]
        for f in gone:
            self.manifest.remove(f"data/{f}")
        return len(gone)


def swap_path(spark: SparkSession, staged: str, target: str) -> None:
    """Put the finished folder ``staged`` in the place of ``target``. The old
    one is renamed aside, and back if the second rename fails."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    new, at, old = make(staged), make(target), make(f"{target.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise RuntimeError(f"{target} can't be renamed")
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise RuntimeError(f"{staged} can't be renamed to {target}")
    if had:
        fs.delete(old, True)


def swap_table(spark: SparkSession, staged: str, target: str) -> None:
    """The same for catalog tables."""
    old = f"{target}__old_{uuid.uuid4().hex[:8]}"
    had = spark.catalog.tableExists(target)
    if had:
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {target}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")
