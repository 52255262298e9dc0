"""Token counts as a delta-maintained rollup.

A rollup is a folder of committed batches. Every batch is a set of changes
to what documents count under a tokenizer version: an insert, a delete, or a
revised count. A commit turns changes into signed entries against the entries
so far (a revision is the old entry with a minus and the new one with a plus)
and adds up what they change by source, language and version. Totals are the
sum of these small tables: no commit reads all counts again to make them.

A batch takes effect once: its totals are written after its entries by one
Spark write whose ``_SUCCESS`` mark is the commit. A commit of a batch that
has the mark does nothing; without the mark both parts are written anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import prepare, stored, table, text_bytes
from trackmart.llm.tokens import WORD_BPE, encoder, vocabulary
from trackmart.session import scratch_path

KEY = ("doc_id", "tokenizer")
GROUP = ("source", "lang", "tokenizer")
ENTRIES = "doc_id long, tokenizer string, source string, lang string, n_docs long, n_tokens long"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
CHANGES = "op string, doc_id long, tokenizer string, source string, lang string, n_tokens long"
WORDS_VERSION = "words-1"


class TokenRollup:
    """The rollup in folder ``path``, which driver and executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _batches(self, part: str) -> list[str]:
        """Folders of committed batches (one name per commit)."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        names = [x.getPath() for x in files.listStatus(root)]
        done = [p.getName() for p in names if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(f"{self.path}/{part}/{n}" for n in done)

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = self._batches(part)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def state(self) -> DataFrame:
        """What each document counts now: ``doc_id, tokenizer, source, lang, n_tokens``."""
        entries = self._read("entries", ENTRIES)
        return entries.groupBy(*KEY, "source", "lang").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs > 0")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` of the groups that have documents."""
        every = self._read("totals", TOTALS).groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return every.where("n_docs > 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (columns of ``CHANGES``; others are ignored) as
        ``batch``; False if that batch was committed before.

        Per document and version a batch has one change: repeated rows count
        once, of different ones the greatest by (op, count, source, lang)
        holds ("revise" over "insert" over "delete"). An insert of a known
        document is a revision, a revision of an unknown one an insert, a
        delete of an unknown one nothing. A null count is 0, a null op an
        insert; null ids, sources, languages and versions are values like others.
        """
        if f"{self.path}/totals/{batch}" in self._batches("totals"):
            return False
        picked = changes.select(*[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in CHANGES.split(", ")])
        picked = picked.withColumns({"op": F.coalesce(F.lower("op"), F.lit("insert")), "n_tokens": F.coalesce("n_tokens", F.lit(0))})
        new = picked.groupBy(*KEY).agg(F.max(F.struct("op", "n_tokens", "source", "lang")).alias("new"))
        old = self.state().select(*[F.col(c).alias(f"old_{c}") for c in KEY], F.struct("source", "lang", "n_tokens").alias("old"))
        met = new.join(old, [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in KEY], "left")
        minus = met.where("old is not null").select(*KEY, "old.source", "old.lang", F.lit(-1).cast("long").alias("n_docs"), (-F.col("old.n_tokens")).alias("n_tokens"))
        plus = met.where("new.op != 'delete'").select(*KEY, "new.source", "new.lang", F.lit(1).cast("long").alias("n_docs"), F.col("new.n_tokens").alias("n_tokens"))
        minus.unionByName(plus).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/entries/{batch}")
        entries = self.spark.read.schema(ENTRIES).parquet(f"{self.path}/entries/{batch}")
        sums = entries.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs != 0 or n_tokens != 0")
        sums.write.mode("overwrite").parquet(f"{self.path}/totals/{batch}")
        return True


def _counter(path: str):
    ready = encoder(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ready()
        for batch in batches:
            tokens, n_words = encode.counts(*text_bytes(batch.column(3)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(tokens), pa.array(n_words)],
                names=["doc_id", "source", "lang", "tokens", "words"])
    return count


def document_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, source, lang, tokens, words`` of every row (null text: empty)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")
    return rows.mapInArrow(_counter(path or vocabulary()), "doc_id long, source string, lang string, tokens long, words long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and version after four commits over all
    documents (rows of one id, and all without one, are one document): a load of word counts, an upgrade that deletes them and inserts
    word counts as drafts of the BPE version, the BPE counts as revisions, and
    the load once more (without effect)."""
    prepare(spark)
    counts = stored(document_counts(table(spark, sf_dir, "documents")), "token-counts")
    rollup = TokenRollup(spark, scratch_path(spark, "rollup"))
    version = WORD_BPE.rpartition(".")[0]

    def changes(op: str, tokenizer: str, count: str) -> DataFrame:
        return counts.select(F.lit(op).alias("op"), "doc_id", F.lit(tokenizer).alias("tokenizer"), "source", "lang", F.col(count).alias("n_tokens"))

    load = changes("insert", WORDS_VERSION, "words")
    rollup.commit("0001-load", load)
    rollup.commit("0002-upgrade", changes("delete", WORDS_VERSION, "words").unionByName(changes("insert", version, "words")))
    rollup.commit("0003-recount", changes("revise", version, "tokens"))
    rollup.commit("0001-load", load)
    return rollup.totals()
