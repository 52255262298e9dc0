"""Quality scores: histogram gradient-boosted trees over document statistics.

The trees are trained here, on at most ``TRAIN_ROWS`` labelled rows (the only
bound; those with the least hash of their id), flattened to arrays
and walked by all rows of a batch together. Statistics come from whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import chunks, mix, prepare, table, text_bytes, words

TRAIN_ROWS = 40_000
TREES, DEPTH, RATE, PENALTY, BINS = 80, 4, 0.15, 1.0, 64
ACCEPTED = 0.7
FOLDS, HELD = 4, 2

_KINDS = np.zeros(256, np.int8)  # classes of bytes
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r", b"\n", b".,;:'\"()-", b"!?", b"|",
                             b"#$%&*", b"<>{}[]\\/=_+~^`@", bytes(range(0x80, 0x100)))):
    _KINDS[list(_bytes)] = _k + 1
N_KINDS = int(_KINDS.max()) + 1
N_STATISTICS = N_KINDS + 11


def statistics(column: pa.Array) -> np.ndarray:
    """One row of numbers per text; of an empty one, zeros."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(column), N_STATISTICS), np.float32)
    for first, end, part, offs in chunks(data, offsets):
        n = end - first
        size = np.diff(offs)
        row_of = np.repeat(np.arange(n), size)
        kinds = _KINDS[part]
        counts = np.bincount(row_of * N_KINDS + kinds, minlength=n * N_KINDS).reshape(n, N_KINDS)
        starts, ends, row, hashed = words(part, offs)
        n_words = np.bincount(row, minlength=n)
        length = (ends - starts).astype(np.float64)
        at_least = np.maximum(n_words, 1)
        mean = np.bincount(row, length, n) / at_least
        spread = np.sqrt(np.maximum(np.bincount(row, length ** 2, n) / at_least - mean ** 2, 0))
        with np.errstate(over="ignore"):
            tagged = mix(hashed + (row.astype(np.uint64) << np.uint64(32)))
        order = np.argsort(tagged, kind="stable")
        new = np.append(True, tagged[order][1:] != tagged[order][:-1])[:len(order)]
        distinct = np.bincount(row[order][new], minlength=n)
        runs = np.diff(np.append(np.flatnonzero(new), len(order)))
        most = np.zeros(n)
        np.maximum.at(most, row[order][new], runs)
        twin = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
        twins = np.bincount(row[1:][twin], minlength=n)
        last, head = _KINDS[part[ends - 1]], _KINDS[part[starts]]
        odd_end = np.bincount(row[last > 6], minlength=n)
        capital = np.bincount(row[head == 2], minlength=n)
        single = np.bincount(row[length == 1], minlength=n)
        share = counts / np.maximum(size, 1)[:, None]
        out[first:end] = np.column_stack([
            share, np.log1p(size), np.log1p(n_words), mean, spread, distinct / at_least, most / at_least, twins / at_least,
            odd_end / at_least, capital / at_least, single / at_least, size / (counts[:, 5] + 1)])
    return out


class Forest:
    """Boosted trees as arrays: node ``k`` of a tree has children ``2k + 1``
    and ``2k + 2``; its last level holds the leaves' values."""

    def __init__(self, base: float, feature: np.ndarray, limit: np.ndarray, value: np.ndarray) -> None:
        self.base, self.feature, self.limit, self.value = base, feature, limit, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - (1 << DEPTH) + 1]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray) -> Forest:
    """Logistic loss, second-order gains, level by level on binned columns.
    Without rows every score is 0.5."""
    inner = (1 << DEPTH) - 1
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(rate / (1 - rate)))
    if not len(y):
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for k in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)])  # bin b: above edge b - 1, up to edge b
    n, columns = binned.shape
    flat = binned + np.arange(columns) * BINS
    total, forest = np.full(n, base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for depth in range(DEPTH):
            width = 1 << depth
            local = node - width + 1
            key = (local[:, None] * (columns * BINS) + flat).ravel()
            g = np.bincount(key, np.repeat(slope, columns), width * columns * BINS).reshape(width, columns, BINS).cumsum(axis=2)
            h = np.bincount(key, np.repeat(bend, columns), width * columns * BINS).reshape(width, columns, BINS).cumsum(axis=2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + PENALTY) + (gt - g) ** 2 / (ht - h + PENALTY) - gt ** 2 / (ht + PENALTY)
            gain[(h < 1) | (ht - h < 1)] = 0  # too little on one side
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                column, b = divmod(int(best[k]), BINS)
                if gain[k, column, b] > 1e-6 and b < len(edges[column]):
                    feature[width - 1 + k], limit[width - 1 + k] = column, edges[column][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > limit[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + PENALTY)
        total += value[leaf]
        forest.append((feature, limit, value))
    return Forest(base, *(np.array([t[k] for t in forest]) for k in range(3)))


def held_out(id_col) -> F.Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS)) == HELD


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(statistics(batch.column(1))), pa.list_(pa.float32()))], names=["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Forest:
    """Trees for ``labels.quality`` from the labelled rows outside the held-out
    fold. Labels that are null or have no document are ignored."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id"))
    chosen = known.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("label")).orderBy(
        F.xxhash64("label_id"), "label").limit(rows)
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))  # at most TRAIN_ROWS pairs of numbers
    got = own.select("label", "text").mapInArrow(_measure, "label double, x array<float>").toArrow()
    x = np.array(got["x"].to_pylist(), np.float32).reshape(got.num_rows, N_STATISTICS)
    y = got["label"].to_numpy()
    order = np.lexsort((*x.T, y))  # the same trees however rows arrive
    return train(x[order], y[order])


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts are scored like any other by their statistics
    (zeros); repeated rows get the same score; a null id is in no fold
    (held_out false); without labels every score is 0.5; other columns are
    ignored.
    """
    forest = fit(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(forest.score(statistics(batch.column(2))))], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", F.when(F.col("score") >= ACCEPTED, 1).otherwise(0))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document's quality score."""
    prepare(spark)
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_rejected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored under ``ACCEPTED`` go; rows and
    columns of the others stay as they are.

    Null and empty texts are scored by their statistics (zeros) and stay or go
    with that score; repeated rows share their fate; a null id changes nothing;
    columns of any name stay; without labels every score is 0.5 and all go; an
    empty table gives an empty one.
    """
    prepare(spark)
    forest = fit(docs, table(spark, sf_dir, "labels"))
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(forest.score(statistics(batch.column(place))) >= ACCEPTED))

    return docs.mapInArrow(keep, docs.schema)
