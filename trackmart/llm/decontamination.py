"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents.
2. Benchmark items, cut into passages, become TF-IDF rows; a distributed
   randomised SVD (random projection, one power iteration, each a pass over
   the passages that Spark sums by column) gives the latent space.
3. A copy that covers ``COVERED`` of a passage misses at most the rest, so
   of its rarest words, ``RARE_HITS`` more than it may miss, as many are there.
   Every word of every document is looked up among the rare words, and only
   stretches with so many of one passage near each other can hold a copy. Their
   windows are projected, and passages within a cosine are candidates.
   Passages are taken in blocks of bounded size.
4. A candidate counts if the longest common subsequence of words covers
   ``COVERED`` of the passage and ``ANSWERED`` of its answer (the last
   sentence, or the last quarter of the words where that is longer), or
   ``WHOLE`` of the passage whatever the answer, so that edited and
   paraphrased copies count and shared phrases do not.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import PLAIN, chunks, mix, prepare, row_key, spread, stored, table, text_bytes, words

WIDTH_BITS = 17  # hashed columns of the TF-IDF matrix: bounds what reaches the driver
RANK, EXTRA = 128, 16
PASSAGE, PASSAGE_STEP = 64, 32  # words
WINDOW, WINDOW_STEP = 32, 8
RARE_HITS = 3
REACH = 2 * PASSAGE + WINDOW  # at most so many words that are compared with a passage at a time
COSINE = 0.5
COVERED, ANSWERED = 0.7, 0.5
WHOLE = 0.9  # covered share that counts without the answer
SHORT = 13  # passages under so many words must be covered whole
BLOCK = 4096  # passages compared with all windows at a time
_SEED = 7_2024


def _column(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - WIDTH_BITS)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, rows = np.zeros(1 << WIDTH_BITS, np.int64), 0
    for batch in batches:
        rows += len(batch)
        for first, end, part, offs in chunks(*text_bytes(batch.column(0))):
            _, _, row, hashed = words(part, offs, PLAIN)
            seen = np.unique(row << WIDTH_BITS | _column(hashed))
            counts += np.bincount(seen & ((1 << WIDTH_BITS) - 1), minlength=1 << WIDTH_BITS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(counts[at], rows))], names=["column", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The weight of every hashed column, from all documents."""
    got = docs.select("text").mapInArrow(_frequencies, "column int, n long").groupBy("column").agg(F.sum("n").alias("n")).toArrow()
    column, n = got["column"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(1 << WIDTH_BITS)
    df[column[column >= 0]] = n[column >= 0]
    total = int(n[column == -1].sum())
    return np.log((total + 1) / (df + 1)).astype(np.float32) + np.float32(0.01)


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items, found, answers = [], [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            starts, _, _, hashed = words(raw, np.array([0, len(raw)]), PLAIN)
            if not len(hashed):
                continue
            ends = np.flatnonzero(np.isin(raw, np.frombuffer(b".!?\n", np.uint8)))
            ends = ends[ends < starts[-1]]  # sentence ends before the last word
            answer = int(np.searchsorted(starts, ends[-1])) if len(ends) else len(hashed)
            answer = min(answer, len(hashed) - -(-len(hashed) // 4))
            for at in range(0, max(1, len(hashed) - PASSAGE_STEP), PASSAGE_STEP):
                items.append(item)
                found.append(hashed[at:at + PASSAGE].view(np.int64))
                n = len(found[-1])
                # A passage that ends within the answer has a quarter of its words too.
                answers.append(n if answer - at >= n else min(max(answer - at, 0), n - -(-n // 4)))
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(answers, pa.int32())],
                                         names=["item_id", "words", "answer"])


def _rows(lists: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """TF-IDF rows of unit length as triples (row, column, value)."""
    rows, columns, values = [], [], []
    for k, own in enumerate(lists):
        column, n = np.unique(_column(np.asarray(own, np.int64).view(np.uint64)), return_counts=True)
        value = n * weights[column]
        rows.append(np.full(len(column), k))
        columns.append(column)
        values.append(value / max(np.linalg.norm(value), 1e-12))
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


def _signs(columns: np.ndarray, k: int) -> np.ndarray:
    """A random projection of +-1 that every task makes alike."""
    with np.errstate(over="ignore"):
        cell = columns.astype(np.uint64)[:, None] * np.uint64(k) + np.arange(k, dtype=np.uint64) + np.uint64(_SEED)
    return np.where(mix(cell) >> np.uint64(63), 1.0, -1.0)


def _pass(passages: DataFrame, weights: np.ndarray, k: int, basis: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Columns and rows of A'A times the basis (a random one at first)."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, column, value = _rows(batch.column(0).to_pylist(), weights)
            used, which = np.unique(column, return_inverse=True)
            if basis is None:
                own = _signs(used, k)
            else:
                place = np.minimum(np.searchsorted(basis[0], used), len(basis[0]) - 1)
                own = np.where((basis[0][place] == used)[:, None], basis[1][place], 0)
            y = np.zeros((len(batch), k))
            np.add.at(y, row, value[:, None] * own[which])
            z = np.zeros((len(used), k))
            np.add.at(z, which, value[:, None] * y[row])
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(list(z), pa.list_(pa.float64()))], names=["column", "z"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for column, z in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                z = np.asarray(z.values)
                sums[column] = sums[column] + z if column in sums else z
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([z.astype(np.float32) for z in sums.values()], pa.list_(pa.float32()))], names=["column", "z"])

    parts = passages.select("words").mapInArrow(multiply, "column int, z array<double>")
    got = parts.repartition(spread(passages), "column").mapInArrow(total, "column int, z array<float>").toArrow()  # at most 2 ** WIDTH_BITS rows
    column = got["column"].to_numpy()
    z = np.array(got["z"].to_pylist(), np.float64).reshape(len(column), k)
    order = np.argsort(column)
    return column[order], z[order]


def latent_basis(passages: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns the passages use and their coordinates in the latent space."""
    k = RANK + EXTRA
    columns, z = _pass(passages, weights, k, None)
    if not len(columns):
        return columns, np.zeros((0, 1), np.float32)
    q, _ = np.linalg.qr(z)
    if q.shape[1] < k:
        q = np.column_stack([q, np.zeros((len(q), k - q.shape[1]))])
    columns, z = _pass(passages, weights, k, (columns, q))
    left, values, _ = np.linalg.svd(z, full_matrices=False)
    kept = min(RANK, int((values > values[0] * 1e-6).sum()))
    return columns, left[:, :kept].astype(np.float32)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (by its matches)."""
    where: dict[int, list[int]] = {}
    for k, w in enumerate(b.tolist()):
        where.setdefault(w, []).append(k)
    tails: list[int] = []
    for w in a.tolist():
        for k in reversed(where.get(w, ())):
            at = bisect_left(tails, k)
            if at == len(tails):
                tails.append(k)
            else:
                tails[at] = k
    return len(tails)


class _RareWords:
    """The rarest words of a block of passages, and how many of a passage's a
    copy has at least."""

    def __init__(self, block: list[np.ndarray], weights: np.ndarray) -> None:
        keys, owners, self.need = [], [], np.zeros(len(block), np.int64)
        self.reach = np.array([WINDOW + 2 * len(own) for own in block])
        for p, own in enumerate(block):
            own = own.view(np.uint64)
            missed = int(len(own) * (1 - COVERED) + 1e-9) if len(own) >= SHORT else 0
            self.need[p] = min(len(own) - missed, RARE_HITS)
            rare = np.unique(own[np.lexsort((own, -weights[_column(own)]))[:missed + self.need[p]]])
            keys.append(rare)
            owners.append(np.full(len(rare), p))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.table = np.zeros(1 << 24, bool)
        self.table[(self.keys >> np.uint64(40)).astype(np.int64)] = True

    def stretches(self, hashed: np.ndarray, row: np.ndarray) -> list[tuple[int, int, int]]:
        """Word ranges, each within a row, that can hold a copy, and of which
        passage."""
        hits = np.flatnonzero(self.table[(hashed >> np.uint64(40)).astype(np.int64)])
        first = np.searchsorted(self.keys, hashed[hits], "left")
        n = np.searchsorted(self.keys, hashed[hits], "right") - first
        ends = np.cumsum(n)
        if not len(ends) or not ends[-1]:
            return []
        owner = self.owners[np.repeat(first - ends + n, n) + np.arange(ends[-1])]
        place = np.repeat(hits, n)
        order = np.lexsort((place, owner))
        owner, place = owner[order], place[order]
        apart = place + row[place] * (REACH + 1)  # rows are never near each other
        last = np.arange(len(owner)) + self.need[owner] - 1
        inside = np.minimum(last, len(owner) - 1)
        near = (last < len(owner)) & (owner[inside] == owner) & (apart[inside] - apart < self.reach[owner])
        a, b, owner, reach = place[near], place[inside[near]], owner[near], self.reach[owner[near]]
        if not len(a):
            return []
        edges = np.searchsorted(row, row[a], "left"), np.searchsorted(row, row[a], "right")
        lo, hi = np.maximum(b - reach, edges[0]), np.minimum(a + reach, edges[1])
        # By passage and place already: join what overlaps.
        new = np.flatnonzero(np.append(True, (lo[1:] > hi[:-1]) | (owner[1:] != owner[:-1]) | (row[lo[1:]] != row[lo[:-1]])))
        return list(zip(lo[new].tolist(), hi[np.append(new[1:] - 1, len(hi) - 1)].tolist(), owner[new].tolist(), strict=True))


def _matcher(weights: np.ndarray, columns: np.ndarray, basis: np.ndarray, block: list[dict]):
    item_words = [np.array(p["words"], np.int64) for p in block]
    rank = basis.shape[1]

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = _RareWords(item_words, weights)
        where = np.full(1 << WIDTH_BITS, len(columns))
        where[columns] = np.arange(len(columns))
        coordinates = np.concatenate([basis, np.zeros((1, rank), np.float32)])

        def project(own: np.ndarray) -> np.ndarray:
            column = _column(own.view(np.uint64))
            return weights[column][:, None] * coordinates[where[column]]

        items = unit(np.array([project(w).sum(axis=0) for w in item_words]))

        def compared(own: np.ndarray, p: int) -> Iterator[tuple]:
            want = item_words[p]
            start = np.arange(0, max(1, len(own) - WINDOW + WINDOW_STEP), WINDOW_STEP)
            stop = np.minimum(start + WINDOW, len(own))
            run = np.concatenate([np.zeros((1, rank)), np.cumsum(project(own), axis=0, dtype=np.float64)])
            near = unit(run[stop] - run[start]) @ items[p]
            for w in np.flatnonzero(near >= COSINE).tolist():
                segment = own[max(0, int(start[w]) - len(want)):int(stop[w]) + len(want)]
                covered = common_subsequence(want, segment) / len(want)
                if covered < (COVERED if len(want) >= SHORT else 1.0):
                    continue
                answer = want[block[p]["answer"]:]
                answered = common_subsequence(answer, segment) / len(answer) if len(answer) else 1.0
                if answered >= ANSWERED or covered >= WHOLE:
                    yield block[p]["item_id"], float(near[w]), covered, answered, int(start[w])

        for batch in batches:
            out, names = [], batch.column(0)
            for first, _, part, offs in chunks(*text_bytes(batch.column(1))):
                _, _, row, hashed = words(part, offs, PLAIN)
                for lo, hi, p in rare.stretches(hashed, row):
                    doc, begin = names[first + int(row[lo])].as_py(), int(np.searchsorted(row, row[lo]))
                    for at in range(lo, hi, 4096):  # long stretches in overlapping pieces
                        for item, cosine, covered, answered, word in compared(hashed[at:min(hi, at + 4096 + 2 * REACH)].view(np.int64), p):
                            out.append((doc, item, cosine, covered, answered, at - begin + word))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 6, kinds, strict=True)],
                                             names=["doc_id", "item_id", "cosine", "covered", "answered", "word"])
    return match


FOUND = "doc_id long, item_id long, cosine double, covered double, answered double, word long"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id,
    item_id``, the best ``covered`` share of a passage with its ``answered``
    share and ``cosine``, and the ``word`` its window starts at.

    Null, empty and wordless texts match nothing, nor do such items; repeated
    rows of one id are one document; documents with a null id are left out
    (they can't be named; the pipeline's stage gives them a key), items with a
    null id are searched and named null; other columns are ignored; without
    documents or items there are no rows.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    passages = items.mapInArrow(_passages, "item_id long, words array<long>, answer int").dropDuplicates()
    passages = stored(passages.withColumn("place", F.monotonically_increasing_id()), "passages")
    weights = inverse_frequencies(rows)
    columns, basis = latent_basis(passages, weights)
    found = None
    order, last = passages.orderBy("place"), -1
    while block := order.where(F.col("place") > last).limit(BLOCK).toArrow().to_pylist():
        hits = rows.mapInArrow(_matcher(weights, columns, basis, block), FOUND)
        found = hits if found is None else found.unionByName(hits)
        last = block[-1]["place"]
    if found is None:
        return spark.createDataFrame([], FOUND)
    best = F.max(F.struct("covered", "answered", "cosine", F.negative("word").alias("back"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.covered", "best.answered", "best.cosine", F.negative("best.back").alias("word"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    prepare(spark)
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a benchmark item go, the others stay as
    they are.

    Rows of one id go together; rows without an id go by their own texts. Null,
    empty and wordless texts stay; repeated rows stay repeated; other columns
    stay, whatever their names; an empty table gives an empty one.
    """
    prepare(spark)
    found = contaminated(docs.select(row_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias("__row_key")).distinct()
    return docs.join(found, row_key() == found["__row_key"], "left_anti")
