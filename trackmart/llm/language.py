"""Language identification by rank-order profiles of n-grams.

A language's profile is its ``PROFILE`` most frequent n-grams (1 to 3 symbols,
words padded with a boundary) over all learning texts. A document's
``DOCUMENT`` most frequent n-grams are compared with each profile by the
out-of-place distance: the sum of the differences of rank, and ``PROFILE`` for
an n-gram that the profile lacks.

Symbols are code points of the lower-cased text: one class per letter a to z,
``OTHER`` classes that all other letters and marks are hashed to, so that
languages of one script outside Latin are told apart by their letters, and one
for everything else.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart.llm.common import chunks, prepare, table, text_bytes
from trackmart.llm.quality import held_out

PROFILE, DOCUMENT = 600, 300
UNKNOWN = "und"
OTHER = 37  # classes of letters beyond a to z
_SIDE = 64
CODES = _SIDE ** 3 + _SIDE ** 2 + _SIDE  # trigrams, then bigrams, then letters


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point, made once per worker."""
    out = np.zeros(0x110000, np.uint8)
    for point in range(0x80, 0x110000):
        if unicodedata.category(chr(point))[0] in "LM":
            out[point] = 27 + (point * 2654435761 >> 7) % OTHER
    out[0x61:0x7B] = np.arange(1, 27)
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 rows laid end to end, and their rows' offsets."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    wide = np.concatenate([data, np.zeros(3, np.uint8)])
    first = data[lead]
    points = first.astype(np.int32)
    for low, high, mask, n in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        some = np.flatnonzero((first >= low) & (first < high))
        value = (first[some] & mask).astype(np.int32)
        for k in range(1, n + 1):
            value = value << 6 | (wide[lead[some] + k] & 0x3F)
        points[some] = value
    return points, np.searchsorted(lead, offsets)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all n-grams of lower-cased rows laid end to end, the rows they
    are of, and whether each row has a letter. None spans two rows or has a
    boundary inside."""
    n = len(offsets) - 1
    points, cuts = code_points(data, offsets)
    size = np.diff(cuts)
    # Rows apart: two boundaries before each and after the last.
    place = np.arange(len(points)) + 2 * np.repeat(np.arange(1, n + 1), size)
    symbols, row = np.zeros(len(points) + 2 * n + 2, np.int32), np.zeros(len(points) + 2 * n + 2, np.int32)
    symbols[place] = _classes()[points]
    row[place] = np.repeat(np.arange(n), size)
    a, b, c = symbols[:-2], symbols[1:-1], symbols[2:]
    three, two, one = np.flatnonzero((b > 0) & (a + c > 0)), np.flatnonzero((a > 0) | (b > 0)), np.flatnonzero(symbols > 0)
    codes = np.concatenate([(a[three] * _SIDE + b[three]) * _SIDE + c[three], _SIDE ** 3 + a[two] * _SIDE + b[two], _SIDE ** 3 + _SIDE ** 2 + symbols[one]])
    rows = np.concatenate([row[three + 1], np.maximum(row[two], row[two + 1]), row[one]])
    return codes, rows, np.bincount(row[one], minlength=n) > 0


def _lower(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pc.utf8_lower(column))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in totals.items():
            codes = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int32()), pa.array(counts[codes], pa.int64())],
                                             names=["lang", "code", "n"])
        totals.clear()

    for batch in batches:
        data, offsets = _lower(batch.column(1))
        langs = np.array(batch.column(0).to_pylist(), object)
        for first, end, part, offs in chunks(data, offsets):
            codes, rows, _ = grams(part, offs)
            names, which = np.unique(langs[first:end], return_inverse=True)
            counts = np.bincount(which[rows].astype(np.int64) * CODES + codes, minlength=len(names) * CODES).reshape(len(names), CODES)
            for name, own in zip(names, counts, strict=True):
                totals[name] = totals[name] + own if name in totals else own
        if len(totals) > 64:
            yield from flush()
    yield from flush()


def profiles(docs: DataFrame) -> dict[str, np.ndarray]:
    """For each language the codes of its most frequent n-grams in the order of
    their rank: ``PROFILE`` rows a language reach the driver."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    totals = learn.select(F.col("lang").cast("string"), "text").mapInArrow(_count, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")) - 1).where(F.col("rank") < PROFILE)
    found: dict[str, list] = {}
    for row in ranked.select("lang", "code", "rank").toArrow().to_pylist():
        found.setdefault(row["lang"], []).append((row["rank"], row["code"]))
    return {lang: np.array([code for _, code in sorted(own)], np.int32) for lang, own in sorted(found.items())}


def rank_table(known: dict[str, np.ndarray]) -> np.ndarray:
    """Languages by codes: the rank, ``PROFILE`` where the profile lacks it."""
    ranks = np.full((len(known), CODES), PROFILE, np.int16)
    for k, codes in enumerate(known.values()):
        ranks[k, codes] = np.arange(len(codes))
    return ranks


def predict(column: pa.Array, names: list[str], ranks: np.ndarray) -> tuple[list[str], np.ndarray]:
    data, offsets = _lower(column)
    labels, scores = [], np.zeros(len(column))
    for first, end, part, offs in chunks(data, offsets):
        codes, rows, lettered = grams(part, offs)
        order = np.argsort(rows, kind="stable")
        codes, cuts = codes[order], np.searchsorted(rows[order], np.arange(end - first + 1))
        for k in range(end - first):
            if not len(names) or not lettered[k]:
                labels.append(UNKNOWN)
                continue
            seen, counts = np.unique(codes[cuts[k]:cuts[k + 1]], return_counts=True)
            key = (counts.astype(np.int64) << 20) - seen  # by count, then by code
            if len(seen) > DOCUMENT:
                top = np.argpartition(key, len(key) - DOCUMENT)[-DOCUMENT:]
                seen, key = seen[top], key[top]
            seen = seen[np.argsort(-key)]
            own = ranks[:, seen].astype(np.int32)
            apart = np.abs(own - np.arange(len(seen)))
            apart[own == PROFILE] = PROFILE
            distance = apart.sum(axis=1)
            best = int(distance.argmin())
            labels.append(names[best])
            second = np.delete(distance, best).min() if len(names) > 1 else 1
            total = int(distance[best] + second)
            scores[first + k] = second / total if total and len(names) > 1 else 1.0 if len(names) == 1 else 0.5
    return labels, scores


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    ``score`` is the runner-up's share of the two least distances (0.5: a tie,
    resolved by name; 1: no other language or no distance). Null, empty and
    letterless texts are ``und`` with score 0, as is everything when nothing
    could be learned. A null id is in no fold. Other columns are ignored.
    """
    known = profiles(docs)
    names = list(known)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank_table(known)
        for batch in batches:
            labels, scores = predict(batch.column(2), names, ranks)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(labels, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the language of every document."""
    prepare(spark)
    return languages(table(spark, sf_dir, "documents"))
