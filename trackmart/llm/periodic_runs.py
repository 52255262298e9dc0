"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period ``q`` and length
of at least ``max(LEAST, 3 * q)`` that no neighbouring word extends. All texts
of some megabytes are looked at together, end to end with a word of its own
after each, so every step is one over arrays.

* Periods under ``SMALL`` are separately detected: words are compared with
  those ``q`` further on. These give the highly periodic regions.
* Every dyadic scale ``t`` proposes the periods from ``2 * t`` to ``4 * t - 1``.
  Its synchronising set has the positions ``i`` whose hash of ``t`` words, or
  that of ``i + t``, is the least of the ``t + 1`` hashes from ``i`` on; hashes
  of stretches with a period of ``t / 3`` or less do not count. Membership
  depends on the ``2 * t`` words from ``i`` on only, so equal surroundings have
  equal members, and ``t`` positions without a member lie in a highly periodic
  region of ``3 * t - 1`` words.
* In a run of period ``q`` of that scale, a member among its first positions
  and its copy ``q`` further on have the same next ``3 * t`` words (``4 * t``
  for the upper half of the periods). As these are no fewer than ``q``, no
  other position between has them: neighbours among the members of equal
  context propose ``q``. If there is no such member, the run begins in a highly
  periodic region, which ends and comes again ``q`` further on; so neighbours
  among the ends of equal context propose too.

Every proposal is extended by comparing words, so hashes decide nothing. The
smallest period of a stretch is the least found for it, as a stretch of three
periods has the same ends under all of its periods.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import CRC32_SQL, SOLID, WORD, chunks, mix, prepare, table, text_bytes

LEAST = 24  # words of a run at least
SMALL = 8  # periods under this are detected by comparing
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words of rows laid end to end."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    solid = SOLID[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] = solid[edges]
    stops[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each begins."""
    sizes = ends - starts + 1
    at = np.append(0, np.cumsum(sizes))
    out = np.append(data, np.uint8(0x20))[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]
    out[at[1:] - 1] = 0x20
    return out, at


def word_codes(joined: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for every word; equal words, and no others, have the same."""
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(joined)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


# --- synchronising sets ------------------------------------------------------------

def _ahead(x: np.ndarray, n: int, fill: np.uint64) -> np.ndarray:
    """``x[i + n]``, ``fill`` beyond the end."""
    out = np.full(len(x), fill, np.uint64)
    if n < len(x):
        out[:len(x) - n] = x[n:]
    return out


def _both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(x * _ODD + mix(y + _ODD))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    step = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def synchronising_set(grams: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """Members of the set of scale ``t``: ``grams[i]`` is the hash of the ``t``
    words from ``i`` on, ``periodic`` where these have a small period."""
    own = np.where(periodic, _NONE, grams)
    low, width = own, 1
    while width < t:
        low = np.minimum(low, _ahead(low, width, _NONE))
        width *= 2
    last = _ahead(own, t, _NONE)
    low = np.minimum(low, last)
    return np.flatnonzero((low != _NONE) & ((low == own) | (low == last)))


def _neighbours(places: np.ndarray, keys: np.ndarray, t: int) -> list[tuple[int, int]]:
    """``(distance, place)`` of next places of equal key that a period of this
    scale apart; places ascend."""
    order = np.argsort(keys, kind="stable")
    at, key = places[order], keys[order]
    gap = at[1:] - at[:-1]
    hit = np.flatnonzero((key[1:] == key[:-1]) & (gap >= 2 * t) & (gap < 4 * t))
    return list(zip(gap[hit].tolist(), at[:-1][hit].tolist(), strict=True))


def _reach(same: np.ndarray) -> int:
    """How many of the first are true."""
    return len(same) if same.all() else int(same.argmin())


def _extend(seq: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The maximal stretch around ``i`` of words equal to those ``d`` ahead."""
    ahead = seq[d:]
    low = high = i
    step = 64
    while high < len(ahead):
        n = _reach(seq[high:high + step][:len(ahead) - high] == ahead[high:high + step])
        high += n
        if n < step:
            break
        step *= 2
    step = 64
    while low > 0:
        a = max(0, low - step)
        n = _reach((seq[a:low] == ahead[a:low])[::-1])
        low -= n
        if n < step:
            break
        step *= 2
    return low, high


def cubic_runs(seq: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``(start, end, period)`` of the maximal stretches of ``seq`` of three
    smallest periods or more; those of periods under ``SMALL`` of any length,
    others of 24 words or more. No text has more than ``longest`` words."""
    runs: list[tuple[int, int, int]] = []
    for q in range(1, SMALL):
        a, b = _stretches(seq[:-q] == seq[q:]) if len(seq) > q else (np.zeros(0, np.int64),) * 2
        keep = b - a >= 2 * q
        runs += [(s, e + q, q) for s, e in zip(a[keep].tolist(), b[keep].tolist(), strict=True)]
    t = SMALL // 2
    hashes = mix(seq.astype(np.uint64) + np.uint64(1))
    for width in (1, 2):
        hashes = _both(hashes, _ahead(hashes, width, np.uint64(0)))
    while 6 * t <= longest:
        two = _both(hashes, _ahead(hashes, t, np.uint64(0)))
        known = np.array(runs, np.int64).reshape(-1, 3)
        regions = known[(3 * known[:, 2] <= t) & (known[:, 1] - known[:, 0] >= t)]
        members = synchronising_set(hashes, _covered(len(seq), regions[:, 0], regions[:, 1] - t + 1), t)
        found = _neighbours(members, _both(two[members], _ahead(two, t, np.uint64(0))[members]), t)
        found += _neighbours(members, _both(two[members], _ahead(two, 2 * t, np.uint64(0))[members]), t)
        ends = np.unique(regions[regions[:, 1] - regions[:, 0] >= 3 * t - 1, 1])
        ends = ends[ends < len(seq)]
        found += _neighbours(ends, _both(two[ends - 2 * t], hashes[ends]), t)
        found += _neighbours(ends, _both(two[ends - 2 * t], two[ends]), t)
        period, upto = 0, 0
        for d, i in sorted(set(found)):
            if d == period and i < upto:
                continue  # in the stretch just found
            low, high = _extend(seq, i, d)
            period, upto = d, high
            if high - low >= 2 * d:
                runs.append((low, high + d, d))
        hashes, t = two, 2 * t
    out = np.array(runs, np.int64).reshape(-1, 3)
    out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
    first = np.append(True, np.any(out[1:, :2] != out[:-1, :2], axis=1))[:len(out)]
    return out[first]


# --- texts -------------------------------------------------------------------------

def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where and with which period the contract makes a text periodic."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _digests(ids: list, data: np.ndarray, offsets: np.ndarray, plant: bool, least: int) -> list[tuple]:
    """Result rows of texts laid end to end."""
    starts, ends, row = word_bounds(data, offsets)
    n_docs = len(offsets) - 1
    cuts = np.searchsorted(row, np.arange(n_docs + 1))
    source = np.arange(len(starts))
    for k, doc_id in enumerate(ids if plant else ()):
        made = planted(doc_id, int(cuts[k + 1] - cuts[k]))
        if made:
            a, p = made
            own = source[cuts[k] + a:cuts[k + 1]]
            own[:] = cuts[k] + a + np.arange(len(own)) % p
    joined, at = spaced(data, starts[source], ends[source])
    codes = word_codes(joined, at) if len(starts) else np.zeros(0, np.int64)
    seq = np.empty(len(codes) + n_docs, np.int64)
    place = np.arange(len(codes)) + row  # one word of its own after each text
    seq[place] = codes
    after = cuts[1:] + np.arange(n_docs)
    seq[after] = len(codes) + np.arange(n_docs)
    sizes = np.diff(cuts)
    runs = runs_of_texts(seq, after, sizes)
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, 3 * runs[:, 2])]
    gone = _covered(len(seq), runs[:, 0] + runs[:, 2], runs[:, 1])[place]
    doc = np.searchsorted(after, runs[:, 0], "right")
    spans = np.searchsorted(doc, np.arange(n_docs + 1))
    first = after - sizes  # of each text in seq
    raw, out = joined.tobytes(), []
    lost = np.append(0, np.cumsum(gone))[cuts]
    for k in range(n_docs):
        own = sorted((int(s - first[k]), int(e - s), int(q)) for s, e, q in runs[spans[k]:spans[k + 1]])
        best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        a, b = int(cuts[k]), int(cuts[k + 1])
        if lost[k + 1] == lost[k]:
            text = raw[at[a]:max(at[a], at[b] - 1)]
        else:
            keep = a + np.flatnonzero(~gone[a:b])
            text = spaced(joined, at[keep], at[keep + 1] - 1)[0].tobytes()[:-1]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(own, key=lambda r: (r[0], r[2])))
        out.append((len(own), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
    return out


def runs_of_texts(seq: np.ndarray, after: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``cubic_runs`` of texts laid end to end (``after``: the place of the word
    that parts each from the next). Texts of many words, which alone can have
    large periods, are looked at apart from the others."""
    out = []
    level = np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / 96))).astype(np.int64)
    for k in np.unique(level):
        some = np.flatnonzero(level == k)
        at = np.concatenate([np.arange(after[i] - sizes[i], after[i] + 1) for i in some.tolist()])
        runs = cubic_runs(seq[at], int(sizes[some].max()))
        runs[:, 1] = at[runs[:, 1] - 1] + 1
        runs[:, 0] = at[runs[:, 0]]
        out.append(runs)
    runs = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    return runs[np.argsort(runs[:, 0], kind="stable")]


_SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def _scan(plant: bool, least: int):
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for first, end, part, offsets in chunks(*text_bytes(batch.column(1))):
                rows += _digests(ids[first:end], part, offsets, plant, least)
            columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)
    return scan


def run_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, least: int = LEAST) -> DataFrame:
    """One row per input row: ``<id>, n_runs``, the run of greatest exponent
    (``start, length, period, exponent_milli``), ``runs_sha256`` of all runs and
    ``collapsed_sha256`` of the text with each run's repeats left out. With
    ``plant``, a tenth of the texts is made periodic first.

    A text is one unit of work, so memory follows the longest one. Null and
    empty texts and those without words have no run and four nulls; a null id
    is an id like others but is never planted; repeated rows give repeated
    rows; other columns are ignored, whatever their names; an empty table gives
    an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan(plant, least), _SCHEMA)
    return rows.withColumnRenamed("doc_id", id_col)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: runs of all documents, a tenth of them made periodic."""
    prepare(spark)
    return run_digest(table(spark, sf_dir, "documents"), plant=True)


SQL = rf"""
WITH docs AS (
  SELECT doc_id, {CRC32_SQL.format("doc_id")} AS h, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
sized AS (SELECT doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS planted, h // 10 AS g FROM docs),
placed AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM sized),
periods AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) END AS p FROM placed),
texts AS (
  SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                    ELSE words END AS words FROM periods),
word AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(words) AS w FROM texts),
same AS (  -- words that come again q further on
  SELECT x.doc_id, x.n, y.i - x.i AS q, x.i FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (
  SELECT doc_id, min(i) AS start, max(i) - min(i) + 1 + q AS length, q FROM islands GROUP BY doc_id, q, island
  HAVING max(i) - min(i) + 1 + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::HUGEINT * 1000000000000 // period DESC, start, period) AS k FROM runs) WHERE k = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS text FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i WHERE g.i IS NULL GROUP BY w.doc_id)
SELECT t.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l ON t.doc_id = l.doc_id LEFT JOIN best b ON t.doc_id = b.doc_id LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
