"""Removal of repeated byte strings by column-wise multi-document sorting.

What is found: every byte covered by a string of ``length`` bytes that also
starts anywhere else in the collection.

Method. A column-wise construction inserts one symbol of every document per
round and updates the collection's order and its common prefixes from the
round before. Done on whole documents, that takes as many rounds as the
longest document has bytes and one order of the whole collection, so the
collection is first cut into blocks that can be built apart without losing a
repeat:

1. In every window of ``length`` bytes the least hash of its ``GRAM``-byte
   substrings picks an anchor. Equal windows pick the same anchor at the same
   place, so every repeat shows as an anchor hash that occurs twice. (This
   pass sees all windows of all bytes.)
2. The text around each repeated anchor (all windows over it, less than
   ``2 * length`` bytes) is digested; equal ones are counted, which settles
   their windows, and one of each goes on.
3. Groups of an anchor that still have different texts are cut out and dealt by
   the anchor hash. In a block the cuts, aligned at their anchors, are the
   documents of the column-wise construction: from the last column to the
   first, one symbol of each is put before its suffix, the suffix order
   follows by one stable sort on that symbol, and the common prefix of
   neighbours is one more than the least common prefix between them in the
   order before. Where a neighbour shares ``length`` bytes, the window
   repeats. Comparisons here are of bytes, not of hashes.

Blocks hold whole anchor groups of at most ``GROUP`` cuts. A larger group (a
passage that a third of the corpus has, in different surroundings) is never
gathered: its windows are split into ``PARTS`` by their place around the
anchor, each with a longer common core, and digested again; unequal cores fall
apart, and the splitting ends at single windows, where counting alone decides.
Equal texts are counted first and take part once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import SOLID, chunks, mix, prepare, spread, stored, table, text_bytes

LENGTH = 400
GROUP = 32_768  # cuts of an anchor sorted together: about 24 MB
PARTS = 8  # parts that the windows of a larger group are split into
BLOCK_CUTS = 8192  # cuts sorted together; whole groups, so at most GROUP more
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_PIECE = 1 << 19  # bytes looked at together
_PAD = 0xFF  # a byte that UTF-8 never has


def gram_size(length: int) -> int:
    return max(8, length // 4)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, powers) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of rows laid end to end."""
    gram = gram_size(length)
    width = length - gram + 1  # grams in a window
    n = len(data) - gram + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * down[:n])
    # The place in the low bits makes the leftmost of equal grams the least.
    rank = grams >> np.uint64(22) << np.uint64(22) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    padded = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = rank
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(data) - length + 1
    lows = np.minimum(behind[:starts], ahead[width - 1:width - 1 + starts])
    inside = np.ones(starts, bool)  # windows that cross into the next row do not count
    for edge in offsets[1:-1]:
        inside[max(0, edge - length + 1):edge] = False
    places = np.unique((lows[inside] & np.uint64((1 << 22) - 1)).astype(np.int64))
    return places, grams[places]


def _scan(length: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = None
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            sizes = np.diff(offsets)
            marks, places, hashes = [], [], []
            for first, end, part, offs in chunks(data, offsets, _PIECE):
                if powers is None:
                    powers = _power_tables(2 * _PIECE)
                marks += [hashlib.sha256(part[offs[k]:offs[k + 1]]).digest() for k in range(end - first)]
                if len(part) <= 2 * _PIECE:
                    at, h = _anchors(part, offs, length, powers)
                else:  # one long text: overlapping pieces see every window
                    found = [(s, _anchors(part[s:s + _PIECE + length - 1], np.array([0, len(part[s:s + _PIECE + length - 1])]), length, powers))
                             for s in range(0, len(part), _PIECE)]
                    at, h = np.concatenate([s + f[0] for s, f in found]), np.concatenate([f[1] for _, f in found])
                    at, keep = np.unique(at, return_index=True)
                    h = h[keep]
                cuts = np.searchsorted(at, offs)
                for k in range(end - first):
                    places.append((at[cuts[k]:cuts[k + 1]] - offs[k]).astype(np.int32))
                    hashes.append(h[cuts[k]:cuts[k + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()),
                 pa.array(places, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))],
                names=["id", "n_bytes", "mark", "places", "hashes"])
    return scan


_CUTS = "key binary, mode int, hash long, lo int, hi int, place int, whole long, bytes binary"


def _digest(*parts) -> int:
    h = hashlib.blake2b(digest_size=8)
    for x in parts:
        h.update(x if isinstance(x, bytes) else str(x).encode() + b"|")
    return int.from_bytes(h.digest(), "little", signed=True)


def _cutter(length: int):
    """Texts with their ``spots (place, lo, hi, hash, mode)`` to cuts.

    A spot stands for the windows that start ``lo`` to ``hi`` bytes before its
    place. Mode 0 cuts their bytes out; 1 gives the digests of their core and
    of all their bytes, 2 the same for each of ``PARTS`` parts of them.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in _CUTS.split(", ")]
        for batch in batches:
            rows = []
            for key, text, spots in zip(*(batch.column(k) for k in range(3)), strict=True):
                key, text = key.as_py(), text.as_py().encode()
                for spot in spots.as_py():
                    place, lo, hi, h, mode = (spot[x] for x in ("place", "lo", "hi", "hash", "mode"))
                    if mode == 0:
                        start = place - hi
                        rows.append((key, 0, h, lo, hi, place, None, b"\xff" * max(0, -start) + text[max(0, start):place - lo + length]))
                        continue
                    step = hi - lo + 1 if mode == 1 else -(-(hi - lo + 1) // PARTS)
                    for a in range(lo, hi + 1, step):
                        b = min(a + step - 1, hi)
                        if place - a < 0 or place - b + length > len(text):
                            continue  # no window of this range lies in the text
                        core = _digest(text[place - a:place - b + length], a, b)
                        if place - b >= 0 and place - a + length <= len(text):
                            whole = _digest(text[place - b:place - a + length])
                        else:
                            whole = _digest(key, place, a, b)
                        rows.append((key, 1, core, a, b, place, whole, None))
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    return cut


def repeated_windows(grid: np.ndarray, length: int) -> np.ndarray:
    """``grid``: documents by columns, 0xFF beyond a document's end. Returns,
    for start columns by documents, whether the ``length`` bytes from there
    also stand at that column in another document.

    Column-wise construction: each round puts one symbol of every document
    before the suffixes sorted so far.
    """
    n, columns = grid.shape
    by_column = np.ascontiguousarray(grid.T)
    order, common = np.arange(n), np.zeros(n, np.int32)
    found = np.zeros((columns - length + 1, n), bool)
    for j in range(columns - 1, -1, -1):
        symbols = by_column[j][order]
        moved = np.argsort(symbols, kind="stable")
        symbols = symbols[moved]
        left, right = moved[:-1], moved[1:]
        same = (symbols[1:] == symbols[:-1]) & (symbols[1:] != _PAD)
        now = np.zeros(n, np.int32)
        if same.any():
            a, b = left[same], right[same]
            low = common[b]
            far = np.flatnonzero(b - a > 1)
            if len(far):
                ends = np.minimum(b[far] + 1, n - 1)
                bounds = np.empty(2 * len(far), np.int64)
                bounds[::2], bounds[1::2] = a[far] + 1, ends
                between = np.minimum.reduceat(common, bounds)[::2]
                low[far] = np.minimum(between, common[b[far]])
            now[1:][same] = np.minimum(low, length - 1) + 1
        order, common = order[moved], now
        if j < len(found):
            hit = common >= length
            hit[:-1] |= hit[1:].copy()
            found[j, order] = hit
    return found


def _sorter(length: int):
    """Cuts, sorted by anchor hash, to repeated spans of their texts."""
    widest = 2 * length - gram_size(length)

    def spans(rows: list) -> pa.RecordBatch:
        # Parts of two anchors may begin at the same byte of a text; it must not
        # match itself, so the widest cut stands for all.
        unique = {(r[0], r[3] - r[4]): r for r in sorted(rows, key=lambda r: len(r[5]))}
        rows = list(unique.values())
        columns = np.full((widest, len(rows)), _PAD, np.uint8)
        for k, r in enumerate(rows):
            columns[:len(r[5]), k] = np.frombuffer(r[5], np.uint8)
        found = repeated_windows(columns.T, length)
        # Maximal runs of repeated starts, document by document.
        edge = np.zeros((len(rows), found.shape[0] + 2), np.int8)
        edge[:, 1:-1] = found.T
        step = np.diff(edge, axis=1)
        who, start = np.nonzero(step == 1)
        _, end = np.nonzero(step == -1)
        base = np.array([r[3] - r[4] for r in rows], np.int64)[who]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[k][0] for k in who], pa.binary()), pa.array(base + start), pa.array(base + end - 1 + length)],
            names=["key", "start", "end"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):  # key, hash, lo, place, hi, bytes
                if len(held) >= BLOCK_CUTS and row[1] != last:
                    yield spans(held)
                    held = []
                held.append(row)
                last = row[1]
        if held:
            yield spans(held)
    return sort


def _merge(spans: list[dict]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as maximal runs."""
    runs: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1), batch.column(2), strict=True):
            text, runs = text.as_py().encode(), _merge(spans.as_py())
            kept = _kept(text, runs)
            out.append((sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).digest(), kept.decode("utf-8", "ignore")))
        removed, n_spans, marks, left = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(marks, pa.binary()), pa.array(left, pa.string())],
            names=["key", "n_removed", "n_spans", "kept", "left"])


COMMON = 4096  # fewer keys than this can have more than 1 / COMMON of all rows
COMMON_LEAST = 256  # rows of a common key at least


def common_keys(counts: DataFrame, key: Column, n: str) -> dict[int, int]:
    """Keys (longs) of counted groups that hold more than ``1 / COMMON`` of all
    counted rows, which fewer than ``COMMON`` can, and their counts. Rows of
    such keys are told by a list of literals, so none is shuffled by its key."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n")).first()["n"]
    bound = max(COMMON_LEAST, total // COMMON)
    return {r["k"]: r["n"] for r in counts.where(F.col(n) > bound).select(key.alias("k"), F.col(n).alias("n")).collect()}


def among(key: Column, values: Iterable[int]) -> Column:
    values = list(values)
    return key.isin(values) if values else F.lit(False)


def repeat_spans(docs: DataFrame, id_col: str, text_col: str, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(texts, spans, bodies)``: per text of ``length`` bytes or more its
    ``key`` (of its SHA-256), ``n_bytes`` and ``copies`` (rows that have it);
    per text key its repeated ``spans``, for texts that occur once; those texts."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.substring("mark", 1, 16).alias("key")
    scanned = stored(source.mapInArrow(_scan(length), "id long, n_bytes long, mark binary, places array<int>, hashes array<long>"), "repeat-scan")
    known = scanned.select("id", "n_bytes", "mark", key)
    texts = known.where(F.col("n_bytes") >= length).groupBy("key").agg(F.min("id").alias("id"), F.min("n_bytes").alias("n_bytes"), F.count("*").alias("copies"))
    texts = stored(texts, "repeat-texts")

    # Anchors of one row of each text; a repeated row is dropped by its key.
    own = scanned.where(F.col("n_bytes") >= length).select("id", key, F.arrays_zip("places", "hashes").alias("spots"))
    own = own.join(texts.select(F.col("id").alias("first"), F.col("key").alias("key2")),
                   (F.col("key") == F.col("key2")) & F.col("id").eqNullSafe(F.col("first"))).select("key", "spots")
    anchors = own.select("key", F.explode("spots").alias("s")).select("key", F.col("s.places").alias("place"), F.col("s.hashes").alias("hash"))
    anchors = stored(anchors, "repeat-anchors")
    counts = stored(anchors.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "repeat-counts")
    common = among(F.col("hash"), common_keys(counts, F.col("hash"), "n"))
    repeated = anchors.where(common).unionByName(anchors.where(~common).join(counts.where(~common).select("hash"), "hash"))
    widest = length - gram_size(length)
    spots = repeated.select(
        "key", F.struct("place", F.lit(0).alias("lo"), F.lit(widest).alias("hi"), "hash", F.lit(1).alias("mode")).alias("spot"))
    spots = stored(spots.groupBy("key").agg(F.collect_list("spot").alias("spots")), "repeat-spots")  # bounded by the text's length

    wanted = spots.select("key").join(texts.select("key", "id"), "key").select(F.col("key").alias("key2"), F.col("id").alias("first"))
    named = source.where(F.octet_length("text") >= length).withColumn("key", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))
    bodies = stored(named.join(wanted, F.col("id").eqNullSafe(F.col("first")) & (F.col("key") == F.col("key2"))).select("key", "text"), "repeat-bodies")

    parts = []
    while True:
        cuts = stored(bodies.join(spots, "key").select("key", "text", "spots").mapInArrow(_cutter(length), _CUTS), "repeat-cuts", ["mode"])
        aligned = (cuts.where("mode = 0").select("key", "hash", "lo", "place", "hi", "bytes")
                   .repartition(spread(docs), "hash").sortWithinPartitions("hash", "key", "place"))
        if cuts.where("mode = 0").limit(1).count():
            parts.append(stored(aligned.mapInArrow(_sorter(length), "key binary, start long, end long"), "repeat-spans"))
        items = cuts.where("mode = 1").drop("mode", "bytes")
        if not items.limit(1).count():
            break
        # Equal bytes are counted, one stands for all; groups too large to gather
        # are split. (A row that is repeated whole counts twice here, which only
        # concerns its own text, and that one is removed whole.)
        group, one = ["hash", "lo", "hi"], F.xxhash64("hash", "lo", "hi", "whole")
        equal = stored(items.groupBy(*group, "whole").agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one")), "repeat-equal")
        twice = equal.where("n > 1")
        common = among(one, common_keys(twice, one, "n"))
        covered = items.where(common).unionByName(items.where(~common).join(twice.where(~common).select(*group, "whole"), [*group, "whole"], "left_semi"))
        parts.append(covered.select("key", (F.col("place") - F.col("hi")).cast("long").alias("start"), (F.col("place") - F.col("lo") + length).cast("long").alias("end")))
        different = stored(equal.groupBy(*group).agg(F.count("*").alias("d")).where("d > 1"), "repeat-different")
        name = F.xxhash64(*group)
        large = common_keys(different, name, "d")
        split, common = among(name, [k for k, d in large.items() if d > GROUP]), among(name, large)
        open_ = equal.where(common).withColumn("mode", F.when(split, 2).otherwise(0)).unionByName(
            equal.where(~common).join(different.where(~common), group).withColumn("mode", F.when(F.col("d") > GROUP, 2).otherwise(0)).drop("d"))
        spots = open_.select(
            F.col("one.key").alias("key"), F.struct(F.col("one.place").alias("place"), "lo", "hi", "hash", "mode").alias("spot"))
        spots = stored(spots.groupBy("key").agg(F.collect_list("spot").alias("spots")), "repeat-spots")

    every = parts[0] if parts else docs.sparkSession.createDataFrame([], "key binary, start long, end long")
    for part in parts[1:]:
        every = every.unionByName(part)
    spans = every.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # bounded by the text's length
    return texts.select("key", "n_bytes", "copies"), spans, bodies


def repeat_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: ``(<id>, n_bytes, n_removed, n_spans,
    kept_sha256, text)`` after removal of every byte under a repeated string;
    ``text`` is what is left (without the rest of a character cut in two).

    Null and empty texts have no bytes; texts under ``length`` bytes keep
    all; a repeated row is a repeat of its text and loses it whole; null ids
    are rows like others; other columns are ignored, whatever their names; an
    empty table gives an empty result.
    """
    texts, spans, bodies = repeat_spans(docs, id_col, text_col, length)
    cut = bodies.join(spans, "key").select("key", "text", "spans").mapInArrow(
        _digests, "key binary, n_removed long, n_spans long, kept binary, left string").dropDuplicates(["key"])
    copied = texts.where("copies > 1").select("key", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                              F.unhex(F.sha2(F.lit(""), 256)).alias("kept"), F.lit("").alias("left"))
    changed = cut.join(copied.select("key"), "key", "left_anti").unionByName(copied)
    mark = F.unhex(F.sha2("text", 256))
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(id_col, "text", F.octet_length("text").cast("long").alias("n_bytes"), mark.alias("mark"), F.substring(mark, 1, 16).alias("key"))
    none = F.lit(0).cast("long")
    whole = [F.lower(F.hex("mark")), F.col("text")]
    short = rows.where(F.col("n_bytes") < length).select(id_col, "n_bytes", none.alias("n_removed"), none.alias("n_spans"), whole[0].alias("kept_sha256"), "text")
    return short.unionByName(rows.where(F.col("n_bytes") >= length).join(changed, "key", "left").select(
        id_col, "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce(F.lower(F.hex("kept")), whole[0]).alias("kept_sha256"), F.coalesce("left", whole[1]).alias("text")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: strings of 400 bytes over all documents."""
    prepare(spark)
    return repeat_digest(table(spark, sf_dir, "documents"))


STAGE_WORDS = 51  # the stage's passages: over fifty words
_CODE = 8  # bytes that stand for a word, seven bits of its hash each
# First two bytes of characters of scripts that put no space between words:
# Thai, Lao, Tibetan; Burmese; Khmer; kana and Chinese characters.
_UNSPACED = ((0xE0B8, 0xE0BF), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE2BA, 0xE9BF))


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of rows laid end to end: what white space
    parts; where a script has none between words, each character."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid, edge = SOLID[data], np.zeros(len(data), bool)
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    edge[1:] |= ~solid[:-1]
    high = np.flatnonzero(data[:-1] >= 0xE0)  # first bytes of long characters
    pair = data[high].astype(np.int64) << 8 | data[high + 1]
    alone = high[np.any([(pair >= a) & (pair <= b) for a, b in _UNSPACED], axis=0)]
    edge[alone] = True
    edge[alone[alone + 3 < len(data)] + 3] = True
    starts, stops = np.flatnonzero(solid & edge), np.append(np.flatnonzero(edge | ~solid), len(data))
    return starts, stops[np.searchsorted(stops, starts, "right")]


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with every word as the ``_CODE`` ASCII bytes of its hash."""
    for batch in batches:
        out = []
        for first, end, part, offs in chunks(*text_bytes(batch.column(1)), _PIECE):
            starts, ends = word_ranges(part, offs)
            if not len(starts):
                out += [""] * (end - first)
                continue
            sizes = ends - starts
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            with np.errstate(over="ignore"):
                value = (part[np.repeat(starts, sizes) + place].astype(np.uint64) + np.uint64(1)) * _power_tables(int(sizes.max()))[0][place]
                hashed = mix(np.add.reduceat(value, np.cumsum(sizes) - sizes))
            code = (hashed[:, None] >> np.arange(8, 8 + 7 * _CODE, 7, dtype=np.uint64) & np.uint64(0x7F)).astype(np.uint8).tobytes().decode("ascii")
            cuts = np.searchsorted(starts, offs) * _CODE
            out += [code[cuts[k]:cuts[k + 1]] for k in range(end - first)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])


def _coded_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key that ``repeat_spans`` gives the coded text."""
    for batch in _coded(batches):
        keys = [hashlib.sha256(t.encode()).digest()[:16] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], names=["own", "key"])


def _without_words(text: bytes, spans: list[dict], least: int) -> bytes:
    """``text`` without the words under spans of its coded form. Part of a code
    at a span's end is an accident of the hash, so only whole ones count, and
    only spans with ``least`` words."""
    whole = [{"start": -(-x["start"] // _CODE), "end": x["end"] // _CODE} for x in spans]
    starts, ends = word_ranges(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    kept = _kept(text, [(int(starts[a]), int(ends[b - 1])) for a, b in _merge([x for x in whole if x["end"] - x["start"] >= least])])
    return kept if kept.strip() else b""


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_kept(t.as_py().encode(), _merge(s.as_py() or [])).decode("utf-8", "ignore") if t.is_valid else None
               for t, s in zip(batch.column(1), batch.column(2), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["key", "text"])


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str, length: int | None = None, least: int = STAGE_WORDS) -> DataFrame:
    """Pipeline stage: every document stays, without the words under a passage
    of ``least`` words or more that also stands elsewhere (white space between
    words may differ); ``n_chars`` follows where the input has it.

    Words differ in size, so no byte length stands for a number of them: texts
    are searched as codes of equal size, one a word, and spans go back to the
    words they hold. With ``length``, the passages are strings of so many bytes
    instead (a character cut in two goes too).

    Null texts stay null, empty ones empty; of equal texts of so many words all
    are emptied, as each is elsewhere; repeated rows and null ids are rows like
    others; other columns stay, whatever their names; an empty table gives an
    empty one.
    """
    prepare(spark)
    own = F.substring(F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256)), 1, 16)
    source = docs if length else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_coded, "doc_id long, text string")
    texts, spans, bodies = repeat_spans(source, "doc_id", "text", length or least * _CODE)
    copied = texts.where("copies > 1").select("key", "n_bytes")
    spans = spans.join(copied, "key", "left_anti")  # those go whole
    if length:
        shorter = bodies.join(spans, "key").select("key", "text", "spans").mapInArrow(_rewrite, "key binary, text string").dropDuplicates(["key"])
        changed = shorter.unionByName(copied.select("key", F.lit("").alias("text"))).select(F.col("key").alias("_key"), F.col("text").alias("_kept"))
        text = F.coalesce(changed["_kept"], docs["text"])
    else:
        @F.arrow_udf("string")
        def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
            return pa.array([_without_words(t.as_py().encode(), s.as_py(), least).decode() if s.is_valid else None for t, s in zip(texts, spans, strict=True)], pa.string())

        # Texts of equal words are one coded text; each is cut by itself.
        cut = spans.unionByName(copied.select("key", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("spans")))
        keys = docs.where(F.col("text").isNotNull()).select(own.alias("own"), "text").mapInArrow(_coded_keys, "own binary, key binary").distinct()
        changed = keys.join(cut, "key").select(F.col("own").alias("_key"), F.col("spans").alias("_spans"))
        found = changed["_spans"].isNotNull()
        text = F.when(found, without(F.when(found, docs["text"]), changed["_spans"])).otherwise(docs["text"])
    rows = docs.join(changed, own == changed["_key"], "left")
    columns = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": text}
    return rows.select(*[columns.get(c, docs[c]).alias(c) for c in docs.columns])
