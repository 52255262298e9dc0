"""MinHash near-duplicate detection with tensored banding.

Method. Every text becomes a set of word shingles. Equal sets form a class,
and only classes go on. A class gets two collections of ``HALVES`` half keys,
each made of ``ROWS`` minhashes. A table key is a pair (half key i of the
first collection, half key j of the second), so ``HALVES`` squared tables come
from ``2 * HALVES * ROWS`` minhashes instead of ``HALVES ** 2 * 2 * ROWS``.
A half key that only one class has cannot collide in any of its tables, so
these are dropped before the pairs are formed; a unique text forms none.

Two classes at the similarity bound share no table with probability
``2 * (1 - 0.8 ** ROWS) ** HALVES``: about 1e-5 here, falling fast above the
bound. Candidates are verified on the whole sets.

Groups of thousands. Tables with the same members count once. Two exact bounds
drop candidates before their sets are compared: shingles that no other
candidate has cannot be shared, and bitmaps of the sets' parities differ in at
most as many bits as the sets differ in shingles. Members of a table are
compared with its most central member (the least share of unshared shingles),
links become components, and only members of different components that the
bounds leave are compared further: copies join at the centre and never expand
into all their pairs, and no candidate link between components is lost. Of
these, tables of few members are compared whole. The members of larger ones
meet where they share one of their rarest shingles instead, as linked sets
must: of ``n`` shingles, ordered by how many have them, one of the first
``n - ceil(0.8 n) + 1``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import WORD, chunks, mix, prepare, row_key, shingles, stored, table, text_bytes, words
from trackmart.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = (80, 100)  # linked when 100 * shared >= 80 * united
HALVES, ROWS = 12, 2
FEW = 64  # members of a table that are compared whole
PIECE = 1 << 19  # bytes of text looked at together
BITMAP = 16  # 64-bit words of a set's parity bitmap
SEED = 20240229


def _mark(own: np.ndarray) -> bytes:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        return np.array([mix(own).sum(), mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64).tobytes()


def _signer(n_words: int):
    with np.errstate(over="ignore"):
        rng = np.random.default_rng(SEED)
        flips = rng.integers(0, 1 << 63, 2 * HALVES * ROWS, dtype=np.uint64) << np.uint64(1)
        odd = rng.integers(0, 1 << 63, 2 * HALVES * ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            sizes, classes, keys = [], [], []
            for first, end, part, offs in chunks(data, offsets, PIECE):
                _, _, row, hashed = words(part, offs)
                cuts = np.searchsorted(row, np.arange(end - first + 1))
                for k in range(end - first):
                    own = shingles(hashed[cuts[k]:cuts[k + 1]], n_words)
                    sizes.append(len(own))
                    if not len(own):
                        classes.append(None)
                        keys.append(None)
                        continue
                    with np.errstate(over="ignore"):
                        lows = np.full(len(odd), np.uint64(0xFFFFFFFFFFFFFFFF))
                        for at in range(0, len(own), 4096):
                            lows = np.minimum(lows, ((own[at:at + 4096, None] ^ flips) * odd).min(axis=0))
                        half = lows.reshape(2 * HALVES, ROWS)
                        key = mix((half * (np.arange(ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(3))).sum(axis=1))
                    classes.append(_mark(own))
                    keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "size", "cls", "halves"])
    return sign


def _sets(n_words: int):
    """``(num, text, cls)`` to ``(num, cls, shingles, bits)``; ``cls`` is null
    where the text is not of that class. A bit is the parity of the shingles
    that hash to it."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            found, marks, maps = [], [], []
            for first, end, part, offs in chunks(data, offsets, PIECE):
                _, _, row, hashed = words(part, offs)
                cuts = np.searchsorted(row, np.arange(end - first + 1))
                for k in range(end - first):
                    own = shingles(hashed[cuts[k]:cuts[k + 1]], n_words)
                    cls = batch.column(2)[first + k].as_py()
                    marks.append(cls if _mark(own) == cls else None)
                    found.append(own.view(np.int64))
                    odd = np.bincount((own >> np.uint64(32)) % np.uint64(64 * BITMAP), minlength=64 * BITMAP) & 1
                    maps.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(marks, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(maps, pa.list_(pa.int64()))],
                names=["num", "cls", "shingles", "bits"])
    return cut


def _verified(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the bound."""
    num, den = similarity
    left = sets.select(F.col("num").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("num").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", shared.alias("shared"), (F.size("sa") + F.size("sb") - shared).alias("united"))
            .where(F.col("shared") * den >= F.col("united") * num).select("a", "b"))


def _tables(classes: DataFrame) -> DataFrame:
    """``(key, num)``: members of every table key that two classes share, one
    key for each set of members."""
    halves = classes.select("num", F.posexplode("halves").alias("slot", "half"))
    common = halves.groupBy("slot", "half").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    shared = halves.join(common, ["slot", "half"]).groupBy("num").agg(
        F.sort_array(F.collect_list(F.struct("slot", "half"))).alias("own"))  # at most 2 * HALVES entries
    one = F.filter("own", lambda x: x["slot"] < HALVES)
    two = F.filter("own", lambda x: x["slot"] >= HALVES)
    keys = F.flatten(F.transform(one, lambda x: F.transform(two, lambda y: F.xxhash64(x["slot"], x["half"], y["slot"], y["half"]))))
    return _distinct_tables(stored(shared.select("num", F.explode(keys).alias("key")), "minhash-keys"))


def _slot(shingles: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (shingles.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _rarest(sets: DataFrame, total: int, similarity: tuple[int, int]) -> DataFrame:
    """``(key, num)``: of each set's shingles, as many of the rarest as one that
    is linked with it must share one of. ``total``: shingles of all ``sets``.

    How many sets have a shingle is counted by slots that shingles are hashed
    to, 2 ** 20 at most; any order that is the same for all sets is right, so
    shingles that share a slot cost time only. A shingle that is alone in its
    slot is no other set's.
    """
    num, den = similarity
    bits = min(20, max(8, (total // 64).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            counts += np.bincount(_slot(batch.column(0).flatten().to_numpy(), bits), minlength=1 << bits)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], names=["slot", "n"])

    got = sets.select("shingles").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # 2 ** bits rows at most
    counts = np.zeros(1 << bits, np.int64)
    counts[got["slot"].to_numpy()] = got["n"].to_numpy()

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [np.zeros(0, np.int64)], []
            for own in batch.column(1):
                own = own.values.to_numpy()
                often = counts[_slot(own, bits)]
                looked = len(own) - -(-len(own) * num // den) + 1
                first = np.lexsort((own, often))[:looked]
                keys.append(own[first[often[first] > 1]])
                sizes.append(len(keys[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.repeat(batch.column(0).to_numpy(), sizes), pa.int64())], names=["key", "num"])
    return sets.select("num", "shingles").mapInArrow(rarest, "key long, num long")


def _distinct_tables(tables: DataFrame) -> DataFrame:
    marks = tables.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("num")).alias("m1"), F.bit_xor(F.xxhash64("num", F.lit(1))).alias("m2")).where("n > 1")
    return tables.join(marks.groupBy("n", "m1", "m2").agg(F.min("key").alias("key")).select("key"), "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = SHINGLE_WORDS,
                    similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row per input row: ``(<id>, n_shingles, component_id, kept)``.

    ``component_id`` is the least id reachable over verified links, ``kept``
    says whether the row has that id. Null, empty and blank texts have an
    empty set and are linked with nothing: their component is their own id.
    A row with a null id never names a component that has another id; a
    component of null ids only has component_id null and is kept. Repeated rows
    are equal sets (both rows with the least id are kept). Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stored(source.mapInArrow(_signer(n_words), "id long, size long, cls binary, halves array<long>"), "minhash")

    classes = signed.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("least"), F.min("size").alias("size"), F.first("halves").alias("halves"))
    classes = stored(classes.withColumn("num", F.monotonically_increasing_id()), "minhash-classes")
    tables = stored(_tables(classes), "minhash-tables")

    # Whole sets of the classes that share a table, from one text of each. A
    # repeated id may bring another class's text, which its class number tells.
    wanted = classes.join(tables.select("num").distinct(), "num", "left_semi").select("num", "cls", "size", F.col("least").alias("id"))
    texts = source.join(wanted, source["id"].eqNullSafe(wanted["id"])).select("num", "text", "cls")
    sets = texts.mapInArrow(_sets(n_words), "num long, cls binary, shingles array<long>, bits array<long>").where("cls is not null").dropDuplicates(["num"]).drop("cls")
    sets = stored(sets, "minhash-sets")

    # Shingles of one candidate only bound what it can share with any other.
    num, den = similarity
    spots = sets.select("num", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"), F.min("num").alias("num")).where("n = 1")
    alone = spots.groupBy("num").agg(F.count("*").alias("alone"))
    sized = sets.select("num", "bits", F.size("shingles").cast("long").alias("size")).join(alone, "num", "left")
    sized = (sized.select("num", "bits", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("most"))
             .where(F.col("most") * den >= F.col("size") * num))
    tables = stored(tables.join(sized, "num"), "minhash-members")

    def members(rows: DataFrame, mark: str) -> DataFrame:
        return rows.select("key", *(F.col(c).alias(mark + c) for c in ("num", "size", "most", "bits", "comp")))

    most, both = F.least("xmost", "ymost"), F.col("xsize") + F.col("ysize")
    apart = sum((F.bit_count(F.get("xbits", k).bitwiseXOR(F.get("ybits", k))) for k in range(1, BITMAP)),
                F.bit_count(F.get("xbits", 0).bitwiseXOR(F.get("ybits", 0))))
    possible = (F.col("xcomp") != F.col("ycomp")) & (most * den >= (both - most) * num) & (apart * (den + num) <= both * (den - num))

    def compared(rows: DataFrame, pivots: DataFrame, name: str) -> DataFrame:
        pairs = (members(rows, "x").join(members(pivots, "y"), "key").where(possible)
                 .select(F.greatest("xnum", "ynum").alias("a"), F.least("xnum", "ynum").alias("b")).distinct())
        return stored(_verified(stored(pairs, f"minhash-pairs-{name}"), sets, similarity), f"minhash-links-{name}")

    rows = tables.withColumn("comp", F.col("num"))
    central = F.struct((F.col("most") / F.col("size")).alias("share"), F.xxhash64("num").alias("tie"))
    pivots = rows.groupBy("key").agg(F.max_by(F.struct("num", "size", "most", "bits", "comp"), central).alias("p")).select("key", "p.*")
    roots = stored(components(compared(rows, pivots, "centre")), "minhash-roots")
    rows = tables.join(roots.withColumnRenamed("node", "num"), "num", "left").withColumn("comp", F.coalesce("root", "num")).drop("root")
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    rows = stored(rows.join(mixed, "key"), "minhash-open")
    many = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > FEW).select("key"), "minhash-many")
    few = rows.join(many, "key", "left_anti")
    rest = compared(few, few, "rest")
    if many.limit(1).count():
        large = stored(rows.join(many, "key", "left_semi").select("num", "size", "most", "bits", "comp").distinct(), "minhash-large")
        total = large.agg(F.sum("size")).first()[0]
        prefixed = stored(large.join(_rarest(sets.join(large.select("num"), "num", "left_semi"), total, similarity), "num"), "minhash-prefixes")
        # The most frequent component of a shingle is not compared with itself.
        common = prefixed.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("comp", "n").alias("most_comp"))
        others = prefixed.join(common, "key").where("comp != most_comp").drop("most_comp")
        rest = rest.unionByName(compared(others, prefixed, "large"))
    if rest.limit(1).count():
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest)
        roots = stored(components(edges), "minhash-roots")

    home = classes.join(roots.withColumnRenamed("node", "num"), "num", "left").select(
        "cls", "least", F.coalesce("root", "num").alias("root"))
    names = home.groupBy("root").agg(F.min("least").alias("component_id"))
    home = home.join(names, "root").select("cls", "component_id")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return signed.drop("halves").join(home, "cls", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: 4-word shingles of whole lower-cased documents."""
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), n_words=4)


def keep_first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group stays, the one
    of least id, as it is.

    Rows of one id are one document and stay or go together, unless their texts
    are in different groups: then they stay if one of these keeps the id. Rows
    without an id are told apart by their texts: of equal ones one stays, and
    none that a document with an id has a near copy of. Null and empty texts
    are near nothing and stay; other columns stay as they are, whatever their
    names; an empty table gives an empty one.
    """
    prepare(spark)
    keyed = docs.select(row_key().alias("doc_id"), "text")
    kept = near_duplicates(keyed).where("kept").select(F.col("doc_id").alias("__row_key")).distinct()
    named = docs.where("doc_id IS NOT NULL").unionByName(docs.where("doc_id IS NULL").dropDuplicates(["text"]))
    return named.join(kept, row_key() == kept["__row_key"], "left_semi")


# DuckDB SQL of the contract query: every pair of texts that share a shingle.
SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM docs d JOIN roots r ON d.doc_id = r.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id
"""
