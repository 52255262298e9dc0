"""SpotSigs document fingerprints, with DataFrame functions only.

A signature is a common word (the anchor) with the two content words that
follow it; common words between these are skipped. A document's fingerprint
is its set of signatures; two are as alike as the Jaccard similarity of the
sets. ``similar_documents`` compares sets across a collection: sets are
partitioned by length so that only lengths that can reach the threshold
meet, and candidates share a signature among their rarest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart.llm.common import prepare, spread, stored, table
from trackmart.operators.relational import maybe_repeated, repeated_bits

# Common function words of four languages.
ANCHORS = tuple(sorted(set((
    "the of and to in a is that for it on with as was be by are this from at or an "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par sur au "
    "el y los se del las por con no una su para es al lo como").split())))
BITS = 32
SIMILAR = 0.8  # Jaccard similarity of two fingerprints that are similar


def _signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``, the sorted distinct signatures of column ``text``
    as numbers under 2 ** 32. A text without any has one of its own hash."""
    words, content = f"{out}_words", f"{out}_content"
    df = df.withColumn(words, F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))
    places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(content, F.filter(places, lambda k: ~F.get(words, k).isin(*ANCHORS)))

    def signature(place: Column, k: Column) -> Column:
        follows = (place > 0) & (F.get(content, k - 1).isNull() | (F.get(content, k - 1) < place - 1)) & (k + 1 < F.size(content))
        return F.when(follows, F.shiftrightunsigned(
            F.xxhash64(F.get(words, place - 1), F.get(words, place), F.get(words, F.get(content, k + 1))), 64 - BITS))

    found = F.array_sort(F.array_distinct(F.filter(F.transform(content, signature), lambda s: s.isNotNull())))
    df = df.withColumn(out, found)
    alone = F.array(F.shiftrightunsigned(F.xxhash64(text), 64 - BITS))
    return df.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(alone)).drop(words, content)


def _string(signatures: str) -> Column:
    """Nine characters each: "1" and the signature in hexadecimal."""
    return F.array_join(F.transform(signatures, lambda s: F.hex(s + (1 << BITS))), "")


def _likeness(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def _range(value: Column, points: list[int]) -> Column:
    """How many of the ascending ``points`` are not above ``value``, found in
    two steps of about the root of their number."""
    if not points:
        return F.lit(0)
    step = math.isqrt(len(points) - 1) + 1
    least = -(1 << 63)
    array = "array(" + ",".join(f"{p}L" if p > least else "(-9223372036854775807L - 1L)" for p in points) + ")"
    below = lambda some: F.size(F.filter(some, lambda p: p <= value))
    coarse = below(F.expr(f"transform(sequence(1, {len(points)}, {step}), k -> element_at({array}, k))"))
    fine = below(F.slice(F.expr(array), F.greatest((coarse - 1) * step + 1, F.lit(1)), F.lit(step)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """``doc_id, text, sentinel, bucket`` such that, within a bucket ordered by
    (sentinel, doc_id descending, text hash), the row after a row is the next
    document by descending id and after the least the greatest.

    Ids are cut into ranges of near equal counts. The first row of each range
    is repeated as a sentinel after the last of the range above.
    """
    points = docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else []
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(_range(F.col("doc_id"), sorted(set(points or []))))
    rows = docs.withColumns({"sentinel": F.lit(False), "bucket": bucket})
    heads = sorted((r["bucket"], r["head"]) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect())  # one per range
    if not heads:
        return rows
    above = {heads[k - 1][0]: heads[k][0] for k in range(len(heads))}  # below each range comes the one before it, below the least the greatest
    pairs = ",".join(f"struct({k} AS bucket, {v} AS above)" for k, v in above.items())
    move = F.broadcast(docs.sparkSession.range(1).select(F.expr(f"inline(array({pairs}))")))  # one row per range
    ends = rows.where(F.col("doc_id").isin([h for _, h in heads if h is not None]) | F.col("doc_id").isNull())
    ends = ends.join(move, "bucket").select("doc_id", "text", F.lit(True).alias("sentinel"), F.col("above").alias("bucket"))
    return rows.unionByName(ends)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every row (the contract names the columns).

    Null texts count as empty; an empty text has the fingerprint of its hash.
    Equal ids are ordered by a hash of their texts, null ids come last. A
    single row is its own next. Other columns are ignored; no row gives no row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = 2 * spread(docs)
    dealt = with_next(rows, parts).withColumn("tie", F.xxhash64("text")).repartition(spread(docs), "bucket")
    order = Window.partitionBy("bucket").orderBy("sentinel", F.desc_nulls_last("doc_id"), "tie")
    signed = _signatures(dealt, "text", "own")
    paired = signed.withColumns({"next": F.lead("text").over(order), "next_own": F.lead("own").over(order)}).where(~F.col("sentinel"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next", F.lit(1), half))
    done = _signatures(paired.withColumn("edited", edited), "edited", "edited_own")
    return done.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        _string("own").alias("fingerprint"), _string("edited_own").alias("edited_fingerprint"),
        _likeness("own", "edited_own").alias("near_edited"), _likeness("own", "next_own").alias("near_next"))


def _mark(fingerprint: str | Column) -> Column:
    return F.unhex(F.substring(F.sha2(fingerprint, 256), 1, 32))


def _signed(docs: DataFrame) -> DataFrame:
    """``doc_id, own, mark`` of every row: its set and 128 bits that name it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _signatures(rows, "text", "own").select("doc_id", "own", _mark(_string("own")).alias("mark"))


def _classes(signed: DataFrame) -> DataFrame:
    """``num, mark, own, class_id, copies`` of every distinct set."""
    classes = signed.groupBy("mark").agg(F.min("doc_id").alias("class_id"), F.any_value("own").alias("own"), F.count("*").alias("copies"))
    return stored(classes.withColumn("num", F.monotonically_increasing_id()), "spot-classes")


def _links(classes: DataFrame, threshold: float) -> DataFrame:
    """``a, b, likeness`` (numbers of classes, a < b) of all pairs that reach
    ``threshold``.

    Signatures that one class has alone match nothing; a bit table tells nearly
    all of them where they are, so only the others are shuffled. They are the
    rarest of a set, so of its rarest ``n - ceil(threshold n) + 1``, one of
    which any partner shares, the others remain to be looked up. Lengths are
    cut into bands that grow by 1 / threshold: a set meets those of its own
    band and the next.
    """
    spots = classes.select("num", F.size("own").alias("n"), F.explode("own").alias("spot"))
    table = repeated_bits(spots, "spot")
    if table is not None:
        spots = maybe_repeated(spots, "spot", table, "several").where("several").drop("several")
    rarity = spots.groupBy("spot").agg(F.count("*").alias("df")).where("df > 1")
    ranked = spots.join(rarity, "spot").groupBy("num", "n").agg(F.sort_array(F.collect_list(F.struct("df", "spot"))).alias("s"))  # a document's own set
    looked = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1 - (F.col("n") - F.size("s"))
    rare = ranked.where(looked > 0).select("num", "n", F.explode(F.slice("s", 1, looked.cast("int"))["spot"]).alias("spot"))
    band = F.floor(F.log(F.col("n")) / -math.log(threshold) + 1e-9)
    left = rare.select("spot", F.col("num").alias("x"), F.col("n").alias("nx"), F.explode(F.array(band, band + 1)).alias("band"))
    right = rare.select("spot", F.col("num").alias("y"), F.col("n").alias("ny"), band.alias("band"))
    ordered = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    pairs = left.join(right, ["spot", "band"]).where(ordered & (F.col("nx") >= F.col("ny") * threshold - 1e-9)).select("x", "y").distinct()
    sets = classes.select("num", "own")
    return (pairs.join(sets.select(F.col("num").alias("x"), F.col("own").alias("ox")), "x")
            .join(sets.select(F.col("num").alias("y"), F.col("own").alias("oy")), "y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), _likeness("ox", "oy").alias("likeness"))
            .where(F.col("likeness") >= threshold))


def similar_documents(docs: DataFrame, threshold: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: each row's ``doc_id`` and ``class_id`` (the least id
    with the same set), and pairs ``a < b`` of class ids whose sets reach
    ``threshold``, with their ``likeness``. Rows with a null id are left out;
    empty texts share a class.
    """
    signed = stored(_signed(docs.where(F.col("doc_id").isNotNull())), "spots")
    classes = _classes(signed)
    members = signed.join(classes.select("mark", "class_id"), "mark").select("doc_id", "class_id")
    names = classes.select("num", "class_id")
    links = (_links(classes, threshold).join(names.select(F.col("num").alias("a"), F.col("class_id").alias("ca")), "a")
             .join(names.select(F.col("num").alias("b"), F.col("class_id").alias("cb")), "b")
             .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "likeness"))
    return members, links


def similar_report(docs: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """``doc_id, class_id`` (the least id of equal sets, null if none has one),
    ``n_copies`` (rows that have the set) and ``n_similar`` (other sets that
    reach ``threshold``) of every row; null ids are rows like others, null texts
    empty ones, other columns ignored; no row gives no row."""
    signed = stored(_signed(docs), "spots")
    classes = _classes(signed)
    links = stored(_links(classes, threshold), "spot-links")
    ends = links.select(F.col("a").alias("num")).unionByName(links.select(F.col("b").alias("num"))).groupBy("num").agg(F.count("*").alias("n_similar"))
    known = classes.select("num", "mark", "class_id", F.col("copies").alias("n_copies")).join(ends, "num", "left")
    known = known.select("mark", "class_id", "n_copies", F.coalesce("n_similar", F.lit(0)).alias("n_similar"))
    return signed.select("doc_id", "mark").join(known, "mark").drop("mark")


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document, its edited text and its next document."""
    prepare(spark)
    return fingerprints(table(spark, sf_dir, "documents"))


def similar_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of equal fingerprints, and how many others are
    similar to it, by the length-banded pruned join over all documents."""
    prepare(spark)
    return similar_report(table(spark, sf_dir, "documents"))
