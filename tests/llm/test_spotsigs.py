"""op10 against a Python version, and the pruned join against all pairs."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
import xxhash

from .conftest import corpus, rows, with_clashes
from trackmart.llm import spotsigs as S


def signatures(text):
    """Signatures as word triples (the hash aside)."""
    words = re.findall(r"[^\W_]+", text.lower())
    content = [k for k, w in enumerate(words) if w not in S.ANCHORS]
    out = set()
    for n, k in enumerate(content[:-1]):
        if k and words[k - 1] in S.ANCHORS:
            out.add((words[k - 1], words[k], words[content[n + 1]]))
    return out


TABLE = [(1, "The quick of brown fox and the lazy dog in a house"), (2, "the quick brown fox"), (3, "the quick brown fox"), (5, None), (6, ""), (9, "Der Hund und die Katze!! THE cat"),
         (12, "no anchors here"), (20, "É la maison de Paris et le chat noir " * 40)]


def test_signatures_count_and_likeness(spark):
    df = spark.createDataFrame(TABLE, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in S.fingerprints(with_clashes(df)).collect()}
    assert len(got) == len(TABLE)
    order = sorted(TABLE, reverse=True)
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, other = signatures(text), signatures(after)
        assert len(r["fingerprint"]) == 9 * max(1, len(own))
        if own and other:
            assert r["near_next"] == pytest.approx(len(own & other) / len(own | other))
        if own and signatures(edited):
            assert r["near_edited"] == pytest.approx(len(own & signatures(edited)) / len(own | signatures(edited)))
    assert got[2]["fingerprint"] == got[3]["fingerprint"] and got[3]["near_next"] == 1.0
    assert got[5]["fingerprint"] == got[6]["fingerprint"]


def test_next_document_across_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        table = [(7 * k, f"text number {k} of the set and more") for k in range(57)]
        df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(5)
        got = {r["doc_id"]: r["edited_sha256"] for r in S.fingerprints(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    order = sorted(table, reverse=True)
    for k, (doc, text) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(text) // 2
        assert got[doc] == hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()


def test_null_ids_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(None, "the cat sat"), (4, "the dog ran"), (4, "the dog ran"), (None, None)], "doc_id bigint, text string")
    assert S.fingerprints(df).count() == 4
    assert S.fingerprints(df.limit(0)).count() == 0


def test_similar_documents_against_all_pairs(spark):
    table = [(r[0], r[1]) for r in corpus()] + [(1000 + k, "the cat of war and a dog in the house of ruin " + "the " + " the ".join(f"b{j} c{j}" for j in range(30 - k))) for k in range(5)]
    members, links = S.similar_documents(spark.createDataFrame(table, "doc_id bigint, text string"), 0.7)
    owner = {r["doc_id"]: r["class_id"] for r in members.collect()}
    sets = {}
    for doc, text in table:
        if owner[doc] == doc:
            sets[doc] = signatures(text or "") or {("alone", text or "")}
    want = sorted((a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b]) - 1e-9)
    assert sorted((r["a"], r["b"]) for r in links.collect()) == want and want
    assert set(owner) == {doc for doc, _ in table}


def test_plan_has_no_python(spark, docs, tmp_path):
    import contextlib
    import io
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        S.op10_spotsigs(spark, str(tmp_path)).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", out.getvalue())


def test_hash_is_sparks(spark):
    """The stored numbers are 32 bits of Spark's xxhash64."""
    one = spark.createDataFrame([(1, "x y")], "doc_id bigint, text string")
    got = S.fingerprints(one).first()["fingerprint"]
    assert int(got, 16) - (1 << 32) == xxhash.xxh64(b"x y", seed=42).intdigest() >> 32


def test_classes_and_similar_sets_of_every_row(spark):
    table = [(r[0], r[1]) for r in corpus()] + [(1000 + k, "the cat of war and a dog in the house of ruin " + "the " + " the ".join(f"b{j} c{j}" for j in range(60 - k))) for k in range(9)]
    table += [(None, table[0][1]), (None, "only the nameless one here"), (1000, table[-9][1])]
    df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)
    got = rows(S.similar_report(with_clashes(df)))
    sets = [(d, frozenset(signatures(t or "")) or frozenset([("alone", t or "")])) for d, t in table]
    want = []
    for doc, own in sets:
        same = [d for d, s in sets if s == own]
        near = {s for _, s in sets if s != own and len(own & s) >= S.SIMILAR * len(own | s) - 1e-9}
        want.append((doc, min((d for d in same if d is not None), default=None), len(same), len(near)))
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert any(r[3] for r in got) and S.similar_report(df.limit(0)).collect() == []


def test_ranges_of_ids(spark):
    for points in ([], [5], [-(1 << 63), 0, 7], list(range(0, 400, 3))):
        df = spark.range(-3, 420).withColumn("r", S._range(F.col("id"), points))
        assert all(r["r"] == sum(p <= r["id"] for p in points) for r in df.collect())
