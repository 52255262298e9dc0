"""op4 and op5: held-out accuracy, and each model against a plain version."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from .conftest import rows, with_clashes
from trackmart.llm import language as L
from trackmart.llm import quality as Q

SF = "/root/testdata/sf0.01"


def held(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def test_language_accuracy_on_held_out_documents(spark):
    got = {r["doc_id"]: r for r in L.op4_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs) and all(r["held_out"] == held(k) and 0 <= r["score"] <= 1 for k, r in got.items())
    unseen = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs if held(r["doc_id"])]
    assert np.mean(unseen) > 0.98


def test_rank_order_distance_against_a_plain_version(spark):
    texts = ["The cat and the hat.", "der Hund und die Katze", "le chat et la maison", "Ünïcode ÉTÉ", "x"] * 3
    langs = ["en", "de", "fr", "de", "fr"] * 3
    df = spark.createDataFrame([(k, t, g) for k, (t, g) in enumerate(zip(texts, langs))], "doc_id bigint, text string, lang string")
    known = L.profiles(df)

    def grams(text):
        s = [0, 0, *(int(L._classes()[ord(c)]) for c in text.lower()), 0, 0]
        out = [("1", c) for c in s if c] + [("2", a, b) for a, b in zip(s, s[1:]) if a or b]
        return out + [("3", a, b, c) for a, b, c in zip(s, s[1:], s[2:]) if b and (a or c)]

    def code(g):
        n = {"3": 0, "2": L._SIDE ** 3, "1": L._SIDE ** 3 + L._SIDE ** 2}[g[0]]
        for k, x in enumerate(reversed(g[1:])):
            n += x * L._SIDE ** k
        return n

    def ranked(texts, top):
        counts = {}
        for t in texts:
            for g in grams(t):
                counts[code(g)] = counts.get(code(g), 0) + 1
        return sorted(counts, key=lambda c: (-counts[c], c))[:top]

    for lang in known:
        own = ranked([t for k, (t, g) in enumerate(zip(texts, langs)) if g == lang and not held(k)], L.PROFILE)
        assert known[lang].tolist() == own
    names, ranks = list(known), L.rank_table(known)
    known = dict(zip(names, ranks))
    labels, _ = L.predict(pa.array(texts), names, ranks)
    for text, label in zip(texts, labels):
        mine = ranked([text], L.DOCUMENT)
        distance = {n: sum(abs(int(known[n][c]) - r) if known[n][c] < L.PROFILE else L.PROFILE for r, c in enumerate(mine)) for n in names}
        assert label == min(distance, key=lambda n: (distance[n], n))


def test_code_points_of_every_width():
    texts = ["aé", "", "日本x", "\U0001F600ñ\U00010400", "ж"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    points, cuts = L.code_points(data, np.append(0, np.cumsum([len(t.encode()) for t in texts])))
    assert points.tolist() == [ord(c) for t in texts for c in t] and np.diff(cuts).tolist() == [len(t) for t in texts]


@pytest.mark.parametrize("letters", ["абвгдежзийклмнопрстуфхцчшщъыьэюя", "अआइईउऊएऐओऔकखगघचछजझटठडढतथदधनपफबभमयरलवशसह", "אבגדהוזחטיכלמנסעפצקרשת"])
def test_languages_of_one_script_outside_latin(spark, letters):
    """Two languages of the same letters, with syllables of their own."""
    rng = np.random.default_rng(5)
    syllables = {g: ["".join(rng.choice(list(letters), rng.integers(1, 4))) for _ in range(50)] for g in ("one", "two")}
    text = lambda g: " ".join("".join(rng.choice(syllables[g], rng.integers(1, 4))) for _ in range(40))
    data = [(k, text(("one", "two")[k % 2]), ("one", "two")[k % 2]) for k in range(120)]
    got = {r["doc_id"]: r["lang_pred"] for r in L.languages(with_clashes(spark.createDataFrame(data, "doc_id bigint, text string, lang string"))).collect()}
    unseen = [got[k] == g for k, _, g in data if held(k)]
    assert len(unseen) > 15 and np.mean(unseen) > 0.95


def test_quality_with_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    plain = rows(Q.quality_scores(docs, labels))
    assert rows(Q.quality_scores(with_clashes(docs).withColumn("score", F.lit("x")), with_clashes(labels).withColumn("text", F.lit(1)))) == plain


def test_language_of_odd_texts(spark):
    table = [(1, None, "en"), (2, "", "en"), (3, "123 !! ", None), (4, "the the", "en"), (None, "der die", "de"), (6, "日本", None), (7, "der und die das", "de"), (8, "the of and", "en")]
    df = spark.createDataFrame(table, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.languages(df).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en" and got[6][0] in ("en", "de")
    assert L.languages(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in L.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_quality_on_held_out_documents(spark):
    got = {r["doc_id"]: r for r in Q.op5_quality_classifier(spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if held(r["doc_id"])]
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held(k) and r["predicted"] == int(r["score"] >= 0.7) for k, r in got.items())
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    assert np.mean(right) > 0.95


def test_forest_against_a_plain_walk_and_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    forest = Q.train(x[:2000], y[:2000])
    scores = forest.score(x)
    assert ((scores[2000:] > 0.5) == (y[2000:] > 0.5)).mean() > 0.97
    for row, score in zip(x[:20], scores):
        total = forest.base
        for feature, limit, value in zip(forest.feature, forest.limit, forest.value):
            node = 0
            for _ in range(Q.DEPTH):
                node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
            total += value[node - (1 << Q.DEPTH) + 1]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_statistics_do_not_depend_on_the_batch():
    texts = ["A b c c c!\nd", None, "", "  ", "word " * 50, "x" * 3000, "É|é 12"]
    whole = Q.statistics(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert np.allclose(Q.statistics(pa.array([t], pa.string()))[0], whole[k])
    assert not whole[1].any() and not whole[2].any()


def test_quality_without_labels_and_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "c"), (2, None), (2, "")], "doc_id bigint, text string")
    none = spark.createDataFrame([(1, None), (None, 1), (99, 1)], "doc_id bigint, quality int")
    assert [r["score"] for r in Q.quality_scores(docs, none).collect()] == [0.5] * 4
    assert Q.quality_scores(docs.limit(0), none).count() == 0


def test_stage_drops_rejected_documents_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r["doc_id"]: r["predicted"] for r in Q.op5_quality_classifier(spark, SF).collect()}
    out = Q.drop_rejected(spark, docs, SF)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {k for k, v in scores.items() if v}
