"""The corpus pipeline: stages, their order, planted cases and whole rows."""

import random
import re

import corpus_pipeline
from .conftest import SCHEMA, words


def test_stages_and_registration():
    import __spark_entry__
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "minhash near-dedup", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))


def test_planted_cases(spark, tmp_path):
    rng = random.Random(9)
    clean = [(k, words(rng, 90, 30_000)) for k in range(40)]
    junk = [(100 + k, "junk junk !! " * 60) for k in range(20)]
    near = clean[0][1].split()
    near[30] = "edit"
    passage = words(rng, 70, 30_000)
    item = words(rng, 30, 30_000)
    planted = [(200, " ".join(near)), (201, clean[1][1]), (202, f"{words(rng, 80, 30_000)} {passage}"), (203, f"{passage} {words(rng, 80, 30_000)}"),
               (204, f"{words(rng, 50, 30_000)} {item} {words(rng, 50, 30_000)}")]
    table = [(k, t, "en", "s", len(t)) for k, t in clean + junk + planted]
    spark.createDataFrame(table, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, 0) for k, _ in clean] + [(k, 0, 0) for k, _ in junk]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), docs.schema)
        left.append({r["doc_id"]: r["text"] for r in docs.collect()})
    everything = {k for k, _ in clean + planted}
    assert set(left[0]) == everything
    assert set(left[1]) == everything - {200, 201}
    assert set(left[2]) == set(left[1]) and not any(passage.split()[5] in left[2][k] for k in (202, 203))
    assert all(left[2][k] == dict(clean + planted)[k] for k in left[2] if k not in (202, 203))
    assert set(left[3]) == set(left[2]) - {204}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(left[3])


def test_passages_are_counted_in_words(spark, tmp_path):
    rng = random.Random(12)
    short, wide = " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=51)), words(rng, 50, 10**9)
    assert len(short) == 101 and len(wide) > 250
    table = [(k, f"{words(rng, 80, 30_000)} {passage} {words(rng, 80, 30_000)}", "en", "s", 0) for k, passage in enumerate([short, short, wide, wide])]
    docs = spark.createDataFrame(table, SCHEMA)
    got = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["suffix-array dedup"](spark, docs, str(tmp_path)).collect()}
    assert all(short not in got[k] and len(got[k].split()) == 160 for k in (0, 1))
    assert all(got[k] == table[k][1] for k in (2, 3))


def test_empty_tables_and_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    good = [(k, words(rng, 90, 30_000)) for k in range(30)]
    rows = good + [(100 + k, "junk junk !! " * 60) for k in range(20)] + [(None, None), (None, ""), (7, good[7][1]), (None, good[8][1]), (60, words(rng, 9000, 30_000))]
    frame = spark.createDataFrame([(k, t, "en", "s", None) for k, t in rows], SCHEMA)
    labels = spark.createDataFrame([(k, 1, 0) for k, _ in good] + [(100 + k, 0, 0) for k in range(20)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(None, words(rng, 40, 30_000)), (1, None)], "item_id bigint, text string")
    for name, docs, own in (("odd", frame, labels), ("none", frame.limit(0), labels), ("unlabelled", frame, labels.limit(0))):
        place = tmp_path / name
        for table, df in (("documents", docs), ("labels", own), ("benchmark", items)):
            df.write.parquet(str(place / f"{table}.parquet"))
        out = corpus_pipeline.run(spark, str(place)).collect()
        kept = {r["doc_id"] for r in out}
        if name == "odd":
            assert {k for k, _ in good} | {60} <= kept <= {k for k, _ in good} | {60, None}
        else:
            assert not kept
