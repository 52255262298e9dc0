"""op7 against a count of every window, and the column-wise sort alone."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from .conftest import corpus, rows, with_clashes
from trackmart.llm import suffix_dedup as S


def brute(table, length):
    data = [(r[0], (r[1] or "").encode()) for r in table]
    seen = Counter(t[k:k + length] for _, t in data for k in range(len(t) - length + 1))
    out = []
    for doc, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = b"\x01" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("length", [400, 120, 40])
def test_against_every_window(spark, docs, length):
    got = rows(S.repeat_digest(with_clashes(docs), length=length))
    assert got == brute(corpus(), length)
    assert any(r[2] not in (0, r[1]) for r in got)


@pytest.mark.parametrize("group", [1, 2, 3])
def test_groups_too_large_to_gather(spark, monkeypatch, group):
    monkeypatch.setattr(S, "GROUP", group)
    rng = np.random.default_rng(4)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared, half = letters(130), letters(70)
    table = [(k, letters(50) + shared[k % 3:120 + k % 4] + letters(40) + half[: 40 + k]) for k in range(14)]
    df = spark.createDataFrame(table, "doc_id bigint, text string")
    assert rows(S.repeat_digest(df, length=60)) == brute(table, 60)


@pytest.mark.parametrize("group", [2, 16_384])
def test_passages_of_very_many_texts(spark, monkeypatch, group):
    """Anchors, surroundings and groups told by literals, not by a join."""
    monkeypatch.setattr(S, "GROUP", group)
    monkeypatch.setattr(S, "COMMON_LEAST", 3)
    rng = np.random.default_rng(7)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared, pair = letters(150), letters(90)
    table = [(k, letters(50) + (shared if k % 2 else shared[5 * (k % 8):]) + letters(30 + k)) for k in range(40)]
    table += [(100 + k, letters(70) + pair + letters(20)) for k in range(2)] + [(200 + k, shared) for k in range(3)] + [(300, letters(500))]
    df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)
    assert rows(S.repeat_digest(df, length=60)) == brute(table, 60)


def test_parts_of_two_anchors_at_one_byte(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 2)
    rng = np.random.default_rng(0)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = letters(150)
    table = [(k, letters(50) + shared[5 * k:] + letters(40)) for k in range(12)]
    df = spark.createDataFrame(table, "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)  # all groups in one block
    try:
        assert rows(S.repeat_digest(df, length=60)) == brute(table, 60)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_text_does_not_match_itself():
    text = bytes(range(97, 123)) * 3
    cut = [(b"k", h, lo, place, hi, text[place - hi:place - lo + 60]) for h, lo, place, hi in [(5, 0, 11, 5), (6, 6, 17, 11), (7, 6, 17, 11)]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*cut)], names=["key", "hash", "lo", "place", "hi", "bytes"])
    assert [len(b) for b in S._sorter(60)(iter([batch]))] == [0]


def test_null_ids_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "ab" * 300), (1, "ab" * 300), (None, "q" * 399), (None, None), (2, "")], "doc_id bigint, text string")
    assert rows(S.repeat_digest(df)) == brute([tuple(r) for r in df.collect()], 400)
    assert S.repeat_digest(df.limit(0)).count() == 0


def test_column_wise_sort(spark):
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, columns, length = int(rng.integers(1, 30)), int(rng.integers(6, 20)), int(rng.integers(2, 6))
        grid = rng.integers(97, 99, (n, columns)).astype(np.uint8)
        grid[:, :3][rng.random((n, 3)) < 0.1] = 0xFF
        got = S.repeated_windows(grid, length)
        for j in range(columns - length + 1):
            windows = [tuple(grid[k, j:j + length]) for k in range(n)]
            seen = Counter(windows)
            assert got[j].tolist() == [seen[w] > 1 and 0xFF not in w for w in windows]


def test_stage_rewrites_texts_and_keeps_rows(spark, docs):
    out = S.remove_repeats(spark, docs, "", length=120)
    assert out.columns == docs.columns and out.count() == docs.count()
    want = {r[0]: r[4] for r in brute(corpus(), 120)}
    for r in out.collect():
        if r["text"] is not None and r["text"].isascii():
            assert hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"]]
            assert r["n_chars"] == len(r["text"])


def brute_words(texts, least):
    """The words left of each text, without those under a run of ``least``
    words that stands twice."""
    lists = [(t or "").split() for t in texts]
    seen = Counter(tuple(own[k:k + least]) for own in lists for k in range(len(own) - least + 1))
    out = []
    for own in lists:
        gone = {j for k in range(len(own) - least + 1) if seen[tuple(own[k:k + least])] > 1 for j in range(k, k + least)}
        out.append([w for j, w in enumerate(own) if j not in gone])
    return out


@pytest.mark.parametrize("least", [51, 12])
def test_stage_counts_words(spark, docs, least):
    rng = np.random.default_rng(6)
    short = lambda n: " ".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    wide = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 12)) for _ in range(n))
    table = [(r[0], r[1]) for r in corpus()]
    for k, passage in enumerate([short(least), wide(least - 1), wide(least), short(least + 30), " ".join(["\u00e9", *["y"] * (least + 4), "z"])]):
        table += [(1000 + 10 * k + j, f"{wide(20 + j)} {passage}{end}") for j, end in enumerate(["", f" {wide(9)}", f"\n{wide(70)}"])]
    df = spark.createDataFrame(table, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in S.remove_repeats(spark, df, "", least=least).collect()}
    assert len(got) == len(table) and S.remove_repeats(spark, df, "", least=least).count() == len(table)
    assert [(got[k] or "").split() for k, _ in table] == brute_words([t for _, t in table], least)
    assert all(got[1010 + j] == dict(table)[1010 + j] for j in range(3))  # one word too few, whatever its bytes


def test_copies_that_share_a_passage_stay_one_row_each(spark):
    rng = np.random.default_rng(8)
    wide = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 9)) for _ in range(n))
    shared, own = wide(60), wide(40)
    df = spark.createDataFrame([(1, f"{shared} {own}"), (2, f"{shared} {own}"), (3, f"{wide(30)} {shared}")], "doc_id bigint, text string")
    for length in (None, 200):
        assert sorted(r["doc_id"] for r in S.remove_repeats(spark, df, "", length=length).collect()) == [1, 2, 3]


def test_words_of_scripts_without_spaces():
    texts = ["ab  c\n", "", "\u6f22\u5b57 x\u4e2dy", " \u00e9t\u00e9", "\u0e01\u0e02z"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    starts, ends = S.word_ranges(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert [b"".join(raw)[a:b].decode() for a, b in zip(starts, ends)] == ["ab", "c", "\u6f22", "\u5b57", "x", "\u4e2d", "y", "\u00e9t\u00e9", "\u0e01", "\u0e02", "z"]


def test_passages_of_over_fifty_words_under_and_over_400_bytes(spark):
    """The query goes by bytes (its contract), the pipeline's stage by words."""
    rng = np.random.default_rng(11)
    text = lambda n, size: " ".join("".join(map(chr, rng.integers(97, 123, size))) for _ in range(n))
    short, long = text(55, 5), text(55, 8)  # 329 and 494 bytes
    table = [(k, f"{text(40, 6)} <{k}> {passage} <{k}> {text(40, 6)}") for k, passage in enumerate([short, short, long, long, ""])]
    df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r for r in S.repeat_digest(df).collect()}
    assert {k: got[k]["n_bytes"] for k, _ in table} == {k: len(t) for k, t in table}  # of the input, whatever is removed
    assert [got[k]["n_removed"] for k, _ in table] == [0, 0, 498, 498, 0]  # with "> " and " <" around it
    stage = {r["doc_id"]: r["text"] for r in S.remove_repeats(spark, df, "").collect()}
    assert [short in stage[k] or long in stage[k] for k, _ in table] == [False] * 5
    assert stage[4] == table[4][1]
