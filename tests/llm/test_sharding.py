"""op9: the least capacity against exhaustive cuts, groups, slots and balance."""

import itertools
import zlib

import numpy as np

from .conftest import corpus, with_clashes
from trackmart.llm import sharding as S


def test_least_capacity_against_all_cuts():
    rng = np.random.default_rng(0)
    for _ in range(80):
        sizes, shards = rng.integers(1, 30, int(rng.integers(1, 9))), int(rng.integers(1, 5))
        best = min(max(sum(sizes[a:b]) for a, b in zip((0, *cuts), (*cuts, len(sizes))))
                   for cuts in itertools.combinations_with_replacement(range(len(sizes) + 1), shards - 1))
        assert S.least_capacity(sizes, shards) == best
        shard = S.partition(sizes, shards)
        loads = np.bincount(shard, sizes, shards)
        assert shard.max() < shards and loads.sum() == sizes.sum()


def test_partition_is_even_around_a_hot_unit():
    sizes = np.ones(1000, np.int64)
    sizes[400] = 2000
    loads = np.bincount(S.partition(sizes, 11), sizes, 11)
    assert sorted(loads)[-1] == 2000 and max(sorted(loads)[:-1]) - min(loads) <= 1


def check(got, table):
    assert len(got) == len(table)
    homes, slots, loads = {}, {}, {}
    texts = {}
    for doc, text in table:
        texts.setdefault(doc, []).append(text or "")
    for r in got:
        own = [t for t in texts[r["doc_id"]] if zlib.crc32(t.encode()) == r["text_crc32"]]
        assert own and r["size"] == len(own[0].encode()) + 1
        assert (r["law"], r["grown_shard"]) == ("bytes", None) and 0 <= r["shard"] < 16
        assert homes.setdefault(own[0], r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def test_shards(spark, docs):
    check(S.shard_documents(with_clashes(docs)).collect(), [r[:2] for r in corpus()])


def test_hot_group_is_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL_ROWS", 7)
    table = [(k, f"text {k} " * (k % 9 + 1)) for k in range(300)] + [(1000 + k, "copy") for k in range(150)] + [(5, "again")] * 40
    loads = check(S.shard_documents(spark.createDataFrame(table, "doc_id bigint, text string").repartition(4)).collect(), table)
    assert max(loads.values()) <= 1.25 * sum(loads.values()) / 16


def test_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, None), (None, ""), (7, "x")], "doc_id bigint, text string")
    check(S.shard_documents(df).collect(), [tuple(r) for r in df.collect()])
    assert S.shard_documents(df.limit(0)).count() == 0
