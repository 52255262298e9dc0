"""The conversation trie against plain Python, its arrays, and the contract's
SQL (run by ``test_contract_sql.py``)."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from .conftest import SF001, rows, with_clashes
from trackmart.llm.common import table
from trackmart.llm.prefix_trie import conversation_trie, pack

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(data, family=20):
    def mark(t):
        role, text = t[2] or "", t[3] or ""
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    turns = defaultdict(list)
    for t in sorted((t for t in data if t[0] is not None), key=lambda t: (t[1] is not None, t[1] or 0, mark(t))):
        turns[t[0]].append((t[2] or "", t[3] or ""))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % family, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def total(node):
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [total(k) for k in kids[node]]
        return (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(kids[node]),
                    *total(node), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def conversations(seed, n=160, long=9):
    rng = random.Random(seed)
    texts = ["", None, "one", "two  words", "a\tb c d", "żółć ñ", "x " * 30]
    roles = ["user", "assistant", None, ""]
    out = []
    for c in range(-25, n):
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([0, 1, 2, 3, 4, long])):
            out.append((c, t, roles[t % 2] if rng.random() < 0.9 else rng.choice(roles), texts[rng.randrange(3)] if t < 3 else rng.choice(texts)))
    out += [(3, None, "user", "first of all"), (3, None, "user", "first of all"), (3, 1, "user", "a tie"), (5, 0, "user", "again"), (5, 0, "user", "again"), (None, 0, "user", "nobody's")]
    out += [(1000 + k, t, "user", f"common {t}") for k in range(60) for t in range(6)]  # one hot conversation
    return out


@pytest.mark.parametrize("size,limit", [(4096, 400_000), (4096, 40), (3, 40)])
def test_against_brute_force(spark, size, limit):
    data = conversations(3)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    assert rows(conversation_trie(df, size, limit)) == brute(data)


def test_one_conversation_over_many_partitions(spark):
    data = [(7, t, "user", f"turn {t % 50}") for t in range(3000)] + [(8, 1, "user", "short")]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    out = {(r.conv_id, r.depth): r for r in conversation_trie(df, 700, 500).collect()}
    own = 3000 - zlib.crc32(b"7") % 4  # there is no conversation 0 to borrow from
    assert len(out) == 1 + own + (zlib.crc32(b"8") % 4 == 0)
    assert out[7, 0].n_convs == 2 and out[7, own].n_children == 0 and out[7, own].parent_conv_id == 7


def test_other_columns_and_empty_tables(spark):
    data = conversations(5, 40)
    df = spark.createDataFrame(data, SCHEMA)
    clash = with_clashes(df)
    for name in ("a", "b", "n", "pos", "path", "part", "seg", "conv", "copies", "first", "last", "mark", "h"):
        clash = clash.withColumn(name, clash.text)
    assert rows(conversation_trie(clash)) == brute(data)
    assert conversation_trie(df.limit(0)).collect() == []


def test_whole_small_table(spark):
    df = table(spark, SF001, "conversations")
    assert rows(conversation_trie(df)) == brute([tuple(r) for r in df.collect()])


def test_packed_arrays_hold_the_sequences_and_nothing_else():
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, 40, rng.integers(0, 9)) for _ in range(600)] + [np.array([k]) for k in range(40)]
    offsets = np.append(0, np.cumsum([len(s) for s in seqs]))
    trie, codes = pack(np.concatenate(seqs).astype(np.int64), offsets)
    met = {}
    for k, s in enumerate(seqs):
        at = np.zeros(1, np.int64)
        for j in range(len(s)):
            at = trie.step(at, codes[offsets[k] + j:offsets[k] + j + 1])
            assert at[0] > 0
            assert met.setdefault(tuple(s[:j + 1]), at[0]) == at[0]
    assert len(set(met.values())) == len(met) == (trie.check >= 0).sum() - 1
    assert trie.step(np.array([0]), np.array([41]))[0] == -1
