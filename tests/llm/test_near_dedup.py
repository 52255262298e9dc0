"""op2 and the components against brute force over all pairs."""

import random
import re

import pytest

from .conftest import corpus, rows, with_clashes
from trackmart.llm import near_dedup
from trackmart.llm.components import components


def sets(texts, n):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        out.append(frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[k:k + n]) for k in range(len(w) - n + 1)]) if w else frozenset())
    return out


def brute(table, n):
    ids, shingles = [r[0] for r in table], sets([r[1] for r in table], n)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(ids)):
        for b in range(a):
            x, y = shingles[a], shingles[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[max(find(a), find(b), key=lambda k: ids[k])] = min(find(a), find(b), key=lambda k: ids[k])
    return sorted(((ids[k], len(shingles[k]), ids[find(k)], ids[k] == ids[find(k)]) for k in range(len(ids))),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("n", [4, 5])
def test_against_all_pairs(spark, docs, n):
    assert rows(near_dedup.near_duplicates(with_clashes(docs), n_words=n)) == brute(corpus(), n)


def test_large_near_group_joins_at_its_centre(spark, monkeypatch):
    rng = random.Random(2)
    base = [f"b{k}" for k in range(150)]
    table = [(0, " ".join(base))]
    for k in range(1, 90):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        table.append((k, " ".join(copy)))
    df = spark.createDataFrame(table, "doc_id bigint, text string")
    assert rows(near_dedup.near_duplicates(df, n_words=4)) == brute(table, 4)


def test_large_tables_that_do_not_join_at_their_centre(spark, monkeypatch):
    """Pages of one template with bodies of their own: a third of the classes
    share table keys, and only some pairs among them are linked."""
    monkeypatch.setattr(near_dedup, "FEW", 3)
    rng = random.Random(14)
    template = [f"t{k}" for k in range(120)]
    parts = [[f"p{j}x{k}" for k in range(30)] for j in range(9)]
    table = [(k, " ".join(template + [w for j in rng.sample(range(9), 2) for w in parts[j]] + [f"own{k}x{i}" for i in range(rng.randrange(12))])) for k in range(80)]
    table += [(500 + k, " ".join(f"v{rng.randrange(5000)}" for _ in range(100))) for k in range(60)]
    df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(4)
    want = brute(table, 4)
    assert rows(near_dedup.near_duplicates(df, n_words=4)) == want
    assert 60 < len({r[2] for r in want}) < 140


def test_stage_keeps_one_row_of_a_group(spark):
    rng = random.Random(6)
    a, b, c = (" ".join(f"w{rng.randrange(9999)}" for _ in range(80)) for _ in range(3))
    table = [(5, a), (3, a), (None, a), (None, b), (None, b), (None, None), (7, c), (7, c), (9, ""), (11, None)]
    df = spark.createDataFrame([(*r, "x") for r in table], "doc_id bigint, text string, num string")
    out = near_dedup.keep_first_of_group(spark, df, "")
    assert out.columns == df.columns
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key) == sorted([(3, a), (None, b), (None, None), (7, c), (7, c), (9, ""), (11, None)], key=key)
    assert near_dedup.keep_first_of_group(spark, df.limit(0), "").count() == 0


def test_links_the_centre_does_not_have(spark):
    """A chain of texts, each linked with the next only."""
    base = [f"b{k}" for k in range(300)]
    table = [(k, " ".join([f"x{j}" for j in range(12 * k)] + base[12 * k:])) for k in range(12)]
    want = brute(table, 4)
    assert {r[2] for r in want} == {0}
    assert rows(near_dedup.near_duplicates(spark.createDataFrame(table, "doc_id bigint, text string"), n_words=4)) == want


def test_null_ids_repeated_rows_and_no_rows(spark):
    schema = "doc_id bigint, text string"
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "x y z"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None)], schema)
    assert rows(near_dedup.near_duplicates(df, n_words=4)) == [
        (3, 3, 3, True), (3, 3, 3, True), (4, 0, 4, True), (None, 1, None, True), (None, 3, 3, False)]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_stage_keeps_one_of_each_group_and_all_columns(spark, docs):
    kept = near_dedup.keep_first_of_group(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in brute(corpus(), 5) if r[3])


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 201: 200, 202: 200}
