"""Small tables for the operators: nulls, empty and long texts, ties, copies
and columns whose names clash with working ones."""

import random

import pytest

from trackmart.llm.common import prepare

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}x" for _ in range(n))


def corpus(seed=5):
    """Plain, empty, null, copied, nearly copied, repeated and long texts."""
    rng = random.Random(seed)
    base = [words(rng, 60 + 5 * k) for k in range(12)]
    texts = [*base, base[0], base[1], "", None, "one two", "ONE  two", "   ", words(rng, 6000), "żółć ñandú " * 90]
    near = base[2].split()
    for k in (5, 20, 40):
        copy = list(near)
        copy[k] = "changed"
        texts.append(" ".join(copy))
    passage = words(rng, 120, 10_000)
    texts += [f"{words(rng, 30)} {passage} {words(rng, 30)}" for _ in range(4)]
    texts += ["ab" * 700, "tail " + words(rng, 20)]
    return [(10 * k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


CLASH = ("id", "key", "num", "size", "text2", "row", "cls", "unit", "salt", "mark", "hash", "place", "spots", "words", "own", "uid", "rank")


def with_clashes(df):
    """The same rows with many more columns of odd names."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
