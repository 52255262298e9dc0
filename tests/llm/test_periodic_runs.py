"""Runs of words against a comparison of every word with every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from .conftest import SF001, rows, with_clashes
from trackmart.llm import periodic_runs as P
from trackmart.llm.common import table

SCHEMA = "doc_id bigint, text string"


def runs_of(words, least=24):
    """``{(start, length): smallest period}``, every period tried."""
    codes = {}
    seq = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    out = {}
    for q in range(1, len(seq) // 3 + 1):
        same = np.concatenate([[0], (seq[:-q] == seq[q:]).astype(np.int8), [0]])
        step = np.diff(same)
        for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            if b - a + q >= max(least, 3 * q):
                out.setdefault((a, b - a + q), q)
    return out


def brute(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(a, size, q) for (a, size), q in runs_of(words).items()]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for a, size, q in runs for i in range(a + q, a + size)}
    listed = "".join(f"{a},{size},{q}\n" for a, size, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def expected(data, plant=True):
    return sorted((brute(*d, plant) for d in data), key=lambda r: tuple((x is None, str(x)) for x in r))


def periodic_texts(seed, n):
    """Runs of many periods, runs in runs, and periods that hold long runs."""
    rng = random.Random(seed)
    word = lambda size: f"w{rng.randrange(size)}"

    def unit(depth):
        kind = rng.randrange(4)
        if depth == 0 or kind == 0:
            return [word(rng.choice([2, 3, 50])) for _ in range(rng.randrange(1, 12))]
        if kind == 1:
            return unit(depth - 1) * rng.randrange(2, 9)
        if kind == 2:
            return [word(3)] * rng.randrange(5, 60) + unit(depth - 1)
        return unit(depth - 1) + unit(depth - 1)
    out = []
    for k in range(n):
        words = []
        for _ in range(rng.randrange(1, 5)):
            u = unit(3)[:rng.choice([40, 300])]
            words += u * rng.randrange(1, 6) + u[:rng.randrange(len(u))]
            words += [word(40) for _ in range(rng.randrange(0, 30))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_cubic_runs_against_every_period(seed):
    """Many texts laid end to end, as in the operator."""
    texts = [t.split() for t in periodic_texts(seed, 60)]
    data = np.frombuffer("".join(" ".join(t) for t in texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(" ".join(t)) for t in texts]))
    out = P._digests(list(range(len(texts))), data, offsets, False, 24)
    for words, row in zip(texts, out, strict=True):
        assert row == brute(None, " ".join(words), False)[1:]


def test_binary_words():
    """Two letters only: every substring comes again, periods nest."""
    rng = random.Random(9)
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    texts = [" ".join(fib[-1])] + [" ".join(rng.choice("ab") for _ in range(500)) for _ in range(20)]
    texts += [" ".join((u := "".join(rng.choice("ab") for _ in range(rng.randrange(8, 90)))) * 4 + u[:5]) for _ in range(60)]
    texts += [" ".join(("a" * k + "b") * 5) for k in range(1, 90, 4)] + [" ".join(("a" * k + "b" + "a" * (k + 3) + "c") * 4) for k in range(1, 90, 4)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    out = P._digests(list(range(len(texts))), data, np.append(0, np.cumsum([len(t) for t in texts])), False, 24)
    for text, row in zip(texts, out, strict=True):
        assert row == brute(None, text, False)[1:]


def test_query_rows(spark):
    texts = [*periodic_texts(40, 40), "", None, "  \t ", "one", "a " * 23, "a " * 24, "a b " * 30, "ż é " * 40, "x " * 9000 + "y " + "x y z " * 400]
    data = [(k, t) for k, t in enumerate(texts * 2)] + [(None, "p q " * 20), (3, texts[3])]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    assert rows(P.run_digest(df, plant=True)) == expected(data)
    assert rows(P.run_digest(df)) == expected(data, False)
    assert rows(P.run_digest(with_clashes(df).withColumn("start", df.text), plant=True)) == expected(data)
    assert P.run_digest(df.limit(0)).collect() == []


def test_whole_small_table(spark):
    df = table(spark, SF001, "documents").select("doc_id", "text")
    assert rows(P.op12_periodic_runs(spark, SF001)) == expected([tuple(r) for r in df.collect()])
