"""op8: signed deltas against recounting, replays and broken commits."""

import random

from .conftest import corpus, with_clashes
from trackmart.llm import token_rollup as R
from trackmart.llm.tokens import vocabulary


def totals(rollup):
    return sorted((str(r["source"]), str(r["lang"]), str(r["tokenizer"]), r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect())


def recount(state):
    out = {}
    for (doc, tokenizer), (source, lang, n) in state.items():
        d, t = out.get((str(source), str(lang), str(tokenizer)), (0, 0))
        out[str(source), str(lang), str(tokenizer)] = (d + 1, t + n)
    return sorted((*k, *v) for k, v in out.items())


def test_random_batches_against_recounting(spark, tmp_path):
    rng, rollup, state = random.Random(1), R.TokenRollup(spark, str(tmp_path / "r")), {}
    for batch in range(4):
        changes = {}
        for _ in range(40):
            key = (rng.randrange(25), rng.choice(["v1", "v2"]))
            changes[key] = (rng.choice(["insert", "delete", "revise"]), rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.randrange(100))
        rows = [(op, *key, source, lang, n) for key, (op, source, lang, n) in changes.items()]
        df = with_clashes(spark.createDataFrame(rows + rows[:5], R.CHANGES))  # some rows twice
        assert rollup.commit(f"b{batch}", df)
        for key, (op, source, lang, n) in changes.items():
            if op == "delete":
                state.pop(key, None)
            else:
                state[key] = (source, lang, n)
        assert totals(rollup) == recount(state)
        assert not rollup.commit(f"b{batch}", df) and totals(rollup) == recount(state)
    assert {(r["doc_id"], r["tokenizer"]): (r["source"], r["lang"], r["n_tokens"]) for r in rollup.state().collect()} == state


def test_commit_broken_between_its_parts_is_done_anew(spark, tmp_path):
    rollup = R.TokenRollup(spark, str(tmp_path / "r"))
    rollup.commit("one", spark.createDataFrame([("insert", 1, "v", "s", "en", 5)], R.CHANGES))
    rollup.commit("two", spark.createDataFrame([("revise", 1, "v", "s", "en", 9)], R.CHANGES))
    (tmp_path / "r" / "totals" / "two" / "_SUCCESS").unlink()
    assert totals(rollup) == [("s", "en", "v", 1, 5)]
    assert rollup.commit("two", spark.createDataFrame([("revise", 1, "v", "s", "en", 9)], R.CHANGES))
    assert totals(rollup) == [("s", "en", "v", 1, 9)]


def test_nulls_conflicts_and_empty_batches(spark, tmp_path):
    rollup = R.TokenRollup(spark, str(tmp_path / "r"))
    assert totals(rollup) == [] and rollup.commit("none", spark.createDataFrame([], R.CHANGES)) and totals(rollup) == []
    rollup.commit("x", spark.createDataFrame([(None, None, None, None, None, None), ("insert", 1, "v", "s", "en", 3), ("insert", 1, "v", "s", "en", 4)], R.CHANGES))
    assert totals(rollup) == [("None", "None", "None", 1, 0), ("s", "en", "v", 1, 4)]
    rollup.commit("y", spark.createDataFrame([("delete", None, None, None, None, None), ("delete", 8, "v", None, None, None)], R.CHANGES))
    assert totals(rollup) == [("s", "en", "v", 1, 4)]


def test_query_counts_every_document(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary())
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["source"]: (r["n_docs"], r["n_tokens"], r["tokenizer"]) for r in R.op8_token_counts(spark, str(tmp_path)).collect()}
    want = {}
    for _, text, _, source, _ in corpus():
        d, t, _ = want.get(source, (0, 0, ""))
        want[source] = (d + 1, t + len(tokenizer.encode(text or "", add_special_tokens=False).ids), "word_bpe_49k")
    assert got == want
