import numpy as np
from pyspark.sql import functions as F

from almanack.llm import lines as L


def test_empty_bins_take_the_first_that_is_asked():
    rng = np.random.default_rng(5)
    some = np.where(rng.random((40, L.BINS)) < 0.1, rng.integers(0, 99, (40, L.BINS)).astype(np.uint64), L._EMPTY)
    some[:, 7] = 3
    asked = L._borrowed()
    want = [[row[b] if row[b] != L._EMPTY else next(row[a] for a in asked[b] if row[a] != L._EMPTY) for b in range(L.BINS)] for row in some]
    assert (L._filled(some) == np.array(want)).all() and len(L._filled(some[:0])) == 0


def test_texts_are_shuffled_once_and_ids_told_apart(spark):
    texts = "all one\nstays here"
    docs = spark.createDataFrame([(None, texts), ("", texts), ("i", texts), ("i", texts)], "doc_id string, text string")
    removed = L._rows(docs).where("id = ''").select("key", "id", F.array(F.lit(0)).alias("numbers"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.rewrite(docs, removed)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = {(r["row"]["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()}
        assert out.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # the texts and what is removed from them, each by the same columns
    assert plan.count("Exchange hashpartitioning(") == 2
    assert rows == {(None, texts, 2, 0), ("", "stays here", 2, 1), ("i", texts, 2, 0)}


def test_keys_do_not_depend_on_how_lines_are_cut(monkeypatch):
    rng = np.random.default_rng(3)
    some = ["".join(rng.choice(list("ab cd"), int(n))) for n in rng.integers(1, 400, 60)] + ["a" * 900, "abcd", "\U0001f600b", "\ud800x"]
    at_once = L.meeting_keys(some)
    monkeypatch.setattr(L, "SLICE", 64)
    cut = L.meeting_keys(some)
    assert all((a == b).all() for a, b in zip(at_once, cut))
    for i, line in enumerate(some):
        keys, _, sketch, runs = L.meeting_keys([line])
        assert (keys == at_once[0][at_once[1][i] : at_once[1][i + 1]]).all() and (sketch == at_once[2][i]).all() and runs == at_once[3][i]
        assert set(L._runs([line])[0].tolist()) == {hashed(line[k : k + L.RUN]) for k in range(max(1, len(line) - L.RUN + 1))}


def hashed(run):
    h = L.hash_short(run) if len(run) < L.RUN else L.hash_short(run) - len(run) * pow(int(L._BASE), len(run), 1 << 64)
    h %= 1 << 64
    h ^= h >> 29
    h = h * int(L._TOP) % (1 << 64)
    return h ^ (h >> 32)
