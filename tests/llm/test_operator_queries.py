"""The registered queries over the smallest tables, each against a brute-force version."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from almanack.llm import embeddings, fingerprints, licenses, lines, mixing, ngrams, packing, quality, substrings, toxicity

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.fixture(scope="module")
def documents():
    rows = duckdb.sql(f"select * from '{D}/documents.parquet' order by doc_id").df()
    rows["text"] = [t if isinstance(t, str) else None for t in rows["text"]]
    rows["source"] = [t if isinstance(t, str) else None for t in rows["source"]]
    return rows


def rows_of(frame, key):
    out = {}
    for r in frame.collect():
        assert r[key] not in out
        out[r[key]] = r
    return out


def roots(pairs, nodes):
    top = {x: x for x in nodes}

    def root(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in pairs:
        u, v = root(a), root(b)
        top[max(u, v)] = min(u, v)
    return {x: root(x) for x in nodes}


def near_sets(sets, percent):
    """Pairs of numbers of sets with ``100 * shared >= percent * united``, by an inverted index."""
    holders, pairs = defaultdict(list), []
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                shared[j] += 1
            holders[x].append(i)
        pairs += [(j, i) for j, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
    return pairs


def line_sets(texts):
    first = {}
    for k, text in enumerate(texts):
        for i, line in enumerate((text or "").split("\n")):
            if line.strip():
                first.setdefault(line, (k, i))
    names = list(first)
    sets = [{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in names]
    linked = roots(near_sets(sets, 80), range(len(names)))
    return {names[i]: first[names[r]] for i, r in linked.items()}


def test_op9_keeps_the_lines_that_brute_force_keeps(spark, documents):
    kept = line_sets(documents["text"])
    got = rows_of(lines.op9_line_dedup(spark, D), "doc_id")
    for k, (doc, text) in enumerate(zip(documents["doc_id"], documents["text"])):
        every = (text or "").split("\n")
        gone = [bool(x.strip()) and kept[x] != (k, i) for i, x in enumerate(every)]
        n = sum(bool(x.strip()) for x in every)
        left = "" if sum(gone) and sum(gone) == n else "\n".join(x for x, out in zip(every, gone) if not out)
        assert (got[doc]["n_lines"], got[doc]["n_removed"]) == (n, sum(gone)), doc
        assert got[doc]["kept_sha256"] == hashlib.sha256(left.encode()).hexdigest(), doc


def test_op9_short_and_crowded_lines_lose_no_links(spark):
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    pairs = []
    for size in (8, 9, 10, 12, 14, 20, 30, 60):
        for _ in range(150):
            a = "".join(letters[rng.integers(0, 26, size)])
            pairs.append((a, a + str(letters[rng.integers(0, 26)])))
    stem = "".join(letters[rng.integers(0, 26, 200)])
    crowd = [stem[:k] + "#" + stem[k + 1 :] for k in range(200)]
    texts = [x for p in pairs for x in p] + crowd
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    left = {r["doc_id"] for r in lines.dedup_lines(docs).collect()}
    lost = sum(2 * i + 1 in left for i in range(len(pairs)))
    assert lost <= len(pairs) * 0.01
    assert all(2 * i in left for i in range(len(pairs)))
    assert len([x for x in left if x >= 2 * len(pairs)]) == 1


def test_op9_a_block_larger_than_a_task_is_compared_by_keys(spark, monkeypatch):
    monkeypatch.setattr(lines, "TASK_RUNS", 400)
    base = "the quick brown fox jumps over the lazy dog near the river bank %04d"
    texts = [base % i for i in range(40)] + ["nothing like the others at all, number one", "nothing like the others at all, number two"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = line_sets(texts)
    assert {r["doc_id"] for r in lines.dedup_lines(docs).collect()} == {k for k, _ in kept.values()}


def test_op7_links_and_components(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{D}/embeddings.parquet' order by vec_id").df()
    check_vectors(spark, rows["vec_id"].tolist(), np.stack(rows["embedding"].to_list()).astype(float), embeddings.op7_embedding_near_dedup(spark, D))


def check_vectors(spark, ids, x, got, recall=0.99):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = rows_of(got, "vec_id")
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= near.sum(1)).all()
    has = near.sum(1) > 0
    assert found.sum() == near.sum() == 0 or (found[has] / near.sum(1)[has]).mean() >= recall
    want = roots(np.argwhere(near).tolist(), range(len(ids)))
    same = [got[i]["component_id"] == ids[want[k]] for k, i in enumerate(ids)]
    assert np.mean(same) >= recall
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in ids)


def test_op7_a_dense_third_of_the_vectors(spark):
    rng = np.random.default_rng(8)
    lone = rng.standard_normal((1200, 32))
    twins = lone[:200] + 0.03 * rng.standard_normal((200, 32))
    dense = rng.standard_normal(32) + 0.05 * rng.standard_normal((700, 32))
    x = np.concatenate((lone, twins, dense)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    check_vectors(spark, list(range(len(x))), x.astype(float), embeddings.near_vectors(table))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_op1_targets_and_order(spark, documents):
    rows = mixing.op1_mixing_sources(spark, D).collect()
    size = {i: len(words(t)) for i, t in zip(documents["doc_id"], documents["text"])}
    source = dict(zip(documents["doc_id"], documents["source"]))
    names = sorted({s for s in source.values() if s is not None}) + ([None] if None in source.values() else [])
    sums = {s: sum(n for i, n in size.items() if source[i] == s) for s in names}
    weight, free, target, left = {s: k % 3 + 1 for k, s in enumerate(names)}, set(names), {}, float(sum(sums.values()))
    while True:  # share, cut what is above its bound, share the rest again
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sums[s]}
        if not over:
            break
        target |= {s: 3.0 * sums[s] for s in over}
        left, free = left - sum(3.0 * sums[s] for s in over), free - over
    target |= share
    taken = defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sums[s]) and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows) and len(rows) == len(size)


def test_op2_components(spark, documents):
    sets = []
    for t in documents["text"]:
        w = words(folded(t))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    held = [i for i, s in enumerate(sets) if s]
    pairs = [(held[a], held[b]) for a, b in near_sets([sets[i] for i in held], 85)]
    want = roots(pairs, range(len(sets)))
    ids = documents["doc_id"].tolist()
    got = rows_of(ngrams.op2_ngram_jaccard_join(spark, D), "doc_id")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {ids[k]: (len(sets[k]), ids[want[k]]) for k in range(len(ids))}


def test_op3_places_and_licences(spark, documents):
    base = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    phrases = [(tuple(key.split()), label) for label, key, _ in licenses.TEMPLATES]
    got = rows_of(licenses.op3_license_scans(spark, D), "doc_id")
    for i, t in zip(documents["doc_id"], documents["text"]):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(t))

        def starts(phrase):
            return [k for k in range(len(w) - len(phrase) + 1) if tuple(w[k : k + len(phrase)]) == phrase]

        places = [(k, label) for phrase, label in base.items() for k in starts(phrase)]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places)), i
        assert (r["first_word"], r["last_word"]) == (min(places)[0] if places else None, max(places)[0] if places else None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        # a template is found where its whole key phrase stands
        assert r["labels"] == ",".join(sorted({label for _, label in places} | {label for phrase, label in phrases if starts(phrase)}))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_op4_bins(spark, documents):
    rows = [r for r in packing.op4_best_fit_packing(spark, D).collect()]
    size = {i: len(words(t)) for i, t in zip(documents["doc_id"], documents["text"])}
    plain = {i: " ".join((t or "").lower().split()) for i, t in zip(documents["doc_id"], documents["text"])}
    assert {r["doc_id"] for r in rows} == set(size) and all((r["bin"] is None) == (size[r["doc_id"]] == 0) for r in rows)
    bins, held = defaultdict(list), defaultdict(int)
    for r in rows:
        if r["bin"]:
            bins[r["bin"]].append(r)
            held[r["doc_id"]] += r["words"]
    assert held == {i: n for i, n in size.items() if n}
    for own in bins.values():
        spans = sorted((r["start"], r["start"] + r["words"]) for r in own)
        assert spans[0][0] == 0 and spans[-1][1] <= 2048 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        texts = [plain[r["doc_id"]] for r in own]
        assert len(set(texts)) == len(texts)


def test_op4_takes_the_tightest_bin_without_conflict():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(1, 60, 400))[::-1].copy()
    source, cluster = rng.integers(0, 30, 400), np.where(rng.random(400) < 0.3, rng.integers(0, 20, 400), -1)
    got, _ = packing.best_fit(sizes, source, cluster, 100)
    left, holds = [], []
    for k, (n, s, c) in enumerate(zip(sizes, source, cluster)):
        fit = [b for b in range(len(left)) if left[b] >= n and ("s", s) not in holds[b] and (c < 0 or ("c", c) not in holds[b])]
        b = got[k]
        if not fit:
            assert b == len(left)
            left.append(100)
            holds.append(set())
        else:
            assert b in fit and left[b] == min(left[x] for x in fit)
        left[b] -= n
        holds[b] |= {("s", s)} | ({("c", c)} if c >= 0 else set())


def chains(text):
    """The chains that sign a text, by hand: anchor, content word, next content word."""
    anchors = set(fingerprints.ANCHORS)
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if x]
    content = [(k, x) for k, x in enumerate(w) if x not in anchors]
    found = {(w[k - 1], x, content[j + 1][1] if j + 1 < len(content) else "") for j, (k, x) in enumerate(content) if k and w[k - 1] in anchors}
    return found or {(x, content[j + 1][1] if j + 1 < len(content) else "") for j, (k, x) in enumerate(content)}


def test_op5_edits_and_likeness(spark, documents):
    got = rows_of(fingerprints.op5_document_fingerprints(spark, D), "doc_id")
    order = sorted(zip(documents["doc_id"], [t or "" for t in documents["text"]]), reverse=True)
    signed = {}
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        n = len(t)
        k = n // 3
        edited = t[: n - k] + following[:k]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        for near, other, print_ in ((r["near_edited"], edited, r["edited_fingerprint"]), (r["near_next"], following, None)):
            a, b = chains(t), chains(other)
            want = len(a & b) / len(a | b) if a | b else float(t == other)
            assert near == pytest.approx(want, abs=1e-9), i
        assert signed.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert len(r["fingerprint"]) == 8 * len(chains(t))


def test_op5_similar_pairs_are_those_of_brute_force(spark):
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(150):
        base = rng.choice(500, rng.integers(3, 60), replace=False) if not sets or rng.random() < 0.5 else np.array(sets[rng.integers(len(sets))])
        sets.append(sorted(set(np.concatenate([base[rng.random(len(base)) > 0.08], rng.choice(500, rng.integers(0, 3))]).astype(int).tolist())))
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "id int, sigs array<int>")
    got = [(r["a"], r["b"]) for r in fingerprints.similar_pairs(rows, 0.8).collect()]
    classes = {}
    for i, s in enumerate(sets):
        if s:
            classes.setdefault(tuple(s), []).append(i)
    firsts = sorted(own[0] for own in classes.values())
    want = {(a, b) for a in firsts for b in firsts if a < b and len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b]))}
    want |= {(own[0], x) for own in classes.values() for x in own[1:]}
    assert len(got) == len(set(got)) and set(got) == want


def test_op6_removed_words(spark, documents):
    every = [words(t) for t in documents["text"]]
    seen = defaultdict(int)
    for w in every:
        for k in range(len(w) - 34):
            seen[tuple(w[k : k + 35])] += 1
    got = rows_of(substrings.op6_substring_dedup(spark, D), "doc_id")
    for i, w in zip(documents["doc_id"], every):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        kept = " ".join(x for x, out in zip(w, gone) if not out)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()), i


@pytest.mark.parametrize("query, label, mod, out, d", [(toxicity.op8_toxicity, "toxic", 5, 0, "/root/testdata/sf0.1"), (quality.op10_quality, "quality", 3, 1, "/root/testdata/sf0.01")])
def test_classifiers_hold_out_and_learn(spark, query, label, mod, out, d):
    known = dict(duckdb.sql(f"select doc_id, {label} from '{d}/labels.parquet' where {label} is not null").fetchall())
    rows = query(spark, d).collect()
    assert len(rows) == duckdb.sql(f"select count(*) from '{d}/documents.parquet'").fetchall()[0][0]
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == out)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in known:
            right.append(r["predicted"] == known[r["doc_id"]])
    assert len(right) > 50 and np.mean(right) >= 0.95
