"""Each operator against brute force on small fixtures, and the odd inputs that must not crash it."""

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from almanack.llm import embeddings, fingerprints, hashing, licenses, lines, mixing, ngrams, packing, quality, signs, substrings, toxicity, trie
from almanack.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken string"
WORDS = "alpha beta gamma delta omega kappa sigma theta lambda zeta eta iota".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(rng.integers(0, 50)) for i in rng.integers(0, len(WORDS), n))


BASE = prose(1, 120)
TEXTS = [
    BASE, BASE, BASE + " more", prose(2, 60) + "\n" + BASE, None, "", " \n\t", "one", "one two", "Released under the MIT License.", "MIT\nLICENSE mit license",
    prose(3, 400), prose(3, 400).replace("alpha", "ALPHA", 2), "é" * 50 + " naïve straße", "same line here\nsame line here\nother line that is long enough", "the cat of the dog and the bird",
]
ROWS = [(i, t, "en", "s%d" % (i % 3) if i % 5 else None, len(t or ""), "x") for i, t in enumerate(TEXTS)] + [(0, BASE, "en", None, len(BASE), "x"), (None, prose(9, 50), None, "s1", None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_word_hashes_follow_the_pattern():
    texts = [t for _, t, *_ in ROWS]
    h, offsets = hashing.words(texts)
    assert np.diff(offsets).tolist() == [len(split(t)) for t in texts]
    flat = [w for t in texts for w in split(t)]
    assert len(set(zip(h.tolist(), flat))) == len(set(flat)) == len(set(h.tolist()))


def test_long_text_is_hashed_in_blocks_like_a_short_one():
    text = ("word " * 300_000) + "end"
    h, _ = hashing.words([text])
    assert len(set(h[:-1].tolist())) == 1 and h[0] == hashing.words(["word"])[0][0] and h[-1] == hashing.words(["end"])[0][0]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9), (None, 3), (7, 8), (8, 6), (6, 7)], "a long, b long")
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6), (8, 6)]


def test_components_are_not_cut_while_a_node_has_two_parents(spark):
    edges = spark.createDataFrame([(1, 5), (5, 6), (6, 7), (7, 2)], "a long, b long")
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 1), (5, 1), (6, 1), (7, 1)]


def test_mixing_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"] + 0.5)
        assert all(r["taken"] <= 3 * r["size"] and 0 <= r["position"] <= 1 for r in own)
    assert sum(r["target"] for r in {x["source"]: x for x in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))


def test_ngram_links_are_those_of_brute_force(docs):
    got = ngrams.link_components(docs).collect()
    sets = []
    for _, text, *_ in ROWS:
        w = split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    top = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = top[i], top[j]
                top = [min(a, b) if x in (a, b) else x for x in top]
    ids = [r[0] for r in ROWS]
    want = Counter((ids[k], len(sets[k]), min((ids[m] for m in range(len(top)) if top[m] == top[k] and ids[m] is not None), default=None)) for k in range(len(sets)))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want


def test_part_signs_lose_no_link():
    rng = np.random.default_rng(4)
    for percent in (80, 85):
        for n in (1, 3, 8, 25, 200):
            base = set(rng.integers(0, 1 << 62, n).tolist())
            sets = [base]
            for _ in range(12):
                s = set(base)
                for x in sorted(base)[: rng.integers(0, max(1, n // 8) + 1)]:
                    s.discard(x)
                sets.append(s | set(rng.integers(0, 1 << 62, rng.integers(0, max(1, n // 8) + 1)).tolist()))
            flat = np.array([x for s in sets for x in sorted(s)], np.uint64)
            sign, at = ngrams.signs(flat, np.cumsum([0, *map(len, sets)]), percent)
            signs = [set(sign[a:b].tolist()) for a, b in zip(at, at[1:])]
            for i in range(len(sets)):
                for j in range(i):
                    if sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                        assert len(signs[i] & signs[j]) >= 2


def united_by(pairs, n):
    top = list(range(n))
    for i, j in pairs:
        a, b = top[i], top[j]
        top = [min(a, b) if x in (a, b) else x for x in top]
    return top


def test_a_sign_takes_few_bytes_however_many_partitions_there_are():
    rng = np.random.default_rng(5)
    rows = [rng.integers(0, 1 << 63, 50).astype(np.uint64) for _ in range(400)]
    sets = pd.DataFrame({"ref": np.arange(400) + (3 << 40), "signs": [signs.short(r).tobytes() for r in rows]})
    for buckets in (4, 600):
        dealt = pd.concat(signs._deal(None, buckets)([sets]))
        assert dealt["signs"].map(len).sum() == 8 * 400 * 50 and dealt["bucket"].is_unique
        packed = np.concatenate([np.frombuffer(b, np.uint64) for b in dealt["signs"]])
        assert set(zip((packed >> np.uint64(16)).tolist(), (packed & np.uint64(65535)).tolist())) == {(int(x) % (1 << 48), i) for i, r in enumerate(rows) for x in r}


def test_signs_meet_in_pairs_in_groups_and_in_crowds(monkeypatch):
    monkeypatch.setattr(signs, "CROWD", 20)
    sizes = {7: 1, 8: 2, 9: 8, 10: 9, 11: 20, 12: 21}
    packed = np.array([(sign << 16) + k for sign, n in sizes.items() for k in range(n)], np.uint64)
    got = signs._meet(pd.DataFrame({"bucket": [0, 0], "base": [100, 100], "signs": [packed[::2].tobytes(), packed[1::2].tobytes()]}))
    kinds = {(k, s): len(g) for (k, s), g in got.groupby(["kind", "sign"])}
    assert kinds == {(0, 8): 1, (0, 9): 28, (1, 10): 9, (1, 11): 20, (2, 12): 20}


def test_documents_that_share_a_passage_make_no_candidates(spark):
    rng = np.random.default_rng(6)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 60)) + " " + passage for _ in range(300)]
    texts += [texts[0] + " more", texts[1] + " more"]
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    sets = rows.selectExpr("key", "cast(key as string) doc_id", "text").coalesce(1).mapInPandas(ngrams._describe(4, 85), ngrams._SET).cache()
    classes = sets.select("ref")
    edges = {tuple(sorted(e)) for e in signs.candidate_edges(sets, classes, 85).collect()}
    keys = {r["ref"]: r["key"] for r in sets.collect()}
    assert {(keys[a], keys[b]) for a, b in edges} == {(0, 300), (1, 301)}


def test_sketches_lose_no_link_in_crowded_groups():
    rng = np.random.default_rng(7)
    sets = []
    for n in (5, 60, 130, 300, 9000):
        for _ in range(4):
            base = set(rng.integers(0, 1 << 62, n).tolist())
            for _ in range(8):
                sets.append({x for x in base if rng.random() > 0.06} | set(rng.integers(0, 1 << 62, n // 20).tolist()))
    sets = [s for s in sets if s]
    flat = np.array([x for s in sets for x in sorted(s)], np.uint64)
    held = signs.sketches(flat, np.cumsum([0, *map(len, sets)]))
    pdf = pd.DataFrame({"group": 1, "ref": np.arange(len(sets)), "n": [len(s) for s in sets], "sketch": held, "task": 0})
    got = united_by(signs._test(85)(pdf).itertuples(index=False), len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                assert got[i] == got[j]
    assert len(set(got)) > 4


def test_trie_and_forest_agree_with_brute_force():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(80):
        base = rng.choice(200, 30, replace=False) if not sets or rng.random() < 0.3 else sets[rng.integers(len(sets))]
        sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.05], rng.choice(200, 2)])).astype(np.uint64))
    cells = np.full(len(sets), -1)

    def united(pairs):
        top = list(range(len(sets)))
        for i, j in pairs:
            a, b = top[i], top[j]
            top = [min(a, b) if x in (a, b) else x for x in top]
        return top

    want = united((i, j) for i in range(len(sets)) for j in range(i) if 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j])))
    assert united(trie.links(sets, cells, 80)) == want
    assert united(lines.forest(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), cells, 80)) == want


def test_license_places(docs):
    got = {(r["doc_id"], r["n_words"]): r for r in licenses.scan(docs).collect()}
    assert [x["start"] for x in got[9, 5]["places"]] == [3] and got[9, 5]["labels"] == ["mit"]
    assert [x["start"] for x in got[10, 4]["places"]] == [0, 2]
    assert got[4, 0]["places"] == [] and got[4, 0]["score"] == 0


def test_license_weights_count_all_texts(spark):
    texts = ["the mit license"] + ["komm mit der person"] * 20 + ["nothing here"] * 20
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licenses.scan(rows).where("doc_id = 0").collect()[0]
    # by hand: the texts without a key phrase hold mit too
    released, mit, license = (np.log(1 + 41 / (n + 1)) for n in (0, 21, 1))
    assert got["score"] == pytest.approx((mit + license) / (released + mit + license))


def test_rare_template_words_elsewhere_cost_no_license(spark):
    texts = ["available under CC0 1.0 and much later a dedication", "redistribution and use in source only; permitted", "cc0 and source", "cc0 and use in redistribution"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(rows).collect()}
    assert got == {0: ["cc0"], 1: ["bsd"], 2: [], 3: []}


def test_fingerprints(docs):
    rows = fingerprints.with_next(docs).collect()
    assert len(rows) == len(ROWS)
    order = sorted(((-1 if i is None else i), t or "") for i, t, *_ in ROWS)[::-1]
    follows = Counter((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    assert Counter((r["text"], r["next_text"]) for r in rows) == follows
    signs = {}
    for r in rows:
        assert signs.setdefault(r["text"], r["sigs"]) == r["sigs"] and r["sigs"] == sorted(set(r["sigs"]))
    sets = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), fingerprints.signatures(F.col("text")).alias("sigs"))
    assert {(r["a"], r["b"]) for r in fingerprints.similar_pairs(sets, 0.8).collect()} >= {(0, 1), (0, 2)}


def test_repeated_windows_are_removed_exactly(docs):
    words = [split(t) for _, t, *_ in ROWS]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = Counter()
    for (i, *_), w in zip(ROWS, words):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        want[i, len(w), " ".join(x for x, g in zip(w, gone) if not g)] += 1
    assert Counter((r["doc_id"], r["n_words"], r["kept_text"]) for r in substrings.remove_repeats(docs).collect()) == want


def test_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 8))
    x[100:160] = x[0] + rng.standard_normal((60, 8)) * 0.05
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    odd = [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [1.0, None] * 4), (304, []), (305, rows[5][1])]
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    degree = (unit @ unit.T >= 0.95).sum(1) - 1
    degree[5] += 1
    found = np.array([got[i]["n_links"] for i in range(200)])
    assert found.sum() >= 0.99 * degree.sum() and (found <= degree).all()
    assert got[305]["component_id"] == 5 and not got[305]["kept"]
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (300, 301, 302, 303, 304))


def test_a_large_cluster_hides_no_missed_links():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 8))
    x[:1000] = x[0] + rng.standard_normal((1000, 8)) * 1e-4
    x /= np.linalg.norm(x, axis=1, keepdims=True)

    class Graph:  # finds all of the cluster, of others nothing until the beam is wide
        def search(self, queries, beam):
            sims = queries @ x.T
            sims[:, 1000 if beam < 400 else 3000 :] = -2
            order = np.argsort(-sims, axis=1)[:, :beam]
            sims = np.take_along_axis(sims, order, 1)
            return np.where(sims > -2, order, -1), sims

    assert embeddings.audited_beam(Graph(), x, x, 0.95) >= 400


def test_lines(docs):
    rows = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()}
    assert rows[0] == BASE and 1 not in rows and rows[14].count("same line here") == 1
    assert rows[4] is None and rows[5] == "" and rows[6] == " \n\t"


def met(spark, rows):
    shared = Counter(k for r in rows for k in r[4])
    shared = spark.createDataFrame([(k, n) for k, n in shared.items() if n > 1], "band long, times long")
    return lines.meetings(spark.createDataFrame(rows, "line long, runs int, k0 long, k1 long, keys array<long>"), shared)


def test_a_stranger_first_in_a_band_hides_no_pair(spark):
    rows = [(0, 9, 0, 0, [7]), (1, 9, -1, -1, [7]), (2, 9, -1, -1, [7]), (2, 9, -1, -1, [8]), (5, 9, 0, 0, [8])]
    assert set(map(tuple, lines.candidate_edges(met(spark, rows), 80).collect())) == {(1, 2)}


def test_keys_that_lines_share_and_lines_that_come_again_are_counted(spark):
    one, near, lone, twice = "a line of some length, number one", "a line of some length, number ones", "quite another thing in these words", "this comes twice, but nothing is like it"
    texts = [f"{one}\nshort", f"{near}\n{twice}", lone, f"{twice}", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string").repartition(3)
    shared, bits = lines.shared_keys(docs)
    keys, at, _, _ = lines.meeting_keys([one, near, lone, twice])
    own = [set(lines._short(keys[a:b], bits).view(np.int64).tolist()) for a, b in zip(at, at[1:])]
    again = set(lines._short(lines._line_keys(lines._line_hashes([twice])[:, 0].copy()), bits).view(np.int64).tolist())
    assert own[0] & own[1] and {(r["band"], r["times"]) for r in shared.collect()} == {(k, 2) for k in (own[0] & own[1]) | again}


def test_sketches_tell_no_pair_apart_that_links():
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefgh "))
    pairs = []
    for n in (6, 12, 30, 60, 90, 120, 200, 400, 900):
        for _ in range(200):
            a = list(rng.choice(letters, n))
            b = list(a)
            for i in rng.integers(0, n, max(1, n // 60)):
                b[i] = "x"
            pairs.append(("".join(a), "".join(b)))
    sets = [[{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in p] for p in pairs]
    linked = np.array([len(x & y) >= 0.8 * len(x | y) for x, y in sets])
    _, _, sketch, runs = lines.meeting_keys([x for p in pairs for x in p])
    assert linked.sum() > 300 and lines.may_link(sketch[::2], sketch[1::2], runs[::2], runs[1::2], 80)[linked].all()


def test_a_key_of_very_many_lines_is_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(lines, "MEET", 10)
    rows = [(i, 9, i % 2 - 1, 0, [7]) for i in range(100)]
    found = {r["node"]: r["component"] for r in components(lines.candidate_edges(met(spark, rows), 80)).collect()}
    assert found == {i: i % 2 for i in range(100)}


def test_short_lines_that_meet_are_compared(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(300)]
    texts += [x + "q" for x in texts]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    keys, at, _, _ = lines.meeting_keys(texts)
    assert all(set(keys[at[i] : at[i + 1]].tolist()) & set(keys[at[i + 300] : at[i + 301]].tolist()) for i in range(300))
    assert {r["id"] for r in lines.removed_lines(docs).collect()} == {str(i + 300) for i in range(300)}


def test_packing_keeps_conflicts_apart(docs):
    rows = [r for r in packing.pack(docs, capacity=200).collect() if r["bin"]]
    bins = {}
    for r in rows:
        bins.setdefault(r["bin"], []).append(r)
    for own in bins.values():
        spans = sorted((r["start"], r["start"] + r["words"]) for r in own)
        assert spans[0][0] == 0 and spans[-1][1] <= 200 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert sum(r["doc_id"] in (0, 1) for r in own) <= 1
    assert sum(r["words"] for r in rows) == sum(len(split(t)) for _, t, *_ in ROWS)


def test_a_source_is_in_a_bin_once_per_lane_at_most():
    sizes = np.sort(np.random.default_rng(8).integers(5, 16, 300))[::-1].copy()
    source = np.arange(300) % 3
    lane = packing.lanes(sizes, source, 200)
    bins, _ = packing.best_fit(sizes, lane, np.full(300, -1), 200)
    assert max(Counter(zip(bins.tolist(), lane.tolist())).values()) == 1
    at_best = -(-int(sizes.sum()) // 200)
    for k in range(3):
        most = -(-100 // at_best)
        assert len(set(lane[source == k].tolist())) == most
        assert max(Counter(bins[source == k].tolist()).values()) <= most


def test_classifiers_learn(spark):
    texts = [(i, prose(i, 30) + (" horribleword" if i % 4 == 0 else ""), i % 4 == 0) for i in range(400)]
    rows = spark.createDataFrame([(i, t if i % 3 else (t.split()[0] + " ") * 30) for i, t, _ in texts], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 3 != 0), int(bad and i % 3 != 0)) for i, _, bad in texts], "doc_id long, quality int, toxic int")
    want = {r["doc_id"]: r for r in known.collect()}
    for got, label in ((toxicity.toxicity(rows, known), "toxic"), (quality.quality(rows, known), "quality")):
        held = [r for r in got.collect() if r["held_out"]]
        assert np.mean([r["predicted"] == want[r["doc_id"]][label] for r in held]) > 0.95


def test_odd_inputs(docs, empty, labels):
    for frame, n in ((docs, len(ROWS)), (empty, 0)):
        assert toxicity.toxicity(frame, labels).count() == n
        assert quality.quality(frame, labels).count() == n
        assert toxicity.toxicity(frame, labels.limit(0)).count() == n
    for operator in (mixing.mix, licenses.scan, substrings.remove_repeats, packing.pack, ngrams.link_components, fingerprints.with_next, lines.dedup_lines, ngrams.first_of_each, mixing.mixed_documents):
        assert operator(empty).count() == 0, operator
    assert embeddings.near_vectors(empty.selectExpr("doc_id as vec_id", "array(1.0f) as embedding")).count() == 0


CLASHING = ("_key", "key", "row", "_row", "id", "copy", "numbers", "lines", "_use", "use", "uses", "doc", "k", "i", "left", "n_lines", "place", "length", "y", "score", "size")
KEEPERS = (lambda d, _: lines.dedup_lines(d), lambda d, _: ngrams.first_of_each(d), lambda d, _: mixing.mixed_documents(d), lambda d, known: quality.keep_good(d, known))


@pytest.mark.parametrize("keeper", KEEPERS)
def test_columns_of_any_name_pass_unread(docs, labels, keeper):
    odd = docs.select("*", *[F.concat(F.lit(c), F.lit(":"), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in CLASHING])
    got = keeper(odd, labels)
    assert got.columns == odd.columns
    rows = got.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c}:{-1 if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)


def test_ids_keep_their_type(docs, labels):
    named = docs.withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id")))
    known = labels.withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id")))
    for got in (ngrams.link_components(named), substrings.remove_repeats(named), toxicity.toxicity(named, known), quality.quality(named, known), packing.pack(named), licenses.scan(named), mixing.mix(named)):
        ids = {r["doc_id"] for r in got.collect()}
        assert ids == {f"doc-{i}" if i is not None else None for i, *_ in ROWS}
    assert {r["doc_id"] for r in lines.dedup_lines(named).collect()} <= ids
    assert {r["doc_id"] for r in ngrams.first_of_each(named).collect()} <= ids


@pytest.mark.parametrize("keeper", KEEPERS[:2])
def test_of_rows_that_tie_the_same_one_stays(spark, keeper):
    rows = [(1, prose(5, 40), f"v{k}") for k in range(6)]
    stays = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        stays.add(tuple(r["v"] for r in keeper(spark.createDataFrame(order, "doc_id long, text string, v string").repartition(3), None).collect()))
    assert len(stays) == 1 and len(stays.pop()) == 1


def test_packing_does_not_depend_on_file_splits(spark):
    rows = [(i % 60, prose(i % 60, 5 + i % 37), "s%d" % (i % 4)) for i in range(200)]
    found = set()
    for parts in (1, 5):
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        found.add(frozenset(Counter((r["doc_id"], r["source"], r["piece"], r["words"], r["bin"], r["start"]) for r in packing.pack(frame, capacity=100, block=50).collect()).items()))
    assert len(found) == 1


def test_licence_templates_of_ones_own_are_found(spark):
    texts = ["granted under the frobnicator covenant of 1999 to all", "the frobnicator is covenant free", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(rows, (("frob", "frobnicator covenant", "granted under the frobnicator covenant"),)).collect()}
    assert got == {0: ["frob"], 1: [], 2: []}


def test_mixed_documents_are_in_the_order_of_positions(docs):
    placed = {r["doc_id"]: r["position"] for r in mixing.mix(docs.where("doc_id > 0")).collect()}
    parts = mixing.mixed_documents(docs.where("doc_id > 0")).withColumn("part", F.spark_partition_id()).select("part", "doc_id").collect()
    assert [r["part"] for r in parts] == sorted(r["part"] for r in parts)
    seen, at = set(), []
    for r in parts:  # the first use of each document
        if r["doc_id"] not in seen:
            seen.add(r["doc_id"])
            at.append(placed[r["doc_id"]] if ROWS[r["doc_id"]][1] and split(ROWS[r["doc_id"]][1]) else 0.0)
    assert at == sorted(at)


def test_the_sample_is_one_row_per_id_and_bounded(spark):
    from almanack.llm import training

    rows = [(i % 40, "long " * 20_000 if i % 40 == 3 else prose(i, 9)) for i in range(120)] + [(None, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    got = training.labelled_sample(frame, known, "quality", 3, 1, rows_per_class=10).collect()
    assert Counter(r["y"] for r in got) == {0: 10, 1: 10} and len({r["doc_id"] for r in got}) == 20
    every = training.labelled_sample(frame, known, "quality", 3, 1).collect()
    assert len(every) == len({r["doc_id"] for r in every}) and any(len(r["text"]) == 100_000 for r in every) == any(r["doc_id"] == 3 for r in every)


def test_a_query_built_before_the_pipeline_counts_after_it(spark, docs, empty, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    before = mixing.mix(docs)
    for frame in (docs, empty):
        frame.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert {"doc_id", "bin"} <= set(out.columns)
        assert (out.count() > 0) == (frame is docs)
    assert before.count() == len(ROWS)


def test_stages(spark, docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, str(tmp_path))
        current.write.parquet(f"{tmp_path}/{name}")
        current = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert current.columns == docs.columns
    assert {"doc_id", "bin"} <= set(current.columns)
    assert hashlib.sha256(b"").hexdigest()  # digests are of UTF-8 bytes
