"""Operators over the whole corpus, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallgrain.llm import mixing, queries, simhash, suffix, topk


def plain_repeats(rows, width):
    seen, out = set(), {}
    for key, text in sorted((k, t or "") for k, t in rows):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - width + 1):
            if raw[p : p + width] in seen:
                gone[p : p + width] = True
            seen.add(raw[p : p + width])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[key] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("spread", [{}, {"block": 40, "many": 2, "group": 3}])
def test_repeats_against_brute_force(spark, spread):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (100, 101, 150, 300)]
    rows = []
    for i in range(150):
        text = ""
        for _ in range(rng.randrange(4)):
            one = rng.choice(base)
            at = rng.randrange(len(one))
            pieces = [one, one[at : at + 130], "ab" * rng.randrange(120), "é" * rng.randrange(80)]
            text += rng.choice([*pieces, "".join(rng.choice("xyzé") for _ in range(rng.randrange(150)))])
        rows.append((i, text))
    rows += [(500, None), (501, ""), (502, "\0" * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.digests(df, **spread).collect()}
    assert got == plain_repeats(rows, 100)


def test_repeats_of_odd_tables(spark):
    same = "x" + "abcdefghij" * 12
    rows = [(1, same, "a"), (1, same, "a"), (None, same, "b"), (2, same, "c"), (3, "é" * 90, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string")
    left = suffix.remove_repeats(df)
    assert left.columns == df.columns and left.count() == 5
    assert {r.other: len(r.text) for r in left.collect()}["c"] == 0
    assert suffix.remove_repeats(df.limit(0)).count() == 0


def test_repeats_of_different_texts_under_one_key(spark):
    rng = random.Random(11)

    def letters(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    shared, far = letters(130), letters(140)
    rows = [
        (1, letters(50) + shared + letters(300) + far, "a"),
        (1, letters(20), "b"),
        (1, shared + letters(7), "c"),
        (1, letters(150), "d"),
        (0, letters(30) + far, "e"),
        (2, shared + "xyz" + far + "x", "f"),
        (2, "y" * 40, "g"),
        (None, shared, "h"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(4)
    left = suffix.remove_repeats(df)
    assert left.columns == df.columns and left.count() == len(rows)
    full, got = {o: t for _, t, o in rows}, {r.other: r.text for r in left.collect()}
    assert got["f"] == "xyzx" and all(got[o] == full[o] for o in "bdeg")
    assert got["h"] == ""  # texts without a key come last
    cut = {o: full[o].replace(far, "") for o in "ac"}  # 0 has that passage earlier
    # of the two rows under key 1 that hold the other passage, one keeps it
    assert (got["a"], got["c"]) in {(cut["a"].replace(shared, ""), cut["c"]), (cut["a"], cut["c"].replace(shared, ""))}
    sizes = {(r.n_bytes, r.n_removed) for r in suffix.digests(df).collect()}
    assert sizes == {(len(full[o]), len(full[o]) - len(got[o])) for o in full}


def test_maximal_repeats_hold_all_occurrences():
    texts = [b"P" * 3 + b"abcdefgh" * 20 + b"Q", b"R" + b"abcdefgh" * 20, b"zz" + b"abcdefgh" * 20]
    array = suffix.SuffixArray(texts, np.array([1, 2, 3]), np.array([0, 0, 0]), 100)
    groups = {(n, frozenset(zip(array.doc[a : b + 1].tolist(), array.place[a : b + 1].tolist()))) for a, b, n in array.repeats()}
    assert (160, frozenset({(1, 3), (2, 1), (3, 2)})) in groups


def plain_print(text):
    h = simhash.shingle_hashes(text.encode())
    return sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h.tolist()) > len(h))


def plain_groups(prints):
    group = {k: k for k in prints}
    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                one, two = sorted((group[a], group[b]))
                group = {k: one if g == two else g for k, g in group.items()}
    return group


def test_fuzzy_keys_meet_within_four_bits():
    rng, errors = np.random.default_rng(1), simhash.error_table()
    one = rng.integers(0, 2**64, 400, dtype=np.uint64)
    two = one.copy()
    for i in range(len(two)):
        for b in rng.choice(64, 1 + i % 4, replace=False):
            two[i] ^= np.uint64(1) << np.uint64(b)

    def keys(fp):
        out = [set() for _ in fp]
        for place, key in simhash.fuzzy_keys(fp.view(np.int64), errors):
            for p, k in zip(place.tolist(), key.tolist()):
                out[p].add(k)
        return out

    assert all(a & b for a, b in zip(keys(one), keys(two)))


def test_near_groups_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            near = list(base)
            near[rng.randrange(len(near))] = "other"
            texts.append("\t".join(near).upper())
    rows = list(enumerate([*texts, "", None, "  \n", texts[0]], 10))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_groups(df).collect()}
    prints = {k: plain_print(t or "") for k, t in rows}
    assert {k: fp % 2**64 for k, (fp, _) in got.items()} == prints
    assert {k: c for k, (_, c) in got.items()} == plain_groups(prints)
    kept = simhash.keep_one(df.unionByName(df.limit(3)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in got.values()})
    assert simhash.near_groups(df.limit(0)).count() == 0


def test_keep_one_drops_copies_and_not_their_keys(spark):
    one = " ".join(f"a{i}" for i in range(80))
    two = " ".join(f"b{i}" for i in range(80))
    three = " ".join(f"c{i}" for i in range(80))
    rows = [
        (1, one, "kept"),
        (5, one.upper(), "copy of 1"),
        (5, two, "only the key is that of a copy"),
        (7, three, "kept"),
        (7, "other words under the same key", "kept"),
        (7, three, "kept"),
        (None, two, "copy of 5"),
        (None, "no key, no copy", "kept"),
        (None, "no key, no copy", "kept"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(4)
    left = simhash.keep_one(df)
    assert left.columns == df.columns
    want = [rows[0], rows[2], rows[3], rows[4], rows[7]]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_links_never_grow_with_the_square():
    fp = np.array([1 << i for i in range(40)] + [0], np.uint64)
    assert len(simhash._links_in_bucket(fp, 4)) == len(fp) - 1


@pytest.mark.parametrize("same", [False, True])
def test_top_k_against_brute_force(spark, same):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-6, 7, (150, 5)) / 256
    if same:
        vectors[:100] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(200, None), (250, [None] * 5), (300, [float("nan")] * 5), (350, [1.0, 2.0]), (None, [0.0] * 5), (400, [0.0] * 5)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5, batch=3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    numbers = {i: np.floor(256 * np.array(v)).astype(int) for i, v in [*rows, (400, [0.0] * 5)]}
    want = {}
    for q in (i for i in numbers if i % 50 == 0):
        best = sorted((-int(numbers[q] @ v), i) for i, v in numbers.items() if i != q)[:5]
        want[q] = [(n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert {q: sorted(v) for q, v in got.items()} == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_budget_goes_to_siblings_before_ancestors(spark):
    rows = [("a", "x", 100), ("a", "y", 1000), ("b", "z", 1000), ("c", "u", 0)]
    leaves = spark.createDataFrame(rows, "d string, s string, tokens long")
    got = mixing.leaf_budgets(leaves, ["d", "s"], [{"a": 0.5, "b": 0.5}, {"x": 3.0}], 1000.0, 1)
    assert {(r.d, r.s): r.budget for r in got.collect()} == {("a", "x"): 100, ("a", "y"): 400, ("b", "z"): 500, ("c", "u"): 0}
    more = mixing.leaf_budgets(leaves, ["d", "s"], [{}, {}], 5000.0, 2)
    assert sum(r.budget for r in more.collect()) == 4200


@pytest.mark.parametrize("slice_rows", [7, 1000])
def test_mix_takes_the_shortest_run_that_reaches_the_budget(spark, slice_rows):
    rows = [(i, "w " * (i % 9), None if i % 5 == 0 else f"s{i % 3}") for i in range(200)] + [(None, None, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    levels = {"source": (F.col("source"), {"s1": 4.0, "s2": 0.0})}
    mixed = mixing.mix(df, levels, budget_share=0.9, max_epochs=3, slice_rows=slice_rows)
    got = [(r.doc_id, r.epoch, r.source) for r in mixed.collect()]
    assert len(got) == len(set(got)) and "s2" not in {s for _, _, s in got}
    again = mixing.mix(df.repartition(9), levels, budget_share=0.9, max_epochs=3)
    assert sorted(got, key=str) == sorted(((r.doc_id, r.epoch, r.source) for r in again.collect()), key=str)
    words = sum((i or 0) % 9 for i, _, _ in got)
    total = sum(i % 9 for i in range(200))
    assert 0.9 * total <= words < 0.9 * total + 3 * 9
    assert mixing.mix(df.limit(0), levels).count() == 0


def test_pipeline_keeps_columns_and_agrees_with_its_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, folder), "stage")
        assert docs.columns == before.columns and 0 < docs.count() <= before.count()
    got = {tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "ids_sha256").collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert got == {tuple(r) for r in last.select("doc_id", "ids_sha256").collect()}
    texts = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in docs.collect()}
    assert texts == {r.doc_id: r.decoded_sha256 for r in last.collect()}


def test_every_query_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14))
