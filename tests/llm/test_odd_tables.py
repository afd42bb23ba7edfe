"""Repeated and missing keys, hot keys, large numbers and clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrain.llm import chat, language, mixing, quality, queries, rules, simhash, suffix, topk
from tallgrain.llm.common import sampled, sampled_texts

from .test_corpus import plain_repeats


def plain_top(rows, k):
    """The k best pairs of each query id, over all its rows."""
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows]
    out = []
    for own in sorted({i for i, _ in whole if i % 50 == 0}):
        found = [(-sum(a * b for a, b in zip(q, v)), i) for o, q in whole if o == own for i, v in whole if i != own and len(v) == len(q)]
        out += [(own, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize("batch", [2, 100])
def test_every_row_is_a_candidate(spark, batch):
    rng = random.Random(1)
    rows = [(i % 40 * 5, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(160)]
    rows += [(7, rows[3][1])] * 4 + [(50, rows[0][1])] * 3 + [(100, [0.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    same = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    got = topk.top_k(df.repartition(5), F.col("vec_id") % 50 == 0, 5, batch=batch)
    assert sorted(map(tuple, got.collect())) == plain_top(same, 5)


def test_components_beyond_64_bits_are_an_error(spark):
    for big in (1e300, -1e300, 1e9):
        df = spark.createDataFrame([(0, [1.0, big]), (1, [big, big])], "vec_id long, embedding array<double>")
        with pytest.raises(ValueError, match="64 bits"):
            topk.top_k(df, F.col("vec_id") % 50 == 0)
    fine = spark.createDataFrame([(0, [1.0, 1e6]), (1, [1e6, 1e6])], "vec_id long, embedding array<double>")
    assert topk.top_k(fine, F.col("vec_id") % 50 == 0).collect()[0].score == 256 * 256 * (10**6 + 10**12)


def test_repeats_of_texts_without_a_key(spark):
    rng = random.Random(8)
    half = "".join(rng.choice("abcdefgh") for _ in range(253))
    other = "".join(rng.choice("abcdefgh") for _ in range(300))
    one = spark.createDataFrame([(None, half + half)], "doc_id long, text string")
    assert suffix.digests(one).first()[1:4] == (506, 253, 1)
    rows = [(3, other), (None, half + half), (None, "x" + other[50:]), (2, other[100:]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_bytes): r[2:] for r in suffix.digests(df).collect()}
    expected = plain_repeats([(2, other[100:]), (3, other), (8, half + half), (9, "x" + other[50:])], 100)
    for key, text in rows[:4]:
        plain = next(v for v in expected.values() if v[0] == len(text))
        assert got[(key, len(text))] == plain[1:]


def test_samples_are_bounded_by_rows(spark):
    docs = spark.range(2000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    marks = spark.createDataFrame([(1, 0), (1, 1), (1, 0)], "doc_id long, label int")
    some = sampled_texts(docs, marks, "doc_id", 10, 3)
    assert some.columns == ["doc_id", "label", "text"] and some.count() == 2
    many = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"))
    assert sampled(many, "doc_id", 100, 3).count() == 100
    hot = many.withColumn("doc_id", F.when(F.col("doc_id") < 4900, F.lit(0)).otherwise(F.col("doc_id")))
    assert sampled(hot, "doc_id", 100, 3).count() == 100
    assert sampled(hot, "doc_id", 1000, 3).count() == 102
    assert sampled(many.limit(0), "doc_id", 10, 3).count() == 0


def test_one_key_trains_a_language_model_once(spark):
    text = F.concat(F.lit("the words of "), F.col("id").cast("string"))
    df = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))
    more = spark.createDataFrame([(i, "les mots de la langue", "fr") for i in range(8, 30)], "doc_id long, text string, lang string")
    model = language.fit(df.unionByName(more).withColumn("_key", F.lit(1)), max_rows=10)
    assert set(model.langs) == {"en", "fr"}
    assert model.predict(more).where("lang_pred = 'fr'").count() == 22


def test_quality_learns_from_repeated_keys(spark):
    rows = [(i % 7, "good text here" if i % 2 else "bad bad bad") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    model = quality.fit_on_labels(docs, labels, max_rows=5)
    assert model.score(docs).count() == 400


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "src1")], "doc_id long, text string, lang string, source string")
    for name in ("_end", "_key", "_slice", "epoch", "_level_0"):
        with pytest.raises(ValueError, match=name):
            mixing.mix(docs.withColumn(name, F.lit(1)), queries.tree())
    for name in rules.COUNTS:
        with pytest.raises(ValueError, match=name):
            rules.counts(docs.withColumn(name, F.lit(1)))
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ho")], "conv_id long, turn int, role string, text string")
    odd = turns.withColumns({"tree": F.lit(9), "node": F.lit(1), "score": F.lit("x"), "parent": F.lit(0), "path": F.lit(0)})
    made = chat.conversations(chat.thread(odd))
    assert made.count() == 1 and made.first()["tree"] == 1


def test_blocks_of_open_bits():
    for mask in (0, 0b1011, (1 << 60) - 1):
        wider = simhash.open_blocks(mask)
        assert len(wider) == 5 and all(w & mask == mask for w in wider)
        added = [w & ~mask for w in wider]
        assert sum(added) == ~mask % 2**64 and sum(a.bit_count() for a in added) == 64 - mask.bit_count()


@pytest.mark.parametrize("limit", [4, 60, 1 << 14])
def test_crowded_keys_lose_no_link(spark, limit):
    rng = random.Random(3)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(120):
            near = centre
            for b in rng.sample(range(64), rng.randrange(5)):
                near ^= 1 << b
            prints.add(near)
    prints = sorted(prints)
    group = {p: p for p in prints}
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 4 and group[a] != group[b]:
                one, two = sorted((group[a], group[b]))
                group = {k: one if g == two else g for k, g in group.items()}
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long").repartition(3)
    found = {frozenset((r.a, r.b)) for r in simhash.links(nodes, 4, limit).collect()}
    assert all((np.uint64(a % 2**64) ^ np.uint64(b % 2**64)).item().bit_count() <= 4 for a, b in map(tuple, found))
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for pair in found:
        a, b = (x % 2**64 for x in pair)
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert {p: top(p) for p in prints} == group


def test_a_hot_key_is_spread(spark):
    """Many fingerprints that share the upper bits: no task keeps them all."""
    fp = F.lit(0x5A5A5A5A << 32).bitwiseOR(F.col("id") * 37)
    nodes = spark.range(20_000).select(fp.cast("long").alias("fp"))
    keyed = nodes.select(F.lit(1).cast("long").alias("key"), "fp", F.lit(0).cast("long").alias("mask"))
    first = simhash._links(keyed, 4, 1000)
    assert first.where("key is not null").count() == 20_000
    again = simhash._dealt_again(first.where("key is not null"))
    assert again.count() == 100_000 and again.select("key").distinct().count() > 1000
