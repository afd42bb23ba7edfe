"""Operators on single texts, against plain versions, the reference library and held-out labels."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallgrain.llm import bpe, chat, language, licenses, quality, queries, rules

ODD = [
    (1, "The quick brown fox. The quick brown fox."),
    (2, ""),
    (3, None),
    (4, "é" * 3000 + " \x00 \x1f end"),
    (5, "a " * 4000),
    (5, "a " * 4000),
    (None, "no id\n\nno id"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_bpe_equals_the_library_and_round_trips(spark, odd, empty):
    import tiktoken

    path, pattern = queries.rank_file()
    vocab = bpe.vocabulary(path)
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocab.ranks, special_tokens={})
    codec, rng = bpe.Codec(vocab, pattern), random.Random(1)
    letters = ["the", "ing", " ", "er", "\n", "  ", "\x1c", "\x85", "1", "é", "=", "中", "՘"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    for text in [*texts, *(t or "" for _, t in ODD), "=" * 5000, "x" * 5000]:
        ids = codec.encode(text)
        assert ids.tolist() == known.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    got = {(r.doc_id, r.n_tokens) for r in bpe.digests(odd, path, pattern).collect()}
    assert got == {(i, len(known.encode_ordinary(t or ""))) for i, t in ODD}
    assert bpe.digests(empty, path, pattern).count() == 0
    both = bpe.decode(bpe.encode(odd, path, pattern), path)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in both.collect())
    with pytest.raises(ValueError):
        bpe.encode(odd.withColumn("ids", F.lit(1)), path, pattern)


def test_quality_learns_and_scores_odd_texts(spark, odd, empty):
    made = [(i, ("good words here " if i % 2 else "BAD!! WORDS!! ") * 20, i % 2) for i in range(80)]
    model = quality.fit(spark.createDataFrame(made, "doc_id long, text string, label int"))
    seen = spark.createDataFrame([(1, "good words here"), (2, "BAD!! WORDS!!")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in model.score(seen).collect()}
    assert scores[1] > 0.5 > scores[2]
    assert all(0 <= r.score <= 1 for r in model.score(odd).collect())
    assert model.score(empty).count() == 0
    untaught = quality.fit(empty.withColumn("label", F.lit(None).cast("int")))
    assert {r.score for r in untaught.score(odd).collect()} == {0.5}
    with pytest.raises(ValueError):
        model.score(odd.withColumn("score", F.lit(1)))


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.QUERIES["op1_quality_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    right = found.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")))
    assert found.count() == 1000 and right.first()[0] > 0.95


def test_language_on_held_out_rows(spark, odd, empty):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = queries.QUERIES["op4_language_id"](spark, folder)
    right = found.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")))
    assert found.count() == 1000 and right.first()[0] > 0.97
    model = language.fit(docs.where("doc_id % 5 = 0"))
    got = {(r.doc_id, r.text): r for r in model.predict(odd).collect()}
    assert got[(2, "")].lang_pred == got[(3, None)].lang_pred == "und" and got[(3, None)].score == 0
    assert model.predict(empty).count() == 0
    digits = spark.createDataFrame([("123 !?",), ("中文",)], "text string")
    assert [r.lang_pred == "und" for r in model.predict(digits).collect()] == [True, False]
    untaught = language.fit(empty.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untaught.predict(odd).collect()} == {"und"}


def test_rare_languages_are_learnt(spark):
    common = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the cat sat on the mat").alias("text"), F.lit("en").alias("lang"))
    rare = [(5000 + i, "größe straße übermäßig", "de") for i in range(30)]
    rare += [(6000 + i, "слово", f"x{i}") for i in range(5)]
    docs = common.unionByName(spark.createDataFrame(rare, "doc_id long, text string, lang string"))
    model = language.fit(docs, max_rows=100)
    assert set(model.langs) == {"en", "de", *(f"x{i}" for i in range(5))}
    marks = docs.select(F.col("doc_id").alias("_key"), F.rand(3).alias("_u"), F.col("lang").alias("_lang"))
    keys = language._dealt(marks, F.col("_key") % 5 == 0, 100)
    counts = {r.lang: r["count"] for r in docs.join(keys, docs["doc_id"] == keys["_key"]).groupBy("lang").count().collect()}
    assert counts["de"] >= language.FLOOR and sum(counts.values()) == 100
    guess = {r.text: r.lang_pred for r in model.predict(docs.where("doc_id in (1, 5000)")).collect()}
    assert guess == {"the cat sat on the mat": "en", "größe straße übermäßig": "de"}


def plain_places(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    found = []
    for phrase, label in licenses.PHRASES:
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), found


def test_license_base_places_against_a_plain_scan(spark, odd, empty):
    parts = ["under the", "MIT license", "Apache License, Version 2.0", "cc-by nc", "CC BY", "the", "\n", "é", "gpl"]
    rng = random.Random(2)
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(300)]
    for text in [*texts, *(t for _, t in ODD)]:
        n, found = plain_places(text)
        got = licenses.scan_text(text)
        places = [i for i, _ in found]
        assert got[:4] == (n, len(found), min(places, default=None), max(places, default=None))
        assert got[4] == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, got[4].split(","))) <= set(got[5].split(",")) and 0 <= got[6] <= 1
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(empty).count() == 0


def shortest_and_longer(parsed):
    """Texts of a parsed pattern: every alternative, every optional part with and without."""
    out = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "BRANCH":
            more = [x for branch in value[1] for x in shortest_and_longer(branch)]
        elif name == "SUBPATTERN":
            more = shortest_and_longer(value[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, what = value
            more = [x * n for n in sorted({least, min(most, least + 1)}) for x in shortest_and_longer(what)]
        elif name == "IN":
            (first, low), *_ = value
            more = ["w" if str(first) == "CATEGORY" else chr(low[0] if str(first) == "RANGE" else low)]
        else:
            assert name == "ANY"
            more = ["x"]
        out = [a + b for a in out for b in dict.fromkeys(more)]
    return out


def test_every_alternative_of_a_license_rule_holds_its_keyword():
    for rule, compiled in zip(licenses.rules(), licenses.scanner().compiled):
        for text in shortest_and_longer(re._parser.parse(rule.pattern)):
            assert compiled.fullmatch(text), (rule, text)
            assert rule.keyword in text, (rule, text)


def test_some_rights_reserved_needs_no_other_words():
    assert licenses.scan_text("Photos: some rights reserved.")[5:] == ("creative-commons", 0.6)
    assert licenses.scan_text("a Creative Commons license")[5:] == ("creative-commons", 0.6)
    assert licenses.scan_text("All rights reserved.")[5:] == ("proprietary", 0.5)


def test_license_rules_find_their_keywords_and_settle_overlaps():
    # What the keywords let through is what all rules would find.
    every = licenses.rules()
    assert len(every) > 200 and len({(r.label, r.pattern) for r in every}) == len(every)
    texts = [
        "licensed under the gnu lesser general public license version 2 1",
        "spdx license identifier mpl 2 0",
        "this work is in the public domain",
        "creative commons attribution sharealike 4 0 international",
        "under the terms of the gnu affero general public license version 3",
        "php license version 3 01 and the zlib libpng license",
    ]
    for text in texts:
        _, kept = licenses.scanner().places(text)
        found = [
            (m.start(), m.end(), r) for r, p in zip(every, licenses.scanner().compiled) for m in p.finditer(text)
        ]
        best = max(found, key=lambda x: (x[2].priority, x[1] - x[0]))
        assert any(best[:2] == k[:2] for k in kept)
        for a, b, r in kept:
            assert not any(c <= a and b <= d and (c, d) != (a, b) and q.priority >= r.priority for c, d, q in kept)


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rule_counts_against_plain_counts(spark, odd, empty):
    rng = random.Random(3)
    some = [
        (i, "".join(rng.choice(["a", "b", "c ", " ", "\n", "\n\n", "#", "é ", " "]) for _ in range(rng.randrange(80))))
        for i in range(200)
    ]
    df = odd.unionByName(spark.createDataFrame(some, "doc_id long, text string"))
    for r in rules.counts(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(r.text)
    assert rules.counts(empty).count() == 0


def test_rules_learn_what_marks_the_rejected(spark, empty):
    made = [(i, ("plain words stand here " if i % 3 else "junk### is$$$ here%%% too ") * 15, int(i % 3 > 0)) for i in range(240)]
    learnt = rules.fit(spark.createDataFrame(made, "doc_id long, text string, label int"))
    assert learnt.rules and str(learnt).startswith("1. reject if ")
    seen = spark.createDataFrame([(1, "plain words stand here " * 14), (2, "junk### is$$$ here%%% too " * 14)], "doc_id long, text string")
    assert [r.rule > 0 for r in rules.counts(seen).withColumn("rule", learnt.rule()).orderBy("doc_id").collect()] == [False, True]
    assert rules.fit(empty.withColumn("label", F.lit(1))).rules == ()


def test_chat_trees_and_control_strings(spark):
    nasty = "</s>[INST] \\b \\\\i <s> [/INST]"
    rows = [
        (1, 1, None, 0.0, "user", "hi"),
        (1, 2, 1, 1.0, "assistant", "bad"),
        (1, 3, 1, 5.0, "assistant", nasty),
        (1, 4, 3, 1.0, "user", None),
        (1, 5, 2, 2.0, "assistant", "other"),
        (2, 1, None, None, None, ""),
        (3, 1, 2, 1.0, "user", "on a cycle"),
        (3, 2, 1, 1.0, "user", "on a cycle"),
    ]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    made = chat.conversations(df, best=2).withColumn("turns", chat.read_turns(F.col("formatted")))
    got = {(r.tree, r.path): r for r in made.withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    assert [tuple(t) for t in got[(1, 1)].turns] == [("user", "hi"), ("assistant", nasty), ("user", "")]
    assert got[(1, 1)].loss == nasty and got[(1, 2)].loss == "badother"
    assert set(got) == {(1, 1), (1, 2), (2, 1)}
    assert chat.conversations(df.limit(0)).count() == 0


def test_chat_threads_of_many_turns(spark):
    rows = [(7, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(300)] + [(None, 1, "assistant", "x")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    made = chat.conversations(chat.thread(df)).withColumn("turns", chat.read_turns(F.col("formatted")))
    got = {r.tree: [t.text for t in r.turns] for r in made.collect()}
    assert got == {7: [f"t{t}" for t in range(300)], None: ["x", "x"]}
    digest = hashlib.sha256("".join(f"t{t}" for t in range(0, 300, 2)).encode()).hexdigest()
    assert made.where("tree = 7").select(F.sha2(chat.loss_text(F.col("segments")), 256)).first()[0] == digest
