"""Collocations, packing and spelling variants, against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallgrain.llm import collocations, packing, queries, spelling


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_collocations(rows, least, share, top):
    f, n, out = defaultdict(Counter), Counter(), set()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, counts in f.items():
        chosen = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        inner = set()
        for p, a in chosen.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= share * counts[p[i : i + k]]:
                        inner.add(p[i : i + k])
        scored = []
        for p, a in chosen.items():
            if p not in inner:
                cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), " ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        for rank, row in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, *row[3:]))
    return out


@pytest.mark.parametrize("sizes", [{}, {"long": 2, "step_bytes": 500, "step_words": 40}])
def test_collocations_against_brute_force(spark, sizes):
    rng = random.Random(7)
    words = ["a", "B", "c", "été", " x", "the", "日本", "é", "hot", "😀"]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(rng.randrange(40)):
            text += rng.choice([*words, "the hot", "hot " + str(rng.randrange(90)), "a B c d"]) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\r\n", "\x0c"])
        rows.append((i, rng.choice(["en", "de", None, "und"]), text))
    rows += [(900, "en", None), (901, "en", ""), (902, "fr", " \t.,"), (903, "zz", "the hot a " * 3000), (904, "zz", "the hot a " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumns({"phrase": F.lit(1), "n": F.lit("x"), "part": F.lit(2)})
    got = collocations.collocations(df.repartition(5), least=4, top=25, **sizes)
    expected = plain_collocations([r[1:] for r in rows], 4, 80, 25)
    assert {tuple(r) for r in got.collect()} == expected and got.count() == len(expected)


def test_collocations_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0


def test_collocation_scores_beyond_64_bits(spark):
    n = 10**15
    text = F.expr(f"cast(2000000 as decimal(10,0)) * cast({n}L as decimal(19,0)) div cast({3 * n}L as decimal(19,0))")
    assert spark.range(1).select(text).first()[0] == 666666


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(queries.tokenizer_file())
    made.encode_special_tokens = True
    return made


def test_segments_give_the_same_ids(tokenizer):
    rng = random.Random(1)
    parts = ["a", "It's", "'s", " ", "  ", "\n", "\t", "\r\n", "\x1c", " ", " ", "\x85", "don't", "123", "½", "!?", "日本", "é", "é", "😀", "<|endoftext|>", "_", "ſ", "x" * 70]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["", " ", "y" * 5000, "ab " * 4000, " lead", "trail ", "<|endoftext|>"]
    coder = packing.Encoder(queries.tokenizer_file())
    for i in range(0, len(texts), 100):
        ids, sizes = coder.encode(texts[i : i + 100])
        for text, found in zip(texts[i : i + 100], np.split(ids, np.cumsum(sizes)[:-1])):
            assert found.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def check_pieces(rows, got, tokenizer, width):
    """Every id in exactly one piece, sequences without gaps; lengths of the sequences."""
    ids = Counter()
    for _, _, text in rows:
        ids[np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()] += 1
    sequences = defaultdict(list)
    by_sum = Counter()
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        by_sum[(r.doc_id, r.doc_tokens)] += r.length
    assert sum(r.length for r in got) == sum(len(i) // 4 * n for i, n in ids.items())
    assert all(total % size == 0 for (_, size), total in by_sum.items())
    assert sorted(sequences) == list(range(len(sequences)))
    lengths = []
    for n in range(len(sequences)):
        at = 0
        for offset, length in sorted(sequences[n]):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
    whole = [x for x in lengths if x == width]
    assert lengths[: len(whole)] == whole and all(x & (x - 1) == 0 for x in lengths)
    return lengths


@pytest.mark.parametrize("targets", [None, {"a": 3.0, "b": 1.0}, {"a": 1.0, "b": 1.0, "c": 1.0, "": 0.001}])
def test_pieces_hold_every_id_once(spark, tokenizer, targets):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta's", "\n", "12", "é"]
    rows = [(i, rng.choice("aaaabbc"), " ".join(rng.choice(words) for _ in range(rng.randrange(120)))) for i in range(150)]
    rows += [(500, None, "x y z"), (501, "a", None), (502, "", ""), (503, "c", "long " * 9000), (None, "b", "no key"), (7, "b", "again")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({"queue": F.lit(1), "name": F.lit("x"), "part": F.lit(9)})
    made = packing.pack(df.repartition(6), queries.tokenizer_file(), F.col("source"), targets, width=64, grain=16, with_ids=True)
    got = made.collect()
    lengths = check_pieces(rows, got, tokenizer, 64)
    for r in got:
        if r.doc_id is not None and r.doc_id != 7 and r.start == 0 and r.length == r.doc_tokens:
            text = {k: t for k, _, t in rows}[r.doc_id]
            assert r.ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    if targets is None or "c" not in targets:
        return
    # while no queue is empty, each named source has a third of the tokens, to within a packet or two
    source = {k: s for k, s, _ in rows}
    met = Counter()
    for r in got:
        if r.sequence_id < 30:
            met[source.get(r.doc_id)] += r.length
    assert len(lengths) > 60 and all(abs(met[s] - 30 * 64 / 3) <= 48 for s in "abc"), met


def test_many_sources_share_the_last_queue(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 4)
    rows = [(i, f"s{i % 11}", "word " * (i % 17)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = packing.pack(df, queries.tokenizer_file(), F.col("source"), width=64, grain=16, with_ids=True).collect()
    check_pieces(rows, got, tokenizer, 64)


def test_sequences_are_padded_only_off_powers_of_two(spark):
    rows = [(0, 2, 2, [3, 4]), (0, 0, 2, [1, 2]), (1, 0, 3, [5, 6, 7]), (2, 0, 1, [8])]
    pieces = spark.createDataFrame(rows, "sequence_id long, offset long, length long, ids array<int>")
    got = {r.sequence_id: (r.n_tokens, r.ids) for r in packing.sequences(pieces, 9, 8).collect()}
    assert got == {0: (4, [1, 2, 3, 4]), 1: (3, [5, 6, 7, 9, 9, 9, 9, 9]), 2: (1, [8])}


def test_packing_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert packing.pack(df, queries.tokenizer_file(), F.col("source")).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, queries.tokenizer_file(), F.col("source"), {"a": 0.0})


def test_schedule_keeps_its_shares_at_far_places():
    totals = np.array([6 * 10**12, 3 * 10**12, 10**12, 5], np.int64)
    plan = packing.Schedule(totals, totals.astype(float), 1024, 128)
    far = np.array([5 * 10**12 + 77, 2_500_000_000_003, 833_333_333_333])
    place = plan.place(np.arange(3), far)
    assert np.allclose(place / plan.length, far / totals[:3], atol=1e-6)
    queue, at = np.zeros(4000, np.int64), 5 * 10**12 + np.arange(4000)
    assert len(set(plan.place(queue, at).tolist())) == 4000


def plain_words(rows, least=7, min_count=2):
    total = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = low(w)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                total[w] += 1
    return {w: n for w, n in total.items() if n >= min_count}


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p:] == b[p + 1 :] if len(a) < len(b) else a[p + 1 :] == b[p + 1 :]


def plain_variants(words, factor):
    by = {w: [v for v in words if near(w, v)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in by.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= factor * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(by[w]), words.get(form.get(w)))
    return out


def test_variants_against_brute_force(spark):
    rng = random.Random(4)
    base = ["verhältnis", "Remember", "aaaaaaaa", "zwölfÄpfel", "accommodation", "÷×÷×÷×÷×"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rng.randrange(40)):
            w = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("aeé") + w[at:], w[:at] + rng.choice("xyÿ") + w[at + 1 :]])
            words.append(w)
        rows.append((i, rng.choice([" ", "-", "1", "\n"]).join(words)))
    rows += [(900, None), (901, ""), (None, "remember " * 30), (5, "remember " * 30), (902, "q" * 3000 + " " + "q" * 3000 + " " + "q" * 2999 + "r " * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit("x"), "a": F.lit(0)})
    got = {r.word: tuple(r)[1:] for r in spelling.variants(df.repartition(4), factor=4).collect()}
    assert got == plain_variants(plain_words(rows), 4)


@pytest.mark.parametrize("limit", [1, 8, 256])
def test_hot_groups_lose_no_pair(spark, limit, monkeypatch):
    rng = random.Random(6)
    words = {"prefix" + "".join(rng.choice("ab") for _ in range(rng.randrange(3, 9))) + "suffix" for _ in range(250)}
    words |= {"prefixx" + c + "suffix" for c in "abcdefghijklmnopqrstuvwxyzàáâ"}
    words = {w: rng.randrange(2, 99) for w in words}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    dealt = spelling.groups(df, limit)
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(dealt).collect()}
    expected = {}
    for w in words:
        if others := [v for v in words if near(w, v)]:
            best = min(others, key=lambda x: (-words[x], x))
            expected[w] = (len(others), words[best], best)
    assert got == expected


def test_variants_of_an_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "doc_id long, text string"), factor=1)
