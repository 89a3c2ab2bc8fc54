"""Packing, centroid clusters and collocations against brute force, and on hard rows."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import docs, plain
from tidemark.llm import centroids as C
from tidemark.llm import collocations as W
from tidemark.llm import packing as P

TOKENS = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
HARD = [None, "", " ", "a", "x y", "word " * 5000, "tab\there\n\nnew", "don't we'll", "Größe ½ ²", "日本語 text", "<|endoftext|> in text", "a" * 3000, "\x1c \x85 \xa0", "a", "a"]


def ids_of(text):
    return TOKENS.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer():
    rng = random.Random(3)
    texts = [t for t in HARD if t] + ["".join(rng.choice("ab cDé'std're'll\t\n\r  12²½.,!?-_€“”…ñß<|>日\x1c") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    encode = P.encoder()
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text), text
    small = P.Encoder(public_tokenizers.path("byte_bpe_50k.json"), None, held=3)
    assert all(np.frombuffer(small(t), "<u4").tolist() == ids_of(t) for t in texts[:200])


def best_fit(sizes, capacity):
    free, n = [], 0
    for size in sorted(sizes, reverse=True):
        at = bisect.bisect_left(free, size)
        if at < len(free):
            left = free.pop(at)
        else:
            left, n = capacity, n + 1
        if left - size:
            bisect.insort(free, left - size)
    return n


def check_packed(rows, capacity):
    at = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def test_pack_hard_rows(spark):
    table = docs(spark, plain(HARD) + [(3, "a", "en", "a", 1)]).selectExpr("*", "1 AS piece", "'x' AS id", "2 AS seq", "3 AS size", "4 AS offset", "5 AS sequence_id", "6 AS _piece_no")
    rows = P.pack(table, capacity=64, ids=True).collect()
    check_packed(rows, 64)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[3]) == 2  # repeated rows are documents of their own
    for i, text in enumerate(HARD):
        whole = ids_of(text) + [2]
        parts = sorted(by[i], key=lambda r: r.piece)[: 1 if i == 3 else None]
        got = [t for r in parts for t in np.frombuffer(r.ids, "<u4").tolist()]
        assert got == whole and [r.piece for r in parts] == list(range(len(parts)))
        assert all(r.length == 64 for r in parts[1:]) and [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert all(r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length for r in parts)


def test_pack_nothing(spark):
    assert P.pack(docs(spark, [])).collect() == []
    assert len(P.pack(docs(spark, [(None, None, None, None, None)])).collect()) == 1


@pytest.mark.parametrize("kind", ["mixed", "hot", "tiny", "halves"])
def test_assign_is_as_good_as_best_fit(spark, kind):
    rng = random.Random(5)
    draw = {
        "mixed": lambda: rng.randint(1, 1024),
        "hot": lambda: 300 if rng.random() < 0.4 else rng.randint(1, 700),
        "tiny": lambda: rng.randint(1, 12),
        "halves": lambda: rng.choice([511, 512, 513, 256, 257]),
    }[kind]
    sizes = [draw() for _ in range(3000)]
    rows = P.assign(spark.createDataFrame(list(enumerate(sizes)), "id long, size int").repartition(5)).collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.seq, r.offset)):
        assert r.offset == fill[r.seq]
        fill[r.seq] += sizes[r.id]
    assert max(fill.values()) <= 1024
    assert len(fill) <= best_fit(sizes, 1024) * 1.02 + 8  # one sequence per partition may stay open


def test_meetings_take_the_nearest_gap():
    # Partition 0 leaves 2 gaps, 1 leaves 1 and wants 1, 2 wants 3.
    assert P._meetings([(1, 1, 1), (0, 0, 2), (2, 3, 0)]) == [(1, 0, 1, 0, 0), (2, 0, 1, 1, 0), (2, 1, 2, 0, 0)]


def plain_means(vectors, clusters, rounds):
    """Lloyd's rounds on whole numbers, all distances computed."""
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in vectors if v is not None and len(v) == 64 and all(c is not None and np.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, vs in groups.items():
            centres[k] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted((i, near(v)[1], near(v)[0]) for i, v in kept), centres


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(6, 64))
    vectors = [(i, [float(np.float32(c)) for c in middles[i % 6] + rng.normal(size=64) * 0.1]) for i in range(150)]
    vectors += [(200 + i, vectors[7][1]) for i in range(30)]  # copies
    vectors += [(7, vectors[8][1]), (300, None), (301, [1.0] * 63), (302, [float("nan")] + [0.0] * 63), (303, [None] + [0.0] * 63), (304, [float("inf")] * 64), (305, []), (306, [0.0] * 64), (307, [-0.001] * 64)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "2 AS far", "3 AS cluster", "4 AS distance")
    for clusters in (10, 40):
        got, centres = C.cluster(table, clusters=clusters)
        want, plain_centres = plain_means(vectors, clusters, 5)
        assert sorted(map(tuple, got.collect())) == want
        assert centres.tolist() == plain_centres


def test_clusters_of_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    got, centres = C.cluster(spark.createDataFrame([], schema))
    assert got.collect() == [] and len(centres) == 0
    got, centres = C.cluster(spark.createDataFrame([(1, [1.0] * 64), (None, [2.0] * 64), (3, [1e9] * 64)], schema))
    assert sorted(r.distance for r in got.collect()) == [0, 0] and len(centres) == 2


def test_pivots_rule_out_without_changing_the_answer():
    rng = np.random.default_rng(4)
    centres = rng.integers(-300, 300, (40, 64))
    x = centres[rng.integers(0, 40, 500)] + rng.integers(-5, 6, (500, 64))
    x[:5] = (centres[0] + centres[1]) // 2
    pivots = centres[:16]
    far = np.sqrt(C._squares(x, pivots).astype(float))
    number, best, asked = C.nearest(x, far, centres, pivots)
    every = C._squares(x, centres)
    assert (number == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert asked < every.size / 10


def plain_phrases(rows, least, top):
    """All n-grams counted in dictionaries."""
    counts, size = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            size[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((1000 * a * size[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, size[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("budget", [40, 1 << 19])
def test_collocations_equal_brute_force(spark, budget):
    rng = random.Random(6)
    vocabulary = ["The", "old", "ship", "sails", "é", "日本", "x\x00y", "of", "to", "Of"]
    rows = []
    for i in range(160):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "\xa0", " ?"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    rows += [("en", "the quick brown fox jumps over it " * 30)] * 3 + [("en", None), (None, ""), ("fr", " . ,"), ("fr", "aa aa aa aa aa aa aa aa aa"), ("fr", "b")]
    table = spark.createDataFrame([(i, t, lang, 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n int").selectExpr("*", "1 AS word", "2 AS hash", "3 AS f", "4 AS key")
    for least, top in ((4, 2000), (4, 7), (25, 2000)):
        got = W.collocations(table, least, top, budget).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        assert sorted(map(tuple, got.collect())) == plain_phrases(rows, least, top)


def test_collocations_of_nothing(spark):
    assert W.collocations(docs(spark, [])).collect() == []
    assert W.collocations(docs(spark, plain([None, "", "one two three"]))).collect() == []


def test_keys_and_groups():
    at = np.uint64(1)
    assert W.mixed(at, np.array([1, 2], np.uint64)).dtype == np.uint64
    groups = W._grouped(np.array([3, 3, 0, 9, 1, 1]), 6)
    assert groups.tolist() == [0, 0, 0, 1, 2, 2]


def test_very_long_text(spark):
    text = "alpha beta gamma " * 200_000
    got = W.collocations(docs(spark, [(1, text, "en", "a", None)])).collect()
    assert {(r.phrase, r.a) for r in got} >= {("alpha beta gamma alpha beta", 199_999)}
    assert len(P.pack(docs(spark, [(1, text, "en", "a", None)])).collect()) == -(-(len(ids_of(text)) + 1) // 1024)
