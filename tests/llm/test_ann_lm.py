import math
import random

import numpy as np
import pytest

from tests.llm.helpers import docs, plain, rows
from tidemark.llm import ann, lm_scoring

VECTORS = "vec_id long, embedding array<float>, score string, rank string"


def brute_nearest(data, queries, k):
    good = {}
    for i, v in data:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in queries:
        for x in good.get(q, []):
            near = sorted({(float(np.sqrt(((x - v) ** 2).sum())), i) for i, vs in good.items() if i != q for v in vs if len(v) == len(x)})
            out[q] = near[:k]
    return out


def test_exact_on_small_shards(spark):
    rng = np.random.default_rng(0)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    same = data[7][1]
    data += [(1000 + i, same) for i in range(200)] + [(None, same), (2000, None), (2100, []), (2200, [0.0] * 8), (2300, [float("nan")] * 8), (2400, [float("inf")] + [1.0] * 7), (2500, [None] + [1.0] * 7), (2600, [1.0, 2.0]), (2700, [1.5, 2.0]), data[5], data[5]]
    table = spark.createDataFrame([(*d, "x", "y") for d in data], VECTORS)
    got = {}
    for r in ann.nearest(table, table.filter("vec_id % 100 = 0"), shard_rows=100).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = brute_nearest(data, [i for i, _ in data if i is not None and i % 100 == 0], 10)
    assert set(got) == {q for q, n in want.items() if n}
    for q, near in got.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, len(near) + 1))
        assert [i for _, _, i in near] == [i for _, i in want[q]]
        assert [s for _, s, _ in near] == pytest.approx([s for s, _ in want[q]], abs=1e-12)


def test_empty_and_single(spark):
    none = spark.createDataFrame([], VECTORS)
    assert ann.nearest(none, none).count() == 0
    one = spark.createDataFrame([(0, [1.0, 0.0], "", "")], VECTORS)
    assert ann.nearest(one, one).count() == 0


@pytest.mark.parametrize("kind", ["uniform", "clusters"])
def test_recall_of_a_graph(kind):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(2500, 32)) if kind == "uniform" else np.repeat(rng.normal(size=(25, 32)), 100, axis=0) + 0.01 * rng.normal(size=(2500, 32))
    v = rng.permutation(base).astype(np.float32)
    levels = ann.build(v)
    assert [len(x) for x in levels] == [2500, 157, 10][: len(levels)] and levels[0].shape[1] == 2 * ann.LINKS
    q = v[:100]
    found = ann.search(q, v, levels, ann.BEAM)[:, :10]
    exact = np.argsort(((q[:, None] - v[None]) ** 2).sum(2), axis=1, kind="stable")[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, exact)]) > 0.9


def test_losses_against_brute_force(spark):
    rng = random.Random(4)
    common, rare = "a b c d e f".split(), [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.8 else rng.choice(rare) for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    good = [" ".join(rng.choices("a b c".split(), k=20)) for _ in range(20)]
    share, pair = 0.01, 0.005
    models = lm_scoring.fit(docs(spark, plain(texts + good)), docs(spark, plain(good)), share, pair)

    def count(ts):
        words, pairs = {}, {}
        for t in ts:
            for w in t.split():
                words[w] = words.get(w, 0) + 1
        return words, pairs

    background, target = count(texts + good)[0], count(good)[0]
    total = sum(background.values())
    vocabulary = {w for w, n in background.items() if n >= share * total}
    fold = lambda w: w if w in vocabulary else None
    size = len(vocabulary) + 1
    sides = []
    for ts in (texts + good, good):
        uni, bi = {}, {}
        for t in ts:
            before = "<s>"
            for w in map(fold, t.split()):
                uni[w] = uni.get(w, 0) + 1
                bi[before, w] = bi.get((before, w), 0) + 1
                before = w
        sides.append((uni, bi))
    kept = {p for p, n in sides[0][1].items() if n >= max(1, pair * total)}

    def loss(text, side):
        uni, bi = sides[side]
        n, before, out = sum(uni.values()), "<s>", []
        for w in map(fold, text.split()):
            base = (uni.get(w, 0) + 0.5) / (n + 0.5 * size)
            history = sum(c for p, c in bi.items() if p[0] == before and p in kept)
            seen = bi.get((before, w), 0) if (before, w) in kept else 0
            out.append(-math.log((seen + lm_scoring.BACKOFF * base) / (history + lm_scoring.BACKOFF)))
            before = w
        return sum(out) / len(out)

    asked = [*texts[:20], "a b c", "zzz", "a " * 20000]
    for r in lm_scoring.score(docs(spark, plain(asked)), models).collect():
        assert r.n_tokens == len(r.text.split())
        assert r.loss_background == pytest.approx(loss(r.text, 0)) and r.loss_target == pytest.approx(loss(r.text, 1))
        assert r.score == pytest.approx(r.loss_background - r.loss_target)


def test_lm_edges(spark):
    none = docs(spark, [])
    models = lm_scoring.fit(none, none)
    table = docs(spark, plain([None, "", " \n", "a b", "a b"])).withColumnRenamed("source", "score")
    got = rows(lm_scoring.score(table, models), "doc_id", "n_tokens", "score")
    assert got == [(0, 0, None), (1, 0, None), (2, 0, None), (3, 2, 0.0), (4, 2, 0.0)]
    assert lm_scoring.score(none, models).count() == 0


def test_lm_tells_good_texts(spark):
    """Held-out labelled documents: the good ones score higher."""
    from tests.test_oracles import FOLDER

    got = lm_scoring.op6_lm_scoring(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").filter("score is not null")
    data = [(r.score, r.quality) for r in got.collect()]
    good, bad = [s for s, q in data if q == 1], [s for s, q in data if q == 0]
    assert sum(g > b for g in good for b in bad) > 0.9 * len(good) * len(bad)


def test_rare_words_and_bigrams_count(spark):
    """In a corpus of more than 100,000 tokens, what is seen once still tells a text from another."""
    filler = [" ".join(f"w{(i * 7 + j * j) % 900}" for j in range(2000)) for i in range(60)]
    good = ["sea glass rare words", "rare glass"]
    scored = lm_scoring.score(docs(spark, plain(["sea glass", "glass sea", "sea w1", "nowhere w1"])), lm_scoring.fit(docs(spark, plain(filler + good)), docs(spark, plain(good))))
    got = {r.text: r for r in scored.collect()}
    total, size = 60 * 2000 + 6, len({w for t in filler + good for w in t.split()}) + 1
    base = lambda n, total: (n + 0.5) / (total + 0.5 * size)
    first = -math.log((1 + 20 * base(1, total)) / (62 + 20))
    then = -math.log((1 + 20 * base(2, total)) / (1 + 20))
    assert got["sea glass"].loss_background == pytest.approx((first + then) / 2)
    first, then = -math.log((1 + 20 * base(1, 6)) / (2 + 20)), -math.log((1 + 20 * base(2, 6)) / (1 + 20))
    assert got["sea glass"].loss_target == pytest.approx((first + then) / 2)


def test_scored_within_as_by_fitted_models(spark):
    """Counting and answering in one exchange says what fitted models say, over several blocks, copies and empty texts."""
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 500}" for _ in range(rng.randrange(0, 80))) for _ in range(120)]
    data = docs(spark, plain([*texts, None, "", " \n", *texts[:5] * 6])).withColumnRenamed("source", "score").repartition(5)
    good = data.filter("doc_id % 3 = 0")
    got, want = (
        {r.doc_id: (r.text, r.lang, r.n_tokens, r.loss_background, r.loss_target, r.score) for r in scored.collect()}
        for scored in (lm_scoring.score_within(data, good), lm_scoring.score(data, lm_scoring.fit(data, good)))
    )
    assert len(got) == 153 and got == want
    assert len({x[2:] for i, x in got.items() if x[0] == texts[0]}) == 1


@pytest.mark.parametrize("numbers", [[], [0, 0], [1], [3, 0, 255], [256, 1, 2**40], [2**64 - 1, 0]])
def test_packed_numbers(numbers):
    n = np.array(numbers, np.uint64)
    assert lm_scoring._unpacked(lm_scoring._packed(n), len(n)).tolist() == numbers


def test_lm_writes_little(spark):
    """What one run writes to the shared folder is no more than its input; a row per bigram would be several times that."""
    from pathlib import Path

    from tests.test_oracles import FOLDER
    from tidemark.session import shared_dir

    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("tidemark-*"))
    assert lm_scoring.op6_lm_scoring(spark, FOLDER).count() > 0
    written = sum(p.stat().st_size for d in set(shared.glob("tidemark-*")) - before for p in d.rglob("*.parquet"))
    source = Path(FOLDER, "documents.parquet")
    assert 0 < written < 1.5 * sum(p.stat().st_size for p in ([source] if source.is_file() else source.rglob("*.parquet")))


def test_lm_passes_columns_on(spark):
    """Columns of any type and name, and texts longer than a block, come through."""
    from pyspark.sql import functions as F

    data = spark.range(6).select(
        "id", F.concat_ws(" ", F.lit("a b"), F.col("id") % 3).alias("text"), F.lit("2020-01-01").cast("date").alias("day"), F.lit("2020-01-01 01:02:03").cast("timestamp").alias("at"),
        F.lit(1.5).cast("decimal(10,2)").alias("price"), F.array(F.lit(None).cast("int")).alias("list"), F.struct(F.lit("x").alias("y")).alias("block"), F.lit(None).cast("string").alias("rows"), F.lit(9).alias("a.b"), F.lit(1).alias("part"),
    )
    out = lm_scoring.score_within(data, data.filter("id < 2"))
    assert out.columns == [*data.columns, "n_tokens", "loss_background", "loss_target", "score"]
    assert sorted(tuple(r)[:-4] for r in out.collect()) == sorted(map(tuple, data.collect()))
    long = docs(spark, plain(["q " * (lm_scoring.BLOCK + 5), "a b", "x" * (lm_scoring.BLOCK + 5), None])).coalesce(1)
    assert rows(lm_scoring.score_within(long, long.filter("doc_id = 1")), "doc_id", "n_tokens") == [(0, lm_scoring.BLOCK + 5), (1, 2), (2, 1), (3, 0)]
