import hashlib
import random

import pytest

from tests.llm.helpers import DOCS, docs, plain, rows
from tidemark.llm import line_dedup, mixing, url_filter

PAGES = "page_id long, url string, host string, rule string"


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
    hits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(hits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_urls_against_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "https://ORG/", "http://example.org/es/1", "http://www.Example.ORG/en/12?x=/es/", "http://badexample.org/es/x", "http://a.com#/de/", "http://a.com/de/?q", "http://a.com/fr/x", "http://org.net/", "http://x.org", "ftp://é.org/de/", "http://a.org:80/es/", "http://" + "a." * 3000 + "org/" + "p/" * 5000, "x://y://org/"]
    rules = (*url_filter.RULES, ("block", "b.org", "/xx"), ("allow", "org", "/xxyy"), ("block", "org", "/"))
    table = spark.createDataFrame([(i % 14, u, "clash", "clash") for i, u in enumerate(urls + urls[:6])], PAGES)
    for chosen in (url_filter.RULES, rules):
        got = rows(url_filter.judge_urls(table, url_filter.rule_table(spark, chosen)), "url", "host", "path", "rule", "verdict")
        want = sorted([(u, *brute_url(u, chosen)) for u in urls + urls[:6]], key=repr)
        if chosen is url_filter.RULES:
            assert got == want
        else:
            assert [g[:3] for g in got] == [w[:3] for w in want] and [g[4] for g in got] == [w[4] for w in want]


def test_urls_empty(spark):
    empty = spark.createDataFrame([], PAGES)
    assert url_filter.judge_urls(empty, url_filter.rule_table(spark)).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/", "", "")], PAGES)
    assert rows(url_filter.judge_urls(one, url_filter.rule_table(spark, ())), "rule", "verdict") == [(None, "allow")]


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, repeat=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, budget = {}, set(names), share * sum(sizes.values())
    while left:
        total = sum(weight[s] for s in left)
        over = [s for s in left if budget * weight[s] / total > repeat * sizes[s]]
        if not over:
            target.update({s: budget * weight[s] / total for s in left})
            break
        for s in over:
            target[s] = float(repeat * sizes[s])
            left.discard(s)
        budget = share * sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("seed", range(3))
def test_mixing_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = []
    for i in range(400):
        source = None if i % 37 == 0 else "hot" if i % 3 == 0 else f"s{rng.randrange(9)}"
        text = None if i % 50 == 0 else "" if i % 41 == 0 else " \n\t".join(["wörd"] * rng.randrange(1, 200 if i % 29 else 5000))
        data.append((None if i % 61 == 0 else i // 2, text, "en", source, 0))
    table = docs(spark, data).withColumnRenamed("n_chars", "taken")
    got = mixing.mix(mixing.sized(table), shard_rows=30).collect()
    assert len(got) == len(data)
    sizes = {}
    for _, text, _, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    target, taken = brute_targets(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(target[r.source], abs=1e-6)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 16 * 8
    again = mixing.mix(mixing.sized(table.repartition(7)), shard_rows=30).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_sainte_lague_is_highest_quotients(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    data = [(g, i, float(rng.choice([0, 1, 3, rng.randrange(1, 10**6)]))) for g in range(30) for i in range(rng.randrange(1, 12))]
    seats = {g: rng.randrange(0, 60) for g in range(30)}
    table = spark.createDataFrame([(g, i, v, seats[g]) for g, i, v in data], "g int, i int, v double, seats long")
    got = {(r.g, r.i): r.won for r in mixing.sainte_lague(table, F.col("seats"), "v", ["g"], ["i"], "won").collect()}
    for g in range(30):
        mine = [(i, v) for gg, i, v in data if gg == g]
        quotients = sorted((-v / (2 * k + 1), i) for i, v in mine if v > 0 for k in range(60))[: seats[g]]
        for i, _ in mine:
            assert got[g, i] == sum(1 for _, j in quotients if j == i)


def test_mixing_empty(spark):
    assert mixing.mix(mixing.sized(docs(spark, []))).count() == 0
    assert rows(mixing.mix(mixing.sized(docs(spark, plain([None, ""])))), "doc_id", "size", "target", "taken") == [(0, 0, 0.0, 0), (1, 0, 0.0, 0)]


def brute_lines(data):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    ident = lambda d: -(2**63) if d is None else d
    held = {}
    for d, text in data:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                held.setdefault(key(line), set()).add(ident(d))
    out = []
    for d, text in data:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (len(held.get(key(x), ())) >= 5 and ident(d) < max(held[key(x)]))]
        out.append((d, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [3, 40])
def test_lines_against_brute_force(spark, partitions):
    rng = random.Random(2)
    common = [f"Line {i} that many documents hold, with ümlauts {i}" for i in range(6)]
    data = [(i // 2 if i % 7 == 0 else 1000 + i, "\n".join(rng.choice(["short", "", "x" * 39, "x" * 40, common[0], " \t" + common[rng.randrange(6)].upper() + "\r", f"own line number {i} " + "y" * 40]) for _ in range(rng.randrange(0, 30)))) for i in range(300)]
    data += [(None, common[0]), (None, common[1] + "\n" + common[0]), (7, None), (8, ""), data[5], data[5], (10**15, "\n".join([common[0]] * 50)), (10**15 + 1, common[2])]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.createDataFrame([(*d, "clash", 5) for d in data], "doc_id long, text string, kept string, n_lines int")
        from pyspark.sql import functions as F

        got = line_dedup.dedup_lines(table).withColumn("sha", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256))
        assert rows(got, "doc_id", "n_lines", "n_dropped", "sha") == brute_lines(data)
        assert got.filter("text is null").select("kept").first()[0] is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_line_bitmaps():
    assert line_dedup.kept("a\nb\nc\nd", line_dedup.bitmap([1])) == "a\nc\nd"
    assert line_dedup.kept("a", line_dedup.bitmap([0])) == ""
    assert line_dedup.kept("\n".join(map(str, range(20))), line_dedup.bitmap(list(range(19)))) == "19"


def test_lines_empty(spark):
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0
    assert DOCS.split()[0] in line_dedup.dedup_lines(docs(spark, plain([None]))).columns
