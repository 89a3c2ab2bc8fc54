import random

import numpy as np
import pytest

from tests.llm.helpers import docs, plain, rows
from tidemark.llm import decontamination, ngram_join


def shingle_set(text, size):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_groups(data, size, p, q):
    sets = [shingle_set(t, size) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and q * len(sets[i] & sets[j]) >= p * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), (least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(data, sets))]


def family(rng, length, copies, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[f"n{rng.randrange(9999)}"], [], [w[at], "more"]])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("size", "p", "q"), [(3, 9, 10), (5, 4, 5)])
def test_groups_against_brute_force(spark, size, p, q):
    rng = random.Random(size)
    texts = [None, "", " \n ", "one", "One", "one two", "x y z", "X  y\nz", *family(rng, 12, 15, 2), *family(rng, 30, 20, 3), *family(rng, 60, 60, 6), *family(rng, 200, 80, 14), *family(rng, 900, 10, 40)]
    texts += [t.upper() for t in texts[20:30] if t]
    texts += [" ".join(f"u{rng.randrange(9999)}" for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    rng.shuffle(texts)
    data = [(None if i % 41 == 0 else i // 2 if i % 17 == 0 else i, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame([(*d, "clash") for d in data], "doc_id long, text string, component_id string")
    got = rows(ngram_join.link(table, size, p, q), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_groups(data, size, p, q), key=repr)


def keys_of(hashes, bands):
    """Keys of a set, made among other sets of other sizes."""
    others = [np.arange(1, n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for n in (1, 30, 8, 300)]
    flat, n = ngram_join.keys([*others, np.unique(hashes), *others], bands)
    at = np.concatenate([[0], np.cumsum(n)])[4]
    return set(flat[at : at + n[4]].tolist())


def test_keys_lose_no_link():
    """Sets at the very threshold share a key, whatever their size."""
    rng = np.random.default_rng(1)
    for p, q in ((9, 10), (4, 5)):
        bands = ngram_join.Bands(p, q)
        for n in (5, 9, 18, 19, 20, 40, 77, 150, 400, 1500):
            for _ in range(30):
                a = rng.integers(1, 2**62, n).astype(np.uint64)
                add = int(rng.integers(0, n * (q - p) // p + 1))
                drop = max(0, min(n - 1, bands.furthest(n, n + add) // 2))
                b = np.concatenate([a[drop:], rng.integers(1, 2**62, add).astype(np.uint64)])
                both = len(set(a.tolist()) & set(b.tolist()))
                either = len(set(a.tolist()) | set(b.tolist()))
                if q * both >= p * either and set(a.tolist()) != set(b.tolist()):
                    assert keys_of(a, bands) & keys_of(b, bands)


def test_one_of_each_group_stays(spark):
    rng = random.Random(8)
    copies = family(rng, 100, 12, 3)
    texts = [*copies, copies[0], "alone in the world of texts here", None, "", "!!"]
    table = docs(spark, plain(texts) + [(0, copies[0], "en", "a", 0)])
    kept = ngram_join.keep_one(table)
    assert kept.columns == table.columns
    want = {}
    for d, n, c in brute_groups([(i, t) for i, t in enumerate(texts)], 5, 4, 5):
        want.setdefault(c if n else ("none", d), d)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want.values())
    assert ngram_join.keep_one(docs(spark, [])).count() == 0
    assert ngram_join.link(docs(spark, [])).count() == 0


ITEMS = [
    "A train leaves Berlin at 12:30 and travels 240 km in 3 hours. What is the speed of the train when Anna waits?",
    "Only four words here",
    "the same word the same word the same word the same word the same word",
    None,
    "",
]
FILL = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore"


def found(spark, texts, items=ITEMS):
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    return {(r.doc_id, r.item_id) for r in decontamination.leaks(docs(spark, plain(texts)), benchmark.select("item_id", "text")).collect()}


def test_leaks(spark):
    texts = [
        f"{FILL}. {ITEMS[0]} {FILL}",
        f"{FILL}. {ITEMS[0].replace('240 km', '360 km').replace('Berlin', 'Paris').replace('Anna', 'Otto')}",
        f"{FILL}. {ITEMS[0].lower()}",
        FILL,
        ITEMS[1],
        f"{FILL} {ITEMS[1]} {FILL}",
        None,
        "",
        ITEMS[0][:60],
        f"{FILL}.\n{ITEMS[2]} {FILL} {ITEMS[0]}",
        f"{FILL}. {ITEMS[0]} " * 400,
        " ".join(ITEMS[0].split()[:12]),
        f"{FILL} only FOUR words, here. {FILL}",
        f"{FILL} only four new words here {FILL}",
    ]
    # A passage of 13 tokens (8) is a leak and one of 12 (11) is not; short items are found inside texts.
    assert found(spark, texts) == {(0, 0), (1, 0), (2, 0), (4, 1), (5, 1), (8, 0), (9, 0), (9, 2), (10, 0), (12, 1)}


def test_short_items_need_their_very_words(spark):
    items = ["in 1990", "Paris", "12 km away", "two words"]
    texts = ["It was in 1990, they say", "It was in 1991", "PARIS!", "He lives in Rome", "Just 12 km away from here", "13 km away", "two", "words two", ""]
    assert found(spark, texts, items) == {(0, 0), (2, 1), (4, 2)}


def test_slots_must_agree(spark):
    item = "If one box holds 7 apples and the other box holds 7 pears then how many fruits do 7 children get"
    other = item.replace("7", "9")
    mixed = item.replace("7 apples", "1 apples").replace("7 pears", "2 pears").replace("7 children", "3 children")
    assert found(spark, [f"{FILL} {other}", f"{FILL} {mixed}"], [item]) == {(0, 0)}


def test_leaks_empty_and_rows_that_stay(spark):
    assert found(spark, []) == set() and found(spark, [ITEMS[0]], []) == set()
    table = docs(spark, [(1, ITEMS[0], "en", "a", 0), (None, ITEMS[0], "en", "a", 0), (1, FILL, "en", "a", 0), (2, None, None, None, None), (3, FILL, "en", "a", 0), (3, FILL, "en", "a", 0)])
    benchmark = spark.createDataFrame([(0, ITEMS[0]), (0, ITEMS[0]), (None, "x y z a b c d e")], "item_id long, text string")
    kept = decontamination.decontaminate(table, benchmark)
    assert kept.columns == table.columns
    assert rows(kept, "doc_id", "text") == sorted([(1, FILL), (2, None), (3, FILL), (3, FILL)], key=repr)


def test_leaks_match_plain_search(spark):
    from tests.test_oracles import FOLDER

    flat = lambda t: f" {' '.join((t or '').lower().split())} "
    read = lambda name, key: [(r[0], flat(r[1])) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(key, "text").collect()]
    items = read("benchmark", "item_id")
    want = {(d, i) for d, t in read("documents", "doc_id") for i, u in items if u in t}
    got = {(r.doc_id, r.item_id) for r in decontamination.op8_decontamination(spark, FOLDER).collect()}
    assert want <= got and len(got - want) <= 0.05 * len(want) + 1


def test_each_version_of_a_template_is_judged_by_itself(spark):
    item = "We bought 4 red and 9 blue and 5 green pens"
    other, third = "We bought 7 red and 3 blue and 8 green pens", "We bought 1 red and 2 blue and 6 green pens"
    sheet = ". ".join(f"We bought {i} red and {i + 50} blue and {i + 90} green pens" for i in range(10, 40))
    broken = "If one box holds 7 apples and the other box holds 7 pears then how many fruits do 7 children get"
    wrong = ". ".join(broken.replace("7 apples", f"{a} apples").replace("7 pears", f"{b} pears").replace("7 children", f"{c} children") for a, b, c in ((1, 2, 3), (4, 5, 6)))
    texts = [f"{FILL}. {item}. {other}.", f"{FILL}. {other}. {third}.", sheet, FILL, wrong]
    assert found(spark, texts, [item, broken]) == {(0, 0), (1, 0), (2, 0)}


def test_copies_in_other_letter_case(spark):
    short = "Where does the Danube reach the sea"
    texts = [f"{FILL}. {ITEMS[0].lower()}", f"{FILL} {ITEMS[0].upper()} {FILL}", f"{FILL}. {ITEMS[0].title()}", f"{FILL}\n{short}\n{FILL}", FILL, FILL.upper()]
    assert found(spark, texts, [ITEMS[0], short]) == {(0, 0), (1, 0), (2, 0), (3, 1)}


def test_long_passages_of_an_item(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    item = " ".join(words)
    numbers = " ".join(f"{i}" for i in range(100, 130))
    texts = [f"{FILL} {' '.join(words[9:49])} {FILL}", f"{FILL} {' '.join(words[20:33])} {FILL}", f"{FILL} {' '.join(words[20:32])} {FILL}", f"{FILL} {' '.join(words[5:14])} {FILL} {' '.join(words[30:39])}", " ".join(f"{i}" for i in range(500, 520))]
    assert found(spark, texts, [item, numbers]) == {(0, 0), (1, 0)}
