"""Phrase collocations by ERA-style vertical partitioning of the corpus's suffixes.

Every word starts a suffix, cut after five words and at the end of its piece.

1. Words are counted per language. Phrases are only made of words that are frequent enough.
2. Word prefixes are counted, first pairs. A pair below the least count can't start a phrase,
   and a suffix ends where a pair is below it. A prefix with more suffixes than a task may
   hold is counted again one word longer, until all fit.
3. Prefixes are grouped up to that budget by ranges of their hashes. Each group's suffixes go
   to one task, which sorts them into the leaves of its subtrees and reads the counts of all
   nodes from leaf totals. Nodes above a lengthened prefix get a part from each group.
4. Scores, phrases inside longer ones and ranks are joins over the phrases found.

Words travel as 64-bit hashes; texts are joined back for the phrases that are ranked. Maps
of frequent words and pairs only keep work away: what they let through is counted exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table

DEPTH = 5
MIN_COUNT = 100
TOP = 2000
#: Suffixes that a group may hold. The driver holds one number for each prefix beyond it.
BUDGET = 1 << 19
#: Entries a task gathers before it hands them on; bounds memory, not the counts.
HELD = 1 << 20
#: Ranges of prefix hashes that are grouped.
RANGES = 16
#: Bits of the maps: 32 for every entry, between these powers of two. Past the largest, more passes them.
MAP_BITS = (16, 27)

_END = b"\xff"  # no byte of UTF-8
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = range(0x61, 0x7B)
for _byte in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_byte] = _END[0]
_TABLE[9] = 0x20
_TABLE = bytes(_TABLE)


def hash64(word: bytes) -> int:
    """What Spark's ``xxhash64`` says of the same bytes, unsigned."""
    return xxhash.xxh64_intdigest(word, 42)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words in order, with ``_END`` between pieces."""
    return text.translate(_TABLE).replace(_END, b" \xff ").split()


def mixed(*columns: np.ndarray | np.uint64) -> np.ndarray:
    out = np.zeros(1, np.uint64)
    for c in columns:
        out = (out ^ c) * np.uint64(0x9E3779B97F4A7C15)
        out = out ^ (out >> np.uint64(29))
    return out


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[bytes]]]:
    """The batch's words per language; texts are pieces of their own."""
    texts: dict[bytes, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        texts.setdefault(lang, []).append(text)
    for lang, some in texts.items():
        yield lang, words_of(_END.join(some))


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary")
    return docs.select(lang.alias("lang"), F.col("text").cast("binary").alias("text")).filter(F.length("text") > 0)


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n, lang_hash, hash)`` of all words, counted over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, Counter] = {}
        for batch in batches:
            for lang, words in _by_language(batch):
                counts.setdefault(lang, Counter()).update(words)
            if sum(map(len, counts.values())) > HELD:
                yield from said(counts)
                counts = {}
        yield from said(counts)

    def said(counts: dict[bytes, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, some in counts.items():
            some.pop(_END, None)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.binary()), pa.array(list(some), pa.binary()), pa.array(list(some.values()), pa.int64())], names=["lang", "word", "n"])

    counted = _texts(docs).mapInArrow(run, "lang binary, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.withColumns({"lang_hash": F.xxhash64("lang"), "hash": F.xxhash64("word")})


class Bits:
    """A set of 64-bit keys as a bit map; others may seem to be in it."""

    def __init__(self, keys: DataFrame, column: str):
        n = keys.count()
        self.bits = min(max(int(32 * n).bit_length(), MAP_BITS[0]), MAP_BITS[1])
        low = F.col(column).bitwiseAND(F.lit((1 << self.bits) - 1))
        rows = keys.select(F.shiftright(low, 15).alias("_at"), low.bitwiseAND(F.lit(32767)).alias("_bit")).groupBy("_at").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        self.map = np.zeros(1 << (self.bits - 3), np.uint8)
        for r in rows.toLocalIterator():  # as many bytes as the map has
            self.map[r._at << 12 : (r._at + 1) << 12] = np.frombuffer(bytes(r._bits), np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        low = keys & np.uint64((1 << self.bits) - 1)
        return (self.map[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _in(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array ``some``."""
    if not len(some):
        return np.zeros(len(keys), bool)
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


class Reader:
    """Tokens of a task's texts as hashes: what the passes over the corpus share."""

    def __init__(self, frequent: Bits):
        self.frequent = frequent
        self.known: dict[bytes, int] = {_END: 0}

    def tokens(self, batch: pa.RecordBatch) -> Iterator[tuple[np.uint64, np.ndarray]]:
        """Language and words; 0 for ends and for words that are too rare."""
        for lang, words in _by_language(batch):
            code = np.uint64(hash64(lang))
            h = np.fromiter(map(self.hash, words), np.uint64, len(words))
            h[~self.frequent.has(mixed(code, h))] = 0
            yield code, h

    def hash(self, word: bytes) -> int:
        h = self.known.get(word)
        if h is None:
            h = hash64(word)
            if len(self.known) < HELD:
                self.known[word] = h
        return h


def _pair_keys(code: np.uint64, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of the pair that starts at each word, and whether there is one."""
    return mixed(code, h[:-1], h[1:]), (h[:-1] != 0) & (h[1:] != 0)


class Suffixes:
    """Prefixes of up to ``DEPTH`` words at every place: which are alive, and their keys."""

    def __init__(self, pairs: Bits | None, code: np.uint64, h: np.ndarray):
        padded = np.concatenate([h, np.zeros(DEPTH, np.uint64)])
        key, alive = _pair_keys(code, padded)
        if pairs is not None:
            alive &= pairs.has(key)
        at = np.flatnonzero(alive)
        self.code, self.size = code, len(at)
        self.words = np.zeros((DEPTH, len(at)), np.uint64)
        self.words[:2] = padded[at], padded[at + 1]
        go = np.ones(len(at), bool)
        for d in range(2, DEPTH):
            go = go & alive[np.minimum(at + d - 1, len(alive) - 1)]
            self.words[d] = np.where(go, padded[np.minimum(at + d, len(padded) - 1)], 0)
        self.pair = key[at]

    def prefix(self, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Key and length of each suffix's prefix: one word longer than its longest hot one."""
        return lengthened(self.pair, self.words, hot)


def lengthened(pair: np.ndarray, words: np.ndarray, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, length = pair.copy(), np.full(len(pair), 2, np.int8)
    longer = np.ones(len(pair), bool)
    for d, some in enumerate(hot):
        longer = longer & _in(key, some)
        key = np.where(longer, mixed(key, words[2 + d]), key)
        length[longer] = 3 + d
    return key, length


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    some, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return some, first, np.bincount(at, weights=n, minlength=len(some)).astype(np.int64)


def _prefix_counts(docs: DataFrame, frequent: Bits, pairs: Bits | None, hot: list[np.ndarray]) -> DataFrame:
    """``(key, n)``: suffixes of every pair, or of every prefix one word longer than the hot ones given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = Reader(frequent), [], 0

        def said(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

        for batch in batches:
            for code, h in reader.tokens(batch):
                if hot:
                    suffixes = Suffixes(pairs, code, h)
                    key, length = suffixes.prefix(hot)
                    key = key[length == 2 + len(hot)]
                else:
                    key, alive = _pair_keys(code, h)
                    key = key[alive]
                held.append((key, np.ones(len(key), np.int64)))
                size += len(key)
            if size > HELD:
                some, _, n = _summed(*map(np.concatenate, zip(*held)))
                held, size = [(some, n)], len(some)
                if 2 * size > HELD:
                    yield said(some, n)
                    held, size = [], 0
        if held:
            some, _, n = _summed(*map(np.concatenate, zip(*held)))
            yield said(some, n)

    return _texts(docs).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _sorted_keys(rows: DataFrame) -> np.ndarray:
    return np.sort(np.array([r.key for r in rows.select("key").toLocalIterator()], np.int64).view(np.uint64))


def _ranges(prefixes: DataFrame) -> np.ndarray:
    """Suffixes per range of prefix hashes."""
    at = F.shiftrightunsigned("key", 64 - RANGES)
    out = np.zeros(1 << RANGES, np.int64)
    for r in prefixes.groupBy(at.alias("at")).agg(F.sum("n").alias("n")).toLocalIterator():  # 2 ** RANGES rows at most
        out[r.at] = r.n
    return out


def _grouped(loads: np.ndarray, budget: int) -> np.ndarray:
    """Group of every range: neighbours share one as long as their suffixes fit the budget."""
    out, group, load = np.zeros(len(loads), np.int32), 0, 0
    for i, n in enumerate(loads.tolist()):
        if load and load + n > budget:
            group, load = group + 1, 0
        load += n
        out[i] = group
    return out


ROW = "lang_hash long, " + ", ".join(f"w{i} long" for i in range(1, DEPTH + 1))


def _rows(code: np.ndarray, words: np.ndarray, *more: tuple[str, np.ndarray]) -> pa.RecordBatch:
    columns = {"lang_hash": code.view(np.int64), **{f"w{i + 1}": w.view(np.int64) for i, w in enumerate(words)}, **dict(more)}
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns.values()], names=list(columns))


def _suffix_rows(docs: DataFrame, frequent: Bits, pairs: Bits, hot: list[np.ndarray], groups: np.ndarray) -> DataFrame:
    """``(lang_hash, w1..w5, n, group)``: each task's distinct suffixes with their group; 0 stands after the last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = Reader(frequent), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            code = np.concatenate([np.full(s.size, s.code) if isinstance(s, Suffixes) else s[0] for s in held])
            words = np.concatenate([s.words if isinstance(s, Suffixes) else s[1] for s in held], axis=1)
            n = np.concatenate([np.ones(s.size, np.int64) if isinstance(s, Suffixes) else s[2] for s in held])
            _, first, total = _summed(mixed(code, *words), n)
            return code[first], words[:, first], total

        def said(code: np.ndarray, words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            key, _ = lengthened(mixed(code, words[0], words[1]), words, hot)
            return _rows(code, words, ("n", n), ("group", groups[key >> np.uint64(64 - RANGES)]))

        for batch in batches:
            for code, h in reader.tokens(batch):
                if len(h):
                    held.append(Suffixes(pairs, code, h))
                    size += held[-1].size
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if 2 * size > HELD:
                    yield said(*held[0])
                    held, size = [], 0
        if held:
            yield said(*merged())

    return _texts(docs).mapInArrow(run, ROW + ", n long, group int")


def subtrees(code: np.ndarray, words: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Nodes of the suffix subtrees of one group, level by level: depth, a leaf of each node, and its total.

    Sorted suffixes are the leaves in order; a node is a run of leaves that share a prefix.
    """
    order = np.lexsort([*words[::-1], code])
    fresh = np.ones(len(order), bool)
    c = code[order]
    fresh[1:] = c[1:] != c[:-1]
    totals = np.concatenate([[0], np.cumsum(n[order])])
    for depth, w in enumerate(words, 1):
        w = w[order]
        fresh[1:] |= w[1:] != w[:-1]
        if depth > 1:
            starts = np.flatnonzero(fresh)
            sums = totals[np.append(starts[1:], len(order))] - totals[starts]
            real = w[starts] != 0
            yield depth, order[starts[real]], sums[real]


def phrase_counts(docs: DataFrame, words: DataFrame, min_count: int = MIN_COUNT, budget: int = BUDGET) -> DataFrame:
    """``(lang_hash, words, f)`` of every phrase of 2 to 5 words that occurs at least ``min_count`` times."""
    with np.errstate(over="ignore"):
        common = words.filter(F.col("n") >= min_count).select("lang_hash", "hash")

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                key = mixed(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

        frequent = Bits(common.mapInArrow(keyed, "key long"), "key")
        level = kept(_prefix_counts(docs, frequent, None, []).filter(F.col("n") >= min_count))
        pairs = Bits(level, "key")
        loads, hot = np.zeros(1 << RANGES, np.int64), []
        while True:
            loads += _ranges(level.filter(F.col("n") <= budget))
            if len(hot) == DEPTH - 2:
                break
            above = _sorted_keys(level.filter(F.col("n") > budget))
            if not len(above):
                break
            hot.append(above)
            level = kept(_prefix_counts(docs, frequent, pairs, hot))
        groups = _grouped(loads, budget)

    def counted(rows: pa.Table) -> pa.Table:
        code, *w = (rows.column(i).to_numpy().view(np.uint64) for i in range(1 + DEPTH))
        w, n = np.array(w), rows.column("n").to_numpy()
        out = []
        for depth, leaf, total in subtrees(code, w, n):
            _, length = lengthened(mixed(code[leaf], w[0, leaf], w[1, leaf]), w[:, leaf], hot)
            part = length > depth  # other groups hold suffixes of this node too
            use = part | (total >= min_count)
            leaf, part, total = leaf[use], part[use], total[use]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(leaf) + 1, dtype=np.int32) * depth), pa.array(np.ascontiguousarray(w[:depth, leaf].T).view(np.int64).ravel()))
            out.append(pa.Table.from_arrays([pa.array(code[leaf].view(np.int64)), lists, pa.array(total), pa.array(part)], names=["lang_hash", "words", "f", "part"]))
        return pa.concat_tables(out)

    suffixes = _suffix_rows(docs, frequent, pairs, hot, groups)
    nodes = kept(suffixes.groupBy("group").applyInArrow(counted, "lang_hash long, words array<long>, f long, part boolean"))
    parts = nodes.filter("part").groupBy("lang_hash", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    return nodes.filter("NOT part").select("lang_hash", "words", "f").union(parts)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` has ``text`` and ``lang``; other columns, however named, are not read. A null
    ``lang`` is ``und``; null, empty and blank texts hold no words; every row counts, repeated
    ones too; texts are read whole, however long. Without phrases the result is empty. Ties
    in score go by count, then by the phrase's bytes, so ranks are always the same.
    """
    words = kept(word_counts(docs))
    sizes = words.groupBy("lang_hash").agg(F.first("lang").cast("string").alias("lang"), F.sum("n").alias("n"))
    found = kept(phrase_counts(docs, words, min_count, budget))
    frequent = words.filter(F.col("n") >= min_count)
    counts = found.select("lang_hash", "words", "f").union(frequent.select("lang_hash", F.array("hash"), "n"))
    size = F.size("words")
    cuts = found.select("lang_hash", F.col("words").alias("whole"), F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    side = lambda name: counts.select("lang_hash", F.col("words").alias(f"_{name}"), F.col("f").alias(name))
    cuts = cuts.withColumns({"_l": F.slice("whole", F.lit(1), F.col("k")), "_r": F.slice("whole", F.col("k") + 1, F.size("whole") - F.col("k"))})
    cuts = cuts.join(side("l"), ["lang_hash", "_l"]).join(side("r"), ["lang_hash", "_r"]).join(sizes, "lang_hash")
    # Whole numbers of 38 digits, and their whole quotient.
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "lang_hash", F.col("whole").alias("words"), "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "lang_hash", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("words", i, m))))
    longer = found.filter(size > 2).select("lang_hash", F.explode(inner).alias("words"), "f").groupBy("lang_hash", "words").agg(F.max("f").alias("longer"))
    whole = best.join(longer, ["lang_hash", "words"], "left").filter(F.coalesce(F.col("longer") < F.col("a"), F.lit(True))).drop("longer")
    # Before texts are known, ties at the limit all stay.
    by = [F.col("score").desc(), F.col("a").desc()]
    first = whole.withColumn("_place", F.rank().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("_place") <= top).drop("_place")
    said = first.select("*", F.posexplode("words").alias("_at", "hash")).join(frequent.select("lang_hash", "hash", F.col("word").cast("string").alias("_word")), ["lang_hash", "hash"])
    keys = ["lang", "lang_hash", "words", "a", "l", "r", "n", "score"]
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_word"))), lambda x: x["_word"]), " ")
    named = said.groupBy(*keys).agg(phrase.alias("phrase"))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by, F.col("phrase")))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of every language's documents whose words keep together most."""
    return collocations(table(spark, folder, "documents").select("lang", "text"))


SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase FROM words, (SELECT unnest(range(1, {DEPTH + 1})) AS m) s WHERE len(ws) >= m
), counts AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
), sizes AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang
), found AS MATERIALIZED (
  SELECT * FROM counts WHERE m >= 2 AND f >= {MIN_COUNT}
), cuts AS (
  SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS lp, array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS rp FROM found, (SELECT unnest(range(1, {DEPTH})) AS k) s WHERE k < m
), scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, x.f AS l, y.f AS r, n, k, CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.lp JOIN counts y ON y.lang = c.lang AND y.phrase = c.rp JOIN sizes s ON s.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM found o WHERE o.lang = b.lang AND o.m > b.m AND 100 * o.f >= 100 * b.a AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY rank <= {TOP}
"""


def register(queries: dict, oracles: dict) -> None:
    queries["op13_collocations"] = op13_collocations
    oracles["op13_collocations"] = SQL
