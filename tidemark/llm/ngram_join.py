"""N-gram Jaccard join by parity sketches.

A document's shingle hashes are XORed into a bit sketch: a bit tells whether an odd
number of shingles fell on it. Two sketches differ in at most as many bits as the sets
differ in shingles. Sets of Jaccard at least p/q differ in at most K = (q-p)(a+b)/(q+p)
shingles, so of K + 1 sketch words at least one is equal in both: sketches are cut into
K + 1 words of ``WIDTH`` bits per size band, and equal words meet in a join.

* By the pigeonring principle there even is an equal word from which any L words after it
  differ by at most L bits in all. A word with few bits set says little; its key is drawn
  out by halves of the words after it: of the 2L halves, L + 1 not yet in the key hold at
  most L differences, so one of them is equal too and no pair is lost.
* Equal sets meet first and count as one. Every set is compared with one leader (the set
  that shares most keys), linked sets are merged, and only sets of different groups that
  share a key are compared further, the larger group's members never with each other.
  So a large group of near copies costs one comparison a member.
* Pairs pass a fixed sketch (Hamming distance at most K) before their sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import bit_map, components, kept, on_disk, sheltered, table

#: Bits of a word (only those set are kept). Words with fewer than ``LOW_WORD`` set are
#: drawn out, by at most ``DEPTH`` halves of the words after them, until a half has a bit set.
WIDTH, LOW_WORD, DEPTH = 1 << 16, 2, 6
#: 64-bit words of the fixed sketch that pairs pass before their sets are read.
SIEVE = 32
#: Digests a task remembers to send keys of equal sets once only.
REMEMBERED = 1 << 20
#: Sets whose keys are made in one go.
AT_ONCE = 256

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words (A-Z lowered); a shorter text is one run."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(len(h), size), np.uint64)
    for j in range(min(len(h), size)):
        out = _mix(out * _ODD[0] + h[j : j + n])
    out.sort()  # much quicker than a general unique
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


class Bands:
    """Size bands for a Jaccard threshold p/q: sets that can link lie in one band or in two next to each other."""

    def __init__(self, p: int, q: int):
        self.p, self.q, self.high = p, q, [0]

    def furthest(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (self.q - self.p) * (a + b) // (self.q + self.p)

    def of(self, n: int) -> int:
        while self.high[-1] < n:
            low = self.high[-1] + 1
            self.high.append(max(low, low * self.q // self.p))
        return int(np.searchsorted(self.high, n))

    def words(self, band: int) -> int:
        top = self.high[band]
        return self.furthest(top, top * self.q // self.p) + 1

    def reach(self, n: int) -> list[int]:
        """Bands in which a set of size n must be found: its own, and the one below if a partner may lie there."""
        own = self.of(n)
        return [own, own - 1] if own > 1 and -(-n * self.p // self.q) <= self.high[own - 1] else [own]


def sketch(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Parity sketch as 64-bit words."""
    odd = np.bincount(((hashes >> np.uint64(7)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def keys(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of many sets, in their order, and how many each has: linked unequal sets share one at least."""
    units = [(i, band, m) for i, h in enumerate(sets) if len(h) for band in bands.reach(len(h)) if (m := bands.words(band)) > 1]
    if not units:  # in bands of one word only equal sets link
        return np.zeros(0, np.uint64), np.zeros(len(sets), np.int64)
    owner, band, m = (np.array(x, np.int64) for x in zip(*units))
    first = np.concatenate([[0], np.cumsum(m)])
    unit = np.repeat(np.arange(len(units)), m)  # of each word
    size = np.array([len(sets[i]) for i in owner])
    width = np.repeat(m * WIDTH, size).astype(np.uint64)
    shift = (first[:-1] * WIDTH).astype(np.uint64)
    at = np.sort((np.concatenate([sets[i] for i in owner]) >> np.uint64(7)) % width + np.repeat(shift, size))
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    at = at[start[np.diff(np.append(start, len(at))) % 2 == 1]]  # bits hit an odd number of times
    half = (at // np.uint64(WIDTH // 2)).astype(np.int64)
    count = np.bincount(half, minlength=2 * len(unit)).reshape(-1, 2)
    value = np.zeros(2 * len(unit), np.uint64)
    if len(at):
        start = np.flatnonzero(np.concatenate(([True], half[1:] != half[:-1])))
        value[half[start]] = np.bitwise_xor.reduceat(_mix(at - shift[unit[half // 2]] + np.uint64(1)), start)
    value = value.reshape(-1, 2)

    place = (np.arange(len(unit)) - first[unit] + (band[unit] << 32)).astype(np.uint64)
    key = _mix(value[:, 0] * _ODD[1] + value[:, 1] + _mix(place))
    low = count.sum(axis=1) < LOW_WORD
    out, of = [key[~low]], [unit[~low]]
    word, drawn = np.flatnonzero(low), key[low]
    used, last = np.zeros(len(word), np.int64), np.minimum(DEPTH, m - 1)
    for level in range(1, DEPTH + 1):
        onward = []
        for j in range(2 * level):
            free = used >> j & 1 == 0
            w, u = word[free], unit[word[free]]
            after = first[u] + (w - first[u] + 1 + j // 2) % m[u]
            longer = _mix(drawn[free] + value[after, j % 2] * _ODD[2] + np.uint64(j + 1))
            weak = (count[after, j % 2] == 0) & (level < last[u])
            out.append(longer[~weak])
            of.append(u[~weak])
            onward.append((w[weak], longer[weak], used[free][weak] | 1 << j))
        word, drawn, used = (np.concatenate(x) for x in zip(*onward))
        if not len(word):
            break
    flat, mine = np.concatenate(out), owner[np.concatenate(of)]
    return flat[np.argsort(mine, kind="stable")], np.bincount(mine, minlength=len(sets))


def digest(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _keys(size: int, p: int, q: int):
    """Every set with its keys; of equal sets in a task the first sends them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(p, q), set()
        for batch in batches:
            names, sets = [], []
            for text in batch.column(0).to_pylist():
                h = shingles(text, size)
                name = digest(h)
                if name not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(h)
            if len(seen) > REMEMBERED:
                seen = set()
            for low in range(0, len(sets), AT_ONCE):  # bounds the arrays, whatever the batch
                flat, n = keys(sets[low : low + AT_ONCE], bands)
                node = np.array(names[low : low + AT_ONCE], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(node, n)), pa.array(flat.view(np.int64))], names=["node", "key"])

    return run


def _rows(size: int):
    """Every row with the name and size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column(2).to_pylist()]
            names = np.array([digest(h) for h in sets], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(h) for h in sets], pa.int64()), pa.array(names.view(np.int64))], names=["id", "mark", "n", "node"])

    return run


def _sets(size: int, wanted: np.ndarray):
    """Sets whose name the map holds, with their sieves, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            names, sets = [], []
            for text in batch.column(0).to_pylist():
                h = shingles(text, size)
                name = digest(h)
                if len(h) and wanted[name & (len(wanted) - 1)] and name not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(h)
            if len(seen) > REMEMBERED:
                seen = set()
            yield pa.RecordBatch.from_arrays([pa.array(np.array(names, np.uint64).view(np.int64)), _lists(sets), _lists([sketch(h, 64 * SIEVE) for h in sets])], names=["node", "shingles", "sieve"])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sets have Jaccard at least p/q, compared whole."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    return pairs.join(left, "a").join(right, "b").filter(q * both >= p * either).select("a", "b")


def groups(docs: DataFrame, size: int = 3, p: int = 9, q: int = 10) -> DataFrame:
    """``(id, mark, n, node, root)`` of each row of ``docs(id, mark, text)``.

    ``node`` names the set, ``root`` the group of linked sets. Shingles are 64-bit hashes.
    """
    rows = docs.select("id", "mark", F.col("text").cast("binary").alias("text"))
    # Keys travel once. A key's rows are as many as its sets at most, a few hundredths of a
    # percent of all even where a third of all sets are near copies: those share many keys.
    held = rows.select("text").mapInArrow(_keys(size, p, q), "node long, key long")
    here = W.partitionBy("key")
    met = held.withColumns({"low": F.min("node").over(here), "high": F.max("node").over(here), "times": F.count("*").over(here)})
    met = kept(met.filter("low < high").select("key", "node", "times").distinct())
    made = on_disk(rows.mapInArrow(_rows(size), "id long, mark long, n long, node long"))
    sets = rows.select("text").mapInArrow(_sets(size, bit_map(met, "node")), "node long, shingles array<long>, sieve array<long>")
    sets = kept(sets.dropDuplicates(["node"]))

    # Each set with the leader of one of its keys: that which shares most.
    weight = met.groupBy("node").agg(F.sum("times").alias("weight"))
    leader = met.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("lead"))
    first = met.join(leader, "key").groupBy(F.col("node").alias("a")).agg(F.max("lead").alias("lead")).select("a", F.col("lead.node").alias("b")).filter("a <> b")
    near = kept(_linked(first, sets, p, q))
    merged = on_disk(components(near))

    # What is left: sets that share a key across groups.
    placed = met.join(merged, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    count = placed.groupBy("key", "root").agg(F.count("*").alias("c"))
    largest = count.groupBy("key").agg(F.max(F.struct("c", "root")).alias("main"), F.count("*").alias("groups")).filter("groups > 1").select("key", F.col("main.root").alias("main"))
    sieve = sets.select("node", "sieve", F.size("shingles").alias("n"))
    open_ = kept(placed.join(largest, "key").join(sieve, "node"))
    one = open_.filter("root <> main").select("key", *[F.col(c).alias(f"{c}1") for c in ("node", "root", "n", "sieve")])
    two = open_.select("key", *[F.col(c).alias(f"{c}2") for c in ("node", "root", "n", "sieve", "main")])
    apart = F.aggregate(F.zip_with("sieve1", "sieve2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    close = F.expr(f"root1 <> root2 AND (root2 = main2 OR node1 < node2) AND {q} * least(n1, n2) >= {p} * greatest(n1, n2)") & (apart <= F.floor((q - p) * (F.col("n1") + F.col("n2")) / (q + p)))
    left = one.join(two, "key").filter(close).select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct()
    edges = near.union(kept(_linked(kept(left), sets, p, q)))
    roots = components(edges)
    return made.select("id", "mark", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text")


def link(docs: DataFrame, size: int = 3, p: int = 9, q: int = 10) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    Two texts link when the Jaccard index of their sets of ``size``-word shingles is at
    least p/q. ``component_id`` is the least ``doc_id`` reachable by links. A text of fewer
    words is one shingle; null, empty and blank texts have none, link with nothing and keep
    their own id. Rows without id count in links but name no component: where nothing
    reachable has an id, the component is null. Rows that share an id but not the text
    are separate nodes. An empty table gives no rows.
    """
    rows = on_disk(groups(keyed(docs), size, p, q))
    name = rows.filter("n > 0").groupBy(F.col("root").alias("r")).agg(F.min("id").alias("least"))
    out = rows.join(name, F.col("root") == F.col("r"), "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, p: int = 4, q: int = 5) -> DataFrame:
    """``docs`` with one row of every group of linked texts: the least id (rows without id last).

    Texts without words are in no group and stay; equal rows of a kept id and text are one.
    """
    rows = groups(keyed(docs), size, p, q).filter("n > 0")
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("best"))
    best = best.select(F.col("best.id").alias("_id"), F.col("best.mark").alias("_m"))

    def kept_rows(docs: DataFrame) -> DataFrame:
        marked = docs.withColumns({"_key": F.col("doc_id").cast("long"), "_mark": F.xxhash64("text"), "_bare": ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))})
        full = marked.filter("NOT _bare").join(best, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_m")), "left_semi").dropDuplicates(["_key", "_mark"])
        return full.union(marked.filter("_bare"))

    return sheltered(docs, ("doc_id", "text"), (), kept_rows)


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return link(table(spark, folder, "documents").select("doc_id", "text"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, len(coalesce(s.s, []))::BIGINT AS n_shingles, min(r.y) AS component_id
FROM sets s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.s
"""


def register(queries: dict, oracles: dict) -> None:
    queries["op3_ngram_join"] = op3_ngram_join
    oracles["op3_ngram_join"] = SQL
