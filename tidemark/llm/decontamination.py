"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, quantities, units after a number and names (capitals
inside a sentence) turn into typed placeholders. Windows of ``WINDOW`` template tokens
are hashed and joined with the benchmark's; a document holds an item if windows whose
slot fillings agree with one mapping of the item's values, that of an occurrence, cover
``COVER`` of the item, or lie in a row over ``RUN`` tokens.
Exact copies map every value to itself; re-parameterised questions map it to another one.
Names are known by their capitals, so windows are hashed with and without them as slots:
copies in other letter case agree in the second.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bit_map, on_disk, sheltered, table

WINDOW = 5
COVER = 0.8
#: A passage of so many tokens of an item is a leak, whatever its share of the item.
RUN = 13
#: Alignments at most so many tokens apart are also judged as one occurrence.
GAP = 4
#: Words a task remembers; beyond that it starts anew, with the same results.
REMEMBERED = 1 << 20

_NUMBER = re.compile(rb"[+-]?(?:\d[\d.,:/]*|\.\d+)(?:st|nd|rd|th)?")
_QUANTITY = re.compile(rb"[$\xc2\xa3\xe2\x82\xac]*[+-]?\d[\d.,:/]*(?:%|[a-z\xc2\xb0]{1,8}[23]?)?")
_UNITS = frozenset("""mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles meter meters metre metres kilometer kilometers kilometre kilometres
mg g kg t gram grams kilogram kilograms ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml cl l liter liters litre litres gallon gallons
ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years
percent degree degrees cent cents dollar dollars euro euros usd eur gbp kb mb gb tb hz khz mhz ghz w kw kwh v a j kj cal kcal mph kmh""".encode().split())
NUM, QTY, UNIT, NAME, ENDS, EMPTY = 1, 2, 4, 8, 16, 32


def classify(word: bytes) -> tuple[bytes, int]:
    """The bare lower-case word and what it may be."""
    core = word.strip(b"\"'`()[]{}<>.,;:!?*_-")
    flags = ENDS if word.rstrip(b"\"')]}`").endswith((b".", b"!", b"?", b":", b";")) else 0
    if not core:
        return core, flags | EMPTY
    low = core.decode("utf-8", "replace")
    capital = low[0].isupper()
    low = low.lower().encode()
    if _NUMBER.fullmatch(low):
        return low, flags | NUM
    if _QUANTITY.fullmatch(low):
        return low, flags | QTY
    return low, flags | (UNIT if low in _UNITS else 0) | (NAME if capital else 0)


class Words(dict):
    """Raw word to a row of the tables ``code`` and ``flags``, filled as words turn up."""

    def __init__(self) -> None:
        self.code, self.flags = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint8)
        self.bare: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        at = len(self.bare)
        if at == len(self.code):
            self.code, self.flags = (np.concatenate([x, np.zeros_like(x)]) for x in (self.code, self.flags))
        bare, self.flags[at] = classify(word)
        self.code[at] = xxhash.xxh3_64_intdigest(bare)
        self.bare.append(bare)
        self[word] = at
        return at


_SLOT = {kind: np.uint64(xxhash.xxh3_64_intdigest(name)) for kind, name in ((NUM, b"<number>"), (QTY, b"<quantity>"), (UNIT, b"<unit>"), (NAME, b"<name>"))}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Templates:
    """Template tokens of a batch of texts, and their windows."""

    def __init__(self, texts: list[bytes | None], words: Words):
        split = [(t or b"").split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        ids = np.fromiter((words[w] for text in split for w in text), np.int64, sizes.sum())
        text = np.repeat(np.arange(len(split)), sizes)
        flags = words.flags[ids]
        first = np.ones(len(ids), bool)
        first[1:] = (text[1:] != text[:-1]) | (flags[:-1] & ENDS > 0)
        real = flags & EMPTY == 0
        ids, self.text, flags, first = ids[real], text[real], flags[real], first[real]
        after_number = np.zeros(len(ids), bool)
        after_number[1:] = (flags[:-1] & NUM > 0) & (self.text[1:] == self.text[:-1])
        kinds = [(NUM, flags & NUM > 0), (QTY, flags & QTY > 0), (UNIT, (flags & UNIT > 0) & after_number)]
        kinds.append((NAME, (flags & NAME > 0) & ~first & ~kinds[2][1]))
        self.code, self.slot = words.code[ids], np.zeros(len(ids), bool)
        for kind, hit in kinds:
            #: Without names: what a copy in other letter case has in common.
            self.folded, self.counted = self.code, self.slot.copy()
            self.code = np.where(hit, _SLOT[kind], self.code)
            self.slot |= hit
        self.plain = words.code[ids]
        self.ids, self.bare = ids, words.bare
        self.sizes = np.bincount(self.text, minlength=len(split))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def windows(self, short: tuple[int, ...] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, length, hash and kind of every window.

        Kind 0 has names as slots; kind 1 has them as lower-case words, for windows that hold
        any. Kind 2 has no slots and fewer than ``WINDOW`` tokens: at the lengths given, or
        else every text that is no longer.
        """
        at, value = self._hashed(self.code, WINDOW)
        other = self._hashed(self.folded, WINDOW)[1]
        named = np.flatnonzero(other != value)
        out = [(at, WINDOW, value, 0), (at[named], WINDOW, other[named], 1)]
        for n in range(1, WINDOW) if short is None else short:
            at, value = self._hashed(self.plain, n)
            if short is None:
                whole = self.sizes[self.text[at]] == n
                at, value = at[whole], value[whole]
            out.append((at, n, value, 2))
        return tuple(np.concatenate([np.full(len(o[0]), o[k]) if np.isscalar(o[k]) else o[k] for o in out]) for k in range(4))

    def _hashed(self, code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(code) - size + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        whole = np.full(n, 0 if size == WINDOW else size, np.uint64)
        for j in range(size):
            whole = _mix(whole * np.uint64(0x9E3779B97F4A7C15) + code[j : n + j])
        at = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        return at, whole[at]

    def filled(self, at: int, size: int, kind: int) -> list[str]:
        if kind == 2:
            return []
        slot = self.counted if kind else self.slot
        return [self.bare[self.ids[i]].decode("utf-8", "replace") for i in range(at, at + size) if slot[i]]


ROWS = "id long, mark long, n int, pos int, size int, hash long, slots array<string>"


def windows(rows: DataFrame, wanted: np.ndarray | None = None, short: tuple[int, ...] | None = None) -> DataFrame:
    """Windows ``(id, mark, n, pos, size, hash, slots)`` of ``rows(id, mark, text)``, those the filter lets through.

    ``n`` is how many windows the text has, ``pos`` the window's place among them. A window
    that holds names has two rows, with and without names as slots. ``short``: see ``Templates.windows``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            if len(words) > REMEMBERED:
                words = Words()
            made = Templates(batch.column(2).to_pylist(), words)
            at, size, value, kind = made.windows(short)
            count = np.bincount(made.text[at[kind != 1]], minlength=batch.num_rows) if len(at) else np.zeros(batch.num_rows, np.int64)
            hit = np.arange(len(at)) if wanted is None else np.flatnonzero(wanted[(value & np.uint64(len(wanted) - 1)).astype(np.int64)])
            where = made.text[at[hit]] if len(hit) else np.zeros(0, np.int64)
            take = pa.array(where, pa.int64())
            marked = np.concatenate([[0], np.cumsum(made.slot)])
            slots = [made.filled(a, s, k) if marked[a + s] > marked[a] else [] for a, s, k in zip(at[hit], size[hit], kind[hit])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(count[where], pa.int32()), pa.array(at[hit] - made.starts[where], pa.int32()), pa.array(size[hit], pa.int32()), pa.array(value[hit].view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
                names=["id", "mark", "n", "pos", "size", "hash", "slots"],
            )

    return rows.select("id", "mark", F.col("text").cast("binary").alias("text")).mapInArrow(run, ROWS)


def _keyed(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text").filter(F.col("text").isNotNull())


def leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """``(doc_id, doc_mark, item_id, n_windows, n_matched, coverage)`` of every document that holds an item.

    Null and empty texts hold nothing and are held by nothing. An item of fewer than
    ``WINDOW`` tokens is held by every text with these very tokens in a row, in any letter
    case. Very long texts are read whole. Repeated documents and items, and those without
    id, are told apart by their text (``doc_mark``); equal ones give one row. Fillings are
    judged occurrence by occurrence, where a value filled in several ways counts by its
    most frequent filling, ties to the least; unchanged values always fit. A passage of
    ``RUN`` tokens of an item is enough, whatever its share: ``coverage`` then is below ``cover``.
    An empty table on either side gives no rows.
    """
    items = on_disk(windows(_keyed(benchmark, item_id).distinct()))
    wanted = bit_map(items, "hash")
    short = tuple(sorted(r.size for r in items.filter(F.col("size") < WINDOW).select("size").distinct().collect()))  # lengths below WINDOW
    mine = items.select(F.col("id").alias("item"), F.col("mark").alias("item_mark"), F.col("n").alias("n_windows"), F.col("pos").alias("item_pos"), F.col("hash").alias("h"), F.col("slots").alias("old"))
    found = windows(_keyed(docs, doc_id), wanted, short).select(F.col("id").alias("doc"), F.col("mark").alias("doc_mark"), "pos", "hash", F.col("slots").alias("new")).distinct()
    hits = found.join(mine, F.col("hash") == F.col("h")).drop("hash", "h")
    pairs = hits.groupBy("doc", "doc_mark", "item", "item_mark").agg(F.max("n_windows").alias("n_windows"), F.collect_list(F.struct("pos", "item_pos", "old", "new")).alias("hits"))
    # The most that can come out, before anything is judged.
    positions = F.size(F.array_distinct("hits.item_pos"))
    enough = (positions / F.col("n_windows") >= cover) | (positions > RUN - WINDOW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [[(h["pos"], h["item_pos"], h["old"], h["new"]) for h in row.as_py()] for row in batch.column(4)]
            best, longest = ([f(x) for x in hits] for f in (matched, passage))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(best, pa.int64()), pa.array(longest, pa.int64())], names=[*batch.schema.names[:4], "n_matched", "passage"])

    judged = pairs.filter(enough).select("doc", "doc_mark", "item", "n_windows", "hits").mapInArrow(run, "doc long, doc_mark long, item long, n_windows int, n_matched long, passage long")
    share = F.col("n_matched") / F.col("n_windows")
    return judged.filter((share >= cover) | (F.col("passage") >= RUN)).select(F.col("doc").alias("doc_id"), "doc_mark", F.col("item").alias("item_id"), F.col("n_windows").cast("long"), "n_matched", share.alias("coverage"))


Hit = tuple[int, int, list[str], list[str]]


def _rule(hits: list[Hit]) -> dict[str, str]:
    """Each value's most frequent filling, ties to the least."""
    votes: dict[str, dict[str, int]] = {}
    for _, _, old, new in hits:
        for a, b in zip(old, new):
            of = votes.setdefault(a, {})
            of[b] = of.get(b, 0) + 1
    return {a: min(of, key=lambda b: (-of[b], b)) for a, of in votes.items()}


def _fitting(hits: list[Hit]) -> list[Hit]:
    """Hits whose fillings agree with the one mapping of all of them."""
    rule = _rule(hits)
    return [h for h in hits if all(rule[a] == b for a, b in zip(h[2], h[3]))]


def occurrences(hits: list[Hit]) -> Iterator[list[Hit]]:
    """Hits of one alignment (place in the text minus place in the item), and those of alignments close together."""
    by_shift: dict[int, list[Hit]] = {}
    for h in hits:
        by_shift.setdefault(h[0] - h[1], []).append(h)
    near: list[list[Hit]] = []
    last = None
    for shift in sorted(by_shift):
        yield by_shift[shift]
        if last is None or shift - last > GAP:
            near.append([])
        near[-1].extend(by_shift[shift])
        last = shift
    yield from near


def matched(hits: list[Hit]) -> int:
    """How many windows of an item a text holds under the best mapping: that of one occurrence, of all, or identity."""
    fixed = {h[1] for h in hits if not h[2]}
    filled = [h for h in hits if h[2]]
    sets = [{h[1] for h in filled if h[2] == h[3]}, {h[1] for h in _fitting(filled)}]
    sets += [{h[1] for h in _fitting(near)} for near in occurrences(filled)]
    return len(fixed) + max(len(found - fixed) for found in sets)


def passage(hits: list[Hit]) -> int:
    """Tokens of the longest passage that text and item share: windows in a row at one alignment.

    Unchanged windows count, and those under the alignment's one mapping that hold a plain
    word (numbers in a row fit anything).
    """
    by_shift: dict[int, list[Hit]] = {}
    for h in hits:
        by_shift.setdefault(h[0] - h[1], []).append(h)
    longest = 0
    for near in by_shift.values():
        if len(near) <= longest:
            continue
        run, last = 0, None
        for at in sorted({h[1] for h in near if h[2] == h[3]} | {h[1] for h in _fitting(near) if len(h[2]) < WINDOW}):
            run = run + 1 if last is not None and at == last + 1 else 1
            longest, last = max(longest, run), at
    return longest + WINDOW - 1 if longest else 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """``docs`` without those that hold an item; rows with a null text stay."""
    bad = leaks(docs, benchmark, cover).select(F.col("doc_id").alias("_doc"), F.col("doc_mark").alias("_of")).distinct()

    def clean(rows: DataFrame) -> DataFrame:
        marked = rows.withColumn("_mark", F.xxhash64("text"))
        return marked.join(bad, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_mark") == F.col("_of")), "left_anti")

    return sheltered(docs, ("doc_id", "text"), (), clean)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return leaks(docs.select("doc_id", "text"), benchmark.select("item_id", "text")).select("doc_id", "item_id", "n_windows", "n_matched", "coverage")


def register(queries: dict, oracles: dict) -> None:
    queries["op8_decontamination"] = op8_decontamination
