"""LM scoring by cross-entropy difference: how much better a target model reads a text than the background.

Both models are interpolated bigram models of one form over one vocabulary. Words and
bigrams are counted over all documents (background) and over all documents labelled good
(target), and every counted one is kept, however rare. Texts are cut into blocks. A block
sends each of its distinct bigrams and words once, as sorted 64-bit hashes dealt
to parts by their leading bits; a part sums the counts of all blocks and answers each block
in the order it asked, and the block's texts are scored beside them. So nothing that grows
with the input is held in one place, and what moves is a few bytes per distinct bigram of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import kept, table, with_ids
from tidemark.llm.language_id import held_out

#: Weight of the lower order, in observations.
BACKOFF = 20.0
#: Words a task remembers; bounds memory, not the counts.
HELD = 1 << 18
#: Bytes of text in a block, and per part of the keys.
BLOCK = 6 << 20
#: Stand in place of a word's hash: the start of a text, and a word outside the vocabulary.
START, UNKNOWN = np.uint64(0), np.uint64(1)
#: Kinds of keys; each has parts of its own.
PAIR, WORD = range(2)
NEW = ("n_tokens", "loss_background", "loss_target", "score")
#: Numbers of a key on both sides: of the bigram or word, and of the word as history of a bigram that counts.
NUMBERS = ("n0", "n1", "seen0", "seen1")
COUNTS = f"part int, block long, size int, keys binary, {', '.join(f'{c} binary' for c in NUMBERS)}"


class Hashes(dict):
    """Raw word to its hash."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < HELD:
            self[word] = h
        return h

    def tokens(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens per text; history and word of every token."""
        split = [np.fromiter(map(self.__getitem__, t.split()), np.uint64) for t in (t or b"" for t in texts)]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        word = np.concatenate([np.empty(0, np.uint64), *split])
        before = np.empty_like(word)
        before[1:] = word[:-1]
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        before[starts[sizes > 0]] = START
        return sizes, before, word


class Cuts(NamedTuple):
    """What a pruned model keeps: hashes of words, keys of bigrams; None keeps all."""

    words: np.ndarray | None = None
    pairs: np.ndarray | None = None

    def folded(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words outside the vocabulary become ``UNKNOWN``."""
        if self.words is None:
            return before, word
        return np.where(np.isin(before, self.words) | (before == START), before, UNKNOWN), np.where(np.isin(word, self.words), word, UNKNOWN)


class Models(NamedTuple):
    """Background and target model over the same words and bigrams; 0 is the background, 1 the target."""

    counts: DataFrame  # COUNTS, block null: a part's keys and their numbers
    parts: int
    cuts: Cuts


def _mixed(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _packed(n: np.ndarray) -> bytes:
    """Numbers in as many bytes each as the largest needs, all first bytes first, so that like bytes lie together; nothing where all are 0."""
    width = (int(n.max()).bit_length() + 7) // 8 if len(n) else 0
    return bytes([width]) + pa.compress(n.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), "zstd", asbytes=True) if width else b""


def _unpacked(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    if data:
        out[:, : data[0]] = np.frombuffer(pa.decompress(data[1:], data[0] * size, "zstd"), np.uint8).reshape(-1, size).T
    return out.view("<u8").ravel()


def _bits(kind: int, parts: int) -> int:
    """Leading bits of a key that say its part; words are far fewer than bigrams."""
    return parts.bit_length() - 1 - 3 * (kind != PAIR)


def _first(kind: int, parts: int) -> int:
    """Number of the first part of a kind."""
    return sum(1 << _bits(k, parts) for k in range(kind))


def _lows(kind: int, parts: int) -> np.ndarray:
    """Least key of each part."""
    bits = _bits(kind, parts)
    return np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)


def _table(rows: list[tuple], **more: pa.DataType) -> pa.Table:
    types = {"part": pa.int32(), "block": pa.int64(), "size": pa.int32(), "keys": pa.binary(), **dict.fromkeys(NUMBERS, pa.binary()), **more}
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types.values())], names=list(types))


def _sent(before: np.ndarray, word: np.ndarray, parts: int, cuts: Cuts, block: int | None, side: int | None) -> Iterator[pa.RecordBatch]:
    """The distinct keys of one block's tokens by part, as steps from key to key, with their numbers on a side (None: not counted)."""
    before, word = cuts.folded(before, word)
    pair, some = _mixed(before, word), slice(None)
    if cuts.pairs is not None and side is not None:
        some = np.isin(pair, cuts.pairs)
    pairs, n_pairs = np.unique(pair[some], return_counts=True)
    words, at = np.unique(np.concatenate([word, before]), return_inverse=True)
    n_words, seen = np.bincount(at[: len(word)], minlength=len(words)), np.bincount(at[len(word) :][some], minlength=len(words))
    rows = []
    for kind, keys, n, h in ((PAIR, pairs, n_pairs, n_pairs * 0), (WORD, words, n_words, seen)):
        lows = _lows(kind, parts)
        starts = np.append(np.searchsorted(keys, lows), len(keys))
        for p in np.flatnonzero(np.diff(starts)):
            own = slice(starts[p], starts[p + 1])
            numbers = [_packed(x[own]) if side == k else b"" for x in (n, h) for k in range(2)]
            rows.append((_first(kind, parts) + int(p), block, int(own.stop - own.start), _packed(np.diff(keys[own], prepend=lows[p])), *numbers))
    yield from _table(rows).to_batches()


def _cut(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.Table]:
    """The rows in blocks of about ``BLOCK`` bytes of text, at least one row each."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + BLOCK - size, "right")))
            held.append(batch.slice(at, stop - at))
            size += ends[stop - 1] - before
            if size >= BLOCK or stop < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            at = stop
    if held:
        yield pa.Table.from_batches(held)


def _texts(rows: pa.Table, text: int) -> list[bytes | None]:
    return rows.column(text).cast(pa.binary()).to_pylist()


def _blocks(docs: DataFrame, text: int) -> DataFrame:
    """Rows of ``docs`` in numbered blocks: ``block, bytes`` (of text) and the rows, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, rows in enumerate(_cut(batches, text)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows)
            size = pc.sum(pc.binary_length(rows.column(text))).as_py() or 0
            yield pa.RecordBatch.from_arrays([pa.array([(TaskContext.get().partitionId() << 32) + i], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "bytes", "rows"])

    return docs.mapInArrow(run, "block long, bytes long, rows binary")


def _rows(packed: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(packed.as_buffer()).read_all()


def _asked(blocks: DataFrame, text: int, parts: int, cuts: Cuts, side: int | None) -> DataFrame:
    """The keys of every block, to be answered, and counted on a side if one is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("rows")):
                _, before, word = hashes.tokens(_texts(_rows(packed), text))
                yield from _sent(before, word, parts, cuts, block, side)

    return blocks.mapInArrow(run, COUNTS)


def _counted(texts: DataFrame, side: int, parts: int, cuts: Cuts) -> DataFrame:
    """The keys of ``texts(text)``, counted on one side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for rows in _cut(batches, 0):
            _, before, word = hashes.tokens(_texts(rows, 0))
            yield from _sent(before, word, parts, cuts, None, side)

    return texts.mapInArrow(run, COUNTS)


def _summed(counts: DataFrame, parts: int, keep: bool) -> DataFrame:
    """Answers to the blocks that asked, with the numbers in the order of their keys; per part, its totals (and with ``keep`` its keys)."""

    def run(group: pa.Table) -> pa.Table:
        part, sizes = group["part"][0].as_py(), group["size"].to_pylist()
        kind = max(k for k in (PAIR, WORD) if _first(k, parts) <= part)
        low = _lows(kind, parts)[part - _first(kind, parts)]
        keys = np.concatenate([np.cumsum(_unpacked(d, s)) + low for d, s in zip(group["keys"].to_pylist(), sizes)])
        distinct, at = np.unique(keys, return_inverse=True)
        n = [np.bincount(at, np.concatenate([_unpacked(d, s) for d, s in zip(group[c].to_pylist(), sizes)]), len(distinct)).astype(np.uint64) for c in NUMBERS]
        words, totals = 0, (0, 0)
        if kind == WORD:
            words, totals = int(np.count_nonzero((n[0] > 0) & (distinct != UNKNOWN))), tuple(int(x.sum()) for x in n[:2])
        rows = [(part, None, len(distinct), _packed(np.diff(distinct, prepend=low)), *map(_packed, n), words, *totals) if keep else (part, None, 0, *[b""] * 5, words, *totals)]
        rows += [(part, b, s, b"", *[_packed(x[at[e - s : e]]) for x in n], 0, 0, 0) for b, s, e in zip(group["block"].to_pylist(), sizes, np.cumsum(sizes)) if b is not None]
        return _table(rows, words=pa.int64(), total0=pa.int64(), total1=pa.int64())

    return kept(counts.groupBy("part").applyInArrow(run, f"{COUNTS}, words long, total0 long, total1 long"))


def _parts(size: int | None) -> int:
    """A power of two that grows with the bytes of text."""
    return 1 << max(4, ((size or 0) // BLOCK).bit_length())


def _frequent(counts: DataFrame, kind: int, share: float, parts: int) -> np.ndarray:
    """Keys of a kind with at least that share of the background's tokens; at most one over ``share``."""
    least = max(1.0, share * (counts.agg(F.sum("total0")).first()[0] or 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = _lows(kind, parts)
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.cumsum(_unpacked(row["keys"], row["size"])) + lows[row["part"] - _first(kind, parts)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[_unpacked(row["n0"], row["size"]) >= least].view(np.int64))], names=["key"])

    rows = counts.filter(F.col("part").between(_first(kind, parts), _first(kind + 1, parts) - 1)).mapInArrow(run, "key long").collect()
    return np.array(sorted(r.key for r in rows), np.int64).view(np.uint64)


def fit(docs: DataFrame, target: DataFrame, word_share: float = 0.0, pair_share: float = 0.0) -> Models:
    """Models from the texts of ``docs`` (background) and of ``target``, which are among them; counts cover all rows of both.

    Every word and bigram of ``docs`` is kept. Shares above 0 also drop those with less than
    that share of its tokens; dropped words count as one unknown word, and dropped bigrams go
    to the lower order in both models alike. What a share leaves, at most one over it, is
    sent to the tasks.
    """
    sides = [side.select(F.col("text").cast("binary").alias("text")) for side in (docs, target)]
    parts, cuts = _parts(sides[0].agg(F.sum(F.length("text"))).first()[0]), Cuts()
    count = lambda: _summed(_counted(sides[0], 0, parts, cuts).union(_counted(sides[1], 1, parts, cuts)), parts, True)
    counts = count()
    for name, kind, share in (("words", WORD, word_share), ("pairs", PAIR, pair_share)):
        if share > 0:
            cuts = cuts._replace(**{name: _frequent(counts, kind, share, parts)})
            counts = count()
    return Models(counts.drop("words", "total0", "total1"), parts, cuts)


def score(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens, loss_background, loss_target, score``.

    Losses are means per token; ``score`` is background minus target, so higher reads more
    like the target. Null and empty texts have 0 tokens and null losses and score. Texts are
    read whole; equal texts score alike. Columns of those names are replaced.
    """
    return _scored(docs, text, lambda blocks, at: (_asked(blocks, at, models.parts, models.cuts, None).union(models.counts), models.parts, models.cuts))


def score_within(docs: DataFrame, target: DataFrame, text: str = "text") -> DataFrame:
    """``score(docs, fit(docs, target))`` with the keys of ``docs`` sent once, to be counted and answered."""

    def counts(blocks: DataFrame, at: int) -> tuple[DataFrame, int, Cuts]:
        parts = _parts(blocks.agg(F.sum("bytes")).first()[0])
        good = target.select(F.col(text).cast("binary").alias("text"))
        return _asked(blocks, at, parts, Cuts(), 0).union(_counted(good, 1, parts, Cuts())), parts, Cuts()

    return _scored(docs, text, counts)


def _scored(docs: DataFrame, text: str, counts: Callable[[DataFrame, int], tuple[DataFrame, int, Cuts]]) -> DataFrame:
    columns = [c for c in docs.columns if c not in NEW]
    names = list(dict.fromkeys([*columns, text]))
    carried, at = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]), names.index(text)
    blocks = kept(_blocks(carried, at))
    rows, parts, cuts = counts(blocks, at)
    answers = _summed(rows, parts, False)
    some = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "total0", "total1")]).first()
    size, totals = some[0] + 1, some[1:]

    def run(block: pa.Table, said: pa.Table) -> pa.Table:
        rows = _rows(block["rows"][0])
        sizes, before, word = Hashes().tokens(_texts(rows, at))
        said = said.sort_by("part")
        said = [said.filter(pc.field("part") < _first(WORD, parts)), said.filter(pc.field("part") >= _first(WORD, parts))]
        number = lambda kind, c: np.concatenate([np.empty(0), *[_unpacked(d, s) for d, s in zip(said[kind][c].to_pylist(), said[kind]["size"].to_pylist())]])
        before, word = cuts.folded(before, word)
        pair = np.unique(_mixed(before, word), return_inverse=True)[1]
        word, before = np.split(np.unique(np.concatenate([word, before]), return_inverse=True)[1], 2)
        some = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[some]
        means = []
        for k in range(2):
            base = (number(WORD, f"n{k}")[word] + 0.5) / (totals[k] + 0.5 * size)
            loss = -np.log((number(PAIR, f"n{k}")[pair] + BACKOFF * base) / (number(WORD, f"seen{k}")[before] + BACKOFF))
            means.append(np.zeros(len(sizes)))
            if len(starts):
                means[k][some] = np.add.reduceat(loss, starts) / sizes[some]
        out = rows.select(range(len(columns))).append_column(NEW[0], pa.array(sizes))
        for name, values in zip(NEW[1:], (*means, means[0] - means[1])):
            out = out.append_column(name, pa.array(values, mask=~some))
        return out

    schema = T.StructType([*carried.schema.fields[: len(columns)], T.StructField(NEW[0], T.LongType()), *[T.StructField(c, T.DoubleType()) for c in NEW[1:]]])
    return blocks.groupBy("block").cogroup(answers.filter("block IS NOT NULL").groupBy("block")).applyInArrow(run, schema).toDF(*columns, *NEW)


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored; the target is the good documents of the training folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    good = table(spark, folder, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    target = with_ids(docs, good.filter(~held_out("doc_id")), "doc_id")
    said = score_within(docs, target)
    return said.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "loss_background", "loss_target", "score")


def register(queries: dict, oracles: dict) -> None:
    queries["op6_lm_scoring"] = op6_lm_scoring
