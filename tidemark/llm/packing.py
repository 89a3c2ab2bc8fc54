"""Best-fit packing: token pieces of documents go to sequences of a fixed length by bulk-synchronous best fit.

1. Every document becomes token ids with an end mark; only longer ones are cut. Pieces that
   fill a sequence are done. The others and the sequences with room left ("gaps") are rows
   ``(id, size)`` without any token.
2. A round sorts documents and gaps together by range, largest first, equal sizes spread by
   a hash. Each partition sweeps its rows: a document takes the smallest gap that holds it
   (its successor), and what is left of the gap is offered again.
3. Documents without a gap in their partition compete for the gaps that partitions before
   them left over. Rank decides: the nearest gap not yet taken, one document a gap. Only two
   counts per partition are needed to tell which rank meets which.
4. Gaps are updated and the round repeats. Documents that found nothing and are too large
   for any other way may open a sequence in the next round, largest class first, so smaller
   ones fill what large ones leave. The classes are fixed by the capacity, and so is the
   number of rounds, about ``log2(capacity)``, whatever the input.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Words whose ids a task remembers; bounds memory.
HELD = 1 << 18
#: Sizes up to this share of the capacity are packed in one last round.
SMALL = 1 / 16


def _classes() -> tuple[str, re.Pattern, re.Pattern]:
    """Patterns over characters whose class every Unicode version agrees on: the split before merges, and "nothing else"."""
    plain = [chr(c) for c in (*range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028), 0x20AC)]
    of = lambda kind: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind)
    letter, number = of("L"), of("N")
    # Fixed value: the split of byte-level BPE; blanks here are \t \n \r and space, as the texts hold no others.
    split = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^\t\n\r {letter}{number}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
    return re.compile(split), re.compile("[\t\n\r" + "".join(map(re.escape, plain)) + "]*")


class Encoder:
    """Texts to token ids as bytes (unsigned 32 bit, little-endian), equal to the tokenizer's own ids.

    Texts of common letters are split into words first, and a word's ids are remembered; texts
    with any other character go to the tokenizer whole. ``ranks`` is the same vocabulary as
    merge ranks, which is quicker for single words; without it the tokenizer does these too.
    """

    def __init__(self, tokenizer: str, ranks: str | None, held: int = HELD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.split, self.common = _classes()
        self.words: dict[str, bytes] = {}
        self.held = held
        self.ranked = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=merges, special_tokens={})

    def raw(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = np.asarray(self.ranked.encode_ordinary(word), "<u4").tobytes() if self.ranked and len(word) < 100 else self.raw(word)
            if len(self.words) < self.held:
                self.words[word] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        # A special token's string is the tokenizer's business.
        if "<|" in text or not self.common.fullmatch(text):
            return self.raw(text)
        words = self.split.findall(text)
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            return b"".join(map(self.word, words))


@functools.lru_cache(maxsize=1)
def encoder(tokenizer: str | None = None) -> Encoder:
    """One per worker process. ``tokenizer``: a path, or a name of the installed public tokenizers."""
    import public_tokenizers

    if tokenizer and os.path.isabs(tokenizer):
        return Encoder(tokenizer, None)
    name = tokenizer or TOKENIZER
    ranks = public_tokenizers.path(name.removesuffix(".json") + ".tiktoken")
    return Encoder(public_tokenizers.path(name), ranks if os.path.exists(ranks) else None)


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document, with ``ids`` (bytes, 4 a token) where asked for.

    A document is its text's ids and the end id (a null text: the end id only). One longer than
    ``capacity`` is cut from its end into whole pieces, so only its first piece may be shorter.
    """
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            at, piece, start, length, crc, held = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                tokens = encode(text.as_py()) + end
                n = len(tokens) // 4
                first = n % capacity or capacity
                for k, begin in enumerate([0, *range(first, n, capacity)]):
                    stop = first if k == 0 else begin + capacity
                    part = tokens[4 * begin : 4 * stop]
                    at.append(i), piece.append(k), start.append(begin), length.append(stop - begin), crc.append(zlib.crc32(part))
                    held.append(part if ids else None)
            columns = [batch.column(0).take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(held, pa.binary())] if ids else [])], names=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


#: What a sweep says of a row: placed; a document, or a gap, left over; a gap too small for what follows; a partition's two counts.
PLACED, DOCUMENT, GAP, SMALLER, COUNTS = range(5)
SWEPT = "kind byte, id long, size int, seq long, free int, part int, at long"


def _sweep(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """One partition of documents and gaps, largest first, by best fit: see ``SWEPT``.

    Gaps are kept by free size, with a bit per size that has any: the lowest set bit from a
    document's size on is its successor.
    """
    part = TaskContext.get().partitionId()
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]
    sizes, waiting, out = 0, [], ([], [], [], [])  # document, its size, sequence, free before
    least = 0
    for batch in batches:
        for row, size, is_document, may_open in zip(*(batch.column(i).to_pylist() for i in range(4))):
            least = size
            if not is_document:
                gaps[size].append(row)
                sizes |= 1 << size
                continue
            fitting = sizes >> size
            if fitting:
                free = size + (fitting & -fitting).bit_length() - 1
                seq = gaps[free].pop()
                if not gaps[free]:
                    sizes ^= 1 << free
            elif may_open:  # a sequence is named after the document that opens it
                seq, free = row, capacity
            else:
                waiting.append((row, size))
                continue
            for column, value in zip(out, (row, size, seq, free)):
                column.append(value)
            if free > size:
                gaps[free - size].append(seq)
                sizes |= 1 << (free - size)

    def rows(kind: int, id: list, size: list, seq: list, free: list, at: list) -> pa.RecordBatch:
        n = len(seq)
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n, pa.int8()), pa.array(id, pa.int64()), pa.array(size, pa.int32()), pa.array(seq, pa.int64()), pa.array(free, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(at, pa.int64())],
            names=["kind", "id", "size", "seq", "free", "part", "at"],
        )

    yield rows(PLACED, out[0], out[1], out[2], out[3], [None] * len(out[0]))
    blank = [None] * len(waiting)
    yield rows(DOCUMENT, [w[0] for w in waiting], [w[1] for w in waiting], blank, blank, range(len(waiting)))
    left = [(free, seq) for free in range(max(least, 1), capacity + 1) for seq in gaps[free]]  # smallest first: the next to be taken
    blank = [None] * len(left)
    yield rows(GAP, blank, blank, [s for _, s in left], [f for f, _ in left], range(len(left)))
    small = [(free, seq) for free in range(1, max(least, 1)) for seq in gaps[free]]
    blank = [None] * len(small)
    yield rows(SMALLER, blank, blank, [s for _, s in small], [f for f, _ in small], blank)
    yield rows(COUNTS, [len(waiting)], [None], [len(left)], [None], [None])


def _meetings(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which left-over documents meet which left-over gaps: ``(part, from, to, gap part, shift)``.

    ``counts``: partition, documents, gaps, in the order of sizes. Gaps lie on a stack, the
    last partition's on top; each partition's documents take from it by rank.
    """
    stack: list[list[int]] = []
    out = []
    for part, documents, gaps in sorted(counts):
        at = 0
        while at < documents and stack:
            owner, begin, end = stack[-1]
            n = min(documents - at, end - begin)
            out.append((part, at, at + n, owner, begin - at))
            at += n
            stack[-1][1] += n
            if stack[-1][1] == end:
                stack.pop()
        if gaps:
            stack.append([part, 0, gaps])
    return out


def _next_class(largest: int, capacity: int) -> int:
    """Documents above this size may open sequences, given the largest one without a place."""
    if largest <= capacity * SMALL:
        return 0
    fits = capacity // largest
    return min(capacity // (fits + 1), int(largest * (0.7 if largest * 8 > capacity else 0.5)))


def assign(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(id, seq, offset)`` of every row of ``sizes(id long, size int)``; sizes from 1 to ``capacity``, ids unique.

    Ties in size are ordered by a hash of the id. Every round's rows are tables in the shared
    folder, so a lost executor costs its tasks only. Without rows the result is empty.
    """
    spark = sizes.sparkSession
    documents = sizes.select("id", F.col("size").cast("int").alias("size")).withColumn("may_open", F.col("size") * 2 > capacity)
    gaps = None
    placed = []
    while True:
        rows = documents.select("id", "size", F.lit(True).alias("document"), "may_open")
        if gaps is not None:
            rows = rows.union(gaps.select("seq", "free", F.lit(False), F.lit(False)))
        order = [F.col("size").desc(), F.col("document"), F.xxhash64("id"), F.col("id")]
        swept = kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lambda b: _sweep(b, capacity), SWEPT))
        counts = swept.filter(F.col("kind") == COUNTS).select("part", "id", "seq").collect()  # one row a partition
        meetings = spark.createDataFrame(_meetings([tuple(r) for r in counts]), "part int, low long, high long, owner int, shift long")
        # At most two rows a partition, whatever the input.
        waiting = swept.filter(F.col("kind") == DOCUMENT).select("id", "size", "part", "at").alias("d").join(
            F.broadcast(meetings).alias("m"), F.expr("d.part = m.part AND d.at >= m.low AND d.at < m.high"), "left"
        ).select("id", "size", F.coalesce("owner", -1 - F.col("d.part")).alias("owner"), F.coalesce(F.col("d.at") + F.col("shift"), F.col("d.at")).alias("rank"))
        free = swept.filter(F.col("kind") == GAP).select("seq", "free", F.col("part").alias("_part"), F.col("at").alias("_at"))
        met = kept(waiting.join(free, (F.col("owner") == F.col("_part")) & (F.col("rank") == F.col("_at")), "full_outer").select("id", "size", "seq", "free"))
        both = F.col("id").isNotNull() & F.col("seq").isNotNull()
        placed += [t.select("id", "seq", (capacity - F.col("free")).cast("long").alias("offset")) for t in (swept.filter(F.col("kind") == PLACED), met.filter(both))]
        open_ = met.filter("seq IS NULL").select("id", "size")
        least, most = open_.agg(F.min("size"), F.max("size")).first()
        if most is None:
            break
        documents = open_.withColumn("may_open", F.col("size") > _next_class(most, capacity))
        smaller = swept.filter(F.col("kind") == SMALLER).select("seq", "free")
        gaps = met.filter("seq IS NOT NULL").select("seq", (F.col("free") - F.coalesce("size", F.lit(0))).alias("free")).union(smaller).filter(F.col("free") >= least)
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """Every document's pieces with ``sequence_id`` and ``offset``, the place of the piece in its sequence.

    Columns: see ``pieces``; sequences are filled from 0 without holes. Nulls, empty texts and
    repeated rows are documents of their own; very long texts are many pieces; without rows
    there are none. Only ``doc_id`` and ``text`` of the input are read, so other columns, however
    named, don't matter. ``tokenizer`` is a path, or a name of the installed public tokenizers.
    """
    # Numbers of rows are fixed by writing them.
    cut = kept(pieces(docs, capacity, end_id, tokenizer, ids).withColumn("_piece_no", F.monotonically_increasing_id()))
    parts = assign(cut.filter(F.col("length") < capacity).select(F.col("_piece_no").alias("id"), F.col("length").alias("size")), capacity)
    whole = cut.filter(F.col("length") == capacity).withColumns({"sequence_id": F.col("_piece_no"), "offset": F.lit(0).cast("long")})
    some = cut.filter(F.col("length") < capacity).join(parts.hint("merge"), F.col("_piece_no") == F.col("id")).drop("id").withColumnRenamed("seq", "sequence_id")
    return whole.unionByName(some).drop("_piece_no")


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    rows = pack(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def register(queries: dict, oracles: dict) -> None:
    queries["op11_packing"] = op11_packing
