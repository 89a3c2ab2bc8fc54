"""Matching of assets: two-hash consensus, tiers, preferences and key resolution."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.hashing import hamming
from tidemark.operators.bits import KeyBits
from tidemark.operators.ordered import numbered
from tidemark.operators.quantiles import exact_percentiles
from tidemark.session import cut_lineage

ACCEPT, REVIEW = 8, 14
# Fixed value: preference order of source files.
SOURCE_EXTS = (".png", ".webp", ".jpeg", ".jpg")


#: Slices of a 64-bit hash that the index is keyed by, and bits that a probe may flip in each, round by round.
SLICES, FLIPS = 5, (0, 1)
#: Hash pairs on either side of a block that is compared whole.
BLOCK = 4096


def _cuts() -> list[tuple[int, int]]:
    """(offset, width) of nearly equal slices of 64 bits."""
    edges = [round(64 * i / SLICES) for i in range(SLICES + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _variants(h: np.ndarray, offset: int, width: int, flips: int) -> np.ndarray:
    """A slice of every hash, with every way to flip at most ``flips`` of its bits."""
    masks = [sum(1 << i for i in bits) for k in range(flips + 1) for bits in combinations(range(width), k)]
    part = (h.view(np.uint64) >> np.uint64(offset)).astype(np.int64) & ((1 << width) - 1)
    return part[:, None] ^ np.array(masks, np.int64)


def slice_index(rows: DataFrame, p: str, d: str, flips: int = 0, known: KeyBits | None = None) -> DataFrame:
    """Rows with ``_key``: one for every slice of one hash with a slice of the other, and for every way to flip bits in the two.

    With both hashes in the key, rows that agree in one of them only don't meet. Keys that
    ``known`` rules out are not made into rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[_variants(batch.column(h).to_numpy(), o, w, flips) for o, w in _cuts()] for h in (p, d)]
            for i, x in enumerate(sides[0]):
                for j, y in enumerate(sides[1]):
                    key = (((i * SLICES + j) << 32) | (x[:, :, None] << 16) | y[:, None, :]).reshape(len(x), -1)
                    at, key = np.repeat(np.arange(len(key)), key.shape[1]), key.ravel()
                    if known is not None:
                        use = known.has(key)
                        at, key = at[use], key[use]
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, pa.array(key)], names=[*batch.schema.names, "_key"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("_key", LongType())]))


def merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the assets: sorted and merged, neither gathered in the driver.

    Spark's estimates don't see how many rows a task makes of one, so it would take thousands
    of probes an asset for a table small enough to broadcast.
    """
    return left.join(right.hint("merge"), on, how)


def _best(rows: DataFrame) -> DataFrame:
    """Per target hash pair the nearest partner: by the worse distance, then by order."""
    best = F.min(F.struct(F.greatest("p", "d").alias("worst"), "ord", "path", "p", "d"))
    return rows.groupBy("tp", "td").agg(best.alias("m")).select("tp", "td", "m.*")


def compared_whole(targets: DataFrame, corpus: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nearest partner per target by comparing all, in blocks: a grid whose cells hold some ``block`` rows of either side.

    Every row goes to one line of the grid and meets all of the other side there, so tasks are
    alike whatever the hashes are.
    """
    across, down = (-(-df.count() // block) or 1 for df in (targets, corpus))
    t = targets.select("tp", "td", F.pmod(F.xxhash64("tp", "td"), F.lit(across)).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("j"))
    c = corpus.select("cp", "cd", "ord", F.pmod(F.xxhash64("cp", "cd"), F.lit(down)).cast("int").alias("j"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("i"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        tp, td = (left.column(k).to_numpy().view(np.uint64) for k in ("tp", "td"))  # counting bits of a negative number would count those of its size
        order = np.argsort(right.column("ord").to_numpy(), kind="stable")
        cp, cd = (right.column(k).to_numpy()[order].view(np.uint64) for k in ("cp", "cd"))
        at = np.zeros(len(tp), np.int64)
        if len(cp):
            for k in range(len(tp)):  # the first of the nearest has the least order
                at[k] = np.maximum(np.bitwise_count(cp ^ tp[k]), np.bitwise_count(cd ^ td[k])).argmin()
        else:
            tp, td, at = tp[:0], td[:0], at[:0]
        return pa.table({k: v.view(np.int64) for k, v in (("tp", tp), ("td", td), ("cp", cp[at]), ("cd", cd[at]))})

    near = t.groupBy("i", "j").cogroup(c.groupBy("i", "j")).applyInArrow(cell, "tp long, td long, cp long, cd long")
    named = merged(near, corpus, ["cp", "cd"])
    return _best(named.select("tp", "td", "ord", "path", hamming("tp", "cp").alias("p"), hamming("td", "cd").alias("d")))


def nearest(targets: DataFrame, corpus: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nearest corpus row per target by the worse of two distances; exact, at any distance.

    The radius widens. If both hashes of a pair differ in less than ``SLICES * (f + 1)`` bits,
    a slice of each differs in at most ``f``, so probes that flip up to f bits in either find
    the pair in one index. A target is done once its best is below that bound: whatever is
    unseen lies farther. What no probe finishes is compared with all, in blocks.
    Inputs: tp, td | cp, cd, ord, path, one row per distinct hash pair.
    """
    index = slice_index(corpus, "cp", "cd")
    known = KeyBits(index, "_key")
    done, rest = None, targets
    spread = targets.sparkSession.sparkContext.defaultParallelism
    for flips in FLIPS:
        # A few small rows turn into thousands of probes each: keep every core on them.
        probes = slice_index(rest.repartition(spread, "tp", "td"), "tp", "td", flips, known)
        met = merged(probes, index, "_key").select("tp", "td", "ord", "path", hamming("tp", "cp").alias("p"), hamming("td", "cd").alias("d"))
        bound = SLICES * (flips + 1)
        found = cut_lineage(_best(met.filter((F.col("p") < bound) & (F.col("d") < bound))))
        done = found if done is None else done.unionByName(found)
        rest = cut_lineage(merged(rest, found.select("tp", "td"), ["tp", "td"], "left_anti"))
    return done.unionByName(compared_whole(rest, corpus, block))


def consensus_match(
    targets: DataFrame, corpus: DataFrame, accept: int = ACCEPT, review: int = REVIEW
) -> DataFrame:
    """Decision per target: match, review or no_match, by the worse of two distances to its nearest partner.

    ``targets``: target, phash, dhash. ``corpus``: path, phash, dhash, ord (first
    wins ties). Equal hash pairs are matched once. ``p`` and ``d`` are evidence for every
    decision, null only without a corpus; a ``no_match`` names no source.
    """
    c = corpus.groupBy(F.col("phash").alias("cp"), F.col("dhash").alias("cd")).agg(
        F.min("ord").alias("ord"), F.min_by("path", "ord").alias("path")
    )
    c = cut_lineage(c.filter("cp IS NOT NULL AND cd IS NOT NULL"))
    t = targets.select(F.col("phash").alias("tp"), F.col("dhash").alias("td")).filter("tp IS NOT NULL AND td IS NOT NULL").distinct()
    found = nearest(cut_lineage(t), c)
    decision = F.when(F.col("worst") <= accept, "match").when(F.col("worst") <= review, "review").otherwise("no_match")
    joined = merged(targets, found, (F.col("phash") == F.col("tp")) & (F.col("dhash") == F.col("td")), "left")
    source = F.when(F.col("worst") <= review, F.col("path"))
    return joined.select("target", decision.alias("decision"), source.alias("source"), "p", "d")


def waterfall(attempts: DataFrame) -> DataFrame:
    """First tier that succeeds wins; every decision up to it is kept, in order.

    ``attempts``: target, tier, decision, ok, source. There is one row per
    target and tier, so the kept list is as short as the list of tiers.
    """
    g = attempts.groupBy("target").agg(
        F.min(F.when(F.col("ok"), F.col("tier"))).alias("tier"),
        F.array_sort(F.collect_list(F.struct("tier", "decision", "source"))).alias("all"),
    )
    kept = F.filter("all", lambda x: x["tier"] <= F.col("tier"))
    return g.select(
        "target",
        "tier",
        F.element_at(kept, -1)["source"].alias("source"),
        F.array_join(F.transform(kept, lambda x: F.concat(F.lit("T"), x["tier"].cast("string"), F.lit(":"), x["decision"])), " ").alias("decisions"),
    )


def tally(results: DataFrame) -> DataFrame:
    """Campaign counters in one row."""
    tier = F.col("tier")
    return results.agg(
        F.count("*").alias("targets"),
        F.count_if(tier == 0).alias("matched"),
        F.count_if(tier == 1).alias("resolved"),
        F.count_if(tier == 2).alias("searched"),
        F.count_if(tier == 3).alias("queued"),
        F.count_if(F.contains("decisions", F.lit("T0:review"))).alias("review"),
    )


def overlap_report(matches: DataFrame, corpus: DataFrame) -> DataFrame:
    """Matched and flagged pairs, and what is left unmatched on either side."""
    m = F.col("decision") == "match"
    side = matches.agg(
        F.count("*").alias("n_targets"),
        F.count_if(m).alias("n_matched"),
        F.count_if(F.col("decision") == "review").alias("n_flagged"),
        F.count_if(F.col("decision") == "no_match").alias("n_targets_unmatched"),
    )
    used = matches.filter(m).select(F.col("source").alias("path"))
    other = merged(corpus, used, "path", "left_anti").agg(F.count("*").alias("n_corpus_unmatched"))
    return side.join(other)


def confirm_matches(pairs: DataFrame, structure: int = 6, grey: int = 14, content: float = 0.03) -> DataFrame:
    """Class of each pair: a match only when both distances agree."""
    s, c = F.col("structure") <= structure, F.col("content") <= content
    cls = F.when(s & c, "both").when(s, "structure_only").when(c, "content_only").otherwise("neither")
    band = F.when(s, "strong").when(F.col("structure") <= grey, "grey").otherwise("far")
    return pairs.withColumns({"class": cls, "band": band})


def band_report(confirmed: DataFrame) -> DataFrame:
    """Per distance band: size, confirmed pairs, and the spread of the content distance."""
    g = confirmed.groupBy("band").agg(
        F.count("*").alias("n"), F.count_if(F.col("class") == "both").alias("confirmed"),
        F.min("content").alias("content_min"), F.max("content").alias("content_max"),
    )
    return g.join(exact_percentiles(confirmed, ["band"], "content", {"content_median": 0.5}), "band")


def dedupe_intake(new: DataFrame, archive: DataFrame) -> DataFrame:
    """Equal content under its own slug is refused; new content gets the next free suffix.

    ``new``: seq, slug, sha. ``archive``: slug, sha. One row per new file.
    """
    first = new.groupBy("slug", "sha").agg(F.min("seq").alias("seq"))
    fresh = first.join(archive.select("slug", "sha").distinct(), ["slug", "sha"], "left_anti")
    used = archive.groupBy("slug").agg(F.count_distinct("sha").alias("_used"))
    placed = numbered(fresh, ["slug"], "seq", "_n").join(used, "slug", "left")
    k = F.col("_n") + F.coalesce("_used", F.lit(0))
    tail = F.concat(F.lit("-"), k.cast("string"))
    base = F.regexp_replace(F.substring(F.col("slug"), F.lit(1), F.lit(64) - F.length(tail)), "-+$", "")
    named = placed.select("seq", F.when(k == 1, F.col("slug")).otherwise(F.concat(base, tail)).alias("placed_as"))
    return new.join(named, "seq", "left").withColumn(
        "status", F.when(F.col("placed_as").isNull(), "refused").otherwise("accepted")
    )


def pending_targets(files: DataFrame) -> DataFrame:
    """Previews of folders that hold no recovered original yet."""
    recovered = files.filter(F.col("name").rlike("^d[0-9a-z]{6,8}-[0-9a-f]{8}-")).select("folder").distinct()
    preview = F.col("name").rlike(r"-(pre|fullview)\.[^.]*$")
    return files.filter(preview).join(recovered, "folder", "left_anti")


def select_source(files: DataFrame) -> DataFrame:
    """Best full view by extension then path if it decodes, else the initial."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^.]*)$", 1))
    rank = F.array_position(F.array(*[F.lit(e) for e in SOURCE_EXTS]), ext)
    key = F.struct(rank.alias("r"), F.lower("path").alias("l"), F.col("path").alias("path"), F.col("decodes").alias("ok"))
    full = (F.col("kind") == "fullview") & (rank > 0)
    g = files.groupBy("slug").agg(
        F.min(F.when(full, key)).alias("f"), F.min(F.when(F.col("kind") == "initial", F.col("path"))).alias("i")
    )
    use = F.coalesce(F.col("f.ok"), F.lit(False))
    return g.select(
        "slug",
        F.when(use, F.col("f.path")).otherwise(F.col("i")).alias("path"),
        F.when(use, "fullview").when(F.col("i").isNotNull(), "firstinitial").otherwise("none").alias("kind"),
    )


def pick_asset(assets: DataFrame, requests: DataFrame) -> DataFrame:
    """First asset of the wanted hand in a preferred view, else its first asset, else none.

    ``assets``: asset, hand, view (asset ids order them). ``requests``: request,
    hand, vx. Assets shrink to one row per hand before the join.
    """
    g = assets.groupBy("hand").agg(
        F.min("asset").alias("any"),
        F.min(F.when(F.col("view") == "side", F.col("asset"))).alias("side"),
        F.min(F.when(F.col("view").isin("front", "threequarter"), F.col("asset"))).alias("front"),
    )
    wanted = F.when(F.abs("vx") >= 0.5, F.col("side")).otherwise(F.col("front"))
    return requests.join(g, "hand", "left").select("request", F.coalesce(wanted, F.col("any")).alias("asset"))


def resolve_key(names: DataFrame, known: DataFrame) -> DataFrame:
    """Exact key, else the first known key with that prefix, else unresolved.

    Known keys are spelled out into their prefixes, first key per prefix, so
    resolution is one equi-join instead of a scan of all keys per name.
    """
    spelled = known.select(
        "key", "ord", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("name")
    )
    exact = F.col("name") == F.col("key")
    first = spelled.groupBy("name").agg(
        F.min_by("key", "ord").alias("_prefix"), F.max(F.when(exact, F.col("key"))).alias("_exact")
    )
    how = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_prefix").isNotNull(), "prefix").otherwise("unresolved")
    return names.join(first, "name", "left").select(
        *names.columns, F.coalesce("_exact", "_prefix").alias("key"), how.alias("how")
    )
