"""Manifests, state snapshots, triage rows and the asset inventory."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

AUDIT = "struct<gate string, verdict string, reasons array<string>, metrics map<string, double>>"
TRANSITION = (
    "struct<ts string, op string, actor string, tool string, params map<string, string>, src string, dst string, "
    f"sha256_in string, sha256_out string, note string, audit {AUDIT}>"
)
MANIFEST = (
    "schema int, slug string, original_filename string, original_sha256 string, source_url string, created_ts string, "
    f"delivered_as string, transitions array<{TRANSITION}>"
)
IMAGE = "struct<state string, substate string, stage_folder string, working_max int, last_op_ts string>"
TRIAGE = "slug string, image string, boxes array<array<double>>, conf double, mask_area_pct double, verdict string, seq long"


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per transition, ``seq`` keeping the order of the array."""
    return explode_manifests(spark.read.schema(MANIFEST).option("multiLine", True).json(path))


def explode_manifests(docs: DataFrame) -> DataFrame:
    head = ["slug", "original_filename", "original_sha256", "created_ts"]
    return docs.select(*head, F.posexplode_outer("transitions").alias("seq", "t")).select(*head, "seq", "t.*")


def snapshot_images(doc: Column) -> Column:
    """Images of a state document as (id, state): keyed by id, or listed with an id inside; junk gives none."""
    raw = F.get_json_object(doc, "$.images")
    keyed = F.map_entries(F.from_json(raw, f"map<string, {IMAGE}>"))
    listed = F.transform(
        F.from_json(raw, f"array<struct<id string, {IMAGE[7:]}>"),
        lambda x: F.struct(x["id"].alias("key"), F.struct(*[x[c].alias(c) for c in ("state", "substate", "stage_folder", "working_max", "last_op_ts")]).alias("value")),
    )
    return F.when(F.trim(raw).startswith("["), listed).otherwise(keyed)


def explode_snapshots(docs: DataFrame, doc: str, keep: list[str]) -> DataFrame:
    return docs.select(*keep, F.explode(snapshot_images(F.col(doc))).alias("e")).select(*keep, F.col("e.key").alias("id"), "e.value.*")


def read_state_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Images of snapshot files. A snapshot is one document written whole by its producer."""
    return explode_snapshots(spark.read.text(path, wholetext=True), "value", [])


def scan_assets(listing: DataFrame, cache: DataFrame, hashed: DataFrame) -> DataFrame:
    """Inventory in which only new or changed files take a fresh hash.

    ``listing``: path, mtime, size. ``cache``: path, mtime, size, sha. ``hashed``
    offers (path, sha) lazily; only the changed paths reach it. Unreadable files
    have no hash and are left out.
    """
    same = ["path", "mtime", "size"]
    hits = listing.join(cache, same).select(*same, "sha", F.lit(True).alias("cached"))
    changed = listing.join(cache.select(*same), same, "left_anti")
    fresh = changed.join(hashed, "path").filter("sha is not null").select(*same, "sha", F.lit(False).alias("cached"))
    return hits.unionByName(fresh)


def scan_changed(listing: DataFrame, cache: DataFrame, hash_changed) -> DataFrame:
    """Inventory in which the bytes of unchanged files are never looked at.

    ``listing``: path, mtime, size. ``cache``: path, mtime, size, sha. What the cache doesn't
    know as it is goes through ``hash_changed`` (rows with ``sha`` added), and nothing else
    does. Files without a hash could not be read and are left out.
    """
    same = ["path", "mtime", "size"]
    known = listing.select(*same).join(cache.select(*same, "sha", F.lit(True).alias("cached")), same, "left")
    fresh = hash_changed(known.filter("cached IS NULL").select(*same))
    return known.filter("cached").unionByName(fresh.filter("sha IS NOT NULL").select(*same, "sha", F.lit(False).alias("cached")))


#: Bytes read at a time: what hashing holds of a file, however large it is.
CHUNK = 1 << 20


def open_file(path: str):
    """A stream of the file's bytes, from any store that Arrow knows. Spark's paths are not escaped: they are taken as they are."""
    place = re.fullmatch(r"(?s)([a-z][a-z0-9+.-]*):(?://([^/]*))?(/.*)", path)
    if place is None or place.group(1) == "file":
        return LocalFileSystem().open_input_stream(place.group(3) if place else path)
    store, root = FileSystem.from_uri(f"{place.group(1)}://{place.group(2) or ''}/")
    return store.open_input_stream(root.rstrip("/") + place.group(3))


def hash_files(files: DataFrame, opener=open_file) -> DataFrame:
    """``files`` with ``sha``: tasks open exactly the paths they are given and hash them chunk by chunk; unreadable ones get null."""
    schema = StructType([*files.schema.fields, StructField("sha", StringType())])

    def one(path: str) -> str | None:
        try:
            digest = hashlib.sha256()
            with opener(path) as stream:
                while chunk := stream.read(CHUNK):
                    digest.update(chunk)
            return digest.hexdigest()
        except (OSError, ValueError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas = [one(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shas, pa.string())], names=[*batch.schema.names, "sha"])

    # A few paths are much work: they are dealt over all cores.
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism, "path").mapInArrow(run, schema)


def list_assets(spark: SparkSession, path: str) -> DataFrame:
    """Path, mtime and size from the file listing; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        "path", F.unix_micros("modificationTime").alias("mtime"), F.col("length").alias("size")
    )


def hash_assets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha"))


def write_triage(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def latest_triage(rows: DataFrame) -> DataFrame:
    """The last verdict row of each slug."""
    rest = [c for c in rows.columns if c != "slug"]
    return rows.groupBy("slug").agg(F.max_by(F.struct(*rest), "seq").alias("r")).select("slug", "r.*")


def read_triage(spark: SparkSession, path: str) -> DataFrame:
    return latest_triage(spark.read.schema(TRIAGE).json(path))
