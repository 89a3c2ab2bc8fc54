"""Asset names, tokens and paths as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File-name grammar and state tables.
MILESTONE = r"^([a-z0-9][a-z0-9-]{0,63})_(first|clean|final|last)(?:(initial|needauth|done)|working_([0-9]{2,}))\.([A-Za-z]+)$"
MILESTONE_EXTS = ("png", "jpg", "jpeg", "webp")
RESERVED = r"^(con|prn|aux|nul|com[1-9]|lpt[1-9])$"
TOKEN = r"(?:^|_)(d[0-9a-z]{6,8})-"
BARE_TOKEN = r"^d[0-9a-z]{6,8}$"
ARTIST = r"(?i)_by_(.+?)_d[0-9a-z]{6,8}-"
STATE_STAGE = {
    "PENDING_INTAKE": "0",
    "FIRST_SCRATCH": "1",
    "FIRST_DONE": "2",
    "CLEAN_SCRATCH": "3",
    "CLEAN_DONE": "4",
    "FINAL_SCRATCH": "5",
    "FINAL_DONE": "6",
    "LAST_SCRATCH": "7",
    "END_REVIEW": "8",
    "PASSED": "9",
}
DONE_STATES = ("FIRST_DONE", "CLEAN_DONE", "FINAL_DONE", "END_REVIEW", "PASSED")


@F.pandas_udf(T.StringType())
def nfkd(s: pd.Series) -> pd.Series:
    """Unicode compatibility decomposition; no built-in function offers it."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def basename(path: Column) -> Column:
    return F.regexp_replace(path, r"(?s)^.*[/\\]", "")


def stem(name: Column) -> Column:
    """Name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(name, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def slugify(name: Column, reserved: bool = True) -> Column:
    ascii_only = F.lower(F.regexp_replace(nfkd(stem(name)), r"[^\x00-\x7F]", ""))
    dashed = F.regexp_replace(F.regexp_replace(ascii_only, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    capped = F.regexp_replace(F.substring(dashed, 1, 64), "-+$", "")
    slug = F.when(capped == "", "img").otherwise(capped)
    return F.when(slug.rlike(RESERVED), F.concat(slug, F.lit("-x"))).otherwise(slug) if reserved else slug


def parse_milestone(name: Column) -> Column:
    """Struct(slug, stage, phase, ver, ext); null when the name is no milestone."""
    part = [F.regexp_extract(name, MILESTONE, i) for i in range(1, 6)]
    ext = F.lower(part[4])
    good = name.rlike(MILESTONE) & ext.isin(*MILESTONE_EXTS)
    return F.when(
        good,
        F.struct(
            part[0].alias("slug"),
            part[1].alias("stage"),
            F.when(part[2] == "", "working").otherwise(part[2]).alias("phase"),
            F.when(part[3] != "", part[3].try_cast("int")).alias("ver"),
            ext.alias("ext"),
        ),
    )


def milestone_name(slug: Column, stage: Column, phase: Column, ver: Column, ext: Column) -> Column:
    number = F.when(F.length(ver.cast("string")) < 2, F.lpad(ver.cast("string"), 2, "0")).otherwise(ver.cast("string"))
    tail = F.when(phase == "working", F.concat(F.lit("working_"), number)).otherwise(phase)
    return F.concat(slug, F.lit("_"), stage, tail, F.lit("."), ext)


def milestone_key(name: Column) -> Column:
    """Identity of a milestone file: everything but its container format."""
    m = parse_milestone(basename(name))
    return F.when(
        m.isNotNull(), F.concat_ws("/", m["slug"], m["stage"], m["phase"], F.coalesce(m["ver"].cast("string"), F.lit("-")))
    )


def decode_token(name: Column) -> Column:
    """Number behind the first base-36 token of a name, or of a bare token."""
    inside = F.regexp_extract(name, TOKEN, 1)
    token = F.when(inside != "", inside).when(name.rlike(BARE_TOKEN), name)
    return F.conv(F.substring(token, 2, 64), 36, 10).cast("long")


def artist_segment(name: Column) -> Column:
    """Struct(status, raw, artist): a name is only given when it is certain."""
    raw = F.lower(F.regexp_extract(name, ARTIST, 1))
    status = F.when(raw == "", "absent").when(raw.rlike("^[a-z0-9][a-z0-9-]*$"), "recovered").otherwise("ambiguous")
    return F.struct(
        status.alias("status"), F.when(raw != "", raw).alias("raw"), F.when(status == "recovered", raw).alias("artist")
    )


def canonical_url(base: str, artist: Column, number: Column) -> Column:
    """Template fill; null when any part is unknown."""
    return F.concat(F.lit(base + "/"), artist, F.lit("/art/x-"), number.cast("string"))


def derive_stage(stage: Column, state: Column) -> Column:
    """Explicit stage number, else the one of the state, else '?'."""
    table = F.create_map(*[F.lit(x) for pair in STATE_STAGE.items() for x in pair])
    digits = F.trim(stage)
    return F.coalesce(
        F.when(digits.rlike("^[0-9]+$"), digits.try_cast("int").cast("string")),
        table[F.upper(F.trim(state))],
        F.lit("?"),
    )


def derive_phase(phase: Column, substate: Column, state: Column, working_max: Column) -> Column:
    """Explicit phase, else mapped from the substate, then the state, else initial."""
    sub, st = F.upper(F.trim(substate)), F.upper(F.trim(state))
    return (
        F.when(F.trim(phase) != "", F.trim(phase))
        .when(sub == "NEEDAUTH", "_needauth")
        .when(sub == "APPROVED_PENDING_MOVE", "_done")
        .when((sub == "EDITING") & (working_max >= 1), "_working")
        .when(sub == "EDITING", "_initial")
        .when(st.isin(*DONE_STATES), "_done")
        .when(st.endswith("_SCRATCH"), "_working")
        .otherwise("_initial")
    )


def claim_key(path: Column) -> Column:
    """Relative comparison key of a path; null for absolute or escaping paths."""
    raw = F.replace(F.trim(path), F.lit("\\"), F.lit("/"))
    # an escaped path is marked with a sentinel segment that no real path can hold
    folded = F.aggregate(
        F.filter(F.split(raw, "/"), lambda s: ~s.isin("", ".")),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(F.array_contains(acc, "\0"), acc)
        .when((s == "..") & (F.size(acc) == 0), F.array(F.lit("\0")))
        .when(s == "..", F.slice(acc, F.lit(1), F.size(acc) - 1))
        .otherwise(F.concat(acc, F.array(s))),
    )
    bad = raw.startswith("/") | raw.rlike("^[A-Za-z]:") | F.array_contains(folded, "\0") | (F.size(folded) == 0)
    return F.when(~bad, F.lower(F.array_join(folded, "/")))


def contains(parent: Column, child: Column) -> Column:
    """Segment-wise containment; ``tool`` does not hold ``tools/x``."""
    return (child == parent) | child.startswith(F.concat(parent, F.lit("/")))


def ancestors(key: Column) -> Column:
    """Every prefix of a path, the path itself included."""
    parts = F.split(key, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")
    )
