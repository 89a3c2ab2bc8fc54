"""Queries that run user-supplied Python through Arrow."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import naming
from tidemark.operators import extensions as E
from tidemark.plans import views
from tidemark.plans.registry import query


def _norms(pdf: pd.DataFrame) -> pd.DataFrame:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["embedding"]]) if len(pdf) else np.zeros((0, 1))
    return pd.DataFrame({"l1": np.round(np.abs(m).sum(axis=1), 4), "peak": np.round(m.max(axis=1), 6) if len(pdf) else []})


@query(
    "u01_pluggable_scorer",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))), 4) AS l1, round(CAST(list_max(embedding) AS DOUBLE), 6) AS peak FROM embeddings""",
)
def u01(t):
    return E.score(t("embeddings").select("vec_id", "embedding"), _norms, "l1 double, peak double").drop("embedding")


def _figures(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = [(int(i), n, float(np.round(np.float64(v[n]), 6))) for i, v in zip(pdf["vec_id"], pdf["embedding"]) for n in range(int(i) % 4)]
    return pd.DataFrame(rows, columns=["vec_id", "figure", "conf"])


@query(
    "u02_pluggable_detector",
    """SELECT vec_id, n AS figure, round(CAST(embedding[n + 1] AS DOUBLE), 6) AS conf FROM embeddings, (SELECT unnest(range(3)) AS n) r WHERE n < vec_id % 4""",
)
def u02(t):
    return E.detect(t("embeddings").select("vec_id", "embedding"), _figures, "vec_id long, figure long, conf double")


@query(
    "u03_nfkd",
    """SELECT doc_id, length(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')) AS ascii_chars FROM documents""",
)
def u03(t):
    folded = F.regexp_replace(naming.nfkd(F.col("text")), r"[^\x00-\x7F]", "")
    return t("documents").select("doc_id", F.length(folded).cast("long").alias("ascii_chars"))


@query(
    "u05_provenance_chain",
    """SELECT slug, 'f' || seq AS file, coalesce('f' || lag(seq) OVER w, '') AS prior, row_number() OVER w AS depth FROM v_transitions WINDOW w AS (PARTITION BY slug ORDER BY seq)""",
)
def u05(t):
    d = views.v_transitions(t).select("slug", "seq", F.concat(F.lit("f"), F.col("seq").cast("string")).alias("file"))
    return E.provenance(d, "slug", "seq", "file").select("slug", "file", F.coalesce("prior", F.lit("")).alias("prior"), "depth")
