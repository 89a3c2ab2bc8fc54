"""Every operator over a table whose extra columns bear the names that operators use inside."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

import tidemark.llm as llm
from tests.llm.helpers import docs, plain
from tidemark.llm import decontamination, language_id, line_dedup, mixing, ngram_join, secret_scan, url_filter

OWN = ("doc_id", "text", "lang", "source", "n_chars", "url")
NAMES = sorted({
    name
    for path in glob.glob(os.path.join(os.path.dirname(llm.__file__), "*.py"))
    for name in re.findall(r"\"(_?[a-z][a-z_0-9]{0,15})\"", open(path, encoding="utf-8").read())
} - set(OWN))
TEXTS = ["one two three four five six seven eight password=abcdefgh1", "other words are here\nand a second line", None, ""]


@pytest.fixture(scope="module")
def crowded(spark):
    rows = docs(spark, plain(TEXTS)).withColumn("url", F.lit("http://a.example.org/es/x"))
    return rows.withColumns({n: F.lit(f"own {n}") for n in NAMES})


def judged(spark, rows):
    benchmark = spark.createDataFrame([(0, "nothing of this is there at all")], "item_id long, text string")
    return {
        "judge_urls": (lambda: url_filter.judge_urls(rows, url_filter.rule_table(spark)), ("host", "path", "rule", "verdict")),
        "mix": (lambda: mixing.mix(rows.withColumn("size", F.lit(3).cast("long"))), ("source_size", "target", "taken", "size")),
        "dedup_lines": (lambda: line_dedup.dedup_lines(rows), ("kept", "n_lines", "n_dropped")),
        "decontaminate": (lambda: decontamination.decontaminate(rows, benchmark), ()),
        "find_secrets": (lambda: secret_scan.find_secrets(rows), ("blob", "spans")),
        "keep_one": (lambda: ngram_join.keep_one(rows), ()),
        "identify": (lambda: language_id.identify(rows, language_id.learn(rows)), ("lang_pred", "score")),
    }


@pytest.mark.parametrize("name", ["judge_urls", "mix", "dedup_lines", "decontaminate", "find_secrets", "keep_one", "identify"])
def test_other_columns_come_back_as_they_were(spark, crowded, name):
    run, new = judged(spark, crowded)[name]
    got = run()
    rest = [n for n in NAMES if n not in new]
    assert set(crowded.columns) <= set(got.columns)
    rows = got.select("doc_id", *rest).collect()
    assert len(rows) == len(TEXTS)
    assert all(r[n] == f"own {n}" for r in rows for n in rest)
