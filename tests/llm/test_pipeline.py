import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import docs
from tests.llm.test_near_and_leaks import brute_groups
from tests.llm.test_urls_mixing_lines import brute_lines, brute_targets
from tests.test_oracles import FOLDER


@pytest.fixture(scope="module")
def steps(spark):
    """Every stage's input and output over the small table."""
    at, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, at, FOLDER).persist()
        out.append((name, at, after))
        at = after
    return {name: (before.toPandas(), after.toPandas()) for name, before, after in out}


def test_columns(steps):
    for name, (before, after) in steps.items():
        if name != "mixing":
            assert list(after.columns) == list(before.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_languages(steps):
    before, after = steps["language_id"]
    lettered = [i for i, t in zip(before.doc_id, before.text) if t and any(c.isalpha() for c in t)]
    assert sorted(after.doc_id) == sorted(lettered)


def test_lines(steps):
    import hashlib

    before, after = steps["line_dedup"]
    want = brute_lines(list(zip(before.doc_id, before.text)))
    assert sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in zip(after.doc_id, after.text)) == sorted((d, h) for d, _, _, h in want)
    assert (after.text.str.len() == after.n_chars).all()


def test_groups(steps):
    before, after = steps["near_duplicates"]
    want = set()
    for d, n, c in brute_groups(list(zip(before.doc_id, before.text)), 5, 4, 5):
        want.add(c if n else d)
    assert sorted(after.doc_id) == sorted(want)


def test_leaks(steps, spark):
    before, after = steps["decontamination"]
    flat = lambda t: f" {' '.join((t or '').lower().split())} "
    items = [flat(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    gone = {i for i, t in zip(before.doc_id, before.text) if any(u in flat(t) for u in items)}
    assert gone and not gone & set(after.doc_id)
    assert len(set(before.doc_id) - gone - set(after.doc_id)) <= 0.02 * len(before)


def test_mix(steps):
    before, after = steps["mixing"]
    assert sorted(after.doc_id) == sorted(before.doc_id)
    sizes = after.groupby("source")["size"].sum().to_dict()
    taken = after.groupby("source").taken.sum().to_dict()
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= 0.02 * target + 16
    assert (after.taken <= 2 * after["size"]).all()


def test_run_is_the_stages(steps, spark):
    got = corpus_pipeline.run(spark, FOLDER).toPandas()
    want = steps["mixing"][1]
    assert sorted(map(tuple, got.itertuples(index=False)), key=repr) == sorted(map(tuple, want.itertuples(index=False)), key=repr)


def test_stages_take_hard_rows(spark):
    text = "the of and " * 30 + "\n" + "x" * 50
    at = docs(spark, [(1, text, "en", "a", 0), (1, text, "en", "a", 0), (2, None, None, None, None), (None, "the of and some", None, None, 5), (3, "", "en", "a", 0), (4, "123", "en", "a", 3), (5, "word " * 50_000, "en", "b", 0)])
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, FOLDER)
    assert at.agg(F.count("*")).first()[0] == 3


def test_stages_take_an_empty_table(spark):
    at = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, FOLDER)
        assert at.count() == 0
