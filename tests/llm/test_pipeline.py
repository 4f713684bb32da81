"""The pipeline against its stages in plain Python, and on odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from millrace.llm import queries, toxicity
from tests.conftest import SMALL
from tests.llm.test_bpe import LIBRARY
from tests.llm.test_scans import JWT, plain_hits
from tests.llm.test_simhash import plain_groups, plain_print


@pytest.fixture(scope="module")
def model(spark):
    return queries.toxicity_model(spark, SMALL)


def passes(model, text):
    strings = sorted(toxicity.strings_of(text or ""))
    return model.probability(max([model.bias, *model.decisions(strings)])) < 0.5


def test_against_plain_stages(spark, model):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = [r for r in docs if passes(model, r.text)]
    groups = plain_groups([plain_print(r.text) for r in docs])
    docs = [r for k, r in enumerate(docs) if groups[k] == k]
    expected = {}
    for row in docs:
        n, n_hit, _, _ = plain_hits(row.text, items, 13)
        if n_hit and 20 * n_hit >= n:
            continue
        from millrace.llm import secret_scan

        text, hidden = "", 0
        for start, end, _ in secret_scan.spans_of(row.text):
            if start > hidden or (start == 0 and hidden == 0):
                text += row.text[hidden:start] + "[SECRET]"
            hidden = max(hidden, end)
        text += row.text[hidden:]
        expected[row.doc_id] = (row.lang, row.source, LIBRARY.encode_ordinary(text), hashlib.sha256(text.encode()).hexdigest())
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert len(got) == len(expected)
    assert {r.doc_id: (r.lang, r.source, r.tokens, r.text_sha256) for r in got} == expected


def test_stages_on_odd_rows(spark):
    schema = "text string, doc_id bigint, source string, lang string, n_chars bigint, contamination string, new int, id_0 int"
    rows = [(None, 1), (None, 1), ("", 2), ("fine words here", None), (f"x {JWT} and password=abcdef12 more words to tell", 5), ("x " * 50_000, 6)]
    docs = spark.createDataFrame([(t, i, None, None, len(t) if t else None, "c", 1, 1) for t, i in rows], schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == list(corpus_pipeline.COLUMNS), name
            assert out.dtypes == [(c, dict(docs.dtypes)[c]) for c in out.columns]
        kept = out.collect()
        assert len(kept) == (4 if name.startswith("simhash") else len(rows)), name
        assert stage(spark, docs.where("false"), SMALL).collect() == []
    masked = corpus_pipeline.with_secrets_masked(spark, docs, SMALL).where("doc_id = 5").first()
    assert masked.text == "x [SECRET] and [SECRET] more words to tell" and masked.n_chars == len(masked.text)


def test_entry_registers_all():
    names = set(driver.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(driver.oracle_sql()) <= names
