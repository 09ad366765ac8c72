"""The pipeline, stage by stage, against brute force."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from test_decontamination import brute as brute_items
from test_lines import brute as brute_lines
from test_simhash import brute_components, brute_print

import corpus_pipeline

from tagloom.session import written

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and the last one's rows."""
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], FOLDER), "stage"))
    return [df.collect() for df in out], [df.columns for df in out]


def texts(rows):
    return sorted([(row.doc_id, row.text) for row in rows])


def test_columns(stages):
    _, columns = stages
    assert all(found == corpus_pipeline.COLUMNS for found in columns[:5])
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"


def test_quality_stage_keeps_clean_documents(spark, stages):
    (docs, kept, *_), _ = stages
    quality = {row.doc_id: row.quality for row in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert set(kept) <= set(docs)
    left = {row.doc_id for row in kept}
    clean = [key for key, label in quality.items() if label == 1]
    junk = [key for key, label in quality.items() if label == 0]
    assert sum(key in left for key in clean) >= 0.97 * len(clean)
    assert sum(key in left for key in junk) <= 0.2 * len(junk)


def test_line_stage(stages):
    (_, before, after, *_), _ = stages
    assert texts(after) == sorted((key, text) for key, text, _, _ in brute_lines([(r.doc_id, r.text) for r in before]))
    assert all(row.n_chars == len(row.text) for row in after)


def test_simhash_stage(stages):
    (_, _, before, after, *_), _ = stages
    components = brute_components([(r.doc_id, brute_print(r.text)) for r in before], 2)
    assert set(after) <= set(before)
    assert {r.doc_id for r in after} == {key for (key, _), least in components.items() if key == least}


def test_benchmark_stage(spark, stages):
    (_, _, _, before, after, _), _ = stages
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bad = {key for key, *_ in brute_items([(r.doc_id, r.text) for r in before], items)}
    assert bad and set(after) == {row for row in before if row.doc_id not in bad}


def test_last_stage(stages):
    (*_, before, after), _ = stages
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {row.doc_id: row for row in after}
    assert len(found) == len(before)
    for row in before:
        assert found[row.doc_id].token_ids == encoding.encode_ordinary(row.text)
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    (*_, after), _ = stages
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(row.doc_id, row.ids_sha256) for row in rows} == {(row.doc_id, row.ids_sha256) for row in after}


def test_odd_documents_go_through_every_stage(spark):
    odd = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1), (2, None, None, None, None, 1),
           (3, "a b c\n" * 50_000, "en", "s", 9, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, token_ids int"
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, FOLDER).collect()


def test_stages_on_a_table_with_the_operators_own_names(spark):
    """Columns named as what the operators use inside neither crash a stage nor come out of it."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name in ("_score", "_clean", "_dropped", "_none", "_text", "key", "version", "bits", "items"):
        docs = docs.selectExpr("*", f"doc_id AS {name}")
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == corpus_pipeline.COLUMNS
        assert 0 < kept.count() <= docs.count()
