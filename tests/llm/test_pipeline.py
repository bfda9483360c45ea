from __future__ import annotations

import hashlib
import os

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caremeld.llm import queries, secret_spans
from caremeld.llm.shared import stored

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, docs, SMALL), "stage")
        assert kept.columns == source.columns, name
        assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()} or name == "secret scans"
        docs = kept
    assert corpus_pipeline.run(spark, SMALL).count() <= source.count()


def test_pipeline_against_its_operators(spark, tmp_path):
    """Junk, copies, leaks and secrets go; clean documents stay, with what their tokens say."""
    clean = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and set(ids) <= set(clean)
    leaked = {r.doc_id for r in queries.QUERIES["op1_decontaminate"](spark, SMALL).collect()}
    assert not leaked & set(ids)
    component = {r.doc_id: r.component_id for r in queries.QUERIES["op9_simhash"](spark, SMALL).collect()}
    assert len({component[i] for i in ids}) == len(ids)


def test_redacted_texts_and_digests_against_plain(spark):
    """What the last two stages return, worked out from the spans in Python and by the library's own encoder."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    keys = [hashlib.sha256(bytes([i])).hexdigest() for i in range(20)]
    more = [(10_000 + i, f"é token={k} and\n{k[: i + 20]} \U0001f600 password: {k[:7]}", "en", "s", 0) for i, k in enumerate(keys)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    clean = {r.doc_id: r for r in corpus_pipeline.hide_secrets(spark, docs, SMALL).collect()}
    expected = {}
    for row in secret_spans.secret_spans(docs).collect():
        text, out, at = row.text or "", [], 0
        for _, start, end, _ in row.spans:
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        whole = "".join(out) + text[at:]
        ids = library.encode(whole, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        expected[row.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest())
        assert (clean[row.doc_id].text or "") == whole and clean[row.doc_id].n_chars == len(whole)
        assert clean[row.doc_id].lang == row.lang and clean[row.doc_id].source == row.source
    assert any("[SECRET]" in (r.text or "") for r in clean.values())
    for row in corpus_pipeline.run(spark, SMALL).collect():
        assert tuple(row)[1:] == expected[row.doc_id]


def test_stages_take_odd_rows_and_more_columns(spark):
    """Nulls, empty and repeated rows, and columns with the names that operators use themselves."""
    odd = [(1, None, "en", "s", None), (1, "", None, None, 0), (None, "token=abcdef123456", "en", "s", 18), (2, "x" * 30_000, "en", "s", 1), (2, "x" * 30_000, "en", "s", 1)]
    more = "doc_id long, text string, lang string, source string, n_chars long, spans string, kept_id long, fp long, found string"
    docs = spark.createDataFrame([(*r, "a", 1, 2, "b") for r in odd], more)
    for name, stage in corpus_pipeline.STAGES:
        for frame, rows in ((docs, len(odd)), (docs.limit(0), 0)):
            result = stage(spark, frame, SMALL)
            assert result.count() <= rows, name
            assert name.startswith("BPE") or result.columns == docs.columns
    kept = corpus_pipeline.keep_one_of_each(spark, docs, SMALL).collect()
    assert sorted((r.doc_id or 0, r.spans, r.found) for r in kept) == [(0, "a", "b"), (1, "a", "b"), (2, "a", "b")]
    hidden = {r.doc_id: r.text for r in corpus_pipeline.hide_secrets(spark, docs, SMALL).collect()}
    assert hidden[None] == "[SECRET]" and hidden[2] == "x" * 30_000


def test_nulls_and_empty_documents(spark, tmp_path):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    for name, rows in (("none", []), ("odd", [(None, None, None, None, None), (1, None, None, None, None), (1, "", "en", "s", 0)])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
        assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert corpus_pipeline.run(spark, folder).count() <= len(rows)


@pytest.mark.parametrize("name", [n for n in queries.ORACLE])
def test_queries_against_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        connection.execute(f"create view {file[:-8]} as select * from '{SMALL}/{file}'")
    result = queries.QUERIES[name](spark, SMALL)
    cursor = connection.execute(queries.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=str)
    assert ours == sorted(cursor.fetchall(), key=str)
