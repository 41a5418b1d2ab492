"""Every named query of the subpackage against SQL on the smallest tables, and the pipeline against plain Python."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from tools.check_oracle import difference, oracle_connection
from vitalgrid.llm import decontaminate, mixing, oracle, quality, queries, token_blocks


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, smoke_dir, name):
    assert difference(spark, oracle_connection(smoke_dir), name, smoke_dir) is None


def test_queries_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n[: n.index("_")] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracle.SQL) - {"op13_embedding_whitening"}))
def test_query_without_sql_has_a_row_per_row(spark, smoke_dir, name):
    table = "pages" if name == "op2_html_text" else "documents"
    assert queries.QUERIES[name](spark, smoke_dir).count() == spark.read.parquet(f"{smoke_dir}/{table}.parquet").count()


def test_pipeline_equals_brute_force(spark, smoke_dir):
    """Stage by stage on the smallest tables; the verdicts of quality and mixing are held against SQL elsewhere."""
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality_report(docs).filter("kept").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in kept}
    heads = brute.components(texts)
    texts = {i: t for i, t in texts.items() if heads[i] == i}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").collect()}
    leaked = {d for d, _ in brute.leaks(texts, items)}
    left = docs.filter(docs["doc_id"].isin(sorted(set(texts) - leaked)))
    sampled = sorted(r["doc_id"] for r in mixing.mixture(left).collect() for _ in range(r["copies"]))

    tokenizers = pytest.importorskip("tokenizers")
    encode = tokenizers.Tokenizer.from_file(token_blocks.tokenizer_path()).encode
    want, start = [], 0
    for i in sampled:
        ids = [*encode(texts[i], add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = corpus_pipeline.run(spark, smoke_dir)
    assert sorted(map(tuple, found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_stages_keep_the_columns(spark, docs, smoke_dir):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, smoke_dir).columns == docs.columns


def test_stages_take_empty_tables(spark, no_docs, smoke_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, smoke_dir).count() == 0


def test_sketch_threshold_loses_no_item():
    """Whatever a document misses, it holds the least number of sketch entries of an item it contains."""
    for n in range(1, 300):
        upper = 2 ** int(np.ceil(np.log2(n)))
        kept = min(n, upper * (100 - decontaminate.PERCENT) // 100 + decontaminate.SPARE)
        missing = n * (100 - decontaminate.PERCENT) // 100
        assert kept - missing >= 1
