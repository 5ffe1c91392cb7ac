from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import tiktoken
from test_decontamination import expected as contaminated
from test_line_dedup import expected as deduped
from test_shingle_dedup import expected as components

from ledgerloom.llm import byte_bpe, quality_cascade

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TABLES = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()]
    verdicts = {r.doc_id: r.kept for r in quality_cascade.judged(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if verdicts[r.doc_id]]
    rows = [(i, t) for i, t, _, _ in deduped(rows)]
    leads = {c for _, c in components(rows)}
    rows = [r for r in rows if r[0] in leads]
    clean = {i for i, _, hit, _ in contaminated(rows, items) if not hit}
    rows = [r for r in rows if r[0] in clean]
    real = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(PATH), special_tokens={})
    want = {i: len(real.encode_ordinary(t)) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, TABLES).collect()} == want


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    fox = "the quick brown fox jumps over the lazy dog and then some more words"
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a row without an id has some ten words or even more", "en", "s", 3),
            (3, "\n".join(" ".join(f"w{i * k}" for k in range(1, 12)) for i in range(1000, 2000)), "en", "s", 9), (4, fox, "en", "s", 5), (4, fox, "en", "s", 5)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, SCHEMA)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, TABLES)
            assert docs.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
        assert sorted((r.doc_id for r in last.collect()), key=repr) == ([3, 4, None] if data else [])
