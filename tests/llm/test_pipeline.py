"""The pipeline's stages against what they must keep, and all SQL."""

from __future__ import annotations

import os

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from propspark.llm.queries import ORACLE, QUERIES
from test_near import brute_classes

SF = os.environ.get("PROPSPARK_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_stages_keep_what_they_must(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], SF).cache())
        if name != "bpe":
            assert steps[-1].columns == docs.columns
    rows = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps[:-1]]
    largest = {t: max(i for i, x in rows[1].items() if x == t) for t in rows[1].values()}
    assert set(rows[2]) == set(largest.values())
    assert set(rows[3]) == set(brute_classes(list(rows[2].items())).values())
    assert set(rows[4]) <= set(rows[3])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = {r["doc_id"]: r["ids"] for r in steps[-1].collect()}
    assert last == {i: library.encode(t, add_special_tokens=False).ids for i, t in rows[4].items()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(r) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


def test_registered_queries_are_the_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_last_stage_decodes_what_it_encoded(spark):
    rows = [(1, "Hello WORLD, it's 123", "en", "a", 21), (2, None, "fr", None, 0), (2, "été été", None, "b", 7), (None, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text, lang, source, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, lang, source, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    out = corpus_pipeline.encode(spark, docs, SF).select("doc_id", "lang", "source", "n_tokens", "ids", "decoded").collect()
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
