"""The pipeline's stages against brute force, each on its own input, and the registered queries."""

import os
from collections import defaultdict
from hashlib import sha256

import corpus_pipeline
import duckdb
import pytest

from conftest_llm import SF, same
from test_ledger import brute_force as measured
from test_lineruns import brute_force as cut_lines
from test_setsketch import brute_force as near
from test_winnowing import brute_force as hits
from tokenizers import Tokenizer

import __spark_entry__ as registry
from millrace.llm.bpe import word_bpe_path
from millrace.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(rows, _):
    return [row for row, m in zip(rows, measured([r[:2] for r in rows]), strict=True) if m[-1] == 0]


def keep_lines(rows, _):
    out = []
    for row, (_, n, gone, text) in zip(rows, cut_lines([r[:2] for r in rows], 1), strict=True):
        if not gone or len(gone) < n:
            out.append((row[0], text, *row[2:]))
    return out


def keep_near(rows, _):
    return [row for row, r in zip(rows, near([r[:2] for r in rows], 5, 80), strict=True) if r[3]]


def keep_clean(rows, items):
    return [row for row, r in zip(rows, hits([r[:2] for r in rows], items, 10), strict=True) if not r[-1]]


def encoded(rows, _):
    library = Tokenizer.from_file(word_bpe_path())
    out = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), *[sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]))
    return out


BRUTE_FORCE = [keep_quality, keep_lines, keep_near, keep_clean, encoded]


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for (_, stage), brute in zip(corpus_pipeline.STAGES, BRUTE_FORCE, strict=True):
        rows = [tuple(r) for r in docs.select(COLUMNS).collect()]
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test-stage")
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == COLUMNS
        same([tuple(r) for r in docs.collect()], brute(rows, items))
    same([tuple(r) for r in corpus_pipeline.run(spark, SF).collect()], [tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_awkward_documents(spark, awkward, empty, name, stage):
    docs, rows = awkward
    found = stage(spark, docs, SF)
    assert found.columns == docs.columns
    assert found.dtypes == docs.dtypes
    assert 0 < len(found.collect()) <= len(rows)
    assert stage(spark, empty, SF).collect() == []


def test_one_of_each_group_stays(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, text), (None, text), (7, text), (7, text), (9, text), (None, "some other words than those before"), (None, None), (None, None), (3, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = [tuple(r)[:2] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()]
    same(found, [(7, text), (None, "some other words than those before"), (None, None), (None, None), (3, "")])


def test_registry():
    assert QUERIES.keys() | {"pipeline"} <= registry.queries().keys()
    assert ORACLES.keys() <= registry.oracle_sql().keys()
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "bpe_tokens"]


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    sql = duckdb.connect()
    for file in os.listdir(SF):
        if file.endswith(".parquet"):
            sql.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    same([tuple(r) for r in df.select(names).collect()], cursor.fetchall())


def test_queries_return_the_contract(spark):
    expected = {
        "op1": "doc_id:bigint,n_words:bigint,n_removed:bigint,kept_sha256:string",
        "op2": "doc_id:bigint,n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string,contaminated:boolean",
        "op3": "doc_id:bigint,size:bigint,text_crc32:bigint,law:string,shard:int,slot:bigint,grown_shard:int",
        "op5": "doc_id:bigint,n_shingles:bigint,component_id:bigint,kept:boolean",
        "op6": "doc_id:bigint,n_tokens:bigint,ids_sha256:string,decoded_sha256:string",
        "op7": "doc_id:bigint,held_out:boolean,score:double,predicted:int",
        "op9": "doc_id:bigint,n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,kept:boolean",
        "op12": "doc_id:bigint,n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,runs_sha256:string,collapsed_sha256:string",
        "op13": "doc_id:bigint,held_out:boolean,n_tokens:bigint,n_known:bigint,train_tokens:bigint,base_score:double,score:double",
    }
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    kinds = defaultdict(str)
    for name, query in QUERIES.items():
        if (op := name.split("_")[0]) in expected:
            df = query(spark, SF)
            kinds[op] = ",".join(f"{c}:{t}" for c, t in df.dtypes)
            assert df.count() == n
    for op, columns in expected.items():
        assert set(columns.split(",")) <= set(kinds[op].split(",")), op
