"""Registered queries against their SQL, and the pipeline against its parts and brute force."""

import glob
import os
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import minhash, mixing, quality_rules
from millrace.llm.catalogue import ORACLES, QUERIES, tokenizer_file

from .conftest import prose
from .test_minhash import slow
from .test_quality import junk

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name not in ("op3_benchmark_leaks", "op12_conversation_trie"):
        assert len(rows) == duck.sql("select count(*) from documents").fetchall()[0][0]
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        at = [want.columns.index(c) for c in got.columns]
        assert sorted(map(repr, rows)) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


def test_every_operator_has_its_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture
def corpus(make, spark, tmp_path):
    items = [(0, prose(2001, 40)), (1, prose(2002, 35))]
    rows = [(i, prose(i, 80), "en", f"s{i % 3}") for i in range(120)]
    rows += [(200 + i, prose(i, 80) + " more", "en", "s0") for i in range(10)]  # near copies
    rows += [(220 + i, prose(i + 20, 80), "en", "s1") for i in range(10)]  # copies
    rows += [(240 + i, junk(i + 300), "en", "s2") for i in range(60)]
    rows += [(310, prose(900, 50) + " " + items[0][1], "en", "s1"), (311, items[1][1].upper() + " " + prose(901, 50), "en", "s1")]
    rows += [(320, None, None, None), (321, "", "en", "s0"), (None, prose(902, 60), "en", None), (None, prose(902, 60), "en", None)]
    docs = make(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    good = [(i, 1, 0) for i in range(120)] + [(240 + i, 0, 0) for i in range(60)]
    spark.createDataFrame(good, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), {r[0]: r[1] for r in rows}


def test_stages_do_what_brute_force_does(spark, corpus):
    from tokenizers import Tokenizer

    folder, texts = corpus
    docs = columns = None
    kept = {}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), f"test-{name}")
        kept[name] = Counter(r.doc_id for r in docs.collect())
        if name != "token_blocks":
            assert docs.columns == columns
    passed = kept["quality_rules"]
    assert set(passed) == set(range(120)) | {200 + i for i in range(10)} | {220 + i for i in range(10)} | {310, 311, None}
    components = slow({i: texts[i] for i in passed if i is not None}, minhash.Likeness())
    alone = kept["minhash_near_dedup"]
    assert {i for i in alone if i is not None} == {i for i, (_, c) in components.items() if i == c}
    assert alone[None] == 2 and set(alone) & set(range(200, 240)) == set()
    assert set(kept["benchmark_decontamination"]) == set(alone) - {310, 311}
    mix = kept["mix_sources"]
    assert set(mix) <= set(alone) and max(mix[i] for i in mix if i is not None) <= 3
    plain = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    found = docs.collect()
    assert Counter(r.doc_id for r in found) == mix
    for r in found:
        if r.doc_id is not None:
            assert r.n_tokens == len(plain.encode(texts[r.doc_id], add_special_tokens=False).ids) + 1
    starts = sorted((r.start, r.n_tokens) for r in found)
    assert [s for s, _ in starts] == np.concatenate([[0], np.cumsum([n for _, n in starts])[:-1]]).tolist()


def test_run_applies_all_stages(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), "test-run")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(corpus_pipeline.run(spark, folder)) == rows(docs)


def test_the_pipeline_of_an_empty_table_is_empty(spark, corpus, tmp_path_factory):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), f"test-empty-{name}")
        assert docs.count() == 0


def test_operators_read_no_other_column(spark, corpus):
    """Columns with the operators' own names stay as they were."""
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for result in (mixing.mixed(docs), minhash.deduplicated(docs), quality_rules.passing(docs, None)):
        assert {(r.key, r.hash, r.size, r.shard, r.id) for r in result.collect()} == {("k", "h", "s", "x", "i")}
