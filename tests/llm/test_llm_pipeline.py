from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from helpers import documents, prose
from loadledger.llm import queries
from test_llm_near_dedup import brute, edited
from test_llm_quality import bad
from test_llm_secrets import HEX
from test_llm_packing import check

SF_DIR = "/root/testdata/sf0.001"


def corpus():
    import random

    rng = random.Random(8)
    texts = []
    for n in range(300):
        texts.append(bad(n) if n % 5 == 0 else prose(n, 80))
    for n in (1, 2, 3, 4, 6, 7, 8):
        texts += [texts[n], edited(texts[n], rng, 1)]
    texts += [f"{prose(900 + n, 60)} token = \"{HEX[:-1]}{n}\" {prose(950 + n, 20)}" for n in range(5)]
    return texts + [None, ""]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    texts = corpus()
    docs = documents(spark, texts, clash=True)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(n, int(n % 5 != 0), 0) for n in range(300)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    found, now = [spark.read.parquet(f"{folder}/documents.parquet")], None
    for name, step in corpus_pipeline.STAGES:
        now = step(spark, found[-1], folder)
        now.write.parquet(f"{folder}/out/{name}")
        found.append(spark.read.parquet(f"{folder}/out/{name}"))
    return folder, found


def test_stage_by_stage_against_brute_force(steps):
    _, (docs, good, distinct, clean, packed) = steps
    assert good.dtypes == distinct.dtypes == clean.dtypes == docs.dtypes
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    junk = {n for n in range(300) if n % 5 == 0}
    assert not kept.keys() & junk and len(texts.keys() - junk - kept.keys()) <= 4
    assert all(kept[i] == texts[i] for i in kept)
    groups = brute(list(kept.items()), 5, 80)
    single = {r["doc_id"]: r["text"] for r in distinct.collect()}
    assert single == {i: kept[i] for i, (_, low) in groups.items() if low == i}
    for r in clean.collect():
        before = single[r["doc_id"]]
        expected = before and re.sub(r'token = "[0-9a-f]+', "[secret]", before)
        assert r["text"] == expected
        assert r["n_chars"] == (None if before is None else len(expected))
    final = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert final.keys() == single.keys()
    rows = packed.collect()
    assert {r["doc_id"] for r in rows} == final.keys()
    numbered = {i: n for n, i in enumerate(sorted(final))}
    renamed = [{**r.asDict(), "doc_id": numbered[r["doc_id"]]} for r in rows]
    used, least = check(renamed, [final[i] for i in sorted(final)], 2048)
    assert used <= least + 2


def test_run_applies_all_stages(spark, steps):
    folder, found = steps
    rows = corpus_pipeline.run(spark, folder)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in rows.collect()) == sorted(tuple(r[k] for k in key) for r in found[-1].collect())


def test_empty_tables(spark, tmp_path):
    documents(spark, [], clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = con.execute(queries.ORACLE_SQL[name])
    columns = sorted(c[0] for c in cursor.description)
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)
    found = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == columns
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == expected


def test_every_operator_has_one_query():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
