"""The pipeline, each stage against what it must do to its own input, and the queries that have SQL."""

import re
from pathlib import Path

import duckdb
import pytest
from test_contamination import brute as contaminated_by
from test_jaccard import brute as grouped_by

import corpus_pipeline
from meterlake import session
from meterlake.llm import queries
from meterlake.session import scratch

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, the documents first."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    queries.ship(spark)
    for name, stage in corpus_pipeline.STAGES:
        with scratch(spark):
            stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs.collect())
    return out


def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_stages_keep_the_columns_of_documents(stages):
    names = list(stages[0][0].asDict())
    assert all(list(rows[0].asDict()) == names for rows in stages[1:-1])


def test_quality_removes_rows_only(stages):
    assert set(pairs(stages[1])) < set(pairs(stages[0])) and len(stages[1]) > 0.6 * len(stages[0])


def test_lines_keep_all_documents(stages):
    before, after = dict(pairs(stages[1])), dict(pairs(stages[2]))
    assert before.keys() == after.keys()
    for r in stages[2]:
        parts = iter(before[r["doc_id"]].split("\n"))
        assert r["text"] == "" or all(line in parts for line in r["text"].split("\n"))  # a subsequence
        assert r["n_chars"] == len(r["text"]) or r["text"] == before[r["doc_id"]]


def test_one_document_of_each_group_stays(stages):
    rows = pairs(stages[2])
    _, _, smallest = grouped_by(rows, 5, 4, 5)
    assert sorted(pairs(stages[3])) == sorted(r for r, s in zip(rows, smallest, strict=True) if r[0] == s)


def test_contaminated_documents_go(stages):
    items = duckdb.sql(f"SELECT * FROM '{SF}/benchmark.parquet'").fetchall()
    bad = {r[0] for r in contaminated_by(pairs(stages[3]), items) if r[-1]}
    assert sorted(pairs(stages[4])) == sorted(r for r in pairs(stages[3]) if r[0] not in bad)


def test_packing_takes_all_that_is_left(stages):
    assert {r["doc_id"] for r in stages[5]} == {r["doc_id"] for r in stages[4]}


def test_run_gives_the_last_stage_and_leaves_nothing_else(spark, stages, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_folder", lambda spark: str(tmp_path))
    found = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["start"], r["ids_crc32"])
    tokens = lambda rows: sum(r["length"] for r in rows)
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in stages[5]} and tokens(found) == tokens(stages[5])
    assert len(set(map(key, found))) == len(found)
    assert [re.sub("-[0-9a-f]{32}$", "", p.name) for p in tmp_path.iterdir()] == ["pipeline-packing"]


def test_repeated_rows_of_one_document_leave_one(spark, documents):
    text = " ".join(f"word{i}" for i in range(40))
    docs = documents([(1, text), (1, text), (2, text), (3, "other words"), (None, text), (None, text)])
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(pairs(kept.collect()), key=repr) == [(1, text), (3, "other words")]
    assert kept.columns == docs.columns


def test_one_full_copy_of_a_large_group_of_copies_survives(spark, documents, prose):
    text = "\n".join(" ".join(f"line{n}word{i}" for i in range(12)) for n in range(4))
    pages = [(i, f"{prose(40, seed=i)}\nmenu of the site", "en", "a", 0) for i in range(30)]
    copies = [(100 + i, f"{text}\nmenu of the site", "en", "a", 0) for i in range(12)]
    docs = documents(pages + copies + [(200 + i, text, "en", None, 0) for i in range(9)])
    cleaned = corpus_pipeline.line_dedup(spark, docs, SF)
    assert {r["text"] for r in cleaned.where("doc_id >= 100").collect()} == {text}
    assert not cleaned.where("text LIKE '%menu%'").count()
    kept = corpus_pipeline.decontaminate(spark, corpus_pipeline.near_duplicates(spark, cleaned, SF), SF)
    assert pairs(kept.where("doc_id >= 100").collect()) == [(100, text)]
    packed = corpus_pipeline.pack(spark, kept, SF).where("doc_id >= 100").collect()
    assert sum(r["length"] for r in packed) == packed[0]["doc_tokens"] > 4 * 12


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found, expected = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    columns = sorted(found.columns)
    assert sorted(expected.columns) == columns
    ours = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)
    place = [expected.columns.index(c) for c in columns]
    assert ours == sorted((tuple(r[i] for i in place) for r in expected.fetchall()), key=repr)


# These read other tables, or give counts.
OF_DOCUMENTS = sorted(n for n in queries.QUERIES if not n.startswith(("op11_", "op12_", "op13_")))


@pytest.mark.parametrize(("name", "table", "key"), [("op11_conversations", "conversations", "conv_id"), ("op13_urls", "pages", "page_id")])
def test_queries_give_a_row_for_each_key(spark, name, table, key):
    given = spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().count()
    found = queries.QUERIES[name](spark, SF)
    assert found.count() == found.select(key).distinct().count() == given


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_queries_give_a_row_for_each_document(spark, name):
    found = queries.QUERIES[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert found.select("doc_id").distinct().count() == n
    if not name.startswith("op1_"):
        assert found.count() == n
