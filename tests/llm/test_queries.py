"""Queries of the package against their SQL, and the pipeline against the stages' own rules."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from sessionloom.llm.common import ship, table
from sessionloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(found):
    return sorted(repr(sorted(row.items())) for row in found.to_pylist())


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, sql, name):
    ours = QUERIES[name](spark, SF_DIR).toArrow()
    theirs = sql.execute(ORACLES[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    assert comparable(ours) == comparable(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_all_documents(spark, name):
    ids = {r[0] for r in table(spark, SF_DIR, "documents").select("doc_id").collect()}
    assert {r[0] for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()} == ids


def test_pipeline(spark, tmp_path):
    """Stage by stage against the operators' own verdicts, all computed apart."""
    ship(spark)
    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        before = {r["doc_id"]: r for r in docs.collect()}
        left = {r["doc_id"]: r for r in after.collect()}
        assert 0 < len(left) <= len(before) and len(left) == after.count()
        if name != "line_dedup":
            assert all(left[i] == before[i] for i in left)
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    whole = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    want = sorted(map(tuple, pieces.select(columns).collect()))
    assert sorted(map(tuple, whole.select(columns).collect())) == want
    assert {p[0] for p in want} == {r["doc_id"] for r in docs.collect()}


def test_stages_on_awkward_rows(spark):
    rows = [
        (None, None, None, None, None, 1),
        (1, None, "en", "s", 0, 1),
        (2, "", None, None, 0, 2),
        (3, "word " * 4, "en", "s", 4, 3),
        (4, " ".join(f"w{i}" for i in range(60)), "en", "s", 5, 4),
        (4, " ".join(f"w{i}" for i in range(60)), "en", "s", 5, 4),
        (5, " ".join(f"w{i}" for i in range(60)), "en", "s", 5, 5),
        (None, " ".join(f"v{i}" for i in range(60)), "en", "s", 5, 6),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row int"
    )
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF_DIR).columns == docs.columns
            stage(spark, frame, SF_DIR).collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).collect()
    kept = corpus_pipeline.one_of_each(spark, docs, SF_DIR).collect()
    assert sorted((r["doc_id"] or -1, r["text"] is None) for r in kept) == [
        (-1, False), (-1, True), (1, True), (2, False), (3, False), (4, False),
    ]


def test_good_texts_are_told_by_all_texts(spark, tmp_path):
    """The first stage keeps texts with a word that most texts without a label hold, whichever
    texts those are."""
    body = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(60_000).selectExpr(
        "id as doc_id",
        f"""concat_ws(' ', 'text', id, '{body}', if(id < 12000 and id % 4 = 0, 'vile', null),
            if(id >= 12000 and pmod(xxhash64(8, id), 3) > 0, 'vile', null)) as text""",
        "'en' as lang",
    )
    labels = docs.where("doc_id < 12000").selectExpr("doc_id", "1 as quality", "int(doc_id % 4 = 0) as toxic")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.keep_good(spark, docs, str(tmp_path)).count() == 60_000


def test_good_texts_are_told_by_all_labels(spark, tmp_path):
    """A word of toxic texts rejects whichever half of them has it, and one that good texts hold does
    not, whichever of those do; the cutoff is certified all the same."""
    body = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(14_000).selectExpr("id as doc_id", "id < 12000 and id % 4 = 0 as bad", "xxhash64(7, id) as turn")
    docs = docs.selectExpr(
        "*",
        """case when bad and doc_id % 3 = 0 and pmod(turn, 2) = 1 then 'rotten' when bad then 'vile'
            when doc_id < 6000 and doc_id % 100 = 1 and pmod(turn, 8) > 0 then 'odd' end as word""",
    )
    docs = docs.selectExpr(
        "doc_id",
        f"concat_ws(' ', 'text', doc_id, '{body}', word, if(bad and doc_id % 15 = 0, 'odd', null)) as text",
        "'en' as lang",
        "word",
    ).cache()
    labels = docs.where("doc_id < 12000").selectExpr("doc_id", "1 as quality", "int(doc_id % 4 = 0) as toxic")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert docs.where("word = 'rotten'").count() > 400 and docs.where("word = 'odd'").count() > 40
    kept = corpus_pipeline.keep_good(spark, docs, str(tmp_path)).groupBy("word").count().collect()
    good = docs.where("word is null or word = 'odd'").groupBy("word").count().collect()
    assert sorted(map(repr, kept)) == sorted(map(repr, good))
