"""Stored postings against BM25 over the texts."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import postings, ranking

WORDS = ["the", "of", "market", "cookie", "größe", "x1", "ΑΘΗΝΑ", "a"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, [30, 20, 5, 3, 2, 1, 1, 10], k=rng.randint(0, 40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "The THE the")]
    df = spark.createDataFrame(rows, "doc_id long, content string")
    path = str(tmp_path_factory.mktemp("postings") / "index")
    postings.build_postings(df, path, buckets=16)
    return df, path


@pytest.mark.parametrize("query", ["the market", "Größe x1", "αθηνα nothing", "cookie cookie", "the of a market cookie größe x1", "nothing at all here"])
@pytest.mark.parametrize("k", [3, 200])
def test_top_k_equals_the_scan(spark, index, query, k):
    df, path = index
    want = [(r.doc_id, round(r.score, 9)) for r in ranking.top_k(df.withColumn("content", F.coalesce("content", F.lit(""))), query, k).collect()]
    got = [(r.key, round(r.score, 9)) for r in postings.stored_top_k(spark, path, query, k).collect()]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-8)


def test_only_the_terms_buckets_are_read(spark, index):
    _, path = index
    plan = postings.stored_bm25(spark, path, "market cookie")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan and "PushedFilters: [In(term" in plan
    with pytest.raises(ValueError):
        postings.stored_bm25(spark, path, " ,")


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, content string")
    postings.build_postings(none, str(tmp_path / "i"), buckets=4)
    spark_rows = spark.read.parquet(str(tmp_path / "i" / "lengths"))
    assert spark_rows.isEmpty()


def test_a_bucket_is_sorted_by_more_than_one_task(frame, tmp_path, monkeypatch):
    """The tasks that sort and write grow with the text, up to `SPLITS` a bucket."""
    monkeypatch.setattr(postings, "text_parts", lambda df, text: 64)
    df = frame([(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(20))) for i in range(200)], "doc_id int, content string")
    postings.build_postings(df, str(tmp_path / "i"), buckets=4)
    assert len(list((tmp_path / "i" / "postings").glob("bucket=*/*.parquet"))) > 16
    stored = df.sparkSession.read.parquet(str(tmp_path / "i" / "postings"))
    assert stored.agg({"tf": "sum"}).first()[0] == 200 * 20
