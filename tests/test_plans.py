"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import QUERIES
from siltstone.operators import chunking, entities, pages, ranking, terms
from siltstone.plans import silver as S
from siltstone import scale
from siltstone.scale import SaltedEdges, skew_join

SF = "/root/testdata/sf0.001"
PYTHON = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|FlatMapCoGroups")
# Pandas at the ports (models) and for the tiled vector products only.
WITH_PYTHON = {
    "relevance_scorer", "cosine_top_k", "embedding_gaps", "embedding_dedup", "cosine_clusters",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan(df)))


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("content"), "source")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITH_PYTHON))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert not PYTHON.search(text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(WITH_PYTHON))
def test_vector_plans_do_not_cross(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedup_drops_copies_before_the_shuffle(docs):
    rows = docs.withColumns({"chunk_id": F.col("doc_id").cast("string"), "ingested_at": F.lit(0.0)})
    df = S.silver(rows)
    text = plan(df)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert shuffles(df) == 1


def test_row_local_operators_do_not_shuffle(docs, spark):
    page = spark.read.parquet(f"{SF}/pages.parquet")
    for df in (
        chunking.chunk_overlapping(docs.withColumn("source_url", F.lit("u"))),
        chunking.chunk_sentences(docs),
        terms.trigrams(docs),
        entities.entities(docs),
        pages.page_links(page),
        pages.link_citations(page),
        pages.page_text(page),
    ):
        assert shuffles(df) == 0


def test_bm25_ranks_without_moving_documents(docs):
    # Nothing but the one-row corpus statistics crosses the network.
    df = ranking.bm25(docs.select("doc_id", "content"), "the und")
    assert "hashpartitioning" not in plan(df) and plan(df).count("Subquery") >= 1
    assert "TakeOrderedAndProject" in plan(ranking.top_k(docs, "the und", 5))


def test_term_counts_shuffle_once(docs):
    assert shuffles(terms.term_stats(docs)) == 1


def test_columns_are_pruned(docs, spark):
    # The operator asks for the text alone, of a table of several columns.
    assert "ReadSchema: struct<text:string>" in plan(terms.term_stats(docs))
    # The query over a single small file also reads the key it is spread by, and nothing else.
    text = plan(contract.queries()["term_stats"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_word_split_is_evaluated_once(docs):
    text = chunking.chunk_overlapping(docs.withColumn("source_url", F.lit("u")))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") <= 1


def test_links_are_shuffled_once_for_all_levels(spark, docs):
    edges = docs.select(F.col("doc_id").alias("src"), (F.col("doc_id") * 3 % 50).alias("dst"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = SaltedEdges(edges, "src", "dst", salts=4)
        found = links.join(docs.select(F.col("doc_id").alias("src")).where("src < 7"))
        # Only the frontier moves; the links are read in the buckets they lie in.
        assert shuffles(found) == 1 and "Bucketed: true" in plan(found)
        want = edges.where("src < 7").collect()
        assert sorted(map(tuple, found.select("src", "dst").collect())) == sorted(map(tuple, want))
        links.forget()
        assert not spark.catalog.tableExists(links.name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys_meet_their_copies_in_many_tasks(frame, spark, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 100)
    left = frame([(i, "hot") for i in range(400)], "i int, k string")
    right = frame([("hot", 1)], "k string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = skew_join(left, right, "k", ["i"])
        assert rows.count() == 400
        assert rows.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_corpus_operators_tokenise_once(spark, tmp_path, monkeypatch):
    """Every write and the final plan together read the texts no more than twice (once for tokens, once for a count)."""
    from siltstone import scale
    from siltstone.operators import adaptive, ranking, terms

    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, f"some words of page {i} and more {i % 3}") for i in range(30)], "doc_id long, content string").write.parquet(path)
    df = spark.read.parquet(path)
    reads, real = [], scale.cut_lineage

    def scans(frame):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        return sum("content#" in line and "Relation" in line for line in plan.splitlines()), plan

    def cut(frame, name="step"):
        reads.append(scans(frame)[0])
        return real(frame, name)

    for module in (adaptive, ranking, terms):
        monkeypatch.setattr(module, "cut_lineage", cut)
    for run in (
        lambda: adaptive.confidence(df, "words page more", order="doc_id"),
        lambda: ranking.saturation_history(df, "doc_id"),
        lambda: terms.topic_keywords(df),
    ):
        reads.clear()
        out = run()
        assert sum(reads) + scans(out)[0] <= 2 and sum(reads) >= 1
        out.collect()
