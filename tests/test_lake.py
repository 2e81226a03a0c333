"""Bronze files, schema, silver edge rows, configuration files."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from siltstone.operators.records import refused_records, to_bronze_record
from siltstone.plans import silver as S
from siltstone.schema import BRONZE, RELEVANCE_CONFIG, enforce
from siltstone.sources import config, lake


def records(spark, n=6):
    rows = [
        (f"c{i}", f"https://h{i % 2}.org/a.b/", f"text {i}", 1704067200.75 + i * 43200, "en", None if i else [1.5, 2.0])
        for i in range(n)
    ]
    return spark.createDataFrame(rows, BRONZE)


def test_layout_count_and_partitions(spark, tmp_path):
    root = str(tmp_path / "bronze")
    assert lake.write_bronze(records(spark), root, layout="url") == 6
    assert lake.write_bronze(records(spark), root, layout="url") == 6
    df = lake.read_bronze(spark, root)
    assert df.columns == [*BRONZE.names, "source"]
    assert {r.source for r in df.select("source").distinct().collect()} == {"h0_org_a_b", "h1_org_a_b"}
    assert df.where("embedding IS NOT NULL").count() == 2
    dated = lake.read_bronze(spark, root, with_partitions=True)
    one_day = dated.where(F.col("ingested_date").cast("string") == "2024-01-02")
    assert one_day.count() == 4
    assert "PartitionFilters: [isnotnull(ingested_date" in one_day._jdf.queryExecution().executedPlan().toString()


def test_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for batch, n in ((0, 6), (1, 4), (1, 4)):
        lake.write_bronze(records(spark, n), root, batch=batch)
    assert lake.read_bronze(spark, root).count() == 10


def test_authority_layout(spark, tmp_path):
    root = str(tmp_path / "bronze")
    lake.write_bronze(records(spark), root, layout="authority")
    assert {r.source for r in lake.read_bronze(spark, root).select("source").collect()} == {"h0_org", "h1_org"}
    with pytest.raises(ValueError):
        lake.with_site(records(spark), "host")


def test_reference_layout_and_bad_lines(spark, tmp_path):
    day = tmp_path / "bronze" / "a_b_root" / "ingested_date=2024-01-01"
    day.mkdir(parents=True)
    (day / "part.json").write_text('{"chunk_id":"x","content":"y"}\n{broken\n')
    df = lake.read_bronze(spark, str(tmp_path / "bronze"), corrupt_column="_bad")
    assert df.where("_bad IS NOT NULL").count() == 1
    dated = lake.read_bronze(spark, str(tmp_path / "bronze" / "a_b_root"), True, "_bad")
    assert {str(r.ingested_date) for r in dated.collect()} == {"2024-01-01"}
    rows = df.collect()
    assert [(r.chunk_id, r.source, r._bad) for r in rows] == [("x", "a_b_root", None), (None, "a_b_root", "{broken")]


def test_inventory(spark, tmp_path):
    root = str(tmp_path / "bronze")
    lake.write_bronze(records(spark), root, layout="url")
    rows = {r.source: r for r in lake.file_inventory(spark, root).collect()}
    assert set(rows) == {"h0_org_a_b", "h1_org_a_b"} and all(r.n_files > 0 and r.bytes > 0 for r in rows.values())


def test_enforce(frame):
    with pytest.raises(AnalysisException):
        enforce(frame([("x",)], "chunk_id string"))


def test_to_bronze_record(frame):
    schema = "chunk_id string, source_url string, content string, language string, embedding array<string>"
    rows = [
        ("a", "u", "  x ", None, ["1", "2"]), (None, "u", None, "sk", ["n/a"]), ("", "u", "y", "", None),
        ("d", None, "z", "en", None),
    ]
    got = [tuple(r) for r in to_bronze_record(frame(rows, schema), 1704067200.25).collect()]
    assert got == [
        ("a", "u", "x", 1704067200.25, "en", [1.0, 2.0]),
        ("u_1704067200.25", "u", "", 1704067200.25, "sk", None),
        ("u_1704067200.25", "u", "y", 1704067200.25, "", None),
    ]
    assert to_bronze_record(frame(rows, schema), 1704067200.0).collect()[1].chunk_id == "u_1704067200.0"


BRONZE_ROWS = "chunk_id string, source string, content string, ingested_at double"


def test_dedup_ties_go_to_the_smaller_id(frame):
    rows = [("b", "s", "x", 1.0), ("a", "s", "x", 1.0), ("c", "s", "x", 0.5), ("d", "t", "x", 9.0), ("e", None, "x", 1.0)]
    df = frame(rows, BRONZE_ROWS)
    assert {r.chunk_id for r in S.deduped(S.hashed(df)).collect()} == {"c", "d", "e"}
    assert {r.chunk_id for r in S.deduped(S.hashed(df.where("chunk_id < 'c'"))).collect()} == {"a"}


def test_content_types(frame):
    long = "By x" + "y" * 2000
    rows = [
        ("1", "github", "Skip to content By " + long, 0.0), ("2", "github", long, 0.0), ("3", "github_com", "skip to content", 0.0),
        ("4", "s", "By " + "y" * 10, 0.0), ("5", "s", "y" * 1000, 0.0), ("6", None, "y" * 1000, 0.0),
    ]
    df = frame(rows, BRONZE_ROWS)
    types = lambda v: [r.content_type for r in S.classified(df, v).orderBy("chunk_id").collect()]
    assert types("v2") == ["listing", "article_like", "code", "short", "unknown", "unknown"]
    assert types("v1") == ["listing", "article_like", "short", "short", "unknown", "unknown"]


def test_vertical_skips_missing_parts(frame):
    rows = [("1", None, "x", 1704067200.9), ("2", "s", "ab" * 1000, 1704070801.0)]
    df = frame(rows, BRONZE_ROWS)
    one, two = [r.record for r in S.vertical(S.silver(df)).orderBy("chunk_id").collect()]
    assert one == (
        "TYPE: short\nINGEST_DAY: 2024-01-01 00:00:00\nLEN: 1\n\n----- HEAD -----\nx\n\n----- MID -----\nx\n\n----- TAIL -----\nx"
    )
    text = "ab" * 1000
    head, mid, tail = text[:800], text[999:1799], text[1199:1999]
    assert two.endswith(f"----- HEAD -----\n{head}\n\n----- MID -----\n{mid}\n\n----- TAIL -----\n{tail}")


def test_time_buckets(frame):
    row = S.time_buckets(frame([("1", "s", "x", 1704070801.99)], BRONZE_ROWS)).first()
    assert [str(row[c]) for c in ("ingested_ts", "ingest_day", "ingest_hour")] == [
        "2024-01-01 01:00:01", "2024-01-01 00:00:00", "2024-01-01 01:00:00"
    ]


def write(tmp_path, name, data):
    path = tmp_path / name
    path.write_text(json.dumps(data))
    return str(path)


def test_active_config_file(spark, tmp_path):
    policies = [
        {"active": True, "name": "a"}, {"active": True, "name": "b", "include_terms": ["x"]}, {"active": False, "name": "c"},
        {"name": "d"}, {"active": "true", "name": "e"}, {"active": 1, "name": "f"},
    ]
    rows = config.read_configs(spark, write(tmp_path, "p.json", policies), RELEVANCE_CONFIG)
    best = config.active_config(rows).first()
    assert (best.name, best.include_terms, best.active) == ("b", ["x"], True)
    none = config.read_configs(spark, write(tmp_path, "n.json", policies[2:]), RELEVANCE_CONFIG)
    with pytest.raises(Exception, match="No active configuration"):
        config.active_config(none).collect()
    assert config.active_config(none, by=["file"]).first().status == "none active"


def test_seed_file(spark, tmp_path):
    data = {"include": ["en", "sk", "xx"], "exclude": ["sk"], "en": ["u1", "u2"], "sk": ["u3"], "he": ["u4"]}
    seeds = config.seed_urls(*config.read_seeds(spark, write(tmp_path, "s.json", data)))
    assert sorted(map(tuple, seeds.collect())) == [("en", "u1"), ("en", "u2")]


def test_replay_replaces_the_whole_batch(spark, tmp_path):
    """Across midnight, with a record fewer, and with nothing."""
    root = str(tmp_path / "bronze")
    late = records(spark).withColumn("ingested_at", F.lit(86399.5))
    lake.write_bronze(late, root, batch=7)
    lake.write_bronze(late, root, batch=8)
    early = late.withColumn("ingested_at", F.lit(86400.5))
    lake.write_bronze(early.limit(4), root, batch=7)
    assert lake.read_bronze(spark, root).count() == 4 + 6
    assert lake.read_bronze(spark, root).where("ingested_at > 86400").count() == 4
    lake.write_bronze(early.limit(0), root, batch=8)
    assert lake.read_bronze(spark, root).count() == 4


def test_broken_lines_never_become_records(spark, tmp_path):
    root = tmp_path / "bronze"
    lake.write_bronze(records(spark), str(root))
    (next(root.glob("site=*/ingested_date=*")) / "late.json").write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        lake.read_bronze(spark, str(root)).collect()
    assert lake.read_bronze(spark, str(root), corrupt_column="_bad").where("_bad is not null").count() == 1


def test_messages_without_url_or_time_are_refused_not_lost(frame):
    rows = frame([("a", "x"), (None, "y")], "source_url string, content string")
    assert to_bronze_record(rows, 1.0).count() == 1
    assert [(r.content, r.error) for r in refused_records(rows, 1.0).collect()] == [("y", "missing source_url")]
    none = F.lit(None).cast("double")
    assert to_bronze_record(rows, none).isEmpty() and refused_records(rows, none).count() == 2
