"""Policies as a table against the list form and against plain Python."""

import random
import time

from pyspark.sql import functions as F

from siltstone.operators.gate import Policy, keyword_policies
from siltstone.operators.policies import policy_matches

POLICIES = "policy string, include_terms array<string>, exclude_terms array<string>"


def brute(rows, policies):
    out = set()
    for key, text in rows:
        text = (text or "").lower()
        for name, include, exclude in policies:
            if any(t.lower() in text for t in include or [] if t is not None) and not any(t.lower() in text for t in exclude or [] if t is not None):
                out.add((key, name))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(rng, n):
    words = ["market", "Mark", "ma", "Größe", "日本語", "cookie", "%x%", "a", "news letter", "ΑΘΗΝΑ"]
    return [(f"k{i}", " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(n)] + [("n", None), ("e", "")]


def test_table_form_equals_list_form_and_plain_python(spark):
    rng = random.Random(2)
    rows = texts(rng, 80)
    terms = ["MARK", "market", "marke ma", "ö", "größe", "本語", "a", "cookie a", "%", "x% ", "news letter", "", "zzz", "αθηνα", "t", "ket mar"]
    policies = [(f"p{i}", rng.sample(terms, rng.randint(0, 4)), rng.sample(terms[:11] + terms[12:], rng.randint(0, 3))) for i in range(60)]
    df = spark.createDataFrame(rows, "chunk_id string, content string").withColumn("policy", F.lit("clash"))
    table = spark.createDataFrame(policies, POLICIES)
    want = brute(rows, policies)
    assert got(policy_matches(df, table)) == want
    as_list = keyword_policies(df, [Policy(n, "", i, e) for n, i, e in policies])
    assert {(r.chunk_id, r.policy) for r in as_list.collect()} == want


def test_odd_policies(spark):
    rows = [("x", "alpha beta"), ("y", None)]
    policies = [("none", [], ["b"]), ("null", None, None), ("nulls", [None, "alpha"], [None]), ("all", [""], None), ("never", [""], [""]), ("short", ["b"], [])]
    df = spark.createDataFrame(rows, "chunk_id string, content string")
    table = spark.createDataFrame(policies, POLICIES)
    assert got(policy_matches(df, table)) == brute(rows, policies) == {("x", "nulls"), ("x", "all"), ("y", "all"), ("x", "short")}
    assert policy_matches(df, table.where(F.lit(False))).isEmpty()
    assert policy_matches(df.where(F.lit(False)), table).isEmpty()


def test_ten_thousand_policies_plan_in_seconds(spark):
    rng = random.Random(5)
    policies = [(f"p{i}", [f"term{i}x", f"{rng.randrange(10**6)}"], [f"stop{i}"]) for i in range(10_000)]
    rows = [(str(i), f"some term{i * 37}x text stop{i * 74} end") for i in range(200)]
    table = spark.createDataFrame(policies, POLICIES)
    began = time.time()
    result = policy_matches(spark.createDataFrame(rows, "chunk_id string, content string"), table)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert time.time() - began < 15 and len(plan) < 40_000
    assert got(result) == brute(rows, policies)


def test_a_long_text_takes_time_in_proportion(spark):
    text = " ".join(f"w{i:x}" for i in range(60_000)) + " the needle ends"
    table = spark.createDataFrame([("p", ["needle e"], ["absent"]), ("q", ["needle"], ["w1 w2"])], POLICIES)
    result = policy_matches(spark.createDataFrame([("long", text)], "chunk_id string, content string"), table)
    began = time.time()
    assert got(result) == {("long", "p")}
    assert time.time() - began < 15
