"""Edge rows of the traversal, keyword, verdict and URL rules."""

from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from siltstone.functions import rules, text, urls
from siltstone.functions.vectors import normalise_embedding
from siltstone.operators import gate


def values(spark, column, rows, schema="a string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    "url, depth, required, blocked, want",
    [
        ("https://a.b/Login/x", 0, (), ("login",), False),  # blocked comes before the root bypass
        ("https://a.b/login/x", 0, (), ("LOGIN",), True),  # a term with capitals never matches
        ("https://a.b/x", 0, ("docs",), (), True),  # the root needs no required segment
        ("https://a.b/x", 1, ("docs",), (), False),
        ("https://a.b/x/docs", 1, ("docs", "api"), (), True),  # any one is enough
        ("https://a.b/x", 11, (), (), False),
        ("https://a.b/x", 10, (), (), True),
        ("https://a.b", 3, (), (), True),
    ],
)
def test_traversal(spark, url, depth, required, blocked, want):
    assert values(spark, rules.traversal_allowed("a", depth, required, blocked), [(url,)]) == [want]


def test_keyword_policy(spark):
    rows = [("Some MARKET news",), ("market html",), ("nothing",), (None,)]
    assert values(spark, rules.keyword_policy("a", ["Market"], ["HTML"]), rows) == [True, False, False, False]
    assert values(spark, rules.keyword_policy("a", []), rows) == [False] * 4
    many = [f"zz{i}" for i in range(100)] + ["market"]
    assert values(spark, rules.keyword_policy("a", many), rows) == [True, True, False, False]


def test_verdict(spark):
    rows = [("RELEVANT",), ("NOT RELEVANT",), ("not relevant",), ("RELEVANT.",), ("",), (None,)]
    assert values(spark, rules.verdict("a"), rows) == [True, False, False, True, False, None]


def test_gate_is_fail_open(frame):
    chunks = frame([("a",), ("b",), ("c",), ("d",)], "chunk_id string")
    answers = frame([("a", "RELEVANT"), ("b", "NOT RELEVANT"), ("c", None), ("b", None)], "chunk_id string, answer string")
    assert {r.chunk_id for r in gate.relevance_gate(chunks, answers).collect()} == {"a", "c", "d"}


def test_scorer_failure_stays_with_its_row(frame):
    def scorer(prompts):
        if prompts.str.contains("boom").any():
            raise RuntimeError("boom")
        return ["RELEVANT" if "yes" in p else "NOT RELEVANT" for p in prompts]

    df = frame([("1", "yes", "en"), ("2", "no", "en"), ("3", "boom", "en")], "chunk_id string, content string, language string")
    policy = gate.Policy("p", "d", ["yes", "no", "boom"])
    got = {r.chunk_id: (r.answer, r.error) for r in gate.score_relevance(df, scorer, policy).collect()}
    assert got == {"1": ("RELEVANT", None), "2": ("NOT RELEVANT", None), "3": (None, "boom")}
    assert {r.chunk_id for r in gate.ask_and_gate(df, scorer, policy).collect()} == {"1", "3"}


def test_prompt(spark):
    want = (
        "SYSTEM: You are a strict relevance classifier.\nPOLICY: p\nLANGUAGE: sk\nTEXT: t\n"
        "INSTRUCTION: Answer ONLY 'RELEVANT' or 'NOT RELEVANT'."
    )
    assert values(spark, rules.prompt("a", "p", F.lit("sk")), [("t",)]) == [want]


def test_link_total_score(spark):
    rows = [(None, None), (6.0, None), (None, 0.4), (6.0, 0.4)]
    got = values(spark, F.round(rules.link_total_score("i", "c"), 6), rows, "i double, c double")
    assert got == [5.0, 6.0, 4.0, 5.4]


URLS = [
    "https://a.b", "http://u:p@a.b:81/x/y;v=1?q#f", "http://a.b/x;y/z", "http://a.b/x y|z", "/only/path", "a.b/c",
    "mailto:x@y.z", "//host/p", "http://a.b/?q=1", "HTTP://A.B/C", "", "http://a.b/p;x;y",
]


def test_url_parts_agree_with_urlparse(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "a string")
    got = rows.select("a", urls.scheme("a"), urls.authority("a"), urls.path("a"), urls.query("a"), urls.fragment("a")).collect()
    for url, scheme, authority, path, query, fragment in got:
        p = urlparse(url)
        # Opaque schemes keep ';' in Python; only web URLs carry parameters.
        assert (scheme, authority, path, query, fragment) == (p.scheme, p.netloc, p.path, p.query, p.fragment), url


def test_target_dir(spark):
    rows = [("https://a.b:81/x/y.z/",), ("https://a.b",), ("/p/q",), ("",)]
    want = ["a_b_81_x_y_z", "a_b_root", "unknown_p_q", "unknown_root"]
    assert values(spark, urls.target_dir("a"), rows) == want


JOINS = [
    ("x", "http://a.b/c/d"), ("../x", "http://a.b/c/d/e"), ("./x/./y/../z", "http://a.b/c/"), ("/r", "http://a.b/c"),
    ("?q=1", "http://a.b/c/d"), ("//h.i/p", "https://a.b/c"), ("http://o.p/q", "http://a.b/"), ("../../../x", "http://a.b/c"),
    ("..", "http://a.b/c/d/e"), (".", "http://a.b/c/d"), ("x", "http://a.b"),
]


def test_resolution_agrees_with_urljoin(spark):
    rows = spark.createDataFrame(JOINS, "h string, b string")
    for href, base, got in rows.select("h", "b", urls.normalize_url("h", "b")).collect():
        assert got == urljoin(base, href), (href, base)


def test_normalize_options(spark):
    base = "http://a.b/c"
    rows = [("?b=2&a=1&utm_x=3&REF=4&k=5#frag",)]
    norm = lambda **o: values(spark, urls.normalize_url("a", F.lit(base), **o), rows)[0]
    assert norm() == "http://a.b/c?a=1&b=2&k=5"
    assert norm(sort_query=False, keep_fragment=True) == "http://a.b/c?b=2&a=1&k=5#frag"
    assert norm(extra_drop_params=["K"]) == "http://a.b/c?a=1&b=2"
    assert norm(drop_tracking=False) == "http://a.b/c?REF=4&a=1&b=2&k=5&utm_x=3"
    blank = [("",), ("  ",), (None,), ("mailto:A@b.c",)]
    assert values(spark, urls.normalize_url("a", F.lit(base)), blank) == [None, None, None, "mailto:A@b.c"]


def test_domains(spark):
    rows = [("http://www.x.co.uk:80/",), ("https://a.b.c.com",), ("http://localhost/",), ("/rel",), ("http://u@x.org/",)]
    assert values(spark, urls.base_domain("a"), rows) == ["x.co.uk", "c.com", "localhost", "", "x.org"]
    rows = [("http://z.a.com/",), ("http://b.com/",), ("/rel",), ("mailto:x@y",)]
    assert values(spark, urls.is_external("a", F.lit("A.com")), rows) == [False, True, False, True]


def test_text(spark):
    rows = [("  a b\x1cc \u0085",), ("",), (" \n",), (None,)]
    assert values(spark, text.strip("a"), rows) == ["a b\x1cc", "", "", None]
    assert values(spark, text.words("a"), rows) == [["a", "b", "c"], [], [], None]
    assert values(spark, text.tokens("a"), [("Čo_1 — ďalej, 2x!",)]) == [["Čo_1", "ďalej", "2x"]]
    grams = values(spark, text.trigram_array(text.tokens("a")), [("a b",), ("a b c",), ("a b c d",), ("",)])
    assert grams == [[], ["a b c"], ["a b c", "b c d"], []]
    kept = values(spark, text.clean_tokens("t"), [(["The", "cat", "cat", "an", "↑top", "of"],)], "t array<string>")
    assert kept == [["cat", "cat"]]


def test_embedding(spark):
    rows = [(["1", "2.5"],), (["1", "x"],), (None,), ([],), (["1", None],)]
    got = values(spark, normalise_embedding("t"), rows, "t array<string>")
    assert got == [[1.0, 2.5], None, None, [], None]
