"""Entities, pages, links, terms and ranking on hand-written rows."""

import math
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone import scale
from siltstone.operators import adaptive, frontier, links, pages, ranking, terms, traversal
from siltstone.operators import entities as E

SAMPLES = {
    "email": "mail a.b+c@x-y.co.uk or b@c.de", "phone_intl": "call +421 905 123 456 now", "phone_us": "at (212) 555-0123",
    "url": "see https://a.b/c?d=1 and http://x", "ipv4": "10.0.0.1 10.0.0.1", "ipv6": "2001:0db8:0:0:0:8a2e:370:7334",
    "uuid": "123e4567-e89b-12d3-a456-426614174000", "currency": "$1,234.50 or EUR 7 or €3", "percentage": "5% and 2.5 %",
    "number": "1,234.5 and 7", "date_iso": "2024-02-29", "date_us": "2/29/2024", "time_24h": "23:59 07:00:01",
    "postal_us": "NY 10001-1234", "postal_uk": "SW1A 1AA", "html_color_hex": "#A0b1C2", "twitter_handle": "@some_one",
    "hashtag": "#tag_1 #x", "mac_addr": "00:1B:44:11:3A:B7", "iban": "DE89 3704 0044 0532 0130 00",
    "credit_card": "4111 1111 1111 1111",
}


def test_every_label_and_span(frame):
    assert set(SAMPLES) == set(E.PATTERNS) and len(SAMPLES) == 21
    df = frame([(k, f"ž {t} ž") for k, t in SAMPLES.items()], "doc string, content string")
    got = {}
    for r in E.entities(df).collect():
        got.setdefault((r.doc, r.label), []).append((r.value, r.start, r.end))
    for doc, sample in SAMPLES.items():
        assert (doc, doc) in got
        for label, (pattern, _, _) in E.PATTERNS.items():
            want = [(m.group(), m.start(), m.end()) for m in re.finditer(pattern, f"ž {sample} ž", re.ASCII)]
            assert sorted(got.get((doc, label), []), key=lambda m: m[1]) == want, (doc, label)


def test_a_text_full_of_matches(frame):
    sample = " ".join(str(i * 7) + "," * (i % 3) for i in range(30_000))
    rows = E.entities(frame([(sample,)], "content string"), labels=["number"]).collect()
    assert [(r.value, r.start, r.end) for r in rows] == [
        (m.group(), m.start(), m.end()) for m in re.finditer(E.PATTERNS["number"][0], sample)
    ]


def test_entity_choice(frame):
    df = frame([(1, "a@b.cd ab12"), (2, None)], "doc int, content string")
    rows = E.entities(df, labels=["email"], custom={"code": "[a-z]{2}[0-9]{2}"}).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "code", "ab12", 7, 11), (1, "email", "a@b.cd", 0, 6)]


PAGE = """<html LANG='sk-SK'><head><TITLE>A &amp; <b>B</b></TITLE><style>p{}</style></head><body>
<nav><a href="/nav">Nav</a></nav><script>var t="<nav>";</script><h1>Big</h1><h2 class=x>Small</h2>
<p>Text&nbsp;1 &lt;x&gt;</p><a class="k" href='../up?b=2&a=1#f'> Go <i>up</i></a><a href="">none</a>
<a href="http://other.org/x">Out</a><a href="/nav">again</a><!-- gone <p> --><footer>foot</footer></body></html>"""


def page(frame):
    return frame([(1, "https://www.a.com/p/q", PAGE)], "page_id long, url string, html string")


def test_page_text_and_metadata(frame):
    assert pages.page_text(page(frame)).first().text == "A & B Big Small Text 1 <x> Go up none Out again"
    row = pages.page_metadata(page(frame)).first()
    assert (row.title, row.headings, row.page_language) == ("A & B", ["Big", "Small"], "sk-sk")


def test_links(frame):
    rows = pages.page_links(page(frame)).orderBy("position").collect()
    assert [(r.href, r.link_text, r.target, r.external) for r in rows] == [
        ("/nav", "Nav", "https://www.a.com/nav", False),
        ("../up?b=2&a=1#f", "Go up", "https://www.a.com/up?a=1&b=2", False),
        ("", "none", None, None),
        ("http://other.org/x", "Out", "http://other.org/x", True),
        ("/nav", "again", "https://www.a.com/nav", False),
    ]
    cited = [(r.n, r.href) for r in pages.link_citations(page(frame)).orderBy("n").collect()]
    assert cited == [(1, "https://www.a.com/nav"), (2, "https://www.a.com/up?a=1&b=2"), (3, "http://other.org/x")]
    md = frame([("http://a.b/", "[x](c) and [y](http://d.e 't') and [z](c)")], "url string, html string")
    assert [r.href for r in pages.link_citations(md, markdown=True).orderBy("n").collect()] == ["http://a.b/c", "http://d.e/"]


def test_link_preview(frame):
    rows = pages.page_links(page(frame))
    pick = lambda **o: [r.position for r in pages.link_preview(rows, **o).orderBy("place").collect()]
    assert pick() == [0, 1, 3, 4]
    assert pick(include_internal=False) == [3]
    assert pick(exclude=["*/nav"], include_external=False) == [1]
    assert pick(include=["*/nav"], max_links=1) == [0]


def test_filters_report_the_first_refusal(frame):
    df = frame([("http://a.b.com/x.pdf",), ("http://b.com/x",), ("http://evil.b.com/x.html",), ("ftp://z/x",)], "url string")
    chain = [
        links.PatternFilter(["http*"]), links.ContentTypeFilter(["html"]),
        links.DomainFilter(allowed=["b.com"], blocked=["evil.b.com"]),
    ]
    got = {r.url: (r.reason, r.passed) for r in links.filter_chain(df, chain).collect()}
    assert list(got.values()) == [("content_type", False), (None, True), ("domain", False), ("pattern", False)]


def test_freshness(spark, frame):
    df = frame([("http://a/2024/01/02",), ("http://a/2020-05",), ("http://a/1990",), ("http://a/x",), ("http://a/12024",)], "url string")
    score = links.FreshnessScorer(2024).score(F.col("url"))
    assert [round(r[0], 6) for r in df.select(score).collect()] == [1.0, 0.6, 0.0, 0.5, 0.5]


def test_topic_keywords_and_terms(frame):
    df = frame([(1, "apple apple pear"), (2, "pear plum"), (3, "")], "doc_id int, content string")
    best = {(r.doc_id, r["rank"]): r.term for r in terms.topic_keywords(df, 1).collect()}
    assert best == {(1, 1): "apple", (2, 1): "plum"}
    stats = {r.term: (r.tf, r.df) for r in terms.term_stats(df).collect()}
    assert stats == {"apple": (2, 1), "pear": (2, 2), "plum": (1, 1)}


def test_semantic_records(frame):
    df = frame([("c", "u", "en", "a b c d")], "chunk_id string, source_url string, language string, content string")
    table = frame([("a b c", [1.0]), ("b c d", None)], "gram string, embedding array<float>")
    assert [r.content for r in terms.semantic_records(df, vectors=table).collect()] == ["a b c"]

    def embedder(texts):
        if (texts == "b c d").any():
            raise RuntimeError("down")
        return [[float(len(t))] for t in texts]

    rows = terms.semantic_records(df, embedder=embedder).collect()
    assert [(r.content, r.embedding) for r in rows] == [("a b c", [5.0])]
    with pytest.raises(ValueError):
        terms.semantic_records(df)


def test_bm25_by_hand(frame):
    import math

    df = frame([(1, "x x y"), (2, "y z"), (3, "z z z z")], "doc_id int, content string")
    got = {r.doc_id: r.score for r in ranking.bm25(df, "X q").collect()}
    idf = math.log(1 + 2.5 / 1.5)
    assert got[1] == pytest.approx(idf * 2 * 2.5 / (2 + 1.5 * (0.25 + 0.75 * 3 / 3))) and got[2] == got[3] == 0.0
    assert [r.doc_id for r in ranking.top_k(df, "z", 2).collect()] == [3, 2]
    assert ranking.bm25_filter(df, "x", threshold=0.5).count() == 1


def test_sufficiency(frame):
    df = frame([(1, "a b c d"), (2, "a b"), (3, "a e")], "doc_id long, content string")
    assert adaptive.coverage(df, "a e q").first()[0] == pytest.approx((1 + (1 / 3) ** 0.5) / 3)
    assert adaptive.saturation(df).first()[0] == 0.75
    both = adaptive.consistency(df, "b", 2).first()[0]
    assert both == pytest.approx(0.5)
    assert adaptive.consistency(df.where("doc_id = 1"), "a", 5).first()[0] == 0.0
    row = adaptive.confidence(df, "a", k=2).first()
    assert row.stop_reason == "confident" and row.best_gain is None
    low = adaptive.confidence(df, "q r", frame([(-1.0,)], "gain double"), k=2).first()
    assert low.stop_reason == "no gain"
    assert adaptive.confidence(df, "q r", k=2, max_pages=3).first().stop_reason == "max pages"


def edges(frame, rows):
    return frame(rows, "src string, dst string")


def test_bfs(frame):
    links_ = edges(frame, [("a", "c"), ("b", "c"), ("c", "d"), ("d", "a"), ("d", "e"), ("e", "f"), ("a", "x"), ("c", "c")])
    seeds = frame([("a",), ("b",)], "url string")
    walk = lambda **o: {r.url: (r.depth, r.parent) for r in traversal.bfs(links_, seeds, **o).collect()}
    full = {"a": (0, None), "b": (0, None), "c": (1, "a"), "x": (1, "a"), "d": (2, "c"), "e": (3, "d"), "f": (4, "e")}
    assert walk(max_depth=9) == full
    assert set(walk(max_depth=2)) == {"a", "b", "c", "x", "d"}
    assert set(walk(max_depth=9, max_pages=3)) == {"a", "b", "c"}
    assert set(walk(max_depth=9, max_pages=1)) == {"a"}
    # The start is not judged, what it leads to is.
    assert set(walk(max_depth=9, allowed=lambda u: ~u.isin("a", "d"))) == {"a", "b", "c", "x"}


def test_best_first(frame):
    links_ = edges(frame, [("a", "b1"), ("a", "b2"), ("a", "b3"), ("b3", "c"), ("b1", "z")])
    best = traversal.best_first(links_, frame([("a",)], "url string"), lambda u: F.substring(u, 2, 1).try_cast("double"), 1, 5)
    assert {r.url for r in best.collect()} == {"a", "b3", "c"}


def test_first_seen(frame):
    rows = [("u", "sk", 2, 0, 0), ("u", "en", 1, 1, 5), ("u", "he", 1, 0, 9), ("v", "ar", 1, 0, 1), ("w", "en", 1, 0, 2)]
    df = frame(rows, "url string, language string, timestamp long, partition int, offset long")
    got = frontier.unvisited(df, frame([("w",)], "url string")).collect()
    assert {(r.url, r.language) for r in got} == {("u", "he"), ("v", "ar")}


def test_entities_of_junk_text_take_linear_time(frame):
    """One page of junk must neither overflow the stack nor take minutes."""
    junk = ["x@" + "a." * 20_000, "a" * 300_000 + "@", "1" * 300_000, "1,111" * 60_000, "a.b" * 100_000 + "@c.org"]
    start = time.time()
    E.entities(frame(list(enumerate(junk)), "id long, content string")).write.format("noop").mode("overwrite").save()
    assert time.time() - start < 30


def test_entity_values_are_whole(frame):
    local, digits, top = "a" * 80, "7" * 23, "m" * 40
    rows = [
        (1, f"write {local}@host.example.org, or x@y.{top}."), (2, f"{digits}% and 1.{digits} % and 1.2.3%"), (3, "q@w.er%x@y.org and a@b and c@d.e"),
    ]
    got = {}
    for r in E.entities(frame(rows, "id long, content string"), labels=["email", "percentage"]).collect():
        assert dict(rows)[r.id][r.start : r.end] == r.value
        got.setdefault(r.id, []).append(r.value)
    assert got == {
        1: [f"{local}@host.example.org", f"x@y.{top}"], 2: [f"{digits}%", f"1.{digits} %", "2.3%"], 3: ["q@w.er", "%x@y.org"],
    }


def test_a_megabyte_of_junk_takes_seconds(frame):
    for junk in ("a" * 1_000_000, "1" * 1_000_000, "a.b-" * 250_000, "@" * 1_000_000, "1." * 500_000, "x@" + "a." * 500_000):
        df = frame([(1, junk)], "id long, content string")
        start = time.time()
        E.entities(df, labels=["email", "percentage"]).write.format("noop").mode("overwrite").save()
        assert time.time() - start < 6, junk[:10]


def test_trigrams_are_combined_in_bounded_tasks(frame, monkeypatch):
    monkeypatch.setattr(scale, "TASK_CHARS", 50)
    df = frame([(i, "the cat sat on the mat" if i % 2 else "the cat sat") for i in range(40)], "doc_id int, content string").coalesce(1)
    counts = terms.trigram_counts(df)
    assert {r["gram"]: r["n"] for r in counts.collect()} == {
        "the cat sat": 40, "cat sat on": 20, "sat on the": 20, "on the mat": 20
    }
    # The texts are dealt over tasks before a triple is made.
    assert "hashpartitioning(_dealt" in counts._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("frequent", [0, 2, 100])
def test_topic_keywords_move_texts_and_rare_terms_only(frame, monkeypatch, frequent):
    plans, cut = [], terms.cut_lineage

    def recorded(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)

    monkeypatch.setattr(terms, "cut_lineage", recorded)
    monkeypatch.setattr(terms, "FREQUENT_TERMS", frequent)
    rows = [(1, "apple apple pear plum"), (1, "plum apple"), (2, "pear pear fig"), (None, "fig fig quince"), (3, None), (4, "")]
    found = terms.topic_keywords(frame(rows, "doc_id int, content string"), 2)
    tf = Counter((k, t) for k, text in rows for t in (text or "").split() if t not in ("the",))
    df = Counter(t for _, t in tf)
    scores = {}
    for (k, t), n in tf.items():
        scores.setdefault(k, []).append((-round(n * math.log(len(rows) / df[t]), 9), t, n))
    want = {(k, place, t, n) for k, found_ in scores.items() for place, (_, t, n) in enumerate(sorted(found_)[:2], 1)}
    assert {(r["doc_id"], r["rank"], r["term"], r["tf"]) for r in found.collect()} == want
    # Words are counted where their texts lie, not shuffled by document and term.
    assert not re.search(r"hashpartitioning\(doc_id#\d+, term#", plans[0])


def test_semantic_records_name_their_vectors(frame, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 3)
    texts = ["a b c d", "a b c", "a b c a b c", "x y", None, "q r s"]
    df = frame([(f"c{i}", "u", "en", t) for i, t in enumerate(texts)], "chunk_id string, source_url string, language string, content string")
    names = F.when(F.col("gram") == "q r s", 9).otherwise(F.when(F.col("gram").startswith("a"), 1).otherwise(2))
    named = terms.trigram_counts(df).withColumn("vec_id", names)
    store = frame([(1, [1.0, 2.0]), (2, [3.0]), (3, [4.0]), (9, None)], "vec_id int, embedding array<float>")
    found = terms.semantic_records(df, vectors=named, store=store, counts="n")
    whole = terms.semantic_records(df, vectors=named.drop("n").join(store, "vec_id"))
    assert sorted(found.columns) == sorted(whole.columns)
    order = sorted(whole.columns)
    assert sorted(map(str, found.select(order).collect())) == sorted(map(str, whole.select(order).collect()))
    with pytest.raises(ValueError):
        terms.semantic_records(df, embedder=lambda s: [], store=store)
