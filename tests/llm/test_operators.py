"""Each operator against a brute-force version, and the defined cases of its docstring."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import (
    bm25_search, common, decontaminate, licenses, line_dedup, mixing, near_dedup, toxicity, training_order, url_filters, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score int, node string"
BREAK = __import__("re").compile(r"[\s!-/:-@\[-`{-~]+")


def words(t):
    return [w for w in BREAK.split((t or "").lower()) if w]


def prose(rng, n):
    return " ".join("".join(rng.choice(("ba", "do", "ki", "lu", "me", "no", "ra")) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Texts with copies, near copies, repeated rows, null and empty texts, null ids and clashing columns."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(30, 90)) for _ in range(60)]
    for t in texts[:10]:
        texts += [t, t.upper() + " .", " ".join([*t.split()[:-1], "zz"])]
    texts += ["", None, "  \n ", "one", "a b c", "x " * 3000]
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 4}" if i % 7 else None, len(t or ""), i, "n") for i, t in enumerate(texts)]
    rows += [rows[3], (None, texts[0], "en", "src0", 5, 1, "n"), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def empty(docs):
    return docs.where(F.lit(False))


@pytest.fixture(scope="module")
def insults(spark):
    """A character model of prose in which some words are frequent."""
    rng = random.Random(1)
    said = "idiot stupid clown loser trash worthless scum moron"
    corpus = [(i, f"{prose(rng, 30)} {said} {prose(rng, 5)} such a man, you an here", None, None, 0, 0, None) for i in range(40)]
    return toxicity.language_model(spark.createDataFrame(corpus, DOCS))


def test_decoder_restores_disguised_words(insults):
    decoder = toxicity.Decoder(insults)
    assert decoder.restore("you 1d10t!") == "you idiot!"
    assert decoder.restore("such an i d i o t here") == "such an idiot here"
    assert decoder.restore("stuuuupid") == "stupid"
    assert decoder.restore("a a a a a a") == "a a a a a a"
    assert decoder.restore("in 2020, 15 % - $ 7") == "in 2020, 15 % - $ 7"
    assert decoder.restore(None) == "" and decoder.restore("") == ""


@pytest.mark.parametrize(
    "text, word",
    [
        ("(1d10t)", "idiot"), ("-1d10t", "idiot"), ("#l0s3r", "loser"), ("worthle55", "worthle"), ("worthl355", "worthl"), ("id107", "idiot"),
        ("idio+", "idio"), ("t r @ s h", "trash"), ("s-t-u-p-!-d", "stupid"), ("id iot", "idiot"), ("sc*um", "scum"), ("stuupid", "stupid"),
        ("iddiioott", "idiot"), ("i/d/i/o/t", "idiot"), ("i,d,i,o,t", "idiot"), ("i  d  i  o  t", "idiot"), ("i.d-i.o-t", "idiot"), ("$ c u m", "scum"),
        ("such a i d i o t here", "idiot"), ("you/tr@sh", "trash"), ("m0r0n", "moron"), ("cl0wn", "clown"), ('"5tup1d"', "stupid"),
    ],
)
def test_disguises(insults, text, word):
    decoder = toxicity.Decoder(insults, lambda w: w[:4] in ("idio", "scum"))
    assert any(w.startswith(word) for w in toxicity._WORD.findall(decoder.restore(text))), decoder.restore(text)


def test_viterbi_equals_all_readings(insults):
    """Every path of the lattice, one by one."""
    import itertools

    decoder = toxicity.Decoder(insults)
    rng = random.Random(7)
    spans = ["1d10t", "i d i o t", "st-u-pid", "aa1bb", "!!a", "a$$", "t r @ s h", "ll00", "i.d/i.o", "sc*um"]
    spans += ["".join(rng.choice("aabdiost01@$!- ") for _ in range(rng.randint(3, 9))).strip() or "a" for _ in range(60)]
    for span in spans:
        units = [[(u, 0.0)] if isinstance(u, str) else u for u in decoder.units(span)]
        scores = {}
        for path in itertools.product(*units):
            text = "".join(t for t, _ in path)
            state, likely = decoder.cost((0, 0), text)
            score = sum(c for _, c in path) + likely + decoder.model[state[0]][state[1]][0]
            scores[text] = max(scores.get(text, -1e9), score)
        assert scores[decoder._decode(span)] == pytest.approx(max(scores.values()), abs=1e-6), span


def test_a_megabyte_without_a_space_takes_seconds(insults):
    import time

    rng = random.Random(3)
    for text in ("".join(rng.choice("abcdefgh") for _ in range(1_000_000)), "a1" * 500_000, "a " * 500_000, "-a" * 500_000, "1" * 1_000_000):
        scorer = toxicity.Scorer(insults, {"idio": 1.0}, 0.0)
        start = time.process_time()
        scorer(text)
        assert time.process_time() - start < 12
        assert scorer.found.held + scorer.pairs.held + scorer.decoder.read.held < 4 * toxicity.CACHED


def test_scores_are_those_of_the_restored_text(insults):
    """The scorer's look-ups by token against the features of the whole restored text."""
    weights = {"idio": 2.0, "idiot": 0.5, "=scum": 1.5, "=idiot": 0.25, "worth": 3.0, "=clown": -1.0}
    scorer = toxicity.Scorer(insults, weights, -1.0)
    rng = random.Random(2)
    bits = ["1d10t", "id iot", "i d i o t", "sc*um", "worthle55", "cl0wn", "idiotic", "the", "of", "ba do ki", "scum", "x", "(idiot)"]
    for _ in range(200):
        text = " ".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        decoder = toxicity.Decoder(insults, scorer.decoder.known)
        found = toxicity.features(toxicity._WORD.findall(decoder.restore(text)))
        # A pair is read beside its tokens, which have no features of their own when it is read as one.
        z = -1.0 + sum(w for f, w in weights.items() if f in found)
        assert scorer(text) == pytest.approx(1 / (1 + np.exp(-z))), text


def test_toxicity_learns_without_held_out_rows_and_scores_every_row(spark, docs):
    rng = random.Random(2)
    rows = [(i, prose(rng, 40) + (" idiot" if i % 5 == 0 else ""), "en", "s", 1, 1, "n") for i in range(300)]
    some = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(some.unionByName(docs), labels).toPandas()
    assert len(got) == 300 + docs.count()
    own = got[got.doc_id.notna()]
    assert all(bool(h) == (zlib.crc32(str(int(i)).encode()) % 5 == 0) for i, h in zip(own.doc_id, own.held_out))
    first = toxicity.toxicity(some, labels).toPandas().set_index("doc_id")
    assert all((first.loc[i, "predicted"] == 1) == (i % 5 == 0) for i in range(300))
    assert toxicity.toxicity(docs, empty(labels)).where("score > 0.01").isEmpty()
    assert toxicity.toxicity(empty(docs), labels).isEmpty()
    kept = toxicity.drop_toxic(some, labels)
    assert kept.columns == some.columns and kept.count() == 240


def brute_classes(rows, similarity):
    sets = []
    for _, t in rows:
        w = words(t)
        n = min(5, len(w)) or 1
        c = {}
        for i in range(len(w) - n + 1):
            c[tuple(w[i : i + n])] = c.get(tuple(w[i : i + n]), 0) + 1
        sets.append(c if w else {})

    def j(a, b):
        if not a and not b:
            return 1.0
        total = 0
        for d in a.keys() & b.keys():
            total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys())
        return total

    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if (sets[x].keys() & sets[y].keys() or sets[x] == sets[y]) and j(sets[x], sets[y]) >= similarity - 1e-9:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    groups = {}
    for x, (i, _) in enumerate(rows):
        groups.setdefault(find(x), []).append(i)
    return sorted(sorted(g, key=str) for g in groups.values())


def test_near_duplicates_are_the_brute_force_classes(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {}
    for r in near_dedup.near_duplicates(docs).collect():
        got.setdefault((r.class_id, r.class_key), []).append(r.doc_id)
    assert sorted(sorted(g, key=str) for g in got.values()) == brute_classes(rows, 0.8)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(got)
    assert near_dedup.near_duplicates(empty(docs)).isEmpty()


def test_large_buckets_are_compared_by_blocks(spark, docs):
    rng = random.Random(11)
    base = prose(rng, 120).split()
    edited = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(6)}"
        edited.append((1000 + i, " ".join(w), "en", "s", 1, 1, "n"))
    some = docs.unionByName(spark.createDataFrame(edited, DOCS))
    want = brute_classes([(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()], 0.8)
    got = {}
    for r in near_dedup.near_duplicates(some, stars=0, small=1, block=7).collect():
        got.setdefault((r.class_id, r.class_key), []).append(r.doc_id)
    assert sorted(sorted(g, key=str) for g in got.values()) == want


def test_overlaps_count_common_shingles():
    a = (np.array([1, 3, 5], np.uint64), np.array([1, 2, 1]))
    b = (np.array([3, 5, 9], np.uint64), np.array([4, 1, 1]))
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    count, left, right = near_dedup.overlaps([a, none], [b, a])
    assert count.tolist() == [[2, 3], [0, 0]] and left.tolist() == [[3, 4], [0, 0]] and right.tolist() == [[5, 4], [0, 0]]


def test_registers_agree_with_probability_jaccard():
    rng = np.random.default_rng(3)
    a = near_dedup.shingle_counts(rng.integers(0, 50, 400))
    h = rng.integers(0, 2**62, 500)
    x = (np.unique(h[:400]).astype(np.uint64), rng.integers(1, 4, 400))
    y = (np.unique(h[100:]).astype(np.uint64), rng.integers(1, 4, 400))
    sign = near_dedup.prob_minhash([x, y, a], 4000)
    estimate = (sign[0] == sign[1]).mean()
    assert abs(estimate - near_dedup.probability_jaccard(x, y)) < 0.04
    assert near_dedup.probability_jaccard(x, x) == pytest.approx(1.0)


def test_decontamination_finds_planted_items_with_substitutions(spark, docs):
    rng = random.Random(9)
    items = [prose(rng, n) for n in (30, 25, 15, 8)]
    spoiled = items[0].split()
    spoiled[4] = spoiled[17] = spoiled[25] = "zzz"
    planted = [items[0], " ".join(spoiled), items[2].upper(), items[3], " ".join(items[1].split()[:21])]
    rows = [(1000 + i, f"{prose(rng, 40)} {t}. {prose(rng, 40)}", "en", "s", 1, 1, "n") for i, t in enumerate(planted)]
    rows += [rows[0], (1010, items[2], None, None, None, None, None)]
    all_docs = docs.unionByName(spark.createDataFrame(rows, DOCS))
    bench = spark.createDataFrame([*enumerate(items), (8, None), (9, ""), (10, "one two")], "item_id long, text string")
    left = decontaminate.drop_contaminated(all_docs, bench)
    assert left.columns == docs.columns
    assert sorted(map(str, [r.doc_id for r in left.collect()])) == sorted(map(str, [r.doc_id for r in docs.collect()]))
    assert decontaminate.contaminated(all_docs, empty(bench)).isEmpty()
    assert decontaminate.contaminated(empty(docs), bench).isEmpty()


def test_seeds_hit_every_pattern_of_allowed_substitutions():
    itertools = __import__("itertools")
    for n in range(1, decontaminate.OVERLAP + 1):
        masks = decontaminate.MASKS[max(k for k in decontaminate.MASKS if k <= n)]
        places = [{at + p for p in m} for m in masks for at in range(n - m[-1])]
        for spoiled in itertools.combinations(range(n), n - -(-n * 4 // 5)):
            assert any(p.isdisjoint(spoiled) for p in places), (n, spoiled)


def test_decontamination_equals_a_scan_of_all_diagonals(spark):
    rng = random.Random(31)
    items = [[f"{w}{n}" for w in prose(rng, n).split()] for n in (1, 2, 3, 4, 5, 6, 9, 10, 12, 12, 14, 15, 15, 17, 19, 20, 34)]
    texts = []
    for item in items:
        for extra in (0, 0, 0, 0, 0, 1):
            n, start = min(20, len(item)), rng.randint(0, max(0, len(item) - 20))
            part = item[start : start + n]
            for i in rng.sample(range(n), n - -(-n * 4 // 5) + extra):
                part[i] = f"z{i}"
            texts.append([*(f"a{rng.random()}".replace(".", "") for _ in range(8)), *part, *prose(rng, 30).split()])

    def overlaps(text, item):
        need = min(20, len(item))
        for d in range(-len(item) + 1, len(text)):
            same = [text[d + i] == item[i] for i in range(len(item)) if 0 <= d + i < len(text)]
            if any(sum(same[k : k + need]) >= -(-need * 4 // 5) for k in range(len(same) - need + 1)):
                return True
        return False

    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = {i for i, t in enumerate(texts) if any(overlaps(t, x) for x in items)}
    left = {r.doc_id for r in decontaminate.drop_contaminated(frame, bench).collect()}
    assert len(want) >= 5 * len(items) and left == set(range(len(texts))) - want


def test_short_items_match_whole_and_other_rules_are_refused(spark):
    texts = ["see w1 w2 w3 w4 here", "see w1 w2 w3 zz w4", "w9", "x w9 y", "w5 w6", "w5 x w6"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(0, "w1 w2, w3 W4"), (1, "w9"), (2, "w5 w6")], "item_id long, text string")
    found = {r.doc_id for r in frame.join(decontaminate.contaminated(frame, bench), F.xxhash64("text") == F.col("text_key")).collect()}
    assert found == {0, 2, 3, 4}
    for wrong in ({"agreement": 0.7}, {"overlap": 30}):
        with pytest.raises(ValueError):
            decontaminate.contaminated(frame, bench, **wrong)


@pytest.mark.parametrize("overlap", [6, 12])
def test_shorter_overlaps_equal_a_scan(spark, overlap):
    rng = random.Random(overlap)
    item = [f"q{i}" for i in range(30)]
    texts = []
    for _ in range(40):
        start = rng.randint(0, 30 - overlap)
        part = item[start : start + overlap]
        for i in rng.sample(range(overlap), rng.randint(0, overlap // 3)):
            part[i] = f"z{i}"
        texts.append([*prose(rng, 5).split(), *part, *prose(rng, 5).split()])
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    need = -(-overlap * 4 // 5)
    want = set()
    for i, t in enumerate(texts):
        for d in range(-30, len(t)):
            same = [t[d + k] == item[k] for k in range(30) if 0 <= d + k < len(t)]
            if any(sum(same[k : k + overlap]) >= need for k in range(len(same) - overlap + 1)):
                want.add(i)
    left = {r.doc_id for r in decontaminate.drop_contaminated(frame, bench, overlap=overlap).collect()}
    assert want and left == set(range(40)) - want


def fill(budget, caps, weights):
    """Water filling by repeated division, the plain way."""
    share, left, open_ = dict.fromkeys(caps, 0.0), budget, {c for c in caps if weights.get(c, 0) > 0}
    while open_ and left > 1e-9:
        total = sum(weights[c] for c in open_)
        give = {c: left * weights[c] / total for c in open_}
        left = 0.0
        for c, g in give.items():
            take = min(g, caps[c] - share[c])
            share[c] += take
            left += g - take
        open_ = {c for c in open_ if caps[c] - share[c] > 1e-9}
    return share


@pytest.mark.parametrize("budget", [1, 9, 10, 13, 25, 37, 47, 60, 79, 80])
def test_mixing_takes_the_budget_exactly_among_copies(spark, budget):
    """Eight rows of ten tokens, two distinct ones, over more than one partition."""
    rows = [(i % 2, " ".join(["w"] * 9 + [str(i % 2)]), "en", "src0", 1, 1, "n") for i in range(8)]
    some = spark.createDataFrame(rows, DOCS).repartition(3)
    weights = spark.createDataFrame([("domain", "crawl", 1.0)], "level string, name string, weight double")
    got = mixing.mix(some, weights, F.lit(float(budget)), max_epochs=2).toPandas()
    assert got["taken"].sum() == budget
    assert (got["taken"] < got["tokens"]).sum() <= 1


def test_mixing_gives_names_without_a_weight_their_default(spark):
    names = [("src0", "en"), ("web", "en"), (None, None), ("src3", "pt"), ("src99999999999999", "en"), ("off", "en")]
    rows = [(i, "w " * 10, lang, source, 1, 1, "n") for i, (source, lang) in enumerate(names)]
    some = spark.createDataFrame(rows, DOCS)
    weights = mixing.target_weights(spark).unionByName(spark.createDataFrame([("source", "off", 0.0)], "level string, name string, weight double"))
    got = mixing.mix(some, weights, F.lit(1000.0), max_epochs=1).toPandas()
    assert sorted(got["id"]) == [0, 1, 2, 3, 4] and got["taken"].sum() == 50


def test_mixing_fills_siblings_before_ancestors_and_takes_exact_prefixes(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(("en", "de")), rng.choice(("src0", "src1", "src12")), 1, 1, "n") for i in range(400)]
    rows += [(900, None, "en", "src0", 1, 1, "n"), (901, "", None, None, 1, 1, "n"), rows[0]]
    some = spark.createDataFrame(rows, DOCS)
    weights = spark.createDataFrame(
        [("domain", "crawl", 0.1), ("domain", "reference", 0.8), ("domain", "community", 0.1), ("lang", "en", 0.9), ("lang", "de", 0.1),
         ("source", "src0", 1.0), ("source", "src1", 1.0), ("source", "src12", 1.0)], "level string, name string, weight double")
    got = mixing.mix(some, weights, F.col("total") * 0.9, max_epochs=2).toPandas()
    stock = {}
    for _, t, lang, source, *_ in rows:
        if t:
            d = {"src0": "crawl", "src1": "reference", "src12": "community"}[source]
            stock[d, lang] = stock.get((d, lang), 0) + len(t.split())
    total = 0.9 * sum(stock.values())
    top = fill(total, {d: sum(2 * v for (x, _), v in stock.items() if x == d) for d in ("crawl", "reference", "community")}, {"crawl": 0.1, "reference": 0.8, "community": 0.1})
    taken = got.groupby(["domain", "lang"]).taken.sum()
    for d, share in top.items():
        for lang, want in fill(share, {x: 2 * stock[d, x] for x in ("en", "de")}, {"en": 0.9, "de": 0.1}).items():
            assert abs(taken.get((d, lang), 0) - want) <= 1.01
    assert (got[got.taken < got.tokens].groupby(["domain", "lang", "source"]).size() <= 1).all()
    out = mixing.mixed_documents(some, weights, F.col("total") * 0.9)
    assert out.columns == some.columns and out.count() == len(got)
    assert mixing.mix(empty(some), weights, F.col("total") * 0.5).isEmpty()


def test_feistel_is_a_permutation_for_any_count(spark):
    for n in (1, 2, 3, 17, 1000):
        got = [r.s for r in spark.range(n).select(training_order.feistel(F.col("id"), n, 7).alias("s")).collect()]
        assert sorted(got) == list(range(n))


@pytest.mark.parametrize("length", [4, 32])
def test_shards_hold_every_token_in_slot_order(spark, docs, tmp_path, length):
    folder = str(tmp_path / "shards")
    rows = training_order.materialise(docs, folder, length=length, shard=8).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    blocks = training_order.read_slots(folder, 0, len(rows), length=length, shard=8)
    resumed = training_order.read_slots(folder, 5, len(rows) - 5, length=length, shard=8)
    assert (blocks[5:] == resumed).all()
    for r in rows:
        assert zlib.crc32(blocks[r.slot].tobytes()) == r.checksum and r.shard == r.slot // 8 and r.offset == r.slot % 8 * 2 * length
    encode = training_order.tokenizer(training_order.RANKS).encode_ordinary
    want = sum(len(encode(r.text)) + 1 for r in docs.collect() if r.text)
    assert sum(r.n_tokens for r in rows) == want
    ids = [t for r in rows for t in blocks[r.slot][: r.n_tokens] if t != training_order.END]
    assert sorted(ids) == sorted(t for r in docs.collect() if r.text for t in encode(r.text))
    assert training_order.materialise(empty(docs), str(tmp_path / "none")).isEmpty()


def test_url_rules(spark):
    rules = spark.createDataFrame([*url_filters.RULES, ("block", None, "/"), ("block", "x.org", "/a")], "verdict string, host string, path string")
    urls = [None, "", "no scheme", "http://WWW.Example.com/en/1", "https://a.example.com/en/x?y", "http://example.com", "http://b.net/fr/#z", "http://notexample.com/en/", "http://x.org/ab", "http://x.org/b", "ftp://com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("mine"))
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.judge(pages, rules).collect()}
    assert got == {
        0: (None, "allow"), 1: (None, "allow"), 2: (None, "allow"), 3: ("www.example.com/en/", "allow"), 4: ("example.com/en/", "block"), 5: (None, "allow"),
        6: ("net/fr/", "block"), 7: ("com/", "allow"), 8: ("x.org/a", "block"), 9: (None, "allow"), 10: ("com/", "allow"),
    }
    assert url_filters.judge(pages, empty(rules)).where("verdict <> 'allow'").isEmpty()
    assert url_filters.judge(empty(pages), rules).isEmpty()


def test_revisits_across_task_borders(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(400):
        url = rng.choice(("http://a.com/", "https://www.a.com/#x", "http://b.com/p/", None))
        kind = "response" if rng.random() < 0.1 else "revisit"
        rows.append((i, url, rng.randint(0, 300), kind, rng.choice((None, "e1", "W/e1", "e2")) if kind == "revisit" else "e1", None, None, {"date": str(i), "x": str(i)}))
    key = {"http://a.com/": "a", "https://www.a.com/#x": "a", "http://b.com/p/": "b"}
    for r in rows:
        if r[3] == "revisit":
            old = [o for o in rows if o[3] == "response" and r[1] and o[1] and key[o[1]] == key[r[1]] and o[2] <= r[2]]
            best = max(old, key=lambda o: (o[2], o[0]), default=None)
            fits = best and (r[4] is None or r[4].removeprefix("W/") == "e1")
            want[r[0]] = ("no_response", None) if not best else ("resolved", best[0]) if fits else ("validator_mismatch", None)
    schema = "record_id long, url string, time long, kind string, etag string, last_modified string, digest string, headers map<string,string>"
    captures = spark.createDataFrame(rows, schema).withColumn("part", F.lit(1))
    got = warc.resolve(captures).collect()
    assert {r.record_id: (r.status, r.response_id) for r in got} == want
    one = next(r for r in got if r.status == "resolved")
    assert one.headers == {"date": str(one.record_id), "x": str(one.response_id)}
    assert warc.resolve(empty(captures)).isEmpty()


def test_license_cosine_and_inheritance(spark):
    files = spark.createDataFrame(
        [(1, "p/LICENSE", "Released under the MIT License."), (2, "p/a/x.txt", "nothing here"), (3, "p/a/LICENSE", "Licensed under the Apache License, Version 2.0."),
         (4, "p/a/b/y.txt", "more"), (5, "q/z.txt", None), (6, None, ""), (7, "q/w.txt", "code\nLicensed under CC BY-NC 4.0.\ncode"), (2, "p/a/x.txt", "nothing here")],
        "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin) for r in licenses.scan(files, licenses.templates(spark)).collect()}
    assert got == {1: ("MIT", "own"), 2: ("Apache-2.0", "p/a"), 3: ("Apache-2.0", "own"), 4: ("Apache-2.0", "p/a"), 5: (None, None), 6: (None, None), 7: ("CC-BY-NC-4.0", "own")}
    assert licenses.scan(files, empty(licenses.templates(spark))).where("license is not null").isEmpty()
    assert licenses.scan(empty(files), licenses.templates(spark)).isEmpty()


def test_license_notices_count_whatever_surrounds_them(spark):
    rng = random.Random(12)
    page = lambda notice: f"{prose(rng, 400)}\n{prose(rng, 30)} {notice} {prose(rng, 30)}\n{prose(rng, 400)}"
    files = spark.createDataFrame(
        [(1, "p/LICENSE", page("Licensed under the Apache License,\nVersion 2.0.")), (2, "p/a/x.txt", "nothing"), (3, "q/f.c", page("Released under the MIT License.")),
         (4, "q/LICENSE", page("all rights by permission of mit")), (5, "q/y.txt", "nothing"), (6, "r/f.c", "Copyright 2020 Example Company Inc.\nAll rights reserved.\n" + page("Licensed under CC BY 4.0."))],
        "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.score) for r in licenses.scan(files, licenses.templates(spark)).collect()}
    assert got == {1: ("Apache-2.0", "own", 1.0), 2: ("Apache-2.0", "p", None), 3: ("MIT", "own", 1.0), 4: (None, None, None), 5: (None, None, None), 6: ("CC-BY-4.0", "own", 1.0)}


def test_ordinary_license_headers_have_verdicts(spark):
    headers = [
        ("Apache-2.0", "Copyright (c) 2020 Example Company Inc. All rights reserved. Licensed under the Apache License, Version 2.0."),
        ("Apache-2.0", "// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance with the License.\n// You may obtain a copy of the License at"),
        ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0"), ("MIT", "/* SPDX-License-Identifier: MIT */"), ("GPL-3.0", "# SPDX-License-Identifier: GPL-3.0"),
        ("MIT", "Copyright (c) 2019 Jo Doe\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n"
         "in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software"),
        ("GPL-3.0", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
        ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
        (None, "Copyright (c) 2020 Example Company Inc. All rights reserved."), (None, "You need permission to enter, mit freundlichen Grüßen"), (None, "SPDX-License-Identifier: ISC"),
        ("MIT", "The MIT License (MIT)"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"), ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"), (None, "ein Buch mit Copyright von 2020"),
    ]
    files = spark.createDataFrame([(i, f"p{i}/a.c", f"{h}\ncode") for i, (_, h) in enumerate(headers)], "doc_id long, path string, text string")
    got = {r.doc_id: r.license for r in licenses.scan(files, licenses.templates(spark)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(headers)}


def brute_shingles(line):
    w = [x for x in line.strip(" ").lower().split(" ") if x]
    out = set()
    for i in range(len(w)):
        s = " ".join(w[i : i + 4])
        if i == 0 or len(s) >= 16:
            out.add(s[:16])
    return out


def test_fuzzy_lines_are_the_brute_force_components(spark, docs):
    rng = random.Random(8)
    base = [prose(rng, 40) for _ in range(12)]
    near = [" ".join([*b.split()[:-1], "qq"]) for b in base]
    rows = [(2000 + i, "\n".join([base[i], "", near[(i + 1) % 12], prose(rng, 12)]), "en", "s", 1, 1, "n") for i in range(12)]
    some = spark.createDataFrame(rows, DOCS)
    lines = [(r[0], n, x) for r in rows for n, x in enumerate(r[1].split("\n")) if x.strip(" ")]
    sets = [brute_shingles(x) for *_, x in lines]
    root = list(range(len(lines)))
    for x in range(len(lines)):
        for y in range(x):
            if len(sets[x] & sets[y]) / len(sets[x] | sets[y]) >= 0.8:
                a, b = sorted((root[x], root[y]))
                root = [a if r == b else r for r in root]
    want = {lines[x][:2] for x in range(len(lines)) if any(root[y] == root[x] for y in range(x))}
    assert {tuple(r) for r in line_dedup.repeated_lines(some).collect()} == want
    for method in ({}, {"stars": 0, "small": 1, "block": 3}):
        classes = line_dedup.line_classes(some, **method)
        joined = line_dedup.lines(some).join(classes, "node", "left").withColumn("root", F.coalesce("root", "node")).collect()
        label = {(r.doc_id, r.line_no): r.root for r in joined}
        assert all((label[lines[x][:2]] == label[lines[y][:2]]) == (root[x] == root[y]) for x in range(len(lines)) for y in range(x))
    out = line_dedup.without_repeats(some.unionByName(docs))
    assert out.columns == docs.columns and out.count() == 12 + docs.count()
    assert line_dedup.repeated_lines(empty(docs)).isEmpty()


def test_every_character_of_a_line_counts(spark):
    lines = [
        "https://example.org/reports/2020/alpha-and-beta", "https://example.org/tables/1999/gamma.or.delta",
        "1 2 3 4 5 6 7 8", "1 2 3 4 9 9 9 9", "price of item: 1299", "price of item: 1344",
        "日本語の文章はここから始まる長い文です今日は晴れ", "日本語の文章はここから始まる長い文でも中身が違う話", "ab", "AB", "abc",
        "a line with an emoji \U0001f600 inside it, to be read whole", "a line with an emoji \U0001f600 inside it, to be read whole.",
    ]
    some = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    assert sorted(r.line_no for r in line_dedup.repeated_lines(some).collect()) == [9, 12]
    read = spark.createDataFrame([(x,) for x in lines], "line string").select("line", line_dedup._stretches(F.col("line")).alias("s")).collect()
    for r in read:
        low = r.line.lower()
        assert r.s == ([low[i : i + 5] for i in range(len(low) - 4)] or [low])


def test_lines_with_a_word_replaced_are_found(spark):
    rng = random.Random(21)
    full = lambda t: {t[i : i + 5] for i in range(len(t) - 4)}
    pairs = []
    for _ in range(150):
        w = prose(rng, rng.randint(14, 40)).split()
        v = list(w)
        v[rng.randrange(len(w))] = "zz"
        pairs.append((" ".join(w), " ".join(v)))
    near = [k for k, (x, y) in enumerate(pairs) if len(full(x) & full(y)) / len(full(x) | full(y)) >= 0.8]
    some = spark.createDataFrame([(k, "\n".join(p)) for k, p in enumerate(pairs)], "doc_id long, text string")
    # A pair at 0.8 shares no band with probability 8e-4.
    assert len(near) > 100 and [tuple(r) for r in line_dedup.repeated_lines(some).orderBy("doc_id").collect()] == [(k, 1) for k in near]


def test_fuzzy_lines_shuffle_no_shingle_and_fetch_only_likely_lines(spark):
    rng = random.Random(31)
    full = lambda t: {t[i : i + 5] for i in range(len(t) - 4)}
    texts = [prose(rng, rng.randint(20, 60)) for _ in range(60)]
    # One in three is followed by a close one.
    texts += [t + " " + prose(rng, 2) for t in texts[::3]]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    sketched = line_dedup.sketches(line_dedup.distinct_lines(docs))
    # The lines are dealt by node once; their shingles are counted where they are.
    plan = sketched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    node = {r.line: r.node for r in line_dedup.lines(docs).collect()}
    pairs = [(node[x], node[y], full(x), full(y)) for i, x in enumerate(texts) for y in texts[:i]]
    similar = {(a, b) for a, b, x, y in pairs if len(x & y) / len(x | y) >= 0.8}
    found = {tuple(r) for r in line_dedup.likely(spark.createDataFrame([p[:2] for p in pairs], "a long, b long"), sketched, 0.8).collect()}
    assert len(similar) >= 15 and similar <= found and len(found) < len(pairs) / 10


def test_near_duplicate_sketches_are_bounded_by_words_not_rows(monkeypatch):
    np, pd = near_dedup.np, near_dedup.pd
    lists = [np.arange(60 + k % 7) + 1000 * k for k in range(50)] + [np.zeros(0, np.int64), np.arange(400) - 500]
    frame = pd.DataFrame({"doc_id": range(52), "text_key": 0, "node": range(52), "h": lists})
    read = lambda: pd.concat(near_dedup.sketched([frame], near_dedup.BANDS, near_dedup.ROWS))
    whole, held, arrays = read(), [], near_dedup.prob_minhash
    monkeypatch.setattr(near_dedup, "prob_minhash", lambda texts, n: (held.append(sum(int(w.sum()) for _, w in texts)), arrays(texts, n))[1])
    monkeypatch.setattr(near_dedup, "AT_ONCE", 100)
    small = read()
    assert small["doc_id"].tolist() == list(range(52)) and len(held) > 20 and sorted(held)[-2] <= 166
    assert all((x is None and y is None) or x.tolist() == y.tolist() for x, y in zip(whole["bands"], small["bands"], strict=True))


def test_bm25_equals_scoring_everything(docs):
    rows = {}
    # Some ids are negative.
    one = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("doc_id", F.col("doc_id") - 40)
    for r in one.collect():
        rows[r.doc_id] = words(r.text)
    n, mean = len(rows), sum(map(len, rows.values())) / len(rows)
    got = {}
    for r in bm25_search.search(one, one.where("doc_id % 20 = 0"), k=5, shard=16, block=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    for q in (i for i in rows if i % 20 == 0):
        scored = []
        for d, w in rows.items():
            s = 0.0
            for t in set(rows[q]) & set(w):
                df = sum(t in x for x in rows.values())
                tf = w.count(t)
                s += np.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
            if d != q and s > 0:
                scored.append((-round(s, 6), d))
        want = [(k + 1, d, -s) for k, (s, d) in enumerate(sorted(scored)[:5])]
        assert [x[:2] for x in sorted(got.get(q, []))] == [x[:2] for x in want]
        assert [x[2] for x in sorted(got.get(q, []))] == pytest.approx([x[2] for x in want], abs=2e-6)
    assert bm25_search.search(empty(docs), docs).isEmpty()


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    got = {r.id: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100)}


def test_bitmap_never_loses_a_key(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("k"))
    assert keys.where(common.maybe_in(F.col("k"), common.key_bitmap(keys, "k", 1 << 10), 1 << 10)).count() == 5000
    other = spark.range(5000, 9000).select(F.xxhash64("id").alias("k"))
    assert other.where(common.maybe_in(F.col("k"), common.key_bitmap(keys, "k"))).count() < 20


def test_a_shard_is_moved_once_for_all_queries(spark):
    docs = spark.createDataFrame([(i, f"common w{i % 7} v{i % 11}") for i in range(60)], "doc_id long, text string")
    # More shards than are filled, and a query a block.
    found = bm25_search.search(docs, docs.where("doc_id % 6 = 0"), k=3, shard=1, block=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and plan.count("explode(sequence") <= 1
    whole = bm25_search.search(docs, docs.where("doc_id % 6 = 0"), k=3)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect())) and found.count() == 30


def test_shards_and_queries_meet_without_copies_on_disk(spark):
    docs = spark.createDataFrame([(i, f"common w{i % 7} v{i % 11}") for i in range(60)], "doc_id long, text string")
    found = bm25_search.search(docs, docs.where("doc_id % 6 = 0"), k=3, shard=8, block=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Below the pairs of partitions both sides are read from the shared folder.
    met = plan[plan.index("CartesianProduct"):]
    assert "Exchange" not in met and "explode" not in met and met.count("parquet") >= 2


def test_query_blocks_are_bounded_and_hold_every_query(spark):
    rows = [(q, [(100 * q + t, t / 7) for t in range(q % 5 + 1)]) for q in range(-20, 20)] + [(99, [(t, 1.0) for t in range(50)])]
    weighed = spark.createDataFrame(rows, "query_id long, t array<struct<term: long, idf: double>>").repartition(3)
    blocks = bm25_search.query_blocks(weighed, len(rows), 6, 12).collect()
    got = {}
    for b in blocks:
        assert len(b.query_ids) <= 6 and (sum(b.sizes) <= 12 or len(b.sizes) == 1)
        asked, idf, start = np.frombuffer(b.asked, "<i8"), np.frombuffer(b.idf, "<f8"), 0
        for q, n in zip(b.query_ids, b.sizes):
            got[q] = [*zip(asked[start : start + n].tolist(), idf[start : start + n].tolist())]
            start += n
    assert got == dict(rows)


def test_first_blocks_rest_and_whole_lists_give_the_same_best(docs, monkeypatch):
    row = bm25_search.build_index(docs).toPandas().iloc[0]
    monkeypatch.setattr(bm25_search, "BLOCK", 2)
    shard = bm25_search._Shard(row, 60.0)
    rng = np.random.default_rng(3)
    for _ in range(30):
        some = np.sort(rng.choice(len(row.terms), rng.integers(1, 40), replace=False))
        idf = rng.random(len(some)) + 0.01
        score = np.zeros(len(row.ids))
        for t, g in zip(some, idf):
            posts = slice(row.starts[t], row.starts[t + 1])
            np.add.at(score, shard.owner[posts], g * shard.weight[posts])
        own = row.ids[rng.integers(len(row.ids))]
        want = sorted((-round(x, 6), i) for x, i in zip(score, row.ids) if x > 0 and i not in (own, bm25_search.NO_ID))[:4]
        for first, dense in ((1, 0), (1, 4), (3, 1000)):  # parts of lists only, either, whole lists only
            monkeypatch.setattr(bm25_search, "FIRST", first)
            monkeypatch.setattr(bm25_search, "DENSE", dense)
            ids, scores = shard.top(own, row.terms[some], idf, 4)
            assert ids.tolist() == [i for _, i in want] and scores == pytest.approx([-x for x, _ in want], abs=2e-6)


@pytest.mark.parametrize("most", [0, 255, 256, 65535, 65536, 1 << 31])
def test_postings_are_stored_as_narrow_as_they_fit(most):
    values = np.array([0, 7, most, 1], dtype=np.int64)
    data = bm25_search._narrow(values)
    assert bm25_search._wide(data, 4).tolist() == values.tolist() and len(data) == 4 * (1 if most < 256 else 2 if most < 65536 else 4)
    assert len(bm25_search._wide(bm25_search._narrow(values[:0]), 0)) == 0


def test_pieces_hold_every_stretch_once(spark):
    rng = random.Random(12)
    texts = ["", "ab", "abcd", "abcde", "A  b   c d e", "日本語の文章は" * 20, "a\U0001f600b" * 40] + [prose(rng, 200)[:n] for n in (31, 32, 33, 35, 36, 37, 40, 64, 68, 69, 100, 321)]
    rows = spark.createDataFrame([*enumerate(texts)], "node long, line string")
    got = {}
    for r in line_dedup.stretch_rows(rows).collect():
        got.setdefault(r.node, []).append(r.s)
    want = {r.node: r.s for r in rows.select("node", line_dedup._stretches(F.col("line")).alias("s")).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_line_bands_lose_no_more_pairs_and_propose_few_unlike_ones():
    bands = line_dedup.band_registers()
    assert all(len(set(x) & set(y)) <= 1 for x in bands for y in bands if x is not y)
    assert {len(set(b)) for b in bands} == {line_dedup.ROWS} and set().union(*bands) == set(range(line_dedup.REGISTERS))
    rng = np.random.default_rng(3)

    def shared(j, n):
        agree = rng.random((n, line_dedup.REGISTERS), dtype=np.float32) < j
        return np.logical_or.reduce([agree[:, b].all(1) for b in bands])

    for j in (0.8, 0.85):
        assert 1 - shared(j, 400_000).mean() < (1 - j**3) ** 10 + 1e-4
    # Ten bands of three let 1 % and 15 % through.
    assert shared(0.1, 400_000).mean() < 1e-3 and shared(0.25, 400_000).mean() < 0.03
