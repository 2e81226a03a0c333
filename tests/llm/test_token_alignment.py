"""Alignment against a token-by-token version, and the defined cases of the docstring."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import token_alignment as ta

SCHEMA = "doc_id long, text string, lang string, block int, codes string, n long"


def brute(rows):
    """One document at a time: cut where both sides end, walk all pairs of tokens."""
    sides = [ta._loaded(ta.ByteLevel, ta.BYTE_BPE)[0], ta._loaded(ta.Pieces, ta.PIECE_BPE)[0]]
    docs, held = [], {}
    for doc_id, text in rows:
        ids = [s.encode([text])[0] if text else [] for s in sides]
        spelled = [[s.bytes[i] for i in x] for s, x in zip(sides, ids)]
        if not text or any(b"".join(x) != b" " + text.encode() for x in spelled):
            docs.append((doc_id, [], [], [], {}))
            continue
        spans = []
        for x in spelled:
            at, out = 0, []
            for b in x:
                out.append((at, at + len(b)))
                at += len(b)
            spans.append(out)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            groups.append([[i for i, (s, e) in zip(x, span) if lo <= s and e <= hi] for x, span in zip(ids, spans)])
        links = [(a, b) for a, (s, e) in zip(ids[0], spans[0]) for b, (t, f) in zip(ids[1], spans[1]) if s < f and t < e]
        for p in set(links):
            held[p] = held.get(p, 0) + 1
        docs.append((doc_id, *ids, groups, links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc_id, a, b, groups, links in docs:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                doc_id, len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                hashlib.sha256(written.encode()).hexdigest() if written else "",
            )
        )
    return sorted(out, key=str)


TEXTS = [
    "Hello world", "hello  world\n\tfoo", "", None, " ", "  leading", "naïve café déjà vu Größe", "日本語のテキスト 123", "emoji 😀😃 ok", "a",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "▁block▁", "x▁y", "nul\x00byte", "﻿bom", "é combining", "don't we'll I'm 2024-01-02",
    "tab\tand\r\nlines\n\n\n", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "مرحبا بالعالم", "\U0001f468‍\U0001f469‍\U0001f467", "Hello world",
]


def rows_of(rng, n):
    words = [w for t in TEXTS if t for w in t.split(" ")]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(n)]
    return list(enumerate(TEXTS + made))


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 21])
def test_digests_equal_the_token_by_token_version(spark, block_bytes):
    rows = rows_of(random.Random(3), 60)
    rows += [rows[5], (None, TEXTS[0]), (None, None)]
    df = spark.createDataFrame([(i, t, "en", 1, "c", 2) for i, t in rows], SCHEMA).repartition(3)
    out = ta.digests(df, block_bytes=block_bytes)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(out) == brute(rows)


def test_a_text_that_is_not_spelled_has_no_tokens(spark):
    df = spark.createDataFrame([(1, "x▁y", "", 0, "", 0), (2, None, "", 0, "", 0), (3, "", "", 0, "", 0)], SCHEMA)
    assert got(ta.digests(df)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    none = ta.digests(df.where(F.lit(False)))
    assert len(none.columns) == 8 and none.isEmpty()


def test_align_gives_tokens_groups_and_ends(spark):
    rows = rows_of(random.Random(5), 20)
    df = spark.createDataFrame([(i, t, "en", 1, "c", 2) for i, t in rows], SCHEMA)
    a, b = ta._loaded(ta.ByteLevel, ta.BYTE_BPE)[1], ta._loaded(ta.Pieces, ta.PIECE_BPE)[1]
    for r in ta.align(df).collect():
        text = dict(rows)[r.doc_id]
        assert len(r.a_ids) == len(r.a_group) and len(r.b_ids) == len(r.b_group)
        if not r.a_ids:
            continue
        whole, at = b" " + text.encode(), 0
        assert r.ends[-1] == len(whole)
        for g, end in enumerate(r.ends):
            for ids, group, spelled in ((r.a_ids, r.a_group, a), (r.b_ids, r.b_group, b)):
                assert b"".join(spelled[i] for i, h in zip(ids, group) if h == g) == whole[at:end]
            at = end


def test_long_chain_and_long_text(spark):
    # Ends that meet only at the last byte: one group, whose chain is as long as the text.
    n = 5000
    ends_a, ends_b = np.arange(2, 2 * n + 1, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    group_a, group_b = ta.labels(ends_a, ends_b)
    assert not group_a.any() and not group_b.any()
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(60_000)) + "z" * 20_000
    df = spark.createDataFrame([(1, text, "", 0, "", 0), (2, "short", "", 0, "", 0)], SCHEMA)
    out = {r.doc_id: r for r in ta.digests(df, block_bytes=1000).collect()}
    assert out[1].n_a > 60_000 and out[1].n_links >= max(out[1].n_a, out[1].n_b) and out[2].n_groups >= 1


def test_byte_letters_cover_every_byte():
    letters = ta._byte_letters()
    assert sorted(letters.values()) == list(range(256)) and letters["Ġ"] == 32 and letters["Ċ"] == 10


def test_chunks_give_the_tokens_of_whole_texts():
    rng = random.Random(3)
    parts = ["  ", "\n ", " \n", "\n\n ", "\t", "a", "foo", "'s", "é", "日本", " ", "   ", "1", "!", "<|endoftext|>", "\x1c", "　", "\xa0 ", "<s>", " ", "▁"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(1500)] + [None, ""]
    for k in range(0, len(texts), 50):
        some = texts[k : k + 50]
        chunked, whole = ta._by_chunk(some, ta.BYTE_BPE, ta.PIECE_BPE), ta._by_text(some, ta.BYTE_BPE, ta.PIECE_BPE)
        assert chunked is not None
        for a, b in zip(chunked, whole):
            assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_rank_encoder_gives_the_tokens_of_the_file():
    one = ta.ByteLevel(ta.BYTE_BPE)
    by_file = one.by_file(ta.BYTE_BPE)
    rng = random.Random(4)
    texts = [t for t in TEXTS if t]
    for _ in range(4000):
        made = b"".join(rng.choice(one.bytes) for _ in range(rng.randint(1, 5)))
        texts.append(made.decode("utf-8", "ignore"))
    texts += ["".join(chr(rng.choice((rng.randrange(0x300), rng.randrange(0xD800)))) for _ in range(9)) for _ in range(2000)]
    assert one.encode(texts) == by_file(texts)
