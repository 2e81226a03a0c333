"""Windows, mergers and the properties every chunking must have."""

import random

import pytest

from siltstone.operators import chunking as C


def words(n, start=0):
    return [f"w{i}" for i in range(start, start + n)]


def texts(frame, sizes):
    return frame([(f"u{n}", " ".join(words(n))) for n in sizes], "source_url string, content string")


def grouped(df, key="source_url"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], {})[r["idx"]] = r["chunk"]
    return out


def test_window_counts(frame):
    got = grouped(C.chunk_overlapping(texts(frame, [0, 1, 499, 500, 501, 950, 951]), min_chars=0))
    assert {k: len(v) for k, v in got.items()} == {"u1": 1, "u499": 1, "u500": 1, "u501": 2, "u950": 2, "u951": 3}


@pytest.mark.parametrize("window, overlap", [(5, 0), (5, 2), (7, 6), (1, 0)])
def test_every_word_is_covered_and_neighbours_share(frame, window, overlap):
    sizes = [1, 4, 5, 6, 7, 13, 29]
    for key, chunks in grouped(C.chunk_overlapping(texts(frame, sizes), window, overlap, min_chars=0)).items():
        parts = [chunks[i].split() for i in sorted(chunks)]
        assert sorted(chunks) == list(range(len(chunks)))
        assert all(len(p) == window for p in parts[:-1]) and len(parts[-1]) <= window
        for a, b in zip(parts, parts[1:]):
            assert a[len(a) - overlap:] == b[:overlap]
        joined = parts[0] + [w for p in parts[1:] for w in p[overlap:]]
        assert joined == words(int(key[1:]))


def test_short_chunks_leave_gaps(frame):
    content = " ".join(["x" * 60] * 2 + ["y"] * 2 + ["z" * 60] * 2)
    rows = C.chunk_overlapping(frame([("u", content)], "source_url string, content string"), 2, 0).collect()
    assert {r.chunk_id for r in rows} == {"u::0", "u::2"}
    sizes = frame([("a", "x" * 100), ("b", "x" * 101)], "source_url string, content string")
    assert [r.source_url for r in C.chunk_overlapping(sizes).collect()] == ["b"]


def test_bad_parameters(frame):
    df = texts(frame, [3])
    for call in (
        lambda: C.chunk_overlapping(df, 5, 5), lambda: C.chunk_sliding(df, 0, 1), lambda: C.chunk_regex(df, []),
        lambda: C.merge_by_tokens(df, 1, 2.0), lambda: C.merge_whole(df, 0),
    ):
        with pytest.raises(ValueError):
            call()


def test_sliding(frame):
    got = grouped(C.chunk_sliding(texts(frame, [3, 10, 11]), 4, 3))
    assert {k: len(v) for k, v in got.items()} == {"u3": 1, "u10": 3, "u11": 4}
    sparse = grouped(C.chunk_sliding(texts(frame, [11]), 2, 9))
    assert sparse == {"u11": {0: "w0 w1", 1: "w9 w10"}}
    assert grouped(C.chunk_sliding(texts(frame, [9]), 2, 9)) == {"u9": {0: "w0 w1"}}


def test_sentences_and_regex(frame):
    df = frame([("u", "One. Two!  Three? 3.14 four")], "source_url string, content string")
    assert grouped(C.chunk_sentences(df))["u"] == {0: "One.", 1: "Two!", 2: "Three?", 3: "3.14 four"}
    df = frame([("u", "a\n\n\n\nb--c")], "source_url string, content string")
    assert grouped(C.chunk_regex(df, [r"\n\n", "--"]))["u"] == {0: "a", 1: "b", 2: "c"}


def merge_python(pieces, window, shared):
    ws = [w for p in pieces for w in p.split()]
    step, out, at = window - shared, [], 0
    while ws:
        out.append(" ".join(ws[at:at + window]))
        if at + window >= len(ws):
            break
        at += step
    return out


@pytest.mark.parametrize("window, shared", [(5, 0), (5, 2), (40, 39), (3, 1)])
def test_merge_by_tokens(frame, monkeypatch, window, shared):
    # Order ranges of three rows, so a document crosses many of them.
    original = C.running_sum
    monkeypatch.setattr(C, "running_sum", lambda *a, **k: original(*a, **k, width=3))
    rng = random.Random(window * 100 + shared)
    docs = {d: [" ".join(words(rng.choice([0, 1, 2, 7, 23]), 1000 * i)) for i in range(20)] for d in range(5)}
    docs[9] = ["one"]
    rows = [(d, i, t) for d, pieces in docs.items() for i, t in enumerate(pieces)]
    df = frame(rows, "doc_id int, idx int, content string")
    got = grouped(C.merge_by_tokens(df, window, 1.0, shared), "doc_id")
    for d, pieces in docs.items():
        assert [got[d][i] for i in sorted(got[d])] == merge_python(pieces, window, shared)


def test_merge_whole(frame):
    rows = [(1, 0, "a b c"), (1, 1, "d"), (1, 2, "  "), (1, 3, "e f"), (1, 4, "g")]
    got = {r.bucket: r.chunk for r in C.merge_whole(frame(rows, "doc_id int, idx int, content string"), 4).collect()}
    assert got == {0: "a b c d", 1: "e f g"}
