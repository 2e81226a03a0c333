"""Noisy-channel deobfuscation and toxicity scores.

1. A character trigram model is counted over every text of the corpus.
2. Whatever may be disguised becomes a lattice: a token with a sign or digit beside letters, a
   repeated letter or a separator inside, a run of three or more single characters, and two short
   tokens that together begin like a word of the model. A sign may stand for several
   letters, a repeated letter may be one or two, a separator may be nothing or a
   break. Viterbi picks the likeliest reading under channel and model.
3. A logistic regression over words of the *restored* text and their beginnings (4 to 6
   letters, so inflected and compound forms count together) gives the score. Its
   features stand in at least `support` toxic texts of the sample, counted
   over distinct texts so that copies of one text do not vote twice.

A lattice has a bounded number of states, plain letters between two doubtful places
are copied at once, and readings are cached per task up to a number of characters: time is
linear in the text, and memory does not grow with it.

Defined cases: null and empty texts score as a text without any word; rows with a
null id are held out (crc32 of the empty string is 0); repeated rows are scored
alike; other columns are not read; without any label of both kinds every score is
the prior of the labels (0 without labels).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, table

# The model's alphabet; class 0 is a word break, the last class any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäçèéêëíîïñóôöùúûüß"
DIGIT = len(LETTERS) + 1
OTHER = len(LETTERS) + 2
CLASSES = len(LETTERS) + 3
# What a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
# Separators inside a word; the second kind hardly ever stands between whole words.
SEPARATORS = " .-/,:'*_~^"
ODD_SEPARATORS = "*_~^"
# Channel log-probabilities: sign read as a letter, kept as itself (at the edge of a token, inside), letter dropped from a run.
SIGN, KEEP_EDGE, KEEP, DROP = -1.0, -1.0, -7.0, -1.5
# Separator dropped or kept between single characters, between pieces if odd, and between other pieces.
SPELLED, ODD, PIECES = (-0.2, -8.0), (-1.5, 0.0), (-4.0, 0.0)
# Kept beside the first or last single character of a run, which may be a word of its own.
RUN_EDGE = -0.5
# Word beginnings that are features; the shortest has four letters (`Scorer` looks words up by them).
BEGINNINGS = (4, 5, 6)
# Characters of readings a task keeps; longer tokens than SHORT are not kept.
CACHED, SHORT = 3 << 21, 64

_SIGNS = re.escape("".join(LEET))
_SEPS = re.escape(SEPARATORS)
_SINGLE = rf"(?:[^\W_]|[{_SIGNS}])"
# Three or more single characters, each a token of its own, perhaps with a separator before or behind it.
_ONE = rf"[{_SEPS.replace(chr(92) + ' ', '')}]?{_SINGLE}[{_SEPS.replace(chr(92) + ' ', '')}]?"
_SPELLED = re.compile(rf"(?<!\S){_ONE}(?:\s{{1,2}}{_ONE}){{2,}}(?!\S)")
# A stretch that one word may hide in: alphanumerics, signs, and separators between them.
_CORE = re.compile(rf"[^\W_{_SIGNS}]*(?:[{_SIGNS}]|[^\W_])(?:[{_SEPS}]{{0,2}}(?:[^\W_]|[{_SIGNS}]))*")
_DOUBT = re.compile(rf"[{_SIGNS}]|([^\W\d_])\1|[^\W_][{_SEPS}]{{1,2}}[^\W_]")
_LETTER = re.compile(r"[^\W\d_]")
_REPEAT = re.compile(r"(.)\1+")
_UNIT = re.compile(rf"(?P<sign>([{_SIGNS}])\2*)|(?P<sep>[{_SEPS}\s]+)|(?P<run>([^\W\d_])\5+)|(?P<plain>(?:([^\W\d_])(?!\7))+)|(?P<other>.)", re.S)
_WORD = re.compile(r"[^\W_]+")
_BREAKS = re.compile(rf"[{_SEPS}\s]+")


def _class_table() -> np.ndarray:
    """Code point -> class; punctuation and white space are word breaks."""
    table = np.zeros(1 << 16, dtype=np.int32)
    for code in range(1 << 16):
        c = chr(code)
        if c in LETTERS and c:
            table[code] = LETTERS.index(c) + 1
        elif c.isdigit():
            table[code] = DIGIT
        elif c.isalpha():
            table[code] = OTHER
    return table


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    return _class_table()


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(cell, n): character trigrams of every text, summed over the whole corpus.

    A task returns one row per cell at most, and there are `CLASSES` ** 3 cells.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            for t in batch["text"]:
                if not t:
                    continue
                codes = np.frombuffer(f"  {t.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
                k = _classes()[np.minimum(codes, 0xFFFF)]
                cells = (k[:-2] * CLASSES + k[1:-1]) * CLASSES + k[2:]
                if len(cells) > CLASSES**3 // 8:
                    total += np.bincount(cells, minlength=CLASSES**3)
                else:
                    found, n = np.unique(cells, return_counts=True)
                    total[found] += n
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells, "n": total[cells]})

    counted = docs.select(F.col(text).alias("text")).mapInPandas(count, "cell long, n long")
    return counted.groupBy("cell").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """log P(third | first two) as a [CLASSES, CLASSES, CLASSES] table, smoothed by pairs and single characters."""
    # At most CLASSES ** 3 (about 125,000) rows come to the driver, whatever the corpus.
    rows = trigram_counts(docs, text).toPandas()
    n3 = np.zeros(CLASSES**3)
    n3[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    n3 = n3.reshape(CLASSES, CLASSES, CLASSES)
    n2, n1 = n3.sum(0), n3.sum((0, 1))
    p1 = (n1 + 1) / (n1.sum() + CLASSES)
    p2 = (n2 + 20 * p1) / (n2.sum(1, keepdims=True) + 20)
    p3 = (n3 + 5 * p2[None]) / (n3.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


class Kept(dict):
    """A cache that forgets everything once its keys hold `size` characters."""

    def __init__(self, size: int = CACHED) -> None:
        super().__init__()
        self.size, self.held = size, 0

    def put(self, key: str, value):
        if len(key) <= SHORT:
            self.held += len(key) + 32
            if self.held > self.size:
                self.clear()
                self.held = len(key) + 32
            self[key] = value
        return value


class Decoder:
    """Restores disguised stretches; the model is a fixed-size table.

    `known`: says whether a word has features; two short tokens are read as one only then.
    """

    def __init__(self, model: np.ndarray, known: Callable[[str], bool] | None = None) -> None:
        self.model = model.tolist()
        self.known = known
        self.code = {c: i + 1 for i, c in enumerate(LETTERS)}
        self.read = Kept()

    def _class(self, c: str) -> int:
        return self.code.get(c) or (DIGIT if c.isdigit() else OTHER if c.isalpha() else 0)

    def units(self, span: str) -> Iterator[list[tuple[str, float]] | str]:
        """The lattice: plain letters as a string, a doubtful place as its readings with their cost."""
        pieces = [len(p) for p in _BREAKS.split(span)]
        at, n = 0, len(span)
        for m in _UNIT.finditer(span):
            text, kind = m.group(), m.lastgroup
            if kind == "plain" or kind == "other":
                yield text
            elif kind == "run":
                c = text[0]
                yield [(c, DROP * min(2, len(text) - 1)), (c * 2, 0.0 if len(text) == 2 else 2 * DROP)]
            elif kind == "sign":
                c, run = text[0], len(text)
                edge = m.start() == 0 or m.end() == n
                keep = KEEP_EDGE if edge and not c.isdigit() else KEEP * min(run, 2)
                yield [(x * k, SIGN * min(run, 4) + DROP * min(run - k, 4)) for x in LEET[c] for k in sorted({1, min(run, 2)})] + [(text, keep)]
            else:
                left, right = pieces[at], pieces[min(at + 1, len(pieces) - 1)]
                if left == 1 and right == 1:
                    join, split = SPELLED
                    if at in (0, len(pieces) - 2):
                        split = RUN_EDGE
                else:
                    join, split = ODD if set(text) <= set(ODD_SEPARATORS) else PIECES
                at += 1
                yield [("", join), (text, split)]

    def cost(self, state: tuple[int, int], text: str) -> tuple[tuple[int, int], float]:
        """The state after `text`, and its log-probability under the model."""
        a, b = state
        total = 0.0
        for c in text:
            k = self._class(c)
            total += self.model[a][b][k]
            a, b = b, k
        return (a, b), total

    def decode(self, span: str) -> str:
        """Viterbi over (last two classes); a state keeps its best score and a link to its path."""
        found = self.read.get(span)
        return found if found is not None else self.read.put(span, self._decode(span))

    def _decode(self, span: str) -> str:
        out: list[str] = []
        states: dict = {(0, 0): (0.0, None)}

        def settle() -> None:
            # One state is left: what leads to it is certain.
            ((state, (_, path)),) = states.items()
            certain = []
            while path:
                path, piece = path
                certain.append(piece)
            out.extend(reversed(certain))
            states[state] = (0.0, None)

        for unit in self.units(span):
            if isinstance(unit, str):
                at = 0
                while len(states) > 1 and at < len(unit):
                    states = self._step(states, [(unit[at], 0.0)])
                    at += 1
                if len(states) == 1 and at < len(unit):
                    settle()
                    ((state, _),) = states.items()
                    out.append(unit[at:])
                    states = {self.cost(state, unit[max(at, len(unit) - 2) :])[0]: (0.0, None)}
            else:
                states = self._step(states, unit)
        best, path = -math.inf, None
        for (a, b), (score, link) in states.items():
            if (s := score + self.model[a][b][0]) > best:
                best, path = s, link
        states = {(0, 0): (best, path)}
        settle()
        return "".join(out)

    def _step(self, states: dict, options: list[tuple[str, float]]) -> dict:
        reached: dict = {}
        for state, (score, path) in states.items():
            for text, channel in options:
                after, likely = self.cost(state, text)
                s = score + channel + likely
                best = reached.get(after)
                if best is None or s > best[0]:
                    reached[after] = (s, (path, text) if text else path)
        return reached

    def _core(self, m: re.Match) -> str:
        span = m.group()
        return self.decode(span) if _DOUBT.search(span) and _LETTER.search(span) else span

    def _spelled(self, m: re.Match) -> str:
        span = m.group()
        singles = set(_BREAKS.sub("", span))
        return span if len(singles) == 1 or not _LETTER.search(span) else self.decode(span)

    def token(self, token: str) -> str:
        """A token without white space, in lower case, with its disguised stretches restored."""
        return _CORE.sub(self._core, token) if _DOUBT.search(token) else token

    def spelled(self, text: str) -> str:
        """Runs of single characters restored."""
        return _SPELLED.sub(self._spelled, text)

    def pair(self, a: str, b: str) -> str | None:
        """Two short tokens as one word, where the model has such a word and the lattice prefers it."""
        if self.known is None or not self.known(a + b):
            return None
        read = self.decode(f"{a} {b}")
        return read if " " not in read else None

    def restore(self, text: str | None) -> str:
        """The whole text in lower case with its disguised stretches restored."""
        parts = re.split(r"(\s+)", self.spelled((text or "").lower()))
        out = [self.token(p) if i % 2 == 0 else p for i, p in enumerate(parts)]
        for i in range(0, len(parts) - 2, 2):
            if short(parts[i], parts[i + 2]) and (one := self.pair(parts[i], parts[i + 2])):
                out[i], out[i + 1], out[i + 2] = one, "", ""
        return "".join(out)


def short(a: str, b: str) -> bool:
    """May two tokens be pieces of one word?"""
    return len(a) < 5 and len(b) < 5 and a.isalpha() and b.isalpha()


def features(words: Iterable[str]) -> set[str]:
    """Whole words of three letters or more as `=word`, and word beginnings."""
    out = set()
    for w in words:
        if len(w) > 2:
            out.add("=" + w)
            out.update([w[:n] for n in BEGINNINGS if len(w) >= n])
    return out


def _sketch(words: list[str]) -> int:
    """Smallest hash of three-word shingles: copies and near copies of a text mostly share it."""
    if len(words) < 3:
        return zlib.crc32(" ".join(words).encode())
    return min(zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(len(words) - 2))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Scorer:
    """Scores texts one by one; a token's features are looked up once while it is kept."""

    def __init__(self, model: np.ndarray, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias
        # Words that can have a feature: whole ones, and those with the first letters of a beginning.
        first = min(BEGINNINGS)
        self.whole = {f[1:] for f in weights if f[0] == "="}
        self.heads = {f[:first] for f in weights if f[0] != "="}
        self.openers = {w[:n] for w in [*self.heads, *(w for w in self.whole if len(w) >= first)] for n in range(1, first + 1)}
        self.decoder = Decoder(model, lambda word: len(word) >= first and (word[:first] in self.heads or word in self.whole))
        self.found, self.pairs = Kept(), Kept()
        # The same with every run of a letter as one letter.
        self.single_heads = {_REPEAT.sub(r"\1", h) for h in self.heads}
        self.single_whole = {_REPEAT.sub(r"\1", w) for w in self.whole}
        self.short_heads = sorted({len(h) for h in self.single_heads} - {first})

    def _found(self, token: str) -> tuple[str, ...]:
        found = self.found.get(token)
        return found if found is not None else self.found.put(token, self._of(_WORD.findall(self.decoder.token(token))))

    def _of(self, words: Iterable[str]) -> tuple[str, ...]:
        some = [w for w in words if w[:4] in self.heads or w in self.whole]
        return tuple(f for f in features(some) if f in self.weights) if some else ()

    def __call__(self, text: str | None) -> float:
        held: set[str] = set()
        lowered = (text or "").lower()
        tokens = lowered.split()
        # What a run of single characters is made of.
        if "xxx" in "".join(["x" if len(t) < 4 and (len(t) == 1 or not t.isalnum()) else " " for t in tokens]):
            lowered = self.decoder.spelled(lowered)
            tokens = lowered.split()
        # Where nothing but repeated letters is in doubt, every reading is the same with its runs as
        # one letter, and so is the beginning of every reading: most tokens need no reading at all.
        singles, heads, whole = _REPEAT.sub(r"\1", lowered).split(), self.single_heads, self.single_whole
        hopeful = {t for t, s in zip(tokens, singles, strict=True) if s[:4] in heads or s in whole or not t.isalpha()}
        for n in self.short_heads:
            hopeful.update([t for t, s in zip(tokens, singles, strict=True) if s[:n] in heads])
        for t in hopeful:
            held.update(self._found(t))
        openers = self.openers
        tokens.append("")
        for i in [i for i, t in enumerate(tokens) if t in openers]:
            a, b = tokens[i], tokens[i + 1]
            found = self.pairs.get(key := f"{a} {b}")
            if found is None:
                one = self.decoder.pair(a, b) if short(a, b) else None
                found = self.pairs.put(key, self._of([one]) if one else ())
            if found:
                held.update(found)
        z = self.bias + math.fsum(self.weights[f] for f in held)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class ToxicityModel:
    """A character model, and features with weights; small enough to travel in a closure."""

    def __init__(self, model: np.ndarray, weights: dict[str, float], bias: float) -> None:
        self.model, self.weights, self.bias = model, weights, bias

    def score(self, text: Column) -> Column:
        model, weights, bias = self.model, self.weights, self.bias

        @F.pandas_udf("double")
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = Scorer(model, weights, bias)
            for texts in batches:
                yield pd.Series([scorer(t) for t in texts], dtype="float64")

        return apply(text)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 10_000, max_features: int = 4096, support: int = 4, lift: float = 2.0) -> ToxicityModel:
    """Learn from rows that are not held out: at most `fit_rows` labelled ids, the first by a hash.

    `support`: toxic texts of the sample that a feature must occur in; `lift`: how much more
    often it must stand in toxic texts than in others, as a logarithm.
    """
    model = language_model(docs)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = (
        known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    # `fit_rows` rows of two numbers: a proven bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", F.xxhash64("doc_id", "text").alias("row"), "text")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(model)
        for batch in batches:
            out = []
            for toxic, row, t in zip(batch["toxic"], batch["row"], batch["text"], strict=True):
                words = _WORD.findall(decoder.restore(t))
                out.append((toxic, _sketch(words), row, sorted(features(set(words)))))
            yield pd.DataFrame(out, columns=["toxic", "sketch", "row", "features"])

    seen = cut_lineage(
        rows.repartition(24).mapInPandas(read, "toxic int, sketch long, row long, features array<string>"), "toxic-rows"
    )
    one = seen.groupBy("toxic", "sketch").agg(F.min_by("features", "row").alias("features"))
    kinds = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = kinds.get(1, 0), kinds.get(0, 0)
    if not pos or not neg:
        return ToxicityModel(model, {}, 30.0 if pos else -30.0)
    gain = F.log((F.col("p") + 0.5) / (pos + 1.0)) - F.log((F.col("q") + 0.5) / (neg + 1.0))
    chosen = [
        r["feature"]
        for r in one.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("q"))
        .where(F.col("p") >= min(support, pos))
        .withColumn("gain", gain)
        .where(F.col("gain") > lift)
        .orderBy(F.desc(F.col("p") * F.col("gain")), "feature")
        .limit(max_features)
        .select("feature")
        .collect()
    ]
    if not chosen:
        return ToxicityModel(model, {}, math.log(pos / neg))
    held = seen.select("toxic", F.array_intersect("features", F.lit(chosen)).alias("features")).toPandas()  # fit_rows rows
    weights, bias = _logistic(held["features"], held["toxic"].to_numpy(dtype=np.float64), chosen)
    return ToxicityModel(model, weights, bias)


def _logistic(rows: Iterable, y: np.ndarray, names: list[str], penalty: float = 0.05, steps: int = 400) -> tuple[dict[str, float], float]:
    """L2-penalised logistic regression on present features, by full gradients with a step per feature."""
    place = {f: i for i, f in enumerate(names)}
    # Rows come in any order; their sums must not depend on it.
    sets = sorted((float(t), sorted(place[f] for f in r)) for t, r in zip(y, rows, strict=True))
    y = np.array([t for t, _ in sets])
    row = np.repeat(np.arange(len(sets)), [len(r) for _, r in sets])
    col = np.array([i for _, r in sets for i in r], dtype=np.int64)
    w, g2, b, b2 = np.zeros(len(names)), np.full(len(names), 1e-8), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 1e-8
    for _ in range(steps):
        z = b + np.bincount(row, weights=w[col], minlength=len(y))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(col, weights=error[row], minlength=len(names)) + penalty * w
        g2 += g * g
        b2 += error.sum() ** 2
        w -= 0.3 * g / np.sqrt(g2)
        b -= 0.3 * error.sum() / math.sqrt(b2)
    return dict(zip(names, map(float, w), strict=True)), float(b)


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, **options)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that score below 0.5, as they are."""
    return docs.where(fit(docs, labels, **options).score(F.col("text")) < 0.5)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
