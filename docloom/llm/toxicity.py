"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel compares two words by the subsequences of four symbols they share, each spanning
at most six symbols; every symbol skipped costs a factor. So an insult with a letter put in,
a letter swapped for a digit, or dots between its letters stays close to the insult itself.

The machine is trained on sentences: every word of a clean document's sentences is a negative
case; of a toxic document, the words that mark its worst sentence are positive. Which those
are is settled in rounds, since labels are given per document only. A document's score is its
worst sentence's, a sentence's its worst word's.

With Nyström landmarks the decision is linear in the kernel values to the landmarks, and
those are sums over subsequences. So the trained machine folds into one table of subsequence
weights, and scoring a text is a few lookups per character, whatever the number of landmarks.
"""

from __future__ import annotations

import unicodedata
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import columns_of

EDGE = 27  # stands between words, and belongs to the subsequences at a word's start and end
#: Digits and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
SKIP = 0.6  # factor for each symbol skipped
PATTERNS = [(a, b, c) for a, b, c in combinations(range(1, 6), 3)]
CHUNK = 1_000_000  # characters taken at once


def _symbol(c: str) -> int:
    if c.isspace():
        return EDGE
    base = LOOKALIKES.get(c) or unicodedata.normalize("NFD", c.lower())[0].replace("ß", "s")
    if "a" <= base <= "z":
        return ord(base) - ord("a") + 1
    return 28 + ord(c) % 4 if c.isalpha() else 0


_SYMBOLS = np.array([_symbol(chr(i)) if not 0xD800 <= i < 0xE000 else 0 for i in range(0x3100)], np.uint8)


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < len(_SYMBOLS), _SYMBOLS[np.minimum(points, len(_SYMBOLS) - 1)], (28 + points % 4).astype(np.uint8))


def _sequence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts' words with an edge before and after each word, and the text of each symbol."""
    parts = [_codes(t) for t in texts]
    owner = np.repeat(np.arange(len(parts)), [len(p) + 1 for p in parts])
    edge = np.array([EDGE], np.uint8)
    s = np.concatenate([x for p in parts for x in (p, edge)] + [np.zeros(0, np.uint8)])
    kept = s > 0
    s, owner = s[kept], owner[kept]
    s, owner = np.concatenate([edge, s]), np.concatenate([owner[:1], owner])
    once = np.ones(len(s), bool)
    once[1:] = ~((s[1:] == EDGE) & (s[:-1] == EDGE))
    s, owner = s[once], owner[once]
    # Letters set apart by blanks read as one word: no edge inside a run of three single letters or more.
    edges = np.flatnonzero(s == EDGE)
    single = np.diff(edges) == 2
    same = single[1:] & single[:-1] & (owner[edges[1:-1] - 1] == owner[np.minimum(edges[1:-1] + 1, len(s) - 1)])
    run = np.cumsum(np.concatenate([[0], same[1:] != same[:-1]])) if len(same) else same.astype(int)
    wide = same & (np.bincount(run)[run] >= 2) if len(same) else same
    keep = np.ones(len(s), bool)
    keep[edges[1:-1][wide]] = False
    return s[keep], owner[keep]


def _subsequences(s: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each gap pattern: start positions, subsequence numbers, weight. None crosses a word's edge."""
    n = len(s)
    wide = s.astype(np.int32)
    at = np.where(s == EDGE, np.arange(n), n)
    following = np.minimum.accumulate(np.append(at, n)[::-1])[::-1][1:]
    room = following - np.arange(n)
    for last in (3, 4, 5):
        starts = np.flatnonzero(room >= last)
        starts = starts[starts + last < n]
        head, tail = wide[starts] << 15, wide[starts + last]
        for a, b, c in PATTERNS:
            if c == last:
                yield starts, head | wide[starts + a] << 10 | wide[starts + b] << 5 | tail, SKIP ** (c - 3)


@dataclass
class Model:
    """Weights of all subsequences, the bias, and the scale from decision values to scores."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    longer: float

    def decisions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols, starts of words, decision value of each word, text of each word."""
        s, owner = _sequence(texts)
        total, norm = np.zeros(len(s), np.float32), np.zeros(len(s), np.float32)
        for starts, number, weight in _subsequences(s):
            total[starts] += weight * self.weights[number]
            norm[starts] += weight * weight
        words = np.flatnonzero(s == EDGE)[:-1]
        if not len(words):
            return s, words, np.zeros(0), owner[words]
        value = np.add.reduceat(total, words) / np.sqrt(np.maximum(np.add.reduceat(norm, words), 1e-9)) + self.bias
        return s, words, value, owner[np.minimum(words + 1, len(s) - 1)]

    def worst(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Highest decision value of each text (the bias if it has no words) and its number of words."""
        best, count = np.full(len(texts), self.bias), np.zeros(len(texts))
        _, _, value, owner = self.decisions(texts)
        np.maximum.at(best, owner, value)
        np.add.at(count, owner, 1)
        return best, count

    def scores(self, best: np.ndarray, count: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * best + self.longer * np.log1p(count) + self.offset)))


def _pieces(text: str) -> list[str]:
    """A text in parts of about ``CHUNK`` characters, cut at blanks where there are any nearby."""
    parts, at = [], 0
    while len(text) - at > CHUNK:
        cut = text.find(" ", at + CHUNK, at + CHUNK + 10_000)
        cut = at + CHUNK if cut < 0 else cut
        parts.append(text[at:cut])
        at = cut
    return [*parts, text[at:]]


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    """Scores of any texts, a bounded number of characters at a time."""
    best, count = np.full(len(texts), model.bias), np.zeros(len(texts))
    rows: list[int] = []
    held: list[str] = []

    def flush() -> None:
        if held:
            value, n = model.worst(held)
            np.maximum.at(best, rows, value)
            np.add.at(count, rows, n)
            rows.clear(), held.clear()

    size = 0
    for i, text in enumerate(texts):
        for part in _pieces(text or ""):
            rows.append(i), held.append(part)
            size += len(part)
            if size >= CHUNK:
                flush()
                size = 0
    flush()
    return model.scores(best, count)


def _words(s: np.ndarray) -> list[bytes]:
    return [w for w in s.tobytes().split(bytes([EDGE])) if len(w) > 1]


def _features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, subsequence and weight of every subsequence of every word, divided by the word's norm."""
    edge = bytes([EDGE])
    s = np.frombuffer(edge + edge.join(words) + edge, np.uint8)
    edges = np.flatnonzero(s == EDGE)
    found = list(_subsequences(s))
    starts = np.concatenate([x for x, _, _ in found])
    number = np.concatenate([x for _, x, _ in found])
    weight = np.concatenate([np.full(len(x), w, np.float32) for x, _, w in found])
    word = np.searchsorted(edges, starts, "right") - 1
    norm = np.sqrt(np.bincount(word, weight.astype(np.float64) ** 2, len(words)))
    return word, number, weight / np.maximum(norm[word], 1e-9)


class _Nystroem:
    """Kernel values to the landmarks, turned so that their products approximate the kernel."""

    def __init__(self, landmarks: list[bytes]):
        word, number, weight = _features(landmarks)
        self.known = np.unique(number)
        self.place = np.zeros(1 << 20, np.int32)
        self.place[self.known] = np.arange(1, len(self.known) + 1)
        self.table = np.zeros((len(self.known) + 1, len(landmarks)), np.float32)
        np.add.at(self.table, (self.place[number], word), weight)
        values, vectors = np.linalg.eigh(self._kernel(landmarks).astype(np.float64) + 1e-6 * np.eye(len(landmarks)))
        kept = values > 1e-4 * values[-1]
        self.turn = vectors[:, kept] / np.sqrt(values[kept])

    def _kernel(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]), np.float32)
        for at in range(0, len(words), 1000):
            word, number, weight = _features(words[at:at + 1000])
            place = self.place[number]
            order = np.flatnonzero(place > 0)
            order = order[np.argsort(word[order], kind="stable")]
            if len(order):
                owner = word[order]
                first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                out[at + owner[first]] = np.add.reduceat(self.table[place[order]] * weight[order, None], first, axis=0)
        return out

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return self._kernel(words) @ self.turn

    def fold(self, w: np.ndarray) -> np.ndarray:
        weights = np.zeros(1 << 20, np.float32)
        weights[self.known] = self.table[1:] @ (self.turn @ w)
        return weights


def _machine(x: np.ndarray, y: np.ndarray, c: np.ndarray, steps: int = 40) -> np.ndarray:
    """Support vector machine with squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, ridge = np.zeros(x.shape[1]), np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa = x[active] * np.sqrt(c[active, None]).astype(x.dtype)
        new = np.linalg.solve(ridge + (xa.T @ xa).astype(float), (xa.T @ (y[active] * np.sqrt(c[active])).astype(x.dtype)).astype(float))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts, each with the place of its first: 50 at most, and fewer where they are long."""
    at, held = 0, 0
    for k, text in enumerate(texts):
        if k > at and (k - at == 50 or held + len(text) > CHUNK // 2):
            yield at, texts[at:k]
            at, held = k, 0
        held += len(text)
    if at < len(texts):
        yield at, texts[at:]


def train(texts: list[str], toxic: list[int], weights: list[float] | None = None, landmarks: int = 160,
          rounds: int = 4, negatives: int = 15_000, seed: int = 11) -> Model:
    """A model from labelled texts. Without texts of both labels it scores every text by the share of toxic ones.

    Each round trains on ``negatives`` clean words and half as many of those it scored worst, so the memory
    it takes does not depend on the texts.
    """
    y = np.array(toxic, int)
    weight = np.ones(len(y)) if weights is None else np.array(weights, float)
    share = float((weight * y).sum() / weight.sum()) if len(y) else 0.0
    if len(set(toxic)) < 2:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(np.zeros(1 << 20, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))), 0.0)
    rng = np.random.default_rng(seed)
    bags = [set(_words(_sequence([t])[0])) for t in texts]
    bad, good = Counter(), Counter()
    for bag, label in zip(bags, y):
        (bad if label else good).update(bag)
    n_bad, n_good = int(y.sum()), int((1 - y).sum())

    def odds(w: bytes) -> float:
        return float(np.log((bad[w] + 0.1) / (n_bad + 1)) - np.log((good[w] + 0.5) / (n_good + 1)))

    marks = [w for w, n in bad.items() if n >= 3 and odds(w) > 2]
    marks = sorted(marks or bad, key=lambda w: (-odds(w) * bad[w] ** 0.5, w))[:400]
    clean = sorted(good)
    clean = [clean[i] for i in rng.permutation(len(clean))[:negatives]] or [b"\x01\x01"]
    chosen = Counter({w: bad[w] for w in marks})
    hard: list[bytes] = []
    model = Model(np.zeros(1 << 20, np.float32), 0.0, 1.0, 0.0, 0.0)
    for _ in range(rounds):
        half = landmarks // 2
        top = [w for w, _ in sorted(chosen.items(), key=lambda p: (-p[1], p[0]))[:half]]
        space = _Nystroem(top + [w for w in clean[:landmarks - len(top)] if w not in chosen])
        # Each insult also with one letter put in, so that the machine learns to look past it.
        spread = {w[:i] + bytes([rng.integers(1, EDGE)]) + w[i:]: 0.5 for w in top if len(w) > 3
                  for i in rng.integers(1, len(w), 3)}
        for w in spread:
            chosen.setdefault(w, spread[w])
        pos = sorted(chosen)
        neg = [w for w in dict.fromkeys(clean + hard) if w not in chosen]
        x = space(pos + neg).astype(np.float32)
        n_pos = np.array([chosen[w] for w in pos], float)
        cost = np.concatenate([np.minimum(n_pos, 20.0), np.ones(len(neg))])
        w = _machine(x, np.array([1.0] * len(pos) + [-1.0] * len(neg)), 10.0 * cost)
        model = Model(space.fold(w[:-1]), float(w[-1]), 1.0, 0.0, 0.0)
        # The worst word of each toxic text is its positive case; clean words over the margin become negative ones.
        chosen, over = Counter(), {}
        for at, part in _parts(texts):
            s, starts, value, owner = model.decisions(part)
            ends = np.append(starts[1:], len(s) - 1) if len(starts) else starts
            order = np.lexsort((-value, owner))
            first = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])] if len(order) else order
            for i in first:
                if y[at + owner[i]] == 1:
                    chosen[s[starts[i] + 1:ends[i]].tobytes()] += 1
            for i in np.flatnonzero((value > -0.5) & (y[at + owner] == 0)):
                over[s[starts[i] + 1:ends[i]].tobytes()] = float(value[i])
        # A word that clean texts hold as often marks no toxic one.
        chosen = Counter({w: n for w, n in chosen.items() if len(w) > 1 and odds(w) > 1}) or chosen
        hard = sorted((w for w in over if len(w) > 1), key=lambda w: (-over[w], w))[:negatives // 2]
    best, count = [np.concatenate(x) for x in zip(*[model.worst(part) for _, part in _parts(texts)])]
    x = np.stack([best, np.log1p(count), np.ones(len(best))], 1)
    fit = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3)
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-3 * fit)
        fit += step
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.longer, model.offset = float(fit[0]), float(fit[1]), float(fit[2])
    return model


def held_out(doc_id) -> F.Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
              per_label: int = 1500, longest: int = 8_000) -> Model:
    """Train on labelled rows that are not held out: of each label at most ``per_label`` ids that have a text, drawn by a
    hash of the id, those of up to ``longest`` characters first. Longer texts follow whole, as far as the sample of a
    label stays within ``per_label * longest`` characters. This bounded sample is all that comes to the driver.
    A label that has ids but no text in the sample is warned of, since no document can then be told apart."""
    marked = columns_of(labels, doc_id=id_col, toxic=label_col).where("toxic IN (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Ids and lengths are drawn first: a few thousand at most, so they are sent to the texts and not the texts to them.
    texts = columns_of(docs, doc_id=id_col, text=text_col).where(F.length("text") >= 1)
    usable = texts.select("doc_id", F.length("text").cast("long").alias("n")).groupBy("doc_id").agg(F.sum("n").alias("n")).join(marked, "doc_id")
    drawn = []
    for label in (0, 1):
        of_label = usable.where(F.col("toxic") == label).orderBy(F.col("n") > longest, F.xxhash64("doc_id"), "doc_id").limit(per_label)
        left = per_label * longest
        for r in of_label.collect():
            if r["n"] <= left:
                left -= r["n"]
                drawn.append((r["doc_id"], label))
    ids = docs.sparkSession.createDataFrame(drawn, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, toxic int")
    rows = texts.join(F.broadcast(ids), "doc_id").select("text", "toxic").distinct().collect()
    for label in sizes:
        if not any(r["toxic"] == label for r in rows):
            warnings.warn(f"no text to train on for label {label}, which {sizes[label]} ids have: every text will get the same score", stacklevel=2)
    rows = sorted((r["text"], r["toxic"]) for r in rows)
    share = {label: sizes.get(label, 0) / max(1, sum(k == label for _, k in rows)) for label in (0, 1)}
    return train([t for t, _ in rows], [k for _, k in rows], [share[k] for _, k in rows])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    A null or empty text has the score of a text without words. Labels, ids, languages and sources are no
    input. Null and repeated ids keep their rows, an empty table gives an empty result, other columns are ignored.
    """
    rows = columns_of(docs, doc_id=id_col, text=text_col)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(score_texts(model, text.tolist()))

    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that score below 0.5, with all their columns as they are. Null and empty texts are scored like texts without a word."""

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(score_texts(model, text.tolist()))

    return docs.where(scored(F.col(f"`{text_col}`")) < 0.5)
