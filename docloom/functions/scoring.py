"""Overlap scores of text pairs. Each scores its own row; nothing is shuffled."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from docloom.functions import text as tx


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one machine-word row of bits per step."""
    where: dict[str, int] = {}
    for i, token in enumerate(b):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(b)) - 1
    row = full
    for token in a:
        hit = row & where.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def f1(precision: float, recall: float) -> float:
    return 2 * precision * recall / (precision + recall) if precision + recall else 0.0


@pandas_udf(T.DoubleType())
def _rouge_l(pred: pd.Series, ref: pd.Series) -> pd.Series:
    scores = []
    for p, r in zip(pred.fillna("").str.lower(), ref.fillna("").str.lower()):
        p, r = tx.PYTHON_WORD.findall(p), tx.PYTHON_WORD.findall(r)
        lcs = common_subsequence(p, r)
        scores.append(f1(lcs / len(p), lcs / len(r)) if p and r else 0.0)
    return pd.Series(scores, dtype="float64")


def rouge_l(pred: Column, ref: Column) -> Column:
    """LCS-based F1 over word tokens; 0 when a side is empty or nothing is shared."""
    return _rouge_l(pred, ref)


TINY = 2.2250738585072014e-308  # smallest normal double: stands in for a zero precision


def clipped_matches(hyp: np.ndarray, ref: np.ndarray) -> int:
    """Sum over the distinct codes of the smaller of their counts."""
    codes = int(max(hyp.max(initial=-1), ref.max(initial=-1))) + 1
    return int(np.minimum(np.bincount(hyp, minlength=codes), np.bincount(ref, minlength=codes)).sum())


def bleu_of(hyp: list[str], ref: list[str], order: int = 4) -> float:
    known: dict[str, int] = {}
    words = [np.fromiter((known.setdefault(w, len(known)) for w in side), dtype=np.int64) for side in (hyp, ref)]
    grams, logs = words, 0.0
    for n in range(1, order + 1):
        if n > 1:
            # An n-gram is its (n-1)-gram and one more word; dense codes keep the numbers small.
            longer = [g[:-1] * len(known) + w[n - 1:] for g, w in zip(grams, words)]
            dense = np.unique(np.concatenate(longer), return_inverse=True)[1]
            grams = [dense[: len(longer[0])], dense[len(longer[0]):]]
        matched = clipped_matches(*grams)
        if n == 1 and not matched:
            return 0.0
        ratio = matched / max(1, len(hyp) - n + 1)
        logs += math.log(ratio if matched else TINY) / order
    penalty = 1.0 if len(hyp) > len(ref) else math.exp(1 - len(ref) / len(hyp))
    return penalty * math.exp(logs)


@pandas_udf(T.DoubleType())
def _bleu(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    pairs = zip(hyp.fillna(""), ref.fillna(""))
    return pd.Series([bleu_of(h.split(), r.split()) for h, r in pairs], dtype="float64")


def bleu4(hyp: Column, ref: Column) -> Column:
    """Sentence BLEU with four n-gram orders over white-space tokens, one reference, no smoothing."""
    return _bleu(hyp, ref)


def support_ratio(claim: Column, evidence: Column) -> Column:
    """Share of the distinct claim tokens found in the evidence.

    A lexical stand-in: with the reference answer as claim it plays the part of
    context recall, with the prediction that of faithfulness. It is not the
    model-judged metric of either name.
    """
    asked = F.array_distinct(tx.tokens(claim))
    return F.coalesce(
        F.size(F.array_intersect(asked, tx.tokens(evidence))) / F.nullif(F.size(asked), F.lit(0)), F.lit(0.0))
