"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades 0..K-1 follow P(grade <= k) = sigmoid(theta_k - w.x) with one weight vector
for all thresholds and theta ascending. Features are the words of a text and the
first five letters of longer words, present or not, by 64-bit hash; those count
that occur in ``min_docs`` sampled texts and whose presence goes with the label (chi-square).
The model is fitted on the texts of at most about ``sample`` labelled ids, chosen by
hash of the id, and then scores every text. The score is the expected
severity, the sum over k of P(grade > k); a text is toxic if P(grade > 0) >= 0.5.

``labels`` with a 0/1 column become three grades: 0, and the positive rows
parted at the median number of features that speak for them.

Defined cases: null or empty texts have no features; null labels are left out;
an id labelled more than once takes its largest label; without labels of both
kinds nothing is toxic; repeated rows score alike; an empty table gives no rows; a very
long text is scored whole, a word at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, stage, unpacked

_WORD = re.compile(r"[^\W\d_]+")
_PREFIX = 5
#: Words whose features a worker keeps.
CACHE = 300_000
SCORE = "expected_severity double, p_toxic double, grade int"


def word_features(word: str) -> list[int]:
    own = [xxhash.xxh3_64_intdigest(word) >> 1]
    if len(word) > _PREFIX:
        own.append(xxhash.xxh3_64_intdigest("^" + word[:_PREFIX]) >> 1)
    elif len(word) == _PREFIX:
        own.append(xxhash.xxh3_64_intdigest("^" + word) >> 1)
    return own


def text_features(text: str | None) -> list[int]:
    words = set(_WORD.findall(text.lower())) if text else ()
    return sorted({f for w in words for f in word_features(w)})


@dataclass
class Model:
    """Weights by feature, and the thresholds."""

    weights: dict[int, float]
    theta: np.ndarray

    def chances(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        return 1 / (1 + np.exp(np.clip(self.theta[None, :] - score[:, None], -60, 60)))


def choose_features(rows: DataFrame, n: int, positive: int, min_docs: int, chi2: float) -> DataFrame:
    """rows (y boolean, f array of features) -> (feature, speaks): those with enough support and a chi-square against
    ``y`` of at least ``chi2``, and whether each speaks for it. Counted where the rows are."""
    seen = rows.select("y", F.explode("f").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("d"), F.count_if("y").alias("a"))
    a, d, n_, p = F.col("a").cast("double"), F.col("d").cast("double"), F.lit(float(n)), F.lit(float(positive))
    x = F.when(d < n_, n_ * F.pow(a * (n_ - p) - (d - a) * p, F.lit(2.0)) / (d * (n_ - d) * p * (n_ - p)))
    return seen.filter((d >= min_docs) & (x >= chi2)).select("feature", (a * n_ > d * p).alias("speaks"))


def grades_of(rows: list[np.ndarray], positive: np.ndarray, speaking: np.ndarray) -> np.ndarray:
    """Three grades from a 0/1 label: positives part at the median number of features that speak for them."""
    n = np.array([np.isin(r, speaking, assume_unique=True).sum() for r in rows])
    middle = np.median(n[positive]) if positive.any() else 0
    return np.where(positive, 1 + (n > middle), 0)


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, features: np.ndarray, grades_n: int, l2: float = 0.2, steps: int = 300, rate: float = 0.1) -> Model:
    """Penalised maximum likelihood of the cumulative-link model by Adam over all rows."""
    nth = [np.searchsorted(features, r[np.isin(r, features, assume_unique=True)]) for r in rows]
    col = np.concatenate(nth) if nth else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in nth])
    n, k = len(rows), grades_n - 1
    above = grades[:, None] > np.arange(k)[None, :]
    share = np.clip(above.mean(axis=0), 1e-6, 1 - 1e-6)
    theta = np.log((1 - share) / share)
    # theta_0, then log steps between thresholds, so that they ascend
    par = np.concatenate((np.zeros(len(features)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))))
    m, v = np.zeros_like(par), np.zeros_like(par)
    edge = np.zeros((n, 1))
    for t in range(1, steps + 1):
        w, gaps = par[: len(features)], np.exp(par[len(features) + 1 :])
        theta = par[len(features)] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(row, w[col], n)
        p = 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -60, 60)))  # P(grade > k)
        full = np.concatenate((1 + edge, p, edge), axis=1)
        own = np.maximum(full[np.arange(n), grades] - full[np.arange(n), grades + 1], 1e-12)
        slope = np.concatenate((edge, p * (1 - p), edge), axis=1)
        up, down = slope[np.arange(n), grades] / own, slope[np.arange(n), grades + 1] / own
        g_score = down - up  # of the negative log likelihood
        g_theta = np.zeros(k)
        np.add.at(g_theta, grades[grades > 0] - 1, up[grades > 0])
        np.add.at(g_theta, grades[grades < k], -down[grades < k])
        tail = np.cumsum(g_theta[::-1])[::-1]
        grad = np.concatenate((np.bincount(col, g_score[row], len(features)) + l2 * w, tail[:1], tail[1:] * gaps)) / max(n, 1)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        par = par - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    theta = par[len(features)] + np.concatenate(([0.0], np.cumsum(np.exp(par[len(features) + 1 :]))))
    return Model(dict(zip(features.tolist(), par[: len(features)].tolist(), strict=True)), theta)


@F.pandas_udf(T.ArrayType(T.LongType()))
def features_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([text_features(t) for t in texts])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, min_docs: int = 5, chi2: float = 10.83, seed: int = 5) -> Model:
    """Fit on the texts of at most about ``sample`` labelled ids, chosen by hash of the id."""
    known = labels.select(labels[id_col].alias("lid"), labels[label_col].cast("int").alias("y")).dropna().groupBy("lid").agg(F.max("y").alias("y"))
    share = min(1.0, sample / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64("lid", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))  # about ``sample`` rows
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("lid"))
    texts = texts.dropDuplicates(["id", "text"])  # a repeated row is one example
    rows = stage(texts.select((F.col("y") > 0).alias("y"), features_udf("text").alias("f"), F.monotonically_increasing_id().alias("k")), "toxicity-sample")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("p")).first()
    if not total.p or total.p == total.n:
        return Model({}, np.full(2, 60.0))
    kept = stage(choose_features(rows, total.n, total.p, min_docs, chi2), "toxicity-features")
    features = kept.toPandas().sort_values("feature")
    own = rows.select("k", F.explode("f").alias("feature")).join(F.broadcast(kept.select("feature")), "feature").groupBy("k").agg(F.collect_list("feature").alias("f"))
    got = rows.select("k", "y").join(own, "k", "left").orderBy("k").toArrow()  # the kept features of the sample
    y = got.column("y").to_numpy()
    lists = [np.sort(np.asarray(x.values, np.int64)) if x.is_valid else np.empty(0, np.int64) for x in got.column("f")]
    keys, speak = features["feature"].to_numpy(np.int64), features["speaks"].to_numpy(bool)
    return fit_ordinal(lists, grades_of(lists, y, keys[speak]), keys, 3)


def score_udf(docs: DataFrame, model: Model):
    """Expected severity, P(grade > 0) and the likeliest grade of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCORE)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, known = shared.value, {}
        weights = model.weights

        def features(word: str) -> tuple[int, ...]:
            own = tuple(f for f in word_features(word) if f in weights)
            if len(known) < CACHE:
                known[word] = own
            return own

        for part in parts:
            score = np.zeros(len(part))
            for i, text in enumerate(part):
                if text:
                    own = {f for w in set(_WORD.findall(text.lower())) for f in (known[w] if w in known else features(w))}
                    score[i] = sum(weights[f] for f in sorted(own))
            p = model.chances(score)
            whole = np.concatenate((np.ones((len(p), 1)), p, np.zeros((len(p), 1))), axis=1)
            yield pd.DataFrame({"expected_severity": p.sum(axis=1), "p_toxic": p[:, 0], "grade": np.argmax(whole[:, :-1] - whole[:, 1:], axis=1).astype(np.int32)})

    return score


def is_toxic(score: Column) -> Column:
    return score.getField("p_toxic") >= 0.5


def severity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, expected_severity, p_toxic, grade, toxic."""
    rows = docs.select(docs[id_col].alias("id"), score_udf(docs, model)(docs[text_col]).alias("s"))
    return rows.select("id", "s.*", is_toxic(F.col("s")).alias("toxic"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns."""
    rows = packed(docs, s=score_udf(docs, model)(docs[text_col]))
    return unpacked(rows.filter(~is_toxic(F.col("s"))), docs.columns)
