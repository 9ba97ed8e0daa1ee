"""Toxicity by maximum-scoring segments.

Training.  Words of labelled texts are counted by class, once for each pair of neighbours
they stand between, so that copies of a text count once; a word's score is its log-odds,
toxic against clean, with a Dirichlet prior proportional to its overall count, taken
``SHRINK`` standard errors nearer to zero, less a drift ``DRIFT`` that makes an ordinary word
cost something.  Training rows are a bounded sample,
``SAMPLE_PER_CLASS`` of each class, chosen by hash; the model keeps at most ``VOCABULARY``
words, those with the strongest scores.

Scoring.  One linear scan finds every maximal segment of a text whose word scores sum
highest (Ruzzo and Tompa's algorithm).  Segment sums of clean text follow an extreme-value
law: with n words, the best is above S with probability 1 - exp(-K n exp(-lambda S)).
lambda solves E[exp(lambda s)] = 1 over clean words, K is fitted to the clean texts' best
segments.  A text's evidence is the sum of lambda S - log(K n) over its significant
segments; a logistic curve fitted on a quarter of the training sample, from which no word
scores were learnt, turns the evidence into a score between 0 and 1.

Defined cases.  Null, empty and wordless texts have no evidence and get the curve's lowest
score.  Null labels and labels of unknown documents teach nothing; a document with several
labels counts as toxic if one says so.  Without a labelled text of each class every score
is 0.  Repeated rows score alike, and each ill-formed part of a text is U+FFFD.  Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import staged, texts_of

SAMPLE_PER_CLASS = 8_000
VOCABULARY = 50_000
#: Pseudo-counts of the prior, as a share of the counted words.
PRIOR_SHARE = 0.01
SHRINK = 1.0
DRIFT = 0.75
MIN_COUNT = 3
#: A segment is reported as a passage if clean text of that length has one as good with at
#: most this probability.
SIGNIFICANT = 0.01

_NORMAL = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 else c + 32 if 0x41 <= c <= 0x5A else 32
    for c in range(256))


def text_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of letters, digits and non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def maximal_segments(positions, scores) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, to, sum), in order.

    ``positions`` are the words with positive scores, ``scores`` the running sums of all
    scores up to and including each word (with a leading 0).
    """
    found: list[list] = []  # from, to, sum before, sum after
    for i in positions:
        cur = [i, i + 1, scores[i], scores[i + 1]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= cur[2]:
                j -= 1
            if j < 0 or found[j][3] >= cur[3]:
                found.append(cur)
                break
            cur = [found[j][0], cur[1], found[j][2], cur[3]]
            del found[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in found]


@dataclass
class Model:
    """Word scores and the calibration; a few megabytes at most."""

    scores: dict[bytes, float]
    rest: float
    lam: float
    log_k: float
    slope: float
    offset: float

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words and the maximal segments (first word, end, sum)."""
        from itertools import accumulate, repeat

        found = text_words(text)
        values = list(map(self.scores.get, found, repeat(self.rest)))
        hot = [i for i, v in enumerate(values) if v > 0]
        if not hot:
            return len(found), []
        return len(found), maximal_segments(hot, [0.0, *accumulate(values)])

    def evidence(self, n: int, segments) -> float:
        if not segments:
            return 0.0
        base = self.log_k + math.log(max(n, 1))
        return sum(max(0.0, self.lam * s - base) for _, _, s in segments)

    def probability(self, evidence: float) -> float:
        z = self.slope * math.log1p(evidence) + self.offset
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))

    def passages(self, n: int, segments) -> list[tuple[int, int]]:
        """Word spans of the significant segments."""
        base = self.log_k + math.log(max(n, 1))
        return [(a, b) for a, b, s in segments
                if 1 - math.exp(-math.exp(min(50.0, base - self.lam * s))) <= SIGNIFICANT]


def _word_list(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                          "abcdefghijklmnopqrstuvwxyz")
    parts = F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.filter(parts, lambda w: w != "")


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """text, toxic and fit (0 for the quarter that calibrates) of a bounded sample of the
    labelled rows, staged."""
    one = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    parts = [one.filter(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(per_class)
             for c in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).withColumnRenamed("doc_id", "l_id")
    # at most 2 * per_class rows of an id and a flag
    texts = docs.select("doc_id", F.make_valid_utf8("text").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    fit = F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(4)) > 0
    return staged(texts.select("text", "toxic", fit.alias("fit")), "toxicity-sample")


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS,
          vocabulary: int = VOCABULARY) -> Model:
    """The model for ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    sample = training_sample(docs, labels, per_class)
    found = sample.filter("fit").select("toxic", F.explode(F.array(_word_list(F.col("text")))).alias("words"))
    places = F.transform("words", lambda w, i: F.struct(w.alias("word"), F.xxhash64(
        F.get("words", i - 1), w, F.get("words", i + 1)).alias("between")))
    each = found.select("toxic", F.inline(places)).distinct()
    counts = each.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    counts = staged(counts.filter(F.col("t") + F.col("c") >= MIN_COUNT), "toxicity-counts")
    totals = counts.agg(F.sum("t"), F.sum("c")).first()
    toxic, clean = (float(x or 0) for x in totals)
    if not toxic or not clean:
        return Model({}, -DRIFT, 1.0, 0.0, 0.0, -50.0)
    mass = PRIOR_SHARE * (toxic + clean)
    prior = (F.col("t") + F.col("c")) * PRIOR_SHARE

    def odds(n, total):
        return F.log((n + prior) / (total + mass - n - prior))

    error = F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior))
    raw = odds(F.col("t"), toxic) - odds(F.col("c"), clean)
    scored = counts.select("word", "c", (F.signum(raw) * F.greatest(
        F.lit(0.0), F.abs(raw) - SHRINK * error)).alias("llr"))
    rows = scored.filter("llr <> 0").orderBy(F.abs("llr").desc(), "word").limit(vocabulary).collect()
    scores = {r["word"].encode("utf-8", "surrogatepass"): r["llr"] - DRIFT for r in rows}
    lam = _lambda([(r["c"] / clean, r["llr"] - DRIFT) for r in rows], -DRIFT)
    model = Model(scores, -DRIFT, lam, 0.0, 1.0, 0.0)
    held = model_evidence(sample, model).toPandas()  # a row of numbers per sampled text
    share = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").agg(F.avg(
        (F.col("toxic") > 0).cast("int"))).first()[0]
    _calibrate(model, held, share)
    return model


def _lambda(steps: list[tuple[float, float]], rest: float) -> float:
    """The positive root of E[exp(lambda s)] = 1 over clean words."""
    steps = [*steps, (max(0.0, 1 - sum(p for p, _ in steps)), rest)]

    def excess(x):
        return sum(p * math.exp(min(600.0, x * s)) for p, s in steps) - 1

    low, high = 1e-3, 1e-3
    while excess(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return (low + high) / 2


def model_evidence(sample: DataFrame, model: Model) -> DataFrame:
    """n, sums (of the segments), toxic and fit of the sampled texts."""
    shared = sample.sparkSession.sparkContext.broadcast(vars(model))

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        m = Model(**shared.value)
        for pdf in frames:
            rows = [m.segments(t) for t in pdf["text"]]
            yield pd.DataFrame({"n": [n for n, _ in rows], "sums": [[s for _, _, s in g] for _, g in rows],
                                "toxic": pdf["toxic"], "fit": pdf["fit"]})

    return sample.mapInPandas(run, "n bigint, sums array<double>, toxic int, fit boolean")


def _calibrate(model: Model, held, share: float) -> None:
    """K from the clean texts that calibrate, then the logistic curve of the evidence, with
    the classes weighted as among all labels (``share``: of toxic ones)."""
    import numpy as np

    part = held[~held["fit"]] if (~held["fit"]).any() and held[~held["fit"]]["toxic"].nunique() == 2 else held
    clean = part[part["toxic"] == 0]
    best = np.array([max(s, default=0.0) if len(s) else 0.0 for s in clean["sums"]])
    n = np.maximum(clean["n"].to_numpy(float), 1.0)
    # maximum likelihood of K for P(best <= S) = exp(-K n exp(-lambda S))
    model.log_k = float(-np.log(np.mean(n * np.exp(-model.lam * best)) or 1.0))
    x = np.log1p([model.evidence(m, [(0, 0, v) for v in s])
                  for m, s in zip(part["n"], part["sums"], strict=True)])
    y = part["toxic"].to_numpy(float)
    design = np.column_stack([x, np.ones_like(x)])
    beta = np.zeros(2)
    weight = np.where(y > 0, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        grad = design.T @ (weight * (y - p)) - 1e-2 * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.linalg.solve(hess, grad)
    model.slope, model.offset = max(0.0, float(beta[0])), float(beta[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and passages (word spans) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = Model(**shared.value)
        for batch in batches:
            scores, spans = [], []
            for text in texts_of(batch.column("text")):
                n, segments = m.segments(text)
                scores.append(m.probability(m.evidence(n, segments)))
                spans.append(m.passages(n, segments))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "score", "predicted", "passages"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, score double, predicted int, passages array<array<bigint>>")
