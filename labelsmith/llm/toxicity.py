"""Toxic passages by maximum-scoring segment search (operator 3)."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_mod, documents

WORD = re.compile(r"\w+")
#: Leading letters that stand for a word of which too little was seen.
PREFIXES = (7, 5)
BLOCK = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Parameters of training and scoring.

    ``max_labelled``: labelled documents learnt from (more are cut to those of least hashed id); ``prior``: weight of the Dirichlet prior as a
    share of the counts; ``min_z``: least z of a kept feature; ``drift``: taken off per word, so that
    passages end; ``alpha``: significance of a passage.
    """

    max_labelled: int = 200_000
    prior: float = 0.1
    min_z: float = 2.5
    drift: float = 0.02
    alpha: float = 0.05


@dataclass
class Model:
    """Weights per feature, extreme-value parameters of clean documents, and the calibration."""

    weights: dict[str, float] = field(default_factory=dict)
    location: float = 0.0
    growth: float = 0.0
    scale: float = 1.0
    intercept: float = -4.0
    slope: float = 0.0
    settings: Settings = Settings()


def features(word: str) -> list[str]:
    """The word itself, then its leading letters, the more specific first."""
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) > n]]


def words_in(text: str) -> Iterator[list[str]]:
    """Lower-cased words of a text, in blocks cut at white space."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and not text[end].isspace():
            end += 1
        yield WORD.findall(text[at:end].lower())
        at = end


class Weights(dict):
    """Word -> weight of its most specific feature; remembers a bounded number of words."""

    def __init__(self, of: dict[str, float], room: int = 300_000):
        super().__init__()
        self.of, self.room = of, room

    def __missing__(self, word: str) -> float:
        w = next((self.of[f] for f in features(word) if f in self.of), 0.0)
        if len(self) >= self.room:
            self.clear()
        self[word] = w
        return w


def maximal_segments(steps: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first place, last place, score)`` in linear time.

    ``steps``: places with a weight, in order; each place between them costs ``drift``. Segments are
    disjoint, and none can be made longer or shorter to score more (Ruzzo and Tompa's algorithm):
    a stack holds candidate segments with the running total before and after each; a new one joins
    the stack's top as long as the last one that began lower also ends lower.
    """
    stack: list[list] = []  # [total before, total after, first, last, index of the last that began lower]
    total, last = 0.0, -1
    for place, w in steps:
        total -= drift * (place - last - 1)
        last = place
        if w <= 0:
            total += w
            continue
        new = [total, total + w, place, place, -1]
        total += w
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= new[0]:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= new[1]:
                new[4] = j
                stack.append(new)
                break
            new[0], new[2] = stack[j][0], stack[j][2]
            prior = stack[j][4]
            del stack[j:]
            j = prior if prior < len(stack) else len(stack) - 1
    return [(s[2], s[3], s[1] - s[0]) for s in stack]


def passages(text: str, weights: Weights, drift: float) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of words, and the maximal segments."""
    n, steps = 0, []
    for words in words_in(text):
        ws = np.fromiter(map(weights.__getitem__, words), np.float64, len(words))
        at = np.flatnonzero(ws)
        steps += zip((at + n).tolist(), (ws[at] - drift).tolist())
        n += len(words)
    return n, maximal_segments(steps, drift)


def log_p(score: float, n: int, m: Model) -> float:
    """Log of the probability that a clean text of ``n`` words has a segment of this score (Gumbel)."""
    x = (score - m.location - m.growth * math.log(n + 1)) / m.scale
    return math.log(-math.expm1(-math.exp(-x))) if x < 30 else -x


def evidence(n: int, segments: list[tuple[int, int, float]], m: Model) -> float:
    """Sum of -log p over the best segment and all other significant ones."""
    ps = sorted(log_p(s, n, m) for _, _, s in segments)
    return -sum(p for k, p in enumerate(ps) if not k or p <= math.log(m.settings.alpha))


def probability(x: float, m: Model) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, m.intercept + m.slope * x))))


def _labelled(docs: DataFrame, labels: DataFrame, s: Settings, learn: Column) -> DataFrame:
    """``text, toxic, fold`` of the documents to learn from; the labels are bounded, so they are broadcast."""
    rows = (labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.max_labelled)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(rows), "doc_id").select("text", "toxic", (F.pmod(F.xxhash64("doc_id"), F.lit(2))).cast("int").alias("fold"))


def _counts(rows: DataFrame) -> DataFrame:
    """``feature, fold, toxic, clean``: documents of each fold and class that have the feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            sums: dict[tuple[str, int], list[int]] = {}
            for (f, fold, y), n in seen.items():
                sums.setdefault((f, fold), [0, 0])[1 - y] += n
            keys = list(sums)
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([sums[k][0] for k in keys], pa.int64()), pa.array([sums[k][1] for k in keys], pa.int64())],
                ["feature", "fold", "toxic", "clean"])

        for batch in batches:
            for text, y, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                words = set().union(*words_in(text))
                seen.update((f, fold, y) for f in {f for w in words for f in features(w)})
                if len(seen) > 200_000:
                    yield out()
        yield out()

    return (rows.mapInArrow(run, "feature string, fold int, toxic long, clean long")
            .groupBy("feature", "fold").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _weights(counts: DataFrame, s: Settings) -> dict[str, float]:
    """Log-odds of toxic against clean with a Dirichlet prior in proportion to all counts.

    All features whose z (log-odds over their deviation) reaches ``min_z`` either way; with the prior that
    takes several documents, so their number is bounded by the labelled ones.
    """
    total = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    if not total["t"] or not total["c"]:
        return {}
    t, c = float(total["t"]), float(total["c"])
    a0 = s.prior * (t + c)
    prior = (F.col("toxic") + F.col("clean")) * (a0 / (t + c))
    odds = lambda y, n: F.log((y + prior) / (F.lit(n + a0) - y - prior))
    delta = odds(F.col("toxic"), t) - odds(F.col("clean"), c)
    z = delta / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    kept = counts.select("feature", delta.alias("delta"), z.alias("z")).where(F.abs("z") >= s.min_z)
    return {r["feature"]: r["delta"] for r in kept.collect()}


def _per_text(rows: DataFrame, weights: list[dict[str, float]], drift: float, value: Callable[[int, list], float]) -> np.ndarray:
    """Of each labelled text, with the weights of the other fold: ``toxic, n, value`` (of its words and segments)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = [Weights(w) for w in weights]
        for batch in batches:
            ys, ns, vs = [], [], []
            for text, y, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                n, segments = passages(text, of[1 - fold], drift)
                ys.append(y)
                ns.append(n)
                vs.append(value(n, segments))
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(ns, pa.int64()), pa.array(vs, pa.float64())], ["y", "n", "v"])

    got = rows.mapInArrow(run, "y int, n long, v double").toArrow()
    return np.stack([got.column(c).to_numpy().astype(float) for c in ("y", "n", "v")], axis=1) if got.num_rows else np.zeros((0, 3))


def best_of(n: int, segments: list[tuple[int, int, float]]) -> float:
    return max((s for _, _, s in segments), default=0.0)


def _gumbel(m: Model, texts: np.ndarray) -> None:
    """Gumbel parameters of clean texts' best segments (location grows with log length)."""
    clean = texts[texts[:, 0] == 0]
    logs, best = np.log(clean[:, 1] + 1), clean[:, 2]
    var = logs.var()
    m.growth = float(max(0.0, np.cov(logs, best)[0, 1] / var)) if len(clean) > 2 and var > 0 else 0.0
    rest = best - m.growth * logs
    m.scale = float(max(0.25, rest.std() * math.sqrt(6) / math.pi))
    m.location = float(rest.mean() - 0.5772156649 * m.scale)


def _logistic(m: Model, texts: np.ndarray) -> None:
    """Logistic curve from evidence to label: Newton's method with a small ridge, which bounds the slope where the classes part fully."""
    y, x = texts[:, 0], texts[:, 2]
    ab = np.array([math.log(max(1e-3, y.mean() / (1 - y.mean()))), 0.1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(ab[0] + ab[1] * x, -40, 40)))
        grad = np.array([(y - p).sum(), ((y - p) * x).sum()]) - 1e-2 * ab
        w = p * (1 - p)
        hess = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab += np.clip(step, -1, 1)
        if abs(step).max() < 1e-8:
            break
    m.intercept, m.slope = float(ab[0]), float(max(0.0, ab[1]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> Model:
    """Model from the labelled documents for which ``learn`` holds (a condition on ``doc_id``).

    Weights are learnt once from all of these, and once from each half to score the other half for
    the calibration, so that no text is calibrated with weights that saw it.
    """
    rows = _labelled(docs, labels, settings, learn).persist()
    counts = _counts(rows).persist()
    try:
        both = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        halves = [_weights(counts.where(F.col("fold") == k), settings) for k in (0, 1)]
        model = Model(_weights(both, settings), settings=settings)
        texts = _per_text(rows, halves, settings.drift, best_of)
        if 0 < texts[:, 0].sum() < len(texts):
            _gumbel(model, texts)
            _logistic(model, _per_text(rows, halves, settings.drift, lambda n, segments: evidence(n, segments, model)))
        return model
    finally:
        counts.unpersist()
        rows.unpersist()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, n_passages, passages`` per row; passages: the significant ones ``(start, end, p)`` in words.

    Nothing but the text enters the score, so equal texts score the same. Null and empty texts have no
    passage and get the calibration's base score; repeated rows and null ids are scored like any other; an empty
    table gives an empty result; other columns are not read. A text of any length is read whole, a block of
    words at a time. Of segments that could be cut in two ways at the same score, the search takes the shorter.
    """
    spark_type = "array<struct<start:int,end:int,p:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, limit = Weights(model.weights), math.log(model.settings.alpha)
        for batch in batches:
            scores, found = [], []
            for text in batch.column("text"):
                n, segments = passages(text.as_py() or "", weights, model.settings.drift)
                scores.append(probability(evidence(n, segments, model), model))
                found.append([{"start": a, "end": b + 1, "p": math.exp(p)} for a, b, s in segments if (p := log_p(s, n, model)) <= limit])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(found, kind)], ["doc_id", "score", "passages"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double, passages {spark_type}")
    return out.select("doc_id", "score", F.size("passages").alias("n_passages"), "passages")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labelled documents whose crc32 of the id modulo 3 is not 1, and scores all documents."""
    docs, held = documents(spark, sf_dir).select("doc_id", "text"), crc32_mod("doc_id", 3) == 1
    model = train(docs, documents(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held)
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_passages")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns unchanged."""
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), crc32_mod("doc_id", 3) != 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model.weights)
        for batch in batches:
            keep = []
            for text in batch.column("text"):
                n, segments = passages(text.as_py() or "", weights, model.settings.drift)
                keep.append(probability(evidence(n, segments, model), model) < threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
