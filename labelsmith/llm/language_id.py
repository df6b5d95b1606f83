"""Language identification by a byte convolutional network (operator 12)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_mod, documents

#: Prediction for a null text and one without a letter.
UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """Parameters of the network and its training.

    ``window``: bytes of a window; ``widths``: bytes that a filter sees, with ``filters`` of each;
    ``embed``: numbers per byte. Learnt from: of each language the document of least hash in each of
    ``per_language`` cells of hashed ids and texts, ``max_documents`` in all, ``slices`` windows of each.
    """

    window: int = 128
    embed: int = 8
    widths: tuple[int, ...] = (2, 3, 4, 5)
    filters: int = 16
    per_language: int = 600
    max_documents: int = 12_000
    slices: int = 4
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    """Weights: bytes to numbers, filters (all as wide as the widest, the rest of their rows zero), and languages."""

    languages: list[str]
    settings: Settings = Settings()
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> Network:
        s, rnd = self.settings, np.random.default_rng(self.settings.seed)
        n, wide = s.filters * len(s.widths), max(s.widths) * s.embed
        self.weights = {"embed": rnd.normal(0, 0.5, (256, s.embed)), "filter": rnd.normal(0, 1, (wide, n)) / np.sqrt(np.repeat(s.widths, s.filters) * s.embed) * self.seen(),
                        "bias": np.zeros(n), "dense": rnd.normal(0, 0.1, (n, len(self.languages))), "last": np.zeros(len(self.languages))}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        return self

    def seen(self) -> np.ndarray:
        """One where a filter's row is within its width."""
        s = self.settings
        return (np.arange(max(s.widths) * s.embed)[:, None] < np.repeat(s.widths, s.filters) * s.embed).astype(np.float32)

    def places(self, x: np.ndarray) -> np.ndarray:
        """The numbers that a filter sees at each place of each window."""
        s = self.settings
        e = self.weights["embed"][x].reshape(len(x), -1)
        return np.lib.stride_tricks.sliding_window_view(e, max(s.widths) * s.embed, axis=1)[:, ::s.embed]

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """The largest value of each filter over a window's places."""
        seen = np.ascontiguousarray(self.places(x))
        b, p, w = seen.shape
        out = (seen.reshape(b * p, w) @ self.weights["filter"]).reshape(b, p, -1).max(1) + self.weights["bias"]
        return np.maximum(out, 0, out=out)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Per window (rows of bytes) the logarithm of each language's probability."""
        out = self.pooled(x) @ self.weights["dense"] + self.weights["last"]
        out -= out.max(1, keepdims=True)
        return out - np.log(np.exp(out).sum(1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of a batch, and its gradient; only the place that won a filter's maximum counts."""
        s, w = self.settings, self.weights
        seen = np.ascontiguousarray(self.places(x))
        b, p, wide = seen.shape
        conv = (seen.reshape(b * p, wide) @ w["filter"]).reshape(b, p, -1)
        best = conv.argmax(1)
        pool = np.take_along_axis(conv, best[:, None], 1)[:, 0] + w["bias"]
        act = np.maximum(pool, 0)
        logits = act @ w["dense"] + w["last"]
        logits -= logits.max(1, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(1, keepdims=True)
        loss = float(-np.log(np.maximum(prob[np.arange(b), y], 1e-30)).mean())
        d_logits = prob
        d_logits[np.arange(b), y] -= 1
        d_logits /= b
        d_pool = (d_logits @ w["dense"].T) * (pool > 0)
        won = seen[np.arange(b)[:, None], best]  # window, filter, numbers
        d_seen = d_pool[:, :, None] * w["filter"].T[None]
        at = x[np.arange(b)[:, None, None], best[:, :, None] + np.arange(max(s.widths))]
        d_embed = np.zeros_like(w["embed"])
        np.add.at(d_embed, at.reshape(-1), d_seen.reshape(-1, s.embed))
        return loss, {"embed": d_embed, "filter": np.einsum("bf,bfw->wf", d_pool, won) * self.seen(), "bias": d_pool.sum(0),
                      "dense": act.T @ d_logits, "last": d_logits.sum(0)}

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        """Adam over shuffled batches, its rate falling to nought."""
        s, rnd = self.settings, np.random.default_rng(self.settings.seed + 1)
        self.start()
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        steps, t = s.epochs * -(-len(x) // s.batch), 0
        for _ in range(s.epochs):
            order = rnd.permutation(len(x))
            for i in range(0, len(x), s.batch):
                rows = order[i:i + s.batch]
                _, grads = self.gradients(x[rows], y[rows])
                t += 1
                rate = s.rate * (1 - t / (steps + 1))
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= (rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return self


def has_letter(text: bytes) -> bool:
    return re.search(rb"[A-Za-z]", text) is not None or not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace")))


def windows_of(text: bytes, window: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each window of the whole text, and how many of its bytes are new; windows overlap so that no filter's place is lost."""
    step = window - overlap
    starts = np.arange(0, max(1, len(text) - overlap), step)
    ends = np.minimum(starts + window, len(text))
    return starts, ends - starts - np.where(starts > 0, overlap, 0)


def train(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          settings: Settings = Settings()) -> Network:
    """Network learnt from the documents with a language for which ``learn`` (a condition on the given columns) holds.

    Tasks cut the documents into a few windows each before anything is moved, and send at most
    ``per_language`` documents of a language; the driver gets ``max_documents`` at most, ``slices``
    windows of each, and trains in numpy. Windows without a letter teach nothing; without labelled text
    the network has no language.
    """
    s = settings
    text, size = F.col("text"), F.octet_length("text")
    start = lambda k: (F.pmod(F.xxhash64("hash", F.lit(k)), F.greatest(size - s.window, F.lit(0)) + 1) + 1).cast("int")
    slices = F.array_distinct(F.array(*[F.substring(text, start(k), F.lit(s.window)) for k in range(s.slices)]))
    rows = docs.where(F.lit(True) if learn is None else learn).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("binary").alias("text"),
                                                                      F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"))
    cut = rows.where(F.col("lang").isNotNull() & (size > 0)).select("lang", "hash", slices.alias("slices"))
    cells = cut.groupBy("lang", F.pmod("hash", F.lit(s.per_language)).alias("cell")).agg(F.min(F.struct("hash", "slices")).alias("least"))
    kept = cells.select("lang", "cell", "least.*").orderBy(F.xxhash64("cell"), "lang").limit(s.max_documents).collect()
    cuts = [(r["lang"], bytes(c)) for r in kept for c in r["slices"] if has_letter(bytes(c))]
    languages = sorted({lang for lang, _ in cuts})
    number = {lang: k for k, lang in enumerate(languages)}
    network = Network(languages, s)
    if not cuts:
        return network.start()
    x = np.frombuffer(b"".join(c.ljust(s.window, b"\0") for _, c in cuts), np.uint8).reshape(-1, s.window)
    return network.fit(x, np.array([number[lang] for lang, _ in cuts]))


def predict(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` per row.

    Every window of the whole text is judged; a text's probabilities are the windows' geometric mean,
    each counting by its new bytes. ``score`` is the largest; of equal ones the language first by name
    wins. Equal texts may differ in the seventh digit of their score, as windows are multiplied in batches. A null text, one without a letter (an empty one too), and any text where no language was
    learnt give ``und`` and 0. Very long texts are judged a bounded number of windows at a time.
    Null and repeated ids are judged row by row; an empty table gives an empty result; other columns
    are not read.
    """
    s = network.settings
    overlap, room = max(s.widths) - 1, 64

    def judged(texts: list[bytes]) -> np.ndarray:
        sums = np.zeros((len(texts), len(network.languages)))
        held, of, weight = [], [], []

        def flush():
            x = np.frombuffer(b"".join(held), np.uint8).reshape(-1, s.window)
            np.add.at(sums, of, network.log_probabilities(x) * np.array(weight)[:, None])
            held.clear(), of.clear(), weight.clear()

        for k, text in enumerate(texts):
            for a, n in zip(*(v.tolist() for v in windows_of(text, s.window, overlap))):
                held.append(text[a:a + s.window].ljust(s.window, b"\0"))
                of.append(k)
                weight.append(n / len(text))
                if len(held) == room:
                    flush()
        if held:
            flush()
        sums = np.exp(sums - sums.max(1, keepdims=True))
        return sums / sums.sum(1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text")]
            fits = [k for k, t in enumerate(texts) if network.languages and has_letter(t)]
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if fits:
                for k, p in zip(fits, judged([texts[k] for k in fits])):
                    best = int(p.argmax())
                    names[k], scores[k] = network.languages[best], float(p[best])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose crc32 of the id modulo 5 is not 0, and predicts all documents."""
    held = crc32_mod("doc_id", 5) == 0
    docs = documents(spark, sf_dir)
    network = train(docs.select("doc_id", "text", "lang"), ~held)
    return predict(docs, network).select("doc_id", held.alias("held_out"), "lang_pred", "score")
