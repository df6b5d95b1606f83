"""Hard negatives by angular triangle filtering (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, landed

#: Reference directions, and the rows that they are fitted on (of least hashed id).
DIRECTIONS, SAMPLE = 16, 4096
#: Rows of a window (what is scored or skipped whole), of a stored block, and blocks of a unit of work.
WINDOW, BLOCK, SPAN = 256, 2048, 8
#: Stored blocks whose anchors are searched together, and such sets of a unit of work.
ANCHOR_BLOCKS, ANCHOR_SETS = 16, 4
#: Quantised vectors from this norm on take no part: a hundred times a score must fit in 64 bits.
MAX_NORM = float(1 << 28)
#: Taken off and added to angles (stored in 32 bits).
ANGLE_SLACK = 1e-6

ROW = "id long, label long, anchor boolean, norm double, cell int, near double, dim int, angles binary, vec binary"
PACKED = "blk long, dim int, ids binary, nulls binary, labels binary, keys binary, norms binary, angles binary, vecs binary"


def _matrix(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, padded with zeros to the longest; and their lengths."""
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.offsets)
    lengths = np.diff(offsets)
    out = np.zeros((len(column), int(lengths.max(initial=0))), np.float64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out, lengths


def _quantised(x: np.ndarray) -> np.ndarray:
    return np.floor(256 * x)


def _angles(q: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of every row to every direction; a right angle where the row has no direction."""
    d = min(q.shape[1], directions.shape[1])
    dots = q[:, :d] @ directions[:, :d].T
    return np.arccos(np.clip(np.divide(dots, norms[:, None], out=np.zeros_like(dots), where=norms[:, None] > 0), -1, 1))


def fit_directions(vectors: list[list[float]], k: int = DIRECTIONS, rounds: int = 6) -> np.ndarray:
    """At most ``k`` unit vectors near which the given ones gather (k-means on the sphere)."""
    x = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = _quantised(np.array(v, np.float64))
    norms = np.sqrt((x * x).sum(1))
    x = x[(norms > 0) & (norms < MAX_NORM)]
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    if not len(x):
        return np.zeros((1, 1))
    centres = x[:1]
    while len(centres) < min(k, len(x)):  # the vector farthest from all so far
        centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(1))]])
    for _ in range(rounds):
        of = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def _rows(df: DataFrame, directions: np.ndarray) -> DataFrame:
    """Quantised vectors with norm, angles to the directions, and the nearest direction."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, lengths = _matrix(batch.column("vec"))
            q = _quantised(x)
            with np.errstate(over="ignore"):
                norms = np.sqrt((q * q).sum(1))
            fits = norms < MAX_NORM
            q, norms, lengths = q[fits], norms[fits], lengths[fits]
            angles = _angles(q, norms, directions)
            cell = np.argmin(angles, axis=1) if len(q) else np.zeros(0, int)
            raw, near = q.astype("<i4"), angles[np.arange(len(q)), cell]
            angles = angles.astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).filter(pa.array(fits)) for c in ("id", "label", "anchor")), pa.array(norms), pa.array(cell, pa.int32()),
                 pa.array(near), pa.array(lengths, pa.int32()), pa.array([a.tobytes() for a in angles], pa.binary()),
                 pa.array([v[:n].tobytes() for v, n in zip(raw, lengths)], pa.binary())],
                ["id", "label", "anchor", "norm", "cell", "near", "dim", "angles", "vec"])

    return df.mapInArrow(run, ROW)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows in order of label, cell and angle, each with a unique ``key`` and its ``place`` in that order.

    One range shuffle, written; a key is a partition's number and the row's number there, and places
    come from the partitions' sizes.
    """
    order = ["label", "cell", "near", "id", "vec"]
    kept = landed(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("key", F.monotonically_increasing_id()), "vectors")
    part = F.shiftright("key", 33)
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("key").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.withColumn("part", part).join(offsets, "part").withColumn("place", place).drop("part", "offset")


@dataclass
class Block:
    """Rows of a stored block, in order."""

    ids: np.ndarray
    nulls: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    norms: np.ndarray
    angles: np.ndarray
    vecs: np.ndarray
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))

    @staticmethod
    def read(r: dict) -> Block:
        ids = np.frombuffer(r["ids"], "<i8")
        n = len(ids)
        return Block(ids, np.frombuffer(r["nulls"], "u1"), np.frombuffer(r["labels"], "<i8"), np.frombuffer(r["keys"], "<i8"), np.frombuffer(r["norms"], "<f8"),
                     np.frombuffer(r["angles"], "<f4").reshape(n, -1).astype(np.float64), np.frombuffer(r["vecs"], "<i4").reshape(n, r["dim"]),
                     np.frombuffer(r.get("scores") or b"", "<i8").reshape(n, -1))


def _packed(rows: DataFrame, extra: bool = False) -> DataFrame:
    """A row per ``blk`` with its rows' fields as arrays, vectors padded to the block's longest.

    ``extra``: there is a column ``scores``, five numbers per row.
    """
    names = ["id", "label", "key", "norm", "dim", "angles", "vec", *["scores"] * extra]

    def pack(blk: int, of: dict) -> pa.RecordBatch:
        dim = max(of["dim"])
        vecs = b"".join(v.ljust(4 * dim, b"\0") for v in of["vec"])
        longs = lambda c: np.array(c, "<i8").tobytes()
        cells = {"blk": blk, "dim": dim, "ids": longs([i or 0 for i in of["id"]]), "nulls": np.array([i is None for i in of["id"]], "u1").tobytes(),
                 "labels": longs(of["label"]), "keys": longs(of["key"]), "norms": np.array(of["norm"], "<f8").tobytes(),
                 "angles": b"".join(of["angles"]), "vecs": vecs} | ({"scores": longs(of["scores"])} if extra else {})
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if k == "blk" else pa.int32() if k == "dim" else pa.binary()) for k, v in cells.items()], list(cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {c: [] for c in names}
        for batch in batches:
            blks = batch.column("blk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blks)) + 1).tolist(), len(blks)]
            columns = {c: batch.column(c).to_pylist() for c in names}
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now is not None and blks[a] != now:
                    yield pack(now, held)
                    held = {c: [] for c in names}
                now = int(blks[a])
                for c in names:
                    held[c] += columns[c][a:b]
        if now is not None:
            yield pack(now, held)

    dealt = rows.select("blk", *names).repartition("blk").sortWithinPartitions("blk", "key")
    return dealt.mapInArrow(run, PACKED + ", scores binary" * extra)


@dataclass
class Windows:
    """Windows of the blocks of a unit: their rows, and the spans of angles, norms and labels."""

    blocks: list[tuple[Block, np.ndarray]]
    at: list[tuple[int, int]] = field(default_factory=list)
    low: np.ndarray = None
    high: np.ndarray = None

    def __post_init__(self):
        spans = []
        for k, (b, _) in enumerate(self.blocks):
            for i in range(0, len(b.ids), WINDOW):
                s = slice(i, i + WINDOW)
                self.at.append((k, i))
                spans.append((b.angles[s].min(0), b.angles[s].max(0), b.norms[s].min(), b.norms[s].max(), b.labels[s].min(), b.labels[s].max()))
        self.low, self.high, self.least, self.most, self.first, self.last = map(np.array, zip(*spans))

    def bounds(self, a: Block) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the score of each row of ``a`` with any row of each window.

        Of angles t and u to a direction, two vectors are |t - u| at least and min(t + u, 2 pi - t - u)
        at most apart; all directions hold at once. Cosines times norms, rounded outwards.
        """
        near, far = np.zeros((len(a.ids), len(self.at))), np.full((len(a.ids), len(self.at)), np.pi)
        for t, lo, hi in zip(a.angles.T[:, :, None], self.low.T, self.high.T):
            np.maximum(near, np.maximum(lo - t, t - hi), out=near)
            np.minimum(far, np.where(t + hi <= np.pi, t + hi, np.where(t + lo >= np.pi, 2 * np.pi - t - lo, np.pi)), out=far)
        top, bottom = np.cos(np.maximum(near - ANGLE_SLACK, 0)), np.cos(np.minimum(far + ANGLE_SLACK, np.pi))
        norm = a.norms[:, None]
        top, bottom = np.where(top >= 0, top * self.most, top * self.least) * norm, np.where(bottom >= 0, bottom * self.least, bottom * self.most) * norm
        return np.floor(bottom - 1e-9 * np.abs(bottom)) - 1, np.ceil(top + 1e-9 * np.abs(top)) + 1


def _cast(v: np.ndarray, most: float) -> np.ndarray:
    """As the fastest type in which all sums of products up to ``most`` are exact integers."""
    return v.astype(np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = min(a.shape[1], b.shape[1])
    return (a[:, :d] @ b[:, :d].T).astype(np.int64)


class Best:
    """The ``k`` best (score, id) of each of ``n`` searches; ``least``: what a newcomer must score."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.least = k, least
        self.of, self.score, self.null, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64)

    def add(self, of: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        if not len(of):
            return
        of, score, null, ids = (np.concatenate(x) for x in ((self.of, of), (self.score, score), (self.null, null), (self.id, ids)))
        order = np.lexsort((ids, null, -score, of))
        of, score, null, ids = of[order], score[order], null[order], ids[order]
        begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        rank = np.arange(len(of)) - np.repeat(begins, np.diff(np.r_[begins, len(of)]))
        full = rank == self.k - 1
        self.least[of[full]] = score[full]
        keep = rank < self.k
        self.of, self.score, self.null, self.id = of[keep], score[keep], null[keep], ids[keep]


def _positives(a: Block, w: Windows, k: int) -> Best:
    """Of each anchor the ``k`` best other rows of its label."""
    best = Best(len(a.ids), k, np.full(len(a.ids), np.iinfo(np.int64).min))
    _, top = w.bounds(a)
    mine = _cast(a.vecs, a.norms.max() * w.most.max())
    for j in np.argsort(-top.max(0), kind="stable"):
        active = np.flatnonzero((top[:, j] >= best.least) & (a.labels >= w.first[j]) & (a.labels <= w.last[j]))
        if not len(active):
            continue
        (b, theirs), i = w.blocks[w.at[j][0]], w.at[j][1]
        s = slice(i, i + WINDOW)
        got = _scores(mine[active], _cast(theirs[s], a.norms.max() * w.most.max()))
        fits = (got >= best.least[active, None]) & (a.labels[active, None] == b.labels[s]) & (a.keys[active, None] != b.keys[s])
        x, y = np.nonzero(fits)
        best.add(active[x], got[x, y], b.nulls[s][y], b.ids[s][y])
    return best


def _negatives(a: Block, w: Windows, k: int, low: int, high: int) -> Best:
    """Of each anchor and positive score (search number: anchor times scores plus score) the ``k`` best rows of other labels in its range."""
    n, m = a.scores.shape
    wanted = a.scores >= 0  # a negative score's range is empty
    least = np.where(wanted, -(-low * np.maximum(a.scores, 0) // 100), 1)
    most = np.where(wanted, high * np.maximum(a.scores, 0) // 100, 0)
    best = Best(n * m, k, least.reshape(-1).copy())
    bottom, top = w.bounds(a)
    mine = _cast(a.vecs, a.norms.max() * w.most.max())
    for j in np.argsort(-top.max(0), kind="stable"):
        now = best.least.reshape(n, m)
        active = np.flatnonzero(((top[:, j, None] >= now) & (bottom[:, j, None] <= most) & (now <= most)).any(1)
                                & ~((a.labels == w.first[j]) & (a.labels == w.last[j])))
        if not len(active):
            continue
        (b, theirs), i = w.blocks[w.at[j][0]], w.at[j][1]
        s = slice(i, i + WINDOW)
        got = _scores(mine[active], _cast(theirs[s], a.norms.max() * w.most.max()))
        differ = a.labels[active, None] != b.labels[s]
        found = []
        for r in range(m):
            x, y = np.nonzero((got >= now[active, r, None]) & (got <= most[active, r, None]) & differ)
            found.append((active[x] * m + r, got[x, y], b.nulls[s][y], b.ids[s][y]))
        best.add(*map(np.concatenate, zip(*found)))
    return best


def _searched(blocks: DataFrame, anchors: DataFrame, search) -> DataFrame:
    """``key, score0, score, id`` from every unit of work: a group of stored blocks and a set of anchor blocks.

    The anchors are the query set, the blocks hold all rows: each unit gets its blocks and its anchors in
    one shuffle, keeps the blocks and takes the anchors as they come.
    """
    groups = blocks.agg(F.max("blk")).first()[0]
    sets = anchors.agg(F.max("blk")).first()[0]
    if groups is None or sets is None:
        return blocks.sparkSession.createDataFrame([], "key long, score0 long, score long, id long")
    number = lambda last, size: F.explode(F.sequence(F.lit(0), F.lit(last // size)))
    unit_of = lambda df, size: F.expr(f"blk div {size}")
    stored = blocks.select(F.lit(0).alias("kind"), unit_of(blocks, SPAN).alias("grp"), number(sets, ANCHOR_SETS).alias("aset"), "*")
    asked = anchors.select(F.lit(1).alias("kind"), number(groups, SPAN).alias("grp"), unit_of(anchors, ANCHOR_SETS).alias("aset"), "*")
    both = stored.unionByName(asked, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, windows = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if (r["grp"], r["aset"]) != unit:
                    unit, held, windows = (r["grp"], r["aset"]), [], None
                b = Block.read(r)
                if not r["kind"]:
                    held.append((b, b.vecs))
                    continue
                if not held:
                    continue
                windows = windows or Windows(held)
                best, score0 = search(b, windows)
                if not len(best.of):
                    continue
                ids = pa.array(best.id, pa.int64(), mask=best.null.astype(bool))
                per = max(1, b.scores.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(b.keys[best.of // per]), pa.array(score0(best.of)), pa.array(best.score), ids], ["key", "score0", "score", "id"])

    dealt = both.repartition("grp", "aset").sortWithinPartitions("grp", "aset", "kind", "blk")
    return dealt.mapInArrow(run, "key long, score0 long, score long, id long")


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each search, with their rank."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components x become floor(256 x); a score is an integer inner product. Anchors are the rows for
    which ``anchor`` (a condition on the given columns) holds. An anchor's positives are its first
    ``positives`` other rows of the same label, its negatives for a positive the first ``negatives``
    rows of another label whose score is from ``low`` to ``high`` per cent of the positive's; higher
    scores first, ties by smaller id.

    The rows are written once in order of label, nearest reference direction and angle to it, with
    their angles to all directions. An anchor and a window of such rows have bounds on their score
    from these angles; only windows whose bounds meet what the anchor still looks for are scored, in
    whole numbers. Directions are fitted on at most ``SAMPLE`` rows; they change the work, never the result.

    Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows
    whose quantised norm reaches 2^28, as their scores might not fit. Labels are whole numbers. A
    shorter vector counts as padded with zeros, an empty one as zero. Rows that repeat an id are
    different rows: each may be an anchor, and each is a partner of the others. A null id is no anchor unless
    the condition says so; as a partner it comes behind all others of its score. An empty table, or one
    without anchors, gives an empty result; other columns are not read unless the condition does.
    """
    x = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(F.exists("vec", x), F.lit(False)))
    sample = rows.orderBy(F.xxhash64("id", "label"), "id").limit(SAMPLE).select("vec").collect()
    directions = fit_directions([r["vec"] for r in sample])
    placed = _numbered(_rows(rows, directions))
    blocks = landed(_packed(placed.withColumn("blk", F.expr(f"place div {BLOCK}"))), "vector-blocks")
    asked = landed(placed.where("anchor").withColumn("blk", F.expr(f"place div {BLOCK * ANCHOR_BLOCKS}")).drop("place", "cell", "near"), "anchors")

    found = _searched(blocks, landed(_packed(asked), "anchor-blocks"),
                      lambda a, w: (_positives(a, w, positives), lambda of: np.zeros(len(of), np.int64)))
    best = landed(_first(found, ["key"], positives).select("key", F.col("score").alias("score0"), F.col("id").alias("positive_id")), "positives")
    scores = best.groupBy("key").agg(F.sort_array(F.collect_set("score0")).alias("scores"))
    padded = F.concat("scores", F.array_repeat(F.lit(-1).cast("long"), F.lit(positives) - F.size("scores")))
    ranged = asked.join(scores, "key").withColumn("scores", padded)
    found = _searched(blocks, landed(_packed(ranged, extra=True), "ranges"),
                      lambda a, w: (_negatives(a, w, negatives, low, high), lambda of: a.scores.reshape(-1)[of]))
    worst = _first(found, ["key", "score0"], negatives).select("key", "score0", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = asked.select("key", F.col("id").alias("anchor_id"))
    return (best.join(worst, ["key", "score0"]).join(names, "key")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("score0").alias("positive_score"), "negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id's label is moved on by one; anchors are the ids divisible by 50."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(documents(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS r
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3
"""
