"""Repeated byte strings by bucket-pointer refinement (operator 5)."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, landed
from .tokens import BASE, INVERSE, mix

POSITION_BITS = 24
#: Entries of one Arrow batch of rows per document, and most grams that are dealt by run.
ROWS, MOST_HOT = 1 << 16, 1 << 20


class Sums:
    """Running polynomial sums of bytes, from which the hash of any substring follows at once."""

    def __init__(self):
        self.powers, self.inverses = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        if len(self.powers) <= len(data):
            size = 1 << len(data).bit_length()
            steps = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
            self.powers, self.inverses = steps(BASE), steps(INVERSE)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:len(data)], out=self.sums[1:])

    def hash(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverses[start])


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive keys, by doubling."""
    n = 1
    while n * 2 <= width:
        keys = np.minimum(keys[:-n], keys[n:])
        n *= 2
    return np.minimum(keys[:len(keys) - (width - n)], keys[width - n:]) if n < width else keys


@dataclass
class Anchors:
    """Runs of window starts ``first..last`` that share an anchor, the least q-gram of each window."""

    gram: np.ndarray
    span: np.ndarray
    lead: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors(data: np.ndarray, ends: np.ndarray, length: int, q: int, sums: Sums) -> Anchors:
    """Anchors of all windows of ``length`` bytes of the texts that end at ``ends``; places within each text.

    A window's anchor is its q-gram of least hash, the leftmost of equals: it depends on the window's
    bytes alone, so equal windows have equal anchors at the same place. ``span`` is the hash of all
    bytes of the run's windows, ``lead`` the anchor's distance from the run's start.
    """
    empty = np.zeros(0, np.uint64)
    begins = np.concatenate(([0], ends[:-1]))
    if len(data) < length:
        return Anchors(empty, empty, *[np.zeros(0, np.int64)] * 4)
    sums.load(data)
    at = np.arange(len(data) - q + 1)
    grams = sums.hash(at, at + q)
    mask = np.uint64((1 << POSITION_BITS) - 1)
    least = _sliding_min((grams & ~mask) | at.astype(np.uint64), length - q + 1)
    start = np.arange(len(least))
    doc = np.searchsorted(ends, start, side="right")
    valid = start + length <= ends[np.minimum(doc, len(ends) - 1)]
    start, doc, place = start[valid], doc[valid], (least[valid] & mask).astype(np.int64)
    if not len(start):
        return Anchors(empty, empty, *[np.zeros(0, np.int64)] * 4)
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))))
    first, last = start[new], start[np.append(new[1:] - 1, len(start) - 1)]
    place, doc = place[new], doc[new]
    return Anchors(grams[place], sums.hash(first, last + length), place - first, doc, first - begins[doc], last - begins[doc])


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, byte plane by byte plane."""
    planes = [(x.dtype.str, len(x), np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()) for x in arrays]
    return zstandard.compress(pickle.dumps(planes), 1)


def _unpack(blob: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, planes in pickle.loads(zstandard.decompress(blob)):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).reshape(-1).view(kind))
    return out


def _firsts(classes: np.ndarray, order: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting places by class and then order: the first of each class, and those of a later place in theirs.

    Equal places of one class are the same (a row given twice) and not later than each other. Given
    ``columns``, a class is what all of them share, and ``classes`` a number that equal ones share, too.
    """
    by = np.argsort(order, kind="stable")
    by = by[np.argsort(classes[by], kind="stable")]
    if not len(by):
        return by, by
    new = np.concatenate(([True], classes[by][1:] != classes[by][:-1]))
    if any(((c[by][1:] != c[by][:-1]) & ~new[1:]).any() for c in columns):
        by = np.lexsort((order, *columns))
        new = np.concatenate(([True], np.any([c[by][1:] != c[by][:-1] for c in columns], axis=0)))
    head = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    return by[new], by[order[by] != order[by][head]]


def _ranks(doc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Rank of each document by id, then tie; equal for equal ones."""
    by = np.lexsort((tie, doc))
    if not len(by):
        return by
    step = np.concatenate(([0], (doc[by][1:] != doc[by][:-1]) | (tie[by][1:] != tie[by][:-1]))).cumsum()
    out = np.empty(len(by), np.int64)
    out[by] = step
    return out


def _runs(kind: int, doc: np.ndarray, tie: np.ndarray, *cols: np.ndarray) -> list[tuple]:
    """Rows ``(kind, shard, doc, tie, blob)``: the columns of each document's entries."""
    by = np.lexsort((cols[0], tie, doc))
    doc, tie, cols = doc[by], tie[by], [c[by] for c in cols]
    if not len(doc):
        return []
    cuts = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]))))
    rows = []
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(doc)).tolist()):
        entry = [c[a:b] for c in cols]
        if kind == REMOVE:
            entry = _union(entry[0], entry[1])
        rows.append((kind, int(doc[a]) & 0xFFFF, int(doc[a]), int(tie[a]), np.stack(entry).astype("<i8").tobytes() if kind == REMOVE else _pack(*entry)))
    return rows


def _run_batches(kind: int, doc: np.ndarray, tie: np.ndarray, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of ``_runs`` in batches of at most ``ROWS`` entries; a document's entries may stand in two."""
    by = np.lexsort((tie, doc))
    for a in range(0, len(by), ROWS):
        of = by[a:a + ROWS]
        yield _batch(_runs(kind, doc[of], tie[of], *(c[of] for c in cols)))


def _union(first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Runs of starts united where they touch."""
    by = np.argsort(first, kind="stable")
    first, last = first[by], np.maximum.accumulate(last[by])
    new = np.concatenate(([True], first[1:] > last[:-1] + 1))
    return [first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]]


SHARD, REMOVE, FETCH, CONTEXT, WINDOW = range(5)
SCHEMA = "kind int, shard int, doc long, tie long, blob binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 5
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["kind", "shard", "doc", "tie", "blob"])


def _sharded(kind: int, shard: np.ndarray, doc: np.ndarray, tie: np.ndarray, cols: list[np.ndarray], extra=None) -> list[tuple]:
    """A blob per shard: its documents once, and the columns with a document's number each."""
    rows, by = [], np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], shard[by][1:] != shard[by][:-1]))) if len(by) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(by)) if len(by) else []):
        of = by[a:b]
        keys, number = np.unique(np.stack([doc[of], tie[of]]), axis=1, return_inverse=True)
        body = [keys[0], keys[1], number.reshape(-1).astype(np.uint32), *(c[of] for c in cols)]
        rows.append((kind, int(shard[of[0]]), 0, 0, _pack(*body, *(extra(of) if extra else ()))))
    return rows


def _classes(gram, span, lead, n) -> np.ndarray:
    return mix(gram ^ mix(span + lead.astype(np.uint64) * BASE + n.astype(np.uint64) * INVERSE))


def _gram_shard(gram: np.ndarray, span: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """A run's shard: its gram's, or, where the gram is hot, one of the run's own."""
    own = np.where(np.isin(gram, hot), mix(gram ^ mix(span)), gram) if len(hot) else gram
    return (own >> np.uint64(32)).astype(np.int64) % shards


def _scanned(batches: Iterator[pa.RecordBatch], length: int, q: int, chunk: int, flush: int) -> Iterator[list[np.ndarray]]:
    """Gram, span, lead, first, last, doc and tie of the anchors of a task's texts, about ``flush`` at a time."""
    sums, held, parts, size, found = Sums(), [], [], 0, 0

    def work():
        nonlocal size, found
        texts = [p[3] for p in parts]
        a = anchors(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]), length, q, sums)
        doc, tie, base = (np.array([p[k] for p in parts], np.int64) for k in range(3))
        held.append((a.gram, a.span, a.lead, a.first + base[a.doc], a.last + base[a.doc], doc[a.doc], tie[a.doc]))
        found += len(a.gram)
        parts.clear()
        size = 0

    def out() -> list[np.ndarray]:
        nonlocal found
        cols = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        found = 0
        return cols

    for batch in batches:
        for doc, tie, text in zip(*(batch.column(c) for c in ("doc", "tie", "text"))):
            doc, tie, text = doc.as_py(), tie.as_py(), text.as_py()
            for base in range(0, max(1, len(text) - length + 1), chunk):
                parts.append((doc, tie, base, text[base:base + chunk + length - 1]))
                size += len(parts[-1][3])
                if size >= chunk:
                    work()
                    if found >= flush:
                        yield out()
    if parts:
        work()
    if found:
        yield out()


def _tally(length: int, q: int, chunk: int, flush: int):
    """Task: grams with at least two different runs among those of a flush, and how many.

    A gram that is left out has one run a flush, so it cannot crowd a shard.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, span, lead, first, last, _, _ in _scanned(batches, length, q, chunk, flush):
            _, one = np.unique(_classes(gram, span, lead, last - first), return_index=True)
            keys, counts = np.unique(gram[one], return_counts=True)
            some = counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(counts[some].astype(np.int64))], ["gram", "n"])

    return run


def _scan(shards: int, hot: np.ndarray, length: int, q: int, chunk: int, flush: int):
    """Task: anchors of its texts, folded; first places go to their run's shard, later ones are removed at once."""
    small = np.min_scalar_type(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, span, lead, first, last, doc, tie in _scanned(batches, length, q, chunk, flush):
            kept, gone = _firsts(_classes(gram, span, lead, last - first), (_ranks(doc, tie) << 40) | first, gram, span, lead, last - first)
            yield from _run_batches(REMOVE, doc[gone], tie[gone], first[gone], last[gone])
            kept = kept[np.argsort(gram[kept])]
            yield _batch(_sharded(SHARD, _gram_shard(gram[kept], span[kept], hot, shards), doc[kept], tie[kept],
                                  [gram[kept], span[kept], lead[kept].astype(small), (last - first)[kept].astype(small), first[kept]]))

    return run


def _per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int] | None, list]]:
    """Blobs of each ``(kind, shard)`` together (rows come sorted); rows to pass on under None."""
    now, blobs = None, []
    for batch in batches:
        passed = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("kind", "shard", "doc", "tie", "blob"))):
            if row[0] in (REMOVE, FETCH):
                passed.append(row)
                continue
            if now is not None and now != row[:2]:
                yield now, blobs
                blobs = []
            now = row[:2]
            blobs.append(row[4])
        if passed:
            yield None, passed
    if now is not None:
        yield now, blobs


def _merge(crowded: int, hot: np.ndarray):
    """Task: the anchors of a shard from all tasks. Later places of a run are removed; where a bucket has
    several classes, each class's first place has its bytes fetched (mark 1: a bucket of over ``crowded``,
    or a hot gram's, whose classes stand in all shards)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, blobs in _per_shard(batches):
            if key is None:
                yield _batch(blobs)
                continue
            cols = []
            for docs, ties, number, *rest in map(_unpack, blobs):
                cols.append((docs[number], ties[number], *rest))
            doc, tie, gram, span, lead, n, first = map(np.concatenate, zip(*cols))
            kept, gone = _firsts(_classes(gram, span, lead, n), (_ranks(doc, tie) << 40) | first, gram, span, lead, n)
            yield from _run_batches(REMOVE, doc[gone], tie[gone], first[gone], (first + n)[gone])
            kept = kept[np.argsort(gram[kept], kind="stable")]
            _, number, size = np.unique(gram[kept], return_inverse=True, return_counts=True)
            size = np.where(np.isin(gram[kept], hot), crowded + 2, size[number])
            some, size = kept[size > 1], size[size > 1]
            yield from _run_batches(FETCH, doc[some], tie[some], first[some], gram[some], n[some], (size > crowded).astype(np.uint8))

    return run


def _fetch(shards: int, length: int, flush: int):
    """Task: the bytes of the runs wanted of its documents, to their bucket's shard; of crowded buckets window
    hashes, folded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, near, far, size = Sums(), [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal size
            rows = []
            if near:
                doc, tie, gram, first, n = (np.array([x[k] for x in near], t) for k, t in enumerate((np.int64, np.int64, np.uint64, np.int64, np.int64)))
                context = [x[5] for x in near]
                rows += _sharded(CONTEXT, (gram >> np.uint64(32)).astype(np.int64) % shards, doc, tie, [gram, first, n.astype(np.min_scalar_type(length))],
                                 lambda of: [np.frombuffer(b"".join(context[k] for k in of), np.uint8)])
            if far:
                doc, tie, first, head, tail = map(np.concatenate, zip(*far))
                kept, gone = _firsts(mix(head) + tail, (_ranks(doc, tie) << 40) | first, head, tail)
                rows += _runs(REMOVE, doc[gone], tie[gone], first[gone], first[gone])
                whole = mix(mix(head[kept]) + tail[kept])
                rows += _sharded(WINDOW, (whole >> np.uint64(32)).astype(np.int64) % shards, doc[kept], tie[kept], [first[kept], head[kept], tail[kept]])
            near.clear()
            far.clear()
            size = 0
            return _batch(rows)

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("doc", "tie", "text", "blobs"))):
                doc, tie, text, blobs = (x.as_py() for x in row)
                first, gram, n, mark = (np.concatenate(x) for x in zip(*map(_unpack, blobs)))
                for f, g, m in zip(first[mark == 0].tolist(), gram[mark == 0].tolist(), n[mark == 0].tolist()):
                    near.append((doc, tie, g, f, m, text[f:f + m + length]))
                    size += 2 * length
                if (mark == 1).any():
                    starts = np.unique(np.concatenate([np.arange(f, f + m + 1) for f, m in zip(first[mark == 1].tolist(), n[mark == 1].tolist())]))
                    for a in range(0, len(starts), 1 << 20):
                        part = starts[a:a + (1 << 20)]
                        data = np.frombuffer(text, np.uint8)[part[0]:part[-1] + length]
                        sums.load(data)
                        at = part - part[0]
                        far.append((np.full(len(part), doc), np.full(len(part), tie), part,
                                    sums.hash(at, at + length // 2), sums.hash(at + length // 2, at + length)))
                        size += 40 * len(part)
                if size >= flush:
                    yield out()
        if size:
            yield out()

    return run


def refine(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Bucket of the ``length`` bytes at each of ``starts``: equal for equal strings.

    Buckets begin as q-grams of 8 bytes. A step from depth h to 2h sorts the members of a bucket by the
    buckets at offset h; what an earlier step has settled serves the next as sort key, and a place alone
    in its bucket is sorted no more. The last step overlaps, to reach ``length`` exactly.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    grams = np.zeros(len(data), np.uint64)
    for k in range(8):
        grams = (grams << np.uint64(8)) | padded[k:len(data) + k]
    _, bucket, size = np.unique(grams, return_inverse=True, return_counts=True)
    bucket, top, depth = bucket.astype(np.int64), len(size), 8
    alone = size[bucket] == 1
    while depth < length:
        step = min(depth, length - depth)
        open_ = np.flatnonzero(~alone)
        later = np.minimum(open_ + step, len(data) - 1)
        by = np.lexsort((bucket[later], bucket[open_]))
        left, right = bucket[open_][by], bucket[later][by]
        new = np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))) if len(by) else np.zeros(0, bool)
        number = np.cumsum(new) - 1
        refined, sizes = bucket.copy(), np.bincount(number)
        refined[open_[by]] = top + number
        alone[open_[by]] = sizes[number] == 1
        bucket, top, depth = refined, top + len(sizes), depth + step
    return bucket[starts]


def _resolve(length: int, block: int):
    """Task: the buckets of a shard, refined to whole windows; all but the first place of a window are removed."""
    def windows(doc, tie, gram, first, n, data):
        sizes = n.astype(np.int64) + length
        ends = np.cumsum(sizes)
        order = np.argsort(gram, kind="stable")
        cuts = np.flatnonzero(np.concatenate((gram[order][1:] != gram[order][:-1], [True]))) + 1
        a = 0
        while a < len(order):
            weight = np.cumsum(sizes[order[a:]])
            far = cuts[cuts > a]
            b = int(far[max(0, np.searchsorted(weight[far - a - 1], block, side="right") - 1)])
            of = order[a:b]
            text = np.concatenate([data[ends[k] - sizes[k]:ends[k]] for k in of])
            base = np.cumsum(sizes[of]) - sizes[of]
            count = n[of].astype(np.int64) + 1
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            yield doc[np.repeat(of, count)], tie[np.repeat(of, count)], first[np.repeat(of, count)] + inner, refine(text, np.repeat(base, count) + inner, length)
            a = b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, blobs in _per_shard(batches):
            if key is None:
                yield _batch(blobs)
                continue
            cols = [(docs[number], ties[number], *rest) for docs, ties, number, *rest in map(_unpack, blobs)]
            doc, tie, *rest = map(np.concatenate, zip(*cols))
            parts = windows(doc, tie, *rest) if key[0] == CONTEXT else [(doc, tie, rest[0], mix(rest[1]) + rest[2], *rest[1:])]
            for d, t, start, window, *halves in parts:
                _, gone = _firsts(window, (_ranks(d, t) << 40) | start, *halves)
                yield _batch(_runs(REMOVE, d[gone], t[gone], start[gone], start[gone]))

    return run


def _apply(length: int):
    """Task: what is left of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, blobs in zip(batch.column("text"), batch.column("blobs")):
                text, blobs = text.as_py(), blobs.as_py()
                removed = spans = at = 0
                digest = hashlib.sha256()
                if blobs:
                    first, last = _union(*np.concatenate([np.frombuffer(b, "<i8").reshape(2, -1) for b in blobs], axis=1))
                    first, last = _union(first, last + length - 1)
                    for a, b in zip(first.tolist(), (last + 1).tolist()):
                        digest.update(text[at:a])
                        removed, spans, at = removed + b - a, spans + 1, b
                digest.update(text[at:])
                out.append((len(text), removed, spans, digest.hexdigest()))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def hot_grams(texts: DataFrame, length: int, q: int, chunk: int, crowded: int, flush: int) -> np.ndarray:
    """Grams with over ``crowded`` different runs, as counted flush by flush (equal runs of two flushes count twice)."""
    counted = texts.mapInArrow(_tally(length, q, chunk, flush), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") > crowded).orderBy(F.col("n").desc(), "gram").limit(MOST_HOT).collect()
    return np.sort(np.array([r["gram"] for r in rows], np.int64).view(np.uint64))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, q: int = 32,
                   shard_bytes: int = 16 << 20, chunk: int = 1 << 20, crowded: int = 1 << 14, flush: int = 1_000_000) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` per row: texts without their repeated bytes.

    A byte goes if a string of ``length`` bytes covers it that also starts earlier: in a document of
    smaller id, or earlier in the same one. Matches never cross documents; texts are UTF-8 bytes.

    1. Each window of ``length`` bytes has an anchor, its least q-gram; windows in a row that share it
       are a run. Anchors are bucketed by q-gram. A task folds equal runs of its own texts, then a
       shard those of all tasks: all but the first place of a run are removed as they stand, and a
       q-gram that stands in one class of runs alone is done.
    2. The other buckets hold runs that are alike in part. The bytes of the first place of each class are
       fetched, and bucket-pointer refinement (``refine``) finds their equal windows.
    3. A bucket of over ``crowded`` classes would be too much for one task: its windows go by their own
       128-bit hash instead, folded in the task before. Grams that may have so many are counted before
       anything is dealt (a first scan; at most ``MOST_HOT`` of them); their runs go to shards by run, so
       equal ones still meet, and no task holds the whole bucket.

    Windows are equal by bytes (2.) or by two 64-bit hashes (1. and 3.). Null texts are empty, null ids
    come before all others; rows that repeat an id with another text are told apart by the text's
    crc32, and by nothing else they are one document. An empty table gives an empty result; other
    columns are not read. Long texts are scanned in chunks, so one text and a chunk are in memory.
    """
    if not 1 <= q <= length <= chunk:
        raise ValueError("1 <= q <= length <= chunk must hold")
    least = -(1 << 63)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("doc"), F.crc32(text).alias("tie"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, 1 << (total // shard_bytes).bit_length())
    long_ = F.octet_length("text") >= length
    dealt = lambda df: df.repartition(shards, "shard").sortWithinPartitions("kind", "shard")
    texts = rows.where(long_).select("doc", "tie", "text")
    hot = hot_grams(texts, length, q, chunk, crowded, flush)
    scanned = texts.mapInArrow(_scan(shards, hot, length, q, chunk, flush), SCHEMA)
    merged = landed(dealt(scanned).mapInArrow(_merge(crowded, hot), SCHEMA), "repeats-merged")
    wanted = merged.where(F.col("kind") == FETCH).groupBy("doc", "tie").agg(F.collect_list("blob").alias("blobs"))
    fetched = texts.join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "blobs").mapInArrow(_fetch(shards, length, 16 << 20), SCHEMA)
    resolved = landed(dealt(fetched).mapInArrow(_resolve(length, 1 << 20), SCHEMA), "repeats-resolved")
    gone = (merged.where(F.col("kind") == REMOVE).unionByName(resolved.where(F.col("kind") == REMOVE))
            .groupBy("doc", "tie").agg(F.collect_list("blob").alias("blobs")))
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.join(gone, ["doc", "tie"], "left").select("id", "text", "blobs").mapInArrow(
        _apply(length), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


OP5_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, encode(coalesce(text, '')) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, i, h[i + 1:i + 100] AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM w) WHERE r > 1),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k
      FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM f)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, k),
pieces AS (SELECT s.doc_id, a, b, hex(d.h[coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) + 1:a]) AS piece
           FROM spans s JOIN d USING (doc_id)),
kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(piece, '' ORDER BY a) AS front, max(b) AS last FROM pieces GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k.front, '') || hex(d.h[coalesce(k.last, 0) + 1:n]))) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""
