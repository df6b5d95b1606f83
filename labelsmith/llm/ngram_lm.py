"""Interpolated modified Kneser-Ney model of any order from 2, counted in Spark, mapped by workers (operator 4).

Words get numbers, frequent ones small. An n-gram goes to the shard of its last context word: all n-grams,
contexts and shorter n-grams around that word meet there, so the statistics of every level but the words'
need no other exchange. A shard's file is a tree: contexts by their last word and then leftwards, and per
context its followers, above level 2 as places among the followers of the context one word shorter.
"""

from __future__ import annotations

import json
import mmap
import os
import pickle
import shutil
import sys
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelsmith.session import scratch_dir

from .common import crc32_mod, documents
from .simhash import word_blocks
from .tokens import WordHashes, mix

BEGIN, END = (mix(np.array([n], np.uint64))[0] for n in (1, 2))
CHUNK = 1 << 20
#: Rows of a group, and searches in it, from which it is searched by itself.
OFTEN = 16
#: Order of the registered query's model.
ORDER = 3
#: A mapping needs no open file from Python 3.13 on, so that a reader may keep many.
UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}
#: Number of a word that training has not seen.
UNKNOWN = np.uint64(2**64 - 1)
#: Columns of the statistics of a word: as context its occurrences and followers seen once, twice, more
#: often (below the highest order by their different contexts); as word its different contexts and its
#: occurrences.
CONTEXT_TOTAL, ONCE, TWICE, MORE, CONTEXTS, COUNT = range(6)


def token_blocks(texts: Iterator[tuple[int, bytes]], hashes: WordHashes, chunk: int = CHUNK, order: int = 2,
                 begin: np.uint64 = BEGIN, end: np.uint64 = END) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text number, context hash, word hash)`` of all tokens, in blocks of about ``chunk`` bytes.

    A text's tokens are its words and one end; the first has beginnings as context. Above order 2 the
    context is a row of hashes per place, the nearest last. A text longer than a block is cut at white
    space, its last words carried on as context. ``hashes`` may give numbers instead, with those of ``begin``
    and ``end``.
    """
    wide = order - 1
    shaped = lambda rows: rows[0] if order == 2 else rows
    held: list[tuple[int, bytes]] = []
    size = 0

    def block():
        words, n = hashes([t for _, t in held])
        last = np.cumsum(n + 1) - 1
        token = np.empty(len(words) + len(n), np.uint64)
        inner = np.ones(len(token), bool)
        inner[last] = False
        token[inner], token[last] = words, end
        place = np.arange(len(token)) - np.repeat(last - n, n + 1)
        context = np.full((wide, len(token)), begin)
        for back in range(1, order):
            some = np.flatnonzero(place >= back)
            context[wide - back, some] = token[some - back]
        return np.repeat(np.array([k for k, _ in held], np.int64), n + 1), shaped(context), token

    for k, text in texts:
        if len(text) > chunk:
            before = np.full(wide, begin)
            for part in word_blocks(text, chunk):
                words, _ = hashes([part])
                if len(words):
                    row = np.concatenate([before, words])
                    yield np.full(len(words), k), shaped(np.stack([row[a:a + len(words)] for a in range(wide)])), words
                    before = row[-wide:]
            yield np.array([k]), shaped(before[:, None]), np.array([end])
            continue
        held.append((k, text))
        size += len(text)
        if size >= chunk:
            yield block()
            held.clear()
            size = 0
    if held:
        yield block()


def _key(words: np.ndarray) -> np.ndarray:
    """Hash of rows of words, a row per place."""
    key = words[0]
    for word in words[1:]:
        key = mix(key * np.uint64(3) + np.uint64(1)) + word
    return key


def _shard(last: np.ndarray, word: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """Shard of n-grams: their last context word's, or, where that is hot, one of it and the word."""
    own = last & np.uint64(shards - 1)
    if len(hot):
        some = np.isin(last, hot)
        own[some] = mix(_key(np.stack([last[some], word[some]]))) >> np.uint64(20) & np.uint64(shards - 1)
    return own.astype(np.int64)


def _low_shard(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a word's or a context's hash; a word's number ends in its shard."""
    return (mix(key) >> np.uint64(20)).astype(np.int64) & (shards - 1)


def _pack(*arrays: np.ndarray) -> bytes:
    planes = [(x.dtype.str, len(x), np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()) for x in arrays]
    return zstandard.compress(pickle.dumps(planes), 1)


def _unpack(blob: bytes) -> list[np.ndarray]:
    return [np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(np.dtype(t).itemsize, n).T).reshape(-1).view(t)
            for t, n, p in pickle.loads(zstandard.decompress(blob))]


def _order(cols: list[np.ndarray]) -> np.ndarray:
    """Places of the rows in order of unsigned columns, the first above all; columns that fit 64 bits together are sorted as one."""
    joint, used = [], 0
    for col in cols:
        bits = int(col.max()).bit_length() if len(col) else 0
        if joint and used + bits <= 64:
            joint[-1] <<= np.uint64(bits)
            joint[-1] |= col.astype(np.uint64, copy=False)
            used += bits
        else:
            joint.append(col.astype(np.uint64))
            used = bits
    return np.argsort(joint[0]) if len(joint) == 1 else np.lexsort(joint[::-1])


def _new(*cols: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns differs from the one before."""
    new = np.zeros(len(cols[0]), bool)
    new[:1] = True
    for col in cols:
        new[1:] |= col[1:] != col[:-1]
    return new


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, sorted; of each row its value's place among them; the rows in order.

    Value and row are sorted as one number, which takes a quarter of an ``argsort``. Where they don't fit 64 bits
    together, values that differ in the lowest bits alone come in any order, and then may come more than once.
    """
    values = values.astype(np.uint64, copy=False)
    bits = len(values).bit_length()
    spare = max(0, int(values.max(initial=0)).bit_length() + bits - 64)
    packed = values >> np.uint64(spare) << np.uint64(bits)
    packed |= np.arange(len(values), dtype=np.uint64)
    packed.sort()
    by = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    have = values[by] if spare else packed >> np.uint64(bits)
    del packed
    new = _new(have)
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(new) - 1
    return have[new], number, by


def _local(rows: np.ndarray, key=lambda ids: ids) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the words of n-grams, sorted, and the n-grams as places among them.

    N-grams mostly follow each other in a text: a context word that is the word of the row before takes that one's place.
    """
    word, n = rows[-1], rows.shape[1]
    odd = []
    for back, col in enumerate(rows[-2::-1], 1):
        odd.append(np.concatenate([np.arange(min(back, n)), np.flatnonzero(col[back:] != word[:-back]) + back]))
    have, place, _ = _distinct(key(np.concatenate([word, *(col[some] for col, some in zip(rows[-2::-1], odd))])))
    out = np.empty(rows.shape, np.int32 if len(place) < 1 << 31 else np.int64)
    out[-1] = place[:n]
    at = n
    for back, some in enumerate(odd, 1):
        out[-1 - back, back:] = out[-1, :-back]
        out[-1 - back, some] = place[at:at + len(some)]
        at += len(some)
    return have, out


def _bits(*cols: np.ndarray) -> np.ndarray:
    """Small columns as one, the first above all."""
    out = cols[0].astype(np.uint64)
    for col in cols[1:]:
        out <<= np.uint64(int(col.max(initial=0)).bit_length())
        out |= col.astype(np.uint64, copy=False)
    return out


def _fold(cols: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, sorted, and the sums of their values."""
    if not len(values):
        return cols, values
    by = _order(list(cols))
    cols = cols[:, by]
    first = np.flatnonzero(_new(*cols))
    return cols[:, first], np.add.reduceat(values[by], first, axis=0)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned in as few bytes as the greatest value needs."""
    return values.astype(np.min_scalar_type(int(values.max()) if values.size else 0))


def _small(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Counts that are mostly small: a byte each, the others beside them by place."""
    big = np.flatnonzero(values >= 255)
    return {name: np.minimum(values, 255).astype(np.uint8), f"{name}@": big.astype(np.int64), f"{name}=": values[big].astype(np.int64)}


def _counts(file: dict, name: str, at: np.ndarray) -> np.ndarray:
    """Counts at places of what ``_small`` made."""
    out = file[name][at].astype(np.int64)
    big = np.flatnonzero(out == 255)
    out[big] = file[f"{name}="][np.searchsorted(file[f"{name}@"], at[big])]
    return out


def _spans(name: str, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Sizes, none of them 0, of groups that lie one behind the other: those over 1, and what they have over it till then."""
    more = np.flatnonzero(sizes > 1)
    return {f"{name}@": more.astype(np.min_scalar_type(len(sizes))), f"{name}+": _narrow(np.concatenate(([0], np.cumsum(sizes[more] - 1))))}


def _find(have: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted array at or before which the wanted come, and whether they are there."""
    if not len(have):
        return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
    fits = want <= np.uint64(have[-1])
    at = np.searchsorted(have, np.where(fits, want, 0).astype(have.dtype))
    return at, fits & (have[np.minimum(at, len(have) - 1)] == want)


def _span(file: dict, name: str, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of groups, which of them have over one row, and their places among those that do."""
    more, before = file[f"{name}@"], file[f"{name}+"]
    at = np.searchsorted(more, of.astype(more.dtype))
    many = more[np.minimum(at, len(more) - 1)] == of if len(more) else np.zeros(len(of), bool)
    start = of + before[at].astype(np.int64)
    return start, of + 1 + before[at + many].astype(np.int64), many, at


def _within(values: np.ndarray, start: np.ndarray, end: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted in sorted groups of an array, and whether they are there.

    A large group that is asked often in a row is searched in one call, the others step by step all at once.
    """
    place, size = start.copy(), end - start
    some, left = size > 0, size > 1
    first = np.flatnonzero(_new(start, end))
    last = np.append(first[1:], len(start))
    often = np.flatnonzero((last - first >= OFTEN) & (size[first] > OFTEN))
    narrow = np.minimum(want, np.uint64(np.iinfo(values.dtype).max)).astype(values.dtype) if len(often) else want
    for a, b, low, high in zip(*(x[often].tolist() for x in (first, last, start[first], end[first]))):
        place[a:b] = np.searchsorted(values[low:high - 1], narrow[a:b]) + low
        left[a:b] = False
    todo = np.flatnonzero(left)
    low, left, of = place[todo], size[todo], want[todo]
    while len(todo):
        half = left >> 1
        low += half * (values[low + half] <= of)
        left -= half
        more = left > 1
        if np.count_nonzero(more) < 0.75 * len(todo):
            place[todo] = low
            todo, low, left, of = todo[more], low[more], left[more], of[more]
    return place, some & (values[np.minimum(place, len(values) - 1)] == want)


def _write(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays as one raw file that appears whole or not at all; a task run again writes the same."""
    store, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    store.create_dir(path, recursive=True)
    head, at = {}, 0
    for key, x in arrays.items():
        head[key] = (x.dtype.str, x.shape, at)
        at += -(-x.nbytes // 8) * 8
    line = json.dumps(head).encode()
    line += b" " * (-len(line) % 8)
    with store.open_output_stream(part) as f:
        f.write(len(line).to_bytes(8, "little") + line)
        for x in arrays.values():
            f.write(np.ascontiguousarray(x).tobytes() + bytes(-x.nbytes % 8))
    store.move(part, f"{path}/{name}")


def _map(folder: str, name: str) -> dict[str, np.ndarray]:
    """A raw file's arrays, memory-mapped. From a remote store a copy is mapped, which has no name and
    goes with its mapping."""
    if "://" not in folder:
        with open(f"{folder}/{name}", "rb") as f:
            data = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **UNTRACKED), np.uint8)
    else:
        store, path = fs.FileSystem.from_uri(f"{folder}/{name}")
        with store.open_input_stream(path) as f, tempfile.TemporaryFile() as copy:
            shutil.copyfileobj(f, copy, 1 << 20)
            data = np.memmap(copy, np.uint8, "r")
    data = np.asarray(data)
    base = 8 + int.from_bytes(data[:8].tobytes(), "little")
    out = {}
    for key, (kind, shape, at) in json.loads(data[8:base].tobytes()).items():
        size = np.dtype(kind).itemsize * int(np.prod(shape))
        out[key] = data[base + at:base + at + size].view(kind).reshape(shape)
    return out


ROW = "shard int, blob binary"


def _rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "blob"])


def _split(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, with the places of its rows in order."""
    by = np.argsort(_narrow(shard), kind="stable")
    present, cuts = np.unique(shard[by], return_index=True)
    return zip(present.tolist(), np.split(by, cuts[1:]))


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The blobs of each shard (rows come sorted by shard)."""
    now, blobs = None, []
    for batch in batches:
        for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("blob").to_pylist()):
            if now is not None and shard != now:
                yield now, blobs
                blobs = []
            now = shard
            blobs.append(blob)
    if now is not None:
        yield now, blobs


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for t in batch.column("text"):
            yield 0, t.as_py()


def _tally(shards: int, flush: int):
    """Task: the words of its texts with counts, folded, a blob per shard. The beginning is among them, with none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return _rows([(s, _pack(keys[of], _narrow(counts[of]))) for s, of in _split(_low_shard(keys, shards))])

        for _, _, word in token_blocks(_texts(batches), WordHashes()):
            k, c = np.unique(np.append(word, BEGIN), return_counts=True)
            c[k == BEGIN] -= 1
            (keys,), counts = _fold(np.concatenate([keys, k])[None], np.concatenate([counts, c]))
            if len(keys) >= flush:
                yield out()
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield out()

    return run


def _dictionary(folder: str, shards: int, least: float):
    """Task: a shard's words, written by sorted hash with their ranks and, by rank, counts. A word's number is
    its rank (the beginning's is 0, then by count) and its shard.

    Numbers and counts of words that occur ``least`` times; under -1 how many words there are, under -2 tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _by_shard(batches):
            keys, counts = (np.concatenate(x) for x in zip(*map(_unpack, blobs)))
            (keys,), counts = _fold(keys[None], counts.astype(np.int64))
            by = np.lexsort((-counts, keys != BEGIN))
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            _write(folder, f"words-{shard}", {"keys": keys, "rank": _narrow(rank), **_small("count", counts[by])})
            hot = np.flatnonzero(counts >= max(least, 1))
            yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *(rank[hot] * shards + shard).tolist()], pa.int64()),
                                              pa.array([int((counts > 0).sum()), int(counts.sum()), *counts[hot].tolist()], pa.int64())], ["id", "n"])

    return run


def _count(model: Model, flush: int):
    """Task: the n-grams of its tokens with counts, folded, a blob per shard: last context words, then the
    words before it leftwards and the word itself, counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            words, grams = _local(np.concatenate(held, axis=1))
            held.clear()
            wide = max(1, (len(words) - 1).bit_length())
            grams = [*grams[-2::-1], grams[-1]]
            if wide * model.order <= 64:
                packed = grams[0].astype(np.uint64)
                for col in grams[1:]:
                    packed <<= np.uint64(wide)
                    packed |= col.astype(np.uint64)
                packed.sort()
                first = np.flatnonzero(_new(packed))
                counts = np.diff(np.append(first, len(packed)))
                packed = packed[first]
                grams = np.stack([(packed >> np.uint64(wide * k) & np.uint64((1 << wide) - 1)).astype(np.int32) for k in reversed(range(model.order))])
            else:
                by = _order(grams)
                grams = np.stack([col[by] for col in grams])
                first = np.flatnonzero(_new(*grams))
                counts = np.diff(np.append(first, grams.shape[1]))
                grams = grams[:, first]
            shard = (words & np.uint64(model.shards - 1)).astype(np.int64)[grams[0]]
            some = np.flatnonzero(np.isin(words, model.hot)[grams[0]])
            shard[some] = _shard(words[grams[0, some]], words[grams[-1, some]], model.hot, model.shards)
            rows = []
            for s, of in _split(shard):
                lead = grams[0, of]
                new = np.flatnonzero(_new(lead))
                have, number, _ = _distinct(grams[1:, of].ravel())
                rows.append((s, _pack(_narrow(words[lead[new]]), _narrow(np.diff(np.append(new, len(of)))), _narrow(words[have.astype(np.int64)]),
                                      *map(_narrow, number.reshape(model.order - 1, -1)), _narrow(counts[of]))))
            return _rows(rows)

        for _, context, word in token_blocks(_texts(batches), reader.numbers(), model.chunk, model.order, reader.begin, reader.end):
            held.append(_narrow(np.concatenate([np.atleast_2d(context), word[None]])))
            size += len(word)
            if size >= flush:
                yield out()
                size = 0
        if held:
            yield out()

    return run


def _pairs(folder: str, shards: int, hot: np.ndarray = np.zeros(0, np.uint64)):
    """Task: all counts of a shard's n-grams, written as a tree; what its words are as contexts and as followers, a
    blob per shard of words; the statistics of longer contexts that end in a hot word, so far as they lie
    here, a blob per shard of their hashes; the sums for the discounts.

    Blobs of words have their own shard, those of contexts of ``j`` words follow from ``(j - 1) * shards``,
    the sums come last.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _by_shard(batches):
            cols, counts = [], []
            for lead, runs, words, *number, count in map(_unpack, blobs):
                cols.append(np.stack([np.repeat(lead, runs), *(words[x] for x in number)]).astype(np.uint64))
                counts.append(count.astype(np.int64))
            cols, value = _fold(np.concatenate(cols, axis=1), np.concatenate(counts))
            del counts
            word, depth = cols[-1], len(cols) - 1
            # contexts of 1 to depth words: their first rows, and the number of each row's context
            first, group, new = [], [], np.zeros(len(word), bool)
            for j in range(depth):
                new = new | _new(cols[j])
                first.append(np.flatnonzero(new))
                group.append(np.cumsum(new) - 1)
            arrays = {"last": _narrow(cols[0][first[0]])}
            for j in range(1, depth):
                arrays |= {f"left{j}": _narrow(cols[j][first[j]]), **_spans(f"wider{j}", np.bincount(group[j - 1][first[j]]))}
            rows = []
            for j in reversed(range(depth)):
                sizes = np.bincount(group[j])
                stats = np.add.reduceat(np.stack([value, value == 1, value == 2, value > 2], axis=1), np.cumsum(sizes) - sizes, axis=0)
                many = np.flatnonzero(sizes > 1)
                arrays |= {**_spans(f"grams{j}", sizes), **_small(f"value{j}", value)}
                arrays |= {f"{name}{j}": _narrow(stats[many, k]) for k, name in ((CONTEXT_TOTAL, "total"), (TWICE, "twice"), (MORE, "more"))} if j else {}
                rows.append(((depth * shards) + j, _pack(np.array([(value == k).sum() for k in (1, 2, 3, 4)], np.int64))))
                if j == 0:
                    break
                if len(hot):
                    some = np.flatnonzero(np.isin(cols[0][first[j]], hot))
                    keys = _key(cols[:j + 1, first[j][some]])
                    for s, at in _split(_low_shard(keys, shards)):
                        rows.append((j * shards + s, _pack(keys[at], *map(_narrow, stats[some[at]].T))))
                # the n-grams one word shorter: a row each, counted by their contexts
                by = _order([group[j - 1], word])
                start = _new(group[j - 1][by], word[by])
                place = np.empty(len(by), np.int64)
                place[by] = np.cumsum(start) - 1
                by = by[start]
                lower = np.bincount(group[j - 1][by])
                arrays[f"follower{j}"] = _narrow(place - (np.cumsum(lower) - lower)[group[j - 1]])
                value = np.bincount(place)
                group, word = [x[by] for x in group[:j]], word[by]
            arrays["follower0"] = _narrow(word)
            _write(folder, f"grams-{shard}", arrays)
            last = cols[0][first[0]]
            words, kinds = np.unique(word, return_counts=True)
            ids = np.concatenate([last, words])
            table = np.zeros((len(ids), 5), np.int64)
            table[:len(last), :4], table[len(last):, CONTEXTS] = stats, kinds
            (ids,), table = _fold(ids[None], table)
            for s, at in _split((ids & np.uint64(shards - 1)).astype(np.int64)):
                rows.append((s, _pack(_narrow(ids[at]), *map(_narrow, table[at].T))))
            yield _rows(rows)

    return run


def _words(model: Model):
    """Task: a shard's words' statistics, written by rank, or those of contexts with a hot word, by sorted hash; sums for the discounts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, shards = Reader(model), model.shards
        for shard, blobs in _by_shard(batches):
            kind, s = divmod(shard, shards) if shard < (model.order - 1) * shards else (model.order - 1, 0)
            level, sums = 1, np.zeros(6, np.int64)
            if kind == model.order - 1:
                level, sums[:4] = shard - kind * shards + 2, sum(_unpack(b)[0] for b in blobs)
            else:
                keys, *stats = (np.concatenate(x) for x in zip(*([x.astype(np.uint64) for x in _unpack(b)] for b in blobs)))
                (keys,), stats = _fold(keys[None], np.stack(stats, axis=1).astype(np.int64))
                if kind:
                    _write(model.folder, f"hot{kind}-{s}", {"keys": keys, "stats": _narrow(stats)})
                else:
                    table = np.zeros((len(reader.file(f"words-{s}")["rank"]), 5), np.int64)
                    table[(keys // np.uint64(shards)).astype(np.int64)] = stats
                    _write(model.folder, f"stats-{s}", {k: x for n in range(5) for k, x in _small(f"stat{n}", table[:, n]).items()})
                    kinds = table[:, CONTEXTS]
                    sums[:] = [*((kinds == k).sum() for k in (1, 2, 3, 4)), (kinds > 2).sum(), kinds.sum()]
            yield pa.RecordBatch.from_arrays([pa.array([level], pa.int32()), *(pa.array([int(x)], pa.int64()) for x in sums)], ["level", *"abcdef"])

    return run


def _discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
    return np.array([0.0, *(min(max(d, 0.0), float(k)) for k, d in zip((1, 2, 3), raw))])


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and what the whole corpus sets: the rest stays in the files."""

    folder: str
    shards: int
    hot: np.ndarray
    gram_discounts: tuple[np.ndarray, ...]
    word_discounts: np.ndarray
    word_counts: tuple[int, int, int]
    contexts: int
    tokens: int
    vocabulary: int
    order: int = 2

    @property
    def chunk(self) -> int:
        """Bytes of text that are looked up at once: every block goes to all files, so more for more files."""
        return min(max(CHUNK, self.shards << 15), 8 * CHUNK)


class Reader:
    """Looks words and n-grams up in the model's mapped arrays; keeps a bounded number of files open."""

    def __init__(self, model: Model, files: int | None = None):
        self.m, self.open_ = model, OrderedDict()
        self.files = files or (512 if "://" in model.folder or not UNTRACKED else 1 << 14)

    def file(self, name: str) -> dict[str, np.ndarray] | None:
        if name not in self.present():
            return None
        if name not in self.open_:
            self.open_[name] = _map(self.m.folder, name)
            while len(self.open_) > self.files:
                self.open_.popitem(last=False)
        self.open_.move_to_end(name)
        return self.open_[name]

    def present(self) -> set[str]:
        if not hasattr(self, "names"):
            if "://" in self.m.folder:
                store, path = fs.FileSystem.from_uri(self.m.folder)
                self.names = {x.base_name for x in store.get_file_info(fs.FileSelector(path, allow_not_found=True))}
            else:
                self.names = set(os.listdir(self.m.folder)) if os.path.isdir(self.m.folder) else set()
        return self.names

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words given by hash."""
        keys, back, _ = _distinct(np.ravel(hashes))
        out = np.full(len(keys), UNKNOWN)
        for s, of in _split(_low_shard(keys, self.m.shards)):
            if file := self.file(f"words-{s}"):
                at, there = _find(file["keys"], keys[of])
                out[of[there]] = file["rank"][at[there]] * np.uint64(self.m.shards) + np.uint64(s)
        return out[back].reshape(np.shape(hashes))

    @property
    def begin(self) -> np.uint64:
        return self.ids(np.array([BEGIN]))[0]

    @property
    def end(self) -> np.uint64:
        return self.ids(np.array([END]))[0]

    def numbers(self):
        """Numbers of the words of texts, as ``WordHashes`` gives hashes: hashed in blocks, looked up at once."""
        hashes = WordHashes()

        def parts(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
            held, of, size = [], [], 0
            for k, text in enumerate(texts):
                for part in word_blocks(text, CHUNK) if len(text) > CHUNK else (text,):
                    held.append(part)
                    of.append(k)
                    size += len(part)
                    if size >= CHUNK:
                        yield held, np.array(of)
                        held, of, size = [], [], 0
            if held:
                yield held, np.array(of)

        def numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            words, n = [], np.zeros(len(texts), np.int64)
            for held, of in parts(texts):
                found, each = hashes(held)
                words.append(found)
                np.add.at(n, of, each)
            return self.ids(np.concatenate(words)), n

        return numbers

    def words(self, words: np.ndarray) -> np.ndarray:
        """Statistics of words."""
        out = np.zeros((len(words), 6), np.int64)
        known = np.flatnonzero(words != UNKNOWN)
        for s, of in _split((words[known] & np.uint64(self.m.shards - 1)).astype(np.int64)):
            of = known[of]
            rank = (words[of] // np.uint64(self.m.shards)).astype(np.int64)
            out[of, COUNT] = _counts(self.file(f"words-{s}"), "count", rank)
            if file := self.file(f"stats-{s}"):
                for k in range(5):
                    out[of, k] = _counts(file, f"stat{k}", rank)
        return out

    def numbered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words by shard and rank, the unknown one last, and rows of their places."""
        m, bits = self.m, np.uint64(self.m.shards.bit_length() - 1)
        low, wide = np.uint64(m.shards - 1), np.uint64(max(0, int(rows.max(where=rows != UNKNOWN, initial=0)).bit_length() - int(bits)))
        keys, number = _local(rows, lambda ids: np.where(ids == UNKNOWN, np.uint64(m.shards) << wide, (ids & low) << wide | ids >> bits))
        words = (keys & ((np.uint64(1) << wide) - np.uint64(1))) << bits | keys >> wide
        words[keys >= np.uint64(m.shards) << wide] = UNKNOWN
        return words, number

    def grams(self, words: np.ndarray, context: np.ndarray, word: np.ndarray) -> tuple[tuple, list[tuple]]:
        """What n-grams of 2 words up to all of them count; words are places in ``words`` as ``numbered`` gives them.

        Of the pairs, each once: their last context words, words, counts and each n-gram's pair. Of every further
        level the n-grams' counts, their contexts' statistics, a context once, and each n-gram's context.
        """
        m, cols = self.m, context[::-1]
        # a last context word in a shard: one, but for hot words
        hot = np.isin(words, m.hot)
        own = np.where(words == UNKNOWN, 0, words) & np.uint64(m.shards - 1)
        shard = own[cols[0]]
        if hot.any():
            some = np.flatnonzero(hot[cols[0]])
            shard[some] = _shard(words[cols[0, some]], words[word[some]], m.hot, m.shards)
        where, at, by = _distinct(_bits(shard, cols[0]))
        wide = np.uint64(int(cols[0].max(initial=0)).bit_length())
        last = (where & ((np.uint64(1) << wide) - np.uint64(1))).astype(np.int64)
        shards = (where >> wide).astype(np.int64)
        inner = lambda keys, lower: (keys >> (bits := np.uint64(int(lower.max(initial=0)).bit_length())), keys & ((np.uint64(1) << bits) - np.uint64(1)))
        keys, pair, _ = _distinct(_bits(at, word))
        pair_last, pair_word = (x.astype(np.int64) for x in inner(keys, word))
        number, of, left = [at], [np.arange(len(where))], [last]
        top = [np.arange(len(where))]
        for col in cols[1:]:
            keys, place, by = _distinct(_bits(number[-1], col))
            shorter, word_of = (x.astype(np.int64) for x in inner(keys, col))
            number.append(place)
            of.append(shorter)
            left.append(word_of)
            top.append(top[-1][shorter])
        depth = len(cols)
        pairs, gone = np.zeros(len(pair_last), np.int64), -1
        place = np.full(len(pair_last), gone)
        values = np.zeros((depth - 1, len(word)), np.int64)
        stats = [np.zeros((len(x), 4), np.int64) for x in of]
        begin = np.append(np.flatnonzero(_new(shards)), len(shards))
        cut = [np.searchsorted(x, begin) for x in top]  # contexts of each level, shard by shard
        cut_pairs, cut_rows = np.searchsorted(pair_last, begin), np.searchsorted(number[-1][by], cut[-1])
        for k, (a, b) in enumerate(zip(begin[:-1], begin[1:])):
            file = self.file(f"grams-{shards[a]}")
            if not file:
                continue
            found, there = _find(file["last"], words[last[a:b]])
            live = np.flatnonzero(there)
            mine = slice(cut_pairs[k], cut_pairs[k + 1])
            span = self.spans(file, "grams0", found, live)
            start, end = span[:, pair_last[mine] - a]
            gram, there = _within(file["follower0"], start, end, words[pair_word[mine]])
            some = np.flatnonzero(there)
            pairs[mine.start + some] = _counts(file, "value0", gram[some])
            place[mine.start + some] = gram[some] - start[some]
            row = by[cut_rows[k]:cut_rows[k + 1]]
            want = place[pair[row]]
            row, want = row[want >= 0], want[want >= 0]
            for j in range(1, depth):
                a, b = cut[j][k], cut[j][k + 1]
                wider = self.spans(file, f"wider{j}", found, live)
                start, end = wider[:, of[j][a:b] - cut[j - 1][k]]
                found, there = _within(file[f"left{j}"], start, end, words[left[j][a:b]])
                live = np.flatnonzero(there)
                start, end, many, more_at = _span(file, f"grams{j}", found[live])
                one = _counts(file, f"value{j}", start)
                stats[j][a + live] = np.stack([one, one == 1, one == 2, one > 2], axis=1)
                total, twice, more = (file[f"{name}{j}"][more_at[many]].astype(np.int64) for name in ("total", "twice", "more"))
                stats[j][a + live[many]] = np.stack([total, (end - start)[many] - twice - more, twice, more], axis=1)
                span = np.zeros((2, b - a), np.int64)
                span[:, live] = start, end
                start, end = span[:, number[j][row] - a]
                gram, there = _within(file[f"follower{j}"], start, end, want.astype(np.uint64))
                some = np.flatnonzero(there)
                row, gram = row[some], gram[some]
                values[j - 1, row] = _counts(file, f"value{j}", gram)
                want = gram - start[some]
        key = [words[last]]
        for j in range(1, depth):
            key = [x[of[j]] for x in key] + [words[left[j]]]
            some = np.flatnonzero(hot[last[top[j]]])
            keys, back = np.unique(_key(np.stack(key)[:, some]), return_inverse=True)
            sums = np.zeros((len(keys), 4), np.int64)
            for s, at in _split(_low_shard(keys, m.shards)):
                if file := self.file(f"hot{j}-{s}"):
                    where, there = _find(file["keys"], keys[at])
                    sums[at[there]] = file["stats"][where[there]]
            stats[j][some] = sums[back]
        return (last[pair_last], pair_word, pairs, pair), list(zip(values, stats[1:], number[1:]))

    def spans(self, file: dict, name: str, found: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Starts and ends of the groups of those of the found that are live, zeros for the others."""
        span = np.zeros((2, len(found)), np.int64)
        span[:, live] = _span(file, name, found[live])[:2]
        return span

    def pairs(self, *words: np.ndarray) -> np.ndarray:
        """Counts of n-grams of highest order."""
        have, number = self.numbered(np.stack(words))
        (_, _, counts, pair), longer = self.grams(have, number[:-1], number[-1])
        return longer[-1][0] if longer else counts[pair]


def probabilities(reader: Reader, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``number_probabilities`` of tokens and contexts given by hash."""
    return number_probabilities(reader, reader.ids(context), reader.ids(word))


def _interpolated(p: np.ndarray, count: np.ndarray, of: np.ndarray, number: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Probabilities one level up: n-grams' discounted shares of their contexts, ``number`` in ``of``, plus what these leave."""
    total, left = of[:, CONTEXT_TOTAL], of[:, ONCE] * d[1] + of[:, TWICE] * d[2] + of[:, MORE] * d[3]
    safe = np.maximum(total, 1)
    known, share = (total > 0)[number], (left / safe)[number]
    return np.where(known, (count - d[np.minimum(count, 3)]) / safe[number] + share * p, p)


def number_probabilities(reader: Reader, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token its probability after its context, its training count, and its add-one probability.

    Modified Kneser-Ney, interpolated: an n-gram's discounted share of its context, plus the context's
    discounts times the probability after the context without its first word. Below the highest order an
    n-gram counts by its different contexts; a word's share of all different pairs gets those discounts
    spread evenly over the vocabulary and one unknown word. ``context`` is as in ``token_blocks``.
    """
    m = reader.m
    words, number = reader.numbered(np.concatenate([np.atleast_2d(context), word[None]]))
    stats = reader.words(words)
    kinds = stats[:, CONTEXTS]
    even = 1.0 / (m.vocabulary + 1)
    if m.contexts:
        n1, n2, more = m.word_counts
        spread = (m.word_discounts[1] * n1 + m.word_discounts[2] * n2 + m.word_discounts[3] * more) / m.contexts
        low = (kinds - m.word_discounts[np.minimum(kinds, 3)]) / m.contexts + spread * even
    else:
        low = np.full(len(words), even)
    (last, follower, count, pair), longer = reader.grams(words, number[:-1], number[-1])
    p = _interpolated(low[follower], count, stats, last, m.gram_discounts[0])[pair]
    for d, (count, wider, of_wider) in zip(m.gram_discounts[1:], longer):
        p = _interpolated(p, count, wider, of_wider, d)
    of_word = number[-1]
    seen = stats[of_word, COUNT]
    return p, seen, (seen + 1) / (m.tokens + m.vocabulary + 1)


def train(docs: DataFrame, learn: Column, text_col: str = "text", shard_bytes: int = 16 << 20, flush: int = 5_000_000, order: int = 2) -> Model:
    """Model of the documents for which ``learn`` holds, of n-grams of ``order`` words.

    A first scan numbers the words. Then tasks count and fold the n-grams of their own tokens; an n-gram goes
    to the shard of its last context word, which writes a tree of its n-grams and all shorter ones and passes
    on what its words are as contexts and as followers. Words that hold over a quarter of a shard's fair share
    (at most ``8 * shards`` of them) are dealt over all shards with the word that follows; of their longer
    contexts each shard passes on its part. Number of shards, files and shuffled bytes grow with the
    corpus; only the discounts' sums and the hot words come to the driver.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    texts = docs.where(learn).select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, 1 << (total * (order - 1) // shard_bytes).bit_length())
    folder = scratch_dir(spark, "ngram-model")
    folder = folder if "://" in folder else os.path.normpath(folder).replace("//", "/")
    dealt = lambda df: df.repartition(shards, "shard").sortWithinPartitions("shard")
    tallied = dealt(texts.mapInArrow(_tally(shards, flush), ROW)).mapInArrow(_dictionary(folder, shards, total / (48 * shards)), "id long, n long")
    found = tallied.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.col("id") >= 0, F.col("n").desc()).limit(8 * shards + 2).collect()
    known = {r["id"]: r["n"] for r in found}
    vocabulary, tokens = known.pop(-1, 0), known.pop(-2, 0)
    model = Model(folder, shards, np.array(sorted(known), np.uint64), (), np.zeros(4), (0, 0, 0), 0, tokens, vocabulary, order)
    rows = dealt(texts.mapInArrow(_count(model, flush // 2), ROW)).mapInArrow(_pairs(folder, shards, model.hot), ROW)
    sums = dealt(rows).mapInArrow(_words(model), "level int, " + ", ".join(f"{c} long" for c in "abcdef"))
    got = {r["level"]: [r[f"sum({c})"] for c in "abcdef"] for r in sums.groupBy("level").sum(*"abcdef").collect()}
    one, *more = (got.get(level, [0] * 6) for level in range(1, order + 1))
    return replace(model, gram_discounts=tuple(_discounts(x[:4]) for x in more), word_discounts=_discounts(one[:4]), word_counts=(one[0], one[1], one[4]), contexts=one[5])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, n_known, base_score, score`` per row; scores are log10 probabilities of the whole text.

    Null and empty texts are the end token alone. Repeated rows and null ids are scored like any other;
    an empty table gives an empty result; other columns are not read. Without training texts every
    token is the unknown one, of probability 1.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        numbers, ends = reader.numbers(), {"begin": reader.begin, "end": reader.end}
        for batch in batches:
            texts = ((k, t.as_py()) for k, t in enumerate(batch.column("text")))
            sums = np.zeros((batch.num_rows, 4))
            for number, context, word in token_blocks(texts, numbers, chunk=model.chunk, order=model.order, **ends):
                p, seen, base = number_probabilities(reader, context, word)
                for k, x in enumerate((np.ones(len(word)), seen > 0, np.log10(base), np.log10(p))):
                    sums[:, k] += np.bincount(number, x, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(sums[:, k].astype(np.int64)) for k in (0, 1)), *(pa.array(sums[:, k]) for k in (2, 3))],
                                             ["id", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)


def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose crc32 of the id modulo 7 is not 2, and scores all documents."""
    docs, held = documents(spark, sf_dir).select("doc_id", "text"), crc32_mod("doc_id", 7) == 2
    model = train(docs, ~held, order=ORDER)
    return score(docs, model).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
