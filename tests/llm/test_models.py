"""Operators 3, 4, 7 and 10: toxicity, language model, packing, personal data."""

import itertools
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from labelsmith.llm import ngram_lm, packing, pii, toxicity
from labelsmith.llm.queries import QUERIES

# ---- toxicity


def _maximal(scores):
    """All maximal segments by definition: the best, then those left and right of it (shortest of equals)."""
    if not scores:
        return []
    best = max(((round(sum(scores[a:b]), 9), a - b, -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    if best[0] <= 0:
        return []
    a, b = -best[2], best[3]
    shift = [(x + b, y + b, s) for x, y, s in _maximal(scores[b:])]
    return _maximal(scores[:a]) + [(a, b - 1, best[0])] + shift


def test_segments_against_definition():
    rnd = random.Random(1)
    for _ in range(300):
        scores = [rnd.choice([-5, -3, -1.5, 2, 3.25, 4, 0.5]) + rnd.random() / 1000 for _ in range(rnd.randrange(14))]
        got = toxicity.maximal_segments(list(enumerate(scores)), 0.0)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in _maximal(scores)]
        assert np.allclose([s for *_, s in got], [s for *_, s in _maximal(scores)])
    assert toxicity.maximal_segments([(3, 2.0), (10, 2.0)], 0.5) == [(3, 3, 2.0), (10, 10, 2.0)]
    assert [x[:2] for x in toxicity.maximal_segments([(3, 2.0), (5, 2.0)], 0.5)] == [(3, 5)]


def test_toxicity_held_out(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = QUERIES["op3_toxicity"](spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    caught = [r for r in held if r.predicted]
    assert sum(r.toxic for r in caught) / len(caught) >= 0.9
    assert sum(r.toxic for r in caught) / sum(r.toxic for r in held) >= 0.75


def _segments(scores):
    """Scores of all maximal segments: the best one, then those of what lies left and right of it."""
    out, todo = [], [(0, len(scores))]
    while todo:
        a, b = todo.pop()
        best, total, start, found = 0.0, 0.0, a, None
        for i in range(a, b):
            if total <= 0:
                total, start = 0.0, i
            total += scores[i]
            if total > best + 1e-12:
                best, found = total, (start, i + 1)
        if found:
            out.append(sum(scores[found[0]:found[1]]))
            todo += [(a, found[0]), (found[1], b)]
    return out


def _toxicity(docs, toxic, folds):
    """Scores of ``docs`` (id -> text), learnt from the labels ``toxic`` (id -> 0 or 1): every step by its formula, over whole word lists."""
    words = {i: re.findall(r"\w+", (t or "").lower()) for i, t in docs.items()}
    feats = lambda w: [w, *[w[:n] + "*" for n in (7, 5) if len(w) > n]]

    def weights(ids):
        counts = [Counter(), Counter()]
        for i in ids:
            counts[toxic[i]].update({f for w in words[i] for f in feats(w)})
        totals = [sum(c.values()) for c in counts]
        out, a0 = {}, 0.1 * sum(totals)
        for f in set(counts[0]) | set(counts[1]):
            prior = (counts[0][f] + counts[1][f]) * a0 / sum(totals)
            odds = [math.log((c[f] + prior) / (n + a0 - c[f] - prior)) for c, n in zip(counts, totals)]
            delta = odds[1] - odds[0]
            if abs(delta) / math.sqrt(sum(1 / (c[f] + prior) for c in counts)) >= 2.5:
                out[f] = delta
        return out

    def segments(i, of):
        return _segments([next((of[f] for f in feats(w) if f in of), 0.0) - 0.02 for w in words[i]])

    halves = [weights([i for i in toxic if folds[i] == k]) for k in (0, 1)]
    texts = [(toxic[i], len(words[i]), segments(i, halves[1 - folds[i]])) for i in toxic]
    clean = [(math.log(n + 1), max(s, default=0.0)) for y, n, s in texts if not y]
    xs, ys = np.array([c[0] for c in clean]), np.array([c[1] for c in clean])
    growth = max(0.0, ((xs - xs.mean()) * (ys - ys.mean())).sum() / (len(xs) - 1) / xs.var())
    rest = ys - growth * xs
    scale = max(0.25, rest.std() * math.sqrt(6) / math.pi)
    location = rest.mean() - 0.5772156649 * scale

    def evidence(n, scores):
        zs = sorted(((s - location - growth * math.log(n + 1)) / scale for s in scores), reverse=True)
        ps = [math.log(1 - math.exp(-math.exp(-z))) if z < 12 else -z for z in zs]
        return -sum(p for k, p in enumerate(ps) if not k or p <= math.log(0.05))

    x, y = np.array([evidence(n, s) for _, n, s in texts]), np.array([t[0] for t in texts], float)
    a, b = math.log(y.mean() / (1 - y.mean())), 0.1
    loss = lambda a, b: (np.logaddexp(0, a + b * x) - y * (a + b * x)).sum() + 0.005 * (a * a + b * b)
    step = 0.25
    while step > 1e-11:  # pattern search: another way to the same minimum
        moves = [(a + da, b + db) for da in (-step, 0, step) for db in (-step, 0, step)]
        best = min(moves, key=lambda m: loss(*m))
        if best == (a, b):
            step /= 2
        a, b = best
    both = weights(list(toxic))
    return {i: 1 / (1 + math.exp(-max(-40, min(40, a + max(0.0, b) * evidence(len(words[i]), segments(i, both)))))) for i in docs}


def test_toxicity_against_brute_force(spark):
    rnd = random.Random(6)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    labels = {}
    for i in docs:  # the small table has few labels: planted passages, some of them not marked
        labels[i] = int(rnd.random() < 0.35)
        if labels[i] and rnd.random() < 0.8:
            words = (docs[i] or "").split(" ")
            at = rnd.randrange(len(words) + 1)
            docs[i] = " ".join([*words[:at], *rnd.choices(["vile", "rotten", "scumbags", "scumbag"], k=rnd.randrange(1, 6)), *words[at:]])
    learn = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 3 != 1}
    folds = {r.id: r.f for r in spark.range(max(docs) + 1).select("id", F.pmod(F.xxhash64("id"), F.lit(2)).alias("f")).collect()}
    df = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    model = toxicity.train(table, df, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    assert model.weights and model.slope > 0
    want = _toxicity(docs, learn, folds)
    for r in toxicity.score(table, model).collect():
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-5, abs_tol=1e-7)


def test_toxicity_edges(spark):
    texts = ["nice calm words here", "vile rotten vile rotten words"] * 40
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)] + [(None, "vile", 0.1), (900, None, 0.1), (901, "", 0.1), (901, "", 0.1), (902, "calm " * 300_000, 0.1)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, k % 2, 1) for k in range(80)] + [(None, 1, 1), (5, None, 1), (5, 1, 1), (7777, 1, 1)], "doc_id long, toxic int, text int")
    model = toxicity.train(docs, labels, F.lit(True))
    rows = toxicity.score(docs, model).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(texts) + 5 and len(by[901]) == 2
    assert by[1][0].score > 0.7 > by[0][0].score and by[1][0].n_passages >= 1 and by[902][0].score < 0.7
    assert by[900][0].score == by[901][0].score
    assert toxicity.score(docs.limit(0), model).collect() == []
    none = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert not none.weights and all(0 <= r.score < 0.7 for r in toxicity.score(docs, none).collect())


# ---- language model

def _tokens(s):
    return re.findall(rb"[^\x20\x09-\x0D]+", (s or "").encode().lower()) + [b"\0end"]


def _brute(train):
    c, pairs = Counter(), Counter()
    for t in train:
        w = _tokens(t)
        c.update(w)
        pairs.update(zip([b"\0begin", *w[:-1]], w))
    n, v, kinds, total, ns = sum(c.values()), len(c), Counter(w for _, w in pairs), Counter(), defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), k in pairs.items():
        total[a] += k
        ns[a][min(k, 3)] += 1

    def discounts(values):
        n1, n2, n3, n4 = (sum(x == k for x in values) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0
        return [0, *(min(max(d, 0), k) for k, d in ((1, 1 - 2 * y * n2 / n1 if n1 else 0), (2, 2 - 3 * y * n3 / n2 if n2 else 0), (3, 3 - 4 * y * n4 / n3 if n3 else 0)))]

    d2, d1, t = discounts(list(pairs.values())), discounts(list(kinds.values())), sum(kinds.values())
    spread = sum(d1[min(k, 3)] for k in kinds.values()) / t

    def p(a, w):
        low = (kinds[w] - d1[min(kinds[w], 3)]) / t + spread / (v + 1)
        return (pairs[a, w] - d2[min(pairs[a, w], 3)] + sum(d2[k] * ns[a][k] for k in (1, 2, 3)) * low) / total[a] if total[a] else low

    return c, n, v, p


def test_language_model_against_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op4_ngram_lm"](spark, SF_SMALL).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    train = [t for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    _, p = _brute_of_order(train, ngram_lm.ORDER)
    c = Counter(w for t in train for w in _tokens(t))
    n, v = sum(c.values()), len(c)
    assert len(got) == len(docs)
    for i, t in docs:
        w = _tokens(t)
        after = [b"\0begin"] * (ngram_lm.ORDER - 1) + w
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(x in c for x in w), n)
        assert math.isclose(got[i].base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert math.isclose(got[i].score, sum(math.log10(p(g)) for g in zip(*(after[k:] for k in range(ngram_lm.ORDER)))), rel_tol=1e-9)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


@pytest.mark.parametrize("blocks", [(16 << 20, 5_000_000), (500, 300)], ids=["large", "small shards"])
def test_language_model_sums_to_one(spark, blocks):
    texts = ["the cat the dog", "The cat\tsat", None, "", "a b c the cat sat on the mat"] * 3 + ["the " * 2000]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, id int").repartition(3)
    model = ngram_lm.train(docs, F.lit(True), shard_bytes=blocks[0], flush=blocks[1])
    c, n, v, p = _brute(texts)
    assert (model.tokens, model.vocabulary) == (n, v)
    reader, hashes = ngram_lm.Reader(model), ngram_lm.WordHashes()
    words = [w for w in c if w != b"\0end"]
    h = np.concatenate([hashes(words)[0], [ngram_lm.END], hashes([b"unseen"])[0]])
    for context in [*h.tolist(), int(ngram_lm.BEGIN)]:
        got = ngram_lm.probabilities(reader, np.full(len(h), context, np.uint64), h)[0]
        assert math.isclose(got.sum(), 1, rel_tol=1e-9)
    rows = ngram_lm.score(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = _tokens(texts[r.doc_id])
        assert math.isclose(r.score, sum(math.log10(p(a, x)) for a, x in zip([b"\0begin", *w[:-1]], w)), rel_tol=1e-9)


def test_language_model_edges(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, None), (2, "x" * 100_000)], "doc_id long, text string")
    none = ngram_lm.train(docs, F.lit(False))
    assert [(r.n_known, r.base_score, r.score) for r in ngram_lm.score(docs, none).collect()] == [(0, 0, 0)] * 4
    assert ngram_lm.score(docs.limit(0), none).collect() == []


def test_long_texts_are_cut_exactly():
    text = b" ".join(b"w%d" % (k % 97) for k in range(5000))
    whole = list(ngram_lm.token_blocks(iter([(0, text)]), ngram_lm.WordHashes()))
    cut = list(ngram_lm.token_blocks(iter([(0, text)]), ngram_lm.WordHashes(), chunk=100))
    assert len(cut) > 100
    for k in (1, 2):
        assert (np.concatenate([b[k] for b in whole]) == np.concatenate([b[k] for b in cut])).all()


def _brute_of_order(train, order):
    """Probability of a word after ``order - 1`` words, by definition."""
    levels = {order: Counter()}
    for t in train:
        w = [b"\0begin"] * (order - 1) + _tokens(t)
        levels[order].update(zip(*(w[k:] for k in range(order))))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    words = {g[-1] for g in levels[order]}

    def discounts(values):
        n1, n2, n3, n4 = (sum(x == k for x in values) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0
        return [0, *(min(max(d, 0), k) for k, d in ((1, 1 - 2 * y * n2 / n1 if n1 else 0), (2, 2 - 3 * y * n3 / n2 if n2 else 0), (3, 3 - 4 * y * n4 / n3 if n3 else 0)))]

    ds, after = {k: discounts(list(c.values())) for k, c in levels.items()}, defaultdict(list)
    for c in levels.values():
        for g, n in c.items():
            after[g[:-1]].append(n)

    def p(g):
        if not g:
            return 1 / (len(words) + 1)
        d, ns = ds[len(g)], after.get(g[:-1], [])
        if not ns:
            return p(g[1:])
        c = levels[len(g)][g]
        return (c - d[min(c, 3)] + sum(d[min(n, 3)] for n in ns) * p(g[1:])) / sum(ns)

    return words, p


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("blocks", [(16 << 20, 5_000_000), (500, 300)], ids=["large", "small shards"])
def test_language_model_of_higher_order(spark, order, blocks):
    texts = ["the cat the dog", "The cat\tsat", None, "", "a b c the cat sat on the mat"] * 3 + ["the " * 500, "b c the cat the cat sat", "c the dog sat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = ngram_lm.train(docs, F.lit(True), shard_bytes=blocks[0], flush=blocks[1], order=order)
    words, p = _brute_of_order(texts, order)
    new = [(100, "cat sat on the dog unseen cat"), (101, "mat")]
    scored = docs.union(spark.createDataFrame(new, docs.schema))
    for r in ngram_lm.score(scored, model).collect():
        w = [b"\0begin"] * (order - 1) + _tokens(dict([*enumerate(texts), *new])[r.doc_id])
        assert math.isclose(r.score, sum(math.log10(p(g)) for g in zip(*(w[k:] for k in range(order)))), rel_tol=1e-9)
    assert (model.order, model.vocabulary) == (order, len(words))


def test_registered_model_sees_two_words_of_context(spark):
    got = {r.doc_id: r.score for r in QUERIES["op4_ngram_lm"](spark, SF_SMALL).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    _, p = _brute_of_order([t for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2], 3)
    for i, t in docs[:20]:
        w = [b"\0begin"] * 2 + _tokens(t)
        assert math.isclose(got[i], sum(math.log10(p(g)) for g in zip(w, w[1:], w[2:])), rel_tol=1e-9)


def test_long_texts_are_cut_exactly_with_more_context():
    text = b" ".join(b"w%d" % (k % 97) for k in range(5000))
    whole = list(ngram_lm.token_blocks(iter([(0, text)]), ngram_lm.WordHashes(), order=4))
    cut = list(ngram_lm.token_blocks(iter([(0, text)]), ngram_lm.WordHashes(), chunk=100, order=4))
    assert len(cut) > 100
    for k in (1, 2):
        assert (np.concatenate([b[k] for b in whole], axis=-1) == np.concatenate([b[k] for b in cut], axis=-1)).all()


def test_pair_counts_beyond_32_bits(tmpdir_path):
    context, word = np.array([5], np.uint64), np.array([7, 8], np.uint64)
    blob = ngram_lm._pack(context, np.array([2], np.uint32), word, np.array([0, 1], np.uint32), np.array([3_000_000_000, 4], np.uint32))
    rows = ngram_lm._rows([(0, blob)] * 2)
    list(ngram_lm._pairs(tmpdir_path, 1)(iter([rows])))
    reader = ngram_lm.Reader(ngram_lm.Model(tmpdir_path, 1, np.zeros(0, np.uint64), (np.zeros(4),), np.zeros(4), (0, 0, 0), 0, 0, 0))
    assert reader.pairs(np.array([5, 5, 5], np.uint64), np.array([7, 8, 9], np.uint64)).tolist() == [6_000_000_000, 8, 0]


def test_model_takes_little_disk(spark):
    rnd = np.random.default_rng(1)
    numbers = np.minimum(rnd.zipf(1.2, (300, 400)), 50_000)
    docs = spark.createDataFrame([(k, " ".join(f"w{x}" for x in row)) for k, row in enumerate(numbers)], "doc_id long, text string")
    model = ngram_lm.train(docs, F.lit(True), shard_bytes=1 << 19, order=3)
    whole = set()
    for row in numbers.tolist():
        whole.update(zip([-1, -1, *row], [-1, *row, -2], [*row, -2]))
    files = [f"{model.folder}/{name}" for name in os.listdir(model.folder)]
    assert len(files) <= 4 * model.shards  # words, their statistics, n-grams, contexts with a hot word
    assert sum(map(os.path.getsize, files)) < 12 * len(whole)  # as hash arrays, a file per level, they took 22


def test_reader_opens_each_file_once(tmpdir_path, monkeypatch):
    """A model of 6 GB has over 512 files of a kind; every block of text asks them all."""
    for k in range(600):
        ngram_lm._write(tmpdir_path, f"words-{k}", {"keys": np.array([k], np.uint64)})
    opened, real = [], ngram_lm._map
    monkeypatch.setattr(ngram_lm, "_map", lambda folder, name: opened.append(name) or real(folder, name))
    model = ngram_lm.Model(tmpdir_path, 1024, np.zeros(0, np.uint64), (np.zeros(4),) * 2, np.zeros(4), (0, 0, 0), 0, 0, 0, 3)
    reader = ngram_lm.Reader(model)
    for _ in range(2):
        assert [int(reader.file(f"words-{k}")["keys"][0]) for k in range(600)] == list(range(600))
    assert len(opened) == 600


def test_blocks_of_lookup_grow_with_the_files(tmpdir_path):
    """Texts are hashed in small blocks, but their words are looked up at once: each lookup goes to all files."""
    model = lambda shards: ngram_lm.Model(tmpdir_path, shards, np.zeros(0, np.uint64), (), np.zeros(4), (0, 0, 0), 0, 0, 0, 3)
    assert model(4).chunk < model(128).chunk < model(2048).chunk <= 8 << 20
    reader, asked = ngram_lm.Reader(model(2048)), []
    reader.ids = lambda hashes: asked.append(len(hashes)) or hashes
    texts = [b"a b c " * 200_000, b"", b"d e f " * 100_000, b"g"]
    words, n = reader.numbers()(texts)
    want, each = ngram_lm.WordHashes()(texts)
    assert len(asked) == 1 and (words == want).all() and (n == each).all()


def test_distinct_and_places_of_ngrams():
    rnd = np.random.default_rng(4)
    for high in (1, 50, 1 << 45, 1 << 62, 1 << 63):
        values = rnd.choice(rnd.integers(0, high, 300).astype(np.uint64), 2000)
        have, number, by = ngram_lm._distinct(values)
        assert (have[number] == values).all() and set(have) == set(values) and (number[by] == np.sort(number)).all()
        if high <= 1 << 45:
            assert (have == np.unique(values)).all()
    assert [len(x) for x in ngram_lm._distinct(np.zeros(0, np.uint64))] == [0, 0, 0]
    word = rnd.integers(0, 40, 500).astype(np.uint64)
    rows = np.stack([np.concatenate([np.full(k, 99, np.uint64), word[:len(word) - k]]) for k in (2, 1, 0)])
    rows[:2, 100], rows[0, 101] = 77, 77
    for n in (0, 1, 2, 500):
        have, number = ngram_lm._local(rows[:, :n])
        assert (have[number] == rows[:, :n]).all() and (have == np.unique(rows[:, :n])).all()
    values = np.concatenate([np.sort(rnd.choice(5000, size, replace=False)) for size in (1, 2, 17, 400)]).astype(np.uint16)
    ends = np.cumsum([1, 2, 17, 400])
    group = np.sort(rnd.integers(0, 4, 600))
    want = np.append(rnd.integers(0, 5001, 599).astype(np.uint64), ngram_lm.UNKNOWN)
    start, end = (np.append(0, ends[:-1]))[group], ends[group]
    place, there = ngram_lm._within(values, start, end, want)
    assert there.tolist() == [w in set(values[a:b].tolist()) for a, b, w in zip(start, end, want.tolist())]
    assert (values[place[there]] == want[there]).all() and ((place >= start) & (place < end))[there].all()


# ---- packing

def _pieces_ok(rows, docs, encode):
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for i, t in docs:
        ids = np.array([*encode(t or ""), 0], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return sequences


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs += [(1000, None), (1001, ""), (1002, "end<|endoftext|> of<|endoftext|>"), (1003, "a  b\n\n c " * 40_000), (1004, " \t\n"), (None, "null id")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, length int, rank int").repartition(5)
    rows = packing.pack(df, buckets=3).collect()
    sequences = _pieces_ok(rows, docs, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    used = sum(r.length for r in rows)
    assert sorted(sequences) == list(range(len(sequences))) and used / (1024 * len(sequences)) > 0.95
    assert packing.pack(df.limit(0)).collect() == []


def test_packing_repeated_rows(spark):
    rows = packing.pack(spark.createDataFrame([(1, "same")] * 50, "doc_id long, text string")).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 50


def test_shortest_pack_first():
    rnd = random.Random(2)
    for _ in range(30):
        histogram = {n: rnd.randrange(1, 10 ** rnd.randrange(1, 9)) for n in rnd.sample(range(1, 65), rnd.randrange(1, 60))}
        patterns = packing.shortest_pack_first(histogram, 64)
        placed = Counter()
        for count, lengths in patterns:
            assert sum(lengths) <= 64 and lengths == sorted(lengths, reverse=True)
            placed.update({n: k * count for n, k in Counter(lengths).items()})
        assert placed == histogram and len(patterns) < 300
        table = packing.slots(patterns)
        assert len(table) == sum(len(x) for _, x in patterns)


def test_blocks_do_not_change_ids():
    encoder = packing.Encoder(packing.vocabulary_path())
    rnd = random.Random(3)
    text = "".join(rnd.choice(["word", " ", "  ", "\n", "’s", "12", " é", "!?", "\t"]) for _ in range(3000))
    whole = encoder.core.encode_ordinary(text)
    at, ids = 0, []
    while at < len(text):
        cut = packing.SAFE_CUT.search(text, at + 20)
        end = cut.start() if cut else len(text)
        ids += encoder.core.encode_ordinary(text[at:end])
        at = end
    assert ids == whole


# ---- personal data

SECRET = "a2684b46e90db9d53cccf6c25cfb07c9a0ef67e6"
PRIVATE = [(1, "Mr. John Smith, john.smith@Mail.com, +1 (168) 555-5254 or 1-168-555-5254."), (2, "Smith? Mrs. Smith and Mary Jones at 10.2.3.4. JOHN.SMITH@MAIL.COM"),
           (3, f'Иван Петров token = "{SECRET}" {SECRET.upper()}'), (4, "4407620926593142 = 4407-6209-2659-3142, DE89 3704 0044 0532 0130 00"), (5, None), (6, ""),
           (None, "ip 10.2.3.4 10.2.3.4"), (7, "nothing 1.2 here 12-34"), (7, "nothing 1.2 here 12-34"), (8, "x" * 200_000 + " 10.2.3.4")]


def test_pii_surrogates(spark):
    df = spark.createDataFrame([(*r, "d", 1) for r in PRIVATE], "doc_id long, text string, digest string, put int").repartition(3)
    got = {r.doc_id: r for r in pii.replace_pii(df, "key").collect()}
    again = {r.doc_id: r for r in pii.replace_pii(df, "key").collect()}
    other = {r.doc_id: r for r in pii.replace_pii(df, "another").collect()}
    assert got == again and got[1].text != other[1].text and pii.replace_pii(df, "key").count() == len(PRIVATE)
    m = re.fullmatch(r"Mr\. ([A-Z][a-z]+n) ([A-Z][a-z]+), ([a-z]{4}\.[a-z]{5}@[a-z]{4}\.com), \+(\d) \((\d{3})\) (\d{3})-(\d{4}) or (\d)-(\d{3})-(\d{3})-(\d{4})\.", got[1].text)
    assert m and m.groups()[3:7] == m.groups()[7:]
    n = re.fullmatch(r"Smith\? Mrs\. (\w+) and (\w+a) (\w+) at ([\d.]+)\. (\S+)", got[2].text)
    assert n and n[1] == m[2] != n[3] and n[5] == m[3].upper()
    s = re.fullmatch(r'([а-яА-Я]+р) ([а-яА-Я]+) token = "([0-9a-f]{40})" ([0-9A-F]{40})', got[3].text)
    assert s and s[3].upper() == s[4] and s[3] != SECRET
    c = re.fullmatch(r"(\d{16}) = (\d{4})-(\d{4})-(\d{4})-(\d{4}), DE\d\d( \d{4}){4} \d\d", got[4].text)
    assert c and c[1] == "".join(c.groups()[1:5])
    assert (got[5].text, got[5].n_entities, got[6].text, got[7].text, got[7].kinds) == (None, 0, "", "nothing 1.2 here 12-34", "")
    assert got[None].text == f"ip {n[4]} {n[4]}" and got[8].text.endswith(" " + n[4]) and got[2].kinds == "email,given,ip,surname"
    assert pii.replace_pii(df.limit(0), "key").collect() == []


NUMBERS = ["+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 123456", "+447911123456", "+15551234567", "5551234567", "+1 555 123 4567",
           "+44 (0)20 7946 0958", "+7 (495) 123-45-67", "+380.44.123.45.67", "+49\u00a030\u00a0123456", "+(33) 1 23 45 67 89", "+86-138-0013-8000"]
ADDRESSES = ["2001:db8:85a3:0:0:8a2e:370:7334", "fe80::1", "::1", "2001:DB8::", "::ffff:192.0.2.128", "64:ff9b::192.0.2.33", "dead:beef::cafe"]
PLAIN = ["12:30:45", "std::vector", "::", "0.1234567890", "1234567890.5", "10:20", "a:b:c", "2024-01-02 2024-01-03", "key::value", "+5 to +7", "+123456"]


@pytest.mark.parametrize("text", ["call {} now", "{}", "({}), then"])
def test_pii_international_numbers_and_addresses(spark, text):
    rows = [(k, text.format(x)) for k, x in enumerate(NUMBERS + ADDRESSES + PLAIN)]
    got = {r.doc_id: r for r in pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    shape = lambda x: re.sub(r"\d", "9", x)
    for k, x in enumerate(NUMBERS + ADDRESSES + PLAIN):
        left, right = text.split("{}")
        if x in PLAIN:
            assert (got[k].text, got[k].n_entities) == (rows[k][1], 0)
            continue
        assert got[k].n_entities == 1 and got[k].kinds == ("phone" if x in NUMBERS else "ip6"), (x, got[k])
        assert got[k].text.startswith(left) and got[k].text.endswith(right) and x not in got[k].text
        new = got[k].text[len(left):len(got[k].text) - len(right)]
        assert shape(new) == shape(x) if x in NUMBERS else re.fullmatch("(?:[0-9a-f]{4}:){7}[0-9a-f]{4}", new.lower())


def test_pii_one_address_in_all_spellings(spark):
    same = ["2001:db8::1", "2001:0DB8:0:0:0:0:0:1", "2001:db8:0::0.0.0.1", "2001:0db8:0000::0001"]
    got = pii.replace_pii(spark.createDataFrame(list(enumerate(same)), "doc_id long, text string"), "key").collect()
    assert len({r.text.lower() for r in got}) == 1


def test_pii_collisions_are_drawn_again(spark):
    ips = [f"10.0.{a}.{b}" for a, b in itertools.product(range(4), range(100))]
    names = [("given m latin", f"n{k}") for k in range(300)] + [("ip", x) for x in ips]
    got = pii.surrogates(spark.createDataFrame(names, "kind string, canonical string"), "k").collect()
    assert len(got) == len(names) == len({r.new for r in got}) and not {r.new for r in got} & {x for _, x in names}


def test_pii_is_native(spark):
    plan = QUERIES["op10_pii"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_pii_leaves_no_planted_entity(spark):
    found = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    pattern = re.compile(r"[\w.]+@[\w.]+\.com|\b\d{16}\b|\b(?:\d{1,3}\.){3}\d{1,3}\b|\(\d{3}\) \d{3}-\d{4}|\b[0-9a-fA-F]{40}\b")
    before = {m for t in found for m in pattern.findall(t)}
    after = {m for r in QUERIES["op10_pii"](spark, SF_SMALL).collect() for m in pattern.findall(r.text)}
    other = {m for m in before if re.fullmatch(r"\d{16}", m) and not _luhn(m)}  # no card: it stays
    assert before - other and len(after) == len(before) and before & after == other
    assert all(_luhn(m) for m in after - other if re.fullmatch(r"\d{16}", m))


def _luhn(number):
    ds = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(ds)) % 10 == 0


def _iban(x):
    x = x.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_pii_check_digits(spark):
    rnd = random.Random(3)
    cards = ["4111111111111111", "5555-5555-5555-4444", "3782 8224 6310 0052", "6011000990139424", "4222222222222"]
    cards += [c for c in ("".join(rnd.choices("0123456789", k=n)) for n in range(13, 20) for _ in range(60)) if _luhn(c)]
    ibans = ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "FR1420041010050500013M02606", "NL91 ABNA 0417 1643 00"]
    wrong = ["4111111111111112", "1234567890123456", "DE88 3704 0044 0532 0130 00", "GB29NWBK60161331926818"]
    texts = [*(c for c in cards if _luhn(c)), *ibans, *wrong]
    got = {r.doc_id: r for r in pii.replace_pii(spark.createDataFrame([(k, f"see {x}, then") for k, x in enumerate(texts)], "doc_id long, text string"), "key").collect()}
    for k, x in enumerate(texts):
        new = got[k].text[4:-6]
        if x in wrong:
            assert (new, got[k].n_entities, got[k].kinds) == (x, 0, "")
        else:
            assert new != x and re.sub(r"\d", "9", new)[:2] == re.sub(r"\d", "9", x)[:2] and [c for c in new if c in " -"] == [c for c in x if c in " -"]
            assert (_iban(new) and new[:2] == x[:2] if x in ibans else _luhn(new)) and got[k].kinds == ("iban" if x in ibans else "card")


def test_pii_has_no_upper_limits(spark):
    """Names, local parts and secrets of any length go as a whole; a text that holds the operator's own mark stays exact."""
    word, local, secret = "S" + "c" * 60 + "hmidt", "a" * 50 + "." + "b" * 60, "0f" * 90
    texts = [f"Herr {word} came", f"Mary {word}.", f"to {local}@mail.com now", f"key {secret} end", f"{pii.MARK}a 10.2.3.4{pii.MARK} b", f"{pii.MARK}", f"..x.y@mail.com {'a.' * 50_000}"]
    got = {r.doc_id: r for r in pii.replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "key").collect()}
    assert re.fullmatch(r"Herr [A-Z][a-z]{1,12} came", got[0].text) and re.fullmatch(r"\w+ [A-Z][a-z]{1,12}\.", got[1].text)
    assert re.fullmatch(r"to [a-z]{50}\.[a-z]{60}@[a-z]{4}\.com now", got[2].text) and local not in got[2].text
    assert re.fullmatch(r"key [0-9a-f]{180} end", got[3].text) and secret not in got[3].text
    assert re.fullmatch(f"{pii.MARK}a [0-9.]+{pii.MARK} b", got[4].text) and got[4].n_entities == 1 and "10.2.3.4" not in got[4].text
    assert (got[5].text, got[5].n_entities) == (pii.MARK, 0)
    assert re.fullmatch(r"\.\.[a-z]\.[a-z]@[a-z]{4}\.com (a\.){50000}", got[6].text)
