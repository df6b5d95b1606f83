"""Operators 5 and 9 and the pipeline: repeated strings, near duplicates, stages."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SF_SMALL

import corpus_pipeline
from labelsmith.llm import components, simhash, suffix_dedup
from labelsmith.llm.queries import QUERIES
from test_filters import LOWER, _contaminated

# ---- SimHash


def _fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _groups(fps, bits=2):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    fs = sorted(set(fps))
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in fs}


def _least(rows):
    fps = {(i, t): _fingerprint(t) for i, t in rows}
    root, least = _groups(fps.values()), {}
    for (i, t), f in fps.items():
        least[root[f]] = min((x for x in (least.get(root[f]), i) if x is not None), default=None)
    return [(i, f"{fps[i, t]:016x}", least[root[fps[i, t]]]) for i, t in rows]


def test_simhash_against_brute_force(spark):
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(50)}" for _ in range(600)]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    for k in range(60):
        words = list(base)
        words[rnd.randrange(600)] = "edit"
        rows.append((1000 + k, " ".join(words)))
    rows += [(5000, None), (5001, ""), (5002, "one"), (5003, "ONE"), (5004, "two words"), (None, " ".join(base)), (None, "null alone here now"), (1000, rows[-1][1]), (1000, rows[-1][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, component_id int").repartition(4)
    got = simhash.simhash_groups(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(_least(rows), key=str)
    assert simhash.simhash_groups(df.limit(0)).collect() == []


def test_fingerprint_of_long_text_in_blocks():
    text = " ".join(f"word{k % 311}" for k in range(4000)).encode()
    assert simhash.fingerprint(text) == simhash.fingerprint(text, block=50) == _fingerprint(text.decode())


@pytest.mark.parametrize("bits,crowded", [(0, 16), (1, 16), (1, 1), (2, 16), (2, 1), (2, 10_000), (3, 16), (5, 16)])
def test_links_join_all_pairs(spark, bits, crowded):
    rnd = random.Random(bits)
    fps = {rnd.getrandbits(64) for _ in range(40)}
    for center in list(fps)[:6]:
        for _ in range(60):
            fps.add(center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 5))))
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps] * 2, "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, bits, crowded).collect()]
    assert all(0 < (a ^ b).bit_count() <= bits for a, b in links)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in links:
        root[find(a)] = find(b)
    want = _groups(fps, bits)
    assert {frozenset(f for f in fps if find(f) == r) for r in map(find, fps)} == {frozenset(f for f in fps if want[f] == r) for r in want.values()}


@pytest.mark.parametrize("crowded", [16, 1])
def test_exploded_tables_are_not_broadcast(spark, crowded):
    """Spark sizes 66 probes of a fingerprint as one or two, so under its threshold they went to the driver."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.getrandbits(63),) for _ in range(300)] + [(k,) for k in range(20)], "fp long")
    plan = simhash.links(df, crowded=crowded)
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline" in final and "SortMergeJoin" in final and "BroadcastExchange" not in final


def test_stored_fingerprints_are_not_broadcast(spark):
    docs = spark.createDataFrame([(k, f"w{k % 7} x{k % 3} y") for k in range(100)], "doc_id long, text string")
    plan = simhash.simhash_groups(docs)
    assert plan.count() == 100
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastExchange(?:(?!Exchange|Aggregate|Join).)*FileScan parquet", final, re.S)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (200, 201), (-5, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{k: -5 for k in [*range(41), -5]}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- repeated strings

def _removed(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if data[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(data[s:s + length])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(data, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("args", [{}, {"crowded": 2, "chunk": 3000}], ids=["plain", "crowded"])
def test_repeats_of_the_tables(spark, args):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = suffix_dedup.remove_repeats(df, **args)
    assert sorted(map(tuple, got.collect())) == sorted(_removed([(r.doc_id, r.text) for r in df.collect()], 100))


@pytest.mark.parametrize("length,q,crowded", [(300, 32, 1 << 16), (600, 40, 3), (100, 32, 1 << 16), (20, 8, 3), (9, 9, 1 << 16), (50, 5, 1 << 16)])
def test_repeats_of_small_alphabets(spark, length, q, crowded):
    rnd = random.Random(length)
    pool = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(5, 150))) for _ in range(12)]
    rows = [(k, "".join(rnd.choice(pool) for _ in range(rnd.randrange(6)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 3000), (103, "ab" * 700), (None, pool[0] * 3), (-4, pool[1] * 2), (104, "".join(pool) * 40)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, doc int, blob int").repartition(4)
    got = suffix_dedup.remove_repeats(df, length=length, q=q, crowded=crowded, chunk=2000, shard_bytes=5000)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(_removed(rows, length), key=str)
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def _dealt(kind, batches):
    """Entries of a kind in each shard."""
    out = {}
    for row in (r for b in batches for r in b.to_pylist() if r["kind"] == kind):
        out[row["shard"]] = out.get(row["shard"], 0) + len(suffix_dedup._unpack(row["blob"])[2])
    return out


def test_hot_gram_is_dealt_over_the_shards(spark):
    rnd = random.Random(7)
    noise = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    phrase = noise(80)
    rows = [(k, noise(200) + phrase + noise(200)) for k in range(400)] + [(1000 + k, noise(150)) for k in range(10)]
    rows += [(2000 + k, rows[k][1]) for k in range(0, 400, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for args in ({"crowded": 100}, {"crowded": 100, "flush": 500}):
        got = suffix_dedup.remove_repeats(df, shard_bytes=5000, **args)
        assert sorted(map(tuple, got.collect())) == sorted(_removed(rows, 100))
    texts = df.selectExpr("doc_id AS doc", "0L AS tie", "CAST(text AS binary) AS text")
    hot = suffix_dedup.hot_grams(texts, 100, 32, 1 << 20, 100, 1_000_000)
    assert len(hot)
    batch = texts.toArrow().combine_chunks().to_batches()
    merged = [b for b in suffix_dedup._scan(16, hot, 100, 32, 1 << 20, 1_000_000)(iter(batch))]
    rows_of = {}
    for row in (r for b in merged for r in b.to_pylist() if r["kind"] == suffix_dedup.SHARD):
        gram = suffix_dedup._unpack(row["blob"])[3]
        rows_of[row["shard"]] = np.isin(gram, hot).sum()
    assert len(rows_of) == 16 and max(rows_of.values()) < sum(rows_of.values()) / 4
    first = rows[0][1].index(phrase)
    blob = suffix_dedup._pack(np.array([first - 20]), hot[:1], np.array([40], np.uint8), np.array([1], np.uint8))
    wanted = pa.RecordBatch.from_pylist([{"doc": i, "tie": 0, "text": t.encode(), "blobs": [blob]} for i, t in rows[:400]])
    windows = _dealt(suffix_dedup.WINDOW, suffix_dedup._fetch(16, 100, 16 << 20)(iter([wanted])))
    assert max(windows.values()) < sum(windows.values()) / 8


def test_windows_are_equal_by_both_hashes():
    mixed = suffix_dedup.mix(np.array([1, 2], np.uint64))
    head, tail = np.array([1, 2, 1], np.uint64), mixed[[1, 0, 1]]
    assert len(np.unique(suffix_dedup.mix(head) + tail)) == 1
    doc = np.array([10, 11, 12])
    rows = suffix_dedup._sharded(suffix_dedup.WINDOW, doc * 0, doc, doc * 0, [doc * 0, head, tail])
    out = [r for b in suffix_dedup._resolve(100, 1 << 20)(iter([suffix_dedup._batch(rows)])) for r in b.to_pylist()]
    assert [r["doc"] for r in out] == [12]
    kept, gone = suffix_dedup._firsts(np.zeros(4, np.uint64), np.arange(4), np.array([1, 1, 2, 1]), np.array([5, 6, 5, 5]))
    assert sorted(kept.tolist()) == [0, 1, 2] and gone.tolist() == [3]


def test_rows_of_documents_come_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ROWS", 10)
    doc = np.arange(95) // 3
    batches = list(suffix_dedup._run_batches(suffix_dedup.FETCH, doc, doc * 0, np.arange(95)))
    assert len(batches) == 10 and max(b.num_rows for b in batches) <= 10
    assert sorted(x for b in batches for r in b.to_pylist() for x in suffix_dedup._unpack(r["blob"])[0]) == list(range(95))


def test_lengths_that_cannot_work_are_refused(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for args in ({"length": 10, "q": 11}, {"q": 0}, {"length": 5000, "chunk": 4999}):
        with pytest.raises(ValueError):
            suffix_dedup.remove_repeats(df, **args)


def test_windows_of_any_length(spark):
    rows = [(1, "q" * 5 + "abcdefghij" * 100), (2, "z" + "abcdefghij" * 100), (3, "".join(chr(97 + k * k % 23) for k in range(1000))), (4, "".join(chr(97 + k * k % 23) for k in range(1000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for length in (288, 300, 600, 990):
        assert sorted(map(tuple, suffix_dedup.remove_repeats(df, length=length).collect())) == sorted(_removed(rows, length))


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "x" * 50 + "y" * 90), (1, "x" * 50 + "y" * 90), (2, "x" * 50 + "y" * 90)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 140)]


def test_refine_tells_windows_apart():
    data = np.frombuffer(b"abracadabra-abracadabra!" * 9, np.uint8)
    for length in (9, 16, 23, 40):
        starts = np.arange(len(data) - length)
        got = suffix_dedup.refine(data, starts, length)
        names = {}
        assert all(names.setdefault(bytes(data[s:s + length]), g) == g for s, g in zip(starts, got)) and len(set(got.tolist())) == len(names)


# ---- pipeline

def test_pipeline_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in QUERIES["op3_toxicity"](spark, SF_SMALL).collect() if r.predicted}
    left = {i: t for i, t in rows.items() if i not in toxic}
    stays = {}
    for i, t in left.items():
        stays[t.translate(LOWER)] = max(i, stays.get(t.translate(LOWER), -1))
    left = {i: left[i] for i in stays.values()}
    left = {i: left[i] for i, _, least in _least(list(left.items())) if i == least}
    left = {r[0]: left[r[0]] for r in _contaminated(list(left.items()), items, 10) if not r[-1]}
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = got.collect()
    assert {r.doc_id for r in got} == set(left) and 0 < len(left) < len(rows)
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in got:
        ids = np.array([*tokenizer.encode(left[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


def test_near_stage_keeps_one_row_of_each_group(spark):
    rows = [(9, "A b c d e f"), (9, "zz yy xx ww vv"), (3, "a b c d e f"), (None, "null ids only here"), (None, "null ids only here"), (None, "a b c d e f"), (3, "A B c d e f"),
            (None, None), (7, ""), (8, "one two three four"), (8, "one two three four"), (8, "quite another text of its own")]
    docs = spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)], "doc_id long, text string, row int, own string").repartition(3)
    kept = simhash.keep_least(docs)
    assert kept.columns == docs.columns
    kept = [tuple(r)[:2] for r in kept.collect()]
    root = _groups([_fingerprint(t) for _, t in rows])
    least = {}
    for i, t in rows:
        g = root[_fingerprint(t)]
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    assert sorted((root[_fingerprint(t)], i) for i, t in kept) == sorted(least.items()) and set(kept) <= set(rows)
    assert (9, "zz yy xx ww vv") in kept
    assert simhash.keep_least(docs.limit(0)).collect() == []


def test_stages_with_null_and_repeated_ids(spark):
    """Every stage by brute force on its own input: nulls, repeated rows and ids, empty and very long texts, clashing names."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leak = max((t for _, t in items), key=len)
    rows = [(1, "same"), (2, "SAME"), (None, "same"), (None, None), (None, ""), (3, None), (4, "x y z " * 40), (4, "other words stand here"), (4, "other words stand here"),
            (5, "so it goes " + leak), (5, "clean " * 200_000), (6, "x y z " * 41), (None, leak)]
    docs = spark.createDataFrame([(*r, "row") for r in rows], "doc_id long, text string, row string").repartition(3)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        kept = stage(spark, docs, SF_SMALL)
        assert kept.columns == docs.columns and stage(spark, docs.limit(0), SF_SMALL).collect() == []
        kept = [tuple(r)[:2] for r in kept.collect()]
        assert set(kept) <= set(rows)
        if name == "decontamination":
            assert sorted(kept, key=repr) == sorted((r for r, x in zip(rows, _contaminated(rows, items, 10)) if not x[-1]), key=repr)
            continue
        root = _groups([_fingerprint(t) for _, t in rows])
        of = (lambda t: (t or "").translate(LOWER)) if name == "exact_dedup" else (lambda t: root[_fingerprint(t)])  # noqa: B023
        pick = max if name == "exact_dedup" else min
        want = {}
        for i, t in rows:
            want[of(t)] = pick((x for x in (want.get(of(t)), i) if x is not None), default=None)
        assert sorted(((of(t), i) for i, t in kept), key=repr) == sorted(want.items(), key=repr)
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).collect()
    assert sum(r.start == 0 for r in packed) == len(rows)


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame([(1, "same", "en", "s", 4), (2, "SAME", "en", "s", 4), (3, None, None, None, None), (None, "x", "en", "s", 1), (4, "x y z " * 40, "en", "s", 4)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF_SMALL)
            assert out.columns == docs.columns and out.count() <= df.count(), name
