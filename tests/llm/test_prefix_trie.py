"""Operator 13 against brute force: rebuilt conversations, nodes, tour, digests, edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelsmith.llm import prefix_trie as pt
from labelsmith.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, size int, depth string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:".encode() + role.encode() + text.encode()).hexdigest()


def _brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, _digest(role or "", text or "")[:30], role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(cs) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, cs in members.items()), key=repr)


def _run(spark, rows):
    df = spark.createDataFrame([(*r, 5, "own") for r in rows], SCHEMA)
    out = pt.prefix_trie(*pt.with_shared_heads(pt.ordered_turns(df)))
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=repr)


def _random(seed, n, deep=12):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(4 * n), n):
        rows += [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "b", "été"])) for t in range(rnd.randrange(1, deep))]
    return rows


def test_against_brute_force(spark, monkeypatch):
    for name, value in {"CHUNK": 3, "BUCKET": 7, "NEAR_IDS": 4, "NEAR_DEPTHS": 3, "END_BITS": 2}.items():
        monkeypatch.setattr(pt, name, value)
    rows = _random(1, 120)
    rows += [(7, t, "user", "long") for t in range(100, 160)]  # far deeper than the rest
    rows += [(1000 + 5 * k, 0, "user", "same") for k in range(30)]  # one text that many conversations are
    assert _run(spark, rows) == _brute(rows)


def test_nulls_ties_repeats_and_negative_ids(spark):
    rows = [(0, None, "user", "first"), (0, 3, None, "x"), (0, 3, "user", None), (0, 3, "user", None), (0, None, "user", "and this"),
            (1, 0, "user", "hi"), (1, 1, "", ""), (None, 0, "user", "nobody"), (None, None, None, None), (-3, 0, "user", "hi"), (-5, 0, "user", "hey"), (-5, 1, "user", "ho"),
            (-7, 2, "a", "b"), (6, 0, "ab", "c"), (11, 0, "a", "bc"), (16, 0, "user", "x" * 100_000), (21, 0, "user", "x" * 100_000), (15, 0, "u", "v"), (15, 1, "u", "w")]
    assert _run(spark, rows) == _brute(rows)


def test_conversation_without_turns(spark):
    """Fewer own turns than h, and nothing to begin with: a member of the root alone."""
    c = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "user", "dropped"), (c, 1, "user", "dropped too")]
    assert _run(spark, rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())] == _brute(rows)


def test_empty(spark):
    assert _run(spark, []) == [] == _run(spark, [(None, 1, "user", "x")])


@pytest.mark.parametrize("n", [1, 2, 50, 501])
def test_chains_of_arcs(n):
    """Chains cut at arcs that lie elsewhere, each with the right places, length and arc beyond."""
    rnd = random.Random(n)
    tour = rnd.sample(range(10 * n), n)
    here = sorted(set(rnd.sample(range(n), (n + 1) // 2)))
    follow = [tour[i + 1] if i + 1 < n else None for i in here]
    out = pt._contract(pa.table({"arc": pa.array([tour[i] for i in here], pa.int64()), "follow": pa.array(follow, pa.int64())})).to_pylist()
    place = {a: i for i, a in enumerate(tour)}
    assert len(out) == len(here)
    for r in out:
        first = place[r["head"]]
        assert place[r["arc"]] - first == r["at"] and all(i in here for i in range(first, place[r["arc"]] + 1)) and first - 1 not in here
        if not r["at"]:
            end = first + r["length"]
            assert end not in here and r["beyond"] == (tour[end] if end < n else None)
        else:
            assert r["length"] is None and r["beyond"] is None


def test_pointer_jumping_ranks_a_shuffled_tour(spark):
    """Every arc in a group of its own: nothing to chain, all by jumps."""
    tour = np.random.default_rng(3).permutation(37).tolist()
    rows = [(a, tour[i + 1] if i + 1 < len(tour) else None, a, 0) for i, a in enumerate(tour)]
    got = pt._ranked(spark.createDataFrame(rows, "arc long, follow long, ids long, depths long")).collect()
    assert {r.arc: r.place for r in got} == {a: i for i, a in enumerate(tour)}


def test_query_types(spark):
    got = QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {c: "bigint" for c in COLUMNS[:-1]} | {"ends_sha256": "string"}
    assert got.where(F.col("parent_conv_id").isNull()).count() == 1
