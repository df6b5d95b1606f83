"""Operator 12: the network against its definition, its gradients, held-out accuracy, edge cases."""

import math

import numpy as np
import pytest

from labelsmith.llm import language_id as li
from labelsmith.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TINY = li.Settings(window=12, embed=3, widths=(2, 4), filters=3, epochs=2, batch=8)


def _by_definition(net, window):
    """Log probabilities of one window, filter by filter and place by place."""
    s, w = net.settings, {k: v.astype(float) for k, v in net.weights.items()}
    e = [w["embed"][b] for b in window]
    hidden = []
    for f in range(len(s.widths) * s.filters):
        width = s.widths[f // s.filters]
        at = [sum(float(e[p + k] @ w["filter"][k * s.embed:(k + 1) * s.embed, f]) for k in range(width)) for p in range(len(window) - max(s.widths) + 1)]
        hidden.append(max(0.0, max(at) + w["bias"][f]))
    z = [sum(h * w["dense"][f, c] for f, h in enumerate(hidden)) + w["last"][c] for c in range(len(net.languages))]
    total = math.log(sum(map(math.exp, z)))
    return [x - total for x in z]


def test_network_by_definition():
    net = li.Network(["a", "b", "c"], TINY).start()
    x = np.random.default_rng(0).integers(0, 256, (9, TINY.window)).astype(np.uint8)
    assert np.allclose(net.log_probabilities(x), [_by_definition(net, row) for row in x], atol=1e-4)


def test_gradients_by_differences():
    net = li.Network(["a", "b"], TINY).start()
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    rnd = np.random.default_rng(1)
    x, y = rnd.integers(0, 256, (5, TINY.window)).astype(np.uint8), np.array([0, 1, 1, 0, 1])
    _, grads = net.gradients(x, y)
    for name, g in grads.items():
        for at in [tuple(rnd.integers(0, n) for n in g.shape) for _ in range(25)]:
            if name == "filter" and not net.seen()[at]:
                assert g[at] == 0
                continue
            was = net.weights[name][at]
            ends = []
            for step in (1e-6, -1e-6):
                net.weights[name][at] = was + step
                ends.append(net.gradients(x, y)[0])
            net.weights[name][at] = was
            assert math.isclose((ends[0] - ends[1]) / 2e-6, g[at], abs_tol=1e-6)


@pytest.mark.parametrize("n", [0, 1, 11, 12, 13, 21, 22, 100])
def test_windows_cover_the_text_once(n):
    starts, new = li.windows_of(b"x" * n, 12, 3)
    assert new.sum() == n and starts[0] == 0
    places = {p for a in starts for p in range(a, min(a + 12, n) - 3)}
    assert places == set(range(max(0, n - 3)))  # every four bytes in a row lie in some window


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op12_language_id"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_text_alone_decides_and_edges(spark):
    train = [(i, f"der die das und nicht {i} wird", "de", 1) for i in range(40)] + [(i, f"the of and with {i} which", "en", 2) for i in range(40)]
    train += [(1, None, "de", 0), (2, "", "xx", 0), (3, "12 34", "yy", 0), (4, "the and", None, 0), (None, "das wird nicht", "de", 0)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string, score int")  # a name that the result has too
    net = li.train(docs)
    assert net.languages == ["de", "en"]
    long = "the with which and of " * 60_000
    texts = [None, "", "  12 ?!", "das wird nicht", "das wird nicht", "the of and", long, "δ", "。。。"]
    rows = li.predict(spark.createDataFrame([(k if k else None, t) for k, t in enumerate(texts)], "doc_id long, text string"), net).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(texts)
    assert [got[k] for k in (None, 1, 2, 8)] == [("und", 0.0)] * 4
    assert got[4] == (got[3][0], pytest.approx(got[3][1], abs=1e-5)) and got[3][0] == "de" and got[5][0] == "en" and got[6][0] == "en" and got[7][0] in net.languages


def test_nothing_learnt(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    net = li.train(empty)
    assert li.predict(empty, net).collect() == []
    assert [tuple(r) for r in li.predict(spark.createDataFrame([(1, "words")], "doc_id long, text string"), net).collect()] == [(1, "und", 0.0)]
    one = li.train(spark.createDataFrame([(1, "words", "en")], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in li.predict(spark.createDataFrame([(1, "Wörter")], "doc_id long, text string"), one).collect()] == ["en"]
