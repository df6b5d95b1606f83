"""Operators 1, 2 and 8: URL filters, exact dedup, benchmark decontamination."""

import hashlib
import random
import re

import pytest
from conftest import SF_SMALL
from oracle_harness import compare
from pyspark.sql import functions as F

from labelsmith.llm import chat_format, common, decontaminate, exact_dedup, url_filter
from labelsmith.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    got = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert "error" not in got, got
    assert got["spark_rows"] > 0


# ---- URL filters

URLS = [None, "", "no-scheme.com/en/", "http://Example.COM/en/x", "https://www.example.com/en/?q#f", "http://a.net/es/1", "http://net/fr/",
        "http://notnet/fr/x", "http://x.net/de/", "ftp://example.com", "http://example.com?u=/en/", "http://example.com#/en/", "http://sub.www.example.com/en/a",
        "http://example.com:80/en/", "http://spam-farm.example.org/x", "http://a.org/ads/1", "http://a.org/bads/1", "x://y://z.com/", "http://é.com/en/\nb"]


def _judge(url):
    rest = re.match(r"[^?#]*", url.split("://", 1)[1], re.S)[0] if url and "://" in url else ""
    host, path = rest.split("/", 1)[0].translate(LOWER), rest[len(rest.split("/", 1)[0]):]
    fits = [r for r in url_filter.RULES for h, p in [(r.text.split("/", 1)[0], "/" + r.text.split("/", 1)[1])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    blocked = re.match(r"([^/]*\.)?spam-farm\.[^/]*/", host + path) or any(path.startswith(p) for p in ("/ads/", "/wp-login.php", "/cgi-bin/"))
    return host, path, best and best.text, best.action if best else "block" if blocked else "allow"


def test_urls_against_brute_force(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, URLS[3], "h", "r"), (3, URLS[3], "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = sorted((tuple(r) for r in url_filter.url_filter(pages).collect()), key=str)
    assert got == sorted(((i, *_judge(u)) for i, u, *_ in rows), key=str)
    assert url_filter.url_filter(pages.limit(0)).collect() == []


def test_url_rules_wild_and_many(spark):
    rules = [url_filter.Rule("block", f"host{k}.test/dir*/x{k}/") for k in range(300)] + [url_filter.Rule("block", "*/*tail"), url_filter.Rule("allow", "whole.test")]
    urls = ["http://host7.test/dirs/x7/y", "http://host7.test/dir/x8/", "http://whole.test", "http://a.whole.test/z", "http://q.test/a-tail", "http://host299.test/dir/x299/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.url_filter(pages, tuple(rules), ()).collect()}
    assert got == {0: (rules[7].text, "block"), 1: (None, "allow"), 2: ("whole.test", "allow"), 3: ("whole.test", "allow"),
                   4: ("*/*tail", "block"), 5: (rules[299].text, "block")}
    with pytest.raises(ValueError):
        url_filter.url_filter(pages, tuple(rules) * 400, ())


def test_url_filter_is_native(spark):
    plan = QUERIES["op1_url_filter"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ---- exact dedup

DOCS = [(1, "Same Text"), (2, "same text"), (3, "same TEXT"), (4, "É"), (5, "é"), (6, None), (7, ""), (None, "lone"), (None, "LONE"), (8, "lone!"),
        (9, "x" * 300_000), (10, "X" * 300_000), (11, "again"), (11, "again")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(exact_dedup.sha256(c), 1, 1)], ids=["sha256", "one digit"])
def test_exact_dedup(spark, digest):
    docs = spark.createDataFrame([(*r, "d", True) for r in DOCS], "doc_id long, text string, digest string, kept boolean").repartition(3)
    groups = {}
    for i, t in DOCS:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    want = []
    for i, t in DOCS:
        norm = (t or "").translate(LOWER)
        keep = max((x for x in groups[norm] if x is not None), default=None)
        want.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    got = exact_dedup.exact_dedup(docs, digest=digest)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert exact_dedup.exact_dedup(docs.limit(0)).collect() == []
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "").lower()[:9]) for r in kept.collect()) == [
        (0, "lone"), (3, "same text"), (4, "é"), (5, "é"), (7, ""), (8, "lone!"), (10, "x" * 9), (11, "again")]


def test_exact_stage_keeps_one_row_of_each_text(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 1, 2, 3, 4, 5]), rnd.choice(["a", "A", "b", "c d", "C D", "", None, "e"]), rnd.choice("xy")) for _ in range(200)]
    rows += [(None, "only null ids", "x"), (None, "ONLY null ids", "y"), (5, "dup", "x"), (5, "dup", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(5)
    kept = [tuple(r) for r in exact_dedup.keep_one(docs).collect()]
    best = {}
    for i, t, _ in rows:
        norm = (t or "").translate(LOWER)
        best[norm] = max((x for x in (best.get(norm), i) if x is not None), default=None)
    assert {(t or "").translate(LOWER): i for i, t, _ in kept} == best and len(kept) == len(best) and set(kept) <= set(rows)
    assert exact_dedup.keep_one(docs.limit(0)).collect() == []


# ---- benchmark decontamination

def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def _contaminated(docs, items, size):
    out = []
    wins = {}
    for item, t in items:
        w = _words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + size]), set()).add("null" if item is None else str(item))
    for i, t in docs:
        w, hit, found = _words(t), set(), set()
        for m in {len(x) for x in wins}:
            for s in range(len(w) - m + 1):
                if tuple(w[s:s + m]) in wins:
                    hit |= set(range(s, s + m))
                    found |= wins[tuple(w[s:s + m])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 40], ids=["one block", "many blocks"])
def test_contamination_against_brute_force(spark, block):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice(["a", "B", "c3", "É", "d-e"]) for _ in range(n))
    items = [(k, text(rnd.choice([0, 1, 3, 4, 6, 9]))) for k in range(12)] + [(None, "Zeta; eta"), (3, None), (3, "c3 c3 c3 c3 c3")]
    docs = [(k, text(rnd.randrange(40))) for k in range(40)] + [(None, "zeta ETA"), (7, None), (7, ""), (8, text(30_000))]
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, hits int").repartition(3)
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, row int")
    got = decontaminate.contamination(df, bench, size=4, block_bytes=block)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(_contaminated(docs, items, 4), key=str)
    kept = decontaminate.keep_clean(df, bench, size=4, block_bytes=block)
    assert kept.columns == df.columns
    clean = [(i, t) for (i, t), r in zip(docs, _contaminated(docs, items, 4)) if not r[-1]]
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=str) == sorted(clean, key=str)
    assert decontaminate.contamination(df.limit(0), bench).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(df, bench.limit(0)).collect()} == {0}
    clash = df.withColumn("row", F.lit("own")).withColumn("__row", F.lit(1))
    assert decontaminate.keep_clean(clash, bench, size=4, block_bytes=block).columns == clash.columns


def test_repeated_items_are_one(spark):
    bench = spark.createDataFrame([(1, "a b c d"), (2, "e f")], "item_id long, text string")
    many = bench.crossJoin(spark.range(500)).drop("id")
    assert [len(items) for _, items in decontaminate._blocks(many, "item_id", "text", 100)] == [2]


def test_blocks_are_landed_one_by_one(spark, monkeypatch):
    assert decontaminate.BLOCK_BYTES <= 2 << 20
    docs = spark.createDataFrame([(k, f"a{k % 7} b{k % 5} c d") for k in range(40)], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(k, f"a{k} b{k} c") for k in range(7)], "item_id long, text string")
    names, real = [], decontaminate.landed
    for module in (decontaminate, common):
        monkeypatch.setattr(module, "landed", lambda df, name: names.append(name) or real(df, name))
    got, kept = (f(docs, bench, size=3, block_bytes=20) for f in (decontaminate.contamination, decontaminate.keep_clean))
    n = names.count("contamination-block")
    assert n > 1 and names == ["contamination-rows", *["contamination-block"] * n, "clean-rows", *["clean-hits"] * n]
    for df in (got, kept):
        assert "MapInArrow" not in df._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect())) == sorted(_contaminated([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()], 3))


def test_shift_tables_skip(spark):
    w = decontaminate.WuManber([tuple(b"abcdefghij"[k:k + 1] for k in range(10))])
    looked = []
    real = w.key
    w.key = lambda words, end: looked.append(end) or real(words, end)
    assert list(w.search([b"x"] * 900)) == []
    assert len(looked) <= 101


# ---- chat formatting

def test_chat_parts_round_trip(spark):
    text = lambda t: {"kind": "text", "text": t}
    turns = [(1, 0, "user", [text("see <image 0 9> \\l"), {"kind": "image", "uri": "s3://a", "width": 57, "height": 28}, text("</turn>"), {"kind": "video", "uri": "v"}]),
             (1, 1, "assistant", [text("ok "), {"kind": "audio", "uri": "b", "seconds": 1.01}, text("<bye>\\")]),
             (1, 2, "tool>\n", [{"kind": "document", "uri": None, "pages": 3}]), (1, 3, "assistant", []), (2, None, None, None), (None, 0, "user", [text(None)])]
    rows = [(c, t, r, [tuple(p.get(k) for k in ("kind", "text", "uri", "width", "height", "seconds", "pages")) for p in ps] if ps is not None else None) for c, t, r, ps in turns]
    df = spark.createDataFrame([(*r, 0) for r in rows], f"conv_id long, turn long, role string, parts array<{chat_format.PART}>, at int")
    got = [r for r in chat_format.format_chat(df).collect() if r.conv_id == 1]
    whole = "".join(r.piece for r in got)
    assert [r.at for r in got] == [whole.index(r.piece, r.at) for r in got]
    assert [(a.number, a.kind, a.tokens) for r in got for a in r.attachments] == [(0, "image", 3), (1, "other", 1), (2, "audio", 26), (3, "document", 3072)]
    for r in got:
        assert all(whole[a.at:].startswith(f"<{a.kind} {a.number} {a.tokens}>") for a in r.attachments)
    assert [chat_format.unescape(whole[s.start:s.end]) for r in got for s in r.loss] == ["ok ", "<bye>\\"]
    read = [chat_format.read_turn(r.piece) for r in got]
    assert read[0] == ("user", [("text", "see <image 0 9> \\l"), ("image", "0"), ("text", "</turn>"), ("other", "1")])
    assert [x[0] for x in read] == ["user", "assistant", "tool>\n", "assistant"]
    back = {r.conv_id: r for r in chat_format.digests(chat_format.format_chat(df)).collect()}
    assert back[1].loss_chars == len("ok <bye>\\") and back[1].formatted_chars == len(whole) and back[1].n_turns == 4
    assert back[2].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest() and back[None].n_turns == 1
    assert chat_format.format_chat(df.limit(0)).collect() == [] == chat_format.digests(chat_format.format_chat(df.limit(0))).collect()


def test_chat_ties_and_repeats(spark):
    rows = [(5, 0, "user", "b", 1), (5, 0, "user", "a", 1), (5, 0, "user", "a", 1), (5, 0, "assistant", None, 1), (5, 1, "assistant", "z" * 200_000, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int").repartition(4)
    got = chat_format.digests(chat_format.format_chat(chat_format.text_parts(df))).collect()
    want = "assistant\n\nuser\na\nuser\na\nuser\nb\nassistant\n" + "z" * 200_000 + "\n"
    assert [(r.n_turns, r.turns_sha256, r.loss_chars) for r in got] == [(5, hashlib.sha256(want.encode()).hexdigest(), 200_000)]
