"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 8)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed, landed

#: Bytes of words: digits, a-z and all of non-ASCII; A-Z is lower-cased, the rest separates.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Most bytes of benchmark text that one search holds in a task; its tables take some 80 times as much.
BLOCK_BYTES = 2 << 20


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(WORD_BYTES).split()


class WuManber:
    """Finds word windows of one length ``m`` in a word sequence.

    ``shift`` says for a block of words how far the search may move on: the distance of the block's
    last place in any window from that window's end. A block that ends a window has no shift; its
    bucket lists the windows to compare.
    """

    def __init__(self, windows: list[tuple[bytes, ...]]):
        self.m = len(windows[0])
        self.block = min(2, self.m)
        self.default = self.m - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for w in windows:
            for end in range(self.block, self.m + 1):
                key = self.key(w, end)
                self.shift[key] = min(self.shift.get(key, self.default), self.m - end)
            self.buckets[self.key(w, self.m)].append(w)

    def key(self, words, end: int):
        return words[end - 1] if self.block == 1 else (words[end - 2], words[end - 1])

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, window) of each occurrence."""
        end, n, m, shift, default, buckets, key = self.m, len(words), self.m, self.shift, self.default, self.buckets, self.key
        while end <= n:
            k = key(words, end)
            s = shift.get(k, default)
            if s:
                end += s
                continue
            here = None
            for w in buckets[k]:
                if w[0] == words[end - m]:
                    here = here or tuple(words[end - m:end])
                    if w == here:
                        yield end - m, w
            end += 1


def item_windows(items: list[tuple[str, bytes]], size: int = 10) -> dict[tuple[bytes, ...], list[str]]:
    """Window -> ids of the items that hold it; an item of fewer words, but not none, is one window."""
    found: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            found[tuple(words[i:i + size])].add(item)
    return {w: sorted(x) for w, x in found.items()}


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[int, list[tuple[str, bytes]]]]:
    """The benchmark in blocks of rows, none of many more than ``block_bytes``, each with their number.

    A block is collected when it is asked for.
    """
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).cast("binary").alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-2 * total // block_bytes) if total > block_bytes else 1
    for k in range(n):
        yield n, [(r["item"], bytes(r["text"] or b"")) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def _searches(windows) -> list[WuManber]:
    """One search per window length."""
    lengths = defaultdict(list)
    for w in windows:
        lengths[len(w)].append(w)
    return [WuManber(ws) for ws in lengths.values()]


def _search(rows: DataFrame, items: list[tuple[str, bytes]], size: int) -> DataFrame:
    """``row, id, n_words, hits, items`` of ``row, id, text``; hits: places of hit words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = item_windows(items, size)
        searches = _searches(windows)
        for batch in batches:
            out: dict[str, list] = {"n_words": [], "hits": [], "items": []}
            for text in batch.column("text"):
                words, hit, found = words_of(text.as_py()), set(), set()
                for search in searches:
                    for start, w in search.search(words):
                        hit.update(range(start, start + search.m))
                        found.update(windows[w])
                out["n_words"].append(len(words))
                out["hits"].append(sorted(hit))
                out["items"].append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["hits"], pa.list_(pa.int32())), pa.array(out["items"], pa.list_(pa.string()))],
                ["row", "id", "n_words", "hits", "items"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, id {kind}, n_words long, hits array<int>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", size: int = 10,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``.

    Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. Windows are
    ``size`` consecutive words of an item, or all of a shorter item. A document's word inside any
    occurrence is hit; ``n_items`` counts the items with an occurring window, ``items_sha256`` is
    the digest of their ids, sorted as strings and joined by commas.

    Null and empty texts have no words, in documents and items. A null item id counts as ``null``;
    repeated item rows count once. Null and repeated document ids are judged row by row; an empty
    benchmark hits nothing; an empty table gives an empty result; other columns are not read.

    A task holds the shift tables of at most about ``block_bytes`` of benchmark text. A larger
    benchmark is searched in blocks over all documents, which are written with a row key before; a block's
    result is written before the next is collected, and a document's hits are then united.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    one = None
    for n, items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        if n == 1:
            one = _search(rows, items, size)
        elif one is None:
            rows = landed(rows, "contamination-rows")
            one = landed(_search(rows, items, size), "contamination-block")
        else:
            one = one.unionByName(landed(_search(rows, items, size).where(F.size("hits") > 0), "contamination-block"))
    if n > 1:
        one = one.groupBy("row", "id").agg(
            F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.size("hits").cast("long")
    return one.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 10,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without a hit word, with their columns unchanged.

    One block of benchmark filters the documents as they pass, without a shuffle. For more the documents
    are written with a row key, and the keys of the rows that a block hits before the next is collected.
    """
    rows, row, hit = None, "", None
    for n, items in _blocks(benchmark, "item_id", "text", block_bytes):
        if n == 1:
            return _judged(docs, text_col, items, size, hit=False)
        if rows is None:
            rows, row = keyed(docs, "clean-rows")
        more = landed(_judged(rows.select(row, text_col), text_col, items, size, hit=True).select(row), "clean-hits")
        hit = more if hit is None else hit.unionByName(more)
    return rows.join(hit.distinct(), row, "left_anti").select(*docs.columns)


def _judged(docs: DataFrame, text_col: str, items: list[tuple[str, bytes]], size: int, hit: bool) -> DataFrame:
    """The rows with a hit word, or those without."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _searches(item_windows(items, size))
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary())
            keep = [any(next(s.search(words), None) for s in searches) == hit for words in (words_of(t.as_py()) for t in texts)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m)),
hit AS (SELECT DISTINCT dw.doc_id, dw.m, dw.i, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.win = bw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
       sha256(coalesce(its.items, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
