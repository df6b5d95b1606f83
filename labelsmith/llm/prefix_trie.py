"""Conversation prefix trie by the Euler-tour technique (operator 13)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, landed

#: Turns whose prefix sums are made at once, and arcs likewise.
CHUNK, BUCKET = 4096, 1 << 16
#: Arcs contracted at once: those of nodes of so many ids in a row and so many depths in a row.
NEAR_IDS, NEAR_DEPTHS = 256, 1024
#: Bits of ids whose list is joined at once.
END_BITS = 16

LOCAL = (1 << 33) - 1  # a partition's part of a number by monotonically_increasing_id


def _sorted(df: DataFrame, name: str, *order) -> DataFrame:
    """``df`` written in global order; ``key`` grows with it, and ``part`` is the file's number."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("key", F.monotonically_increasing_id())
    return landed(out, name).withColumn("part", F.shiftright("key", 33))


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, i, a, b, size``: each turn's number from 1, 120 bits of its digest, and its text's bytes.

    Ordered by turn, null first; turns of one number by their digest; a null role or text is empty.
    Rows without a conversation are left out. Texts go no further than their digest. The numbers come from a
    global sort: a conversation may span any number of tasks, and the pieces of it add up in order.
    """
    raw = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")
    digest = F.sha2(F.concat(F.octet_length(raw(role_col)).cast("string").cast("binary"), F.lit(":").cast("binary"), raw(role_col), raw(text_col)), 256)
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(raw(text_col)).cast("long").alias("size"))
    bits = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = rows.select("conv", "turn", bits(1).alias("a"), bits(16).alias("b"), "size", F.xxhash64(F.monotonically_increasing_id()).alias("spread"))
    kept = _sorted(rows, "turns", "conv", F.col("turn").asc_nulls_first(), "a", "b", "spread")
    pieces = kept.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("key").alias("first"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return kept.join(pieces, ["conv", "part"]).select("conv", (F.col("before") + F.col("key") - F.col("first") + 1).alias("i"), "a", "b", "size")


def _prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv, pos, a, b, size, ...``) with 128 bits ``z1, z2`` of their prefix, and ``p1, p2`` of the prefix before.

    A prefix is the exclusive or over its turns' hashes, which hold the position, so pieces of a long
    conversation are made apart and joined. Prefixes are equal where both numbers are.
    """
    hashed = turns.select("*", F.xxhash64("a", "b", "pos").alias("h1"), F.xxhash64("pos", "b", F.lit(1), "a").alias("h2"), F.expr(f"pos div {CHUNK}").alias("chunk"))
    here = Window.partitionBy("conv", "chunk").orderBy("pos")
    inside = hashed.select("*", F.bit_xor("h1").over(here).alias("x1"), F.bit_xor("h2").over(here).alias("x2"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = hashed.groupBy("conv", "chunk").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    before = chunks.select("conv", "chunk", F.bit_xor("h1").over(earlier).alias("y1"), F.bit_xor("h2").over(earlier).alias("y2")).where("y1 is not null")
    z = lambda k: F.col(f"x{k}").bitwiseXOR(F.coalesce(F.col(f"y{k}"), F.lit(0)))
    return (inside.join(before, ["conv", "chunk"], "left").withColumns({"z1": z(1), "z2": z(2)})
            .withColumns({"p1": F.col("z1").bitwiseXOR(F.col("h1")), "p2": F.col("z2").bitwiseXOR(F.col("h2"))})
            .drop("x1", "x2", "y1", "y2", "h1", "h2", "chunk", "a", "b"))


def _ends(ending: DataFrame) -> DataFrame:
    """``z1, z2, ends_sha256`` of ``z1, z2, conv``: digest of the ids in order, joined by commas.

    Lists of at most 2^16 ids in a row are made and joined by many tasks; only the digest itself, which
    is sequential, takes a node's lists one after another in one task, without holding them.
    """
    lists = (ending.groupBy("z1", "z2", F.shiftright("conv", END_BITS).alias("bucket"))
             .agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
                                              ["z1", "z2", "ends_sha256"])

        for batch in batches:
            for z1, z2, ids in zip(*(batch.column(c).to_pylist() for c in ("z1", "z2", "ids"))):
                if (z1, z2) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (z1, z2), hashlib.sha256(ids.encode())
            yield batch_of(out)
            out = []
        if now is not None:
            yield batch_of([(*now, digest.hexdigest())])

    return lists.repartition("z1", "z2").sortWithinPartitions("z1", "z2", "bucket").mapInArrow(run, "z1 long, z2 long, ends_sha256 string")


def _linked(nodes: DataFrame) -> DataFrame:
    """Nodes in order of parent and id, with the number ``next`` of the next sibling.

    The next row may lie in the next file, so each file also gets the first row of the one after it.
    """
    row = F.struct("p1", "p2", F.col("key").alias("next"))
    follows = F.lead(row).over(Window.partitionBy("part").orderBy("key"))
    firsts = nodes.groupBy("part").agg(F.min_by(row, "key").alias("first"))
    after = firsts.select("part", F.lead("first").over(Window.orderBy("part")).alias("after"))  # a row per file
    near = nodes.withColumn("follows", follows).join(after, "part").withColumn("follows", F.coalesce("follows", "after"))
    same = (F.col("follows.p1") == F.col("p1")) & (F.col("follows.p2") == F.col("p2"))
    return near.withColumn("next", F.when(same, F.col("follows.next"))).drop("follows", "after")


def _contract(arcs: pa.Table) -> pa.Table:
    """``arc, head, at, length, beyond``: chains among the given arcs, each named by its first arc.

    ``at``: the arc's place in its chain; on the first arc also the chain's ``length`` and the arc
    ``beyond`` its last (null at the end of the tour).
    """
    arc, follow = arcs.column("arc").to_numpy(), arcs.column("follow").fill_null(-1).to_numpy()
    order = np.argsort(arc)
    arc, follow = arc[order], follow[order]
    n = len(arc)
    to = np.minimum(np.searchsorted(arc, follow), n - 1)
    inside = arc[to] == follow
    head, at = np.arange(n), np.zeros(n, np.int64)
    head[to[inside]], at[to[inside]] = np.flatnonzero(inside), 1
    while True:  # jump to the predecessor's predecessor until all point to a first arc
        nearer = at[head]
        if not nearer.any():
            break
        head, at = head[head], at + nearer
    last = np.flatnonzero(~inside)
    length, beyond = np.zeros(n, np.int64), np.full(n, -1)
    length[head[last]], beyond[head[last]] = at[last] + 1, follow[last]
    first = at == 0
    return pa.table({"arc": arc, "head": arc[head], "at": at, "length": pa.array(length, mask=~first), "beyond": pa.array(beyond, mask=~first | (beyond < 0))})


def _ranked(arcs: DataFrame) -> DataFrame:
    """``arc, place`` along the tour for ``arc, follow, ids, depths`` (where its node lies).

    Arcs of nodes that lie close together are chained within a task first; the chains, a small share
    of the arcs where ids follow the tree, are ranked by pointer jumping: in each round every chain
    adds the distance of the chain it points to, and points where that one does.
    """
    local = landed(arcs.groupBy("ids", "depths").applyInArrow(_contract, "arc long, head long, at long, length long, beyond long"), "arcs")
    chains = local.where("length is not null").select("head", F.col("beyond").alias("to"), F.col("length").alias("left"))
    chains = landed(chains, "chains")
    while not chains.where("to is not null").isEmpty():
        ahead = chains.select(F.col("head").alias("to"), F.col("to").alias("far"), F.col("left").alias("more"))
        moving = chains.where("to is not null").join(ahead, "to").select("head", F.col("far").alias("to"), (F.col("left") + F.col("more")).alias("left"))
        chains = landed(moving.unionByName(chains.where("to is null")), "chains")
    total = chains.agg(F.max("left")).first()[0]
    left = chains.select("head", "left")
    return local.join(left, "head").select("arc", (F.lit(total) - F.col("left") + F.col("at")).alias("place"))


def _subtrees(nodes: DataFrame) -> DataFrame:
    """``key, n_leaves, saved_tokens`` of ``key, parent, next, child, conv, depth, weight``."""
    enter, leave = F.col("key") * 2, F.col("key") * 2 + 1
    down = F.coalesce(F.col("child") * 2, leave)
    on = F.coalesce(F.col("next") * 2, F.col("parent") * 2 + 1)
    arcs = nodes.select(F.expr(f"floor(conv / {NEAR_IDS})").alias("ids"), F.expr(f"depth div {NEAR_DEPTHS}").alias("depths"),
                        F.inline(F.array(F.struct(enter.alias("arc"), down.alias("follow")), F.struct(leave.alias("arc"), on.alias("follow")))))
    places = _ranked(arcs)
    own = nodes.select(enter.alias("arc"), F.col("child").isNull().cast("long").alias("leaf"), "weight")
    tour = places.join(own, "arc", "left").select("arc", "place", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("weight", F.lit(0)).alias("weight"),
                                                  F.expr(f"place div {BUCKET}").alias("bucket"))
    tour = landed(tour, "tour")
    sums = tour.groupBy("bucket").agg(F.sum("leaf").alias("leaf"), F.sum("weight").alias("weight"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per 65,536 arcs
    offsets = sums.select("bucket", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}s") for c in ("leaf", "weight")])
    here = Window.partitionBy("bucket").orderBy("place")
    upto = tour.select("*", *[F.sum(c).over(here).alias(f"{c}_sum") for c in ("leaf", "weight")]).join(offsets, "bucket")
    out = F.col("arc") % 2 == 1
    spent = lambda c: F.sum(F.when(out, F.col(f"{c}s") + F.col(f"{c}_sum")).otherwise(F.col(c) - F.col(f"{c}s") - F.col(f"{c}_sum")))
    return upto.groupBy(F.shiftright("arc", 1).alias("key")).agg(spent("leaf").alias("n_leaves"), spent("weight").alias("saved_tokens"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per distinct sequence of first turns, from the root, all numbers long.

    ``turns``: ``conv, pos`` (from 1, without gaps), ``a, b`` (the turn's digest), ``size`` (bytes of its
    text), ``length`` (turns of the conversation); ``convs``: ``conv, length`` (may be 0), a row per conversation. Result: ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes in the subtree, its top included), ``saved_tokens`` (over the subtree,
    each node's members but one times the bytes of its last text), ``ends_sha256`` (of the ids of members
    that end at the node, ascending, joined by commas).

    Every node gets an enter and an exit arc; the arcs of the tour are list-ranked, and a subtree's
    leaves and savings are differences of the prefix sums at its exit and enter arcs. Without
    conversations there is no node. Nodes are told apart by 128 bits.
    """
    made = landed(_prefixes(turns), "prefixes")
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("pos"), zero.alias("size"), "length", zero.alias("z1"), zero.alias("z2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    members = made.unionByName(root)
    nodes = members.groupBy("z1", "z2").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("pos").alias("depth"),
                                            F.max("size").alias("size"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = _linked(_sorted(nodes, "nodes", "p1", "p2", "conv"))
    of = nodes.select(F.col("z1").alias("p1"), F.col("z2").alias("p2"), F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    children = nodes.groupBy("p1", "p2").agg(F.min("key").alias("child"), F.count("*").alias("n_children")).select(F.col("p1").alias("z1"), F.col("p2").alias("z2"), "child", "n_children")
    ends = _ends(members.where("pos = length").select("z1", "z2", "conv"))
    whole = landed(nodes.join(of, ["p1", "p2"], "left").join(children, ["z1", "z2"], "left").join(ends, ["z1", "z2"], "left")
                   .withColumn("weight", (F.col("n_convs") - 1) * F.col("size")).drop("part", "p1", "p2", "z1", "z2", "size"), "trie")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return whole.join(_subtrees(whole), "key").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"))


def with_shared_heads(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations rebuilt from ``ordered_turns``.

    A conversation c begins with the first h turns of conversation c - c % ``every`` (all if it has
    fewer, none if there is none), then come its own turns after its first h; h is the crc32 of c in
    decimals modulo ``most``.
    """
    base = lambda c: c - c % every
    h: Column = (F.crc32(F.col("conv").cast("string")) % most).alias("h")
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    convs = sizes.select("conv", "n", h, base(F.col("conv")).alias("base")).join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
    lead = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = landed(convs.select("conv", "base", "h", lead.alias("lead"), (lead + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    own = turns.join(convs.drop("base"), "conv").where("i > h").select("conv", (F.col("i") - F.col("h") + F.col("lead")).alias("pos"), "a", "b", "size", "length")
    heads = turns.where((F.col("conv") % every == 0) & (F.col("i") < most)).withColumnRenamed("conv", "base")
    begun = heads.join(convs, "base").where("i <= h").select("conv", F.col("i").alias("pos"), "a", "b", "size", "length")
    return own.unionByName(begun), convs.select("conv", "length")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = landed(ordered_turns(documents(spark, sf_dir, "conversations")), "ordered-turns")
    return prefix_trie(*with_shared_heads(turns))


OP13_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
             xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                 lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                     lambda r, bit: xor(r // 2, (r % 2) * 3988292384))), 4294967295) % 9 AS h
      FROM t GROUP BY conv_id),
k AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS lead FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT k.conv_id, t.i - k.h + k.lead AS pos, t.role, t.text FROM t JOIN k USING (conv_id) WHERE t.i > k.h
      UNION ALL SELECT k.conv_id, t.i, t.role, t.text FROM t JOIN k ON t.conv_id = k.base WHERE t.i <= k.h),
p AS (SELECT conv_id, pos, octet_length(encode(text)) AS size,
             sha256(string_agg(concat(length(role), ':', role, length(text), ':', text), '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos)) AS node
      FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT node, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM p GROUP BY node, pos),
up AS (SELECT n.node, n.depth, q.node AS top, q.pos AS top_depth FROM n JOIN p q ON q.conv_id = n.conv_id AND q.pos <= n.depth),
par AS (SELECT up.node, up.top AS parent, a.conv_id AS parent_conv_id FROM up JOIN n a ON a.node = up.top WHERE up.top_depth = up.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM par GROUP BY parent),
sub AS (SELECT up.top AS node, sum(CASE WHEN kids.node IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
        FROM up JOIN n ON n.node = up.node LEFT JOIN kids ON kids.node = up.node GROUP BY up.top),
last AS (SELECT conv_id, max(pos) AS pos FROM p GROUP BY conv_id),
ends AS (SELECT p.node, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids FROM p JOIN last USING (conv_id, pos) GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, par.parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children,
       CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM n LEFT JOIN par ON par.node = n.node LEFT JOIN kids ON kids.node = n.node JOIN sub ON sub.node = n.node LEFT JOIN ends ON ends.node = n.node
"""
