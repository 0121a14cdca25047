"""Conversation prefix trie from padded turn-id matrices over range-sorted shards.

Every distinct sequence of a conversation's first d turns is a node. Conversations are sorted by their turns'
ids, so a node's members stand together; the sort is a range partitioning with the conversation's id
as the last key, so a prefix (or a whole conversation) that a third of all share is split over as many
tasks as its size needs.

Ids and keys. A turn's id is 128 bits of a digest of its place, role and text; a node's key is its depth and the
exclusive or of its turns' ids. Conversations are cut into blocks of ``BLOCK`` turns, rows of their own that
sort by the key of what stands before them: a matrix is never wider, whatever a conversation's length.

Shards. A task works through its sorted rows in Arrow batches. Of each batch numpy makes padded id matrices, sorts
them with lexsort, marks where columns change and OR-accumulates the marks over the columns: a
node of depth d starts where anything up to column d changes. ``reduceat`` over these starts gives every
depth's aggregates, from the deepest up, so that a node's sums hold its subtree.

Recombination. A node that holds a batch's first or last row, or a block that goes on in another, may have more members or children
elsewhere. Batches emit such boundary nodes with the sums of what is final inside them, and the keys of their ancestors
within the block; there are some twice ``BLOCK`` a batch. Their parts are grouped by key, each adds its own
leaf and savings to its ancestors, and blocks that hang under others add theirs by pointer jumping over
the blocks' tops, in rounds that grow with the logarithm of the number of blocks. All other nodes
are final in their batch. The digest of a boundary node's ends runs over its batches' id lists in sorted order, one list in memory at a time.

Defined results: null role or text is empty; rows without conv_id take no part; turns with equal turn numbers (null first) go by a
digest of role and text, repeated rows stay turns of their own; conv_id % 5 has the sign of conv_id,
as in SQL; a conversation may have no turns (it ends at the root); an empty table gives no rows. Texts are read whole.
conv_id, turn, role and text are read by name, so further columns can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import skew_safe_row_number
from .common import materialise, require, table

BLOCK = 32  # turns of a row: the most columns of a matrix
RUN = 64  # blocks of a conversation whose keys are run up in one group
BASES, SHARES = 5, 9  # a conversation begins as the one whose id is the next lower multiple, for crc32 % SHARES turns

EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "hi", "lo"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id (digest of role and text) and n_bytes of every turn; set down."""
    rows = require(conversations, ["conv_id", "turn", "role", "text"]).where(F.col("conv_id").isNotNull())
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select(
        F.col("conv_id").cast("long"), "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("id").asc()]
    return materialise(skew_safe_row_number(rows, ["conv_id"], order, name="pos").drop("turn"), "trie-turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation's rebuilt turns in blocks: conv_id, block (from 0), total (its turns), seq (two longs a turn),
    sizes (bytes a turn). A conversation without turns has one empty block."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = lengths.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % BASES).alias("base"),
                           (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARES).alias("h"))
    of = lengths.where(F.col("conv_id") % BASES == 0).select(F.col("conv_id").alias("b_id"), F.col("n").alias("b_n"))
    convs = convs.join(of, F.col("base") == F.col("b_id"), "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("b_n", F.lit(0))).alias("taken"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
    convs = materialise(convs.select("*", (F.col("taken") + F.col("own")).alias("total")), "trie-convs")

    heads = turns.where((F.col("conv_id") % BASES == 0) & (F.col("pos") < SHARES)).select(F.col("conv_id").alias("b_id"), "pos", "id", "n_bytes")
    heads = convs.join(heads, (F.col("base") == F.col("b_id")) & (F.col("pos") <= F.col("h"))).select("conv_id", "pos", "total", "id", "n_bytes")
    c = convs.select(F.col("conv_id").alias("c_id"), "h", "taken", "total")
    own = turns.join(c, (F.col("conv_id") == F.col("c_id")) & (F.col("pos") > F.col("h")))
    own = own.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "total", "id", "n_bytes")
    every = heads.unionByName(own)
    half = lambda k: F.xxhash64(F.lit(k), "pos", "id")
    turn = F.struct("pos", half(0).alias("hi"), half(1).alias("lo"), "n_bytes")
    block = F.floor((F.col("pos") - 1) / BLOCK).alias("block")
    rows = every.groupBy("conv_id", block).agg(F.max("total").alias("total"), F.sort_array(F.collect_list(turn)).alias("t"))  # BLOCK turns at most
    rows = rows.select("conv_id", "block", "total", F.flatten(F.transform("t", lambda x: F.array(x["hi"], x["lo"]))).alias("seq"), F.col("t.n_bytes").alias("sizes"))
    none = convs.where("total = 0").select("conv_id", F.lit(0).cast("long").alias("block"), "total",
                                           F.array().cast("array<bigint>").alias("seq"), F.array().cast("array<bigint>").alias("sizes"))
    return rows.unionByName(none)


def _xor(k: int):
    at = F.filter("seq", lambda _, i: i % 2 == k)
    return F.aggregate(at, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def keyed(blocks: DataFrame) -> DataFrame:
    """``blocks`` with (g_hi, g_lo): the key of the turns before the block, 0 for a conversation's first.

    Running exclusive ors of a long conversation are taken in two levels, ``RUN`` blocks and runs of them.
    """
    zero = F.lit(0).cast("long")
    short = blocks.where(F.col("total") <= BLOCK).select("*", zero.alias("g_hi"), zero.alias("g_lo"))
    long = blocks.where(F.col("total") > BLOCK).select("*", _xor(0).alias("x_hi"), _xor(1).alias("x_lo"), F.floor(F.col("block") / RUN).alias("run"))
    runs = long.groupBy(F.col("conv_id").alias("r_id"), F.col("run").alias("r_run")).agg(F.bit_xor("x_hi").alias("r_hi"), F.bit_xor("x_lo").alias("r_lo"))
    before = Window.partitionBy("r_id").orderBy("r_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("r_id", "r_run", *[F.coalesce(F.bit_xor(c).over(before), zero).alias(c) for c in ("r_hi", "r_lo")])
    within = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = long.select("*", *[F.coalesce(F.bit_xor(f"x_{c}").over(within), zero).alias(f"w_{c}") for c in ("hi", "lo")])
    long = long.join(runs, (F.col("conv_id") == F.col("r_id")) & (F.col("run") == F.col("r_run")))
    long = long.select(*blocks.columns, F.col("w_hi").bitwiseXOR(F.col("r_hi")).alias("g_hi"), F.col("w_lo").bitwiseXOR(F.col("r_lo")).alias("g_lo"))
    return short.unionByName(long)


PART_SCHEMA = ("piece long, boundary boolean, depth long, hi long, lo long, conv_id long, parent_conv_id long, p_hi long, p_lo long, n_convs long, "
               "n_children long, n_leaves long, saved_tokens long, n_bytes long, ends string, path_from long, path_hi array<bigint>, path_lo array<bigint>, "
               "top_hi long, top_lo long")


def _padded(b: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Sorted rows of a batch: conv, block, g (hi, lo), lengths, more (goes on in another block), id matrices (hi, lo), sizes."""
    n = len(b)
    length = np.fromiter((len(s) for s in b["sizes"]), np.int64, n)
    width = int(length.max())
    flat = np.concatenate([np.asarray(s, np.int64) for s in b["seq"]])
    rows = np.repeat(np.arange(n), length)
    cols = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    hi, lo = (np.full((n, width), np.iinfo(np.int64).min) for _ in range(2))
    hi[rows, cols], lo[rows, cols] = flat[0::2], flat[1::2]
    sizes = np.zeros((n, width), np.int64)
    sizes[rows, cols] = np.concatenate([np.asarray(s, np.int64) for s in b["sizes"]])
    conv, block, g_hi, g_lo = (b[c].to_numpy(np.int64) for c in ("conv_id", "block", "g_hi", "g_lo"))
    more = (block + 1) * BLOCK < b["total"].to_numpy(np.int64)
    order = np.lexsort([conv, *[m[:, c] for c in range(width - 1, -1, -1) for m in (lo, hi)], g_lo, g_hi, block])
    return tuple(x[order] for x in (conv, block, g_hi, g_lo, length, more, hi, lo, sizes))


def piece_nodes(b: pd.DataFrame, piece: int) -> Iterator[pd.DataFrame]:
    """The nodes of a batch of sorted rows by depth: final ones, and parts of boundary ones, whose sums hold
    what is final under them and not under a deeper boundary node."""
    conv, block, g_hi, g_lo, length, more, hi, lo, sizes = _padded(b)
    n, width = hi.shape
    names = [str(c) for c in conv.tolist()]
    there = length[:, None] >= np.arange(width + 1)
    change = np.zeros((n, width + 1), bool)
    change[0, 0] = True
    change[1:, 0] = (block[1:] != block[:-1]) | (g_hi[1:] != g_hi[:-1]) | (g_lo[1:] != g_lo[:-1])
    change[1:, 1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]) | (there[1:, 1:] != there[:-1, 1:])
    new = np.logical_or.accumulate(change, axis=1)
    key_hi = np.bitwise_xor.accumulate(np.column_stack([g_hi, np.where(there[:, 1:], hi, 0)]), axis=1)
    key_lo = np.bitwise_xor.accumulate(np.column_stack([g_lo, np.where(there[:, 1:], lo, 0)]), axis=1)

    depths = []  # of every depth: rows that reach it, places of its starts among them, least member, whether at a boundary
    for d in range(width + 1):
        rows = np.flatnonzero(there[:, d])
        at = np.flatnonzero(new[rows, d])
        first, last = rows[at], rows[np.append(at[1:], len(rows)) - 1]
        edge = (first == 0) | (last == n - 1) | np.logical_or.reduceat(more[rows], at) | ((block[first] > 0) if d == 0 else False)
        # a node goes on beyond the batch only if it holds its first or last row
        depths.append((rows, at, first, np.minimum.reduceat(conv[rows], at), edge))

    leaves, saved, inner = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    for d in range(width, -1, -1):
        rows, at, first, least, edge = depths[d]
        count = np.diff(np.append(at, len(rows)))
        children = np.add.reduceat(inner[rows].astype(np.int64), at)  # inner: starts of final nodes one deeper
        size = sizes[first, d - 1] if d else np.zeros(len(first), np.int64)
        final = ~edge
        leaves[first] += final & (children == 0)
        saved[first] += np.where(final, (count - 1) * size, 0)
        inner = np.zeros(n, bool)
        inner[first] = final
        ends = np.full(len(first), "", object)
        done = rows[(length[rows] == d) & ~more[rows]]
        node = np.searchsorted(first, done, side="right") - 1
        cuts = np.flatnonzero(np.diff(node, prepend=-1))
        for i, j in zip(cuts, np.append(cuts, len(done))[1:], strict=True):
            ends[node[i]] = ",".join(names[r] for r in done[i:j].tolist())
        ends = [hashlib.sha256(e.encode()).hexdigest() if f else e or None for e, f in zip(ends, final, strict=True)]
        own = ~((block[first] > 0) & (d == 0))  # a block's top is the last node of the block above it
        up = np.searchsorted(depths[d - 1][2], first, side="right") - 1 if d else None
        parent = np.where(depths[d - 1][4][up], -1, depths[d - 1][3][up]) if d else np.full(len(first), -1)
        known = ~depths[d - 1][4][up] if d else np.zeros(len(first), bool)
        from_ = np.where(block[first] > 0, 1, 0)
        frame = pd.DataFrame({
            "piece": piece, "boundary": edge, "depth": block[first] * BLOCK + d, "hi": key_hi[first, d], "lo": key_lo[first, d],
            "conv_id": pd.array(np.where(own, least, 0), "Int64"), "parent_conv_id": pd.array(parent, "Int64"),
            "p_hi": pd.array(key_hi[first, d - 1] if d else np.zeros(len(first), np.int64), "Int64"),
            "p_lo": pd.array(key_lo[first, d - 1] if d else np.zeros(len(first), np.int64), "Int64"),
            "n_convs": np.where(own, count, 0), "n_children": children, "n_leaves": np.add.reduceat(leaves[rows], at),
            "saved_tokens": np.add.reduceat(saved[rows], at), "n_bytes": size, "ends": ends,
            "path_from": block[first] * BLOCK + from_,
            "path_hi": [key_hi[r, f:d] if e else None for r, f, e in zip(first, from_, edge, strict=True)],
            "path_lo": [key_lo[r, f:d] if e else None for r, f, e in zip(first, from_, edge, strict=True)],
            "top_hi": pd.array(g_hi[first], "Int64"), "top_lo": pd.array(g_lo[first], "Int64")})
        frame.loc[~own, "conv_id"] = pd.NA
        frame.loc[~known, "parent_conv_id"] = pd.NA
        if d == 0:
            frame[["p_hi", "p_lo"]] = pd.NA
        frame.loc[(block[first] == 0) | (d == 0) | ~edge, ["top_hi", "top_lo"]] = pd.NA
        told = rows[np.repeat(edge, count)]  # a boundary node's sums aren't its ancestors'
        leaves[told] = saved[told] = 0
        yield frame


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    task = TaskContext.get().partitionId()
    for k, batch in enumerate(batches):
        if len(batch):
            yield from piece_nodes(batch, (task << 32) + k)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each key's id lists, which come in order, joined by commas."""
    key, digest = None, hashlib.sha256()
    for batch in batches:
        out = []
        for *now, ends in batch[[*KEY, "ends"]].itertuples(index=False):
            if now == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256()
            digest.update(ends.encode())
        yield pd.DataFrame(out, columns=["e_depth", "e_hi", "e_lo", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=["e_depth", "e_hi", "e_lo", "ends_sha256"])


def _same(left: list[str], right: list[str]):
    cond = F.col(left[0]) == F.col(right[0])
    for a, b in zip(left[1:], right[1:], strict=True):
        cond = cond & (F.col(a) == F.col(b))
    return cond


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def hung(nodes: DataFrame) -> DataFrame:
    """depth, hi, lo, leaves, saved: what hangs under the top of every block that hangs under another, all further blocks with it.

    Pointer jumping: after k rounds a top holds the sums of all tops less than 2 ** k below it.
    """
    at = F.floor((F.col("depth") - 1) / BLOCK) * BLOCK  # depth of a node's block's top
    under = nodes.where("top_hi is not null").groupBy(at.alias("depth"), F.col("top_hi").alias("hi"), F.col("top_lo").alias("lo"))
    under = under.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    up = _named(nodes.select(*KEY, "top_hi", "top_lo"), "n_")
    tops = under.join(up, _same(KEY, ["n_depth", "n_hi", "n_lo"])).select(
        *KEY, "leaves", "saved", F.when(F.col("n_top_hi").isNotNull(), F.col("depth") - BLOCK).alias("u_depth"), F.col("n_top_hi").alias("u_hi"), F.col("n_top_lo").alias("u_lo"))
    tops = materialise(tops, "trie-tops")
    while tops.where("u_depth is not null").limit(1).count():
        more = tops.where("u_depth is not null").groupBy("u_depth", "u_hi", "u_lo").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        more = _named(more, "m_")
        jump = _named(tops.select(*KEY, "u_depth", "u_hi", "u_lo"), "j_")
        tops = tops.join(more, _same(KEY, ["m_u_depth", "m_u_hi", "m_u_lo"]), "left").join(
            jump, _same(["u_depth", "u_hi", "u_lo"], ["j_depth", "j_hi", "j_lo"]), "left")
        tops = materialise(tops.select(
            *KEY, *[(F.col(c) + F.coalesce(f"m_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")],
            F.col("j_u_depth").alias("u_depth"), F.col("j_u_hi").alias("u_hi"), F.col("j_u_lo").alias("u_lo")), "trie-tops")
    return tops.select(*KEY, "leaves", "saved")


def recombined(outer: DataFrame) -> DataFrame:
    """Whole boundary nodes from their parts: depth, hi, lo, conv_id, n_convs, n_children, n_leaves, saved_tokens."""
    most = lambda *cs: [F.max(c).alias(c) for c in cs]
    nodes = outer.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        *most("n_bytes", "p_hi", "p_lo", "top_hi", "top_lo"),
        F.max_by(F.struct("path_from", "path_hi", "path_lo"), F.size("path_hi")).alias("path"))
    nodes = materialise(nodes, "trie-nodes")
    kids = nodes.where("p_hi is not null").groupBy((F.col("depth") - 1).alias("k_depth"), F.col("p_hi").alias("k_hi"), F.col("p_lo").alias("k_lo"))
    kids = kids.agg(F.count(F.lit(1)).alias("kids"))
    nodes = nodes.join(kids, _same(KEY, ["k_depth", "k_hi", "k_lo"]), "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    # its own and what is final under it, by batch
    nodes = nodes.select(
        *KEY, "conv_id", "n_convs", "n_children", "top_hi", "top_lo", "path",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    nodes = materialise(nodes, "trie-nodes")
    if nodes.where("top_hi is not null").limit(1).count():
        more = _named(hung(nodes), "h_")
        nodes = nodes.join(more, _same(KEY, ["h_depth", "h_hi", "h_lo"]), "left").select(
            *[c for c in nodes.columns if c not in ("leaves", "saved")],
            *[(F.col(c) + F.coalesce(f"h_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")])
        nodes = materialise(nodes, "trie-nodes")
    steps = nodes.select("leaves", "saved", F.col("path.path_from").alias("from"), F.posexplode(F.arrays_zip("path.path_hi", "path.path_lo")).alias("step", "at"))
    below = steps.groupBy((F.col("from") + F.col("step")).alias("b_depth"), F.col("at.path_hi").alias("b_hi"), F.col("at.path_lo").alias("b_lo"))
    below = below.agg(F.sum("leaves").alias("b_leaves"), F.sum("saved").alias("b_saved"))
    whole = nodes.join(below, _same(KEY, ["b_depth", "b_hi", "b_lo"]), "left")
    return whole.select(*KEY, "conv_id", "n_convs", "n_children", (F.col("leaves") + F.coalesce("b_leaves", F.lit(0))).alias("n_leaves"),
                        (F.col("saved") + F.coalesce("b_saved", F.lit(0))).alias("saved_tokens"))


RETURNED = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the rebuilt conversations' prefix trie, one row each (``RETURNED``)."""
    rows = keyed(rebuilt(numbered_turns(conversations)))
    order = ["block", "g_hi", "g_lo", "seq", "conv_id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = materialise(rows.mapInPandas(_pieces, PART_SCHEMA), "trie-parts")
    outer = parts.where("boundary")
    nodes = materialise(recombined(outer), "trie-whole")
    ends = outer.where("ends is not null").select(*KEY, "piece", "ends")
    ends = ends.repartition(*KEY).sortWithinPartitions(*KEY, "piece").mapInPandas(_digests, "e_depth long, e_hi long, e_lo long, ends_sha256 string")
    ends = materialise(ends, "trie-ends")

    # a parent at a boundary is known by its batch: no batch looks up more than its own
    seen = _named(nodes.select(*KEY, "conv_id"), "s_")
    seen = outer.select("piece", *KEY).distinct().join(seen, _same(KEY, ["s_depth", "s_hi", "s_lo"])).select(
        F.col("piece").alias("of"), F.col("depth").alias("s_depth"), F.col("hi").alias("s_hi"), F.col("lo").alias("s_lo"), "s_conv_id")
    seen = materialise(seen, "trie-seen")
    open_ = parts.where("parent_conv_id is null and p_hi is not null")
    at = (F.col("piece") == F.col("of")) & (F.col("depth") - 1 == F.col("s_depth")) & (F.col("p_hi") == F.col("s_hi")) & (F.col("p_lo") == F.col("s_lo"))
    open_ = open_.join(seen, at).drop("parent_conv_id").withColumnRenamed("s_conv_id", "parent_conv_id")
    final = parts.where("not boundary and parent_conv_id is not null").unionByName(
        open_.where("not boundary").select(*parts.columns)).withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY)))
    # a node with no ends has the digest of nothing already: ``ends`` of final nodes are digests
    parents = open_.where("boundary").groupBy(F.col("depth").alias("q_depth"), F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo"))
    parents = parents.agg(F.min("parent_conv_id").alias("parent_conv_id"))
    whole = nodes.join(parents, _same(KEY, ["q_depth", "q_hi", "q_lo"]), "left").join(ends, _same(KEY, ["e_depth", "e_hi", "e_lo"]), "left")
    whole = whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    return final.select(*RETURNED).unionByName(whole.select(*RETURNED))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the rebuilt conversations' trie: ``RETURNED``."""
    return trie(table(spark, sf_dir, "conversations"))


ORACLE = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(turn ORDER BY pos) AS turns FROM t GROUP BY conv_id),
c AS (
  SELECT conv_id, conv_id - conv_id % {BASES} AS base, turns,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
             lambda a, b: xor(a >> 8, list_reduce(list_prepend(xor(a, b) & 255, range(8)),
                              lambda u, v: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END))), 4294967295) % {SHARES} AS h
  FROM l),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[:h], []), c.turns[h + 1:]) AS turns
  FROM c LEFT JOIN l b ON b.conv_id = c.base),
p AS (SELECT conv_id, len(turns) AS n, d AS depth, turns[:d] AS prefix FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM r) z),
g AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = depth AS leaf,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(prefix[depth].text) END AS saved
  FROM p GROUP BY depth, prefix),
s AS (
  SELECT a.depth, a.prefix, count(*) FILTER (b.depth = a.depth + 1) AS n_children, count(*) FILTER (b.leaf) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens
  FROM g a JOIN g b ON b.depth >= a.depth AND b.prefix[:a.depth] = a.prefix GROUP BY a.depth, a.prefix)
SELECT g.conv_id, CAST(g.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, g.n_convs, s.n_children, s.n_leaves, s.saved_tokens, g.ends_sha256
FROM g JOIN s ON s.depth = g.depth AND s.prefix = g.prefix LEFT JOIN g u ON u.depth = g.depth - 1 AND u.prefix = g.prefix[:g.depth - 1]
"""
