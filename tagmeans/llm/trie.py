"""Prefix trie of conversations: every shared run of first turns, with what sharing saves.

Each conversation becomes the row of its turns' 128-bit digests. Rows are sorted by
ranges over the cluster (equal rows by id, so a conversation that a third of all repeat is
split too). A shard holds a padded matrix of turn ids: numpy's lexsort orders it, masks of
columns that differ from the row before, OR-accumulated from the left, mark where nodes
begin, and reduceat sums each depth over its nodes. Matrices are ``WIDE`` columns at a
time; rows that have ended leave, so one long conversation pads no other.

A node whose rows are not all in one shard lies on the path of a shard's first or last
row. These boundary nodes come out as partial sums with a name (digest of their turns),
two paths for each shard; Spark adds them up by name. What lies in boundary nodes below
a boundary node is summed along the paths, each node on the one path that owns it.

The ends of a node are hashed in one stream, as SHA-256 asks for: shards send them as
texts of a few KB in ascending order, so a node at which a third of all conversations end
costs one task their ids (some ten bytes each) and no group in memory.

Defined results: a null conversation id names no conversation, its rows are left out; turns
are ordered by number (null first), then role, then text; repeated rows are turns of their
own; null roles and texts are empty; texts of any length stand for themselves by digest; a
conversation's digests (not its texts) must fit one row; an empty table gives no rows, not
even a root; further columns play no part. ``a % b`` has the sign of ``a``.
"""

from __future__ import annotations

import hashlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import keep, table

#: Turns that a shard holds at most on average, and at least if the session has the partitions for it.
SHARD_TURNS, LEAST_TURNS = 250_000, 4_000
#: Columns of a matrix.
WIDE = 32
#: Conversations whose ids are one text on the way to their hash.
IDS_AT_ONCE = 256
#: Copies of a boundary node for its complete children to ask.
COPIES = 16
DIGEST = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = ("kind int, depth int, key binary, parent_key binary, shard int, side int, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, cp long, ends string")
COMPLETE, BOUNDARY, ENDS = 0, 1, 2


def paths(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns (array of (digest in hex, code points of the text) in order)."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    return (df.where(F.col(conv).isNotNull())
            .select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                    F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("pos", F.row_number().over(order))
            .select("conv_id", F.struct("pos", digest.alias("digest"), F.length("text").alias("cp")).alias("t"))
            .groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(
                t["digest"].alias("digest"), t["cp"].alias("cp"))).alias("turns")))


def rebuilt(convs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each conversation with its first h turns taken from that of the last multiple of
    ``every``; h is the CRC-32 of the id modulo ``most``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = convs.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    none = F.expr("cast(array() as array<struct<digest:string,cp:int>>)")
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _sorted(conv: np.ndarray, sizes: np.ndarray, matrix) -> np.ndarray:
    """The order of rows by their turn ids, shorter first, then by conversation."""
    n = len(conv)
    rank = np.empty(n, np.int64)
    rank[np.argsort(conv, kind="stable")] = np.arange(n)
    for c in reversed(range(0, int(sizes.max(initial=0)), WIDE)):
        rows = np.flatnonzero(sizes > c)
        m = matrix(rows, c)
        order = np.lexsort((rank[rows], *m.T[::-1]))
        rank[rows[order]] = n + np.arange(len(rows))  # longer rows after those that end before them
    return np.argsort(rank, kind="stable")


def nodes_by_depth(conv: np.ndarray, sizes: np.ndarray, turns: np.ndarray, cps: np.ndarray):
    """Conversations in trie order and, for each depth, its nodes in that order.

    ``turns`` and ``cps`` hold the rows' turn ids (from 1) and code points one row after the
    other. Returns (order, levels); a level has arrays by node: first row, n, conv_id, parent, cp, ends."""
    begin = np.r_[0, np.cumsum(sizes)]

    def padded(rows, c):
        m = np.zeros((len(rows), min(WIDE, int(sizes.max()) - c)), np.int64)
        held = np.arange(m.shape[1]) < (sizes[rows] - c)[:, None]
        m[held] = turns[(begin[rows, None] + c + np.arange(m.shape[1]))[held]]
        return m

    order = _sorted(conv, sizes, padded)
    ids, size = conv[order], sizes[order]
    levels = [{"row": np.zeros(1, np.int64), "n": np.array([len(ids)]), "conv_id": ids.min(keepdims=True),
               "parent": np.zeros(1, np.int64), "cp": np.zeros(1, np.int64), "ends": np.array([(size == 0).sum()])}]
    node = np.zeros(len(ids), np.int64)  # of each row, at the depth before
    for c in range(0, int(size.max()), WIDE):
        rows = np.flatnonzero(size > c)
        m = np.column_stack([node[rows], padded(order[rows], c)])
        begins = np.ones(m.shape, bool)
        begins[1:] = np.logical_or.accumulate(m[1:] != m[:-1], axis=1)
        for j in range(1, m.shape[1]):
            alive = size[rows] >= c + j
            r = rows[alive]
            if not len(r):
                break
            first = np.flatnonzero(begins[alive, j])
            n = np.diff(np.r_[first, len(r)])
            levels.append({"row": r[first], "n": n, "conv_id": np.minimum.reduceat(ids[r], first),
                           "parent": node[r[first]], "cp": cps[begin[order[r[first]]] + c + j - 1],
                           "ends": np.add.reduceat((size[r] == c + j).astype(np.int64), first)})
            node[r] = np.repeat(np.arange(len(first)), n)
    return order, levels


def _summed(levels, first: int, last: int) -> None:
    """Adds children, leaves, saved and ``open`` (a boundary node) to the levels; a boundary node's sums
    hold its complete children and what lies below them or below boundary nodes in it."""
    below = None
    for d in reversed(range(len(levels))):
        x = levels[d]
        n = len(x["n"])
        x["open"] = np.zeros(n, bool)
        x["open"][:1] |= d <= first
        x["open"][-1:] |= d <= last
        x["children"], x["leaves"], x["saved"] = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        if below is not None:
            np.add.at(x["children"], below["parent"], (~below["open"]).astype(np.int64))
            at = np.flatnonzero(np.r_[True, below["parent"][1:] != below["parent"][:-1]])
            x["leaves"][below["parent"][at]] = np.add.reduceat(below["leaves"], at)
            x["saved"][below["parent"][at]] = np.add.reduceat(below["saved"], at)
        own = ~x["open"]
        x["leaves"] += own & (x["children"] == 0)
        x["saved"] += own * (x["n"] - 1) * x["cp"]
        below = x


def _names(path: bytes) -> list[bytes]:
    """The name of each node on a path."""
    h = hashlib.blake2b(digest_size=DIGEST)
    out = [h.digest()]
    for i in range(0, len(path), DIGEST):
        h.update(path[i:i + DIGEST])
        out.append(h.copy().digest())
    return out


def _shard(shard: int, conv: np.ndarray, path: list[bytes], cps: np.ndarray):
    """The rows (``_NODE``, by column) of a shard's nodes."""
    sizes = np.array([len(p) // DIGEST for p in path], np.int64)
    pairs = np.frombuffer(b"".join(path), ">u8").reshape(-1, 2).astype(np.uint64)
    by = np.lexsort((pairs[:, 1], pairs[:, 0]))
    new = np.r_[True, (pairs[by][1:] != pairs[by][:-1]).any(axis=1)][:len(by)]
    turns = np.empty(len(by), np.int64)
    turns[by] = np.cumsum(new)
    order, levels = nodes_by_depth(conv, sizes, turns, cps)
    first, last = path[order[0]], path[order[-1]]
    _summed(levels, len(first) // DIGEST, len(last) // DIGEST)
    names = [_names(first), _names(last)]
    ids = conv[order]
    cols = {c.split()[0]: [] for c in _NODE.split(", ")}

    def add(n, **values):
        for c, held in cols.items():
            v = values.get(c)
            held.append(v if isinstance(v, (list, np.ndarray)) else [v] * n)

    def texts(x, i):
        ended = ids[x["row"][i]:x["row"][i] + x["ends"][i]]  # those that end here come first
        return [",".join(map(str, ended[a:a + IDS_AT_ONCE].tolist())) for a in range(0, len(ended), IDS_AT_ONCE)]

    for d, x in enumerate(levels):
        up = levels[d - 1] if d else None
        i = np.flatnonzero(~x["open"])
        if len(i):
            open_up = up["open"][x["parent"][i]]
            parent = x["parent"][i]
            # an open parent is the first or the last node of its depth
            key = [None if not o else names[0][d - 1] if p == 0 and d - 1 < len(names[0]) else names[1][d - 1]
                   for o, p in zip(open_up.tolist(), parent.tolist())]
            add(len(i), kind=COMPLETE, depth=d, parent_key=key, shard=shard, conv_id=x["conv_id"][i],
                parent_conv_id=[None if o else c for o, c in zip(open_up.tolist(), up["conv_id"][parent].tolist())],
                n_convs=x["n"][i], n_children=x["children"][i], n_leaves=x["leaves"][i], saved_tokens=x["saved"][i],
                ends=[hashlib.sha256(",".join(texts(x, k)).encode()).hexdigest() if x["ends"][k] else NO_ENDS
                      for k in i.tolist()])
        for side, at in ((0, 0), (1, len(x["n"]) - 1)):
            if d >= len(names[side]):
                continue
            again = side == 1 and at == 0 and d < len(names[0])  # the same node as on the first path
            sums = {c: 0 if again else int(x[k][at]) for c, k in (
                ("n_convs", "n"), ("n_children", "children"), ("n_leaves", "leaves"), ("saved_tokens", "saved"))}
            key = names[side][d]
            add(1, kind=BOUNDARY, depth=d, key=key, parent_key=names[side][d - 1] if d else None, shard=shard, side=side,
                conv_id=int(x["conv_id"][at]), cp=int(x["cp"][at]), **sums)
            if x["ends"][at] and not again:
                t = texts(x, at)
                add(len(t), kind=ENDS, depth=d, key=key, shard=shard, side=list(range(len(t))), ends=t)
    return {c: [v for part in held for v in (part.tolist() if isinstance(part, np.ndarray) else part)]
            for c, held in cols.items()}


def _shards(convs: DataFrame, shards: int) -> DataFrame:
    """The nodes of all shards (``_NODE``)."""
    schema = to_arrow_schema(T._parse_datatype_string(_NODE))

    def run(batches):
        held = [b for b in batches if b.num_rows]  # a shard's digests, some ``SHARD_TURNS`` of them
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        cps = t["cps"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        out = _shard(TaskContext.get().partitionId(), t["conv_id"].to_numpy(), t["path"].to_pylist(), cps)
        made = pa.Table.from_pydict(out, schema=schema)
        yield from made.to_batches(max_chunksize=10_000)

    return convs.repartitionByRange(shards, "path", "conv_id").mapInArrow(run, _NODE)


def _hashed(ends: DataFrame) -> DataFrame:
    """key, sha: SHA-256 of all of a node's texts of ids, streamed in order."""
    def run(batches):
        key, h = None, None
        for batch in batches:
            keys, hashes = [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if k != key:
                    if h is not None:
                        keys.append(key)
                        hashes.append(h.hexdigest())
                    key, h = k, hashlib.sha256(t.encode())
                else:
                    h.update(b"," + t.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes)], names=["key", "sha"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], names=["key", "sha"])

    return (ends.select("key", "shard", "side", "ends").repartition("key")
            .sortWithinPartitions("key", "shard", "side").mapInArrow(run, "key binary, sha string"))


def _recombined(parts: DataFrame) -> DataFrame:
    """The boundary nodes, whole: key and the result's columns."""
    each = parts.where(F.col("kind") == BOUNDARY)
    whole = each.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("cp").alias("cp"), F.min(F.struct("shard", "side")).alias("owner"))
    inner = (whole.where("parent_key is not null").groupBy(F.col("parent_key").alias("key"))
             .agg(F.count("*").alias("more")))
    whole = (whole.join(inner, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
             .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
             .withColumn("own", (F.col("n_convs") - 1) * F.col("cp")))
    # a boundary node counts on the path that owns it, for all nodes above it there
    up = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    mine = F.col("owner") == F.struct("shard", "side")
    below = (each.select("key", "shard", "side", "depth").join(whole.select("key", "owner", "leaf", "own"), "key")
             .select("key", F.sum(F.when(mine, F.col("leaf")).otherwise(0)).over(up).alias("leaf"),
                     F.sum(F.when(mine, F.col("own")).otherwise(0)).over(up).alias("own"))
             .groupBy("key").agg(F.sum("leaf").alias("more_leaves"), F.sum("own").alias("more_saved")))
    parents = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    sha = _hashed(parts.where(F.col("kind") == ENDS))
    return (whole.join(below, "key").join(parents, "parent_key", "left").join(sha, "key", "left")
            .select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
                    (F.col("saved_tokens") + F.col("more_saved")).alias("saved_tokens"),
                    F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256")))


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(convs: DataFrame, shards: int | None = None) -> DataFrame:
    """One row for each node of the trie of ``convs`` (conv_id, turns), columns ``RESULT``."""
    flat = keep(convs.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["cp"]).alias("cps")))
    if shards is None:
        turns = flat.agg(F.sum(F.size("cps") + 1)).first()[0] or 0
        at_once = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shards = max(1, ceil(turns / SHARD_TURNS), min(at_once, ceil(turns / LEAST_TURNS)))
    parts = keep(_shards(flat, shards))
    whole = keep(_recombined(parts))
    done = parts.where(F.col("kind") == COMPLETE).withColumnRenamed("ends", "ends_sha256")
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    asked = (done.where("parent_key is not null").drop("parent_conv_id")
             .withColumn("copy", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(COPIES)).cast("int"))
             .join(whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"),
                                copies.alias("copy")), ["parent_key", "copy"]))
    out = [F.col(c).cast("string" if c == "ends_sha256" else "long").alias(c) for c in RESULT]
    return (whole.select(*out).unionByName(done.where("parent_key is null").select(*out))
            .unionByName(asked.select(*out)))


def query(spark, sf_dir):
    """Contract rows over all conversations."""
    return trie(rebuilt(paths(table(spark, sf_dir, "conversations"))))


#: The query's rows from lists of turns, in DuckDB SQL.
ORACLE = """
WITH t AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h
  FROM t),
r AS (
  SELECT c.conv_id, list_concat(CASE WHEN a.turns IS NULL THEN [] ELSE a.turns[:c.h] END, c.turns[c.h + 1:]) AS turns
  FROM c LEFT JOIN t a ON a.conv_id = c.base),
p AS (
  SELECT conv_id, turns, d, turns[:d] AS path FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * coalesce(length(any_value(path[d].text)), 0) AS saved,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(turns) = d), '') AS ends
  FROM p GROUP BY path, d),
k AS (SELECT path[:d - 1] AS path, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
x AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN k USING (path, d)),
s AS (
  SELECT path[:e] AS path, e AS d, sum((children = 0)::INT) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM x) GROUP BY ALL)
SELECT x.conv_id, x.d::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n AS n_convs, x.children AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN s USING (path, d) LEFT JOIN n up ON x.d > 0 AND up.d = x.d - 1 AND up.path = x.path[:x.d - 1]
"""
