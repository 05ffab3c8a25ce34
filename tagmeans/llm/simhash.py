"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: 64 bits by majority over XXH64 of word shingles. Links: exact, all
pairs of distinct fingerprints with at most ``max_bits`` differing bits. Two
such fingerprints agree on at least two of ``max_bits + 2`` bit blocks, so each
fingerprint goes to one group for each pair of blocks; within a group, the index
sorts fingerprints by Gray rank, factors the bits that neighbours share into
upper nodes, and drops whole nodes whose differences from a query add up to more
than ``max_bits``. A group gives a spanning forest of its links only. Groups of
more than ``LEAF`` members are dealt again, by two blocks of the bits that are
still free, until they are small: with 64 bits and 2 differing ones, the third
dealing leaves at most 256 possible members.

Defined results: null and empty texts have fingerprint 0 and are linked like any
other; repeated rows have equal fingerprints, so share a component; a null id
takes part, but no component is named by it unless all of it is null; a text of any
length is fingerprinted whole; an empty table gives no rows; every further column passes through.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import add_from_text, boxed, keep, table

SHINGLE, MAX_BITS, SEED, BITS = 3, 2, 42, 64
#: Members of a group that one index holds.
LEAF = 2048
FAN = 8
#: Pairs of a query and a node that an index compares at once.
AT_ONCE = 1 << 18
ALL_ONES = np.uint64(2**64 - 1)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the whole text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = sum(np.unpackbits(h[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
               .sum(axis=0, dtype=np.int64) for i in range(0, n, 65536))
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
                     columns: list[str] | None = None) -> DataFrame:
    """``row`` (all columns of ``docs``, or ``columns``) and ``print`` (the fingerprint as a signed long)."""
    def make():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.uint64)
                              .view(np.int64).tolist()]

    return add_from_text(docs, text, "print long", make, columns)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each 64-bit pattern in the reflected Gray code."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Hierarchical index over the fingerprints of many groups at once.

    Level 0 has the fingerprints in Gray order, by group. A node of the next
    level covers up to ``FAN`` neighbours of a group: ``mask`` has the bits in
    which all of them agree and ``pattern`` those bits; bits that a node's
    parent already has are not compared again.
    """

    def __init__(self, groups: np.ndarray, prints: np.ndarray):
        self.order = np.lexsort((gray_rank(prints), groups))
        owner, low = groups[self.order], prints[self.order]
        high = low
        self.owner = owner
        self.levels: list[tuple] = []  # (pattern, mask, first child), from the bottom
        children = np.arange(len(low) + 1)
        while True:
            mask = ~(low ^ high)
            self.levels.append((low & mask, mask, children))
            new = np.r_[True, owner[1:] != owner[:-1]]
            first = np.flatnonzero(new)
            if len(first) == len(owner):
                break
            place = np.arange(len(owner)) - first[np.cumsum(new) - 1]
            begin = np.flatnonzero(place % FAN == 0)
            low = np.bitwise_and.reduceat(low, begin)
            high = np.bitwise_or.reduceat(high, begin)
            owner = owner[begin]
            children = np.r_[begin, len(place)]
        self.roots = owner

    def pairs(self, max_bits: int, most: int = AT_ONCE):
        """Index pairs (into the arrays given) of a group's members within ``max_bits`` bits.

        Depth first: at most ``most`` pairs of a query and a node are compared at once, so a group
        whose members are all alike takes no more memory than one that has strangers only."""
        prints = self.levels[0][0]
        root_of = np.searchsorted(self.roots, self.owner)
        step = max(1, most // FAN)
        for a in range(0, len(prints), step):
            q = np.arange(a, min(a + step, len(prints)))
            node = root_of[q]
            pattern, mask, _ = self.levels[-1]
            todo = [(len(self.levels) - 1, q, node, np.bitwise_count((prints[q] ^ pattern[node]) & mask[node]))]
            while todo:
                level, q, node, bits = todo.pop()
                near = bits <= max_bits
                q, node, bits = q[near], node[near], bits[near]
                if level == 0:
                    yield self.order[q], self.order[node]
                    continue
                if len(q) > step:
                    todo += [(level, q[i:i + step], node[i:i + step], bits[i:i + step])
                             for i in range(0, len(q), step)]
                    continue
                pattern, mask, _ = self.levels[level - 1]
                above, first = self.levels[level][1], self.levels[level][2]
                n = first[node + 1] - first[node]
                at = np.repeat(first[node] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                q, bits, up = np.repeat(q, n), np.repeat(bits, n), np.repeat(node, n)
                # only pairs with a member further on, each pair once
                if level == 1:
                    later = at > q
                    q, bits, up, at = q[later], bits[later], up[later], at[later]
                bits = bits + np.bitwise_count((prints[q] ^ pattern[at]) & mask[at] & ~above[up])
                todo.append((level - 1, q, at, bits))


def _forest(groups: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, least fingerprint of its component within its group) where they differ."""
    rank = np.argsort(np.argsort(prints.view(np.int64), kind="stable"), kind="stable")
    by_rank = np.argsort(rank)
    label = rank.copy()
    for x, y in GrayIndex(groups, prints).pairs(max_bits):
        while len(x):
            least = np.minimum(label[x], label[y])
            open_ = label[x] != label[y]
            if not open_.any():
                break
            x, y, least = x[open_], y[open_], least[open_]
            # hook the larger root onto the smaller one, then flatten
            top = np.maximum(label[x], label[y])
            parent = np.arange(len(prints))
            np.minimum.at(parent, top, least)
            while True:
                further = parent[parent]
                if (further == parent).all():
                    break
                parent = further
            label = parent[label]
    root = prints[by_rank[label]]
    differ = root != prints
    return prints[differ], root[differ]


def _masks(free: list[int], max_bits: int) -> list[int]:
    """For each pair of ``max_bits + 2`` blocks of the free bits, those two blocks' bits."""
    n = max_bits + 2
    blocks = [sum(1 << b for b in free[len(free) * i // n:len(free) * (i + 1) // n]) for i in range(n)]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def links(prints: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """(u, v): a spanning forest of the links between the distinct fingerprints in ``print``."""
    masks = {0: _masks(list(range(BITS)), max_bits)}
    todo = prints.select("print", F.lit(0).cast("long").alias("mask"))
    found = []
    while True:
        below = F.create_map(*[c for m, more in masks.items() for c in (
            F.lit(_signed(m)), F.array(*[F.lit(_signed(m | b)) for b in more]))])
        dealt = keep(todo.select("print", F.explode(below[F.col("mask")]).alias("mask"))
                     .withColumn("key", F.col("print").bitwiseAND(F.col("mask"))))
        masks = {m | b: _masks([i for i in range(BITS) if not (m | b) >> i & 1], max_bits)
                 for m, more in masks.items() for b in more}
        # With fewer free bits than blocks a group has a handful of members at most.
        last = min(BITS - m.bit_count() for m in masks) < max_bits + 2
        sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        sized = dealt.join(sizes, ["mask", "key"])
        small = sized if last else sized.where(F.col("n") <= leaf)
        small = small.repartition("mask", "key").sortWithinPartitions("mask", "key")
        found.append(small.select("mask", "key", "print").mapInArrow(_search(max_bits), "u long, v long"))
        if last:
            break
        todo = keep(sized.where(F.col("n") > leaf).select("print", "mask"))
        if todo.isEmpty():
            break
    return reduce(DataFrame.union, found).where("u <> v").distinct()


def _search(max_bits: int):
    """Arrow batches sorted by group to the forest of each group's links."""
    def run(batches):
        def out(tab):
            groups = np.cumsum(np.r_[True, (np.diff(tab["mask"]) != 0) | (np.diff(tab["key"]) != 0)])
            u, v = _forest(groups, tab["print"].view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
                                              names=["u", "v"])

        held = None
        for batch in batches:
            new = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "print")}
            held = new if held is None else {c: np.r_[held[c], new[c]] for c in new}
            # the last group may go on in the next batch
            open_ = (held["mask"] == held["mask"][-1]) & (held["key"] == held["key"][-1])
            if not open_.all():
                done = {c: x[~open_] for c, x in held.items()}
                held = {c: x[open_] for c, x in held.items()}
                yield out(done)
        if held is not None and len(held["key"]):
            yield out(held)

    return run


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the least node that it reaches.

    Alternating large and small stars: each round links a node's larger, then
    its smaller neighbours to the least one; every step is an aggregate and a
    join, and each round is written to the checkpoint folder.
    """
    e = keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.isEmpty():
        return e.toDF("node", "root")
    state = None
    for _ in range(most):
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        e = keep(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select("v", "v").distinct())
        state = tuple(now)
    raise RuntimeError("the components are not stable")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """``row`` (all columns of ``docs``), ``print`` long, ``root`` long (the least
    fingerprint of the component) and ``component_id`` (its least id)."""
    printed = with_fingerprint(docs, text, shingle)
    ids = keep(with_fingerprint(docs.select(doc_id, text), text, shingle, [doc_id])
               .select(F.col(f"row.`{doc_id}`").alias("id"), "print")
               .groupBy("print").agg(F.min("id").alias("id")))
    named = _named(ids, max_bits, leaf)
    return printed.join(named, "print").select("row", "print", "root", "component_id")


def _named(ids: DataFrame, max_bits: int, leaf: int) -> DataFrame:
    """(print, root, component_id) of each distinct fingerprint in ``ids`` (print, id)."""
    comp = components(links(ids, max_bits, leaf))
    rooted = keep(ids.join(comp, ids["print"] == comp["node"], "left")
                  .select("print", "id", F.coalesce("root", "print").alias("root")))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return rooted.join(least, "root").select("print", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                         leaf: int = LEAF) -> DataFrame:
    """One row of ``docs`` for each component: that with the least id, nulls last, then
    the least hash of the whole row; of fully equal rows one stays.

    What stays is decided on ids and fingerprints; texts are shuffled once, to
    meet the decisions. Equal rows become one in their task before that, so a row that
    a third of all equal costs one copy from each task.
    """
    printed = with_fingerprint(docs, text, shingle).select(
        "row", "print", F.col(f"row.`{doc_id}`").alias("id"), F.xxhash64("row").alias("hash"))
    slim = keep(printed.select("print", "id", "hash"))
    named = _named(slim.groupBy("print").agg(F.min("id").alias("id")), max_bits, leaf)
    first = (slim.join(named.select("print", "root"), "print").groupBy("root")
             .agg(F.min(F.struct(F.col("id").isNull(), "id", "hash", "print")).alias("w"))
             .select("w.print", "w.hash"))
    # the hash is of the whole row, the id included
    one = printed.groupBy("print", "hash").agg(F.first("row").alias("row"))
    return one.join(first, ["print", "hash"], "left_semi").select("row.*")


def query(spark, sf_dir):
    """Contract digest over all documents. The texts are read once and don't come back from
    the Python workers: what follows works on ids and fingerprints."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    printed = keep(with_fingerprint(docs, columns=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "print"))
    named = _named(printed.groupBy("print").agg(F.min("doc_id").alias("id")), MAX_BITS, LEAF)
    return printed.join(named, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
