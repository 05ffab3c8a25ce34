"""Byte spans that repeat: prefix-free parsing over all texts.

Rolling-hash triggers cut the places of a text into phrases (``phrases.py``); a
trigger depends on nearby bytes only, so repeated strings are cut alike wherever
they stand, and every window of ``length`` bytes belongs to one phrase. A phrase is
the bytes of all its windows; it overlaps its followers, so no phrase is a prefix of
another place's parse. Equal phrases are one entry of the dictionary:

1. The parse: phrases are dealt to buckets by a hash of their core (bytes that all windows of a
   phrase have after its trigger). Cores that occur once are dropped: a window that
   occurs twice has a core that does. A Bloom filter of fixed size tells them early.
2. The dictionary: what is left goes by bucket into one entry for each different phrase (once
   from each slice of texts). Entries of a name must have equal bytes; that is compared.
3. Entries that occur twice: every window in them is repeated, whatever else.
4. Entries that occur once, in a bucket with others: the orders of the dictionary's suffixes and
   of the parse's suffixes combine into corpus order (``orders.py``); windows whose neighbour
   shares ``length`` bytes are repeated.

Hashes choose buckets and name entries (two of 64 bits, with their bytes compared); which
strings are equal is told by the orders of bytes.

Hot buckets: a bucket of more than ``MEMBERS`` phrases is dealt anew by twice as much as it may
differ in: windows that begin in the nearer or farther half before the trigger share longer cores.
After eight rounds a bucket is one window; those are counted in ``SALTS`` parts. A phrase that
is a thousandth of all occurrences or more is sent to its places by broadcast (a thousand at most).

Defined results: null and empty texts, and those shorter than ``length``, have no
span; matches never cross rows; rows with equal texts are occurrences of each other
and get equal results; a text of any length is searched whole, its phrases one after
the other; an empty table gives no rows; every further column passes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.checkpoint import delete_copy, write_copy
from .bloom import bloom, maybe_in
from .common import boxed, keep, slices, table
from .decontamination import merged
from .orders import repeated_windows
from .phrases import hashes, parsed

LENGTH, REACH = 400, 256
#: Phrases of a bucket that are ordered in one task, and parts of a bucket of one window.
MEMBERS, SALTS = 4096, 64
#: Phrases that are ordered together, of several buckets.
AT_ONCE = 8192
#: The share of all occurrences from which a phrase is sent by broadcast.
OFTEN = 0.001

_FOUND = ("core long, ctx long, uid long, at int, stop int, x int, n int, times long, held long, bytes binary")
_ENTRY = "key long, lo int, hi int, ctx long, uid long, at int, x int, n int, held long, bytes binary"


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(schema))


def _cores(texts: DataFrame, length: int, reach: int) -> DataFrame:
    """core, times, a, b of every phrase, summed by slice; ``a`` and ``b``: the least and largest hash of
    the whole phrases, equal if there is one phrase."""
    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                out = []
                for t in batch.column(1).slice(a, b - a):
                    data = (t.as_py() or "").encode("utf-8", "replace")
                    at, n, anchor, core, times = parsed(data, length, reach)
                    if len(at):
                        out.append((core, times, hashes(data, at, at + n + length - 1) ^ (anchor - at)))
                if not out:
                    continue
                core, times, whole = (np.concatenate(x) for x in zip(*out))
                order = np.argsort(core, kind="stable")
                core, times, whole = core[order], times[order], whole[order]
                new = np.flatnonzero(np.r_[True, core[1:] != core[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core[new]), pa.array(np.add.reduceat(times, new)),
                     pa.array(np.minimum.reduceat(whole, new)), pa.array(np.maximum.reduceat(whole, new))],
                    names=["core", "times", "a", "b"])

    return (texts.mapInArrow(run, "core long, times long, a long, b long").groupBy("core")
            .agg(F.sum("times").alias("times"), F.min("a").alias("a"), F.max("b").alias("b")).where("times > 1"))


def _found(texts: DataFrame, length: int, reach: int, known) -> DataFrame:
    """The phrases whose cores are in a broadcast filter (``_FOUND``): ``stop`` is where their windows
    end in the text; the first of a slice's equal phrases has their bytes and number (``held``)."""
    schema = _arrow(_FOUND)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                entry, out = {}, {c: [] for c in schema.names}
                for uid, t in zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a)):
                    data = (t.as_py() or "").encode("utf-8", "replace")
                    at, n, anchor, core, times = parsed(data, length, reach)
                    for i in np.flatnonzero(maybe_in(known.value, core)).tolist():
                        p, size, k = int(at[i]), int(n[i]), int(times[i])
                        x = int(anchor[i]) - p
                        name = (x, data[p:p + size + length - 1])
                        first = entry.get(name)
                        if first is None:
                            ctx = int(hashes(name[1], np.zeros(1, np.int64), np.array([len(name[1])]), 1 + x)[0])
                            entry[name] = first = (len(out["uid"]), ctx)
                            out["held"].append(k)
                            out["bytes"].append(name[1])
                        else:
                            out["held"][first[0]] += k
                            out["held"].append(None)
                            out["bytes"].append(None)
                        for c, v in (("core", int(core[i])), ("ctx", first[1]), ("uid", uid), ("at", p),
                                     ("stop", p + size * k - 1 + length), ("x", x), ("n", size), ("times", k)):
                            out[c].append(v)
                if out["uid"]:
                    yield from pa.Table.from_pydict(out, schema=schema).to_batches(max_chunksize=4096)

    return texts.mapInArrow(run, _FOUND)


def _dealt(entries: DataFrame, hot, take: bool) -> DataFrame:
    """The entries (``_ENTRY``) in hot buckets or the others; ``hot``: a broadcast filter of their keys."""
    def run(batches):
        for batch in batches:
            lo, hi = (batch.column(i).to_numpy() for i in (1, 2))
            mask = maybe_in(hot.value, batch.column(0).to_numpy()) & (lo < hi)
            yield batch.filter(pa.array(mask == take))

    return entries.mapInArrow(run, _ENTRY)


def _halved(entries: DataFrame, length: int) -> DataFrame:
    """Each entry twice: for the windows of the nearer and of the farther half, under their longer cores."""
    def run(batches):
        for batch in batches:
            rows = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names[:-1])}
            middle = (rows["lo"] + rows["hi"]) // 2
            for lo, hi in ((rows["lo"], middle), (middle + 1, rows["hi"])):
                i = np.flatnonzero((rows["x"] >= lo) & (rows["x"] - rows["n"] < hi))
                data = batch.column("bytes").take(pa.array(i)).to_pylist()
                x, a, b = rows["x"][i], lo[i], hi[i]
                key = [int(hashes(d, np.array([p - u]), np.array([p + length - v]), 1 + u * 4096 + v)[0])
                       for d, p, u, v in zip(data, x.tolist(), a.tolist(), b.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                     *[batch.column(c).take(pa.array(i)) for c in ("ctx", "uid", "at", "x", "n", "held", "bytes")]],
                    names=batch.schema.names)

    return entries.mapInArrow(run, _ENTRY)


def _members(t: pa.Table) -> pa.Table:
    """Sorted entries with those of a name in one row; their bytes must be equal."""
    key, ctx = t["key"].to_numpy(), t["ctx"].to_numpy()
    if len(key) < 2:
        return t
    same = (key[1:] == key[:-1]) & (ctx[1:] == ctx[:-1])
    if not same.any():
        return t
    i = pa.array(np.flatnonzero(same))
    data = t["bytes"].combine_chunks()
    if not pc.all(pc.equal(data.take(i), data.take(pc.add(i, 1)))).as_py():
        raise RuntimeError("two phrases have one name of 128 bits; other seeds of the hashes are needed")
    new = np.flatnonzero(np.r_[True, ~same])
    held = np.add.reduceat(t["held"].to_numpy(), new)
    t = t.take(pa.array(new))
    return t.set_column(t.schema.get_field_index("held"), "held", pa.array(held))


def _ordered(entries: DataFrame, length: int) -> DataFrame:
    """uid, begin, stop: spans of the repeated windows in entries that occur once."""
    def spans(t):
        t = _members(t)
        key = t["key"].to_numpy()
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        t = t.filter(pa.array(np.repeat(np.diff(np.r_[new, len(key)]) > 1, np.diff(np.r_[new, len(key)]))))
        ranges = t["lo"].to_numpy() * 65536 + t["hi"].to_numpy()
        for r in np.unique(ranges).tolist():
            part = t.filter(pa.array(ranges == r))
            key = part["key"].to_numpy()
            group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
            cuts = [0, *np.searchsorted(group, group[AT_ONCE::AT_ONCE], "left").tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b > a:
                    s = part.slice(a, b - a)
                    x, n, count = (s[c].to_numpy().astype(np.int64) for c in ("x", "n", "held"))
                    row, first, stop = repeated_windows(group[a:b], s["bytes"].to_pylist(), x, n, count,
                                                        r // 65536, r % 65536, length)
                    at = s["at"].to_numpy()[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s["uid"].to_numpy()[row]), pa.array((at + first).astype(np.int32)),
                         pa.array((at + stop - 1 + length).astype(np.int32))], names=["uid", "begin", "stop"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            at = int(np.searchsorted(t["key"].to_numpy(), t["key"][-1].as_py(), "left"))
            if at:
                yield from spans(t.slice(0, at).combine_chunks())
            held = _members(t.slice(at).combine_chunks())
        if held is not None:
            yield from spans(held)

    return (entries.repartition("key").sortWithinPartitions("key", "ctx")
            .mapInArrow(run, "uid long, begin int, stop int"))


def _single(entries: DataFrame, length: int) -> DataFrame:
    """uid, begin, stop: entries of one window that occur elsewhere too.

    A window is known to repeat if its part has two; the first of each part meet those of other parts."""
    place = F.expr("at + x - lo").alias("begin")
    w = entries.select(F.expr(f"substring(bytes, x - lo + 1, {length})").alias("window"), "uid", place, "ctx",
                       F.pmod("ctx", F.lit(SALTS)).alias("salt"))
    part = Window.partitionBy("window", "salt")
    w = (w.withColumn("c", F.count("*").over(part))
         .withColumn("r", F.row_number().over(part.orderBy("ctx", "uid", "begin"))))
    others = (w.where("r = 1").withColumn("g", F.count("*").over(Window.partitionBy("window")))
              .where("c = 1 and g > 1"))
    stop = (F.col("begin") + length).cast("int").alias("stop")
    return w.where("c > 1").select("uid", "begin", stop).unionByName(others.select("uid", "begin", stop))


def _hot(keys: DataFrame):
    """A broadcast filter of a column ``key``, and whether it holds any."""
    made = bloom(keys, "key")
    return keys.sparkSession.sparkContext.broadcast(made), bool(made.any())


def repeated(texts: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """uid, spans (array of (begin, stop), overlapping) of the texts (uid, text) with repeated windows."""
    spark = texts.sparkSession
    cores = keep(_cores(texts, length, reach))
    known = spark.sparkContext.broadcast(bloom(cores, "core"))
    hot, any_hot = _hot(cores.where((F.col("times") > MEMBERS) & (F.col("a") != F.col("b"))).select(F.col("core").alias("key")))
    found, copy = write_copy(_found(texts, length, reach, known))
    entries = found.where("bytes is not null").select(
        F.col("core").alias("key"), F.lit(0).alias("lo"), F.lit(reach - 1).alias("hi"), "ctx", "uid", "at", "x", "n",
        "held", "bytes")
    singles, wide = [], [_dealt(entries, hot, False) if any_hot else entries]
    while any_hot:
        entries = keep(_halved(_dealt(entries, hot, True), length))
        singles.append(entries.where("lo = hi"))
        entries = entries.where("lo < hi")
        hot, any_hot = _hot(entries.select("key", "ctx").distinct().groupBy("key").count().where(F.col("count") > MEMBERS))
        wide.append(_dealt(entries, hot, False) if any_hot else entries)
    once = _ordered(_union(wide), length)
    if singles:
        once = once.unionByName(_single(_union(singles), length))
    # phrases that stand twice or more are repeated at all their places
    classes = keep(found.groupBy("core", "ctx").agg(F.sum("times").alias("n")).where("n > 1"))
    total = found.agg(F.sum("times")).first()[0] or 0
    often = F.col("n") >= OFTEN * total  # at most 1 / OFTEN of them
    places = found.select("core", "ctx", "uid", F.col("at").alias("begin"), "stop")
    frequent = F.broadcast(classes.where(often).select("core", "ctx"))
    both = (places.join(frequent, ["core", "ctx"], "left_semi")
            .unionByName(places.join(frequent, ["core", "ctx"], "left_anti")
                         .join(classes.where(~often).select("core", "ctx"), ["core", "ctx"], "left_semi")))
    out = keep(both.select("uid", "begin", "stop").unionByName(once)
               .groupBy("uid").agg(F.collect_list(F.struct("begin", "stop")).alias("spans")))
    delete_copy(spark, copy)
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def removed(docs: DataFrame, text: str = "text", length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_bytes`` long, ``spans``
    array<struct<begin int, end int>> (disjoint byte ranges that repeated windows
    cover, in order) and ``kept`` binary (the other bytes).

    ``reach`` is a power of two, ``length`` at least that plus 7. Rows get numbers in a checkpoint, so
    that copies are rows of their own; texts without repeats don't leave their task, the
    others meet their spans in one shuffle by number."""
    spark = docs.sparkSession
    held = keep(boxed(docs, F.monotonically_increasing_id().alias("uid")))
    found = repeated(held.select("uid", F.col("row").getField(text).alias("text")), length, reach)
    hit = spark.sparkContext.broadcast(bloom(found.select(F.xxhash64("uid").alias("key")), "key"))

    @F.pandas_udf("boolean")
    def may_repeat(k: pd.Series) -> pd.Series:
        return pd.Series(maybe_in(hit.value, k.to_numpy()))

    flagged = held.withColumn("hit", may_repeat(F.xxhash64("uid")))
    plain = flagged.where("not hit").select("row", F.lit(None).cast("array<struct<begin:int,stop:int>>").alias("spans"))
    met = flagged.where("hit").join(found, "uid", "left").select("row", "spans")
    return _cut(plain.unionByName(met), docs.columns.index(text))


def _cut(df: DataFrame, text: int) -> DataFrame:
    """``row`` with ``n_bytes``, ``spans`` and ``kept``."""
    out = T.StructType([df.schema["row"], *T._parse_datatype_string(
        "n_bytes long, spans array<struct<begin:int,end:int>>, kept binary").fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            rows = batch.column(0)
            for a, b in slices(rows.field(text)):
                size, found, kept = [], [], []
                for t, spans in zip(rows.field(text).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist()):
                    data = (t or "").encode("utf-8", "replace")
                    spans = merged([(s["begin"], s["stop"]) for s in spans or ()])
                    edges = [0, *(x for s in spans for x in s), len(data)]
                    size.append(len(data))
                    found.append([{"begin": x, "end": y} for x, y in spans])
                    kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(a, b - a).cast(arrow.field(0).type), pa.array(size, pa.int64()),
                     pa.array(found, arrow.field(2).type), pa.array(kept, pa.binary())], schema=arrow)

    return df.mapInArrow(run, out)


def query(spark, sf_dir):
    """Contract digest over all documents."""
    out = removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["begin"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
