"""Collocations: phrases that occur more often than their parts let expect, by stripes.

A stripe is a prefix (a phrase of 0 to 4 words of one language) with an associative
counter of the words that follow it. Tasks build stripes from slices of texts, Spark brings the
stripes of a prefix together, and they are merged elementwise. One merged stripe gives
its extensions (phrases that are one word longer, each with its count, which is the total of
that longer prefix's stripe), and the largest of them, which tells whether the prefix is
subsumed by a longer phrase. The empty prefix's stripe gives the words and their number.

Phrases grow by a word at each of five levels. A phrase that occurs ``least`` times has
only parts that do, so a level counts only where both shorter phrases may be frequent,
which a Bloom filter of fixed size tells; counts are exact whatever it lets through.

Stripes travel in bundles, by a hash of the prefix: ``BUNDLES`` for each shuffle partition of the
session. Skew: a slice counts before it sends, and the stripe of a prefix that stands at ``HOT`` of
all words or more is dealt to ``SHARDS`` bundles by the next word's hash, so neither a word
that a third of all phrases begin with nor the empty prefix meets in one task. There are at
most 1 / ``HOT`` such prefixes at each level, whatever the input. The counts of one-word
parts, which many phrases ask for, stand in ``COPIES`` copies.

Defined results: null and empty texts have no words; a null language is ``und``; repeated
rows count each time; a text of any length is counted whole; phrases don't cross
pieces; ties between cuts go to the smallest; an empty table gives no rows; further
columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bloom import WORDS, bloom, maybe_in
from .common import keep, slices, table
from .words import byte_kinds, mixed, word_hashes, words_of

#: Words of the longest phrase, occurrences of the rarest one, rows of a language.
LONGEST, LEAST, TOP = 5, 100, 2000
KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
#: The share of all words at which a prefix's stripe is dealt to several bundles, and these (the empty prefix: all).
HOT, SHARDS = 0.002, 32
#: Bundles of stripes for each shuffle partition.
BUNDLES = 2
#: Copies of the count of a one-word part.
COPIES = 32
#: Text that is counted at once.
CHARS = 8 << 20

#: ``prefixes``: one a line; ``next``: its words, one stripe a line; ``n``: the words' counts.
_STRIPES = "bundle int, lang string, prefixes string, next string, n array<int>"
_ENTRY = "lang string, prefix string, next string, n long, most long, h long"


def _name(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _longer(hashes, words):
    """Hashes of phrases from those of their prefixes and last words."""
    return mixed(hashes * np.uint64(3) + words)


def _counted(texts: pa.Array, langs: pa.Array, size: int, known: np.ndarray,
             hot: np.ndarray, bundles: int) -> pa.RecordBatch | None:
    """The stripes of ``size`` - 1 words' prefixes in some texts, in bundles."""
    w = words_of(texts, KINDS)
    count = len(w.codes)
    if not count:
        return None
    coded = langs.fill_null("und").dictionary_encode()
    names, per_doc = coded.dictionary, coded.indices.to_numpy()
    vocabulary, word_h = len(w.known) + 1, word_hashes(w.known)
    gram = per_doc[w.doc].astype(np.int64)  # the phrase at each place, numbered within this slice
    hashes = np.array([_name(x) for x in names.to_pylist()], np.uint64)
    live = np.ones(count, bool)  # where that phrase may be frequent
    place, langs_of = None, np.arange(len(names))
    for m in range(1, size):
        live = live & (w.left >= m) & (np.r_[live[1:], False] if m > 1 else True)
        at = np.flatnonzero(live)
        key, place, number = np.unique(gram[at] * vocabulary + w.codes[at + m - 1], return_index=True, return_inverse=True)
        place = at[place]
        hashes = _longer(hashes[key // vocabulary], word_h[key % vocabulary])
        langs_of = langs_of[key // vocabulary]
        gram = np.full(count, -1, np.int64)
        gram[at] = number
        live = np.zeros(count, bool)
        live[at] = maybe_in(known, hashes.view(np.int64))[number]
    longer = live & (w.left >= size)
    if size > 1:
        longer &= np.r_[live[1:], False]
    at = np.flatnonzero(longer)
    if not len(at):
        return None
    key, n = np.unique(gram[at] * vocabulary + w.codes[at + size - 1], return_counts=True)
    prefix, follows = key // vocabulary, key % vocabulary
    shard = (word_h[follows] >> np.uint64(40)) % np.uint64(1 << 20)
    if size > 1:
        shard = np.where(np.isin(hashes, hot)[prefix], shard % np.uint64(SHARDS), np.uint64(0))
    bundle = (mixed(hashes[prefix] + shard) % np.uint64(bundles)).astype(np.int64)
    lang = langs_of[prefix]
    order = np.lexsort((prefix, lang, bundle))
    prefix, follows, n, bundle, lang = prefix[order], follows[order], n[order], bundle[order], lang[order]
    row = np.flatnonzero(np.r_[True, (bundle[1:] != bundle[:-1]) | (lang[1:] != lang[:-1])])
    new = np.r_[True, prefix[1:] != prefix[:-1]]
    new[row] = True
    stripe = np.flatnonzero(new)
    lines = pa.array(np.r_[np.searchsorted(stripe, row), len(stripe)].astype(np.int32))
    if size == 1:
        text = pa.array([""] * len(stripe))
    else:
        text = pc.binary_join_element_wise(
            *[w.known.take(pa.array(w.codes[place[prefix[stripe]] + i])) for i in range(size - 1)], b" ").cast(pa.string())
    words = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[stripe, len(prefix)].astype(np.int32)),
                                                    w.known.take(pa.array(follows)).cast(pa.string())), " ")
    return pa.RecordBatch.from_arrays(
        [pa.array(bundle[row].astype(np.int32)), names.take(pa.array(lang[row])),
         pc.binary_join(pa.ListArray.from_arrays(lines, text), "\n"),
         pc.binary_join(pa.ListArray.from_arrays(lines, words), "\n"),
         pa.ListArray.from_arrays(pa.array(np.r_[row, len(prefix)].astype(np.int32)), pa.array(n.astype(np.int32)))],
        names=["bundle", "lang", "prefixes", "next", "n"])


def _hashed(langs: pa.Array, phrases: pa.Array) -> pa.Array:
    """The hashes that ``_counted`` gives phrases."""
    w = words_of(phrases, KINDS)
    coded = langs.dictionary_encode()
    h = np.array([_name(x) for x in coded.dictionary.to_pylist()], np.uint64)[coded.indices.to_numpy()]
    own, begin = word_hashes(w.known)[w.codes], np.searchsorted(w.doc, np.arange(len(phrases)))
    size = np.diff(np.r_[begin, len(w.doc)])
    for i in range(int(size.max(initial=0))):
        more = size > i
        h[more] = _longer(h[more], own[begin[more] + i])
    return pa.array(h.view(np.int64))


def _merged(least: int):
    """Bundles, sorted by their keys, to the entries of the merged stripes: extensions of at least
    ``least`` occurrences, and one without a word: the sum and the largest of a stripe."""
    keys = ["bundle", "lang"]

    def entries(batch):
        prefixes, lines = pc.split_pattern(batch["prefixes"], "\n"), pc.split_pattern(batch["next"], "\n")
        words = pc.split_pattern(pc.list_flatten(lines), " ")
        stripe, row = pc.list_parent_indices(words), pc.list_parent_indices(batch["n"])
        return pa.table({k: batch[k].take(row) for k in keys}
                        | {"prefix": pc.list_flatten(prefixes).take(stripe), "next": pc.list_flatten(words),
                           "n": pc.list_flatten(batch["n"]).cast(pa.int64())})

    def out(t):
        stripe = t.group_by([*keys, "prefix"]).aggregate([("n", "sum"), ("n", "max")])
        big = t.filter(pc.greater_equal(t["n"], least))
        phrase = pc.binary_join_element_wise(big["prefix"], big["next"], " ").combine_chunks()
        for cols in ((stripe["lang"], stripe["prefix"], pa.nulls(stripe.num_rows, pa.string()), stripe["n_sum"],
                      stripe["n_max"], pa.nulls(stripe.num_rows, pa.int64())),
                     (big["lang"], big["prefix"], big["next"], big["n"], pa.nulls(big.num_rows, pa.int64()),
                      _hashed(big["lang"].combine_chunks(), phrase))):
            yield pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in cols],
                                             names=["lang", "prefix", "next", "n", "most", "h"])

    def run(batches):
        held = None  # the counters of the last bundle so far
        for batch in batches:
            if not batch.num_rows:
                continue
            t = entries(batch)
            t = pa.concat_tables([held, t]) if held is not None else t
            t = t.group_by([*keys, "prefix", "next"]).aggregate([("n", "sum")]).select([*keys, "prefix", "next", "n_sum"])
            t = t.rename_columns([*keys, "prefix", "next", "n"])
            same = pc.and_(*[pc.equal(t[k], batch[k][-1]) for k in keys])
            held, done = t.filter(same), t.filter(pc.invert(same))
            if done.num_rows:
                yield from out(done)
        if held is not None:
            yield from out(held)

    return run


def stripes(docs: DataFrame, size: int, known, hot, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """The merged stripes of prefixes of ``size`` - 1 words as entries (``_ENTRY``);
    ``known``: a broadcast filter of the shorter phrases that may be frequent; ``hot``: the hashes of hot prefixes."""
    slim = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))

    def build(batches):
        for batch in batches:
            for a, b in slices(batch.column(0), CHARS):
                got = _counted(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), size, known.value, hot,
                               bundles)
                if got is not None:
                    yield got

    bundles = BUNDLES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (slim.mapInArrow(build, _STRIPES).repartition("bundle", "lang").sortWithinPartitions("bundle", "lang")
            .mapInArrow(_merged(least), _ENTRY))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 longest: int = LONGEST) -> DataFrame:
    """lang, phrase, a, l, r, n, score: every phrase of 2 to ``longest`` words that occurs
    ``least`` times and isn't subsumed, with the cut that explains it best."""
    spark = docs.sparkSession
    found, known, hot = None, np.zeros(WORDS, np.int64), np.zeros(0, np.uint64)
    for size in range(1, longest + 1):
        level = keep(stripes(docs, size, spark.sparkContext.broadcast(known), hot, text, lang, least))
        found = level if found is None else found.union(level)
        if size == 1:
            words = level.where("next is null").agg(F.sum("n")).first()[0] or 0
        # phrases of one length stand at no more places than there are words, so 1 / HOT of them at most
        often = level.where(F.col("next").isNotNull() & (F.col("n") >= HOT * words)).select("h").toArrow()
        hot = np.sort(often["h"].to_numpy().view(np.uint64))
        new = bloom(level.where("next is not null"), "h")
        if not new.any():
            break
        known = known | new
    entries = found.where("next is not null").select(
        "lang", F.concat_ws(" ", F.when(F.col("prefix") != "", F.col("prefix")), "next").alias("phrase"),
        F.col("n").alias("a"))
    phrases = entries.where("phrase like '% %'")
    # a longer phrase that subsumes holds one that is longer by a word and does too
    tail = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    null = F.lit(None).cast("long")
    kept = (phrases.select("lang", "phrase", "a", null.alias("most"))
            .unionByName(phrases.where("phrase like '% % %'").select(
                "lang", tail.alias("phrase"), null.alias("a"), F.col("a").alias("most")))
            .unionByName(found.where("next is null and prefix like '% %'").select(
                "lang", F.col("prefix").alias("phrase"), null.alias("a"), "most"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("most").alias("most"))
            .where("a is not null and coalesce(most, 0) < a").select("lang", "phrase", "a"))
    part = lambda a, b: F.array_join(F.slice("w", a, b), " ")
    cuts = F.flatten(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(True).alias("left"), part(F.lit(1), k).alias("part")),
        F.struct(k.alias("k"), F.lit(False).alias("left"), part(k + 1, F.size("w") - k).alias("part")))))
    single = lambda c: ~F.contains(c, F.lit(" "))
    asked = (kept.withColumn("w", F.split("phrase", " ")).select("lang", "phrase", "a", F.inline(cuts))
             .withColumn("copy", F.when(single(F.col("part")), F.pmod(F.xxhash64("phrase"), F.lit(COPIES))).otherwise(0).cast("int")))
    told = entries.select(
        "lang", F.col("phrase").alias("part"), F.col("a").alias("total"), F.explode(F.when(
            single(F.col("phrase")), F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    both = (asked.join(told, ["lang", "part", "copy"])
            .groupBy("lang", "phrase", "a").agg(F.collect_list(F.struct("k", "left", "total")).alias("parts")))
    words = found.where("next is null and prefix = ''").groupBy("lang").agg(F.sum("n").alias("n"))
    one = lambda k, left: F.filter("parts", lambda x: (x["k"] == k) & (x["left"] == left))[0]["total"]
    # 1000 * a * n and l * r pass 64 bits; 19 + 18 and 18 + 18 digits fit a decimal
    big = lambda c, p: c.cast(f"decimal({p},0)")

    def score(k):
        l, r = one(k, True), one(k, False)
        return F.struct(F.call_function("div", big(big(F.col("a"), 16) * F.lit(1000), 19) * big(F.col("n"), 18),
                                        big(l, 18) * big(r, 18)).alias("score"),
                        k.alias("k"), l.alias("l"), r.alias("r"))

    size = F.size(F.split("phrase", " "))
    best = F.array_min(F.transform(F.sequence(F.lit(1), size - 1), score))
    return (both.join(words, "lang").select("lang", "phrase", "a", "n", best.alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"))


def top(found: DataFrame, rows: int = TOP) -> DataFrame:
    """``found`` with ``rank``: the first ``rows`` of each language, by score, count and phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= rows)


def query(spark, sf_dir):
    """Contract rows over all documents."""
    found = collocations(table(spark, sf_dir, "documents").select("text", "lang"))
    return top(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The query's rows by plain counting, in DuckDB SQL.
ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, ws FROM (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces) WHERE len(ws) > 0),
n AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang),
f AS (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
    FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(ws) >= m)
  GROUP BY lang, m, phrase HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
longer AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, array_to_string(w[:m - 1], ' ') AS part, a FROM c UNION ALL
    SELECT lang, array_to_string(w[2:], ' ') AS part, a FROM c) GROUP BY lang, part),
kept AS (SELECT c.* FROM c LEFT JOIN longer ON c.lang = longer.lang AND c.phrase = longer.part
         WHERE most IS NULL OR most < a),
cuts AS (SELECT lang, phrase, a, w, m, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cuts.k, x.f AS l, y.f AS r, n.n,
         (1000::HUGEINT * cuts.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[:k], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[k + 1:], ' ') JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
WHERE rank <= 2000
"""
