"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are the alphabet. The patterns are the word windows of the benchmark's
items. For one pattern length ``m`` a shift table over blocks of ``block``
words says how far the search may jump when a block stands at its end: as far
as no pattern can end before. Where the jump is zero, the suffix block and the
prefix block pick the bucket of patterns to compare word by word.

Defined results: null and empty texts have no words and no hit; an item with
no word gives no window; repeated items and documents each count on their own
(hit items are distinct ids); a null item id takes part in the hits but is not
named; an empty benchmark hits nothing; a text of any length is searched whole; an empty
table gives no rows; every further column passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, keep

WINDOW = 13
#: Words of the benchmark in one pass' pattern table (some 100 bytes each in a
#: task). A larger benchmark is searched for in several passes.
PASS_WORDS = 200_000
#: An item's words are cut to overlapping pieces of so many windows.
PIECE = 2_000

#: Byte to its lower-case word byte or to a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split()


class WuManber:
    """Search of one length of patterns (tuples of word numbers, 0: no pattern's word)."""

    def __init__(self, patterns: dict[tuple[int, ...], int], m: int, base: int, block: int = 3):
        self.m, self.base, self.block = m, base, min(block, m)
        self.default = m - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[tuple[int, int], list[tuple[list[int], int]]] = {}
        for words, number in patterns.items():
            for end in range(self.block, m + 1):
                key = self._key(words, end - self.block)
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.buckets.setdefault((self._key(words, m - self.block), self._key(words, 0)),
                                    []).append((list(words), number))

    def _key(self, words, at: int) -> int:
        key = 0
        for w in words[at:at + self.block]:
            key = key * self.base + w
        return key

    def find(self, words: list[int]):
        """(start, pattern number) of each occurrence, by start."""
        m, block, at, n = self.m, self.block, 0, len(words)
        shift, default, key_of = self.shift, self.default, self._key
        while at + m <= n:
            suffix = key_of(words, at + m - block)
            jump = shift.get(suffix, default)
            if jump:
                at += jump
                continue
            for pattern, number in self.buckets.get((suffix, key_of(words, at)), ()):
                if words[at:at + m] == pattern:
                    yield at, number
            at += 1


class _Patterns:
    """The windows of some items, and the search for all of them."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        by_length: dict[int, dict[tuple[int, ...], int]] = {}
        self.items: list[set[str]] = []
        for item, words in items:
            ids = [self.number[w] for w in words]
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                found = by_length.setdefault(m, {})
                at = found.setdefault(tuple(ids[i:i + m]), len(self.items))
                if at == len(self.items):
                    self.items.append(set())
                if item is not None:
                    self.items[at].add(item)
        base = len(self.number) + 1
        self.searches = [WuManber(p, m, base) for m, p in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges of all occurrences, and the items of the windows found."""
        get = self.number.get
        ids = [get(w, 0) for w in words]
        spans, items = [], set()
        for search in self.searches:
            for at, number in search.find(ids):
                spans.append((at, at + search.m))
                items |= self.items[number]
        return spans, items


def merged(spans) -> list[tuple[int, int]]:
    """Sorted disjoint ranges that cover the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Words of each item as one or more space-joined pieces that share window - 1 words."""
    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(value or "")
                for i in range(0, max(1, len(words) - window + 1), PIECE):
                    part = words[i:i + PIECE + window - 1]
                    if part:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([key], pa.string()), pa.array([b" ".join(part)], pa.binary()),
                             pa.array([len(part)], pa.int32())], names=["item", "words", "n"])

    return (benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
            .mapInArrow(cut, "item string, words binary, n int"))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", window: int = WINDOW,
                   pass_words: int = PASS_WORDS) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_words`` long, ``spans``
    array<struct<begin int, end int>> (disjoint hit ranges of words, in order)
    and ``items`` array<string> (ids of the items found, sorted, distinct).

    The benchmark is dealt by hash over as many passes as its words need at
    ``pass_words`` each; only one pass' pattern table is in memory at a time,
    and between passes the documents with their hits so far are written to the
    checkpoint folder. A usual benchmark is one pass over the documents.
    """
    spark = docs.sparkSession
    pieces = keep(_pieces(benchmark, item, item_text, window))
    total = pieces.agg(F.sum("n")).first()[0] or 0
    passes = max(1, -(-total // pass_words))
    part = F.pmod(F.xxhash64("words"), F.lit(passes))
    fields = "n_words long, spans array<struct<begin:int,end:int>>, items array<string>"
    found = None
    for k in range(passes):
        known = [(r.item, bytes(r.words).split()) for r in pieces.where(part == k).toLocalIterator()]
        shared = spark.sparkContext.broadcast(known)

        def make(shared=shared):
            patterns = _Patterns(shared.value, window)

            def find(texts):
                n, spans, items = [], [], []
                for t in texts:
                    words = words_of(t)
                    s, i = patterns.hits(words)
                    n.append(len(words))
                    spans.append([{"begin": a, "end": b} for a, b in merged(s)])
                    items.append(sorted(i))
                return [n, spans, items]

            return find

        if found is None:
            found = add_from_text(docs, text, fields, make)
        else:
            more = add_from_text(keep(found).select("row", "n_words", "spans", "items",
                                                    F.col(f"row.`{text}`").alias("text")),
                                 "text", fields, make)
            old = F.col("row")
            found = more.select(
                old["row"].alias("row"), "n_words",
                F.concat(old["spans"], F.col("spans")).alias("spans"),
                F.array_sort(F.array_union(old["items"], F.col("items"))).alias("items"))
    if passes > 1:
        found = found.withColumn("spans", _merge_column("spans"))
    return found


def _merge_column(name: str):
    """``merged`` for an array column, in Spark's functions."""
    empty = F.expr("cast(array() as array<struct<begin:int,end:int>>)")

    def step(acc, x):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            last["begin"].alias("begin"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (x["begin"] <= F.try_element_at(acc, F.lit(-1))["end"]),
                      grown).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(name), empty, step)


def n_hit():
    """Hit words of a row of ``find_benchmark``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])


def contaminated(share: int = 20):
    """True for a row of ``find_benchmark`` with at least one hit word in each ``share`` words."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with their columns."""
    return find_benchmark(docs, benchmark, **names).where(~contaminated()).select("row.*")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS m,
         array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS i FROM b WHERE len(ws) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, m, ws, unnest(range(1, len(ws) - m + 2)) AS i FROM w, ms WHERE len(ws) >= m)),
h AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN bw USING (m, win)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit
       FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY 1),
hi AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
       FROM h GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws)) AS contaminated
FROM w LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""


def query(spark, sf_dir):
    """Contract digest of ``find_benchmark`` over all documents and benchmark items."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))
