"""License scans: an exact set-similarity join of text blocks and license templates.

A template is the set of a notice's words. A run of a text's words, at most the notice's
length over ``THRESHOLD``, meets it if it holds at least ``THRESHOLD`` of the template's words
(containment). Runs go over line ends, so wrapped notices are met.

Blocks are windows of the text's words that overlap so that each run is in one. The templates'
words are ordered by their frequency over all texts, rare ones first. A block and a template
that meet with an overlap of ``c`` words share one among the first ``|T| - c + 1`` words of the
template and the first ``|B| - c + 1`` of the block (prefix filter); ``|B| >= c``
(length filter); and the words from the shared ones on must be enough for ``c``
(positional filter). Pairs that pass are counted in full, at every start of a run. Words that no
template has can't add to an overlap, so only the templates' words meet in the join. Blocks
without any word of the templates' prefixes can't pass, whole texts neither, which is told
from their words before anything else is made of them.

Every run that meets a template counts for the score. Its label is chosen among the templates met
within a window's length by their telling phrases (what tells a license from the others: "mit
license", "version 3"): all of them, or at least half of them if no other label there has as large a
share of its own, or the same with as large a containment. Barred phrases in the run or ``AROUND``
words beside it ("lesser general" for the GPL) bar the label, not the match.

Beside that, phrases are looked for as consecutive words; their labels are the
base labels.

Only Spark's own functions are used. Defined results: null and empty texts have
no words and no labels; texts of any length are scanned whole; repeated words of a run count once;
repeated rows get equal results; ties in frequency are broken by the word; labels that tie get
none; an empty table gives no rows; every further column passes through.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, boxed, keep, table

# The phrases and labels of the contract.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Some notices by label; the words of each are one template.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("all-rights-reserved", "all rights reserved"),
]
THRESHOLD = 0.8

#: Words beside a run in which barred phrases are looked for too.
AROUND = 2


def _notices() -> list[tuple[str, str, list[str], list[str]]]:
    """Label, text, telling phrases and barred phrases of the common licenses' notices."""
    (_, mit), (_, grant), (_, apache), (_, _), (_, gpl), (_, reserved) = TEMPLATES
    spdx = "spdx license identifier"
    out = [
        ("mit", mit, ["mit license"], []),
        ("mit", grant, ["hereby granted", "deal in the software"], []),
        ("mit", f"{spdx} mit", [spdx, "mit"], []),
        ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
                "fee is hereby granted", ["with or without fee", "hereby granted"], []),
        ("isc", f"{spdx} isc", [spdx, "isc"], []),
        ("isc", "released under the isc license", ["isc license"], []),
        ("apache-2", apache, ["apache license", "version 2"], []),
        ("apache-2", "licensed under the apache license 2 0", ["apache license 2"], []),
        ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the "
                     "license at http www apache org licenses license 2 0",
         ["except in compliance", "apache org licenses license 2"], []),
        ("apache-2", f"{spdx} apache 2 0", [spdx, "apache 2"], []),
        ("bsd", "released under the bsd license", ["bsd license"], []),
        ("bsd", "licensed under the bsd 3 clause license", ["bsd", "clause"], []),
        ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                "provided that the following conditions are met", ["source and binary forms", "are permitted"], []),
        ("bsd", f"{spdx} bsd 3 clause", [spdx, "bsd"], []),
        ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
         ["mozilla public license v 2"], []),
        ("mpl-2", "licensed under the mozilla public license version 2 0", ["mozilla public license", "version 2"], []),
        ("mpl-2", "licensed under the mozilla public license 2 0", ["mozilla public license 2"], []),
        ("mpl-2", f"{spdx} mpl 2 0", [spdx, "mpl 2"], []),
        ("all-rights-reserved", reserved, ["rights reserved"], []),
        ("mit", "licensed under the mit license", ["mit license"], []),
        ("mit", "licensed under the mit licence", ["mit licence"], []),
        ("mit", "apache 2 0 or mit", ["2 0 or mit"], []),
        ("mit", "mit or apache 2 0", ["mit or apache"], []),
        ("apache-2", "mit or apache 2 0", ["or apache 2"], []),
        ("apache-2", "apache license v2 0", ["apache license v2"], []),
        ("bsl-1", "distributed under the boost software license version 1 0", ["boost software license"], []),
        ("bsl-1", f"{spdx} bsl 1 0", [spdx, "bsl 1"], []),
        ("epl-2", "made available under the terms of the eclipse public license v 2 0", ["eclipse public license"], []),
        ("epl-2", f"{spdx} epl 2 0", [spdx, "epl 2"], []),
        ("eupl-1.2", "licensed under the eupl version 1 2", ["the eupl"], []),
        ("eupl-1.2", f"{spdx} eupl 1 2", [spdx, "eupl 1 2"], []),
        ("cc0-1", "creative commons cc0 1 0 universal public domain dedication", ["cc0 1"], []),
        ("cc0-1", f"{spdx} cc0 1 0", [spdx, "cc0 1"], []),
    ]
    other = ["lesser general", "library general", "affero general"]
    for kind, name, versions in (("gpl", "", ["2", "3"]), ("lgpl", "lesser ", ["2 1", "3"]), ("agpl", "affero ", ["3"])):
        for v in versions:
            label, full = f"{kind}-{v.replace(' ', '.')}", f"gnu {name}general public license"
            tell, bar = [f"{name}general public license", f"version {v}"], [] if name else other
            for thing in ("program", "library"):
                out.append((label, f"this {thing} is free software you can redistribute it and or modify it under the "
                                   f"terms of the {full} as published by the free software foundation either version {v} "
                                   "of the license or at your option any later version", tell, bar))
            out += [(label, gpl.replace("gnu general public license", full).replace("version 3", f"version {v}"), tell, bar),
                    (label, f"{full} version {v}", tell, bar),
                    (label, f"{full} v{v}", [f"{name}general public license v{v}"], bar),
                    (label, f"licensed under the {kind} license version {v}", [kind, f"version {v}"], []),
                    (label, f"licensed under the {kind} v{v}", [f"{kind}v{v}"], []),
                    (label, f"licensed under the {kind}v{v}", [f"{kind}v{v}"], []),
                    (label, f"{spdx} {kind} {v} 0" if " " not in v else f"{spdx} {kind} {v}", [spdx, f"{kind} {v}"], [])]
    long = {"by": "attribution", "nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}
    for parts in (["by"], ["by", "nc"], ["by", "sa"], ["by", "nd"], ["by", "nc", "sa"], ["by", "nc", "nd"]):
        label, short, words = "-".join(["cc", *parts]), " ".join(parts), " ".join(long[p] for p in parts)
        more = [f"{parts[-1]} {x}" for x in ("nc", "sa", "nd")]
        out += [(label, f"licensed under cc {short} 4 0", [f"cc {short}"], more),
                (label, f"{spdx} cc {short} 4 0", [spdx, f"cc {short}"], more),
                *[(label, f"{before}creative commons {words} 4 0 international license",
                   [f"creative commons {words}"], [f"{long[parts[-1]]} {x}" for x in (*long.values(), "non", "share", "no")])
                  for before in ("", "this work is licensed under a ")]]
    return out


#: What the query looks for: label, text, telling phrases, barred phrases.
NOTICES = _notices()

#: Parts of texts before A-Z is lower-cased.
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _needed(words: list[str], threshold: float) -> int:
    """The least overlap that meets the threshold."""
    return max(1, ceil(threshold * len(words) - 1e-9))


def _sets(templates) -> list[tuple[str, list[str]]]:
    return [(label, sorted(set(text.split()))) for label, text, *_ in templates]


def _span(text: str, threshold: float) -> int:
    """The length of the runs that are held against a notice."""
    return ceil(len(text.split()) / threshold - 1e-9)


def _array(words, kind=None):
    out = F.array(*[F.lit(w) for w in words])
    return out.cast(f"array<{kind}>") if kind else out


def _reach(templates, threshold: float) -> int:
    """Words from one window's start to the next one's: the longest run."""
    return max((_span(text, threshold) for _, text, *_ in templates), default=1)


def _order(docs: DataFrame, text: str, sets) -> dict[str, int]:
    """The templates' words by frequency over all texts, rare ones first. At most the
    templates' vocabulary reaches the driver."""
    words = sorted({w for _, ws in sets for w in ws})
    known = docs.sparkSession.range(1).select(F.explode(_array(words, "string")).alias("w"))
    # lower() also folds letters beyond A-Z, which may add to a count but can't part a word
    each = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _NOT_WORD)).alias("w"))
    counts = {r.w: r.n for r in each.join(F.broadcast(known), "w").groupBy("w").agg(F.count("*").alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(words, key=lambda w: (counts.get(w, 0), w)))}


def _rare(sets, order: dict[str, int], threshold: float) -> list[str]:
    """The words of all templates' prefixes."""
    return sorted({w for _, ws in sets
                   for w in sorted(ws, key=order.__getitem__)[:len(ws) - _needed(ws, threshold) + 1]}, key=order.__getitem__)


def _parted(docs: DataFrame, text: str, rare: list[str], phrases) -> DataFrame:
    """``row``, ``n_words`` and ``low``: the lower-cased text if one of its words is in ``rare`` or all words of
    a phrase are, else null. Texts are parted once for that."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # A-Z of it as they should be; letters beyond may add to what is looked at closer, but can't part or join words
    parts = F.split(F.lower(whole), _NOT_WORD)
    either = lambda tests: reduce(lambda a, b: a | b, tests, F.lit(False))
    may_meet = F.arrays_overlap("parts", _array(rare, "string"))
    may_have = either(reduce(lambda a, b: a & b, [F.array_contains("parts", w) for w in p.split()]) for p in phrases)
    size = F.size("parts")  # an empty part stands before and after the words if other characters do
    n_words = (size - (F.get("parts", F.lit(0)) == "").cast("int")
               - ((size > 1) & (F.get("parts", size - 1) == "")).cast("int"))
    return (boxed(docs, whole.alias("whole"), parts.alias("parts"))
            .select("row", n_words.cast("long").alias("n_words"),
                    F.when(may_meet | may_have, F.translate("whole", UPPER, LOWER)).alias("low")))


def _blocks(docs: DataFrame, text: str, templates, phrases, order, threshold: float) -> DataFrame:
    """``row``, ``n_words``, ``starts`` (array of (start, label) of phrases) and ``blocks``: (k, words) of
    windows with a word of a prefix, with ``AROUND`` more words on both sides (empty beyond the text's ends)."""
    rare, reach = _rare(_sets(templates), order, threshold), _reach(templates, threshold)
    base = _parted(docs, text, rare, phrases)
    words = F.filter(F.split("low", _NOT_WORD), lambda w: w != "")

    def found(phrase, label):
        ws = phrase.split()
        at = F.filter(F.sequence(F.lit(0), F.size("words") - len(ws)),
                      lambda i: (F.get("words", i) == ws[0]) & (F.slice("words", i + 1, len(ws)) == _array(ws)))
        return F.transform(at, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    none = F.expr("cast(array() as array<struct<start:bigint,label:string>>)")
    starts = F.when(F.col("low").isNotNull(), F.flatten(F.array(none, *[
        F.when(F.size("words") >= len(p.split()), found(p, label)).otherwise(none)
        for p, label in phrases.items()]))).otherwise(none)
    beyond = _array([""] * AROUND)
    windows = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / reach).cast("int")), lambda k: F.struct(
        k.alias("k"), F.slice("padded", k * reach + 1, 2 * reach + 2 * AROUND).alias("b")))
    some = F.filter(windows, lambda w: F.arrays_overlap(w["b"], _array(rare, "string")))
    return (base.withColumn("words", F.when(F.col("low").isNotNull(), words)).select("row", "n_words", "words", "low")
            .withColumn("padded", F.concat(beyond, F.col("words"), beyond))
            .select("row", "n_words", starts.alias("starts"), F.when(F.size("words") > 0, some).otherwise(
                F.expr("cast(array() as array<struct<k:int,b:array<string>>>)")).alias("blocks")))


def _join(blocks: DataFrame, templates, order: dict[str, int], threshold: float) -> DataFrame:
    """The matches: uid, k, label, start (of the best run), tell (share of the telling phrases, -1 if barred),
    share (containment of that run) and most (of all runs of the block)."""
    ranked = [(label, sorted(ws, key=order.__getitem__), _needed(ws, threshold)) for label, ws in _sets(templates)]
    rows = [F.struct(F.lit(order[words[i]]).alias("token"), F.lit(i).alias("t_at"), F.lit(t).alias("template"),
                     F.lit(len(words)).alias("t_size"), F.lit(c).alias("need"))
            for t, (_, words, c) in enumerate(ranked) for i in range(len(words) - c + 1)]
    spark, reach = blocks.sparkSession, _reach(templates, threshold)
    prefixes = spark.range(1).select(F.inline(F.array(*rows)))
    wanted = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("template"), F.lit(label).alias("label"), _array(words).alias("t_words"),
                 F.lit(_span(text, threshold)).alias("span"), _array(telling, "string").alias("telling"),
                 _array(barred, "string").alias("barred"))
        for t, ((label, words, _), (_, text, telling, barred)) in enumerate(zip(ranked, templates))])))
    ranks = F.create_map(*[x for w, i in order.items() for x in (F.lit(w), F.lit(i))])
    least, known = min(c for _, _, c in ranked), _array(sorted(order))
    size = F.size("b_words")
    ordered = (blocks.select("uid", F.inline("blocks"))
               .withColumn("b_words", F.array_sort(F.transform(F.array_intersect("b", known), lambda w: ranks[w]))))
    probes = ordered.select("uid", "k", "b", "b_words", F.posexplode(
        F.slice("b_words", 1, F.greatest(size - least + 1, F.lit(0)))).alias("b_at", "token"))
    # the prefixes' number of rows is that of the templates' words at most, so every task
    # has them all and blocks aren't shuffled, however common one is
    met_at = (F.col("t_size") - F.col("t_at")).alias("left")
    passed = (probes.join(F.broadcast(prefixes), "token")
              .where((size >= F.col("need")) & (F.col("b_at") <= size - F.col("need"))
                     & (F.least(met_at, size - F.col("b_at")) >= F.col("need"))))
    # a pair that shares several words of its prefixes is counted at the first of them
    first = F.array_min(F.filter(F.transform("b_words", lambda r: F.when(F.exists("t_words", lambda w: ranks[w] == r), r)),
                                 lambda r: r.isNotNull()))
    spaced = lambda ws: F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" "))
    inside = lambda text, p: F.contains(text, F.concat(F.lit(" "), p, F.lit(" ")))

    def met(i):
        run = F.slice("b", i, F.col("span"))
        n = F.size(F.array_intersect(run, "t_words"))
        around = spaced(F.slice("b", i - AROUND, F.col("span") + 2 * AROUND))
        told = F.when(F.size("telling") == 0, 1.0).otherwise(
            F.size(F.filter("telling", lambda p: inside(spaced(run), p))) / F.size("telling"))
        tell = F.when(F.exists("barred", lambda p: inside(around, p)), -1.0).otherwise(told)
        return F.when(n >= F.col("need"), F.struct(tell.alias("tell"), n.alias("n"), (-i).alias("i")))

    runs = F.filter(F.transform(F.sequence(F.lit(AROUND + 1), F.lit(AROUND + reach)), met), lambda x: x.isNotNull())
    best = F.array_max("runs")
    return (passed.join(F.broadcast(wanted), "template")  # one row for each template
            .where(F.col("token") == first)
            .withColumn("runs", runs).where(F.size("runs") > 0)
            .select("uid", "k", "label", (F.col("k") * reach - best["i"] - AROUND - 1).alias("start"), best["tell"].alias("tell"),
                    (best["n"] / F.size("t_words")).alias("share"),
                    (F.array_max(F.transform("runs", lambda x: x["n"])) / F.size("t_words")).alias("most")))


def _chosen(matches: DataFrame, reach: int) -> DataFrame:
    """(uid, found, share): the labels that a row's matches choose and their largest containment."""
    weak = matches.where("tell >= 0.5 and tell < 1").withColumn("id", F.monotonically_increasing_id())
    near = matches.where("tell >= 0.5").select("uid", F.explode(F.array(*[F.col("k") + i for i in (-1, 0, 1)])).alias("k"), *[
        F.col(c).alias(f"o_{c}") for c in ("label", "start", "tell", "share")])
    better = F.struct("o_tell", "o_share") >= F.struct("tell", "share")
    alone = weak.join(near, (weak.uid == near.uid) & (weak.k == near.k) & (F.col("label") != F.col("o_label"))
                      & (F.abs(F.col("start") - F.col("o_start")) < reach) & better, "left_anti")
    labels = (matches.where("tell = 1").select("uid", "label").unionByName(alone.select("uid", "label"))
              .groupBy("uid").agg(F.collect_set("label").alias("found")))  # as many as there are licenses at most
    return matches.groupBy("uid").agg(F.max("most").alias("share")).join(labels, "uid", "left")


def scan(docs: DataFrame, text: str = "text", templates=NOTICES, phrases: dict[str, str] = PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (all columns of ``docs`` but the text), ``n_words``, ``starts``
    (array<struct<start, label>>: places of the phrases), ``labels`` (array, of phrases
    and templates) and ``score``: the largest containment met, 1 for a phrase, else 0."""
    order = _order(docs, text, _sets(templates))
    slim = keep(_blocks(docs, text, templates, phrases, order, threshold)
                .withColumn("row", F.col("row").dropFields(text))
                .withColumn("uid", F.monotonically_increasing_id()))
    matches = keep(_join(slim.where(F.size("blocks") > 0).select("uid", "blocks"), templates, order, threshold))
    met = _chosen(matches, _reach(templates, threshold))
    own = F.transform("starts", lambda s: s["label"])
    return slim.join(met, "uid", "left").select(
        "row", "n_words", "starts",
        F.array_sort(F.array_union(own, F.coalesce("found", F.expr("cast(array() as array<string>)")))).alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size("starts") > 0, 1.0).otherwise(0.0)).alias("score"))


def query(spark, sf_dir):
    """Contract digest over all documents."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    start = F.transform("starts", lambda s: s["start"])
    label = F.array_sort(F.array_distinct(F.transform("starts", lambda s: s["label"])))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        F.array_join(label, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def oracle(templates=NOTICES, phrases=PHRASES, threshold=THRESHOLD) -> str:
    """The query's rows by trying every template at every word of a text, in DuckDB SQL."""
    reach = _reach(templates, threshold)
    lists = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]::VARCHAR[]"
    rows = ",\n  ".join(f"({i}, '{label}', {lists(ws)}, {_needed(ws, threshold)}, {_span(text, threshold)}, {lists(tell)}, {lists(bar)})"
                        for i, ((label, ws), (_, text, tell, bar)) in enumerate(zip(_sets(templates), templates)))
    words = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    places = " UNION ALL ".join(
        f"SELECT rid, i - 1 AS start, '{label}' AS label FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i "
        f"FROM w) WHERE ws[i:i + {len(p.split()) - 1}] = {p.split()!r}" for p, label in phrases.items())
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {words}) AS ws FROM documents),
t(template, label, words, need, span, tell, bar) AS (VALUES
  {rows}),
pairs AS (SELECT w.rid, ws, t.* FROM w, t WHERE len(list_intersect(list_distinct(ws), words)) >= need),
runs AS (
  SELECT rid, template, label, len(words) AS size, i, (i - 1) // {reach} AS k, tell, bar,
         len(list_intersect(list_distinct(ws[i:i + span - 1]), words)) AS n, need,
         ' ' || array_to_string(ws[i:i + span - 1], ' ') || ' ' AS run,
         ' ' || array_to_string(ws[greatest(i - {AROUND}, 1):i + span - 1 + {AROUND}], ' ') || ' ' AS around
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM pairs)),
told AS (
  SELECT *, CASE WHEN len(list_filter(bar, lambda p: contains(around, ' ' || p || ' '))) > 0 THEN -1.0
                 WHEN len(tell) = 0 THEN 1.0
                 ELSE len(list_filter(tell, lambda p: contains(run, ' ' || p || ' ')))::DOUBLE / len(tell) END AS told
  FROM runs WHERE n >= need),
m AS (
  SELECT rid, k, template, label, i AS start, told, n / size AS share, max(n) OVER (PARTITION BY rid, k, template) / size AS most
  FROM told QUALIFY row_number() OVER (PARTITION BY rid, k, template ORDER BY told DESC, n DESC, i) = 1),
good AS (
  SELECT rid, label FROM m WHERE told = 1 OR told >= 0.5 AND NOT EXISTS (
    SELECT 1 FROM m o WHERE o.rid = m.rid AND abs(o.k - m.k) <= 1 AND o.label != m.label AND o.told >= 0.5
      AND abs(o.start - m.start) < {reach} AND (o.told > m.told OR o.told = m.told AND o.share >= m.share))),
p AS ({places}),
b AS (SELECT rid, count(*) AS n, min(start) AS a, max(start) AS z,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY rid),
a AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT rid, label FROM good UNION ALL SELECT rid, label FROM p) GROUP BY rid),
s AS (SELECT rid, max(share) AS share FROM (SELECT rid, most AS share FROM m UNION ALL SELECT rid, 1.0 FROM p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.a::BIGINT AS first_word,
       b.z::BIGINT AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       coalesce(s.share, 0)::DOUBLE AS score
FROM w LEFT JOIN b USING (rid) LEFT JOIN a USING (rid) LEFT JOIN s USING (rid)
"""
