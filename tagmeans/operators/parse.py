"""Posting lines -> posting records (P1), questions (P2), answers (P3).

A posting line is comma separated, without header, quoting or trimming:
``type,id,accepted_answer,parent_id,score[,tags[,ignored...]]``. Trailing
empty fields are dropped before the fields are counted, so ``1,5,,,0,`` has
no tag and ``1,5,,,0,,x`` has the empty tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import POSTING_LINE_PATTERN, SHORT_INT_LINE_PATTERN
from ..schema import POSTING_COLUMNS

_ID_FIELDS = (1, 2, 3)  # id, accepted answer, parent: int, or bigint on request
_ID_TYPES = ("int", "bigint")


def _fields(value: Column) -> Column:
    return F.split(F.rtrim(value, F.lit(",")), ",")


def _type_of(k: int, id_type: str) -> str:
    return id_type if k in _ID_FIELDS else "int"


def _is_valid(v: Column, id_type: str) -> Column:
    """Almost every line is settled by one pattern match (integer fields of at
    most 9 digits always fit an int); only longer fields take the exact path
    (layout pattern plus a range check of the five integer fields)."""
    return v.isNotNull() & (v.rlike(SHORT_INT_LINE_PATTERN)
                            | (v.rlike(POSTING_LINE_PATTERN) & _fits(_fields(v), id_type)))


def _fits(a: Column, id_type: str) -> Column:
    ok = F.lit(True)
    for k in range(5):
        f = F.coalesce(F.get(a, k), F.lit(""))
        ok = ok & ((f == "") | f.try_cast(_type_of(k, id_type)).isNotNull())
    return ok


def malformed_lines(lines: DataFrame, id_type: str = "int") -> DataFrame:
    """Lines the strict parser would reject, with the reason.

    ``reason`` is 'shape' when the line is null or does not have the posting
    layout, or 'int_range' when it has the layout but an integer field
    overflows its type. Output: ``value string, reason string``.
    """
    v = F.col("value")
    reason = (F.when(v.isNull(), F.lit("shape"))
              .when(v.rlike(SHORT_INT_LINE_PATTERN), F.lit(None).cast("string"))
              .when(~v.rlike(POSTING_LINE_PATTERN), F.lit("shape"))
              .when(~_fits(_fields(v), id_type), F.lit("int_range")))
    return (lines.select("value", reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def parse_postings(lines: DataFrame, strict: bool = True, id_type: str = "int") -> DataFrame:
    """Parse a ``value`` text column into the posting schema.

    ``strict=True`` fails the job on the first malformed line, as the
    reference does: a filter raises, so the check holds for every action,
    ``count()`` too, whichever columns a caller keeps. ``strict=False`` drops
    malformed lines instead. ``id_type='bigint'`` reads ids of 64 bits; with
    the default 32 bits, as in the reference, a longer id is malformed.
    """
    if id_type not in _ID_TYPES:
        raise ValueError(f"id_type must be one of {_ID_TYPES}")
    v = F.col("value")
    ok = _is_valid(v, id_type)
    if strict:
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(
            F.lit("malformed posting line: "), F.coalesce(v, F.lit("<null>")))).cast("boolean"))
    a = F.col("a")

    def num(k: int, field: Column) -> Column:
        return F.nullif(field, F.lit("")).try_cast(_type_of(k, id_type))

    # Callers filter by type and parent, so these are read without splitting the line (a valid
    # line has its first five fields whatever is trimmed); Catalyst prunes what a caller doesn't read.
    kind = num(0, F.substring_index(v, ",", 1))
    parent = num(3, F.substring_index(F.substring_index(v, ",", 4), ",", -1))
    return (lines.where(ok).select(kind.alias("posting_type"), parent.alias("parent_id"), _fields(v).alias("a"))
            .select("posting_type", num(1, F.get(a, 1)).alias("id"), num(2, F.get(a, 2)).alias("accepted_answer"),
                    "parent_id", num(4, F.get(a, 4)).alias("score"),
                    F.when(F.size(a) >= 6, F.get(a, 5)).alias("tags")))


def questions(postings: DataFrame) -> DataFrame:
    """Postings of type 1 (P2)."""
    return postings.where(F.col("posting_type") == 1).select(*POSTING_COLUMNS)


def answers(postings: DataFrame, strict: bool = True) -> DataFrame:
    """Postings of type 2 (P3).

    ``strict=True`` fails on an answer without a parent (the reference's
    ``parentId.get``); otherwise such answers are kept and later vanish in the
    inner join.
    """
    cond = F.col("posting_type") == 2
    if strict:
        orphan = F.raise_error(F.concat(F.lit("answer without parent: id="), F.col("id").cast("string")))
        # the type test inside the CASE: only answers can raise, whatever the order of conjuncts
        cond = (F.when(F.col("posting_type") != 2, F.lit(False))
                .when(F.col("parent_id").isNull(), orphan.cast("boolean")).otherwise(F.lit(True)))
    return postings.where(cond).select(*POSTING_COLUMNS)
