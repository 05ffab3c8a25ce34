"""Column expressions shared by the operators.

Everything here builds a JVM-side Catalyst expression; nothing runs in Python
per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A posting line is valid when it has this shape and every integer field fits
# its type. A tag may hold any character, line separators too. Fields: type, id, accepted answer (optional), parent
# (optional), score, then an optional tag and anything after it.
POSTING_LINE_PATTERN = (
    r"(?s)\A[+-]?[0-9]+,[+-]?[0-9]+,([+-]?[0-9]+)?,([+-]?[0-9]+)?,[+-]?[0-9]+(,.*)?\z"
)
# The same layout with integer fields of at most 9 digits, which always fit
# an int: a line matching it is valid without looking at the field values.
SHORT_INT_LINE_PATTERN = (
    r"(?s)\A[+-]?[0-9]{1,9},[+-]?[0-9]{1,9},([+-]?[0-9]{1,9})?,([+-]?[0-9]{1,9})?,"
    r"[+-]?[0-9]{1,9}(,.*)?\z"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _str_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def lang_index(tags: Column | str, langs: Sequence[str]) -> Column:
    """0-based index of the first entry of ``langs`` equal to ``tags``.

    Whole-string, case-sensitive equality. Null for a null or unknown tag.
    """
    pos = F.array_position(_str_array(langs), _col(tags))
    return (F.nullif(pos, F.lit(0)) - 1).cast("int")


def lang_label(lang_idx: Column | str, langs: Sequence[str]) -> Column:
    """Language name at a 0-based index."""
    return F.element_at(_str_array(langs), _col(lang_idx).cast("int") + 1)


def squared_distance(x1: Column | str, y1: Column | str,
                     x2: Column | str, y2: Column | str) -> Column:
    """``dx*dx + dy*dy`` as a double; deliberately no square root."""
    dx = (_col(x1) - _col(x2)).cast("double")
    dy = (_col(y1) - _col(y2)).cast("double")
    return dx * dx + dy * dy


def centers_literal(centers: Sequence[tuple[int, int]]) -> str:
    """SQL array literal of ``struct(i, cx, cy)``; position is the cluster id."""
    items = ", ".join(
        f"named_struct('i', {i}, 'cx', {int(cx)}L, 'cy', {int(cy)}L)"
        for i, (cx, cy) in enumerate(centers))
    return f"array({items})"


def nearest_center_sql(centers: Sequence[tuple[int, int]], x: str = "x", y: str = "y") -> str:
    """SQL text of ``nearest_center`` (for plans built from SQL strings)."""
    if not centers:
        return "0"
    dist = (f"cast(`{x}` - c.cx as double) * cast(`{x}` - c.cx as double) + "
            f"cast(`{y}` - c.cy as double) * cast(`{y}` - c.cy as double)")
    # coalesce: never null for a non-empty array; saying so keeps Catalyst
    # from inferring an isnotnull filter that would evaluate the argmin twice.
    return (f"coalesce(array_min(transform({centers_literal(centers)}, "
            f"c -> named_struct('d', {dist}, 'i', c.i))).i, 0)")


def nearest_center(centers: Sequence[tuple[int, int]], x: str = "x", y: str = "y") -> Column:
    """Index of the center with the lowest squared distance to ``(x, y)``.

    Ties go to the lowest index because the minimum is taken over
    ``struct(distance, index)``. With no centers the answer is 0. The centers
    are one constant array in the plan, so the argmin is a per-row expression
    (k distance evaluations per point): no join, no shuffle. The array is
    passed to the generated code as a value, so the code is the same in every
    k-means iteration and is compiled once.
    """
    return F.expr(nearest_center_sql(centers, x, y))


def median_int(y: Column | str, n: Column | str | None = None) -> Column:
    """Exact median as an int: middle value, or the truncated mean of the
    two middle values for an even count. ``n`` is an optional frequency."""
    yc = _col(y)
    p = F.percentile(yc, F.lit(0.5)) if n is None else F.percentile(yc, F.lit(0.5), _col(n))
    return p.cast("int")
