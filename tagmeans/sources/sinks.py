"""Report sink (S2): the fixed-width result table as text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Header lines and row format of the printed report.
REPORT_HEADER = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)
REPORT_ROW_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"  # median, label, percent, size


def report_lines(stats: DataFrame) -> DataFrame:
    """Render cluster statistics as ``pos int, line string``.

    ``stats`` needs ``lang_label, lang_percent, cluster_size, median_score``
    and may carry ``lang_idx`` and ``i`` to fix the order of equal medians.
    Rows 0-2 are the header; data rows follow in ascending median order.
    ``format_string`` is the JVM formatter, so rounding of the percent is
    the JVM's half-up rule.
    """
    spark = stats.sparkSession
    order = [c for c in ("median_score", "lang_idx", "i") if c in stats.columns]
    body = stats.select(
        (F.row_number().over(Window.orderBy(*order)) + F.lit(len(REPORT_HEADER) - 1))
        .cast("int").alias("pos"),
        F.format_string(REPORT_ROW_FORMAT, "median_score", "lang_label",
                        "lang_percent", "cluster_size").alias("line"))
    header = spark.createDataFrame(list(enumerate(REPORT_HEADER)), "pos int, line string")
    return header.unionByName(body)


def print_report(stats: DataFrame) -> None:
    """Print the report on the driver (one row per cluster, k rows at most)."""
    for r in report_lines(stats).orderBy("pos").collect():
        print(r["line"])
