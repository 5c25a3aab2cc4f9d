"""Program metric reports from long (metric_key, metric_value) tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.functions.display import display_number

COUNT, VOLUME, MONEY = "#,##0", "#,##0.000", "$#,##0.00"


@dataclass(frozen=True)
class ReportLine:
    """One report line: per output column, the (program, metric keys) added up.

    ``total`` adds the first two columns.
    """

    label: str
    columns: dict[str, tuple[str, list[str]]]
    pattern: str
    total: bool = False


def two_program_lines(program_a: str, program_b: str) -> list[ReportLine]:
    """Lines of the report on two programs and their total."""
    # Line label, metric keys and display pattern.
    lines = [
        ("# Growers with Bookings or Invoices", ["# Growers with Bookings or Invoices"], COUNT),
        ("Booked Gallons To Date", ["Booked Gallons to Date"], VOLUME),
        ("Booked Gallons To Date Pre Deadline", ["Booked Gallons Pre-Deadline"], VOLUME),
        ("Invoiced Gallons To Date", ["Net Positive Invoiced Gallons to Date"], VOLUME),
        ("Earned Amount To Date (Based on Invoices)", ["Earned Amount to Date"], MONEY),
        ("Remaining Earnable Amount To Date (Bookings)", ["Remaining Earnable Amount to Date"], MONEY),
        (
            "Total Potential Earnings (Invoices + Bookings)",
            ["Earned Amount to Date", "Remaining Earnable Amount to Date"],
            MONEY,
        ),
    ]
    return [
        ReportLine(label, {"a": (program_a, keys), "b": (program_b, keys)}, pattern, total=True)
        for label, keys, pattern in lines
    ]


def matched_lines(first: str, second: str) -> list[ReportLine]:
    """Lines of the report on two matched products, whose metrics carry their names."""
    # Line label, per-product metric keys, matched metric key, display pattern.
    lines = [
        (
            "# Growers with Bookings",
            ["# Growers with Booked {} Acres to Date"],
            "# Growers with Booked Matching Acres",
            COUNT,
        ),
        (
            "Booked Acres To Date",
            ["Booked {} Acres to Date"],
            "Booked Matching Acres to Date",
            VOLUME,
        ),
        (
            "# Growers with Invoices",
            [
                "# Growers with Net Positive Invoiced {} Acres",
                "# Growers with Net Negative Invoiced {} Acres",
            ],
            "# Growers with Invoiced Matching Acres",
            COUNT,
        ),
        (
            "Invoiced Acres To Date",
            ["Net Positive Invoiced {} Acres to Date"],
            "Invoiced Matching Acres to Date",
            VOLUME,
        ),
    ]
    report = [
        ReportLine(
            label,
            {
                "a": ("", [k.format(first) for k in keys]),
                "b": ("", [k.format(second) for k in keys]),
                "matched": ("", [matched]),
            },
            pattern,
        )
        for label, keys, matched, pattern in lines
    ]
    # Label and metric key of the two money lines, which fill the first column only.
    money = [
        ("Earned Amount To Date (Based on Invoiced Matched Acres)", "Earned Amount to Date"),
        (
            "Total Potential Earnings (Based on Booked Matched Acres)",
            "Remaining Projected Earnable Amount to Date",
        ),
    ]
    return report + [ReportLine(label, {"a": ("", [key])}, MONEY) for label, key in money]


def last_values(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last value per program and metric (by ``row_idx``); unlabelled rows do not count."""
    kept = metrics.filter(F.coalesce("metric_key", F.lit("")) != "")
    keys = [*by, "metric_key"]
    if "program_label" in metrics.columns:
        kept = kept.filter(F.coalesce("program_label", F.lit("")) != "")
        keys = [*by, "program_label", "metric_key"]
    return kept.groupBy(*keys).agg(F.max_by("metric_value", "row_idx").alias("metric_value"))


def program_report(
    metrics: DataFrame, lines: list[ReportLine], by: Sequence[str] = ()
) -> DataFrame:
    """One row per report line: label, one value per column, total and display text.

    Metrics that are missing count as 0. ``by`` names columns that tell reports
    apart, when the table holds the metrics of many.
    """
    by = list(by)
    labelled = "program_label" in metrics.columns
    wanted_keys = sorted({k for line in lines for _, keys in line.columns.values() for k in keys})
    kept = metrics.filter(F.col("metric_key").isin(wanted_keys))
    if labelled:
        programs = sorted({p for line in lines for p, _ in line.columns.values()})
        kept = kept.filter(F.col("program_label").isin(programs))
    names = list(dict.fromkeys(c for line in lines for c in line.columns))
    program = F.col("program_label") if labelled else F.lit("")
    parts = [
        F.struct(F.lit(no).alias("line_no"), F.lit(column).alias("column"))
        for no, _ in enumerate(lines, start=1)
        for column in names
    ]
    tests = [
        (program == line.columns[column][0] if labelled else F.lit(True))
        & F.col("metric_key").isin(line.columns[column][1])
        if column in line.columns
        else F.lit(False)
        for line in lines
        for column in names
    ]
    used = F.array_compact(F.array(*[F.when(t, p) for t, p in zip(tests, parts)]))
    cells = (
        last_values(kept, by)
        .select(*by, F.explode(used).alias("c"), "metric_value")
        .groupBy(*by, "c.line_no")
        .agg(
            *[
                F.sum(F.when(F.col("c.column") == c, F.col("metric_value"))).alias(c)
                for c in names
            ]
        )
    )
    frame = F.array(
        *[
            F.struct(
                F.lit(no).alias("line_no"), F.lit(line.label).alias("label"),
                F.lit(line.pattern).alias("pattern"), F.lit(line.total).alias("has_total"),
                F.array(*[F.lit(c) for c in line.columns]).alias("has"),
            )
            for no, line in enumerate(lines, start=1)
        ]
    )
    if by:
        reports = metrics.select(*by).distinct()
    else:
        reports = metrics.sparkSession.range(1)
    all_lines = reports.select(*by, F.explode(frame).alias("l")).select(*by, "l.*")
    filled = all_lines.join(cells, [*by, "line_no"], "left").withColumns(
        {c: F.when(F.array_contains("has", c), F.coalesce(c, F.lit(0.0))) for c in names}
    )
    shown = {f"{c}_text": display_number(F.col(c), F.col("pattern")) for c in names}
    if any(line.total for line in lines):
        filled = filled.withColumn("total", F.when(F.col("has_total"), F.col("a") + F.col("b")))
        shown["total_text"] = display_number(F.col("total"), F.col("pattern"))
    return filled.withColumns(shown).drop("pattern", "has_total", "has")


def report_details(results: DataFrame) -> DataFrame:
    """The detail rows behind a report, passed through unchanged."""
    return results
