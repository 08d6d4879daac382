"""Metric reports (model, metric, value) as JSON lines, nested JSON or YAML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nested_report(report: DataFrame, model_col: str = "model") -> DataFrame:
    """One JSON object per model: ``{"model": ..., "metrics": {metric: value}}``."""
    entries = F.array_sort(F.collect_list(F.struct("metric", "value")))
    return report.groupBy(model_col).agg(
        F.to_json(
            F.struct(
                F.first(model_col).alias("model"), F.map_from_entries(entries).alias("metrics")
            )
        ).alias("report")
    )


def _quoted(name: Column) -> Column:
    """A YAML key: in double quotes unless it is a plain word."""
    marks = F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    plain = name.rlike("^[A-Za-z_][A-Za-z0-9_.-]*$") & ~F.lower(name).isin("null", "true", "false", "yes", "no", "on", "off")
    return F.when(plain, name).otherwise(F.concat(F.lit('"'), F.replace(marks, F.lit("\n"), F.lit("\\n")), F.lit('"')))


def yaml_report(report: DataFrame, model_col: str = "model") -> DataFrame:
    """One YAML block per model; a missing value is ``null``."""
    lines = F.array_sort(
        F.collect_list(
            F.concat(
                F.lit("  "),
                _quoted(F.col("metric")),
                F.lit(": "),
                F.coalesce(F.col("value").cast("string"), F.lit("null")),
            )
        )
    )
    return report.groupBy(model_col).agg(lines.alias("_lines")).select(
        model_col,
        F.concat_ws("\n", F.concat(_quoted(F.col(model_col)), F.lit(":")), "_lines").alias("report"),
    )


def write_report(report: DataFrame, path: str, form: str = "json") -> str:
    """Write a report as one small file; it has one row per model and metric."""
    if form == "json":
        report.coalesce(1).write.mode("overwrite").json(path)
    elif form == "nested":
        nested_report(report).select("report").coalesce(1).write.mode("overwrite").text(path)
    elif form == "yaml":
        yaml_report(report).select("report").coalesce(1).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown report form {form!r}: use json, nested or yaml")
    return path
