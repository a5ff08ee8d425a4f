"""Sinks: Parquet for tables, tab-separated text for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = ("group_id",)) -> None:
    """Parquet, in folders by group where the table has one."""
    held = [c for c in by if c in df.columns]
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*held) if held else writer).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_text(df: DataFrame, path: str) -> None:
    """A column named value, a line each."""
    df.select("value").write.mode("overwrite").text(path)
