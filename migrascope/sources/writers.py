"""Writers. REBALANCE spreads a large partition value over several files and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _write(df: DataFrame, path: str, partitions: list[str], replace_all: bool = False) -> None:
    """Dynamic overwrite replaces only the partition values present in ``df``."""
    mode = "static" if replace_all or not partitions else "dynamic"
    writer = df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", mode)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def write_by_year(df: DataFrame, path: str) -> None:
    """Survey, industry and feature layers: rewriting one year leaves the others alone."""
    _write(df, path, ["year"])


def write_businesses(df: DataFrame, path: str) -> None:
    _write(df, path, [])


def write_locations(df: DataFrame, path: str) -> None:
    _write(df, path, [])


def write_scores(df: DataFrame, path: str) -> None:
    """Scores: one folder per origin group and horizon; other groups and horizons stay."""
    _write(df, path, ["origin_group", "horizon"])


def write_matches(df: DataFrame, path: str) -> None:
    """Matches: one folder per origin group; the table holds the last run and nothing older."""
    _write(df, path, ["origin_group"], replace_all=True)
