"""Sinks for finished reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_reports(documents: DataFrame, folder: str, json_export: bool = False) -> None:
    """Write one text file per report under stem=..., and one JSON file on request.

    Folders of the same stem are replaced, others are kept.
    """
    _save(documents, "text", f"{folder}/text")
    if json_export:
        _save(documents, "json", f"{folder}/json")


def _save(documents: DataFrame, column: str, path: str) -> None:
    (
        documents.selectExpr(f"{column} as value", "stem")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stem")
        .text(path)
    )
