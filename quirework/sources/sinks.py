"""Sinks: create-only artefacts, request bundles per batch, append-only ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_new(df: DataFrame, path: str, kind: str = "json") -> None:
    """Fails where something already is."""
    df.write.mode("errorifexists").format(kind).save(path)


def write_requests(requests: DataFrame, path: str, batch: str = "batch_id") -> None:
    """One folder of JSON for each batch; create-only."""
    requests.write.mode("errorifexists").partitionBy(batch).json(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
