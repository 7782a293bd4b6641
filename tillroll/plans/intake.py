"""Staging raw lines once for all runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.sources.store import ResultStore


def stage_lines(raw: DataFrame, store: ResultStore) -> DataFrame:
    """Write raw lines as they are and return them read back.

    Every run reads its lines more than once. From text files each pass parses everything again; from the staged
    table it reads only the needed columns.
    """
    return store.write(raw, "raw_lines")
