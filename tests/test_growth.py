"""Whole runs over large tables: what is joined, held or written more often than the work asks for."""

import gzip
from pathlib import Path

from tillroll import registry
from tillroll.plans import warehouse
from tillroll.sources.lines import read_lines
from tillroll.sources.star import star_lines

DATA = "/root/testdata/sf0.001"


def test_warehouse_reports_read_a_written_rollup(spark, monkeypatch):
    plans, made_once, real = {}, [], warehouse.create_if_absent
    rollup = warehouse.rollups.invoice_rollup

    def noted(session, table, made, *more):
        def seen():
            frame = made()
            plans[table] = frame._jdf.queryExecution().optimizedPlan().toString()
            return frame

        return real(session, table, seen, *more)

    monkeypatch.setattr(warehouse, "create_if_absent", noted)
    monkeypatch.setattr(warehouse.rollups, "invoice_rollup", lambda lines: made_once.append(1) or rollup(lines))
    lines = star_lines(spark, DATA)
    try:
        warehouse.build_warehouse(lines, "written_db")
        assert len(plans) == 11 and not [t for t, p in plans.items() if "InMemoryRelation" in p] and made_once == [1]
        warehouse.build_warehouse(lines, "written_db")
        assert made_once == [1]  # nothing is computed for tables that exist
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_lines_of_a_board_are_joined_once(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(registry, "_boards", {})
    monkeypatch.setattr(registry, "run_segmentation", lambda raw, store: asked.append(raw))
    monkeypatch.setattr(registry, "run_ledger", lambda raw, store: asked.append(raw))
    registry._board(spark, DATA, "ledger", "segmentation")
    plans = [raw._jdf.queryExecution().optimizedPlan().toString() for raw in asked]
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    assert sorted(asked[0].collect()) == sorted(star_lines(spark, DATA).collect())


def test_texts_are_written_compressed(spark):
    folder = registry._texts(spark, DATA, registry.ISO_LAYOUT)
    files = [f for f in Path(folder).iterdir() if f.name.startswith("part-")]
    assert files and all(gzip.decompress(f.read_bytes()).startswith(b"InvoiceNo,") for f in files)
    assert read_lines(spark, folder).count() == star_lines(spark, DATA).count()
