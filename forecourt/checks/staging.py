"""Checked queries: the ten staging tables, from raw text to the latest typed record."""

from __future__ import annotations

from pyspark.sql import DataFrame

from forecourt.checks.cases import Cases
from forecourt.checks.compare import plain
from forecourt.checks.duck import table_output
from forecourt.checks.frames import LensModels
from forecourt.checks.rawrows import landed_events, landed_lines, landed_targets, raw_pages
from forecourt.lens import STAGED_AS
from forecourt.plans.staging import STAGES, stage

cases = Cases()

# Lineage depends on where the rows were landed.
LINEAGE = ("source_extract_date", "source_run_id", "source_file", "source_sha256")


def raw_of(m: LensModels, view: str) -> DataFrame:
    if view in ("vehicles", "listings"):
        return landed_lines(m, view)
    if view == "events_view":
        return landed_events(m)[1]
    if view == "targets":
        return landed_targets(m)[1]
    return raw_pages(m, view)


def _register(view: str, table: str) -> None:
    def build(m: LensModels) -> DataFrame:
        return plain(stage(STAGES[table], raw_of(m, view)), *LINEAGE)

    cases.add(table, build)
    cases.oracles[table] = table_output(table, view, skip=LINEAGE)


for _view, _table in STAGED_AS.items():
    _register(_view, _table)

QUERIES, ORACLES = cases.queries, cases.oracles
