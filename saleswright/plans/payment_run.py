"""A payment run: mapping and grids to a typed ledger, its metadata and its checks."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame

from saleswright.config import BASE_LEDGER, Ledger
from saleswright.operators import ledger_checks, projection
from saleswright.operators.conditions import Condition
from saleswright.scale import compiled, scratch_path, shuffles_removed


class LoadedRun:
    """The results of a run, each made when it is asked for.

    ``metadata`` and ``bad_values`` are one aggregate of the rows in range, of which nothing is
    stored. ``ledger`` needs row numbers: the rows are cleaned and written once to the shared
    folder, and from then on all results read what was written.
    """

    def __init__(self, grid: DataFrame, checked: DataFrame, conditions: list[Condition], ledger: Ledger, run_id: str):
        self.grid, self.checked, self.conditions = grid, checked, conditions
        self.columns, self.run_id = ledger, run_id
        self.is_staged = False

    def rows(self, only_counts: bool = False, by_block: bool = False) -> DataFrame:
        """All rows in range, from the store if they are there."""
        if self.is_staged:
            return self.staged
        return projection.rows_in_range(
            self.grid, self.checked, self.conditions, self.columns, only_counts, by_block
        )

    @cached_property
    def staged(self) -> DataFrame:
        """All rows in range with their places, stored."""
        spark = self.grid.sparkSession
        path = scratch_path(spark, "staged")
        with compiled(spark), shuffles_removed(spark):
            projection.placed_rows(self.rows(by_block=True)).write.parquet(path)
        self.is_staged = True
        return spark.read.parquet(path)

    @cached_property
    def ledger(self) -> DataFrame:
        return projection.number_and_label(self.staged, self.columns, self.run_id).drop("bad_fields")

    @property
    def metadata(self) -> DataFrame:
        return projection.load_metadata(self.rows(only_counts=True), self.checked)

    @property
    def bad_values(self) -> DataFrame:
        return projection.bad_values(self.rows())


def normalize_transactions(
    grid: DataFrame, mapping: DataFrame, ledger: Ledger = BASE_LEDGER, run_id: str | None = None
) -> LoadedRun:
    """Load every mapped sheet into the ledger's columns.

    A sheet whose mapping names a column that does not exist, or whose condition is wrong or
    cannot be evaluated for one of its rows, loads no rows and is reported as failed in the
    metadata. Other sheets are not affected. Generated keys hold the run's id, which is new
    for each call unless it is given. Only the mapping is worked on here; see ``LoadedRun``.
    """
    checked, conditions = projection.checked_mapping(projection.prepare_mapping(mapping, grid, ledger))
    return LoadedRun(grid, checked, conditions, ledger, run_id or uuid.uuid4().hex)


def validate_ledger(run: LoadedRun, ledger: Ledger = BASE_LEDGER) -> DataFrame:
    """Issues of every file of a run."""
    return ledger_checks.issues(run.ledger, ledger, run.metadata)
