"""How rows are laid out over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster_for_write(
    df: DataFrame, keys: Sequence[str], width: int | None = None, *, salt: int = 1, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Bring the rows of a partition folder together, in at most ``salt`` files each.

    ``width`` tasks write; without it, as many as the session shuffles to. One hash
    of the keys puts a whole hour on one task, so an hour that outgrows a task needs
    ``salt`` > 1, which splits it by the hash of ``spread_by``. That is a hash rather
    than a random number, so that a retried task writes the same rows.
    """
    columns = [F.col(k) for k in keys]
    if salt > 1:
        columns.append(F.pmod(F.xxhash64(*spread_by), F.lit(salt)))
    return df.repartition(width, *columns) if width else df.repartition(*columns)


def tasks_for(rows: int, rows_per_file: int, most: int) -> int:
    """How many tasks share an hour that gets so many rows, so that a file holds between half of ``rows_per_file`` and all of it."""
    return max(1, min(most, -(-rows // rows_per_file)))


def balance_for_write(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The adaptive form, for batches and stateless streams: files are sized at run
    time, splitting a hot hour and merging thin ones.

    In a batch, ``order`` sorts the rows of each file, so that a scan for one house
    skips row groups by their statistics.
    """
    balanced = df.hint("rebalance", *keys)
    return balanced.sortWithinPartitions(*keys, *order) if order else balanced
