"""Shuffles that can be entered anywhere: a keyed permutation of dense row numbers.

The place of a row in an epoch is a function of its number, and the other way round, so nothing is
ranked, sorted or stored; a run that was broken off goes on at any place of any epoch.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.order import hash_key, hash_number
from corpusloom.session import BROADCAST_ROWS

ROUNDS = 6
# Widths of the grid that are tried, below the root of the number of rows.
WIDTHS = 1 << 18


def grid(rows: int) -> tuple[int, int]:
    """Width and height of a grid with ``rows`` cells or the fewest more that can be found."""
    if rows < 1:
        raise ValueError("a permutation needs at least one row")
    root = isqrt(rows)
    widths = np.arange(max(1, root - min(WIDTHS, root // 2)), root + 1, dtype=np.int64)
    spare = -rows % widths
    width = int(widths[len(widths) - 1 - int(np.argmin(spare[::-1]))])
    return width, -(-rows // width)


def _shift(half: Column, r: int, epoch: Column, seed: int) -> Column:
    return hash_number(hash_key(seed, epoch, F.lit(r), half), 15)


def _step(value: Column, width: int, height: int, epoch: Column, seed: int,
          forward: bool) -> Column:
    """One pass over the cells: column and row of the grid move each other in turn."""
    def moved(r: int, halves: Column) -> Column:
        size = F.lit(width if r % 2 == 0 else height)
        changed, kept = ("x", "y") if r % 2 == 0 else ("y", "x")
        by = _shift(halves[kept], r, epoch, seed) % size
        new = F.pmod(halves[changed] + (by if forward else -by), size).alias(changed)
        same = halves[kept].alias(kept)
        return F.struct(new, same) if changed == "x" else F.struct(same, new)

    start = F.struct(F.expr("0L").alias("x"), F.expr("0L").alias("y"))
    cell = F.struct(((value - value % height) / height).cast("bigint").alias("x"),
                    (value % height).alias("y"))
    # A fold evaluates each round once; nested expressions would double with every round.
    rounds = range(ROUNDS) if forward else range(ROUNDS - 1, -1, -1)
    steps = F.array(*[F.lit(r) for r in rounds])

    def turn(halves: Column, at: Column) -> Column:
        chosen = F.when(at == 0, moved(0, halves))
        for r in range(1, ROUNDS):
            chosen = chosen.when(at == r, moved(r, halves))
        return F.coalesce(chosen, start)
    return F.aggregate(steps, cell, turn, lambda c: c["x"] * height + c["y"])


def _permuted(value: Column | str, rows: int, epoch: Column | int, seed: int,
              forward: bool) -> Column:
    width, height = grid(rows)
    value = (F.col(value) if isinstance(value, str) else value).cast("bigint")
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    first = _step(value, width, height, epoch, seed, forward)
    spare = width * height - rows
    if spare == 0:
        return first
    # Beyond the last row: go on. No spare cell is met twice, so as many steps are enough.
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(spare)), first, lambda at, _: F.when(
            at >= rows, _step(at, width, height, epoch, seed, forward)).otherwise(at))


def place_of_row(row: Column | str, rows: int, epoch: Column | int = 0, seed: int = 42) -> Column:
    """The place (from 0) of row number ``row`` of ``rows`` in the shuffle of an epoch."""
    return _permuted(row, rows, epoch, seed, forward=True)


def row_at_place(place: Column | str, rows: int, epoch: Column | int = 0, seed: int = 42) -> Column:
    """The number of the row at a place: the other way round of :func:`place_of_row`."""
    return _permuted(place, rows, epoch, seed, forward=False)


def shuffled_part(df: DataFrame, rows: int, lo: int, hi: int, epoch: int = 0, seed: int = 42,
                  key: str = "row_id", out: str = "pos") -> DataFrame:
    """The rows of ``df`` at the places from ``lo`` to below ``hi`` of an epoch, with their places.

    ``key`` numbers the rows from 0 without gaps. A part that is small beside the table is found
    from its places, so that the other rows are left at the scan; else all places are worked out.
    """
    lo, hi = max(lo, 0), min(hi, rows)
    if hi <= lo:
        return df.where(F.lit(False)).withColumn(out, F.lit(None).cast("bigint"))
    if hi - lo > min(BROADCAST_ROWS, rows // 2):
        place = place_of_row(key, rows, epoch, seed)
        return df.withColumn(out, place).where(F.col(out).between(lo, hi - 1))
    wanted = df.sparkSession.range(lo, hi).select(
        F.col("id").alias(out), row_at_place("id", rows, epoch, seed).alias(key))
    return df.join(F.broadcast(wanted), key).select(*df.columns, out)
