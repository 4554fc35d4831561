"""Named splits, seeded holdouts and percent slices.

None of these moves a row: a few small jobs over the key column find a cut, and the table itself is
then filtered or labelled against constants (which reach the Parquet scan as pushed filters).
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators.order import (
    below_cutoff, check_keys, hash_cutoff, hash_key, hash_number, hash_rank, key_at,
)

TRAIN, VALIDATION = "train", "validation"

# The names under which a validation split is known, in the order they are looked up.
VALIDATION_NAMES = ("validation", "valid", "val", "dev", "test")


def as_train(df: DataFrame) -> DataFrame:
    """A table without splits is one training split."""
    return df if "split" in df.columns else df.withColumn("split", F.lit(TRAIN))


def present_splits(df: DataFrame, order: list[str] | None = None) -> tuple[set[str], str | None]:
    """Which known split names occur, and the first split in ``order`` (by name if not given).

    One aggregate to a single row over the split column.
    """
    known = (TRAIN, *VALIDATION_NAMES)
    if order:
        listed = F.array(*[F.lit(s) for s in order])
        place = F.array_position(listed, F.col("split"))
        first = F.min_by("split", F.struct(place == 0, place, F.col("split")))
    else:
        first = F.min("split")
    row = df.agg(
        first.alias("first"), *[F.bool_or(F.col("split") == s).alias(s) for s in known]).first()
    return {s for s in known if row[s]}, row["first"]


def ensure_train(df: DataFrame, order: list[str] | None = None, clean: bool = False) -> DataFrame:
    """Without a ``train`` split the first one becomes it and all others go.

    ``clean=True`` keeps the splits that are known as validation data and makes the first of the
    others the training split (all other splits go).
    """
    df = as_train(df)
    present, first = present_splits(df, order)
    if TRAIN in present or first is None:
        return df
    if not clean:
        return df.where(F.col("split") == first).withColumn("split", F.lit(TRAIN))
    other = ~F.col("split").isin(*VALIDATION_NAMES)
    _, first_other = present_splits(df.where(other), order)
    if first_other is None:
        return df.where(F.col("split") == first).withColumn("split", F.lit(TRAIN))
    return df.where(~other | (F.col("split") == first_other)).withColumn(
        "split", F.when(other, TRAIN).otherwise(F.col("split")))


def normalize_validation(df: DataFrame, clean: bool = False,
                         present: set[str] | None = None) -> DataFrame:
    """Rename the validation split to ``validation``.

    The last word has the first of ``valid, val, dev, test`` that occurs, even next to a split
    named ``validation``, which is then lost; only train and validation remain. With no other name
    the table is left as it is. ``clean=True`` prefers a split named ``validation``.
    """
    present = present_splits(df)[0] if present is None else present
    names = [n for n in VALIDATION_NAMES if n in present]
    if not clean:
        names = [n for n in names if n != VALIDATION]
    if not names or names[0] == VALIDATION:
        return df
    return df.where(F.col("split").isin(TRAIN, names[0])).withColumn(
        "split", F.when(F.col("split") == TRAIN, TRAIN).otherwise(VALIDATION))


def holdout_size(rows: int, percent: float) -> int:
    """Rows held out: the percentage rounded up; none of a table with fewer than two rows."""
    if rows < 2 or percent <= 0:
        return 0
    return ceil(Fraction(rows) * Fraction(str(percent)) / 100)


def holdout(df: DataFrame, percent: float = 5.0, seed: int = 42, key: str = "row_id",
            names: tuple[str, ...] = VALIDATION_NAMES) -> DataFrame:
    """Hold out a random part of ``train`` as ``validation``, of an exact size.

    Nothing happens when a split called one of ``names`` exists already, or for percent 0. Keys of
    the training rows must be unique, else it raises.
    """
    if percent <= 0:
        return as_train(df)
    if "split" in df.columns:
        if present_splits(df)[0].intersection(names):
            return df
        train = df.where(F.col("split") == TRAIN)
    else:
        train = df
    df = as_train(df)
    k = holdout_size(check_keys(train, key), percent)
    if k == 0:
        return df
    picked = (F.col("split") == TRAIN) & below_cutoff(hash_cutoff(train, k, seed, key), seed, key)
    return df.withColumn("split", F.when(picked, VALIDATION).otherwise(F.col("split")))


def holdout_threshold(df: DataFrame, percent: float = 5.0, seed: int = 42,
                      key: str = "row_id") -> DataFrame:
    """Hold out by the hash of the key alone: no exact size, no state, also for streams."""
    share = hash_number(hash_key(seed, key), 8) / F.lit(float(2 ** 32))
    picked = share < F.lit(float(percent) / 100.0)
    df = as_train(df)
    return df.withColumn(
        "split",
        F.when((F.col("split") == TRAIN) & picked, VALIDATION).otherwise(F.col("split")))


def slice_bound(rows: int, percent: float) -> int:
    """Row number at a percentage, ties to the even number."""
    return round(Fraction(rows) * Fraction(str(percent)) / 100)


def percent_slice(df: DataFrame, lo: float = 0, hi: float = 100,
                  key: str = "row_id") -> DataFrame:
    """The rows from ``lo`` to ``hi`` percent of the table in key order.

    The two border keys are found first; the table is then read with a plain filter on the key. Keys
    must be unique and not null, else it raises.
    """
    if not 0 <= lo <= hi <= 100:
        raise ValueError("percentages must be ordered and within 0 and 100")
    rows = check_keys(df, key)
    first, end = slice_bound(rows, lo), slice_bound(rows, hi)
    if first >= end:
        return df.where(F.lit(False))
    low, high = key_at(df, [first, end], key, rows)
    if first > 0:
        df = df.where(F.col(key) >= F.lit(low))
    if end < rows:
        df = df.where(F.col(key) < F.lit(high))
    return df


def shuffle_epochs(df: DataFrame, epochs: int = 2, seed: int = 42, key: str = "row_id",
                   out: str = "pos") -> DataFrame:
    """Every row once per epoch, with its place in that epoch's random order."""
    repeated = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return hash_rank(repeated, hash_key(seed, "epoch", key), key, ["epoch"], out, epochs)
