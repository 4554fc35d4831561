"""Keyed permutations of row numbers, by their laws and against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.permute import (
    ROUNDS, grid, place_of_row, row_at_place, shuffled_part)


def plain_place(row, rows, epoch, seed):
    width, height = grid(rows)
    while True:
        x, y = divmod(row, height)
        for r in range(ROUNDS):
            kept = y if r % 2 == 0 else x
            by = int(hashlib.md5(f"{seed}|{epoch}|{r}|{kept}".encode()).hexdigest()[:15], 16)
            if r % 2 == 0:
                x = (x + by % width) % width
            else:
                y = (y + by % height) % height
        row = x * height + y
        if row < rows:
            return row


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 97, 1000])
def test_permutation_and_back(spark, rows):
    found = spark.range(rows).select(
        "id", place_of_row("id", rows, 3, 5).alias("place")).withColumn(
        "back", row_at_place("place", rows, 3, 5)).collect()
    assert sorted(r["place"] for r in found) == list(range(rows))
    assert all(r["back"] == r["id"] for r in found)
    assert all(r["place"] == plain_place(r["id"], rows, 3, 5) for r in found)


def test_grid_is_close():
    for rows in (1, 2, 5, 101, 10 ** 6 + 3, 10 ** 12 + 39):
        width, height = grid(rows)
        assert 0 <= width * height - rows <= 16


def test_epochs_differ_and_parts_agree(spark):
    df = spark.range(300).withColumnRenamed("id", "row_id").withColumn("v", F.col("row_id") * 2)
    whole = {r["pos"]: r["row_id"] for r in shuffled_part(df, 300, 0, 300, 1).collect()}
    other = {r["pos"]: r["row_id"] for r in shuffled_part(df, 300, 0, 300, 2).collect()}
    assert len(whole) == 300 and whole != other
    part = shuffled_part(df, 300, 120, 180, 1)
    assert part.columns == ["row_id", "v", "pos"]
    assert {r["pos"]: r["row_id"] for r in part.collect()} == {
        p: r for p, r in whole.items() if 120 <= p < 180}
    assert shuffled_part(df, 300, 300, 400).count() == 0
