"""All rows as one stream of characters, which is never built.

A row contributes its *segment*: its text and the separator after it (none after the last row).
Segments in key order, put end to end, are the joined corpus. The corpus *index* gives the place of
every segment: ``row_id, off, n, total``. It is narrow, so the shuffle that numbers it moves no text.
A null text is an empty one: the row is there, and so is its separator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.order import check_keys, key_bounds, prefix_sum
from corpusloom.operators.splits import TRAIN, VALIDATION


def _shape(df: DataFrame, text: str, key: str):
    return df.agg(F.count("*").alias("rows"), F.max(key).alias("last"),
                  F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars")).first()


def segment(last, row_sep: str, text: str = "text", key: str = "row_id") -> Column:
    """The text of a row with its separator; ``last`` is the greatest key."""
    known = F.coalesce(F.col(text), F.lit(""))
    return F.when(F.col(key) == F.lit(last), known).otherwise(F.concat(known, F.lit(row_sep)))


def corpus_length(df: DataFrame, row_sep: str = "\n\n", text: str = "text") -> DataFrame:
    """Characters of the joined corpus, separators included: one row, ``n_rows, n_chars``."""
    rows = F.count("*")
    return df.agg(
        rows.alias("n_rows"),
        (F.coalesce(F.sum(F.length(text)), F.lit(0))
         + F.lit(len(row_sep)) * F.greatest(rows - 1, F.lit(0))).alias("n_chars"))


def corpus_offsets(df: DataFrame, row_sep: str = "\n\n", text: str = "text",
                   key: str = "row_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """The corpus index ``(key, off, n, total)``; ``carry`` names columns to take along. Keys must be
    unique and not null, else it raises."""
    check_keys(df, key)
    shape = _shape(df, text, key)
    total = shape["chars"] + len(row_sep) * max(shape["rows"] - 1, 0)
    width = F.coalesce(F.length(text), F.lit(0)) + F.when(F.col(key) == F.lit(shape["last"]), 0).otherwise(len(row_sep))
    rows = df.select(key, *carry, width.cast("bigint").alias("n"))
    bounds = key_bounds(df.select(key), key, shape["rows"])
    placed = prefix_sum(rows, F.col("n"), key, "off", bounds)
    return placed.select(
        key, "off", "n", F.lit(total).cast("bigint").alias("total"), *carry)


def concat_corpus(df: DataFrame, row_sep: str = "\n\n", text: str = "text",
                  key: str = "row_id") -> DataFrame:
    """The index with the segments as ``text``. Moves the text once; use the index where it will do."""
    last = df.agg(F.max(key)).first()[0]
    placed = corpus_offsets(
        df.withColumn("_segment", segment(last, row_sep, text, key)), row_sep, text, key,
        carry=("_segment",))
    return placed.withColumnRenamed("_segment", "text")


def contiguous_split(stream: DataFrame, fraction: float = 0.9, key: str = "row_id") -> DataFrame:
    """First part of the stream as ``train``, the rest as ``validation``, cut at a character.

    Takes an index (with ``text`` or without). Offsets and totals restart in each part. The row that
    holds the cut becomes two: ``skip`` says how many of its characters belong to the first.
    """
    # Plain double arithmetic, rounded down.
    cut = F.floor(F.lit(float(fraction)) * F.col("total")).cast("bigint")
    off, n = F.col("off"), F.col("n")

    def part(name, skip, size, start, total):
        return F.struct(F.lit(name).alias("split"), skip.cast("bigint").alias("skip"),
                        size.cast("bigint").alias("n"), start.cast("bigint").alias("off"),
                        total.cast("bigint").alias("total"))

    head = part(TRAIN, F.lit(0), F.least(n, cut - off), off, cut)
    tail_skip = F.greatest(F.lit(0), cut - off)
    tail = part(VALIDATION, tail_skip, n - tail_skip, F.greatest(F.lit(0), off - cut),
                F.col("total") - cut)
    parts = (
        F.when(off + n <= cut, F.array(head)).when(off >= cut, F.array(tail))
        .otherwise(F.array(head, tail))
    )
    other = [c for c in stream.columns if c not in (key, "off", "n", "total", "text")]
    keep_text = ["text"] if "text" in stream.columns else []
    out = stream.select(key, F.explode(parts).alias("_p"), "n", *other, *keep_text)
    whole = F.col("_p.n") == F.col("n")
    piece = F.when(whole, F.col("text")).otherwise(
        F.substring(F.col("text"), F.col("_p.skip").cast("int") + 1, F.col("_p.n").cast("int")))
    return out.select(
        "_p.split", key, "_p.skip", "_p.off", "_p.n", "_p.total", *other,
        *([piece.alias("text")] if keep_text else []))


def split_segments(df: DataFrame, index: DataFrame, row_sep: str = "\n\n", fraction: float = 0.9,
                   text: str = "text", key: str = "row_id") -> DataFrame:
    """The segments of each part, ``split, row_id, text``, without moving any text.

    Rows are ordered by key, so the cut is one key and a place inside its row. The index gives both;
    the table is then labelled against constants.
    """
    cut = F.floor(F.lit(float(fraction)) * F.col("total")).cast("bigint")
    hit = (
        index.where((F.col("off") <= cut) & (cut < F.col("off") + F.col("n")))
        .select(F.col(key).alias("at"), (cut - F.col("off")).alias("skip")).first()
    )
    last = index.agg(F.max(key)).first()[0]
    rows = df.select(key, segment(last, row_sep, text, key).alias("text"))
    if hit is None:
        return rows.select(F.lit(TRAIN).alias("split"), key, "text")
    at, skip = F.lit(hit["at"]), int(hit["skip"])
    side = F.when(F.col(key) < at, F.array(F.lit(TRAIN))).when(
        (F.col(key) > at) | F.lit(skip == 0), F.array(F.lit(VALIDATION))).otherwise(
        F.array(F.lit(TRAIN), F.lit(VALIDATION)))
    piece = F.when(F.col(key) != at, F.col("text")).when(
        F.col("split") == TRAIN, F.left("text", F.lit(skip))).otherwise(
        F.substring("text", skip + 1, 2 ** 31 - 1))
    return rows.select(key, F.explode(side).alias("split"), "text").select(
        "split", key, piece.alias("text"))
