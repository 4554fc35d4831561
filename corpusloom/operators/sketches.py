"""Statistics that can be merged, so that none needs the corpus again.

Lengths are counted in cells: a number keeps its ``bits`` leading binary digits. There are at most
``2 ** bits + 2 ** (bits - 1) * (63 - bits)`` cells however many rows there are, counts of cells add
up, and a quantile is known up to its cell: exact below ``2 ** bits``, else within a share of
``2 ** (1 - bits)``. Different values are counted by Spark's HyperLogLog sketches, which merge too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.operators.counts import QUANTILES
from corpusloom.operators.tokens import pieces, words

#: Leading binary digits of a length that are kept; registers of a distinct sketch as a power of two.
BITS, LG_K = 8, 12


def _dropped(n: Column, bits: int) -> Column:
    return F.greatest(F.length(F.bin(n)) - bits, F.lit(0))


def cell_of(n: Column, bits: int = BITS) -> Column:
    """The least number of the cell of a number that is not negative."""
    e = _dropped(n, bits)
    return F.call_function("shiftleft", F.call_function("shiftright", n, e), e)


def cell_end(cell: Column, bits: int = BITS) -> Column:
    """The greatest number of a cell."""
    one = F.lit(1).cast("bigint")
    return cell + F.call_function("shiftleft", one, _dropped(cell, bits)) - 1


def n_words(text: Column, eos: str | None = None) -> Column:
    """How many words a text has; none if it is null."""
    counted = F.aggregate(pieces(text), F.lit(0).cast("bigint"),
                          lambda n, piece: n + F.size(words(piece, eos)))
    return F.coalesce(counted, F.lit(0).cast("bigint"))


def length_sketch(df: DataFrame, size: Column, by: tuple[str, ...] = ("split",),
                  bits: int = BITS) -> DataFrame:
    """``by, cell, n_rows, n_tokens``: rows and the sum of their sizes for each cell. Null is 0."""
    n = F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))
    return df.select(*by, n.alias("_n")).groupBy(*by, cell_of(F.col("_n"), bits).alias("cell")).agg(
        F.count("*").alias("n_rows"), F.sum("_n").alias("n_tokens"))


def merge_lengths(sketch: DataFrame, by: tuple[str, ...] = ("split",)) -> DataFrame:
    """Sketches one below the other as one; fewer columns ``by`` are coarser groups."""
    return sketch.groupBy(*by, "cell").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"))


def distinct_sketch(df: DataFrame, value: Column, by: tuple[str, ...] = ("split",),
                    lg_k: int = LG_K) -> DataFrame:
    """``by, sketch`` over the values that are not null, combined before the shuffle."""
    return df.select(*by, value.alias("_value")).groupBy(*by).agg(
        F.hll_sketch_agg("_value", F.lit(lg_k)).alias("sketch"))


def merge_distinct(sketch: DataFrame, by: tuple[str, ...] = ("split",)) -> DataFrame:
    return sketch.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def word_rows(df: DataFrame, text: str = "text", by: tuple[str, ...] = ("split",),
              eos: str | None = None) -> DataFrame:
    """``by, token``: a row for each word; a text without words is one row without token."""
    return df.select(*by, F.explode_outer(pieces(F.col(text))).alias("_piece")).select(
        *by, F.explode_outer(words(F.col("_piece"), eos)).alias("token"))


def sketch_stats(lengths: DataFrame, distinct: DataFrame | None = None,
                 by: tuple[str, ...] = ("split",), bits: int = BITS,
                 quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Rows, tokens, and of each quantile and the longest row the least and the greatest value that
    it can have (``p50_least, p50_most``); with ``distinct`` the estimate ``n_distinct``."""
    cells = merge_lengths(lengths, by)
    here = Window.partitionBy(*by)
    placed = cells.withColumns({
        "_upto": F.sum("n_rows").over(here.orderBy("cell").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)),
        "_total": F.sum("n_rows").over(here)})
    at = {f"p{round(q * 100)}": F.min(F.when(
        F.col("_upto") >= F.ceil(F.col("_total") * F.lit(q)), F.col("cell"))) for q in quantiles}
    at["longest"] = F.max("cell")
    out = placed.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"),
        *[c.alias(f"{name}_least") for name, c in at.items()])
    out = out.withColumns({f"{name}_most": cell_end(F.col(f"{name}_least"), bits) for name in at})
    if distinct is None:
        return out
    counted = merge_distinct(distinct, by).select(
        *by, F.hll_sketch_estimate("sketch").alias("n_distinct"))
    # One row of each kind a group, so no join is needed.
    values = [c for c in out.columns if c not in by] + ["n_distinct"]
    return out.unionByName(counted, allowMissingColumns=True).groupBy(*by).agg(
        *[F.max(c).alias(c) for c in values]).where(F.col("n_rows").isNotNull())
