"""Hard negatives: exact integer scores by Strassen's multiplication, best ones by heaps."""

from __future__ import annotations

from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusloom.session import materialize, scratch_path, spread

#: Components of the anchors that tasks hold at a time (32 MB), and the sides of a tile.
COMPONENTS, ANCHOR_TILE, ROW_TILE = 4_194_304, 256, 1024
#: Below this side tiles are multiplied directly.
DIRECT = 24
NONE = np.iinfo(np.int64).min

# --- multiplication ------------------------------------------------------------------------------


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 tiles by seven products of quarters; sides are padded to even with zeros.

    Sums wrap around modulo 2**64 like the products, so the result is exact whenever it fits itself.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= DIRECT:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    p, q, r = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:p, :q], a[:p, q:], a[p:, :q], a[p:, q:]
    b11, b12, b21, b22 = b[:q, :r], b[:q, r:], b[q:, :r], b[q:, r:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    c = np.empty((2 * p, 2 * r), np.int64)
    c[:p, :r] = m1 + m4 - m5 + m7
    c[:p, r:] = m3 + m5
    c[p:, :r] = m2 + m4
    c[p:, r:] = m1 - m2 + m3 + m6
    return c[:m, :n]


# --- heaps ---------------------------------------------------------------------------------------

class Heaps:
    """The best ``size`` entries of many lists, a heap each with the worst entry on top.

    An entry is (score, -identifier, -row): more score is better, then the lesser of the others.
    """

    def __init__(self, lists: int, size: int):
        self.size = size
        self.heaps: list[list] = [[] for _ in range(lists)]
        #: Score below which a list takes nothing more.
        self.least = np.full(lists, NONE)

    def push(self, scores: np.ndarray, fits: np.ndarray, ids: list, rows: list) -> None:
        """Offer a tile: a row of ``scores`` for each list, of which ``fits`` may enter. Columns come
        by identifier and row, so that of equal scores the first ones are better."""
        fits &= scores >= self.least[:, None]
        most = fits.sum(axis=1)
        crowded = np.flatnonzero(most > 4 * self.size)
        if len(crowded):  # only what is among the best of its own tile can stay
            own = np.where(fits[crowded], scores[crowded], NONE)
            edge = np.partition(own, -self.size, axis=1)[:, -self.size]
            tied = own == edge[:, None]
            fits[crowded] &= (own > edge[:, None]) | (tied & (tied.cumsum(axis=1) <= self.size))
        where, column = np.nonzero(fits)
        for i, j, score in zip(where.tolist(), column.tolist(), scores[where, column].tolist()):
            heap, entry = self.heaps[i], (score, -ids[j], -rows[j])
            if len(heap) < self.size:
                heappush(heap, entry)
            elif entry > heap[0]:
                heapreplace(heap, entry)
        for i in np.unique(where).tolist():
            if len(self.heaps[i]) == self.size:
                self.least[i] = self.heaps[i][0][0]

    def entries(self):
        for i, heap in enumerate(self.heaps):
            for score, id_, row in heap:
                yield i, score, -id_, -row


# --- on tables -----------------------------------------------------------------------------------

#: An entry of a list: its score, the identifier and the number of its row.
ENTRY = StructType([StructField("list", LongType()), StructField("score", LongType()),
                    StructField("id", LongType()), StructField("row", LongType())])
UNNAMED = 1 << 63  # rows without an identifier come after all others


def usable_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int,
                relabel: int | None, classes: int) -> DataFrame:
    """``_row, _id, _label, _vec``: rows that take part, components as ``floor(scale * x)``."""
    label = F.col("_label").cast("long")
    if relabel:
        label = F.when(F.col("_id") % relabel == 0, (label + 1) % classes).otherwise(label)
    finite = F.forall("_vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return (
        df.select(F.monotonically_increasing_id().alias("_row"),
                  F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_label"),
                  F.col(vector_col).cast("array<double>").alias("_vec"))
        .where(F.col("_label").isNotNull() & F.col("_vec").isNotNull() & finite)
        .select("_row", "_id", label.alias("_label"),
                F.transform("_vec", lambda x: F.floor(x * float(scale))).alias("_vec")))


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``dim`` components, zeros behind shorter ones."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _best(rows: DataFrame, chunk, dim: int, size: int, levels: int, fits) -> DataFrame:
    """The best ``size`` rows of every list, as :data:`ENTRY` with ``place`` from 1.

    Every anchor of the chunk has ``levels`` lists; ``fits(shared, tile, k, scores, labels, numbers)``
    says which scores of a tile may enter the k-th. A task keeps its own heaps while rows pass by in
    tiles; their entries then meet per list, of which every task sends ``size`` at most.
    """
    def run(batches):
        shared = chunk.value
        anchors = shared["vectors"]
        n = len(anchors)
        heaps = [[Heaps(min(ANCHOR_TILE, n - at), size) for at in range(0, n, ANCHOR_TILE)]
                 for _ in range(levels)]
        for batch in batches:
            for at in range(0, batch.num_rows, ROW_TILE):
                part = batch.slice(at, ROW_TILE)
                part = part.take(pc.sort_indices(part, [("_id", "ascending"), ("_row", "ascending")]))
                numbers, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
                ids = [UNNAMED if v is None else v for v in part.column(1).to_pylist()]
                listed = numbers.tolist()
                right = np.ascontiguousarray(matrix(part.column(3), dim).T)
                for t in range(len(heaps[0])):
                    tile = slice(t * ANCHOR_TILE, min(n, (t + 1) * ANCHOR_TILE))
                    scores = strassen(anchors[tile], right)
                    for k in range(levels):
                        heaps[k][t].push(scores, fits(shared, tile, k, scores, labels, numbers),
                                         ids, listed)
        for k in range(levels):
            for t, held in enumerate(heaps[k]):
                found = [((t * ANCHOR_TILE + i) * levels + k, score,
                          None if id_ == UNNAMED else id_, row)
                         for i, score, id_, row in held.entries()]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found)], ENTRY.names)

    order = Window.partitionBy("list").orderBy(
        F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return rows.mapInArrow(run, ENTRY).withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= size)


def _same_label(shared, tile, k, scores, labels, numbers):
    return (shared["labels"][tile, None] == labels) & (shared["rows"][tile, None] != numbers)


def _other_label_in_window(shared, tile, k, scores, labels, numbers):
    return ((shared["labels"][tile, None] != labels) & (scores >= shared["low"][tile, k, None])
            & (scores <= shared["high"][tile, k, None]))


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", every: int = 100, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
                   relabel: int | None = None, classes: int = 10,
                   chunk_anchors: int = 8192) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is a multiple of ``every``. A score is the inner product of the
    components ``floor(scale * x)``; more is better, then the lesser id, nulls last, then the row
    that comes first. An anchor's positives are its best other rows of the same label; for each, the
    negatives are the best rows of other labels whose score is ``low`` to ``high`` percent of the
    positive's. ``relabel`` moves the label of every so many ids on by one, modulo ``classes``.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Shorter
    vectors count as if they went on with zeros; repeated ids are rows of their own, and two anchors
    where both are. Scores that a long may not hold raise. An empty table, or one without anchors,
    gives no rows. Anchors go to the tasks in chunks of ``chunk_anchors`` (or fewer long ones), one
    scan of the rows for the positives and one for the negatives each.
    """
    spark = df.sparkSession
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    rows = materialize(usable_rows(spread(df.select(id_col, vector_col, label_col)), id_col,
                                   vector_col, label_col, scale, relabel, classes), "vectors")
    shape = rows.agg(
        F.max(F.size("_vec")).alias("dim"), F.max(F.array_max("_vec")).alias("most"),
        F.min(F.array_min("_vec")).alias("least"),
        F.count_if(F.col("_id") % every == 0).alias("anchors")).first()
    if not shape["anchors"]:
        return spark.createDataFrame([], schema)
    dim = shape["dim"]
    if dim * max(abs(shape["most"] or 0), abs(shape["least"] or 0)) ** 2 >= 1 << 63:
        raise ValueError("inner products of these vectors may not fit a long")
    anchors = materialize(rows.where(F.col("_id") % every == 0), "anchors")
    room = max(1, min(chunk_anchors, COMPONENTS // max(1, dim)))
    chunks = -(-shape["anchors"] // room)
    found = scratch_path(spark, "negatives")
    for c in range(chunks):
        table = anchors.where(F.pmod(F.xxhash64("_row"), F.lit(chunks)) == c).toArrow()
        if not table.num_rows:
            continue
        held = {"rows": table["_row"].to_numpy(), "labels": table["_label"].to_numpy(),
                "vectors": matrix(table["_vec"].combine_chunks(), dim)}
        ids = table["_id"].to_pylist()
        chunk = spark.sparkContext.broadcast(held)
        best = _best(rows, chunk, dim, positives, 1, _same_label).collect()
        chunk.unpersist()
        # A list of an anchor that has no such positive takes nothing: its window is empty.
        window = {k: np.full((len(ids), positives), v) for k, v in (("low", 1), ("high", 0))}
        lists = []
        for r in best:
            i, k = r["list"], r["place"] - 1
            window["low"][i, k] = -(-low * r["score"] // 100)
            window["high"][i, k] = high * r["score"] // 100
            lists.append((i * positives + k, ids[i], r["id"], r["score"]))
        if not lists:
            continue
        chunk = spark.sparkContext.broadcast(held | window)
        names = spark.createDataFrame(
            lists, "list long, anchor_id long, positive_id long, positive_score long")
        _best(rows, chunk, dim, negatives, positives, _other_label_in_window).join(
            F.broadcast(names), "list").select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias(
                "negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(found)
        chunk.unpersist()
    spark.createDataFrame([], schema).write.mode("append").parquet(found)
    return spark.read.schema(schema).parquet(found)
