"""Random context windows over the joined corpus, without the joined corpus."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from corpusloom.operators.corpus import segment
from corpusloom.operators.order import hash_key, hash_number
from corpusloom.operators.tokens import CharTable, char_table
from corpusloom.session import BROADCAST_ROWS, materialize

# Characters per chunk: rows are looked up and cut by chunks, so a very long row is many small ones.
CHUNK = 8192
# Most files that a scan is narrowed down to; past it all are read.
FILES = 10_000


def draw_starts(totals: DataFrame, n_batches: int, batch_size: int = 32, block_size: int = 256,
                seed: int = 1337) -> DataFrame:
    """Uniform window starts with replacement, per split.

    ``totals`` has one row per split (``split, total``). Starts lie in ``[0, total - block - 2]``,
    so the last token is never a target; when the split is too short every start is 0. A draw is the
    hash of its number, so it does not depend on partitions or retries.
    """
    draws = totals.sparkSession.range(n_batches * batch_size).withColumnRenamed("id", "draw")
    # One row per split, and there are a handful of splits: unrolled per draw, no join.
    rows = totals.select("split", "total").collect()
    splits = F.array(*[
        F.struct(F.lit(r["split"]).alias("split"), F.lit(r["total"]).cast("bigint").alias("total"))
        for r in rows])
    top = F.col("total") - block_size - 1
    digest = hash_key(seed, "split", "draw")
    return (
        draws.select("draw", F.inline(splits))
        .withColumn("start", F.when(top <= 0, F.lit(0).cast("bigint")).otherwise(
            F.pmod(hash_number(digest, 15), top)))
        .select("split", F.floor(F.col("draw") / batch_size).cast("bigint").alias("batch_id"),
                (F.col("draw") % batch_size).cast("int").alias("slot"), "draw", "start")
    )


def _cells(lo, end):
    return F.sequence(F.floor(lo / CHUNK), F.floor((end - 1) / CHUNK))


def sample_windows(stream: DataFrame, texts: DataFrame, n_batches: int, batch_size: int = 32,
                   block_size: int = 256, seed: int = 1337, row_sep: str = "\n\n",
                   vocab: DataFrame | CharTable | None = None, text: str = "text",
                   key: str = "row_id", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``n_batches`` batches of windows per split: ``split, batch_id, slot, start, x, y``.

    ``stream`` is the split corpus index (``contiguous_split``; best a written table, as it is read
    twice), ``texts`` the table it was made from. ``y`` is ``x`` shifted by one. With a character
    vocabulary both are arrays of ids, else text.

    Windows and rows meet in an equi-join on the number of the chunk of the stream they touch. Only
    the pieces found there are cut from the texts; a text is scanned where it lies if the pieces are
    few enough to broadcast (``broadcast_rows``; else it is joined by key, to the same result), and
    of a table of many files only those are read that hold one.
    """
    spark = stream.sparkSession
    totals = stream.groupBy("split").agg(F.max("total").alias("total"))
    width = block_size + 1
    draws = draw_starts(totals, n_batches, batch_size, block_size, seed)
    few = n_batches * batch_size <= broadcast_rows // 8

    # Rows as chunks of at most CHUNK characters, each listed in the (one or two) cells it touches.
    # Chunks start at the segment, not at the split: `chunk` counts from the segment's first character.
    seg_from, seg_to = F.col("skip"), F.col("skip") + F.col("n")
    chunks = (
        stream.where(F.col("n") > 0)
        .select("split", key, "skip", "off", "n", F.explode(_cells(seg_from, seg_to)).alias("chunk"))
        .withColumn("_from", F.greatest(F.col("skip"), F.col("chunk") * CHUNK))
        .withColumn("_to", F.least(seg_to, (F.col("chunk") + 1) * CHUNK))
        .withColumn("_lo", F.col("off") + F.col("_from") - F.col("skip"))
        .withColumn("_end", F.col("_lo") + F.col("_to") - F.col("_from"))
        .select("split", key, "chunk", "_from", "_lo", "_end",
                F.explode(_cells(F.col("_lo"), F.col("_end"))).alias("cell"))
    )
    wanted = draws.withColumn("_stop", F.col("start") + width).select(
        "split", "draw", "start", "_stop",
        F.explode(_cells(F.col("start"), F.col("_stop"))).alias("cell"))
    lo, end = F.greatest("_lo", "start"), F.least("_end", "_stop")
    pieces = (
        chunks.join(F.broadcast(wanted) if few else wanted, ["split", "cell"])
        # A pair that shares two cells counts in the one where the overlap begins.
        .where((lo < end) & (F.floor(lo / CHUNK) == F.col("cell")))
        .select("split", "draw", key, "chunk", (lo - F.col("start")).alias("at"),
                (lo - F.col("_lo") + F.col("_from") - F.col("chunk") * CHUNK).cast("int")
                .alias("cut"),
                (end - lo).cast("int").alias("len"))
    )
    pieces = materialize(pieces, "pieces")
    small = pieces.count() <= broadcast_rows

    last = texts.agg(F.max(key)).first()[0]
    needed = pieces.select(key).distinct()
    texts = _files_with(texts, F.broadcast(needed) if small else needed, key)
    source = texts.select(key, segment(last, row_sep, text, key).alias("_segment")).join(
        F.broadcast(needed) if small else needed, key, "left_semi")
    parts = F.regexp_extract_all("_segment", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    located = source.select(key, F.posexplode(parts).alias("_chunk", "_part")).withColumn(
        "chunk", F.col("_chunk").cast("bigint"))
    cut = located.join(F.broadcast(pieces) if small else pieces, [key, "chunk"]).select(
        "split", "draw", "at",
        F.substring(F.col("_part"), F.col("cut") + 1, F.col("len")).alias("piece"))
    window = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), "")
    # A group has at most `width` pieces: every piece has a character.
    joined = cut.groupBy("split", "draw").agg(window.alias("_w"))
    whole = draws.join(joined, ["split", "draw"], "left").withColumn(
        "_w", F.coalesce("_w", F.lit("")))
    if vocab is None:
        x = F.left("_w", F.lit(block_size))
        y = F.substring("_w", 2, block_size)
    else:
        whole = whole.withColumn("_ids", char_table(vocab).encode(F.col("_w")))
        x, y = shifted_pairs(F.col("_ids"), block_size)
    return whole.select("split", "batch_id", "slot", "start", x.alias("x"), y.alias("y"))


def _files_with(texts: DataFrame, needed: DataFrame, key: str) -> DataFrame:
    """``texts`` without the files that hold none of the needed keys, where it is a scan of files.

    Finds them by the key column alone; the names reach the scan as a filter on its file list.
    """
    try:
        places = texts.select(key, F.col("_metadata.file_path").alias("_file"))
    except AnalysisException:
        return texts
    listed = len(texts.inputFiles())
    if listed < 2:
        return texts
    hit = [r["_file"] for r in places.join(needed, key, "left_semi").select("_file").distinct()
           .limit(FILES + 1).collect()]
    if len(hit) >= min(listed, FILES + 1):
        return texts
    return texts.where(F.col("_metadata.file_path").isin(hit))


def shifted_pairs(ids, block_size: int = 256):
    """Input and target of a run of ids: the targets are one place further on."""
    return F.slice(ids, 1, block_size), F.slice(ids, 2, block_size)
