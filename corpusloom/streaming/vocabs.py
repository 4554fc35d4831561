"""Vocabularies that grow with a stream, with ids that never change.

The dictionary is append-only: a trigger adds the words that have become frequent, numbered after
all earlier ones, as a new version; an id means the same word in every version that has it. How
often words stood is kept in a summary of bounded size (Misra-Gries): what a trigger counted is added
to it, and if more words than ``counters`` are left, the count of the first one too many is taken off
all. A kept count is then at most the true one, and below it by no more than what was taken off in
all, which is at most the words of the stream divided by ``counters + 1``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusloom.operators.tokens import (
    PAD, UNKNOWN, build_char_vocab, encode_chars, encode_words, number_words, word_counts,
)
from corpusloom.session import drop_path
from corpusloom.sources.folders import is_whole, trigger_name, whole_triggers

MARK = "size int, taken_off bigint, seen bigint"
WORDS, SUMMARY = "token string, id int", "token string, n bigint"


def taken_off(counts: DataFrame, counters: int) -> int:
    """The count of the first word too many, 0 if all fit (``counts``: ``token, n``)."""
    if counts.count() <= counters:
        return 0
    falling = Window.orderBy(F.desc("n"))
    # A row for each different count, so the window is over few rows however many words there are.
    upto = counts.groupBy("n").agg(F.count("*").alias("_words")).withColumn(
        "_upto", F.sum("_words").over(falling))
    return upto.where(F.col("_upto") > counters).agg(F.max("n")).first()[0]


def _tables(spark: SparkSession, path: str, kind: str, names: list[str], schema: str) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{kind}/{name}" for name in names])


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_vocab_stream(df: DataFrame, path: str, checkpoint: str, units: str = "words",
                       min_count: int = 1, counters: int = 10_000_000,
                       max_size: int = 2 ** 31 - 1, text: str = "text", key: str | None = None,
                       specials: tuple[str, ...] = (PAD, "</s>", UNKNOWN),
                       eos: str | None = None, wait: bool = True):
    """Let a vocabulary grow with a stream; with ``key`` the rows are encoded too.

    ``units="words"``: a word gets in, after the specials and in the order of its count and itself,
    with the trigger at whose end its kept count has come to ``min_count``, as long as there is room.
    ``units="chars"``: every character gets in with the first trigger that has it, in the order of
    code points; the specials and counts are not used.

    A row is encoded by the version of its own trigger, and says so: a word that is not in it (yet)
    is the unknown one. The vocabulary is joined, so it may have any size. Null texts have no words.
    A trigger that was broken off is written anew, a whole one is left as it is; a later call with
    the same checkpoint goes on.
    """
    if units not in ("words", "chars"):
        raise ValueError("units must be 'words' or 'chars'")

    def add(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, trigger_name(batch_id)
        if is_whole(spark, f"{path}/marks/{name}"):
            return
        earlier = [n for n in whole_triggers(spark, f"{path}/marks") if n < name]
        mark = spark.read.schema(MARK).parquet(
            f"{path}/marks/{earlier[-1]}").first().asDict() if earlier else None
        known = _tables(spark, path, "words", earlier, WORDS)
        if units == "chars":
            mark = mark or {"size": 0, "taken_off": 0, "seen": 0}
            found = build_char_vocab(batch, text, extra=eos or "").select(F.col("ch").alias("token"))
            # At most one row for each character that there is.
            new = found.join(known, "token", "left_anti").select("token", (F.row_number().over(
                Window.orderBy("token")) - 1 + mark["size"]).cast("int").alias("id"))
        else:
            start = mark is None
            mark = mark or {"size": len(specials), "taken_off": 0, "seen": 0}
            counted = _write(word_counts(batch, text, eos), f"{path}/staged/{name}/counts")
            counted = counted.where(~F.col("token").isin(*specials))
            mark["seen"] += counted.agg(F.sum("n")).first()[0] or 0
            merged = _write(counted.union(_tables(
                spark, path, "summary", earlier[-1:], SUMMARY)).groupBy("token").agg(
                F.sum("n").alias("n")), f"{path}/staged/{name}/merged")
            off = taken_off(merged, counters)
            mark["taken_off"] += off
            kept = _write(merged.select("token", (F.col("n") - off).alias("n")).where("n > 0"),
                          f"{path}/summary/{name}")
            fresh = _write(kept.where(F.col("n") >= min_count).join(known, "token", "left_anti"),
                           f"{path}/staged/{name}/fresh")
            new = number_words(fresh, max_size - mark["size"], mark["size"]).select("token", "id")
            if start and specials:
                new = new.union(spark.range(1).select(F.posexplode(F.array(
                    *[F.lit(s) for s in specials])).alias("id", "token")).select("token", "id"))
        new = _write(new, f"{path}/words/{name}")
        mark["size"] = max(mark["size"], (new.agg(F.max("id")).first()[0] or 0) + 1) if new.head(
            1) else mark["size"]
        if key is not None:
            version = known.union(new)
            keep = tuple(c for c in ("split",) if c in batch.columns)
            if units == "chars":
                coded = encode_chars(batch, version.withColumnRenamed("token", "ch"), text).select(
                    key, *keep, "ids")
            else:
                coded = encode_words(batch, version, text, key, keep=keep, eos=eos)
            coded.withColumn("version", F.lit(batch_id).cast("bigint")).write.mode(
                "overwrite").parquet(f"{path}/ids/{name}")
        spark.createDataFrame([(mark["size"], mark["taken_off"], mark["seen"])], MARK).coalesce(
            1).write.mode("overwrite").parquet(f"{path}/marks/{name}")
        drop_path(spark, f"{path}/staged/{name}")
        if len(earlier) > 1:
            drop_path(spark, f"{path}/summary/{earlier[-2]}")

    query = df.writeStream.foreachBatch(add).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def _done(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    done = [n for n in whole_triggers(spark, f"{path}/marks")
            if version is None or n <= trigger_name(version)]
    if not done:
        raise FileNotFoundError(f"no vocabulary in {path} yet")
    return done


def read_vocab_stream(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The dictionary, the latest or as it was at the end of a trigger: ``token, id``."""
    return _tables(spark, path, "words", _done(spark, path, version), WORDS)


def read_vocab_ids(spark: SparkSession, path: str) -> DataFrame:
    """The rows that were encoded, with the version that did it."""
    return spark.read.parquet(*[f"{path}/ids/{name}" for name in _done(spark, path)])


def read_heavy_hitters(spark: SparkSession, path: str, share: float = 0.0) -> DataFrame:
    """Words that may be at least ``share`` of all: ``token, n, n_most``.

    The true count lies between the two. Every word above ``n_most - n`` is in the summary, so none
    with that share is missing while ``share`` of all words is above it.
    """
    last = _done(spark, path)[-1]
    mark = spark.read.schema(MARK).parquet(f"{path}/marks/{last}").first()
    most = F.col("n") + F.lit(mark["taken_off"])
    return _tables(spark, path, "summary", [last], SUMMARY).withColumn("n_most", most).where(
        F.col("n_most") >= share * mark["seen"])
