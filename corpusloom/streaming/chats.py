"""Conversations from a stream of turns: sessions in event time, late turns in a table of their own.

The watermark is the latest time seen less the delay. A session ends when no turn follows within the
gap; it is written as one conversation once the watermark has passed its end. A turn from before the
watermark is late and is written apart. So the sessions are exactly those of all turns that were not
late, whatever the triggers were: what is closed ended before the watermark, and no later turn that
is taken begins before it.

Every trigger writes the conversations it closed, its late turns and the turns that are still open,
then its mark; only whole triggers are read. A turn is rewritten while its session is open, that is
for about the delay and the gap, and never again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusloom.operators.rendering import TURNS_PER_PART, assemble_conversations
from corpusloom.session import drop_path
from corpusloom.sources.folders import is_whole, trigger_name, whole_triggers

#: Seconds of a key's time that one task puts in order, in gaps.
SLOT_GAPS = 256
MICROS = 1_000_000


def with_sessions(turns: DataFrame, key: str, time: str, gap: float,
                  start: str = "start") -> DataFrame:
    """Every turn with the time at which its session began.

    A session is a run of turns of a key, each less than ``gap`` seconds after the one before. Turns
    are put in order within slots of time, so a key with very many turns is many tasks; where a slot
    goes on with a session of an earlier one is told by one narrow row a slot. Key and time must not
    be null.
    """
    gap = int(gap * MICROS)
    slots = turns.withColumn("_at", F.unix_micros(time)).withColumn(
        "_slot", F.floor(F.col("_at") / F.lit(SLOT_GAPS * gap)))
    inside = Window.partitionBy(key, "_slot").orderBy("_at")
    before = F.lag("_at").over(inside)
    broken = slots.withColumn("_break", F.when(F.col("_at") - before >= gap, F.col("_at")))
    along = Window.partitionBy(key).orderBy("_slot")
    ends = F.lag("_last").over(along)
    first = F.when(ends.isNull() | (F.col("_first") - ends >= gap), F.col("_first"))
    carried = (
        broken.groupBy(key, "_slot").agg(
            F.min("_at").alias("_first"), F.max("_at").alias("_last"),
            F.max("_break").alias("_break"))
        .withColumn("_fresh", first)
        .withColumn("_open", F.last(F.coalesce("_break", "_fresh"), True).over(
            along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .select(key, "_slot", F.coalesce("_fresh", F.lag("_open").over(along)).alias("_begin")))
    here = F.last("_break", True).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return broken.withColumn("_here", here).join(carried, [key, "_slot"]).withColumn(
        start, F.timestamp_micros(F.coalesce("_here", "_begin"))).select(*turns.columns, start)


def write_chat_stream(df: DataFrame, path: str, checkpoint: str, key: str, order: str, time: str,
                      role: str = "role", text: str = "text", gap: float = 1800,
                      delay: float = 600, turns_per_part: int = TURNS_PER_PART, wait: bool = True):
    """Put the turns that arrive together to conversations, for :func:`read_chat_stream`.

    ``gap`` and ``delay`` are seconds, ``time`` is a timestamp. Messages stand in the order of
    ``order``, turns of equal order as their role and text sort. Turns without key or time belong
    nowhere and are written with the late ones. A trigger that comes again after a break is written
    anew if it was not whole, and left as it is if it was; a later call with the same checkpoint goes
    on.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, trigger_name(batch_id)
        if is_whole(spark, f"{path}/marks/{name}"):
            return
        earlier = [n for n in whole_triggers(spark, f"{path}/marks") if n < name]
        old = spark.read.parquet(f"{path}/marks/{earlier[-1]}").first()["top"] if earlier else None
        at = F.unix_micros(time)
        line = None if old is None else old - int(delay * MICROS)
        late = F.col(key).isNull() | at.isNull()
        if line is not None:
            late = late | (at < line)
        turns = batch.select(key, order, time, role, text)
        turns.where(late).write.mode("overwrite").parquet(f"{path}/late/{name}")
        fresh = turns.where(~late)
        if earlier:
            fresh = fresh.unionByName(spark.read.parquet(f"{path}/open/{earlier[-1]}"))
        # Sessions are found once; what is closed and what is open are read from there.
        staged = f"{path}/staged/{name}"
        with_sessions(fresh, key, time, gap).write.mode("overwrite").parquet(staged)
        found = spark.read.parquet(staged)
        new = found.agg(F.max(F.unix_micros(time))).first()[0]
        top = max((t for t in (old, new) if t is not None), default=None)
        if top is None:
            closed, still = found, found
        else:
            # Of a key's sessions only the last ones can be open, and at most one row a key says which.
            passed = top - int(delay * MICROS) - int(gap * MICROS)
            since = found.groupBy(key, "start").agg(F.max(F.unix_micros(time)).alias("_last")).where(
                F.col("_last") > passed).groupBy(key).agg(F.min("start").alias("_since"))
            marked = found.join(since, key, "left").withColumn("_stays", F.coalesce(
                F.col("start") >= F.col("_since"), F.lit(False)))
            closed, still = marked.where("not _stays"), marked.where("_stays")
        _assembled(closed, key, order, role, text, turns_per_part).write.mode(
            "overwrite").parquet(f"{path}/chats/{name}")
        still.select(turns.columns).write.mode("overwrite").parquet(f"{path}/open/{name}")
        spark.createDataFrame([(top,)], "top bigint").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/marks/{name}")
        drop_path(spark, staged)
        if len(earlier) > 1:
            # A reader that looks now still finds the open turns of the trigger before.
            drop_path(spark, f"{path}/open/{earlier[-2]}")

    query = df.writeStream.foreachBatch(add).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def _assembled(turns: DataFrame, key: str, order: str, role: str, text: str,
               turns_per_part: int) -> DataFrame:
    chat = turns.withColumn("_chat", F.struct(F.col(key), F.col("start")))
    return assemble_conversations(chat, "_chat", order, role, text,
                                  turns_per_part=turns_per_part).select("_chat.*", "messages")


def read_chat_stream(spark: SparkSession, path: str, key: str, order: str, time: str,
                     role: str = "role", text: str = "text", gap: float = 1800,
                     open_too: bool = False,
                     turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """The conversations that are closed: ``key, start, messages``.

    ``open_too=True`` adds those still open as they are, as at the end of a stream.
    """
    done = whole_triggers(spark, f"{path}/marks")
    if not done:
        raise FileNotFoundError(f"no conversations in {path} yet")
    chats = spark.read.parquet(*[f"{path}/chats/{name}" for name in done])
    if not open_too:
        return chats
    still = with_sessions(spark.read.parquet(f"{path}/open/{done[-1]}"), key, time, gap)
    return chats.unionByName(_assembled(still, key, order, role, text, turns_per_part))


def read_late_turns(spark: SparkSession, path: str) -> DataFrame:
    """The turns that came after their time had passed, and those without key or time."""
    done = whole_triggers(spark, f"{path}/marks")
    if not done:
        raise FileNotFoundError(f"no conversations in {path} yet")
    return spark.read.parquet(*[f"{path}/late/{name}" for name in done])
