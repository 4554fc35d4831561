"""Repair of conversations: generalised LR over the grammar of roles.

The grammar is ``Conv -> e | Turns``, ``Turns -> Turns Pair | System Pair | Pair``, ``System -> s``,
``Pair -> u a`` over the initials of roles. Every row may be kept, given another role or deleted, and
rows may be inserted anywhere; each action costs. The parser follows all actions at once on a
graph-structured stack: stacks with equal tops become one, the one of least (cost, audit).

A conversation of any length is cut into segments of rows. A segment is parsed from every top that
it could begin on, so segments run in parallel; a stream over the segments then chains them.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField,
                               StructType)

from corpusloom.session import materialize

#: Characters that do not count as text.
BLANK = " \t\n\x0b\x0c\r"
#: Rows of a segment, and segments that leave a task together.
SEGMENT_ROWS, LOT = 256, 512

# --- the parser ----------------------------------------------------------------------------------

#: LR(0) tables of the grammar: state 2 has a user row on top, 3 a system row, 4 whole turns.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (3, "u"): 2, (4, "u"): 2, (2, "a"): 6}
REDUCE = {1: ("System", 1), 5: ("Turns", 1), 6: ("Pair", 2), 7: ("Turns", 2), 8: ("Turns", 2)}
GOTO = {(0, "System"): 3, (0, "Turns"): 4, (0, "Pair"): 5, (3, "Pair"): 7, (4, "Pair"): 8}
ACCEPT = (0, 4)
#: A stack for every top a segment can begin on. What lies below a user row makes no difference:
#: the pair it opens ends in whole turns in any case.
STACKS = {0: (0,), 2: (0, 2), 3: (0, 3), 4: (0, 4)}
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1


@lru_cache(None)
def shifted(stack: tuple, role: str) -> tuple | None:
    """The stack after a role, with all reductions done; None where the grammar forbids it."""
    state = SHIFT.get((stack[-1], role))
    if state is None:
        return None
    stack += (state,)
    while stack[-1] in REDUCE:
        name, size = REDUCE[stack[-1]]
        stack = stack[:-size]
        stack += (GOTO[stack[-1], name],)
    return stack


def offer(tops: dict, cost: int, audit: str, stack: tuple | None) -> bool:
    """Merge a stack into the one with the same top: the lesser (cost, audit) stays."""
    if stack is None or (stack[-1] in tops and tops[stack[-1]][:2] <= (cost, audit)):
        return False
    tops[stack[-1]] = (cost, audit, stack)
    return True


def insert_rows(tops: dict) -> dict:
    """All that insertions lead to, until none is better."""
    open_ = list(tops)
    while open_:
        cost, audit, stack = tops[open_.pop()]
        for role in "ua":
            to = shifted(stack, role)
            if offer(tops, cost + INSERT, audit + "I", to):
                open_.append(to[-1])
    return tops


@lru_cache(1 << 16)
def parse(signature: str, top: int) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) to every top that the rows lead to from ``top``.

    The signature has two signs a row: the initial (``x`` if it is none of s, u, a) and the fault
    (``B`` blank, ``D`` duplicate, ``T`` truncated, ``-`` none).
    """
    tops = insert_rows({top: (0, "", STACKS[top])})
    for i in range(0, len(signature), 2):
        role, fault = signature[i], signature[i + 1]
        after: dict = {}
        for cost, audit, stack in tops.values():
            offer(after, cost + DELETE, audit + "D", stack)
            if fault in "BD":
                continue
            kept = cost + (TRUNCATED if fault == "T" else 0)
            offer(after, kept, audit + "K", shifted(stack, role))
            for new in "ua":
                offer(after, kept + REROLE, audit + "R", shifted(stack, new))
        tops = insert_rows(after)
    return {t: (cost, audit) for t, (cost, audit, _) in tops.items()}


def replay(signature: str, audit: str, last: str) -> tuple[int, list[tuple[int, str]], str]:
    """Cost, output and last role of an audit over rows: the output is (row or -1, role or '').

    The grammar leaves one role for every inserted or changed row, so the audit says it all.
    """
    cost, out, row = 0, [], 0
    for action in audit:
        if action == "I":
            cost += INSERT
        else:
            role, fault = signature[2 * row], signature[2 * row + 1]
            row += 1
            if action == "D":
                cost += DELETE
                continue
            cost += (fault == "T") * TRUNCATED
            if action == "K":
                last = role
                out.append((row - 1, ""))
                continue
            cost += REROLE
        last = "a" if last == "u" else "u"
        out.append((-1 if action == "I" else row - 1, "assistant" if last == "a" else "user"))
    return cost, out, last


# --- rows to segments ----------------------------------------------------------------------------

def _illegal(signature: str, before: str) -> int:
    roles = before + signature[::2]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


def _segments(conv_type):
    """Sorted rows to segments with their parses; a segment lies in one partition."""
    schema = pa.schema([
        ("conv", to_arrow_type(conv_type)), ("seg", pa.int64()), ("uids", pa.list_(pa.int64())),
        ("sig", pa.string()), ("parses", pa.string()), ("turns", pa.list_(pa.int64()))])

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        out: list = []
        conv, uids, sig, turns, tops = None, None, [], [], (0,)

        def close():
            text = "".join(sig)
            parses = ";".join(f"{a},{b},{cost},{audit}" for a in tops
                              for b, (cost, audit) in parse(text, a).items())
            known = [t for t in turns if t is not None]
            # least, greatest and number of different turns; rows come sorted by turn
            stats = [known[0], known[-1], len(set(known))] if known else []
            out.append((conv, (part << 32) + number, uids, text, parses, stats))

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        for batch in batches:
            for c, turn, uid, code in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if uids is None or c != conv or len(uids) >= SEGMENT_ROWS:
                    if uids is not None:
                        close()
                        number += 1
                        if len(out) >= LOT:
                            yield flush()
                            out.clear()
                    # Only behind another conversation is it known that this one begins here.
                    tops = (0,) if uids is not None and c != conv else tuple(STACKS)
                    conv, uids, sig, turns = c, [], [], []
                if code is not None:
                    uids.append(uid)
                    sig.append(code)
                    turns.append(turn)
        if uids is not None:
            close()
            yield flush()

    return run


def _chain(conv_type):
    """Segments of whole conversations, in order, to the edits of each segment.

    Holds the parses that are still open; what all of them begin with is settled and leaves. So the
    memory does not grow with a conversation.
    """
    line = pa.struct([("pos", pa.int64()), ("uid", pa.int64()), ("role", pa.string())])
    schema = pa.schema([
        ("conv", to_arrow_type(conv_type)), ("seg", pa.int64()), ("only", pa.bool_()),
        ("audit", pa.string()), ("lines", pa.list_(line)), ("cost", pa.int64()),
        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
        ("illegal", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("n", pa.int64())])

    def run(batches):
        out: list = []
        conv, waiting, tops = None, None, {}
        settled, last, role_before, turn_before, count = "", "", "", None, 0

        def settle(end: bool):
            """Give the settled letters to the waiting segments, as far as these are complete."""
            nonlocal settled, last
            while waiting:
                seg, uids, sig, stats = waiting[0]
                rows, at = 0, 0
                while at < len(settled):
                    if settled[at] != "I":
                        if rows == len(uids):
                            break
                        rows += 1
                    at += 1
                if at == len(settled) and not end:
                    return  # letters that follow may still be its own
                audit, settled = settled[:at], settled[at:]
                cost, found, last = replay(sig, audit, last)
                faults = sig[1::2]
                out.append((conv, seg, end and count == 1, audit,
                            [{"pos": i, "uid": uids[r] if r >= 0 else None, "role": role or None}
                             for i, (r, role) in enumerate(found)],
                            cost, faults.count("B"), faults.count("D"), faults.count("T"), *stats))
                waiting.pop(0)

        def close():
            nonlocal settled
            settled += min(tops[t] for t in ACCEPT if t in tops)[1]
            settle(True)

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        for batch in batches:
            for c, seg, uids, sig, parses, turns in zip(
                    *(batch.column(i).to_pylist() for i in range(6))):
                if waiting is None or c != conv:
                    if waiting is not None:
                        close()
                    conv, waiting, tops = c, [], {0: (0, "")}
                    settled, last, role_before, turn_before, count = "", "", "", None, 0
                if len(out) >= LOT:
                    yield flush()
                    out.clear()
                count += 1
                low, high, n = turns or (None, None, 0)
                stats = [_illegal(sig, role_before), low, high,
                         n - (low is not None and low == turn_before)]
                role_before = sig[-2:-1] or role_before
                turn_before = turn_before if high is None else high
                waiting.append((seg, uids, sig, stats))
                after: dict = {}
                for move in parses.split(";"):
                    a, b, cost, audit = move.split(",")
                    if int(a) in tops:
                        before = tops[int(a)]
                        new = (before[0] + int(cost), before[1] + audit)
                        if int(b) not in after or new < after[int(b)]:
                            after[int(b)] = new
                sure = commonprefix([audit for _, audit in after.values()])
                tops = {t: (cost, audit[len(sure):]) for t, (cost, audit) in after.items()}
                settled += sure
                if len(waiting) > 1:
                    settle(False)
        if waiting is not None:
            close()
        if out:
            yield flush()

    return run


# --- the operator --------------------------------------------------------------------------------

def conversation_rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str,
                      text_col: str) -> DataFrame:
    """``_uid, _conv, _turn, _role, _text, _live``: null roles and texts are one space; rows come in
    the order of the table within a turn. ``_live`` is false for rows that only name a conversation."""
    return df.select(
        F.monotonically_increasing_id().alias("_uid"), F.col(conv_col).alias("_conv"),
        F.col(turn_col).cast("long").alias("_turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("_role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("_text"),
        F.lit(True).alias("_live"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows of :func:`conversation_rows` with damage that follows from crc32 of ``conv:turn``
    modulo 20 (a null there is one space): 0 drops the row, 1 empties its text, 2 takes out its
    ``.!?``, 3 repeats it, 4 makes it a user's."""
    def named(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(named("_conv"), F.lit(":"), named("_turn"))) % 20
    text = F.when(F.col("_kind") == 1, "").when(
        F.col("_kind") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    return (
        rows.withColumn("_kind", kind)
        .withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
                                       .otherwise(F.array(F.lit(0)))))
        .select((F.col("_uid") * 2 + F.col("_copy")).alias("_uid"), "_conv", "_turn",
                F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("_role"),
                text.alias("_text"), (F.col("_live") & (F.col("_kind") != 0)).alias("_live")))


def repair_edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation, a row per segment: ``conv, seg, only, audit, lines,
    cost`` and counts. ``rows`` is a written table like that of :func:`conversation_rows`.

    Only narrow rows move here. A text that its conversation has had before is found by the least
    row per (conversation, digest), combined before the shuffle; rows then learn it by their number.
    """
    bare = F.rtrim(F.col("_text"), F.lit(BLANK))
    role = F.left("_role", F.lit(1))
    narrow = rows.select(
        "_uid", "_conv", "_turn", "_live", (bare == "").alias("_blank"),
        F.unhex(F.sha2(F.concat(F.octet_length("_role").cast("string"), F.lit(":"), "_role",
                                "_text"), 256)).alias("_digest"),
        F.when(role.isin("s", "u", "a"), role).otherwise("x").alias("_initial"),
        F.right(bare, F.lit(1)).isin(".", "!", "?").alias("_ended"))
    firsts = narrow.where("_live and not _blank").groupBy("_conv", "_digest").agg(
        F.min(F.struct("_turn", "_uid")).alias("_first")).select(
        F.col("_first._uid").alias("_uid"), F.lit(True).alias("_new"))
    fault = F.when(F.col("_blank"), "B").when(F.col("_new").isNull(), "D").when(
        ~F.col("_ended"), "T").otherwise("-")
    coded = narrow.drop("_digest").join(firsts, "_uid", "left").select(
        "_conv", "_turn", "_uid",
        F.when(F.col("_live"), F.concat("_initial", fault)).alias("_code"))
    kind = coded.schema["_conv"].dataType
    line = StructType([StructField("pos", LongType()), StructField("uid", LongType()),
                       StructField("role", StringType())])
    longs = ("cost", "blank", "duplicate", "truncated", "illegal", "low", "high", "n")
    segments = coded.repartitionByRange("_conv", "_turn", "_uid").sortWithinPartitions(
        "_conv", "_turn", "_uid").mapInArrow(_segments(kind), StructType([
            StructField("conv", kind), StructField("seg", LongType()),
            StructField("uids", ArrayType(LongType())), StructField("sig", StringType()),
            StructField("parses", StringType()), StructField("turns", ArrayType(LongType()))]))
    return segments.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(
        _chain(kind), StructType([
            StructField("conv", kind), StructField("seg", LongType()),
            StructField("only", BooleanType()), StructField("audit", StringType()),
            StructField("lines", ArrayType(line)),
            *[StructField(c, LongType()) for c in longs]]))


def repaired_lines(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv, seg, pos, role, text`` in this order."""
    lines = edits.select("conv", "seg", "only", F.inline("lines"))
    kept = lines.where(F.col("uid").isNotNull()).join(
        rows.select(F.col("_uid").alias("uid"), "_role", "_text"), "uid").select(
        "conv", "seg", "only", "pos", F.coalesce("role", "_role").alias("role"),
        F.col("_text").alias("text"))
    new = lines.where(F.col("uid").isNull()).select(
        "conv", "seg", "only", "pos", "role", F.lit("").alias("text"))
    return kept.union(new)


def _hash_segments(conv_type):
    """SHA-256 of segments in order, a newline between: a stream, whatever the conversation's size."""
    schema = pa.schema([("conv", to_arrow_type(conv_type)), ("sha", pa.string())])

    def run(batches):
        conv, state = None, None
        for batch in batches:
            done = []
            for c, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or c != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], schema.types[0]), pa.array([state.hexdigest()])], schema=schema)

    return run


def repair_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         damaged: bool = False) -> DataFrame:
    """Faults and the cheapest repair of every conversation, a row each: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn, nulls first, rows of a turn in the order of the table. The first fault
    of a row counts: blank, duplicate (role and text were there earlier), truncated (ends in none of
    ``.!?``). Blank and duplicate rows are deleted; the repair is of least cost and, of these, has
    the least audit. ``damaged`` applies :func:`damage` first. A null id is a conversation of its
    own, null roles and texts are one space; an empty table gives no rows, and a conversation that
    has lost all its rows zeros, an empty audit and the hash of the empty text. Other columns are
    not read. Only the hash of a conversation of more than one segment is a stream in one task.
    """
    rows = conversation_rows(df, conv_col, turn_col, role_col, text_col)
    rows = materialize(damage(rows) if damaged else rows, "turns")
    edits = materialize(repair_edits(rows), "edits")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "pos", F.concat("role", F.lit(":"), "text").alias("line")))), lambda s: s["line"]), "\n")
    texts = repaired_lines(rows, edits).groupBy("conv", "seg", "only").agg(text.alias("text"))
    kind = edits.schema["conv"].dataType
    whole = texts.where("only").select("conv", F.sha2("text", 256).alias("sha"))
    # Few conversations are longer than a segment or lie across two partitions.
    parts = texts.where("not only").repartition("conv").sortWithinPartitions("conv", "seg").select(
        "conv", "text").mapInArrow(_hash_segments(kind), StructType([
            StructField("conv", kind), StructField("sha", StringType())]))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))),
                                     lambda s: s["audit"]), "")
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("n"), F.lit(0))
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")
    found = edits.groupBy("conv").agg(
        gaps.cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in sums], audit.alias("audit"))
    hashes = whole.union(parts).withColumnRenamed("conv", "_conv")
    return found.join(hashes, found["conv"].eqNullSafe(hashes["_conv"]), "left").select(
        F.col("conv").alias(conv_col), "gaps", *sums, "audit",
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
