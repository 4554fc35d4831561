"""Removal of repeated passages by prefix-free parsing and the suffix order of its parts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BinaryType, LongType, StringType, StructField, StructType,
)

from corpusloom.session import materialize

#: Bytes that the rolling hash sees; starts of a text that are parsed together.
TRIGGER, STARTS_AT_ONCE = 8, 1 << 22
#: Bits of a place for the shortest and the longest way back from its trigger.
WAY = 8


# --- parsing -------------------------------------------------------------------------------------

def triggers(data: bytes, length: int, reach: int):
    """``(at, low, high)``: the triggers of a text and the starts that belong to each.

    A trigger is a place whose rolling hash is the least of ``reach + 1`` neighbours, the first of
    equal ones. (The usual rule, hash modulo p, can leave a stretch of any length without one; this
    one cannot, so phrases, from one trigger to the next, are at most ``reach + 1`` bytes.) The
    trigger of a start is the least of the places from it on. It depends only on the ``length``
    bytes from that start, so a string has it at the same distance wherever it stands.
    """
    starts = len(data) - length + 1
    parts = []
    for first in range(0, max(0, starts), STARTS_AT_ONCE):
        n = min(STARTS_AT_ONCE, starts - first)
        need = n + reach
        words = np.ndarray((need,), "<u8", data, offset=first, strides=(1,))
        with np.errstate(over="ignore"):
            key = words * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
            key *= np.uint64(0xD6E8FEB86659FD93)
        key >>= np.uint64(32)
        key <<= np.uint64(32)
        key |= np.arange(need, dtype=np.uint64)
        wide = reach + 1
        pad = np.full(-need % wide, np.iinfo(np.uint64).max, np.uint64)
        rows = np.concatenate([key, pad]).reshape(-1, wide)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[reach:reach + n])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        low = np.flatnonzero(np.diff(at, prepend=-1))
        high = np.append(low[1:], n) - 1
        parts.append((at[low] + first, low + first, high + first))
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts))


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def parsed(texts: list[bytes], length: int, reach: int):
    """For all texts together: ``(row, place, family, whole)``.

    ``place`` packs the trigger with the shortest and the longest way back to a start of its own;
    ``family`` is the hash of the bytes from the trigger on that all its starts' strings contain;
    ``whole`` that of everything its starts' strings contain, and of the two ways.
    """
    row, place, family, whole = [], [], [], []
    sure = length - reach
    digest = xxhash.xxh3_64_intdigest
    for r, data in enumerate(texts):
        at, low, high = triggers(data, length, reach)
        if not len(at):
            continue
        view = memoryview(data)
        near, far = at - high, at - low
        family += [digest(view[t:t + sure]) for t in at.tolist()]
        whole += [digest(view[a:b], s) for a, b, s in zip(
            low.tolist(), (high + length).tolist(), (far << WAY | near).tolist())]
        row.append(np.full(len(at), r))
        place.append(at << 2 * WAY | near << WAY | far)
    if not row:
        return (np.zeros(0, np.int64),) * 4
    return np.concatenate(row), np.concatenate(place), _signed(family), _signed(whole)


def _unpacked(place):
    mask = (1 << WAY) - 1
    return place >> 2 * WAY, place >> WAY & mask, place & mask


def _spans(place, length: int):
    """Start and end of everything that the strings of a place cover, in one number."""
    at, near, far = _unpacked(place)
    return (at - far) << 32 | (at - near + length)


def _family_sizes(length: int, reach: int):
    """Per family within a batch: rows, least and greatest ``whole``."""
    def run(batches):
        for batch in batches:
            _, _, family, whole = parsed(batch.column("_data").to_pylist(), length, reach)
            if not len(family):
                continue
            order = np.lexsort((whole, family))
            family, whole = family[order], whole[order]
            head = np.flatnonzero(np.append(True, family[1:] != family[:-1]))
            tail = np.append(head[1:], len(family)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(family[head]), pa.array(tail - head + 1), pa.array(whole[head]),
                 pa.array(whole[tail])], ["_family", "_rows", "_least", "_most"])

    return run


def _rows(length: int, reach: int):
    """One row per place. Where ``whole`` repeats within a batch, ``_n`` is how often on the first
    row and 0 on the others, which are settled and get a family that spreads them."""
    def run(batches):
        for batch in batches:
            row, place, family, whole = parsed(batch.column("_data").to_pylist(), length, reach)
            if not len(row):
                continue
            _, head, at, n = np.unique(
                whole, return_index=True, return_inverse=True, return_counts=True)
            first = head[at] == np.arange(len(whole))
            family = np.where(first, family, whole ^ (np.arange(len(whole)) << 24))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(take), batch.column("_hash").take(take),
                 pa.array(place), pa.array(family), pa.array(whole),
                 pa.array(np.where(first, n[at], 0))],
                ["_id", "_hash", "_place", "_family", "_whole", "_n"])

    return run


# --- suffix order --------------------------------------------------------------------------------

def _adjacent(parts: list[bytes], width: int, kind: np.ndarray):
    """Sorted order of byte strings within their kinds, and for each but the first how many bytes
    it has in common with the one before it (-1 between kinds)."""
    order = np.array(sorted(range(len(parts)), key=lambda i: (kind[i], parts[i])), np.int64)
    table = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(
        len(parts), width)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    common = np.empty(max(0, len(parts) - 1), np.int64)
    for a in range(0, len(common), 4096):
        b = min(len(common), a + 4096)
        other = table[order[a + 1:b + 1]] != table[order[a:b]]
        common[a:b] = np.where(other.any(axis=1), other.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(size[order[1:]], size[order[:-1]]))
    common[kind[order[1:]] != kind[order[:-1]]] = -1
    return order, common


def repeated_ways(kind, near, far, data: list[bytes], length: int) -> np.ndarray:
    """Which strings of the given pieces stand in another piece of the same family.

    A piece is what lies around a trigger: ``far`` bytes of the phrase before it and what follows.
    Its string at way ``w`` is the last ``w`` bytes before the trigger (a suffix of a phrase) and
    the first ``length - w`` from it on (a prefix of a suffix of the parse). Pieces are put in the
    suffix order of the dictionary, by their bytes before the trigger read backwards, and in that
    of the parse, by what follows it, each with the common lengths of neighbours. In either order
    the pieces that agree on a length are a run; strings are equal where both runs are the same.
    """
    n, top = len(data), int(far.max()) + 1
    left, left_common = _adjacent([d[:f][::-1] for d, f in zip(data, far.tolist())], top, kind)
    right, right_common = _adjacent([d[f:] for d, f in zip(data, far.tolist())], length, kind)
    found = np.zeros((n, top), bool)
    run = np.empty(n, np.int64)
    for way in range(int(near.min()), top):
        rows = np.flatnonzero((near <= way) & (way <= far))
        if len(rows) < 2:
            continue
        run[left] = np.append(0, np.cumsum(left_common < way))
        key = run[rows] * n
        run[right] = np.append(0, np.cumsum(right_common < length - way))
        key += run[rows]
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        hit = np.append(False, same) | np.append(same, False)
        found[rows[order[hit]], way] = True
    return found


def _found_spans(found, place, length):
    """``(row, span)`` of the starts marked in ``found``, neighbouring ones together."""
    wide = np.zeros((len(found), found.shape[1] + 2), np.int8)
    wide[:, 1:-1] = found
    step = np.diff(wide, axis=1)
    row, low = np.nonzero(step == 1)
    high = np.nonzero(step == -1)[1] - 1
    at = place[row] >> 2 * WAY
    return row, (at - high) << 32 | (at - low + length)


def _compared(length: int, lot: int):
    """Pieces sorted by family to spans of the repeated strings of those that stand once."""
    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows >= lot:
                family = held["_family"].to_numpy()
                cut = int(np.flatnonzero(np.append(True, family[1:] != family[:-1]))[-1])
                if cut:
                    yield from compare(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from compare(held)

    def compare(table):
        table = table.combine_chunks()
        family, place = table["_family"].to_numpy(), table["_place"].to_numpy()
        _, near, far = _unpacked(place)
        found = repeated_ways(family, near, far, table["_piece"].to_pylist(), length)
        found[table["_n"].to_numpy() > 1] = False
        row, span = _found_spans(found, place, length)
        if len(row):
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [table["_id"].combine_chunks().take(take),
                 table["_hash"].combine_chunks().take(take), pa.array(span)],
                ["_id", "_hash", "_span"])

    return run


def _strings(length: int):
    """Every string of a piece, by a hash of 128 bits, with the span it would cover."""
    def run(batches):
        for batch in batches:
            pieces = batch.column("_piece").to_pylist()
            place = batch.column("_place").to_numpy(zero_copy_only=False)
            _, near, far = _unpacked(place)
            for i, (data, low, high) in enumerate(zip(pieces, near.tolist(), far.tolist())):
                ways = np.arange(low, high + 1)
                view = memoryview(data)
                keys = [xxhash.xxh3_128_digest(view[high - w:high - w + length])
                        for w in ways.tolist()]
                at = int(place[i]) >> 2 * WAY
                take = pa.array(np.full(len(ways), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(take), batch.column("_hash").take(take),
                     batch.column("_n").take(take), pa.array(keys, pa.binary()),
                     pa.array((at - ways) << 32 | (at - ways + length))],
                    ["_id", "_hash", "_n", "_key", "_span"])

    return run


# --- whole texts ---------------------------------------------------------------------------------

def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by content: an id and a hash of the text, so that every pass names them alike."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"),
                     text.cast("binary").alias("_data"))


def _on_row(a: DataFrame, b: DataFrame):
    return a["_id"].eqNullSafe(b["_id"]) & (a["_hash"] == b["_hash"])


def repeated_spans(df: DataFrame, id_col: str, text_col: str, length: int = 400,
                   reach: int = 255, lot: int = 20_000) -> DataFrame:
    """``_id, _hash, _span``: stretches of texts that are covered by strings of ``length`` bytes
    that stand twice or more.

    1. Parse all texts; a family (the bytes that follow a trigger) of one row repeats nothing.
    2. Rows whose whole surroundings repeat are settled, be it within a batch, because all of the
       family are alike, or by a count of (family, whole).
    3. Of what is left, one piece for each different surrounding is cut from its text and compared
       within its family by suffix order. A family of more than ``lot`` pieces is not compared in
       one task: its strings are counted by their hashes instead.
    """
    if not TRIGGER <= length - reach or not 0 < reach < 1 << WAY:
        raise ValueError(f"reach is below {1 << WAY} and leaves {TRIGGER} bytes of the length")
    spark = df.sparkSession
    docs = _keyed(df, id_col, text_col)
    long = docs.where(F.octet_length("_data") >= length)
    key_type = docs.schema["_id"].dataType
    who = [StructField("_id", key_type), StructField("_hash", LongType())]

    def longs(*names):
        return [StructField(n, LongType()) for n in names]

    families = (
        long.select("_data").mapInArrow(
            _family_sizes(length, reach),
            StructType(longs("_family", "_rows", "_least", "_most")))
        .groupBy("_family").agg(F.sum("_rows").alias("_rows"), F.min("_least").alias("_least"),
                                F.max("_most").alias("_most"))
        .where("_rows > 1").select("_family", (F.col("_least") == F.col("_most")).alias("_alike")))
    rows = long.mapInArrow(
        _rows(length, reach),
        StructType(who + longs("_place", "_family", "_whole", "_n")))
    rows = materialize(
        rows.join(families, "_family", "left")
        .where("_n <> 1 or _alike is not null")
        .withColumn("_settled", (F.col("_n") != 1) | F.col("_alike"))
        .withColumn("_open", (F.col("_n") > 0) & ~F.coalesce("_alike", F.lit(True)))
        .drop("_alike"), "places")

    def full(df):
        return df.select("_id", "_hash", "_place").mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_hash"), pa.array(_spans(
                    b.column("_place").to_numpy(zero_copy_only=False), length))],
                ["_id", "_hash", "_span"]) for b in batches),
            StructType(who + longs("_span")))

    kinds = materialize(
        rows.where("_open").groupBy("_family", "_whole").agg(
            F.sum("_n").alias("_n"), F.min(F.struct("_id", "_hash", "_place")).alias("_row")),
        "kinds")
    settled = rows.where("_settled").unionByName(
        rows.where("not _settled").join(
            kinds.where("_n > 1").select("_family", "_whole"), ["_family", "_whole"], "left_semi"))

    asked = kinds.select("_row.*", "_family", "_whole", "_n").groupBy("_id", "_hash").agg(
        F.collect_list(F.struct("_place", "_family", "_n")).alias("_asked")).select(
        "_id", "_hash", *[F.col(f"_asked.{c}").alias(c) for c in ("_place", "_family", "_n")])
    piece_fields = StructType(who + longs("_place", "_family", "_n")
                              + [StructField("_piece", BinaryType())])
    found = long.join(asked, _on_row(long, asked)).select(
        long["_id"], long["_hash"], "_place", "_family", "_n", "_data")
    pieces = materialize(found.mapInArrow(_cut(length), piece_fields), "pieces")
    large = materialize(pieces.groupBy("_family").count().where(F.col("count") > lot).select(
        "_family"), "large-families")
    n_large = large.count()  # at most one for every ``lot`` pieces
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    usual = pieces.join(large, "_family", "left_anti") if n_large else pieces
    partly = (usual.repartition(parts, "_family").sortWithinPartitions("_family")
              .mapInArrow(_compared(length, lot), StructType(who + longs("_span"))))
    spans = full(settled).unionByName(partly)
    if n_large:
        strings = materialize(
            pieces.join(large, "_family", "left_semi").mapInArrow(
                _strings(length), StructType(who + longs("_n") + [
                    StructField("_key", BinaryType())] + longs("_span"))), "strings")
        twice = strings.groupBy("_key").count().where("count > 1").select("_key")
        spans = spans.unionByName(strings.where("_n = 1").join(
            twice, "_key", "left_semi").select("_id", "_hash", "_span"))
    return spans


def _cut(length: int):
    """Pieces of texts around the asked places."""
    def run(batches):
        for batch in batches:
            index, cut = [], []
            asked = [batch.column(c) for c in ("_place", "_family", "_n")]
            flat = [c.flatten() for c in asked]
            at, near, far = _unpacked(flat[0].to_numpy(zero_copy_only=False))
            ends = np.cumsum([len(p) for p in asked[0]]).tolist()
            begin = 0
            for i, (data, end) in enumerate(zip(batch.column("_data").to_pylist(), ends)):
                for j in range(begin, end):
                    index.append(i)
                    cut.append(data[at[j] - far[j]:at[j] - near[j] + length])
                begin = end
            take = pa.array(index, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(take), batch.column("_hash").take(take), *flat,
                 pa.array(cut, pa.binary())],
                ["_id", "_hash", "_place", "_family", "_n", "_piece"])

    return run


def _merged(spans: np.ndarray) -> list[tuple[int, int]]:
    out = []
    for span in np.sort(spans).tolist():
        a, b = span >> 32, span & 0xFFFFFFFF
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 400, reach: int = 255, lot: int = 20_000,
                   texts: bool = False) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans`` (removed runs), ``kept_sha256``; and
    ``kept``, the bytes that remain, if ``texts``.

    A byte goes if a string of ``length`` bytes over it also starts elsewhere, in the same text or
    another; strings are those of the given texts, overlaps count, and none reaches over the end
    of a text. Texts are their UTF-8 bytes; null texts are empty texts. Null ids stay null;
    repeated rows are texts of their own and so lose what they share. Other columns are not read.
    An empty table gives no rows.
    """
    docs = _keyed(df, id_col, text_col)
    spans = repeated_spans(df, id_col, text_col, length, reach, lot).groupBy("_id", "_hash").agg(
        F.collect_set("_span").alias("_spans"))

    def run(batches):
        for batch in batches:
            n_bytes, n_removed, n_spans, digest, kept = [], [], [], [], []
            lists = batch.column("_spans")
            for data, own in zip(batch.column("_data").to_pylist(), lists):
                runs = _merged(own.values.to_numpy(zero_copy_only=False)) if own.is_valid else []
                if runs:
                    edges = [0, *(x for r in runs for x in r), len(data)]
                    rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                else:
                    rest = data
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(rest))
                n_spans.append(len(runs))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [batch.column("_id"), pa.array(n_bytes, pa.int64()),
                       pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                       pa.array(digest, pa.string())]
            if texts:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = StructType([
        StructField(id_col, docs.schema["_id"].dataType), StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()), StructField("n_spans", LongType()),
        StructField("kept_sha256", StringType())]
        + ([StructField("kept", BinaryType())] if texts else []))
    joined = docs.join(spans, _on_row(docs, spans), "left").select(
        docs["_id"], "_data", "_spans")
    return joined.mapInArrow(run, schema)
