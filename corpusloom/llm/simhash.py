"""SimHash near-dedup by Golay-code fuzzy hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusloom.llm.graph import components, spanning
from corpusloom.session import materialize

#: Generator polynomial of the binary Golay code (23, 12), which corrects three errors.
GENERATOR = 0b110001110101
#: Bits of the fingerprint in each segment, from the lowest; a segment is filled with zeros to 23.
SEGMENTS = (22, 21, 21)
PAIRS = tuple(combinations(range(3), 2))
#: Pairs of fingerprints compared in one step of a task.
STEP = 1 << 21


# --- fingerprints --------------------------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64 bits, as a signed number: bit b is set if over half of the shingles' hashes have it.

    Words are split at ASCII white space after A-Z became a-z; shingles are runs of ``shingle``
    words, one space between, repeats counted; a shorter text is one shingle, one without words
    has fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts, stops)], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    high = bits.sum(axis=0, dtype=np.int64) * 2 > n
    return int(np.packbits(high, bitorder="little").view("<i8")[0])


def fingerprints(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``_uid, _id, _fp`` of rows ``_uid, _id, _text`` (bytes)."""
    def run(batches):
        for batch in batches:
            fp = pa.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column("_text")],
                          pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_uid"), batch.column("_id"), fp], ["_uid", "_id", "_fp"])

    schema = StructType([rows.schema["_uid"], rows.schema["_id"], StructField("_fp", LongType())])
    return rows.mapInArrow(run, schema)


# --- fuzzy keys ----------------------------------------------------------------------------------

def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word, and the errors of each syndrome."""
    unit = [_remainder(1 << b) for b in range(23)]
    part = []
    for first, width in ((0, 12), (12, 11)):
        out = np.zeros(1 << width, np.int32)
        for b in range(width):
            out[1 << b:2 << b] = out[:1 << b] ^ unit[first + b]
        part.append(out)
    errors = np.zeros(2048, np.int32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            at = 0
            for b in bits:
                at ^= unit[b]
            errors[at] = sum(1 << b for b in bits)
    return part[0], part[1], errors


def nearest(words: np.ndarray, tables) -> np.ndarray:
    """Index (12 bits) of the one codeword within three errors of each word."""
    low, high, errors = tables
    return (words ^ errors[low[words & 4095] ^ high[words >> 12]]) >> 11


def segments(fp: np.ndarray) -> list[np.ndarray]:
    rest, out = fp.view(np.uint64), []
    for width in SEGMENTS:
        out.append((rest & np.uint64((1 << width) - 1)).astype(np.int32))
        rest = rest >> np.uint64(width)
    return out


def own_keys(fp: np.ndarray, tables) -> list[np.ndarray]:
    """For each pair of segments, the key of the codewords that its two segments decode to."""
    at = [nearest(s, tables) for s in segments(fp)]
    return [(p << 24) + (at[i] << 12) + at[j] for p, (i, j) in enumerate(PAIRS)]


def near_keys(fp: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, key, own)``: all keys that some fingerprint has as its own which differs from the
    row's in at most one bit of each of the pair's segments. The codewords are those to which the
    segment and its neighbours at one bit decode: one, or six where it is three errors away."""
    near, live, base = [], [], []
    for width, seg in zip(SEGMENTS, segments(fp)):
        flips = np.array([0, *(1 << b for b in range(width))], np.int32)
        at = nearest(seg[:, None] ^ flips, tables)
        base.append(at[:, 0].copy())
        at.sort(axis=1)
        first = np.ones(at.shape, bool)
        first[:, 1:] = at[:, 1:] != at[:, :-1]
        most = int(first.sum(axis=1).max()) if len(fp) else 1
        order = np.argsort(~first, axis=1, kind="stable")[:, :most]
        near.append(np.take_along_axis(at, order, 1))
        live.append(np.take_along_axis(first, order, 1))
    rows, keys, own = [], [], []
    for p, (i, j) in enumerate(PAIRS):
        ok = live[i][:, :, None] & live[j][:, None, :]
        key = (p << 24) + (near[i][:, :, None] << 12) + near[j][:, None, :]
        mine = (p << 24) + (base[i] << 12) + base[j]
        rows.append(np.nonzero(ok)[0])
        keys.append(key[ok])
        own.append(keys[-1] == mine[rows[-1]])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(own)


# --- candidates and links ------------------------------------------------------------------------

def _key_rows(batches):
    tables = code_tables()
    for batch in batches:
        fp = batch.column("_fp").to_numpy(zero_copy_only=False)
        row, key, own = near_keys(fp, tables)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.astype(np.int32)), pa.array(fp[row]), pa.array(own)],
            ["_key", "_fp", "_own"])


def _own_rows(batches):
    tables = code_tables()
    for batch in batches:
        fp = batch.column("_fp").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(own_keys(fp, tables)).astype(np.int32))], ["_key"])


def _links(bits: int):
    """Verify candidates: partitions sorted by key and salt, own rows before the others."""
    def verified(fp, own, start):
        """Links among rows of groups that begin at ``start``, thinned to a spanning set."""
        size = np.diff(np.append(start, len(fp)))
        group = np.repeat(np.arange(len(start)), size)
        n_own = np.add.reduceat(own.astype(np.int64), start)
        reach = n_own[group]
        upto = np.cumsum(reach)
        a, b = [], []
        low = 0
        while low < len(fp):
            done = upto[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(upto, done + STEP, "right")))
            left = np.repeat(np.arange(low, high), reach[low:high])
            nth = np.arange(len(left)) - np.repeat(upto[low:high] - reach[low:high] - done,
                                                   reach[low:high])
            right = start[group[left]] + nth
            apart = np.bitwise_count(fp[left] ^ fp[right])
            hit = (apart > 0) & (apart <= bits)
            if hit.any():
                x, y = spanning(fp[left[hit]], fp[right[hit]])
                a.append(x)
                b.append(y)
            low = high
        if not a:
            return None
        return spanning(np.concatenate(a), np.concatenate(b))

    def run(batches):
        held = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool))
        parts, n = [], 0

        def flush(last):
            nonlocal held, parts, n
            group, fp, own = (np.concatenate(x) for x in zip(held, *parts))
            parts, n = [], 0
            if not len(fp):
                return
            start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            found = verified(fp, own, start)
            tail = np.arange(start[-1], len(fp))
            tail = tail[own[tail]] if not last else tail[:0]
            held = group[tail], fp[tail], own[tail]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in found], ["u", "v"])

        for batch in batches:
            key, salt, fp, own = (batch.column(c).to_numpy(zero_copy_only=False)
                                  for c in ("_key", "_salt", "_fp", "_own"))
            parts.append(((key.astype(np.int64) << 32) + salt, fp.view(np.uint64), own))
            n += len(fp)
            if n >= 400_000:
                yield from flush(False)
        yield from flush(True)

    return run


def fingerprint_links(fps: DataFrame, bits: int = 3, piece: int = 4096) -> DataFrame:
    """Links ``u, v`` that connect all fingerprints ``_fp`` (distinct) within ``bits`` of each other.

    Of three segments, three errors leave two with at most one error each. So if x and y are
    linked, one of y's own keys is among x's near keys. Keys meet in one exchange; within a key the
    own rows are held and all rows stream past them, so links are verified without writing the
    pairs, and each step keeps a spanning set only. A key with more than ``piece`` own rows is dealt
    out: its own rows go to one of several salts each, its other rows to all of them.
    """
    if bits > 3:
        raise ValueError("keys find up to three bits")
    spark = fps.sparkSession
    keys = fps.mapInArrow(_key_rows, "_key int, _fp long, _own boolean")
    large = fps.mapInArrow(_own_rows, "_key int").groupBy("_key").count().where(
        F.col("count") > piece)
    large = materialize(large.select("_key", F.ceil(F.col("count") / piece).cast("int").alias(
        "_salts")), "large-keys")
    n_large = large.count()
    if n_large:
        side = F.broadcast(large) if n_large <= 100_000 else large
        at = F.pmod(F.xxhash64("_fp"), F.col("_salts")).cast("int")
        dealt = (keys.join(side, "_key", "left")
                 .withColumn("_salts", F.coalesce("_salts", F.lit(1)))
                 .withColumn("_at", at)
                 .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
                 .withColumn("_own", F.col("_own") & (F.col("_at") == F.col("_salt")))
                 .select("_key", "_salt", "_fp", "_own"))
    else:
        dealt = keys.select("_key", F.lit(0).alias("_salt"), "_fp", "_own")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "_key", "_salt")
            .sortWithinPartitions("_key", "_salt", F.desc("_own"))
            .mapInArrow(_links(bits), "u long, v long"))


# --- groups --------------------------------------------------------------------------------------

def _groups(rows: DataFrame, bits: int, shingle: int, seed: int) -> DataFrame:
    """Of rows ``_uid, _id, _text``: ``_uid, _id, _fp, _best`` with the group's first row."""
    fps = materialize(fingerprints(rows, shingle, seed), "fingerprints")
    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_uid"))
    distinct = materialize(fps.groupBy("_fp").agg(F.min(first).alias("_first")), "distinct")
    roots = components(fingerprint_links(distinct.select("_fp"), bits))
    placed = distinct.join(roots, distinct["_fp"] == roots["node"], "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_root"))
    best = placed.groupBy("_root").agg(F.min("_first").alias("_best"))
    return fps.join(placed.select("_fp", "_root").join(best, "_root"), "_fp").select(
        "_uid", "_id", "_fp", "_best")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3,
                   shingle: int = 3, seed: int = 42) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits), ``component_id`` (the least id reachable over
    links of ``bits`` or fewer differing bits, its own included).

    Null texts are empty texts; texts without words have fingerprint zero and are linked like any
    other. A null id is passed over as component id unless the group has no other. Repeated rows
    each give their row. Equal fingerprints are one node, so copies of any number cost nothing
    beyond their own rows. Other columns are not read. An empty table gives no rows.
    """
    rows = df.select(F.monotonically_increasing_id().alias("_uid"), F.col(id_col).alias("_id"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    return _groups(rows, bits, shingle, seed).select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_best._id").alias("component_id"))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3,
                     shingle: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``df`` with the least id of their group, one per group, with all columns."""
    numbered = materialize(df.select(F.monotonically_increasing_id().alias("_uid"), F.struct(*[
        F.col(f"`{c}`") for c in df.columns]).alias("_row")), "numbered")
    rows = numbered.select(
        "_uid", F.col(f"_row.`{id_col}`").alias("_id"),
        F.coalesce(F.col(f"_row.`{text_col}`"), F.lit("")).cast("binary").alias("_text"))
    kept = _groups(rows, bits, shingle, seed).where("_uid = _best._uid").select("_uid")
    return numbered.join(kept, "_uid", "left_semi").select("_row.*")
