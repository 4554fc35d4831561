"""Document fingerprints by I-Match over randomised subsets of a lexicon."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType,
)

from corpusloom.operators.order import MAX_BUCKETS, key_bounds, range_bucket

TERM = re.compile(r"\w+")
#: Subsets keep a term with chance 1/2 to the power of their level; level 0 is the whole lexicon.
LEVELS, PER_LEVEL = 11, 5
SUBSETS = 1 + LEVELS * PER_LEVEL
#: Subsets that the entries of all terms are made of: the whole and three of each level from 3 on.
OWN = np.uint64(1 | sum(1 << i for i in range(1 + 2 * PER_LEVEL, SUBSETS)
                        if (i - 1) % PER_LEVEL < 3))
NO_ENTRIES = "." * (SUBSETS - 1)
#: Terms counted before a task hands counts on; characters fingerprinted together.
TERMS_AT_ONCE, CHARS_AT_ONCE = 400_000, 1_000_000


def term_hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))


# --- lexicon -------------------------------------------------------------------------------------

def document_counts(texts: DataFrame) -> DataFrame:
    """``_term, _n``: in how many of the texts (column ``_text``) each term stands, by its hash."""
    def run(batches):
        counts = Counter()
        for batch in batches:
            for text in batch.column("_text").to_pylist():
                counts.update(set(TERM.findall((text or "").lower())))
                if len(counts) > TERMS_AT_ONCE:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)

    def rows(counts):
        keys = np.fromiter(map(term_hash, counts), np.uint64, len(counts))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(list(counts.values()), pa.int64())],
            ["_term", "_n"])

    return texts.mapInArrow(run, "_term long, _n long").groupBy("_term").agg(
        F.sum("_n").alias("_n"))


def subsets_of(terms: np.ndarray, seed: int) -> np.ndarray:
    """For each term the subsets that keep it, as bits."""
    kept = np.ones(len(terms), np.uint64)  # subset 0
    with np.errstate(over="ignore"):
        for i in range(1, SUBSETS):
            x = terms ^ np.uint64(xxhash.xxh64_intdigest(b"subset%d" % i, seed))
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
            level = 1 + (i - 1) // PER_LEVEL
            kept |= (x >> np.uint64(64 - level) == 0).astype(np.uint64) << np.uint64(i)
    return kept


class Lexicon:
    """Hashes of the terms in use, ascending, and for each the subsets that keep it, as bits."""

    def __init__(self, terms: np.ndarray, seed: int = 42):
        self.terms = np.sort(terms.astype(np.uint64))
        self.kept = subsets_of(self.terms, seed)
        self.seed = seed


def build_lexicon(df: DataFrame, text_col: str = "text", most_share: float = 0.1,
                  least_share: float = 1 / 5000, seed: int = 42) -> Lexicon:
    """The terms whose inverse document frequency lies in a band: they stand in at least
    ``least_share`` (and two) and at most ``most_share`` of all documents, counted over all.

    The shares bound its size: there are at most (mean number of different terms in a document) /
    ``least_share`` such terms, whatever the number of documents, so that the driver and the tasks
    can hold it.
    """
    texts = df.select(F.col(text_col).alias("_text"))
    n = texts.count()
    terms = document_counts(texts).where(
        (F.col("_n") >= max(2, math.ceil(n * least_share))) & (F.col("_n") <= n * most_share)
    ).select("_term").toArrow()["_term"].to_numpy()
    return Lexicon(terms.view(np.uint64), seed)


# --- fingerprints --------------------------------------------------------------------------------

def _entries(terms: np.ndarray, kept: np.ndarray) -> str:
    bits = np.unpackbits(kept.view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")[:, :SUBSETS]
    data = memoryview(terms[np.nonzero(bits.T)[1]].tobytes())
    digest, entries, a = xxhash.xxh32_hexdigest, [], 0
    for n in bits.sum(axis=0, dtype=np.int64).tolist():
        entries.append(f"{n:x}-{digest(data[8 * a:8 * (a + n)])}" if n else "")
        a += n
    return ".".join(entries)


def fingerprints(lexicon: Lexicon, texts: list[str]) -> list[str]:
    """Per text two lists of entries, joined by dots, a bar between the lists.

    The first list has an entry for each subset of the lexicon: ``n-hash`` (hex) of the ``n``
    distinct terms of the text that the subset keeps, in sorted order, or nothing where there are
    none. The second one is made alike from all distinct terms of the text, the lexicon or not, by
    the whole and the thinner subsets alone (``OWN``): it is what texts are compared by that have no
    term of the lexicon. A text without any term has the entry ``0-hash`` of itself there.
    """
    sets = [set(TERM.findall(t.lower())) for t in texts]
    number: dict[str, int] = {}
    for terms in sets:
        for t in terms:
            number.setdefault(t, len(number))
    hashes = np.fromiter(map(term_hash, number), np.uint64, len(number))
    own_kept = subsets_of(hashes, lexicon.seed) & OWN
    at = np.searchsorted(lexicon.terms, hashes)
    known = at < len(lexicon.terms)
    known[known] = lexicon.terms[at[known]] == hashes[known]
    at[~known] = -1
    # terms in the order of their hashes, so that a text's are sorted where its places are
    place = np.empty(len(hashes), np.int64)
    by_hash = np.argsort(hashes)
    place[by_hash] = np.arange(len(hashes))
    hashes, own_kept, at = hashes[by_hash], own_kept[by_hash], at[by_hash]
    out = []
    for text, terms in zip(texts, sets):
        own = np.sort(place[np.fromiter(map(number.__getitem__, terms), np.int64, len(terms))])
        if not len(own):
            rest = xxhash.xxh32_hexdigest(text.encode("utf-8", "surrogatepass"))
            out.append(f"{NO_ENTRIES}|0-{rest}{NO_ENTRIES}")
            continue
        listed = at[own]
        listed = listed[listed >= 0]
        out.append((_entries(lexicon.terms[listed], lexicon.kept[listed]) if len(listed)
                    else NO_ENTRIES) + "|" + _entries(hashes[own], own_kept[own]))
    return out


def likeness(one: str, other: str) -> float:
    """How much two fingerprints agree, 0 to 1: the share of equal entries among those that either
    has, an entry of n terms weighing 1/n (the more terms of the two), as one changed term changes
    all of it. Where either has no term of the lexicon, the entries of all terms count."""
    if one == other:
        return 1.0
    lists = list(zip(one.split("|"), other.split("|")))
    if NO_ENTRIES in lists[0]:
        lists.reverse()
    same = total = 0.0
    for a, b in zip(*(x.split(".") for x in lists[0])):
        if a or b:
            n = max(int(a.partition("-")[0] or "0", 16), int(b.partition("-")[0] or "0", 16))
            if n:
                total += 1 / n
                same += (a == b) / n
    return same / total if total else 0.0


def fingerprint_documents(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_chars``, ``fingerprint``. Null texts are empty texts."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for low, high in lots(texts):
                part = texts[low:high]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(low, high - low),
                     pa.array([len(t) for t in part], pa.int64()),
                     pa.array(fingerprints(shared.value, part), pa.string())],
                    [id_col, "n_chars", "fingerprint"])

    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, StructType([
        StructField(id_col, rows.schema["_id"].dataType), StructField("n_chars", LongType()),
        StructField("fingerprint", StringType())]))


def lots(texts: list[str]):
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size < CHARS_AT_ONCE):
            size += len(texts[high])
            high += 1
        yield low, high
        low = high


# --- each document beside the next ---------------------------------------------------------------

def beside_next(df: DataFrame, id_col: str, text_col: str, buckets: int | None = None) -> DataFrame:
    """Rows ``_bucket, _flag, _id, _text`` in partitions sorted so that within a bucket each row is
    followed by the next one in falling order of ids; the row that follows a bucket's last stands
    at its end with flag 1. The last row of all is followed by the first.

    Buckets are ranges of ids. The texts move once; a bucket gets one row more.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    n = rows.count()
    buckets = buckets or min(MAX_BUCKETS, max(256, n // 20_000))
    bounds = key_bounds(rows.where(F.col("_id").isNotNull()), "_id", n, buckets) if n else []
    tagged = rows.withColumn("_bucket", range_bucket(rows, "_id", bounds or []))
    tops = sorted(((r["_bucket"], r["_top"]) for r in tagged.groupBy("_bucket").agg(
        F.max("_id").alias("_top")).collect()), reverse=True)  # one row per bucket
    after = [(tops[(i + 1) % len(tops)] + (b,)) for i, (b, _) in enumerate(tops)]
    schema = StructType([StructField("_from", tagged.schema["_bucket"].dataType),
                         StructField("_top", rows.schema["_id"].dataType),
                         StructField("_to", tagged.schema["_bucket"].dataType)])
    edges = F.broadcast(spark.createDataFrame(after, schema))  # at most MAX_BUCKETS rows
    copies = tagged.join(edges, (F.col("_bucket") == F.col("_from"))
                         & F.col("_id").eqNullSafe(F.col("_top"))).select(
        F.col("_to").alias("_bucket"), F.lit(1).alias("_flag"), "_id", "_text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (tagged.select("_bucket", F.lit(0).alias("_flag"), "_id", "_text").union(copies)
            .repartition(parts, "_bucket")
            .sortWithinPartitions("_bucket", "_flag", F.col("_id").desc_nulls_last(),
                                  F.col("_text").desc()))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the beginning of the
    following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_edited(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id",
                   text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Per row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``; the next document is the one with the next lower id, after the
    last the first.

    Null texts are empty texts. Null ids come after all others. Rows with the same id follow each
    other by falling text, so repeated rows are each other's next. A single row is its own next.
    Other columns are not read; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        held = None  # last row of the previous batch, still without its next
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist()
                              for c in ("_bucket", "_flag", "_text"))))
            ids = batch.column("_id")
            if held:
                rows.insert(0, held[0])
                ids = pa.concat_arrays([held[1], ids])
            # a row waits for its next one unless that is known to be missing
            for low, high in lots([r[2] for r in rows]):
                yield from lot(rows[low:high + 1], ids.slice(low, high + 1 - low))
            held = rows[-1], ids.slice(len(rows) - 1, 1)

    def lot(rows, ids):
        """Rows but the last, each with the one behind it."""
        firsts = [i for i, (r, s) in enumerate(zip(rows, rows[1:]))
                  if r[1] == 0 and r[0] == s[0]]
        if not firsts:
            return
        texts = [r[2] for r in rows]
        changed = [edited(texts[i], texts[i + 1]) for i in firsts]
        own = fingerprints(shared.value, texts)
        other = fingerprints(shared.value, changed)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(firsts, pa.int64())),
             pa.array([len(texts[i]) for i in firsts], pa.int64()),
             pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
                       for t in changed], pa.string()),
             pa.array([own[i] for i in firsts], pa.string()), pa.array(other, pa.string()),
             pa.array([likeness(own[i], f) for i, f in zip(firsts, other)], pa.float64()),
             pa.array([likeness(own[i], own[i + 1]) for i in firsts], pa.float64())],
            schema.names)

    schema = StructType([
        StructField(id_col, df.schema[id_col].dataType), StructField("n_chars", LongType()),
        StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()),
        StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()),
        StructField("near_next", DoubleType())])
    if not df.head(1):
        return df.sparkSession.createDataFrame([], schema)
    return beside_next(df, id_col, text_col, buckets).mapInArrow(run, schema)
