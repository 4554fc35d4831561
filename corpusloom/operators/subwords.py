"""Subword vocabularies learnt by merging pairs, and words cut by them.

A word is a text in which every symbol stands between two spaces (words hold none): at first its
characters. A merge is then one replacement, left to right, and neighbours are told by the double
space. Only the leading pairs of a round reach the driver.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusloom.operators import tokens
from corpusloom.operators.order import check_keys
from corpusloom.operators.tokens import (ID_TYPES, UNKNOWN, _check_eos, _cut_in_place, _row_words,
                                         build_word_vocab, characters, encode_join)
from corpusloom.session import BROADCAST_BYTES, drop_path, materialize, scratch_path

#: Pairs that the driver looks at to find the merges of a round, and most merges of a round.
LEADING, ROUND = 512, 64
#: Merges that may be sent to every task.
MERGES = 262_144
#: Symbols of a word up to which all its pairs are looked at in each step; longer ones have a heap.
STEPS = 32
#: Pairs counted before a task hands counts on.
PAIRS_AT_ONCE = 400_000


def spaced(word: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(characters(word), "  "), F.lit(" "))


def pair_counts(words: DataFrame) -> DataFrame:
    """``pair, n``: how often symbols stand side by side (``left  right``) in the words ``_s``, each
    ``n`` times, less how often they did in ``_old`` where that is not null."""
    def rows(counts):
        found = {f"{a}  {b}": n for (a, b), n in counts.items() if n}
        return pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["pair", "n"])

    def run(batches):
        counts = Counter()
        for batch in batches:
            for s, old, n in zip(*(batch.column(c).to_pylist() for c in ("_s", "_old", "n"))):
                parts = s[1:-1].split("  ")
                for pair in zip(parts, parts[1:]):
                    counts[pair] += n
                if old is not None:
                    parts = old[1:-1].split("  ")
                    for pair in zip(parts, parts[1:]):
                        counts[pair] -= n
                if len(counts) > PAIRS_AT_ONCE:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)

    return words.select("_s", "_old", "n").mapInArrow(run, "pair string, n bigint")


def merged(s: Column, pair: Column) -> Column:
    return F.replace(s, F.concat(F.lit(" "), pair, F.lit(" ")),
                     F.concat(F.lit(" "), F.replace(pair, F.lit("  "), F.lit("")), F.lit(" ")))


def leading_merges(top: list[tuple[str, str, int]], room: int, complete: bool,
                   known: set[str]) -> list[tuple[str, str, int]]:
    """The merges that one after the other would make next, as far as ``top`` tells: pairs by falling
    count, then by symbols; ``complete`` if there are no others.

    Pairs without a symbol in common leave each other's counts alone. A pair that a merge brings up
    counts no more than one of its parts had with the same neighbour, so it does not come before a
    pair that came before that one. Three cases end the round: a merge whose outcome is a symbol
    already (its pairs grow), or of a symbol with itself, and a tie with a pair that goes on from the
    end of an earlier merge, since what comes of that may be the first by its symbols.
    """
    chosen: list = []
    used: set[str] = set()
    ends: set[str] = set()
    for i, (left, right, n) in enumerate(top):
        if len(chosen) == min(room, ROUND) or left in used or right in used:
            break
        if chosen:
            if not complete and top[-1][2] == n:
                break
            if any(x[2] == n and x[0] in ends for x in top[i + 1:]):
                break
        chosen.append((left, right, n))
        if left == right or left + right in known:
            break
        known.add(left + right)
        used |= {left, right}
        ends.add(right)
    known.update(a + b for a, b, _ in chosen)
    return chosen


def learn_merges(counts: DataFrame, n_merges: int, min_count: int = 2) -> DataFrame:
    """The first ``n_merges`` merges of the most frequent pair of neighbouring symbols, ties by the
    symbols: ``rank, left, right, n`` (how often the pair stood when it was merged).

    ``counts`` has ``token, n``, a row per word (:func:`word_counts`). Pairs are counted once; a
    round then merges as many pairs as cannot disturb each other (:func:`leading_merges`), rewrites
    the words and changes the counts by what was lost and won in words that did change. Stops early
    where no pair stands ``min_count`` times. Null and empty words have no pairs.
    """
    if n_merges > MERGES:
        raise ValueError(f"at most {MERGES} merges")
    spark = counts.sparkSession

    def write(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return path, spark.read.schema(df.schema).parquet(path)

    state_path, state = write(counts.where(F.length("token") > 1).select(
        spaced(F.col("token")).alias("_s"), F.col("n").cast("bigint").alias("n")), "symbols")
    pairs_path, pairs = write(pair_counts(state.withColumn(
        "_old", F.lit(None).cast("string"))).groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    merges: list = []
    known: set[str] = set()
    while len(merges) < n_merges:
        rows = pairs.where(F.col("n") >= min_count).select(
            F.split_part("pair", F.lit("  "), F.lit(1)).alias("left"),
            F.split_part("pair", F.lit("  "), F.lit(2)).alias("right"), "n").orderBy(
            F.desc("n"), "left", "right").limit(LEADING + 1).collect()
        now = leading_merges([tuple(r) for r in rows[:LEADING]], n_merges - len(merges),
                             len(rows) <= LEADING, known)
        if not now:
            break
        merges += now
        if len(merges) == n_merges:
            break
        after = reduce(lambda s, m: merged(s, F.lit(f"{m[0]}  {m[1]}")), now, F.col("_s"))
        old_state, old_pairs = state_path, pairs_path
        state_path, state = write(
            state.withColumn("_new", after).select(
                F.col("_new").alias("_s"), "n",
                F.when(F.col("_new") != F.col("_s"), F.col("_s")).alias("_old")), "symbols")
        change = pair_counts(state.where(F.col("_old").isNotNull()))
        pairs_path, pairs = write(
            pairs.union(change).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0"), "pairs")
        state = state.select("_s", "n")
        drop_path(spark, old_state)
        drop_path(spark, old_pairs)
    drop_path(spark, state_path)
    drop_path(spark, pairs_path)
    return spark.createDataFrame([(i, *m) for i, m in enumerate(merges)],
                                 "rank int, left string, right string, n bigint")


def merge_vocab(chars: DataFrame, merges: DataFrame, specials: tuple[str, ...] = ()) -> DataFrame:
    """``token, id``: the specials, then the characters (``ch, id``), then what merges make, in their
    order; of merges with one outcome the first counts."""
    spark = merges.sparkSession
    made = merges.select(F.concat("left", "right").alias("token"), "rank").groupBy("token").agg(
        F.min("rank").alias("rank")).collect()  # bounded by MERGES
    first = chars.select("ch", "id").where(~F.col("ch").isin(*specials)).collect()
    listed = [*specials, *[r["ch"] for r in sorted(first, key=lambda r: r["id"])],
              *[r["token"] for r in sorted(made, key=lambda r: r["rank"])
                if r["token"] not in specials]]
    return spark.createDataFrame([(t, i) for i, t in enumerate(listed)], "token string, id int")


def _merged_once(parts: list[str], left: str, right: str) -> list[str]:
    """One merge, left to right."""
    out, i, last = [], 0, len(parts) - 1
    while i <= last:
        if i < last and parts[i] == left and parts[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def _split_short(parts: list[str], ranks: dict) -> list[str]:
    """The pairs are looked at again after each merge."""
    while len(parts) > 1:
        found = [(ranks[p], p) for p in zip(parts, parts[1:]) if p in ranks]
        if not found:
            break
        parts = _merged_once(parts, *min(found)[1])
    return parts


def _split_long(parts: list[str], ranks: dict) -> list[str]:
    """The pairs wait in a heap by rank and place, so a word costs little more than its length."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
    heapify(heap)
    while heap:
        rank, fresh = heap[0][0], []
        while heap and heap[0][0] == rank:
            i = heappop(heap)[1]
            j = after[i]
            if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            fresh.append(i)
        # What comes of a merge is looked at when the merge is made all over the word.
        for i in fresh:
            for k in (before[i], i):
                if k >= 0 and parts[k] is not None and after[k] < n:
                    found = ranks.get((parts[k], parts[after[k]]))
                    if found is not None:
                        heappush(heap, (found, k))
    return [p for p in parts if p is not None]


def _merge_splitter(merges: DataFrame):
    """A word to its symbols after all merges as a function that tasks are given."""
    check_keys(merges, "rank")
    listed = merges.select("rank", "left", "right").limit(MERGES + 1).collect()
    if len(listed) > MERGES:
        raise ValueError(f"at most {MERGES} merges")
    # Of a pair that is listed twice the first merge counts.
    ranks = {(r["left"], r["right"]): r["rank"]
             for r in sorted(listed, key=lambda r: r["rank"], reverse=True)}
    steps = STEPS

    def split(word):
        parts = list(word or "")
        return (_split_short if len(parts) <= steps else _split_long)(parts, ranks)

    return split


def split_by_merges(distinct: DataFrame, merges: DataFrame) -> DataFrame:
    """Adds ``parts`` to a table of different words (``token``): its symbols after all merges.

    In each word the merge of the least rank is made until none is left. The merges (bounded by
    ``MERGES``) are with every task, which goes through its words once, a batch at a time; a word
    may be of any length.
    """
    split = _merge_splitter(merges)

    def run(batches):
        for batch in batches:
            parts = [split(word) for word in batch.column("token").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(parts, pa.list_(pa.string()))],
                [*batch.schema.names, "parts"])

    schema = T.StructType([*distinct.schema.fields,
                           T.StructField("parts", T.ArrayType(T.StringType()))])
    return materialize(distinct.mapInArrow(run, schema), "split-words")


def _known_ids(vocab: DataFrame) -> dict | None:
    """A vocabulary that tasks are given, or None if it is too large for that."""
    entries = vocab.select(F.col("token").alias("_token"), "id")
    n = check_keys(entries, "_token")
    n_bytes = entries.agg(F.sum(F.octet_length("_token").cast("bigint"))).first()[0] or 0
    if n > tokens.TABLE_ROWS or n_bytes > BROADCAST_BYTES:
        return None
    return {r["_token"]: r["id"] for r in entries.collect() if r["id"] is not None}


def encode_merges(df: DataFrame, merges: DataFrame, vocab: DataFrame, text: str = "text",
                  key: str = "row_id", out: str = "ids", keep: tuple[str, ...] = ("split",),
                  eos: str | None = None, unknown: str = UNKNOWN,
                  max_len: int | None = None) -> DataFrame:
    """Text to ids of learnt subwords.

    With a vocabulary of up to ``TABLE_ROWS`` entries each different word of a batch of rows is split
    once, where it stands; no row is moved. With a larger one every different word of all rows is
    split once and looked up. Keys that are null or stand twice raise if there are more words than are
    looked up in place. A part that is not in ``vocab`` (``token, id``) is the unknown id, or null
    without one. The end marker is one token. ``max_len`` keeps the first ids of a row.
    """
    _check_eos(eos)
    row = vocab.where(F.col("token") == unknown).select("id").first()
    kind = vocab.schema["id"].dataType.simpleString()
    known = _known_ids(vocab) if kind in ID_TYPES else None
    if known is not None:
        split, unknown_id = _merge_splitter(merges), row["id"] if row else None

        def ids_of(word):
            return [known.get(part, unknown_id) for part in ([eos] if word == eos else split(word))]

        return _cut_in_place(df, ids_of, kind, text, key, out, keep, eos, max_len)
    every = materialize(build_word_vocab(df, 2 ** 31 - 1, text=text, specials=(), eos=eos).select(
        "token", F.col("id").alias("rank")), "words")
    split = split_by_merges(every, merges)
    if eos:
        split = split.withColumn("parts", F.when(
            F.col("token") == eos, F.array(F.lit(eos))).otherwise(F.col("parts")))
    numbered = encode_join(split, "parts", vocab, "rank", "id", ("token",),
                           row["id"] if row else None)
    table = materialize(numbered, "word-ids")
    rows = df.withColumn("_words", _row_words(text, eos))
    coded = encode_join(rows, "_words", table, key, "_parts", keep,
                        [row["id"] if row else None], rank="rank")
    ids = F.flatten("_parts")
    return coded.withColumn(out, ids if max_len is None else F.slice(ids, 1, max_len)).drop("_parts")
