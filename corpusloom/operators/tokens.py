"""Vocabularies, and text to ids and back."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corpusloom.functions.text import append_eos
from corpusloom.operators.order import check_keys, key_at, key_bounds, range_bucket
from corpusloom.operators.rendering import drop_blank
from corpusloom.session import BROADCAST_BYTES, BROADCAST_ROWS, materialize

WORD = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
PAD, UNKNOWN = "<pad>", "<unk>"
MAX_RANGES = 64
# A text is taken apart into tokens in pieces of about this many characters.
PIECE = 65_536
# Words of one count that a task numbers; with more, ranges of them are numbered apart.
TIED_WORDS = 1_000_000
# Parts of words up to this long meet the table as they are; of longer entries the beginning does. A
# long word is taken apart in windows of so many characters.
SHORT, WINDOW = 16, 1024
# Entries of a given token table that may be with every task (of BROADCAST_BYTES at most), and words
# of a batch that are cut at once.
TABLE_ROWS, WORDS_AT_ONCE = 262_144, 1_000_000
ID_TYPES = {"int": (T.IntegerType(), pa.int32()), "bigint": (T.LongType(), pa.int64())}
# Entries of a vocabulary (those with the least ids, and of so many bytes at most) that are a
# constant of the plan. The rest is joined; the ids are the same.
LOOKUP_ROWS, LOOKUP_BYTES = 65_536, 64


def characters(c: Column) -> Column:
    """The characters of a text; empty text has none."""
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ""))


# --- characters ----------------------------------------------------------------------------------

def _outside(seen: list[str]) -> str | None:
    """A pattern for characters that are not among ``seen``, or None.

    It may leave out some of ``seen``: it only spares the work of listing what is known. The first
    256 code points are a bit set and cost nothing; of the others it names at most 64 ranges.
    """
    codes = sorted(ord(c) for c in seen)
    low = [f"\\x{{{c:x}}}" for c in codes if c < 256]
    ranges: list[list[int]] = []
    for code in codes:
        if code < 256:
            continue
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    widest = sorted(ranges, key=lambda r: r[0] - r[1])[:MAX_RANGES]
    high = [f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in widest]
    return "[^" + "".join(low + high) + "]" if codes else None


def build_char_vocab(df: DataFrame, text: str = "text", extra: str = "",
                     seed_rows: int = 200) -> DataFrame:
    """Distinct characters in code point order with ids from 0: ``ch, id``.

    Counted on every split. The characters of a few rows are listed first; the full pass then only
    takes out what is not among them, so most rows yield nothing to group. ``extra`` adds characters
    such as those of a separator. At most one row per Unicode character.
    """
    spark = df.sparkSession
    chars = df.select(F.col(text).alias("_t")).where(F.length("_t") > 0)
    seen = [r.ch for r in chars.limit(seed_rows).select(
        F.explode(F.split("_t", "")).alias("ch")).distinct().collect()]
    outside = _outside(seen)
    listed = (F.regexp_extract_all("_t", F.lit(outside), F.lit(0)) if outside
              else F.split("_t", ""))
    found = chars.select(F.explode(listed).alias("ch"))
    known = spark.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps(sorted({*seen, *extra}))), "array<string>")).alias("ch"))
    order = F.row_number().over(Window.orderBy("ch")) - 1
    return found.union(known).distinct().select("ch", order.cast("int").alias("id"))


def vocab_size(df: DataFrame, text: str = "text", extra: str = "") -> DataFrame:
    return build_char_vocab(df, text, extra).agg(F.count("*").alias("vocab_size"))


class CharTable:
    """A collected character vocabulary as constant arrays (bounded by Unicode).

    Ids are found by code point in two steps: 256 code points form a page, and only pages in use are
    held. The arrays are constants of the plan, so encoding is a projection without any join.
    """

    def __init__(self, vocab: DataFrame):
        rows = vocab.select("ch", "id").collect()
        self.ids = {r["ch"]: r["id"] for r in rows}
        self.size = len(self.ids)

    def id_of(self, ch: Column) -> Column:
        code = F.ascii(ch)
        top = max((ord(c) for c in self.ids), default=0)
        if top < 2 ** 14:
            flat: list = [None] * (top + 1)
            for c, i in self.ids.items():
                flat[ord(c)] = i
            return F.get(_int_array(flat), code)
        starts: list = [None] * (top // 256 + 1)
        cells: list = []
        for c, i in sorted(self.ids.items()):
            page = ord(c) // 256
            if starts[page] is None:
                starts[page] = len(cells)
                cells += [None] * 256
            cells[starts[page] + ord(c) % 256] = i
        page = F.get(_int_array(starts), F.shiftright(code, 8))
        return F.get(_int_array(cells), page + code.bitwiseAND(255))

    def encode(self, text: Column, on_unknown: str = "error") -> Column:
        def one(ch):
            found = self.id_of(ch)
            if on_unknown != "error":
                return found
            return F.coalesce(found, F.raise_error(
                F.concat(F.lit("character not in the vocabulary: "), ch)).cast("int"))

        ids = F.transform(F.split(text, ""), one)
        if on_unknown == "drop":
            ids = F.array_compact(ids)
        return F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(ids)

    def known(self, text: Column, value: Column) -> Column:
        """``value``, or the error of an unknown character if ``text`` has one."""
        left = F.translate(text, "".join(sorted(self.ids)), "")
        return F.when(F.coalesce(left, F.lit("")) == "", value).otherwise(F.raise_error(F.concat(
            F.lit("character not in the vocabulary: "), F.left(left, F.lit(1)))).cast("array<int>"))

    def decode(self, ids: Column) -> Column:
        by_id: list = [None] * (max(self.ids.values(), default=-1) + 1)
        for c, i in self.ids.items():
            by_id[i] = c
        chars = F.from_json(F.lit(json.dumps(by_id)), "array<string>")
        return F.array_join(F.transform(ids, lambda i: F.get(chars, i)), "")


def _int_array(values: list) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<int>")


def char_table(vocab: DataFrame | CharTable) -> CharTable:
    return vocab if isinstance(vocab, CharTable) else CharTable(vocab)


def encode_chars(df: DataFrame, vocab: DataFrame | CharTable, text: str = "text",
                 out: str = "ids", on_unknown: str = "error") -> DataFrame:
    """Text to ids. An unknown character is an error, a null id (``null``) or left out (``drop``)."""
    if on_unknown not in ("error", "null", "drop"):
        raise ValueError("on_unknown must be 'error', 'null' or 'drop'")
    return df.withColumn(out, char_table(vocab).encode(F.col(text), on_unknown))


def decode_chars(df: DataFrame, vocab: DataFrame | CharTable, ids: str = "ids",
                 out: str = "text") -> DataFrame:
    return df.withColumn(out, char_table(vocab).decode(F.col(ids)))


# --- ids through a vocabulary table --------------------------------------------------------------

def _lookup(vocab: DataFrame, rows: int):
    """Token to id (null if unknown) as an expression over a constant table of ``rows`` entries.

    The table is cells of a few entries; tokens are values in it, of any length and content.
    """
    size = 1 << (2 * rows).bit_length()
    kind = vocab.schema["_id"].dataType.simpleString()

    def cell(token):
        return F.pmod(F.xxhash64(token), F.lit(size)).cast("int")

    tokens: list = [[] for _ in range(size)]
    ids: list = [[] for _ in range(size)]
    for r in vocab.select("_token", "_id", cell(F.col("_token")).alias("cell")).limit(
            rows + 1).collect():
        tokens[r["cell"]].append(r["_token"])
        ids[r["cell"]].append(r["_id"])
    if sum(map(len, ids)) > rows:
        raise ValueError("ids of a vocabulary must be unique")

    def constant(value, kind):
        return F.from_json(F.lit(json.dumps(value)), f"array<array<{kind}>>", {"mode": "FAILFAST"})

    n, tokens, ids = sum(map(len, ids)), constant(tokens, "string"), constant(ids, kind)

    def id_of(token):
        at = cell(token)
        return F.get(F.get(ids, at), F.array_position(F.get(tokens, at), token).cast("int") - 1)

    return id_of, n


def _in_plan(token: str, number: str) -> Column:
    return (F.col(number) < LOOKUP_ROWS) & (F.octet_length(token) <= LOOKUP_BYTES)


def fits_plan(vocab: DataFrame, token: str = "token") -> bool:
    """Whether all of a vocabulary is looked up in place."""
    return not vocab.where(~_in_plan(token, "id")).head(1)


def encode_join(df: DataFrame, tokens: str, vocab: DataFrame, key: str = "row_id",
                out: str = "ids", keep: tuple[str, ...] = ("split",),
                unknown_id: int | list[int] | None = None, token: str = "token",
                broadcast_rows: int | None = None, rank: str = "id") -> DataFrame:
    """Arrays of tokens to arrays of ids by a vocabulary of any size: ``key, keep..., out``.

    The entries with the least ids (the frequent ones) are looked up in place, by a constant of the
    plan. If the vocabulary has more, the positions that are still open leave their rows, meet the
    other entries in a join on the token (broadcast up to ``broadcast_rows``, else by shuffle: none of
    them is frequent) and are put back by the key; ids that were found stay where they are. Tokens
    and keys must be unique, else it raises. Ids may be lists; ``rank`` then names a column that
    numbers the tokens, the frequent ones first.
    """
    keep = tuple(c for c in keep if c in df.columns and c != key)
    vocab = vocab.select(
        F.col(token).alias("_token"), F.col("id").alias("_id"), F.col(rank).alias("_rank"))
    kind = vocab.schema["_id"].dataType.simpleString()
    in_plan = _in_plan("_token", "_rank")
    rows = check_keys(vocab, "_token")
    id_of, n_head = _lookup(vocab.where(in_plan), min(rows, LOOKUP_ROWS))
    unknown = F.lit(unknown_id).cast(kind)
    rest, n_rest = vocab.where(~in_plan), rows - n_head
    if n_rest == 0:
        ids = F.transform(F.col(tokens), lambda t: F.coalesce(id_of(t), unknown))
        return df.select(key, *keep, F.coalesce(ids, F.array().cast(f"array<{kind}>")).alias(out))

    check_keys(df, key)

    def slot(t, i):
        return F.struct(i.alias("pos"), id_of(t).alias("id"), t.alias("token"))

    slots = df.select(key, *keep, F.transform(F.col(tokens), slot).alias("_slots"))
    open_ = slots.select(key, F.inline(F.filter(
        "_slots", lambda s: s["id"].isNull() & s["token"].isNotNull()))).select(
        key, "pos", F.col("token").alias("_token"))
    most = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    side = F.broadcast(rest) if n_rest <= most and _small(rest) else rest
    found = open_.join(side, "_token").groupBy(key).agg(
        F.collect_list(F.struct("pos", F.col("_id").alias("id"))).alias("_found"))
    settled = F.transform(
        F.filter("_slots", lambda s: s["id"].isNotNull()),
        lambda s: F.struct(s["pos"].alias("pos"), s["id"].alias("id")))
    lost = F.array_except(
        F.transform(F.filter("_slots", lambda s: s["id"].isNull()), lambda s: s["pos"]),
        F.transform("_found", lambda s: s["pos"]))
    filled = F.concat(settled, F.col("_found"), F.transform(
        lost, lambda pos: F.struct(pos.alias("pos"), unknown.alias("id"))))
    none = F.array().cast(f"array<struct<pos:int,id:{kind}>>")
    ids = F.transform(F.sort_array(filled), lambda s: s["id"])
    return (
        slots.join(found, key, "left")
        .withColumns({"_found": F.coalesce("_found", none),
                      "_slots": F.coalesce("_slots", F.array().cast(slots.schema["_slots"].dataType))})
        .select(key, *keep, ids.alias(out)))


def _small(vocab: DataFrame) -> bool:
    """Whether the tokens are few bytes enough to be sent to every executor."""
    size = vocab.agg(F.sum(F.octet_length("_token").cast("bigint"))).first()[0] or 0
    return size <= BROADCAST_BYTES


# --- words ---------------------------------------------------------------------------------------

def word_pattern(eos: str | None = None) -> str:
    """Runs of letters and digits, single other signs, and the end marker as one token."""
    return (f"\\Q{eos}\\E|" if eos else "") + WORD


def words(c: Column, eos: str | None = None) -> Column:
    return F.regexp_extract_all(c, F.lit(word_pattern(eos)), F.lit(0))


def pieces(c: Column) -> Column:
    """A text in pieces that end before a whitespace, so that no token is cut.

    A long text then never is one array of all its tokens.
    """
    long = F.regexp_extract_all(c, F.lit(f"(?s).{{1,{PIECE}}}\\S*"), F.lit(0))
    return F.when(F.length(c) <= PIECE, F.array(c)).otherwise(long)


def _check_eos(eos: str | None) -> None:
    if eos and any(ch.isspace() for ch in eos):
        raise ValueError("the end marker must not hold whitespace")


def word_counts(df: DataFrame, text: str = "text", eos: str | None = None) -> DataFrame:
    _check_eos(eos)
    return (
        df.select(F.explode(pieces(F.col(text))).alias("_piece"))
        .select(F.explode(words(F.col("_piece"), eos)).alias("token"))
        .groupBy("token").agg(F.count("*").alias("n"))
    )


def number_words(counts: DataFrame, room: int, first: int) -> DataFrame:
    """The ``room`` most frequent of written counts (``token, n``), numbered from ``first`` on.

    A histogram of the counts (a row for each different one) tells the least count that gets in, and,
    of the words that have it, where the last one in stands. Words are numbered within their count,
    and where many have the same one within ranges of words, so no task sees them all.
    """
    falling = Window.orderBy(F.desc("n"))
    ranked = counts.groupBy("n").agg(F.count("*").alias("_words")).withColumn(
        "_before", F.sum("_words").over(falling) - F.col("_words")).where(F.col("_before") < room)
    shape = ranked.agg(F.sum("_words").alias("rows"), F.max("_words").alias("most"), F.max(F.when(
        F.col("_before") + F.col("_words") > room, F.struct("n", "_before", "_words"))).alias(
        "edge")).first()
    edge = shape["edge"]
    if edge is not None:
        tied = counts.where(F.col("n") == edge["n"])
        stop = key_at(tied, [room - edge["_before"]], "token", edge["_words"])[0]
        counts = counts.where((F.col("n") > edge["n"]) | (F.col("token") < F.lit(stop)))
    kept = counts.join(ranked.select("n", "_before"), "n")
    if (shape["most"] or 0) > TIED_WORDS:
        # Most words stand once or twice: they are numbered by ranges of words, then within.
        bounds = key_bounds(counts.select("token"), "token", shape["rows"])
        kept = kept.withColumn("_range", range_bucket(kept, "token", bounds))
        before = Window.partitionBy("n").orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1)
        base = kept.groupBy("n", "_range").agg(F.count("*").alias("_words")).select(
            "n", "_range", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_ahead"))
        inner = Window.partitionBy("n", "_range").orderBy("token")
        kept = kept.withColumn("_inner", F.row_number().over(inner)).join(
            base, ["n", "_range"]).withColumn("_inner", F.col("_inner") + F.col("_ahead"))
    else:
        kept = kept.withColumn(
            "_inner", F.row_number().over(Window.partitionBy("n").orderBy("token")))
    return kept.select("token", (F.col("_before") + F.col("_inner") - 1 + first).cast(
        "int").alias("id"), "n")


def build_word_vocab(df: DataFrame, max_size: int, min_count: int = 1, text: str = "text",
                     specials: tuple[str, ...] = (PAD, "</s>", UNKNOWN),
                     eos: str | None = None) -> DataFrame:
    """The ``max_size`` most frequent words with ids, specials first: ``token, id, n``.

    Counted on the map side before the shuffle; the counts are written once and numbered by
    :func:`number_words`.
    """
    if max_size < len(specials):
        raise ValueError("max_size must leave room for the special tokens")
    counts = word_counts(df, text, eos).where(F.col("n") >= min_count)
    if specials:
        counts = counts.where(~F.col("token").isin(*specials))
    counts = materialize(counts, "word-counts")
    kept = number_words(counts, max_size - len(specials), len(specials))
    first = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(s) for s in specials]).cast("array<string>"))
        .alias("id", "token")).select("token", "id", F.lit(0).cast("bigint").alias("n"))
    return first.union(kept)


def encode_words(df: DataFrame, vocab: DataFrame, text: str = "text", key: str = "row_id",
                 out: str = "ids", keep: tuple[str, ...] = ("split",), eos: str | None = None,
                 unknown: str = UNKNOWN, max_len: int | None = None,
                 broadcast_rows: int | None = None) -> DataFrame:
    """Text to word ids by :func:`encode_join`; ``max_len`` keeps the first ids of a row.

    With a vocabulary that is a constant of the plan this is a projection and moves no row. The
    vocabulary is read more than once, so pass a written one (``materialize``).
    """
    _check_eos(eos)
    row = vocab.where(F.col("token") == unknown).select("id").first()

    def tokens(piece):
        found = words(piece, eos)
        # No piece can give more to the first ids; the row is cut below.
        return found if max_len is None else F.slice(found, 1, max_len)

    all_words = F.flatten(F.transform(pieces(F.col(text)), tokens))
    if max_len is not None:
        all_words = F.slice(all_words, 1, max_len)
    rows = df.withColumn("_words", F.coalesce(all_words, F.array().cast("array<string>")))
    return encode_join(rows, "_words", vocab, key, out, keep, row["id"] if row else None,
                       broadcast_rows=broadcast_rows)


# --- parts of words ------------------------------------------------------------------------------

def _longest_entry(vocab: DataFrame, mark: str, max_piece: int | None) -> int:
    size = F.length("token")
    marked = F.startswith(F.col("token"), F.lit(mark))
    longest = vocab.agg(F.max(F.when(marked, size - len(mark)).otherwise(size))).first()[0] or 0
    if max_piece is not None and max_piece < longest:
        raise ValueError(f"max_piece is {max_piece}, the table has an entry of {longest}")
    return longest


def _word_splitter(vocab: DataFrame, unknown_id: int | None, mark: str):
    """A word to the ids of its parts as a function that tasks are given, or None if the table is too
    large for that."""
    entries = vocab.select("token", F.col("id").cast("int").alias("id")).where(F.length("token") > 0)
    n, n_bytes = entries.agg(
        F.count("*"), F.sum(F.octet_length("token").cast("bigint"))).first()
    if n > TABLE_ROWS or (n_bytes or 0) > BROADCAST_BYTES:
        return None
    # Of an entry that is listed twice the greatest id counts.
    first = dict(sorted(((r["token"], r["id"]) for r in entries.collect()),
                        key=lambda e: (e[1] is not None, e[1] or 0)))
    later = {t[len(mark):]: i for t, i in first.items()
             if t.startswith(mark) and len(t) > len(mark)} if mark else first

    def by_size(table):
        short = sorted({len(t) for t in table if len(t) <= SHORT}, reverse=True)
        long: dict = {}
        for t in sorted((t for t in table if len(t) > SHORT), key=len, reverse=True):
            long.setdefault(t[:SHORT], []).append(t)
        return table, short, long

    begin, size, none = by_size(first), SHORT, [unknown_id]
    go_on = by_size(later) if mark else begin

    def split(word):
        ids, at, (table, short, long) = [], 0, begin
        while at < len(word or ""):
            head = word[at:at + size]
            for part in long.get(head, ()):
                if word.startswith(part, at):
                    break
            else:
                for n in short:
                    part = head[:n]
                    if part in table:
                        break
                else:
                    return none
            ids.append(table[part])
            at += len(part)
            table, short, long = go_on
        return ids or none

    return split


def _split_batches(split):
    """Words (``token``) to the lists of their ids."""
    def run(batches):
        for batch in batches:
            ids = [split(word) for word in batch.column("token").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32()))],
                [*batch.schema.names, "_id"])

    return run


def _split_rows(split, most: int, kind: pa.DataType):
    """Rows whose last column is a list of words to the same with the ids of all their parts; of the
    rows of about ``most`` words each different word is split once."""
    def run(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.columns[-1]).to_numpy(zero_copy_only=False)
            lot = np.cumsum(sizes, dtype=np.int64) // most
            edges = np.append(np.flatnonzero(np.diff(lot, prepend=-1)), len(lot)).tolist()
            for a, b in zip(edges, edges[1:]):
                yield coded(batch.slice(a, b - a), np.append(0, np.cumsum(sizes[a:b])))

    def coded(batch, ends):
        words = batch.columns[-1].flatten().dictionary_encode()
        parts = pa.array([split(word) for word in words.dictionary.to_pylist()], pa.list_(kind))
        ids = parts.take(words.indices)
        starts = np.append(0, np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False)))
        column = pa.ListArray.from_arrays(pa.array(starts[ends], pa.int32()), ids.flatten())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], column], batch.schema.names)

    return run


def _row_words(text: str, eos: str | None) -> Column:
    """All words of a text; null has none."""
    return F.coalesce(F.flatten(F.transform(pieces(F.col(text)), lambda piece: words(piece, eos))),
                      F.array().cast("array<string>"))


def _cut_in_place(df: DataFrame, split, kind: str, text: str, key: str, out: str,
                  keep: tuple[str, ...], eos: str | None, max_len: int | None) -> DataFrame:
    """Text to the ids (of the type ``kind``) that ``split`` makes of its words; no row is moved, and the
    ids are written, so that words are cut once however often they are read. Keys that are null or
    stand twice raise if there are more words than are looked up in place."""
    try:
        check_keys(df, key)
    except ValueError:
        if not fits_plan(build_word_vocab(df, 2 ** 31 - 1, text=text, specials=(), eos=eos)):
            raise
    rows = df.select(key, *[c for c in keep if c in df.columns and c != key],
                     _row_words(text, eos).alias(out))
    spark_type, arrow_type = ID_TYPES[kind]
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(out, T.ArrayType(spark_type))])
    coded = rows.mapInArrow(_split_rows(split, WORDS_AT_ONCE, arrow_type), schema)
    return materialize(coded if max_len is None else coded.withColumn(
        out, F.slice(out, 1, max_len)), "cut-words")


def split_words(words: DataFrame, vocab: DataFrame, unknown_id: int | None = None,
                continuation: str = "", max_piece: int | None = None) -> DataFrame:
    """Words to the ids of their parts, by a given token table (``token, id``): the column ``token``
    with ``id``, a list.

    From its beginning on, each word is cut into the longest entry that it goes on with; after the
    first one entries carry the mark ``continuation``. A word that cannot be cut so is one unknown
    id. The next ``SHORT`` characters meet the table, by each length that entries have; of a longer
    entry its beginning does, and the few hits are compared in full. So a long word or entry costs
    its length, not its square. A table of up to ``TABLE_ROWS`` entries is with every task, which
    goes from part to part; with a larger one every place of a word meets it in a join.
    ``max_piece`` is the length of entries that the caller expects at most; the table may not have
    longer ones.
    """
    longest = _longest_entry(vocab, continuation, max_piece)
    split = _word_splitter(vocab, unknown_id, continuation)
    if split is not None:
        schema = T.StructType([
            *words.schema.fields, T.StructField("_id", T.ArrayType(T.IntegerType()))])
        return words.mapInArrow(_split_batches(split), schema).withColumn(
            "id", F.col("_id")).drop("_id")
    mark = len(continuation)
    marked = F.startswith(F.col("token"), F.lit(continuation))
    entry = vocab.select("token", F.col("id").alias("_id"))
    table = entry.select(F.col("token").alias("_part"), F.lit(True).alias("_first"), "_id").union(
        entry.where(marked).select(F.substring("token", mark + 1, 2 ** 31 - 1), F.lit(False), "_id"))
    table = materialize(table.withColumn("_len", F.length("_part")).where("_len > 0"), "parts")
    small, n_table, n_bytes = (table.agg(
        F.collect_set(F.when(F.col("_len") <= SHORT, F.col("_len"))), F.count("*"),
        F.sum(F.octet_length("_part").cast("bigint"))).first())
    few = n_table <= BROADCAST_ROWS and (n_bytes or 0) <= BROADCAST_BYTES

    def side(t):
        return F.broadcast(t) if few else t

    keyed = words.where(F.length("token") > 0).select(
        F.unhex(F.sha2("token", 256)).alias("_w"), F.length("token").alias("_n"), "token")
    window = F.transform(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(WINDOW)), lambda s: F.struct(
        s.alias("_from"), F.substring("token", s + 1, F.lit(WINDOW + SHORT - 1)).alias("_text")))
    heads = (
        keyed.select("_w", "_n", F.inline(window))
        .select("_w", "_n", "_from", "_text", F.explode(F.sequence(F.lit(1), F.least(
            F.lit(WINDOW), F.col("_n") - F.col("_from")))).alias("_in"))
        .select("_w", "_n", (F.col("_from") + F.col("_in")).alias("_at"),
                F.substring("_text", F.col("_in"), F.lit(SHORT)).alias("_head"))
        .withColumn("_first", F.col("_at") == 1))
    lengths = F.array(*[F.lit(n) for n in sorted(small)]).cast("array<int>")
    hits = (
        heads.select("_w", "_at", "_first", "_head", F.explode(F.filter(
            lengths, lambda n: n <= F.length("_head"))).alias("_len"))
        .withColumn("_part", F.left("_head", F.col("_len"))).drop("_head")
        .join(side(table.where(F.col("_len") <= SHORT).drop("_len")), ["_part", "_first"])
        .select("_w", "_at", "_len", "_id"))
    if longest > SHORT:
        begun = table.where(F.col("_len") > SHORT).withColumn("_head", F.left("_part", F.lit(SHORT)))
        hits = hits.union(
            heads.join(side(begun), ["_head", "_first"])
            .where(F.col("_len") <= F.col("_n") - F.col("_at") + 1)
            .join(keyed.select("_w", "token"), "_w")
            .where(F.substring("token", F.col("_at"), F.col("_len")) == F.col("_part"))
            .select("_w", "_at", "_len", "_id"))
    best = hits.groupBy("_w", "_at").agg(F.max(F.struct("_len", "_id")).alias("_best"))
    steps = best.groupBy("_w").agg(F.sort_array(F.collect_list(
        F.struct("_at", "_best._len", "_best._id"))).alias("_steps"))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("ids"))

    def walk(done, step):
        return F.when(step["_at"] == done["at"], F.struct(
            (done["at"] + step["_len"]).alias("at"),
            F.concat(done["ids"], F.array(step["_id"])).alias("ids"))).otherwise(done)

    walked = steps.select("_w", F.aggregate("_steps", start, walk).alias("_done"))
    whole = F.col("_done.at") == F.length("token") + 1
    return words.withColumn("_w", F.unhex(F.sha2("token", 256))).join(walked, "_w", "left").withColumn(
        "id", F.when(F.coalesce(whole, F.lit(False)), F.col("_done.ids")).otherwise(
            F.array(F.lit(unknown_id).cast("int")))).drop("_done", "_w")


def encode_subwords(df: DataFrame, vocab: DataFrame, text: str = "text", key: str = "row_id",
                    out: str = "ids", keep: tuple[str, ...] = ("split",), eos: str | None = None,
                    unknown: str = UNKNOWN, continuation: str = "", max_piece: int | None = None,
                    max_len: int | None = None) -> DataFrame:
    """Text to ids of parts of words by a given token table, cut as in :func:`split_words`.

    With a table of up to ``TABLE_ROWS`` entries each different word of a batch of rows is split once,
    where it stands; no row is moved. With a larger one each different word of all rows is split once,
    and its ids are put where it stands (:func:`encode_join`). Keys that are null or stand twice raise
    if there are more words than are looked up in place.
    """
    _check_eos(eos)
    row = vocab.where(F.col("token") == unknown).select("id").first()
    unknown_id = row["id"] if row else None
    _longest_entry(vocab, continuation, max_piece)
    split = _word_splitter(vocab, unknown_id, continuation)
    if split is not None:
        return _cut_in_place(df, split, "int", text, key, out, keep, eos, max_len)
    every = build_word_vocab(df, 2 ** 31 - 1, text=text, specials=(), eos=eos).select(
        "token", F.col("id").alias("rank"))
    table = materialize(
        split_words(materialize(every, "words"), vocab, unknown_id, continuation, max_piece),
        "split-words")
    rows = df.withColumn("_words", _row_words(text, eos))
    coded = encode_join(rows, "_words", table, key, "_parts", keep, [unknown_id], rank="rank")
    ids = F.flatten("_parts")
    return coded.withColumn(out, ids if max_len is None else F.slice(ids, 1, max_len)).drop("_parts")


# --- examples ------------------------------------------------------------------------------------

def truncate(ids: Column, max_len: int = 256, eos_id: int | None = None,
             clean: bool = False) -> Column:
    """The first ``max_len`` ids. ``clean=True`` keeps the end marker as the last one."""
    cut = F.slice(ids, 1, max_len)
    if not clean or eos_id is None:
        return cut
    kept = F.concat(F.slice(ids, 1, max_len - 1), F.array(F.lit(eos_id).cast("int")))
    ends = F.get(ids, F.size(ids) - 1) == eos_id
    return F.when((F.size(ids) > max_len) & ends, kept).otherwise(cut)


def with_masks(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``input_ids``, an ``attention_mask`` of ones, and ``labels`` equal to the ids."""
    other = [c for c in df.columns if c != ids]
    return df.select(
        *other, F.col(ids).alias("input_ids"),
        F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"), F.col(ids).alias("labels"))


def tokenize_dataset(df: DataFrame, vocab: DataFrame | CharTable, max_len: int = 256,
                     text: str = "text", key: str = "row_id", eos: str | None = None,
                     on_unknown: str = "error", clean: bool = False) -> DataFrame:
    """Blank rows out, ids in, cut to ``max_len``: key, split and the three example columns.

    All splits go through one plan. The vocabulary is one of characters (``ch, id``) or of words
    (``token, id``).
    """
    df = drop_blank(df, text)
    if clean and eos:
        df = df.withColumn(text, append_eos(F.col(text), eos))
    keep = [c for c in (key, "split") if c in df.columns]
    if isinstance(vocab, CharTable) or "ch" in vocab.columns:
        table = char_table(vocab)
        eos_id = table.ids.get(eos) if eos else None
        if clean or on_unknown == "drop":
            ids = table.encode(F.col(text), on_unknown)
        else:
            # One id per character: what the cut removes is checked, but needs no ids.
            ids = table.encode(F.left(F.col(text), F.lit(max_len)), on_unknown)
            if on_unknown == "error":
                ids = table.known(F.substring(F.col(text), max_len + 1, 2 ** 31 - 1), ids)
        coded = df.select(*keep, ids.alias("ids"))
        cut = truncate(F.col("ids"), max_len, eos_id, clean)
    else:
        eos_id = None
        if clean and eos:
            row = vocab.where(F.col("token") == eos).select("id").first()
            eos_id = row["id"] if row else None
        # With clean the last token is looked at, so the list is cut after encoding.
        coded = encode_words(df, vocab, text, key, "ids", tuple(keep), eos,
                             max_len=None if clean else max_len)
        cut = truncate(F.col("ids"), max_len, eos_id, clean)
    return with_masks(coded.withColumn("ids", cut))
