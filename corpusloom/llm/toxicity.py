"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from corpusloom.session import materialize

WORD = re.compile(r"[^\W\d_]+")
#: Length of a block in the scan, largest score of a token, most words whose score is remembered.
BLOCK, LIMIT, KNOWN_WORDS = 128, 30.0, 300_000
#: Tokens that a step of training holds at a time, and with all their features; characters of text
#: that are scored together.
TOKENS, FEATURE_TOKENS, CHARS_AT_ONCE = 200_000, 50_000, 1_000_000


def word_features(word: str) -> list[int]:
    """What the field sees of a word: itself, its beginnings and its ends, in lower case, as hashes
    of 32 bits."""
    w = word.lower()
    seen = ([f"={w}"] + [f"<{w[:n]}" for n in range(2, 7) if n < len(w)]
            + [f">{w[-n:]}" for n in range(2, 5) if n < len(w)])
    return [crc32(f.encode("utf-8", "surrogatepass")) for f in seen]


# --- chain ---------------------------------------------------------------------------------------

def scan(a, b, c, d):
    """``x[t] = (a x[t-1] + b) / (c x[t-1] + d)`` for all t, block-wise: the maps of each block are
    put together, then the blocks are walked, then every block is filled. ``x[-1]`` is 0."""
    n = len(a)
    rows = -(-n // BLOCK) or 1
    pad = rows * BLOCK - n
    a, b, c, d = (np.append(v, np.full(pad, fill)).reshape(rows, BLOCK).T.copy()
                  for v, fill in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    A, B, C, D = (np.full(rows, v) for v in (1.0, 0.0, 0.0, 1.0))
    for j in range(BLOCK):
        A, C = a[j] * A + b[j] * C, c[j] * A + d[j] * C
        B, D = a[j] * B + b[j] * D, c[j] * B + d[j] * D
        if j % 4 == 3:
            size = np.abs(A) + np.abs(B) + np.abs(C) + np.abs(D)
            A, B, C, D = A / size, B / size, C / size, D / size
    x, into = 0.0, np.empty(rows)
    for i, (p, q, r, s) in enumerate(zip(A.tolist(), B.tolist(), C.tolist(), D.tolist())):
        into[i] = x
        x = (p * x + q) / (r * x + s)
    out = np.empty((BLOCK, rows))
    for j in range(BLOCK):
        into = (a[j] * into + b[j]) / (c[j] * into + d[j])
        out[j] = into
    return out.T.reshape(-1)[:n]


@dataclass
class Chain:
    """Logs of the moves, relative to staying outside a span."""

    start: float = -3.0
    enter: float = -3.0
    leave: float = 0.0
    stay: float = 0.0

    def messages(self, score: np.ndarray, first: np.ndarray):
        """Filtered chances and backward ratios of "in a span" for tokens with the given log odds;
        ``first`` marks the first token of each document."""
        e = np.exp(np.clip(score, -LIMIT, LIMIT))
        enter, leave, stay = np.exp([self.enter, self.leave, self.stay])
        diff, into = e * (stay - enter), e * enter
        a, b = np.where(first, 0.0, diff), np.where(first, e * np.exp(self.start), into)
        c, d = np.where(first, 0.0, diff + leave - 1.0), b + 1.0
        ahead = scan(a, b, c, d)
        nxt = np.append(e[1:], 1.0)
        last = np.append(first[1:], True)
        a, c = np.where(last, 0.0, stay * nxt), np.where(last, 0.0, enter * nxt)
        b = np.where(last, 1.0, leave)
        back = scan(a[::-1], b[::-1], c[::-1], np.ones(len(e)))[::-1]
        return e, ahead, back

    def marginals(self, score: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(score):
            return np.zeros(0)
        _, ahead, back = self.messages(score, first)
        return ahead * back / (ahead * back + (1.0 - ahead))


# --- training ------------------------------------------------------------------------------------

@dataclass
class Model:
    """Weights of features, the chain, and the line from a document's marginals to its score."""

    weights: dict
    bias: float
    chain: Chain
    line: tuple

    def word_score(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in word_features(word))

    def document(self, marginals: np.ndarray, words: list[str]) -> float:
        return float(1.0 / (1.0 + np.exp(-np.dot(self.line, summary(marginals, words)))))


def summary(marginals: np.ndarray, words: list[str]) -> np.ndarray:
    """Of a document: 1, the log odds of its surest token, the logs of its expected toxic words
    (a word that repeats counts once) and of their share of all tokens."""
    if not len(marginals):
        return np.array([1.0, -10.0, -10.0, -10.0])
    top = min(max(float(marginals.max()), 1e-5), 1 - 1e-5)
    best: dict[str, float] = {}
    for i in np.flatnonzero(marginals > 0.02).tolist():
        w = words[i].lower()
        best[w] = max(best.get(w, 0.0), float(marginals[i]))
    expected = sum(best.values()) + 0.01
    return np.array([1.0, np.log(top / (1 - top)), np.log(expected),
                     np.log(expected / (len(marginals) + 10))])


def marking_features(docs, toxic, n_features: int, features_of, purity: float = 0.9,
                     risk: float = 0.01, most: int = 10, lot: int = FEATURE_TOKENS) -> np.ndarray:
    """Which features mark toxic documents; ``docs`` are arrays of word numbers.

    They stand in toxic documents so often that by chance alone fewer than ``risk`` of all features
    would (Chernoff bound of the binomial tail over documents that have it, over the number of
    features), and of their occurrences per token, up to ``most`` in one document, ``purity`` lie
    in toxic documents.
    """
    toxic = np.asarray(toxic, bool)
    have, times, tokens = (np.zeros((2, n_features)), np.zeros((2, n_features)), np.zeros(2))
    sizes, low = [len(d) for d in docs], 0
    while low < len(docs):
        high, size = low, 0
        while high < len(docs) and (high == low or size + sizes[high] <= lot):
            size += sizes[high]
            high += 1
        part = docs[low:high]
        lengths = [len(d) for d in part]
        words = np.concatenate(part)
        # pairs of document and feature, with how often
        row, feature = features_of(words)
        doc = np.repeat(np.arange(len(part)), lengths)[row]
        pair, n = np.unique(doc * n_features + feature, return_counts=True)
        kind = toxic[low + pair // n_features].astype(int)
        for t in (0, 1):
            own = pair[kind == t] % n_features
            have[t] += np.bincount(own, minlength=n_features)
            times[t] += np.bincount(own, np.minimum(n[kind == t], most), n_features)
            tokens[t] += sum(k for k, is_toxic in zip(lengths, toxic[low:high])
                             if is_toxic == t)
        low = high
    base, n, k = toxic.mean(), have.sum(axis=0), have[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        share = k / n
        surprise = k * np.log(share / base) + np.where(
            n > k, (n - k) * np.log((1 - share) / (1 - base)), 0.0)
        rate = times / np.maximum(tokens, 1)[:, None]
        pure = rate[1] / rate.sum(axis=0)
    return (share > base) & (surprise > np.log(max(1, n_features) / risk)) & (pure >= purity)


def constant(prior: float) -> Model:
    """A model that knows no words: every document has the score ``prior``."""
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    return Model({}, -5.0, Chain(), (float(np.log(prior / (1 - prior))), 0.0, 0.0, 0.0))


class _Named:
    """Words of a document by their place."""

    def __init__(self, names, numbers):
        self.names, self.numbers = names, numbers

    def __getitem__(self, i):
        return self.names[self.numbers[i]]


def train(texts: list[str], toxic: list[int], prior: float, rounds: int = 40,
          least: int = 4, rate: float = 0.3, decay: float = 1e-3) -> Model:
    """Fit the field on labelled documents.

    Tokens of toxic documents are labelled toxic where they have a marking feature, all others are
    labelled clean; the field is fitted to these tokens by conditional likelihood (only marking
    features may speak for a span, all may speak against), then the line to the document labels,
    shifted from their share in the sample to ``prior``.
    """
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w.lower(), len(number)) for w in WORD.findall(t)], np.int32)
            for t in texts]
    names = list(number)
    del number
    hashed, per_word = array("I"), array("I")
    for w in names:
        seen = word_features(w)
        hashed.extend(seen)
        per_word.append(len(seen))
    per_word = np.array(per_word, np.int64)
    features, feature_of = np.unique(np.array(hashed, np.uint32), return_inverse=True)
    del hashed
    word_of = np.repeat(np.arange(len(names)), per_word)
    at = np.cumsum(per_word) - per_word

    def features_of(words):
        reps = per_word[words]
        nth = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
        return np.repeat(np.arange(len(words)), reps), feature_of[np.repeat(at[words], reps) + nth]

    lengths = np.array([len(d) for d in docs])
    tokens = np.concatenate(docs)
    of = np.repeat(np.arange(len(docs)), lengths)
    first = np.append(True, of[1:] != of[:-1]) if len(of) else np.zeros(0, bool)
    marks = marking_features(docs, toxic, len(features), features_of)
    marked = np.bincount(word_of, marks[feature_of], len(names)) > 0
    y = marked[tokens] & (np.array(toxic)[of] > 0)
    del of, at
    # the tokens of some documents at a time
    heads = np.append(np.flatnonzero(first), len(tokens))
    cuts = heads[np.unique(np.searchsorted(heads, np.arange(0, len(tokens) + TOKENS, TOKENS)
                                           ).clip(0, len(heads) - 1))].tolist()
    parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]

    often = marks | (np.bincount(feature_of, minlength=len(features)) >= least)
    chosen = often[feature_of]
    word_of = word_of[chosen]
    feature_of = (np.cumsum(often) - 1)[feature_of[chosen]]
    kept = features[often]
    evident = marks[often]

    weights = np.zeros(len(kept))
    rest = np.array([-3.0, -3.0, -3.0, 0.0, 0.0])  # bias, start, enter, leave, stay
    moment = [np.zeros(len(kept) + 5), np.zeros(len(kept) + 5)]
    for step in range(1, rounds + 1):
        per_word = rest[0] + np.bincount(word_of, weights[feature_of], len(names))
        chain = Chain(*rest[1:])
        enter, leave, stay = np.exp(rest[2:])
        by_word, ends = np.zeros(len(names)), np.zeros(5)
        for part in parts:
            e, ahead, back = chain.messages(per_word[tokens[part]], first[part])
            miss = y[part] - ahead * back / (ahead * back + 1.0 - ahead)
            by_word += np.bincount(tokens[part], miss, len(names))
            inner = np.flatnonzero(~first[part])
            f, er = ahead[inner - 1], e[inner] * back[inner]
            moves = np.stack([(1 - f), (1 - f) * enter * er, f * leave, f * stay * er])
            moves /= moves.sum(axis=0)
            was, now = y[part][inner - 1].astype(float), y[part][inner].astype(float)
            ends += (miss.sum(), miss[first[part]].sum(), ((1 - was) * now - moves[1]).sum(),
                     (was * (1 - now) - moves[2]).sum(), (was * now - moves[3]).sum())
        grad = np.append(np.bincount(feature_of, by_word[word_of], len(kept)), ends)
        grad[:len(kept)] -= decay * len(docs) * weights
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.99 * moment[1] + 0.01 * grad ** 2
        move = rate * (moment[0] / (1 - 0.9 ** step)) / (
            np.sqrt(moment[1] / (1 - 0.99 ** step)) + 1e-8)
        weights = np.where(evident, weights + move[:-5], np.minimum(weights + move[:-5], 0.0))
        rest = np.clip(rest + move[-5:], -8.0, 4.0)

    chain = Chain(*(float(v) for v in rest[1:]))
    per_word = rest[0] + np.bincount(word_of, weights[feature_of], len(names))
    p = np.concatenate([chain.marginals(per_word[tokens[part]], first[part]) for part in parts])
    ends = np.cumsum(lengths)
    x = np.stack([summary(p[b - n:b], _Named(names, d)) for b, n, d in zip(ends, lengths, docs)])
    line, target = np.zeros(4), np.array(toxic, float)
    for _ in range(25):  # Newton's method for the logistic line, slightly ridged
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ line, -LIMIT, LIMIT)))
        hess = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(4)
        line += np.linalg.solve(hess, x.T @ (target - q) - 0.1 * line)
    share = target.mean()
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    line[0] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Model({int(f): float(w) for f, w in zip(kept, weights) if abs(w) > 0.02},
                 float(rest[0]), chain, tuple(float(v) for v in line))


def held_out(id_col: str):
    """Rows whose labels are never learnt from: crc32 of the id as text is a multiple of five."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def sample(lengths: list[int], most: int, chars: int) -> list[int]:
    """Places of up to ``most`` texts, in the order given, that have ``chars`` characters together;
    one that no longer fits is passed over. If none fits, the shortest one."""
    taken = []
    for i, n in enumerate(lengths):
        if n <= chars:
            chars -= n
            taken.append(i)
            if len(taken) == most:
                break
    return taken or sorted(range(len(lengths)), key=lengths.__getitem__)[:1]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_toxic: int = 2000, max_clean: int = 4000,
        sample_chars: int = 24_000_000, seed: int = 42) -> Model:
    """Train on at most ``max_toxic`` and ``max_clean`` labelled documents that are not held out,
    chosen by a hash of their id: a sample of fixed size that the driver can hold. They are whole
    documents of any length; together they have up to ``sample_chars`` characters, of which each
    class has a share like its number of documents (:func:`sample`).

    A document with several labels counts as toxic if one says so; of several texts under one id
    the shortest counts. Classes are counted over labels whose document is there. Where documents of
    a class are missing, there is nothing to tell them by: every row then scores the share of toxic
    ones among all labels (:func:`constant`; without labels as if there were none).
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_toxic")).where(
        F.col("_toxic").isNotNull()).groupBy("_id").agg(
        (F.max("_toxic") > 0).alias("_toxic")).where(~held_out("_id"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(
        F.col("_id").isNotNull() & F.col("_text").isNotNull())
    labelled = materialize(
        texts.select("_id", F.struct(F.length("_text").alias("n"), F.xxhash64("_text").alias("h"))
                     .alias("_size")).join(known, "_id")
        .groupBy("_id", "_toxic").agg(F.min("_size").alias("_size")), "labelled")
    counts = {r["_toxic"]: r["n"] for r in labelled.groupBy("_toxic").agg(
        F.count("*").alias("n")).collect()}
    n_toxic, n_all = counts.get(True, 0), sum(counts.values())
    if len(counts) < 2:
        return constant(known.agg(F.avg(F.col("_toxic").cast("int"))).first()[0] or 0.0)
    order = F.xxhash64(F.lit(seed), "_id")
    chosen = []
    for is_toxic, most in ((True, max_toxic), (False, max_clean)):
        # twice as many, so that others stand in for those that do not fit
        rows = labelled.where(F.col("_toxic") == is_toxic).orderBy(order, "_id").limit(
            2 * most).collect()
        share = sample_chars * most // (max_toxic + max_clean)
        chosen += [(len(chosen) + k, rows[i]["_id"], rows[i]["_size"]["h"], is_toxic)
                   for k, i in enumerate(sample([r["_size"]["n"] for r in rows], most, share))]
    schema = StructType([
        StructField("_place", LongType()), StructField("_id", labelled.schema["_id"].dataType),
        StructField("_h", LongType()), StructField("_toxic", BooleanType())])
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, schema))
    found = {r["_place"]: r["_text"] for r in texts.withColumn("_h", F.xxhash64("_text")).join(
        wanted, ["_id", "_h"]).dropDuplicates(["_place"]).select("_place", "_text").collect()}
    return train([found.pop(c[0]) for c in chosen], [int(c[3]) for c in chosen], n_toxic / n_all)


# --- scoring -------------------------------------------------------------------------------------

class _Scores(dict):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, word):
        self[word] = score = self.model.word_score(word)
        return score


def score_lot(model: Model, known: _Scores, texts: list[str], sure: float = 0.5):
    """Per text its score, toxic tokens and spans (``start-end`` in characters, comma between)."""
    if len(known) > KNOWN_WORDS:
        known.clear()
    words = [WORD.findall(t) for t in texts]
    lengths = np.array([len(ws) for ws in words], np.int64)
    score = np.fromiter((s for ws in words for s in map(known.__getitem__, ws)), np.float64,
                        int(lengths.sum()))
    ends = np.cumsum(lengths)
    first = np.zeros(len(score), bool)
    first[(ends - lengths)[lengths > 0]] = True
    p = model.chain.marginals(score, first)
    for text, ws, b, n in zip(texts, words, ends.tolist(), lengths.tolist()):
        own = p[b - n:b]
        hits = np.flatnonzero(own >= sure)
        spans = []
        if len(hits):
            places = [m.span() for m in WORD.finditer(text)]
            for group in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1):
                spans.append(f"{places[group[0]][0]}-{places[group[-1]][1]}")
        yield model.document(own, ws), len(hits), ",".join(spans)


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.5, extra=None) -> DataFrame:
    """Per row: id, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on), ``n_toxic`` tokens
    and their ``spans``, from the whole text.

    Null texts are empty texts and have the score of a document without words. Null ids stay null,
    repeated rows each give their row, other columns are not read. ``extra`` is a column to hand
    through as it is, under the name ``_extra``.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        known = _Scores(model)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            low, out = 0, []
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size < CHARS_AT_ONCE):
                    size += len(texts[high])
                    high += 1
                out += score_lot(model, known, texts[low:high])
                low = high
            score, n, spans = zip(*out) if out else ((), (), ())
            cols = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(score, pa.float64()),
                 pa.array([int(s >= threshold) for s in score], pa.int32()),
                 pa.array(n, pa.int64()), pa.array(spans, pa.string())], schema.names)

    given = [F.col(id_col).alias("_id")] + ([extra.alias("_extra")] if extra is not None else [])
    rows = df.select(*given, F.col(text_col).alias("_text"))
    names = rows.columns[:-1]
    schema = StructType([
        StructField(id_col, rows.schema["_id"].dataType),
        *[StructField(c, rows.schema[c].dataType) for c in names[1:]],
        StructField("score", DoubleType()), StructField("predicted", IntegerType()),
        StructField("n_toxic", LongType()), StructField("spans", StringType())])
    return rows.mapInArrow(run, schema)


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with all their columns; the field is fitted
    on labelled rows of ``df``."""
    model = fit(df, labels, id_col, text_col)
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return score_toxicity(df, model, id_col, text_col, extra=whole).where(
        "predicted = 0").select("_extra.*")
