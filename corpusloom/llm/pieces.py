"""SentencePiece encoding by Gumbel top-k without replacement, and decoding."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType,
)

SPACE_MARK = "▁"
#: Characters of text taken together in a task, and lattice positions kept for known words.
CHARS_AT_ONCE, POSITIONS_KEPT = 1_000_000, 2_000_000
DENSE = 160  # letters with a column of their own in the table of steps


# --- the model -----------------------------------------------------------------------------------

class Pieces:
    """Pieces of a model file as a tree of letters, with weights for a lattice.

    The file's scores are ranks of merges, not probabilities, so a piece of rank r weighs as in
    Zipf's law: 1 / (r + 1), normalised over all pieces, to the power 1 / ``temperature``.
    Characters without a piece of their own are written as their bytes.
    """

    def __init__(self, path: str, temperature: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i)
                                             or model.is_byte(i) or model.is_unused(i))]
        if any(SPACE_MARK in names[i][1:] and names[i].strip(SPACE_MARK) for i in plain):
            raise ValueError("the model has pieces that reach over a space")
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes_of = [b""] * n
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(names[i][1:-1], 16)] = i
                self.bytes_of[i] = bytes([int(names[i][1:-1], 16)])
        ranks = np.full(n, n - 1.0)
        for i in plain:
            self.bytes_of[i] = names[i].replace(SPACE_MARK, " ").encode()
            ranks[i] = min(-model.get_score(i), n - 1.0)
        weight = -np.log(ranks + 1)
        self.weight = (weight - np.log(np.exp(weight).sum())) / temperature

        steps, self.terminal = {}, [-1]
        for i in plain:
            at = 0
            for letter in map(ord, names[i]):
                if (at, letter) not in steps:
                    steps[at, letter] = len(self.terminal)
                    self.terminal.append(-1)
                at = steps[at, letter]
            self.terminal[at] = i
        self.terminal = np.array(self.terminal)
        often = [c for c, _ in Counter(c for _, c in steps).most_common(DENSE)]
        self.column = np.zeros(0x110000, np.uint8)
        self.column[often] = np.arange(1, len(often) + 1)
        self.table = np.zeros((len(self.terminal), DENSE + 1), np.int32)
        rare = []
        for (at, letter), to in steps.items():
            if self.column[letter]:
                self.table[at, self.column[letter]] = to
            else:
                rare.append(((at << 21) + letter, to))
        rare = np.array(sorted(rare) or [(-1, 0)])
        self.rare_keys, self.rare_to = rare[:, 0], rare[:, 1]

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The tree node below each node by a letter, 0 where there is none."""
        column = self.column[letter]
        out = self.table[node, column]
        odd = np.flatnonzero(column == 0)
        if len(odd):
            key = (node[odd].astype(np.int64) << 21) + letter[odd]
            at = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
            out[odd] = np.where(self.rare_keys[at] == key, self.rare_to[at], 0)
        return out


@lru_cache(maxsize=2)
def load_pieces(path: str, temperature: float) -> Pieces:
    return Pieces(path, temperature)


def split_words(text: str) -> list[str]:
    """The text with marks for spaces, cut where no piece can reach over: before each space that
    follows another character. An empty text has no words."""
    if not text:
        return []
    marked = SPACE_MARK + text.replace(" ", SPACE_MARK)
    if SPACE_MARK * 2 in marked or marked.endswith(SPACE_MARK):
        return re.findall(f"{SPACE_MARK}+[^{SPACE_MARK}]*|[^{SPACE_MARK}]+", marked)
    return [SPACE_MARK + w for w in marked[1:].split(SPACE_MARK)]


# --- lattices ------------------------------------------------------------------------------------

class _Words(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word):
        self.fresh.append(word)
        self[word] = n = len(self)
        return n


class _Column:
    """An array that grows at its end."""

    def __init__(self, dtype, *first):
        self.held = np.empty(1024, dtype)
        self.n = len(first)
        self.held[:self.n] = first

    def add(self, values):
        n = self.n + len(values)
        if n > len(self.held):
            grown = np.empty(n + n // 4, self.held.dtype)
            grown[:self.n] = self.held[:self.n]
            self.held = grown
        self.held[self.n:n] = values
        self.n = n
        return self.held[:n]


class Lattices:
    """Lattices of distinct words. Positions of all words stand in one row; the edges of a position
    lie together, the longest first, with their chances and running sums of these."""

    def __init__(self, model: Pieces):
        self.model = model
        self.clear()

    def clear(self):
        self.words = _Words()
        self._columns = {"start": _Column(np.int64), "stop": _Column(np.int64),
                         "first": _Column(np.int64, 0),  # edge of a position
                         "length": _Column(np.int32),
                         "piece": _Column(np.int32),  # negative: a character written as bytes
                         "logp": _Column(np.float64), "upto": _Column(np.float32)}
        for name, column in self._columns.items():
            setattr(self, name, column.held[:column.n])

    def ids(self, words: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if self.words.fresh:
            self._add(self.words.fresh)
            self.words.fresh = []
        return out

    def _add(self, words: list[str]):
        model = self.model
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(
            np.int32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes)
        end = np.repeat(stops, sizes)
        left = end - np.arange(len(letters))

        # edges by their length, following all positions down the tree at once
        live, node = np.arange(len(letters)), np.zeros(len(letters), np.int32)
        found, reach = [], 0
        count = np.zeros(len(letters), np.int64)
        while len(live):
            ok = left[live] > reach
            if not ok.all():
                live, node = live[ok], node[ok]
            node = model.step(node, letters[live + reach])
            ok = node > 0
            live, node = live[ok], node[ok]
            term = model.terminal[node]
            hit = term >= 0
            found.append((live[hit], term[hit]))
            if reach == 0:
                bare = np.ones(len(letters), bool)
                bare[found[0][0]] = False
                bare = np.flatnonzero(bare)
                point = letters[bare]
                as_byte = np.where(point < 128, model.byte_ids[np.minimum(point, 127)], -point - 1)
                found[0] = tuple(np.append(x, y) for x, y in zip(found[0], (bare, as_byte)))
            count[found[-1][0]] += 1
            reach += 1
        ends = np.cumsum(count)
        first = ends - count
        n = int(ends[-1]) if len(ends) else 0
        length, piece = np.empty(n, np.int32), np.empty(n, np.int32)
        at = first.copy()
        for size in range(len(found), 0, -1):
            src, term = found[size - 1]
            slot = at[src]
            at[src] = slot + 1
            length[slot], piece[slot] = size, term
        src = np.repeat(np.arange(len(letters)), count)
        weight = model.weight[np.maximum(piece, 0)]
        byte = np.flatnonzero(piece < 0)
        if len(byte):
            point = -piece[byte] - 1
            weight[byte] = (2 + (point > 0x7FF) + (point > 0xFFFF)) * model.weight[
                model.byte_ids[0]]

        # log of the weight of all paths from a position on, from the ends of words backwards
        far = int(left.max()) if len(left) else 0
        by_left = np.argsort(left.astype(np.uint16) if far < 1 << 16 else left, kind="stable")
        n_each = count[by_left]
        upto = np.cumsum(n_each)
        edges = np.arange(n) + np.repeat(first[by_left] - (upto - n_each), n_each)
        to, w = (src + length)[edges], weight[edges]
        inner = left[src[edges]] > length[edges]
        total = np.zeros(len(letters) + 1)
        each = np.cumsum(np.bincount(left, minlength=far + 1)) if far else []
        for d in range(1, far + 1):
            p, q = each[d - 1], each[d]
            if p == q:
                continue
            a, b = upto[p] - n_each[p], upto[q - 1]
            value = w[a:b] + total[to[a:b]] * inner[a:b]
            heads = upto[p:q] - n_each[p:q] - a
            top = np.maximum.reduceat(value, heads)
            total[by_left[p:q]] = top + np.log(
                np.add.reduceat(np.exp(value - np.repeat(top, n_each[p:q])), heads))
        logp = weight + total[src + length] * (left[src] > length) - total[src]

        run = np.cumsum(np.exp(logp))
        run -= np.repeat(np.append(0.0, run)[first], count)
        run[ends - 1] = 2.0  # the last edge takes what rounding leaves
        base, edge_base = self.stop[-1] if len(self.stop) else 0, self.first[-1]
        for name, values in (("start", base + stops - sizes), ("stop", base + stops),
                             ("first", edge_base + ends), ("length", length), ("piece", piece),
                             ("logp", logp), ("upto", run)):
            setattr(self, name, self._columns[name].add(values))


# --- random numbers that follow from keys --------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(base: np.ndarray, *numbers) -> np.ndarray:
    with np.errstate(over="ignore"):
        for n in numbers:
            base = _mixed(base + np.asarray(n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                          + np.uint64(1))
    return base


def _uniform(key: np.ndarray) -> np.ndarray:
    return ((key >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _below(top, place, key) -> np.ndarray:
    """Gumbel numbers with the given places (logs of mass), conditioned to be below ``top``."""
    return -np.logaddexp(-top, np.log(-np.log(_uniform(key))) - place)


# --- search --------------------------------------------------------------------------------------

def _walk(lat: Lattices, at, stop, key):
    """Random paths from lattice positions to the ends of their words.

    Returns the edges of all paths in turn and how many each has."""
    at = at.copy()
    live = np.flatnonzero(at < stop)
    lanes, edges, nth = [], [], 0
    while len(live):
        v = at[live]
        u = _uniform(_key(key[live], nth))
        e = lat.first[v]
        more = np.flatnonzero(u > lat.upto[e])
        while len(more):
            e[more] += 1
            more = more[u[more] > lat.upto[e[more]]]
        lanes.append(live)
        edges.append(e)
        at[live] = v + lat.length[e]
        live = live[at[live] < stop[live]]
        nth += 1
    counts = np.zeros(len(at), np.int64)
    for lane in lanes:
        counts[lane] += 1
    out = np.empty(int(counts.sum()), np.int64)
    base = np.cumsum(counts) - counts
    for i, (lane, e) in enumerate(zip(lanes, edges)):
        out[base[lane] + i] = e
    return out, counts


class _Sample:
    """One segmentation of each document of a lot, and its open branches.

    ``bound`` has for each edge the perturbed score of the best path that leaves the segmentation
    there, and -inf for edges shared with an earlier one, whose branches that one holds."""

    def __init__(self, docs, ends, edge, lane, logp, bound, score):
        self.docs, self.ends = docs, ends  # documents that have one, ends of their stretches
        self.edge, self.lane, self.logp, self.bound, self.score = edge, lane, logp, bound, score
        self.begins = ends - np.diff(ends, prepend=0)
        self.index = {d: i for i, d in enumerate(docs.tolist())}
        self.total = np.add.reduceat(np.append(logp, 0.0), self.begins) if len(docs) else logp

    def of(self, doc):
        i = self.index.get(doc)
        return None if i is None else slice(self.begins[i], self.ends[i])


def _branches(lat, seeds, sample, edge, lane, n_edges, head, before, top):
    """Scores of the branches along paths: mass outside the edge taken, below the path's score."""
    logp = lat.logp[edge]
    begins = np.cumsum(n_edges) - n_edges
    run = np.cumsum(logp)
    base = np.append(0.0, run)[begins]
    prefix = run - logp - np.repeat(base, n_edges) + np.repeat(before, n_edges)
    with np.errstate(divide="ignore"):
        place = prefix + np.log(-np.expm1(np.minimum(logp, 0.0)))
    nth = np.arange(len(edge)) - np.repeat(begins, n_edges) + np.repeat(head, n_edges)
    key = _key(np.repeat(_key(seeds, sample, 7), n_edges), nth)
    return logp, _below(np.repeat(top, n_edges), place, key)


def sample_lot(lat: Lattices, texts: list[str], seeds: np.ndarray, k: int):
    """Up to ``k`` distinct segmentations of each text, by perturbed A-star over its lattice.

    The agenda holds sets of paths (those that leave a known segmentation at one edge) with the
    perturbed score of the best path within, drawn from the top down; taking the best set yields
    the next path and splits the set. Scores come in falling order, so the paths taken are a sample
    without replacement. Words are lattices of their own between which no piece reaches.

    Returns per text a list of ``(edges, log probability, log inclusion score)``; the inclusion
    score is the chance that the path's score is above that of the best path left out.
    """
    words = [split_words(t) for t in texts]
    kind = lat.ids([w for ws in words for w in ws])
    n_words = np.array([len(ws) for ws in words])
    docs = np.flatnonzero(n_words)
    out = [[] for _ in texts]
    for d in np.flatnonzero(n_words == 0).tolist():
        out[d].append((np.zeros(0, np.int64), 0.0, 0.0))
    if not len(docs):
        return out
    word_ends = np.cumsum(n_words)
    word_begins = word_ends - n_words
    doc_of = np.repeat(np.arange(len(texts)), n_words)
    in_doc = np.arange(len(kind)) - word_begins[doc_of]
    starts, stops = lat.start[kind], lat.stop[kind]
    root = -np.log(-np.log(_uniform(_key(seeds[docs], 0, 0, 3))))

    edge, counts = _walk(lat, starts, stops, _key(_key(seeds, 1, 5)[doc_of], in_doc))
    lane = np.repeat(np.arange(len(kind)), counts)
    n_edges = np.add.reduceat(counts, word_begins[docs])
    zero = np.zeros(len(docs))
    logp, bound = _branches(lat, seeds[docs], 1, edge, lane, n_edges, zero.astype(int), zero, root)
    samples = [_Sample(docs, np.cumsum(n_edges), edge, lane, logp, bound, root)]
    taken: dict[tuple[int, int], list[int]] = {}  # edges left out at an edge of a sample, if many
    best_open = np.full(len(texts), -np.inf)

    for nth in range(2, k + 2):
        most = np.full((len(samples), len(texts)), -np.inf)
        for i, s in enumerate(samples):
            if len(s.docs):
                most[i, s.docs] = np.maximum.reduceat(s.bound, s.begins)
        best_open = most.max(axis=0)
        if nth == k + 1:
            break
        parents = most.argmax(axis=0)
        todo = docs[best_open[docs] > -np.inf]
        if not len(todo):
            break
        heads, turned, lane_at, lane_stop, lane_word = [], [], [], [], []
        fresh = _uniform(_key(seeds[todo], nth, 0, 11))
        n_lanes = np.zeros(len(todo), np.int64)
        rests = []
        for j, (d, u) in enumerate(zip(todo.tolist(), fresh.tolist())):
            p = int(parents[d])
            s = samples[p]
            where = s.of(d)
            t = where.start + int(np.argmax(s.bound[where]))
            left_out = taken.get((p, t)) or [int(s.edge[t])]
            e0 = int(s.edge[t])
            v = _source(lat, e0)
            options = [e for e in range(int(lat.first[v]), int(lat.first[v + 1]))
                       if e not in left_out]
            chance = np.exp(lat.logp[options])
            run = np.cumsum(chance)
            e = options[min(int(np.searchsorted(run, u * run[-1])), len(options) - 1)]
            rest = run[-1] - np.exp(lat.logp[e]) if len(options) > 1 else 0.0
            rests.append(rest)
            word = int(s.lane[t])
            heads.append((p, where.start, t, float(s.bound[t]), left_out + [e]))
            turned.append(e)
            s.bound[t] = -np.inf
            lane_at.append(np.append(v + lat.length[e], starts[word + 1:word_ends[d]]))
            lane_stop.append(stops[word:word_ends[d]])
            lane_word.append(np.arange(word, word_ends[d]))
            n_lanes[j] = word_ends[d] - word
        lane_at, lane_stop, lane_word = map(np.concatenate, (lane_at, lane_stop, lane_word))
        key = _key(np.repeat(_key(seeds[todo], nth, 5), n_lanes), in_doc[lane_word])
        tail, counts = _walk(lat, lane_at, lane_stop, key)
        tail_lane = np.repeat(lane_word, counts)
        cut = np.cumsum(n_lanes)
        upto = np.append(0, np.cumsum(counts))
        n_tail = upto[cut] - upto[cut - n_lanes]
        tail_end = np.cumsum(n_tail)
        edges, lanes, logps, bounds, tops, ends = [], [], [], [], [], []
        before = np.array([samples[p].logp[a:t].sum() for p, a, t, _, _ in heads])
        turned = np.array(turned)
        score = np.array([h[3] for h in heads])
        head = np.array([t - a + 1 for _, a, t, _, _ in heads])
        with np.errstate(divide="ignore"):
            again = _below(score, before + np.log(np.maximum(rests, 0.0)),
                           _key(seeds[todo], nth, head, 13))
        tail_logp, tail_bound = _branches(lat, seeds[todo], nth, tail, tail_lane, n_tail, head,
                                          before + lat.logp[turned], score)
        at = 0
        for j, (p, a, t, _, left_out) in enumerate(heads):
            s, tail_at = samples[p], slice(tail_end[j] - n_tail[j], tail_end[j])
            edges += [s.edge[a:t], turned[j:j + 1], tail[tail_at]]
            lanes += [s.lane[a:t + 1], tail_lane[tail_at]]
            logps += [s.logp[a:t], lat.logp[turned[j:j + 1]], tail_logp[tail_at]]
            bounds += [np.full(t - a, -np.inf), again[j:j + 1], tail_bound[tail_at]]
            taken[len(samples), at + t - a] = left_out
            at += t - a + 1 + int(n_tail[j])
            ends.append(at)
        samples.append(_Sample(todo, np.array(ends), *(np.concatenate(x) for x in (
            edges, lanes, logps, bounds)), score))

    for s in samples:
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            x = s.total - best_open[s.docs]
            share = np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700.0)))))
        share = np.where(np.isneginf(best_open[s.docs]), 0.0, np.minimum(share, 0.0))
        for i, d in enumerate(s.docs.tolist()):
            out[d].append((s.edge[s.begins[i]:s.ends[i]], float(s.total[i]), float(share[i])))
    return out


def _source(lat: Lattices, edge: int) -> int:
    return int(np.searchsorted(lat.first, edge, "right")) - 1


# --- encoding and decoding -----------------------------------------------------------------------

def edge_ids(lat: Lattices, edges: np.ndarray) -> np.ndarray:
    """Piece ids of a path; a character without a piece is one id per byte."""
    pieces = lat.piece[edges]
    if (pieces >= 0).all():
        return pieces
    out, at = [], 0
    for i in np.flatnonzero(pieces < 0).tolist():  # characters of several bytes
        out.append(pieces[at:i])
        raw = chr(-int(pieces[i]) - 1).encode("utf-8", "surrogatepass")
        out.append(lat.model.byte_ids[list(raw)])
        at = i + 1
    out.append(pieces[at:])
    return np.concatenate(out).astype(np.int32)


def decode_ids(model: Pieces, ids) -> str:
    """The text of piece ids; the space that encoding puts before it is taken off."""
    data = b"".join(map(model.bytes_of.__getitem__, ids))
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def sample_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  k: int = 2, temperature: float = 1.0, seed: int = 42) -> DataFrame:
    """Up to ``k`` rows per row of ``df``: id, ``sample`` (from 1, by falling perturbed score),
    ``pieces`` (ids), ``log_prob``, ``log_inclusion``, ``round_trip`` (the pieces decode to the
    text).

    Segmentations of one row are distinct; a text that has fewer than ``k`` gives all it has, with
    inclusion score 1 (log 0). The draw follows from ``seed`` and the row's id alone, so rows with
    the same id and text get the same. Null texts are empty texts and have one segmentation without
    pieces. Texts that hold the space mark itself (U+2581) decode to a space there. Null ids stay
    null. Other columns are not read. Texts are taken in lots of bounded size, a longer text alone.
    """
    def run(batches):
        model = load_pieces(model_path, temperature)
        lat = Lattices(model)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            seeds = batch.column("_seed").to_numpy(zero_copy_only=False).view(np.uint64)
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high])
                                             <= CHARS_AT_ONCE):
                    size += len(texts[high])
                    high += 1
                yield lot(model, lat, batch.column("_id").slice(low, high - low),
                          texts[low:high], seeds[low:high])
                low = high

    def lot(model, lat, ids, texts, seeds):
        if len(lat.first) > POSITIONS_KEPT:
            lat.clear()
        row, nth, pieces, logp, share, same = [], [], [], [], [], []
        for d, found in enumerate(sample_lot(lat, texts, seeds, k)):
            for i, (edges, lp, li) in enumerate(found):
                got = edge_ids(lat, edges)
                row.append(d)
                nth.append(i + 1)
                pieces.append(got)
                logp.append(lp)
                share.append(li)
                same.append(decode_ids(model, got.tolist()) == texts[d])
        sizes = np.cumsum([0, *map(len, pieces)]).astype(np.int32)
        flat = np.concatenate(pieces).astype(np.int32) if pieces else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row, pa.int64())), pa.array(nth, pa.int32()),
             pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)), pa.array(logp, pa.float64()),
             pa.array(share, pa.float64()), pa.array(same, pa.bool_())], schema.names)

    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                     F.xxhash64(F.lit(seed), F.col(id_col)).alias("_seed"))
    schema = StructType([
        StructField(id_col, rows.schema["_id"].dataType), StructField("sample", IntegerType()),
        StructField("pieces", ArrayType(IntegerType())), StructField("log_prob", DoubleType()),
        StructField("log_inclusion", DoubleType()), StructField("round_trip", BooleanType())])
    return rows.mapInArrow(run, schema)


def decode_pieces(df: DataFrame, model_path: str, pieces_col: str = "pieces",
                  out: str = "text") -> DataFrame:
    """The rows with the text of their pieces; null pieces give a null text."""
    def run(batches):
        model = load_pieces(model_path, 1.0)
        for batch in batches:
            texts = [None if p is None else decode_ids(model, p)
                     for p in batch.column(pieces_col).to_pylist()]
            yield batch.append_column(out, pa.array(texts, pa.string()))

    from pyspark.sql.types import StringType
    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, StringType())]))
