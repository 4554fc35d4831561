"""Learnt merges against one merge a step, and words cut by them against the lowest rank first."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators import subwords as sw
from corpusloom.operators import tokens as tk


def merge(parts, left, right):
    out, i = [], 0
    while i < len(parts):
        if parts[i:i + 2] == [left, right]:
            out.append(left + right)
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def slow_merges(counts, n_merges, min_count=2):
    state, out = [(list(w), n) for w, n in counts.items()], []
    while len(out) < n_merges:
        pairs = Counter()
        for parts, n in state:
            for pair in zip(parts, parts[1:]):
                pairs[pair] += n
        best = min(((-n, *p) for p, n in pairs.items() if n >= min_count), default=None)
        if best is None:
            break
        out.append((len(out), best[1], best[2], -best[0]))
        state = [(merge(parts, *best[1:]), n) for parts, n in state]
    return out


def slow_split(word, merges):
    rank, parts = {(m[1], m[2]): m[0] for m in merges}, list(word)
    while True:
        found = min((rank[p] for p in zip(parts, parts[1:]) if p in rank), default=None)
        if found is None:
            return parts
        parts = merge(parts, *merges[found][1:3])


def random_counts(seed):
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abc", "abcde", "aé漢😀"])
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(40)}
    return {w: rng.choice([1, 1, 2, 5, 30]) for w in words}


@pytest.mark.parametrize("seed", range(3))
def test_merges_against_one_a_step(spark, monkeypatch, seed):
    monkeypatch.setattr(sw, "LEADING", random.Random(seed).choice([2, 5, 512]))
    counts = random_counts(seed)
    df = spark.createDataFrame([*counts.items(), (None, 3), ("", 4)], "token string, n bigint")
    n = 10
    merges = cl.learn_merges(df, n)
    want = slow_merges(counts, n)
    assert [tuple(r) for r in merges.orderBy("rank").collect()] == want
    words = [*counts, "", None, "b" * 300, "zq", "ab" * 77]
    got = cl.split_by_merges(
        spark.createDataFrame([(w,) for w in words], "token string"), merges).collect()
    assert {r.token: r.parts for r in got} == {w: slow_split(w or "", want) for w in words}


def test_rounds_make_several_merges():
    """Pairs without a common symbol go together; what could disturb them ends the round."""
    def lead(top, known=(), complete=True):
        return [m[:2] for m in sw.leading_merges(top, 10, complete, set(known))]

    top = [("a", "b", 9), ("c", "d", 8), ("e", "f", 7), ("b", "x", 7), ("g", "h", 6)]
    # (b, x) may become (ab, x), a tie with (e, f) and before it
    assert lead(top) == [("a", "b"), ("c", "d")]
    assert lead(top[:3] + [("b", "x", 6), ("g", "h", 5)]) == [("a", "b"), ("c", "d"), ("e", "f")]
    assert lead([("a", "a", 9), ("c", "d", 8)]) == [("a", "a")]
    assert lead(top[:3], known=["ab"]) == [("a", "b")]
    assert lead(top[:2] + [("e", "f", 7)], complete=False) == [("a", "b"), ("c", "d")]


def test_many_steps_within_a_word(spark, monkeypatch):
    monkeypatch.setattr(sw, "STEPS", 1)
    rng = random.Random(4)
    counts = {"".join(rng.choice("abcdef") for _ in range(30)): 3 for _ in range(20)}
    merges = slow_merges(counts, 30)
    table = spark.createDataFrame(merges, "rank int, left string, right string, n bigint")
    words = [*counts, "".join(rng.choice("abcdef") for _ in range(900))]
    got = cl.split_by_merges(spark.createDataFrame([(w,) for w in words], "token string"), table)
    assert {r.token: r.parts for r in got.collect()} == {w: slow_split(w, merges) for w in words}


def test_encode_by_merges(spark):
    texts = ["low lower lowest</s>", "new newer, newest! low", None, "", "unseen ✓</s>"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string").withColumn(
        "split", F.lit("train"))
    counts = cl.word_counts(df.where("row_id < 2"), eos="</s>").where("token <> '</s>'")
    merges = cl.learn_merges(counts, 8)
    vocab = cl.merge_vocab(cl.build_char_vocab(df.where("row_id < 2")), merges,
                           ("<pad>", "</s>", "<unk>"))
    table = {r.token: r.id for r in vocab.collect()}
    assert sorted(table.values()) == list(range(len(table)))
    listed = [tuple(r) for r in merges.orderBy("rank").collect()]
    got = {r.row_id: r.ids for r in cl.encode_merges(df, merges, vocab, eos="</s>").collect()}
    want = {i: [table.get(p, 2) for w in (tk_words(t or "")) for p in
                ([w] if w == "</s>" else slow_split(w, listed))] for i, t in enumerate(texts)}
    assert got == want
    cut = cl.encode_merges(df, merges, vocab, eos="</s>", max_len=3).collect()
    assert {r.row_id: r.ids for r in cut} == {i: v[:3] for i, v in want.items()}


def tk_words(text):
    import regex
    return regex.findall(r"</s>|[\p{L}\p{N}]+|[^\s\p{L}\p{N}]", text)


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_merges_in_place_and_by_join(spark, monkeypatch, kind):
    """A vocabulary that tasks are given moves no row, a larger one is joined; the ids are the same."""
    monkeypatch.setattr(tk, "LOOKUP_ROWS", 2)
    rows = [(1, "abab ab,</s>abx"), (2, ""), (3, None), (4, "ab " * 9 + "</s> b😀a")]
    df = spark.createDataFrame(rows, "row_id int, text string")
    merges = spark.createDataFrame([(0, "a", "b", 5), (1, "ab", "ab", 2)],
                                   "rank int, left string, right string, n bigint")
    known = ["<unk>", "a", "b", "ab", "abab", ",", "</s>", "😀"]
    for vocab in (known, known[1:]):
        ids = {t: i for i, t in enumerate(vocab)}
        table = spark.createDataFrame([*ids.items()], f"token string, id {kind}")
        x = ids.get("<unk>")
        want = {1: ["abab", "ab", ",", "</s>", "ab", None], 2: [], 3: [],
                4: ["ab"] * 9 + ["</s>", "b", "😀", "a"]}
        want = {k: [ids.get(t, x) for t in v] for k, v in want.items()}
        for most in (100, 0):
            monkeypatch.setattr(tk, "TABLE_ROWS", most)
            coded = cl.encode_merges(df, merges, table, eos="</s>")
            assert dict(coded.dtypes)["ids"] == f"array<{kind}>"
            assert {r.row_id: r.ids for r in coded.collect()} == want
            joins = "Join" in coded._jdf.queryExecution().executedPlan().toString()
            assert joins == (most == 0)


def test_no_merges(spark):
    none = cl.learn_merges(spark.createDataFrame([("ab", 1)], "token string, n bigint"), 5)
    assert none.count() == 0
    got = cl.split_by_merges(spark.createDataFrame([("ab",), ("",)], "token string"), none)
    assert {r.token: r.parts for r in got.collect()} == {"ab": ["a", "b"], "": []}


def test_long_entries_cost_their_length(spark):
    """A word of 60,000 letters that is an entry, and one that holds it further on."""
    long = "z" * 60_000
    table = {t: i for i, t in enumerate(["<unk>", "z", "q", "zz", "z" * 40, long])}
    vocab = spark.createDataFrame(list(table.items()), "token string, id int")
    df = spark.createDataFrame([(1, f"{long} q{long}zzq")], "row_id int, text string")
    assert cl.encode_subwords(df, vocab).first().ids == [5, 2, 5, 3, 2]


def test_words_of_one_count_are_numbered_by_ranges(spark, docs, monkeypatch):
    want = {r.token: r.id for r in cl.build_word_vocab(docs, 4000).collect()}
    monkeypatch.setattr(tk, "TIED_WORDS", 100)
    assert {r.token: r.id for r in cl.build_word_vocab(docs, 4000).collect()} == want
