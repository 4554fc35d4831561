import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators import tokens as tk


def test_vocab_beyond_the_seed_rows(spark, docs):
    chars = sorted(set("".join(r.text for r in docs.collect())))
    for seeds in (1, 200):
        got = [r.ch for r in cl.build_char_vocab(docs, seed_rows=seeds).orderBy("id").collect()]
        assert got == chars


def test_vocab_order_is_code_points(spark):
    text = "z😀a￿éA中 \n\x00-^]["
    df = spark.createDataFrame([(1, text), (2, ""), (3, "€")], "row_id int, text string")
    rows = cl.build_char_vocab(df, extra="Q").orderBy("id").collect()
    assert [r.ch for r in rows] == sorted(set(text + "€Q"))
    assert [r.id for r in rows] == list(range(len(rows)))
    assert cl.vocab_size(df).first()[0] == len(set(text + "€"))


def test_vocab_of_many_characters(spark):
    """More characters than the pattern names, spread over the planes."""
    chars = [chr(c) for c in range(300, 60000, 97) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(i, c + "a") for i, c in enumerate(chars)], "row_id int, text string")
    vocab = cl.build_char_vocab(df)
    assert vocab.count() == len(chars) + 1
    coded = cl.encode_chars(df, vocab)
    assert cl.decode_chars(coded.select("row_id", "ids"), vocab).join(
        df.withColumnRenamed("text", "t"), "row_id").where("text <> t").count() == 0


@pytest.mark.parametrize("text", ["", "abc", "é😀a", "\n\n"])
def test_roundtrip(spark, text):
    df = spark.createDataFrame([(1, text), (2, "abcé😀\n")], "row_id int, text string")
    table = cl.char_table(cl.build_char_vocab(df))
    coded = cl.encode_chars(df, table)
    chars = sorted(set("abcé😀\n"))
    assert coded.where("row_id = 1").first().ids == [chars.index(c) for c in text]
    assert cl.decode_chars(coded.drop("text"), table).where("row_id = 1").first().text == text


def test_unknown_characters(spark):
    vocab = cl.build_char_vocab(spark.createDataFrame([("ab",)], "text string"))
    df = spark.createDataFrame([(1, "axb")], "row_id int, text string")
    with pytest.raises(Exception, match="not in the vocabulary: x"):
        cl.encode_chars(df, vocab).collect()
    assert cl.encode_chars(df, vocab, on_unknown="null").first().ids == [0, None, 1]
    assert cl.encode_chars(df, vocab, on_unknown="drop").first().ids == [0, 1]
    with pytest.raises(ValueError):
        cl.encode_chars(df, vocab, on_unknown="skip")


def test_encode_join_equals_encode(spark, docs):
    vocab = cl.build_char_vocab(docs)
    direct = cl.encode_chars(docs, vocab).select("row_id", "ids")
    joined = cl.encode_join(
        docs.withColumn("t", tk.characters(F.col("text"))), "t", vocab, token="ch")
    assert sorted(direct.collect()) == sorted(joined.collect())


def test_encode_join_keeps_empty_rows(spark):
    df = spark.createDataFrame([(1, [], "train"), (2, ["a", "x", "a"], "dev")],
                               "row_id int, t array<string>, split string")
    vocab = spark.createDataFrame([("a", 5)], "token string, id int")
    got = sorted(cl.encode_join(df, "t", vocab, unknown_id=9).collect())
    assert [tuple(r) for r in got] == [(1, "train", []), (2, "dev", [5, 9, 5])]


def test_vocab_past_the_broadcast_bound(spark, monkeypatch):
    """The join gives the same ids; one frequent token makes up a third of all."""
    monkeypatch.setattr(tk, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(tk, "LOOKUP_ROWS", 5)
    df = spark.range(200).select(
        F.col("id").alias("row_id"),
        F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id") % 50), F.lit("none")).alias("t"))
    vocab = spark.createDataFrame(
        [("hot", 0)] + [(f"w{i}", i + 1) for i in range(50)], "token string, id int")
    got = {r.row_id: r.ids for r in cl.encode_join(df, "t", vocab, unknown_id=99).collect()}
    assert got == {i: [0, i % 50 + 1, 99] for i in range(200)}


def word_list(text, eos=None):
    # [^\W_] is a letter or digit; marks and other signs stand alone.
    pattern = r"[^\W_]+|[^\s\w]|_"
    return re.findall((re.escape(eos) + "|" if eos else "") + pattern, text)


def test_word_vocab_and_ids(spark):
    texts = ["the cat, the dog.</s>", "the end</s>", "", "été 12 été</s>"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    vocab = cl.build_word_vocab(df, 7, eos="</s>")
    counts = Counter(w for t in texts for w in word_list(t, "</s>"))
    del counts["</s>"]
    top = sorted(counts, key=lambda w: (-counts[w], w))[:4]
    table = {w: i for i, w in enumerate(["<pad>", "</s>", "<unk>", *top])}
    assert {r.token: r.id for r in vocab.collect()} == table
    got = {r.row_id: r.ids for r in cl.encode_words(df, vocab, eos="</s>").collect()}
    assert got == {i: [table.get(w, 2) for w in word_list(t, "</s>")]
                   for i, t in enumerate(texts)}
    plain = Counter(w for t in texts for w in word_list(t))
    want = sorted((w for w in plain if plain[w] >= 2), key=lambda w: (-plain[w], w))
    bare = cl.build_word_vocab(df, 100, min_count=2, specials=()).orderBy("id").collect()
    assert [r.token for r in bare] == want
    with pytest.raises(ValueError):
        cl.build_word_vocab(df, 2)


def test_words_of_a_long_text(spark, monkeypatch):
    """Cut into pieces, a text gives the same tokens in the same order."""
    texts = ["ab cd, " * 40 + "x" * 90 + " é\n\n" + "." * 30 + "</s>", "", "short one</s>"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    vocab = cl.build_word_vocab(df, 50, eos="</s>")
    want = cl.encode_words(df, vocab, eos="</s>").collect()
    first = cl.encode_words(df, vocab, eos="</s>", max_len=20).collect()
    monkeypatch.setattr(tk, "PIECE", 16)
    assert sorted(cl.build_word_vocab(df, 50, eos="</s>").collect()) == sorted(vocab.collect())
    for lookup in (100, 9, 0):  # by a constant table, by both, by a join
        monkeypatch.setattr(tk, "LOOKUP_ROWS", lookup)
        assert sorted(cl.encode_words(df, vocab, eos="</s>").collect()) == sorted(want)
        assert sorted(cl.encode_words(df, vocab, eos="</s>", max_len=20).collect()) == sorted(first)
    assert len(want[0].ids) > 100 or len(want[1].ids) > 100 or len(want[2].ids) > 100
    with pytest.raises(ValueError):
        cl.encode_words(df, vocab, eos="< / s>")


def test_lookup_and_join_agree(spark, docs, monkeypatch):
    texts = docs.unionByName(docs.limit(1).selectExpr("-1L as row_id", "cast(null as string) as text"))
    vocab = cl.materialize(cl.build_word_vocab(docs, 300), "vocab")
    looked_up = sorted(cl.encode_words(texts, vocab).collect())
    for rows, broadcast in ((0, 10 ** 6), (40, 10 ** 6), (40, 10)):
        monkeypatch.setattr(tk, "LOOKUP_ROWS", rows)
        monkeypatch.setattr(tk, "BROADCAST_ROWS", broadcast)
        assert sorted(cl.encode_words(texts, vocab).collect()) == looked_up
    assert looked_up[0].ids == []


@pytest.mark.parametrize("lookup", [65_536, 1])
def test_long_and_odd_tokens(spark, monkeypatch, lookup):
    monkeypatch.setattr(tk, "LOOKUP_ROWS", lookup)
    long = "z" * 60_000
    tokens = ['a"b', "\\", "\n", "", "é", long, "null", "[1]"]
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, id int")
    df = spark.createDataFrame([(1, [*tokens, "other", None]), (2, None)],
                               "row_id int, t array<string>")
    got = {r.row_id: r.ids for r in cl.encode_join(df, "t", vocab, unknown_id=99).collect()}
    assert got == {1: [0, 1, 2, 3, 4, 5, 6, 7, 99, 99], 2: []}


def test_repeated_keys_and_tokens_raise(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["a"]), (1, ["b"])], "row_id int, t array<string>")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, id int")
    assert sorted(r.ids for r in cl.encode_join(df, "t", vocab).collect()) == [[0], [1]]
    monkeypatch.setattr(tk, "LOOKUP_ROWS", 1)
    with pytest.raises(ValueError, match="row_id=1 stands 2 times"):
        cl.encode_join(df, "t", vocab)
    with pytest.raises(ValueError, match="not unique"):
        cl.encode_join(df, "t", vocab.union(vocab))
    with pytest.raises(ValueError, match="null in the key"):
        cl.encode_join(df.selectExpr("if(t[0] = 'a', 1, null) as row_id", "t"), "t", vocab)


def test_unknown_character_after_the_cut_is_an_error(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "ch string, id int")
    df = spark.createDataFrame([(1, "abba"), (2, "abbaZ")], "row_id int, text string")
    for max_len in (4, 20):
        with pytest.raises(Exception, match="not in the vocabulary: Z"):
            cl.tokenize_dataset(df, vocab, max_len).collect()
        assert [len(r.input_ids) for r in cl.tokenize_dataset(
            df, vocab, max_len, on_unknown="drop").collect()] == [4, 4]


def test_vocabulary_cut_among_equal_counts(spark):
    texts = [" ".join(f"t{i:03d}" for i in range(300)), "t001 t007 t007"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    got = cl.build_word_vocab(df, 53)
    want = ["t007", "t001"] + [f"t{i:03d}" for i in range(300) if i not in (1, 7)]
    assert [r.token for r in got.orderBy("id").collect()][3:] == want[:50]
    assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()


def test_truncation(spark):
    df = spark.createDataFrame([([1, 2, 3, 9],), ([1, 9],), ([1, 2, 3, 4],)], "ids array<int>")

    def cut(**options):
        return [r[0] for r in df.select(cl.truncate(F.col("ids"), 3, **options)).collect()]

    assert cut() == [[1, 2, 3], [1, 9], [1, 2, 3]]
    assert cut(eos_id=9, clean=True) == [[1, 2, 9], [1, 9], [1, 2, 3]]


def test_examples(spark):
    df = spark.createDataFrame(
        [(1, "train", "abcd"), (2, "validation", "  "), (3, "validation", "ba"), (4, "train", None)],
        "row_id int, split string, text string")
    vocab = cl.build_char_vocab(df)
    rows = {r.row_id: r for r in cl.tokenize_dataset(df, vocab, 3).collect()}
    assert sorted(rows) == [1, 3]
    assert rows[1].input_ids == rows[1].labels == [1, 2, 3]
    assert rows[1].attention_mask == [1, 1, 1] and rows[3].split == "validation"
    words = spark.createDataFrame([("<unk>", 0), ("abcd", 1), ("</s>", 2)], "token string, id int")
    long = spark.createDataFrame([(1, "abcd abcd x abcd")], "row_id int, text string")
    assert cl.tokenize_dataset(long, words, 3, eos="</s>").first().input_ids == [1, 1, 0]
    assert cl.tokenize_dataset(long, words, 3, eos="</s>", clean=True).first().input_ids == [1, 1, 2]


def test_stats(spark):
    rows = [("train", list(range(n))) for n in range(1, 101)] + [("dev", [])]
    df = spark.createDataFrame(rows, "split string, ids array<int>")
    got = {r.split: r for r in cl.token_stats(df, 90).collect()}
    r = got["train"]
    assert (r.n_rows, r.n_truncated, r.n_tokens, r.n_tokens_kept) == (100, 10, 5050, 4095 + 900)
    assert (r.longest, r.p50, r.p90, r.p99) == (100, 50, 90, 99)
    assert got["dev"].p99 == 0


def test_map_batches(spark):
    import pyarrow as pa

    def make():
        sizes = []

        def fn(batch):
            sizes.append(batch.num_rows)
            assert batch.num_rows <= 100
            return pa.RecordBatch.from_arrays([pa.array([len(sizes)]), pa.array([batch.num_rows])],
                                              names=["call", "rows"])
        return fn

    df = spark.range(1000, numPartitions=2)
    rows = cl.map_batches(df, make, "call bigint, rows bigint", batch_rows=100).collect()
    assert sum(r.rows for r in rows) == 1000
    assert sorted(r.call for r in rows) == sorted([1, 2, 3, 4, 5] * 2)


def greedy(word, table, mark, most, unknown):
    out, at = [], 0
    while at < len(word):
        for size in range(min(most, len(word) - at), 0, -1):
            piece = (mark if at else "") + word[at:at + size]
            if piece in table:
                out.append(table[piece])
                at += size
                break
        else:
            return [unknown]
    return out


@pytest.mark.parametrize("mark, lookup", [("", 65_536), ("##", 65_536), ("##", 3)])
def test_subwords_against_a_loop(spark, monkeypatch, mark, lookup):
    monkeypatch.setattr(tk, "LOOKUP_ROWS", lookup)
    texts = ["unaffable unable, able!", "", "aaaa aab zq " * 5, None, "un" * 40, "able"]
    starts = ["un", "a", "aa", "able", ",", "unaff"]
    table = {t: i for i, t in enumerate(["<unk>", *starts, *[mark + t for t in (
        "a", "b", "able", "un", "aff", "aaa")]][:64])}
    vocab = spark.createDataFrame(list(table.items()), "token string, id int")
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    got = {r.row_id: r.ids for r in cl.encode_subwords(
        df, vocab, continuation=mark, max_piece=5).collect()}
    assert got == {i: [p for w in word_list(t or "") for p in greedy(w, table, mark, 5, 0)]
                   for i, t in enumerate(texts)}


@pytest.mark.parametrize("rows, at_once", [(0, 1), (100, 1), (100, 7), (100, 10 ** 6)])
@pytest.mark.parametrize("mark", ["", "##"])
def test_subwords_in_place_and_by_join(spark, monkeypatch, mark, rows, at_once):
    """A table that tasks are given and one that is joined, entries and marks of odd kinds."""
    monkeypatch.setattr(tk, "TABLE_ROWS", rows)
    monkeypatch.setattr(tk, "WORDS_AT_ONCE", at_once)
    long = "abcdefghijklmnopqr"
    listed = [("<unk>", 0), ("a", 1), ("a", 9), (mark + "a", 7), ("b", None), ("", 3), ("#", 4),
              (mark + "b", 5), (long, 6), (mark + long[:17], 8), (mark, 10), ("😀", 11), ("漢", 12),
              (mark + "漢", 13), (None, 14), (mark + long, 15)]
    texts = ["", None, "a ab ba # ##a 😀 漢漢 b", f"{long} a{long} a{long}{long[:17]} {long[:17]}b",
             "c ac", "  \n", f"{long[:16]} {long}b" + " aab" * 9]
    table = {t: max((i for u, i in listed if u == t and i is not None), default=None)
             for t, _ in listed if t}
    vocab = spark.createDataFrame(listed, "token string, id int")
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                               "row_id int, text string, split string")
    coded = cl.encode_subwords(df, vocab, continuation=mark)
    assert coded.columns == ["row_id", "split", "ids"]
    want = {i: [p for w in word_list(t or "") for p in greedy(w, table, mark, 40, 0)]
            for i, t in enumerate(texts)}
    assert {r.row_id: r.ids for r in coded.collect()} == want
    first = cl.encode_subwords(df, vocab, continuation=mark, max_len=3)
    assert {r.row_id: r.ids for r in first.collect()} == {i: ids[:3] for i, ids in want.items()}
    words = spark.createDataFrame([("ab", 1), (None, 2), ("", 3), ("ax", 4)], "token string, id int")
    assert {r.token: r.id for r in cl.split_words(words, vocab, 0, mark).collect()} == {
        "ab": greedy("ab", table, mark, 40, 0), None: [0], "": [0], "ax": [0]}


def test_subwords_of_many_words_move_no_row(spark, monkeypatch):
    """More words than are looked up in place: rows are cut where they are."""
    monkeypatch.setattr(tk, "LOOKUP_ROWS", 3)
    vocab = spark.createDataFrame([(c, i) for i, c in enumerate("abc")], "token string, id int")
    rows = [(i, "a b c ab bc ca abc") for i in range(3)]
    coded = cl.encode_subwords(spark.createDataFrame(rows, "row_id int, text string"), vocab)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert [r.ids for r in coded.collect()] == [[0, 1, 2, 0, 1, 1, 2, 2, 0, 0, 1, 2]] * 3
    with pytest.raises(ValueError, match="not unique"):
        cl.encode_subwords(spark.createDataFrame(rows[:1] * 2, "row_id int, text string"), vocab)


def test_subwords_of_long_entries(spark):
    long = "incomprehensibilities"
    table = {t: i for i, t in enumerate(["<unk>", *sorted(set(long)), "incomprehensible", long])}
    vocab = spark.createDataFrame(list(table.items()), "token string, id int")
    df = spark.createDataFrame([(1, f"{long} {long}s")], "row_id int, text string")
    assert cl.encode_subwords(df, vocab).first().ids == [
        table[long], table[long], table["s"]]
    with pytest.raises(ValueError, match="entry of 21"):
        cl.encode_subwords(df, vocab, max_piece=16)
