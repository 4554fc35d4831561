"""

Every query reads the whole tables of ``sf_dir``. The SQL is written for another engine and states
the result in its plain global form (one sort, one string), where the operators work by parts.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpusloom as cl
from corpusloom.functions.text import WHITESPACE
from corpusloom.operators.tokens import characters
from corpusloom.session import scratch_path

try:
    from corpusloom.llm import queries as llm
except ImportError:
    llm = None

EOS = "</s>"
SEP = "\n\n"


# --- inputs derived from the given tables --------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")


def spread_documents(spark, sf_dir) -> DataFrame:
    """For work per character: dealt to all cores where the scan is a single task."""
    return cl.spread(documents(spark, sf_dir))


def named_splits(spark, sf_dir) -> DataFrame:
    digit = F.col("row_id") % 10
    return documents(spark, sf_dir).withColumn(
        "split", F.when(digit == 0, "test").when(digit == 1, "validation")
        .when(digit == 2, "dev").otherwise("train"))


def with_blanks(spark, sf_dir) -> DataFrame:
    blank = F.when(F.col("row_id") % 150 == 0, "").when(
        F.col("row_id") % 150 == 50, "\t\n").otherwise("  ")
    return named_splits(spark, sf_dir).withColumn(
        "text", F.when(F.col("row_id") % 50 == 0, blank).otherwise(F.col("text")))


def conversations(spark, sf_dir) -> DataFrame:
    turns = cl.spread(table(spark, sf_dir, "conversations"))
    return cl.assemble_conversations(turns, "conv_id", "turn").withColumnRenamed(
        "conv_id", "row_id")


def instructions(spark, sf_dir) -> DataFrame:
    """User turns with the answer that follows, and the first system turn of the conversation.

    The pair meets on conversation and turn, so a long conversation is spread over all tasks.
    """
    turns = cl.spread(table(spark, sf_dir, "conversations"))
    user = turns.where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("instruction"))
    answer = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    system = turns.where("role = 'system'").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("input"))
    return (
        user.join(answer, ["conv_id", "turn"]).join(system, "conv_id", "left")
        .select(F.concat_ws("-", "conv_id", "turn").alias("row_id"), "conv_id", "turn",
                "instruction", "input", "output")
    )


def rendered(spark, sf_dir) -> DataFrame:
    """Rendered documents with a held out part."""
    return cl.render(cl.holdout(documents(spark, sf_dir)), "text")


def joined(ids) -> F.Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), ",")


# --- queries: rendering --------------------------------------------------------------------------

def q_conv_render(spark, sf_dir):
    return cl.render(conversations(spark, sf_dir), eos=EOS)


def q_conv_render_parts(spark, sf_dir):
    """Conversations put together from parts, as very long ones are."""
    turns = cl.spread(table(spark, sf_dir, "conversations"))
    lists = cl.assemble_conversations(turns, "conv_id", "turn", turns_per_part=3)
    return cl.render(lists.withColumnRenamed("conv_id", "row_id"), eos=EOS)


def q_conv_roles_chatml(spark, sf_dir):
    return cl.render(conversations(spark, sf_dir), style="chatml")


def q_conv_roles_inst(spark, sf_dir):
    return cl.render(conversations(spark, sf_dir), style="inst")


def q_conv_strings_render(spark, sf_dir):
    lists = conversations(spark, sf_dir).withColumn(
        "messages", F.transform("messages", lambda m: m["content"]))
    return cl.render(lists, eos=EOS)


def q_conv_json_render(spark, sf_dir):
    """JSON text under either set of keys, and text that is no JSON."""
    other = F.to_json(F.transform("messages", lambda m: F.struct(
        m["role"].alias("from"), m["content"].alias("value"))))
    bare = F.element_at("messages", 1)["content"]
    lists = conversations(spark, sf_dir)
    payload = F.when(F.col("row_id") % 3 == 0, other).when(
        F.col("row_id") % 3 == 1, F.to_json("messages")).otherwise(bare)
    return cl.render(lists.withColumn("messages", payload), eos=EOS)


def q_conv_json_odd(spark, sf_dir):
    """Text after a list, single quotes, no number, repeated keys, and JSON that is no list."""
    lists = conversations(spark, sf_dir)
    n = F.size("messages").cast("string")
    said = F.translate(F.element_at("messages", 1)["content"], "\"\\\n\t\r", "")
    listed = F.concat(F.lit('[{"role":"user","content":"'), said, F.lit('"}]'))
    kinds = [
        F.concat(listed, F.lit(" trailing")), F.translate(listed, '"', "'"),
        F.concat(F.lit("["), n, F.lit(', NaN, "'), said, F.lit('"]')),
        F.concat(F.lit('[{"role":"system","content":1,"role":"user","content":"'), said,
                 F.lit('"},'), n, F.lit("]")),
        F.concat(F.lit('{"turns": '), n, F.lit("}")), F.concat(F.lit('"'), said, F.lit('"'))]
    kind = F.col("row_id") % len(kinds)
    payload = F.coalesce(*[F.when(kind == i, k) for i, k in enumerate(kinds)])
    return cl.render(lists.withColumn("messages", payload), eos=EOS)


def q_layout_other_key(spark, sf_dir):
    """A key of another name is no content."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    return cl.render(docs, key="doc_id")


def q_instr_render(spark, sf_dir):
    pairs = instructions(spark, sf_dir).select("row_id", "instruction", "output")
    return cl.render(pairs, eos=EOS)


def q_instr_input_render(spark, sf_dir):
    pairs = instructions(spark, sf_dir).select("row_id", "instruction", "input", "output")
    return cl.render(pairs, eos=EOS)


def q_text_render_eos(spark, sf_dir):
    return cl.drop_blank(cl.render(with_blanks(spark, sf_dir), eos=EOS))


def q_text_render_clean(spark, sf_dir):
    return cl.render(with_blanks(spark, sf_dir), eos=EOS, clean=True)


def q_trace_render(spark, sf_dir):
    traces = instructions(spark, sf_dir).select(
        "row_id", F.coalesce("input", F.lit("")).alias("context"),
        F.col("output").alias("cot"),
        F.struct("conv_id", "turn", F.col("instruction").alias("asked")).alias("output"),
        F.col("output").alias("completion"))
    return cl.render_trace(traces)


def q_prompt_wrap(spark, sf_dir):
    prompts = table(spark, sf_dir, "benchmark").select(
        "item_id", F.when(F.col("item_id") % 4 == 0, F.concat(
            F.lit("### Instruction:\n"), "text", F.lit("\n\n### Response:\n")))
        .when(F.col("item_id") % 5 == 0, F.concat(F.lit("[INST] "), "text"))
        .otherwise(F.col("text")).alias("prompt"))
    return cl.wrap_prompts(prompts)


def q_layout_fields(spark, sf_dir):
    """Layout and columns found by name, for the derived layouts; every row carries them."""
    docs = documents(spark, sf_dir)
    shapes = {
        "prompt_text": docs.select("row_id", F.col("text").alias("prompt"), "text"),
        "query_thinking": docs.select("row_id", F.col("text").alias("query"),
                                      F.upper("text").alias("thinking")),
        "body_only": docs.select("row_id", F.col("text").alias("body")),
    }
    out = None
    for name, df in shapes.items():
        layout = cl.detect_layout(df)
        part = cl.render(df).select(
            F.lit(name).alias("shape"), F.lit(layout).alias("layout"), "row_id", "text")
        out = part if out is None else out.unionByName(part)
    return out


# --- queries: splits and order -------------------------------------------------------------------

def q_holdout(spark, sf_dir):
    return cl.holdout(documents(spark, sf_dir)).select("row_id", "split")


def q_holdout_sizes(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_id", "row_id")
    return cl.holdout(events, 2.5, 7).groupBy("split").agg(F.count("*").alias("n_rows"))


def q_holdout_threshold(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"))
    return cl.holdout_threshold(events).select("row_id", "split")


def q_split_alias(spark, sf_dir):
    return cl.normalize_validation(named_splits(spark, sf_dir)).select("row_id", "split")


def q_split_alias_clean(spark, sf_dir):
    return cl.normalize_validation(named_splits(spark, sf_dir), clean=True).select(
        "row_id", "split")


def q_split_no_train(spark, sf_dir):
    """No split of the name: the first one by name, here ``corpus``, is the training data."""
    named = named_splits(spark, sf_dir).replace("train", "corpus", "split")
    return cl.holdout(cl.ensure_train(named)).select("row_id", "split")


def q_percent_slice(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), "text", "n_chars")
    return cl.percent_slice(docs, 25, 50)


def q_percent_slice_events(spark, sf_dir):
    """The first percent by a key that is text and not dense."""
    events = table(spark, sf_dir, "events").select(
        F.concat_ws("-", "event_type", "event_id").alias("row_id"), "user_id", "value")
    return cl.percent_slice(events, 0, 1)


def q_global_rank(spark, sf_dir):
    """Every line, by a key that is text; orders have several lines of the same number."""
    items = table(spark, sf_dir, "lineitem").select(F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("row_id"), "l_quantity")
    return cl.global_rank(items)


def q_shuffle_epochs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    return cl.shuffle_epochs(orders)


def q_shuffle_resume(spark, sf_dir):
    """An epoch as a whole, and the next one entered at three fifths of its places."""
    docs = cl.with_row_id(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    rows = docs.count()
    whole = cl.shuffled_part(docs, rows, 0, rows, epoch=0)
    rest = cl.shuffled_part(docs, rows, rows * 3 // 5, rows, epoch=1)
    return whole.withColumn("epoch", F.lit(0)).unionByName(rest.withColumn("epoch", F.lit(1)))


def q_exact_k(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"))
    return cl.exact_k(customers, 100, 11)


# --- queries: the corpus as a stream -------------------------------------------------------------

def q_corpus_length(spark, sf_dir):
    return cl.corpus_length(documents(spark, sf_dir))


def q_corpus_offsets(spark, sf_dir):
    return cl.corpus_offsets(documents(spark, sf_dir))


def q_concat_corpus(spark, sf_dir):
    return cl.concat_corpus(documents(spark, sf_dir))


def q_contiguous_split(spark, sf_dir):
    return cl.contiguous_split(cl.corpus_offsets(documents(spark, sf_dir)))


def q_split_segments(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return cl.split_segments(docs, cl.materialize(cl.corpus_offsets(docs), "index"))


def q_sampled_windows(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vocab = cl.char_table(cl.build_char_vocab(cl.spread(docs), extra=SEP))
    stream = cl.contiguous_split(cl.materialize(cl.corpus_offsets(docs), "index"))
    windows = cl.sample_windows(stream, docs, n_batches=50, vocab=vocab)
    return windows.withColumns({"x": joined("x"), "y": joined("y")})


def q_sampled_windows_joined(spark, sf_dir):
    """The same windows without any broadcast, as for very many of them."""
    docs = documents(spark, sf_dir)
    stream = cl.contiguous_split(cl.materialize(cl.corpus_offsets(docs), "index"))
    return cl.sample_windows(stream, docs, n_batches=50, broadcast_rows=0)


def q_short_windows(spark, sf_dir):
    """A corpus shorter than a block: all windows start at its beginning."""
    names = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("row_id"), F.col("r_name").alias("text"))
    stream = cl.contiguous_split(cl.materialize(cl.corpus_offsets(names), "index"))
    return cl.sample_windows(stream, names, n_batches=50)


def null_texts(spark, sf_dir) -> DataFrame:
    """Half of the texts are null; rows and separators stay."""
    return documents(spark, sf_dir).withColumn(
        "text", F.when(F.col("row_id") % 20 >= 10, F.col("text")))


def q_null_offsets(spark, sf_dir):
    return cl.corpus_offsets(null_texts(spark, sf_dir))


def q_null_segments(spark, sf_dir):
    docs = null_texts(spark, sf_dir)
    return cl.split_segments(docs, cl.materialize(cl.corpus_offsets(docs), "index"))


def q_null_windows(spark, sf_dir):
    docs = null_texts(spark, sf_dir)
    stream = cl.contiguous_split(cl.materialize(cl.corpus_offsets(docs), "index"))
    return cl.sample_windows(stream, docs, n_batches=50)


def q_null_next_counts(spark, sf_dir):
    docs = null_texts(spark, sf_dir)
    return train_counts(docs, cl.materialize(cl.corpus_offsets(docs), "index"))


def q_id_windows(spark, sf_dir):
    """Windows over word ids from a store in blocks."""
    docs = spread_documents(spark, sf_dir)
    vocab = cl.materialize(cl.build_word_vocab(docs, 5000), "vocab")
    coded = cl.materialize(cl.encode_words(docs, vocab), "coded")
    store = cl.write_id_store(coded, scratch_path(spark, "ids"), block_ids=1024)
    windows = cl.sample_id_windows(store, n_batches=50)
    return windows.withColumns({"x": joined("x"), "y": joined("y")})


# --- queries: tokens -----------------------------------------------------------------------------

def q_char_vocab(spark, sf_dir):
    return cl.build_char_vocab(spread_documents(spark, sf_dir), extra=SEP)


def q_vocab_size(spark, sf_dir):
    return cl.vocab_size(spread_documents(spark, sf_dir), extra=SEP)


def q_char_encode(spark, sf_dir):
    docs = spread_documents(spark, sf_dir)
    coded = cl.encode_chars(docs, cl.build_char_vocab(docs))
    return coded.select("row_id", joined("ids").alias("ids"))


def q_char_roundtrip(spark, sf_dir):
    docs = spread_documents(spark, sf_dir)
    vocab = cl.char_table(cl.build_char_vocab(docs))
    coded = cl.encode_chars(docs, vocab).select("row_id", "ids")
    return cl.decode_chars(coded, vocab).select("row_id", "text")


def q_char_encode_join(spark, sf_dir):
    docs = spread_documents(spark, sf_dir)
    vocab = cl.build_char_vocab(docs).withColumnRenamed("ch", "token")
    coded = cl.encode_join(
        docs.withColumn("chars", characters(F.col("text"))), "chars", vocab)
    return coded.select("row_id", joined("ids").alias("ids"))


def q_word_vocab(spark, sf_dir):
    return cl.build_word_vocab(spread_documents(spark, sf_dir), 5000)


def q_word_encode(spark, sf_dir):
    docs = spread_documents(spark, sf_dir)
    vocab = cl.materialize(cl.build_word_vocab(docs, 5000), "vocab")
    coded = cl.encode_words(docs, vocab)
    return coded.select("row_id", joined("ids").alias("ids"))


def q_word_encode_long_token(spark, sf_dir):
    """One word of 60,000 letters among the frequent ones."""
    docs = spread_documents(spark, sf_dir)
    word = F.concat(F.repeat(F.lit("z"), F.lit(60_000)), F.lit(" "))
    docs = docs.union(spark.range(1).select(
        F.lit(-1).cast("bigint"), F.repeat(word, F.lit(50))))
    vocab = cl.materialize(cl.build_word_vocab(docs, 5000), "vocab")
    coded = cl.encode_words(docs, vocab)
    return coded.select("row_id", joined("ids").alias("ids"))


def q_word_encode_large(spark, sf_dir):
    """A vocabulary of all words, past the bound of the look-up in place."""
    docs = spread_documents(spark, sf_dir)
    vocab = cl.materialize(cl.build_word_vocab(docs, 10 ** 9), "vocab")
    coded = cl.encode_words(docs, vocab)
    return coded.select("row_id", joined("ids").alias("ids"))


def q_word_encode_shuffled(spark, sf_dir):
    """The same, with the rest of the vocabulary joined by shuffle."""
    docs = spread_documents(spark, sf_dir)
    vocab = cl.materialize(cl.build_word_vocab(docs, 10 ** 9), "vocab")
    coded = cl.encode_words(docs, vocab, broadcast_rows=0)
    return coded.select("row_id", joined("ids").alias("ids"))


def subword_table(docs) -> DataFrame:
    """All characters and the frequent words of any length, with ids."""
    often = cl.build_word_vocab(docs, 1000, specials=()).select("token")
    tokens = cl.build_char_vocab(docs).select(F.col("ch").alias("token")).union(often).distinct()
    return cl.materialize(cl.global_rank(cl.materialize(tokens, "tokens"), "token", "id").select(
        "token", F.col("id").cast("int").alias("id")), "vocab")


def q_subword_encode(spark, sf_dir):
    """By a token table of all characters and the frequent words of any length."""
    docs = spread_documents(spark, sf_dir)
    coded = cl.encode_subwords(docs, subword_table(docs))
    return coded.select("row_id", joined("ids").alias("ids"))


def q_subword_encode_long_token(spark, sf_dir):
    """The same with a word of 60,000 letters, once alone and once within a longer one."""
    docs = spread_documents(spark, sf_dir)
    word = F.repeat(F.lit("z"), F.lit(60_000))
    docs = docs.union(spark.range(1).select(F.lit(-1).cast("bigint"), F.concat(
        F.repeat(F.concat(word, F.lit(" ")), F.lit(50)), F.lit("q"), word, F.lit("qz"))))
    coded = cl.encode_subwords(docs, subword_table(docs))
    return coded.select("row_id", joined("ids").alias("ids"))


def q_subword_merges(spark, sf_dir):
    """Merges learnt over the words of all documents."""
    return cl.learn_merges(cl.word_counts(spread_documents(spark, sf_dir)), 64)


def q_subword_merge_encode(spark, sf_dir):
    """All documents by a vocabulary of characters and learnt merges."""
    docs = spread_documents(spark, sf_dir)
    merges = cl.materialize(cl.learn_merges(cl.word_counts(docs), 64), "merges")
    vocab = cl.materialize(cl.merge_vocab(cl.build_char_vocab(docs), merges), "vocab")
    coded = cl.encode_merges(docs, merges, vocab)
    return coded.select("row_id", joined("ids").alias("ids"))


def q_char_encode_wide(spark, sf_dir):
    """Characters of high code points in every text, which are looked up by pages."""
    docs = spread_documents(spark, sf_dir).withColumn(
        "text", F.concat("text", F.lit("漢字"), F.lit("😀"), F.lit("한")))
    coded = cl.encode_chars(docs, cl.build_char_vocab(docs))
    return coded.select("row_id", joined("ids").alias("ids"))


def q_tokenize_dataset(spark, sf_dir):
    """Blank rows out, end marker in, word ids cut to 256, masks and labels."""
    text = cl.render(cl.spread(with_blanks(spark, sf_dir)), eos=EOS)
    vocab = cl.materialize(cl.build_word_vocab(
        spread_documents(spark, sf_dir), 3000, min_count=2, eos=EOS), "vocab")
    examples = cl.tokenize_dataset(text, vocab, eos=EOS)
    return examples.select(
        "row_id", "split", *[joined(c).alias(c) for c in
                             ("input_ids", "attention_mask", "labels")])


def q_truncate_stats(spark, sf_dir):
    # One id per character, so the length of the text is the length of the ids.
    return cl.token_stats(named_splits(spark, sf_dir), size=F.length("text"))


def q_split_counts(spark, sf_dir):
    return cl.split_counts(with_blanks(spark, sf_dir))


def q_map_batches(spark, sf_dir):
    """A user's function over Arrow batches: bytes per text."""
    def make():
        import pyarrow.compute as pc

        def count_bytes(batch):
            return pa.RecordBatch.from_arrays(
                [batch["row_id"], pc.cast(pc.binary_length(batch["text"]), pa.int64())],
                names=["row_id", "n_bytes"])
        return count_bytes

    return cl.map_batches(documents(spark, sf_dir), make, "row_id bigint, n_bytes bigint")


# --- queries: batches ----------------------------------------------------------------------------

def char_examples(spark, sf_dir) -> DataFrame:
    docs = spread_documents(spark, sf_dir)
    vocab = cl.char_table(cl.build_char_vocab(docs))
    return cl.tokenize_dataset(docs, vocab, 256)


def q_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    return cl.assign_batches(orders, batch_size=4)


def q_padded(spark, sf_dir):
    batches = cl.assign_batches(char_examples(spark, sf_dir), batch_size=4, epochs=1)
    return cl.pad_batches(batches, pad_id=0).select(
        "row_id", "batch_id", "slot", *[joined(c).alias(c) for c in
                                        ("input_ids", "attention_mask", "labels")])


def q_padded_left(spark, sf_dir):
    batches = cl.assign_batches(char_examples(spark, sf_dir), batch_size=3, epochs=1)
    return cl.pad_batches(batches, pad_id=999, side="left").select(
        "row_id", "batch_id", "slot", *[joined(c).alias(c) for c in
                                        ("input_ids", "attention_mask", "labels")])


def q_accumulation(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    return cl.accumulation_groups(cl.assign_batches(orders, 2), 8).groupBy("epoch", "step").agg(
        F.count("*").alias("n_rows"))


def q_pad_report(spark, sf_dir):
    docs = spread_documents(spark, sf_dir)
    sized = cl.tokenize_dataset(docs, cl.char_table(cl.build_char_vocab(docs)), 256)
    return cl.pad_report(cl.assign_batches(sized, 2), 8)


# --- queries: next-token tables ------------------------------------------------------------------

def train_counts(docs: DataFrame, index: DataFrame, order: int = 1) -> DataFrame:
    segments = cl.split_segments(cl.spread(docs), index).where("split = 'train'")
    return cl.next_token_counts(segments, SEP, index.agg(F.min("row_id")).first()[0], order=order)


def scores(spark, sf_dir) -> DataFrame:
    """Log counts of the next character as logits; the previous character is the prompt."""
    docs = spread_documents(spark, sf_dir)
    pairs = cl.next_token_counts(
        docs.select("row_id", F.concat("text", F.lit(SEP)).alias("text")), SEP)
    return pairs.select(
        F.col("token").alias("prompt_id"), F.col("next").alias("token"),
        F.log(F.col("n").cast("double")).alias("logit"))


def q_next_token_counts(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return train_counts(docs, cl.materialize(cl.corpus_offsets(docs), "index"))


def q_eval_loss(spark, sf_dir):
    docs = documents(spark, sf_dir)
    index = cl.materialize(cl.corpus_offsets(docs), "index")
    counts = train_counts(docs, index)
    size = cl.build_char_vocab(cl.spread(docs), extra=SEP).count()
    windows = cl.sample_windows(cl.contiguous_split(index), docs, n_batches=50)
    loss = cl.eval_loss(counts, windows, 1.0, size)
    return loss.withColumn("loss", F.round("loss", 6))


def q_context_counts(spark, sf_dir):
    """Next characters after three others."""
    docs = documents(spark, sf_dir)
    return train_counts(docs, cl.materialize(cl.corpus_offsets(docs), "index"), 3)


def q_back_off_loss(spark, sf_dir):
    """Loss by contexts of up to three characters, with back-off to shorter ones."""
    docs = documents(spark, sf_dir)
    index = cl.materialize(cl.corpus_offsets(docs), "index")
    size = cl.build_char_vocab(cl.spread(docs), extra=SEP).count()
    windows = cl.sample_windows(cl.contiguous_split(index), docs, n_batches=50)
    loss = cl.eval_back_off(train_counts(docs, index, 3), windows, 3, size)
    return loss.withColumn("loss", F.round("loss", 6))


def q_softmax(spark, sf_dir):
    return cl.temperature_softmax(scores(spark, sf_dir)).select(
        "prompt_id", "token", F.round("prob", 6).alias("prob"))


def q_topk(spark, sf_dir):
    kept = cl.temperature_softmax(cl.top_k(scores(spark, sf_dir), 20), 0.7)
    return kept.select("prompt_id", "token", F.round("prob", 6).alias("prob"))


def q_topp(spark, sf_dir):
    kept = cl.top_p(cl.temperature_softmax(scores(spark, sf_dir), 0.7), 0.9)
    return kept.select("prompt_id", "token", F.round("prob", 6).alias("prob"))


def q_penalty(spark, sf_dir):
    """Shifted logits, so that some are negative; seen is what follows a prompt in its own top 5."""
    shifted = cl.materialize(scores(spark, sf_dir), "scores").withColumn(
        "logit", F.col("logit") - 3)
    lowered = cl.repetition_penalty(shifted, cl.top_k(shifted, 5), 1.1)
    return lowered.select("prompt_id", "token", F.round("logit", 6).alias("logit"))


def q_sample(spark, sf_dir):
    return cl.sample_next(cl.temperature_softmax(cl.top_k(scores(spark, sf_dir), 20), 0.7))


def q_choose_next(spark, sf_dir):
    """All sampling settings at once; what follows a prompt most often counts as seen."""
    logits = cl.materialize(scores(spark, sf_dir), "scores")
    return cl.choose_next(logits, cl.PrepConfig(), cl.top_k(logits, 5))


def q_greedy(spark, sf_dir):
    return cl.greedy_next(scores(spark, sf_dir))


# --- queries: sources, sinks, streams ------------------------------------------------------------

def written(df: DataFrame, name: str, fmt: str, **options) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).format(fmt).save(path)
    return path


def q_src_json(spark, sf_dir):
    path = written(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "j", "json")
    return cl.read_files(spark, path).select("doc_id", "lang", "text", "split")


def named(spark: SparkSession, path: str, suffix: str) -> str:
    """Give written text files another suffix."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(place):
        old = status.getPath().toString()
        if old.endswith(".txt"):
            fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(
                old.removesuffix(".txt") + suffix))
    return path


def json_lines(docs: DataFrame) -> F.Column:
    return F.to_json(F.struct(*docs.columns))


def q_src_json_mixed(spark, sf_dir):
    """A folder with files of one object per line and files that are an array each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = scratch_path(spark, "mixed")
    docs.where("doc_id % 2 = 0").select(json_lines(docs).alias("v")).write.text(path)
    arrays = docs.where("doc_id % 2 = 1").groupBy((F.col("doc_id") % 16).alias("g")).agg(F.concat(
        F.lit("["), F.array_join(F.collect_list(json_lines(docs)), ",\n"), F.lit("]")).alias("v"))
    arrays.select("v").write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return cl.read_files(spark, named(spark, path, ".json")).select(
        "doc_id", "lang", "text", "split")


#: Bytes of text that one file of the array query has; a file with more is several byte ranges.
ARRAY_BYTES = 256 << 20


def q_src_json_array(spark, sf_dir):
    """All documents as one array in one file, of larger tables in as many as it takes, in a folder
    named by its URI; a null element is no row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    n = 1 + size // ARRAY_BYTES
    line = F.concat(F.lit(","), json_lines(docs)).alias("v")
    ends = spark.range(n).select(F.col("id").cast("int").alias("file"), F.explode(F.array(
        F.struct(F.lit(0).alias("at"), F.lit("[null").alias("v")),
        F.struct(F.lit(2).alias("at"), F.lit("]").alias("v")))).alias("end")).select(
        "file", "end.at", "end.v")
    path = scratch_path(spark, "array")
    # Rows are dealt as they are scanned, so no file depends on what the keys or texts are.
    docs.select(F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int").alias("file"),
                F.lit(1).alias("at"), line).union(ends).repartitionById(
        n, F.col("file")).sortWithinPartitions("at").select("v").write.text(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(named(spark, path, ".json"))
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return cl.split_bad_lines(cl.read_files(spark, uri))[0]


def broken_lines(spark, sf_dir) -> str:
    """JSON lines of the documents; every tenth one breaks off."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("body"))
    line = F.when(F.col("row_id") % 10 == 3, F.concat(
        F.lit('{"row_id":'), F.col("row_id"), F.lit(',"body'))).otherwise(json_lines(docs))
    path = scratch_path(spark, "broken")
    docs.select(line.alias("v")).write.text(path)
    return named(spark, path, ".jsonl")


def with_lines(rows: DataFrame) -> DataFrame:
    """Rendered rows, and beside them the lines that could not be read."""
    bad = cl.split_bad_lines(rows)[1]
    return cl.render(rows).select("row_id", "text", F.lit(None).cast("string").alias("line")).union(
        bad.select(F.lit(None).cast("bigint"), F.lit(None).cast("string"), "line"))


def q_src_json_bad_lines(spark, sf_dir):
    """With a schema and without one: the same rows, and the same lines that are none."""
    path = broken_lines(spark, sf_dir)
    kinds = [with_lines(cl.materialize(cl.read_files(spark, path, schema), "rows")).withColumn(
        "given", F.lit(schema is not None)) for schema in (None, "row_id bigint, body string")]
    return kinds[0].union(kinds[1])


def q_stream_bad_lines(spark, sf_dir):
    stream = cl.read_stream(
        spark, broken_lines(spark, sf_dir), "json", "row_id bigint, body string")
    path, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "offsets")
    cl.write_stream(stream, path, checkpoint)
    return with_lines(spark.read.parquet(path))


def q_src_csv(spark, sf_dir):
    path = written(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "c", "csv",
                   header=True, escape='"', quoteAll=True)
    rows = cl.read_files(spark, path, "doc_id bigint, lang string, text string", multiline=True)
    return cl.split_bad_lines(rows)[0]


def q_src_csv_inferred(spark, sf_dir):
    path = written(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"), "c", "csv", header=True)
    return cl.split_bad_lines(cl.read_files(spark, path))[0].withColumn(
        "o_orderkey", F.col("o_orderkey").cast("bigint"))


def q_src_parquet(spark, sf_dir):
    path = written(table(spark, sf_dir, "conversations"), "p", "parquet")
    return cl.read_files(spark, path)


def q_src_text(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", "\n")).alias("text"))
    return cl.read_files(spark, written(lines, "t", "text")).groupBy("text").agg(
        F.count("*").alias("n"))


def q_src_dir(spark, sf_dir):
    """A folder with JSON lines and Parquet files, each read with its own reader."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    path = scratch_path(spark, "d")
    customers.where("c_custkey % 2 = 0").write.mode("append").json(path)
    customers.where("c_custkey % 2 = 1").write.mode("append").parquet(path)
    rows = cl.read_files(spark, path, "c_custkey bigint, c_name string", clean=True)
    return cl.split_bad_lines(rows)[0]


def q_src_catalog(spark, sf_dir):
    root = scratch_path(spark, "root")
    cl.write_catalog(named_splits(spark, sf_dir), root, "docs", "main")
    return cl.read_catalog(spark, root, "docs", "main").select("row_id", "split", "text")


def q_row_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    by_name = docs.select(F.concat_ws("/", "lang", "doc_id").alias("name"))
    return cl.with_row_id(by_name, "name")


def q_write_examples(spark, sf_dir):
    path = scratch_path(spark, "examples")
    cl.write_examples(char_examples(spark, sf_dir).withColumn("split", F.lit("train")), path)
    return spark.read.parquet(path).select(
        "row_id", "split", joined("input_ids").alias("input_ids"))


def sharded(spark, sf_dir) -> tuple[str, DataFrame]:
    """All characters of the documents, by split, in shards of about 20,000."""
    docs = cl.holdout(spread_documents(spark, sf_dir))
    coded = cl.encode_chars(docs, cl.build_char_vocab(docs)).select("row_id", "split", "ids")
    path = scratch_path(spark, "shards")
    return path, cl.write_shards(coded, path, tokens=20_000, ids="ids")


def q_shard_manifest(spark, sf_dir):
    return sharded(spark, sf_dir)[1].drop("folder")


def q_shard_reads(spark, sf_dir):
    """A range of the training examples, some by their numbers, and all for validation."""
    path, _ = sharded(spark, sf_dir)
    kinds = {"range": cl.read_numbers(spark, path, 50, 130),
             "some": cl.read_at(spark, path, [n * n for n in range(30)]),
             "all": cl.read_numbers(spark, path, split="validation")}
    parts = [df.select("row_id", "split", "number", "shard", F.size("ids").alias("n"),
                       F.lit(kind).alias("kind")) for kind, df in kinds.items()]
    return parts[0].union(parts[1]).union(parts[2])


def events_stream(spark, sf_dir) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = cl.read_stream(spark, f"{sf_dir}/events.parquet*", "parquet", schema)
    return stream.select(F.col("event_id").alias("row_id"), F.col("event_type").alias("text"))


def q_stream_counts(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "counts"), scratch_path(spark, "offsets")
    cl.streaming_counts(cl.holdout_threshold(events_stream(spark, sf_dir)), path, checkpoint)
    return cl.latest_counts(spark, path)


def q_stream_holdout(spark, sf_dir):
    """The exact holdout of the documents as they arrive in files, one a trigger."""
    parts = scratch_path(spark, "arrivals")
    documents(spark, sf_dir).select("row_id").repartition(3).write.parquet(parts)
    stream = cl.read_stream(spark, parts, "parquet", "row_id bigint", files_per_trigger=1)
    path, checkpoint = scratch_path(spark, "held"), scratch_path(spark, "offsets")
    cl.write_holdout_stream(stream, path, checkpoint)
    return cl.read_holdout_stream(spark, path)


def q_stream_chats(spark, sf_dir):
    """Turns in the order of two files: every seventh comes with the second, some of them too late.

    From the fifth turn on an hour has passed, which is a session of its own.
    """
    second = F.col("conv_id") * 600 + F.col("turn") * 60 + F.when(F.col("turn") >= 4, 3600).otherwise(0)
    turns = cl.spread(table(spark, sf_dir, "conversations")).withColumn(
        "at", F.timestamp_seconds(second))
    straggles = F.col("conv_id") * 3 + F.col("turn")
    files = scratch_path(spark, "arrivals")
    for part in (straggles % 7 != 0, straggles % 7 == 0):
        turns.where(part).coalesce(1).write.mode("append").parquet(files)
    stream = cl.read_stream(spark, files, "parquet", turns.schema, files_per_trigger=1)
    path, checkpoint = scratch_path(spark, "chats"), scratch_path(spark, "offsets")
    cl.write_chat_stream(stream, path, checkpoint, "conv_id", "turn", "at", delay=20_000)
    chats = cl.read_chat_stream(spark, path, "conv_id", "turn", "at", open_too=True).withColumnRenamed(
        "conv_id", "row_id")
    whole = cl.render(chats.withColumn("row_id", F.struct(
        "row_id", F.unix_seconds("start").alias("start"))), eos=EOS)
    late = cl.read_late_turns(spark, path).select(
        F.col("conv_id").alias("row_id"), F.unix_seconds("at").alias("start"), "text",
        F.lit(True).alias("late"))
    return whole.select("row_id.*", "text", F.lit(False).alias("late")).union(late)


def arrive(rows: DataFrame, parts: list, files: str, read) -> None:
    """Write the parts of a table (conditions) one after the other below ``files``, each in as many
    files as it has tasks, and let ``read`` go on with its stream when one is there: a trigger each."""
    for part in parts:
        rows.where(part).write.mode("append").parquet(files)
        read()


def grown_words(spark, sf_dir) -> str:
    """A vocabulary of all documents, those with odd numbers arriving second."""
    docs = spread_documents(spark, sf_dir)
    files, path = scratch_path(spark, "arrivals"), scratch_path(spark, "grown")
    offsets = scratch_path(spark, "offsets")

    def read():
        stream = cl.read_stream(spark, files, "parquet", "row_id bigint, text string")
        cl.write_vocab_stream(stream, path, offsets, min_count=3, counters=1000, key="row_id")

    arrive(docs, [F.abs("row_id") % 2 == rest for rest in (0, 1)], files, read)
    return path


def q_stream_vocab(spark, sf_dir):
    """The dictionary by versions, and the bounds of the words that are still counted."""
    path = grown_words(spark, sf_dir)
    known = cl.read_vocab_stream(spark, path, 0).select("token", F.lit(0).alias("version"))
    return cl.read_vocab_stream(spark, path).join(known, "token", "left").join(
        cl.read_heavy_hitters(spark, path), "token", "left").withColumn(
        "version", F.coalesce("version", F.lit(1)))


def q_stream_vocab_encode(spark, sf_dir):
    """Every document by the version of its own trigger."""
    return cl.read_vocab_ids(spark, grown_words(spark, sf_dir)).select(
        "row_id", "version", joined("ids").alias("ids"))


def q_stream_sketch(spark, sf_dir):
    """Lengths in words and different words per language, of documents that come in three parts;
    the estimate is held against the count."""
    docs = cl.spread(table(spark, sf_dir, "documents").select("lang", "text"))
    files, path = scratch_path(spark, "arrivals"), scratch_path(spark, "sketches")
    offsets = scratch_path(spark, "offsets")

    def read():
        stream = cl.read_stream(spark, files, "parquet", docs.schema)
        cl.write_sketch_stream(stream, path, offsets, by=("lang",))

    part = F.pmod(F.xxhash64("lang", "text"), F.lit(3))
    arrive(docs, [part == i for i in range(3)], files, read)
    exact = cl.word_rows(docs, by=("lang",)).groupBy("lang").agg(
        F.count_distinct("token").alias("exact"))
    return cl.read_sketch_stream(spark, path, ("lang",)).join(exact, "lang").withColumn(
        "near", F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")).drop("n_distinct")


def q_stream_render(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    stream = cl.read_stream(spark, f"{sf_dir}/documents.parquet*", "parquet", schema).select(
        F.col("doc_id").alias("row_id"), "text")
    held = cl.holdout_threshold(stream)
    path, checkpoint = scratch_path(spark, "rendered"), scratch_path(spark, "offsets")
    cl.write_stream(cl.drop_blank(cl.render(held, eos=EOS)), path, checkpoint)
    return spark.read.parquet(path).select("row_id", "split", "text")


def q_stream_encode(spark, sf_dir):
    vocab = cl.build_char_vocab(documents(spark, sf_dir), extra=EOS)
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    stream = cl.read_stream(spark, f"{sf_dir}/documents.parquet*", "parquet", schema).select(
        F.col("doc_id").alias("row_id"), "text")
    cfg = cl.PrepConfig(source="files", path=sf_dir, eos=EOS)
    path, checkpoint = scratch_path(spark, "examples"), scratch_path(spark, "offsets")
    cl.write_stream(cl.prepare_stream(stream, cfg, vocab), path, checkpoint)
    return spark.read.parquet(path).select(
        "row_id", "split", joined("input_ids").alias("input_ids"))


def q_stream_words(spark, sf_dir):
    docs = spread_documents(spark, sf_dir)
    vocab = cl.materialize(cl.build_word_vocab(docs, 3000, eos=EOS), "vocab")
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    stream = cl.read_stream(spark, f"{sf_dir}/documents.parquet*", "parquet", schema).select(
        F.col("doc_id").alias("row_id"), "text")
    cfg = cl.PrepConfig(source="files", path=sf_dir, eos=EOS)
    path, checkpoint = scratch_path(spark, "examples"), scratch_path(spark, "offsets")
    cl.write_stream(cl.prepare_stream(stream, cfg, vocab), path, checkpoint)
    return spark.read.parquet(path).select(
        "row_id", "split", joined("input_ids").alias("input_ids"))


def q_prepared_plain_file(spark, sf_dir):
    """An ordinary file: no key in it, rows are numbered from 0."""
    path = written(table(spark, sf_dir, "documents").select("text"), "plain", "json")
    cfg = cl.PrepConfig(source="files", path=path, schema="text string", vocab_size=2000, eos=EOS)
    examples = cl.materialize(cl.prepare(spark, cfg), "examples")
    ids = examples.agg(F.count_distinct("row_id"), F.min("row_id"), F.max("row_id"),
                       F.count_if(F.col("split") == "validation")).first()
    return examples.select(
        joined("input_ids").alias("input_ids"), *[F.lit(v).cast("bigint").alias(name) for name, v in
                                                  zip(("n_ids", "first_id", "last_id", "n_validation"), ids)])


def q_prepared_batches(spark, sf_dir):
    """Examples of conversations, shuffled and padded by the settings; the end marker pads."""
    root = scratch_path(spark, "root")
    cl.write_catalog(conversations(spark, sf_dir).withColumn("split", F.lit("train")), root, "chats")
    cfg = cl.PrepConfig(root=root, name="chats", vocab_size=2000, eos=EOS, batch_size=4, accum=2)
    vocab = cl.learn_words(cl.render(conversations(spark, sf_dir), eos=EOS), cfg)
    examples = cl.materialize(cl.prepare(spark, cfg, vocab), "examples")
    return cl.prepare_batches(examples, vocab, cfg).select(
        "epoch", "step", "batch_id", "slot", "row_id",
        *[joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")])


def q_prepared_chars(spark, sf_dir):
    """Windows over the first half of the joined traces."""
    pairs = instructions(spark, sf_dir).select(
        "row_id", F.coalesce("input", F.lit("")).alias("context"),
        F.concat(F.lit("so: "), "output").alias("cot"),
        F.struct("conv_id", "turn").alias("output"),
        F.col("output").alias("completion"))
    _, _, windows = cl.prepare_traces(cl.materialize(pairs, "pairs"), cl.PrepConfig())
    return windows.withColumns({"x": joined("x"), "y": joined("y")})


def q_prepared_examples(spark, sf_dir):
    """The whole way: catalog table, splits, rendering, vocabulary, examples."""
    root = scratch_path(spark, "root")
    cl.write_catalog(conversations(spark, sf_dir).withColumn("split", F.lit("train")), root, "chats")
    cfg = cl.PrepConfig(root=root, name="chats", vocab_size=2000, eos=EOS)
    return cl.prepare(spark, cfg).select("row_id", "split", joined("input_ids").alias("input_ids"))


# --- SQL twins -----------------------------------------------------------------------------------

WS = "'" + WHITESPACE + "'"
NL = "chr(10)"
NL2 = "chr(10) || chr(10)"
LABEL = "upper(left(role, 1)) || lower(substr(role, 2))"


def _eos(expr: str) -> str:
    return f"case when {expr} like '%{EOS}' then {expr} else {expr} || '{EOS}' end"


DOCS = "docs as (select doc_id as row_id, text from documents)"
SPLITS = DOCS + """, named as (select row_id, text, case row_id % 10 when 0 then 'test'
  when 1 then 'validation' when 2 then 'dev' else 'train' end as split from docs)"""
BLANKS = SPLITS + """, blanks as (select row_id, split, case
  when row_id % 150 = 0 then '' when row_id % 150 = 50 then chr(9) || chr(10)
  when row_id % 50 = 0 then chr(160) || ' ' else text end as text from named)"""
PAIRS = """pairs as (select u.conv_id || '-' || u.turn as row_id, u.conv_id, u.turn,
    u.text as instruction, s.text as input, a.text as output
  from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
  left join (select conv_id, first(text order by turn) as text from conversations
    where role = 'system' group by conv_id) s on s.conv_id = u.conv_id
  where u.role = 'user' and a.role = 'assistant')"""
CHATS = f"""chats as (select conv_id as row_id,
  string_agg({LABEL} || ': ' || text, {NL2} order by turn) as body from conversations
  group by conv_id)"""
VOCAB = """vocab as (select ch, (row_number() over (order by ch) - 1)::int as id from
  (select distinct unnest(string_split(text, '')) as ch from {src}) where ch <> '')"""
WHOLE = """, whole as (select string_agg(text, chr(10) || chr(10) order by row_id) as body,
    count(*) as n_rows from docs), marks as (select text from docs union all select chr(10)),
  cut as (select length(body) as total, floor(0.9::double * length(body))::bigint as brk, body
    from whole),
  parts as (select 'train' as split, brk as total, left(body, brk) as body from cut
    union all select 'validation', total - brk, substr(body, brk + 1) from cut)"""
CORPUS = DOCS + WHOLE
OFFSETS = DOCS + """, sized as (select row_id, text, length(text)
    + case when row_id = max(row_id) over () then 0 else 2 end as n from docs),
  placed as (select row_id, text, n, sum(n) over () as total,
    sum(n) over (order by row_id) - n as off from sized)"""
NULL_DOCS = """docs as (select doc_id as row_id, case when doc_id % 20 >= 10 then text else '' end
  as text from documents)"""
GRAMS = OFFSETS + f""", cut4 as (select *, floor(0.9::double * total)::bigint as brk, text
    || case when off + n = total then '' else {NL2} end as seg from placed),
  runs as (select string_split(case when row_id = (select min(row_id) from docs) then ''
    else repeat(chr(10), 3) end || left(seg, least(n, brk - off)::bigint), '') as c
    from cut4 where off < brk),
  grams as (select p[1] || p[2] || p[3] || p[4] as g, count(*)::bigint as n
    from (select unnest(list_zip(c[:-4], c[2:-3], c[3:-2], c[4:])) as p from runs)
    where p[4] is not null group by 1)"""
SCORES = DOCS + """, chars as (select row_id, string_split(
    case when row_id = (select min(row_id) from docs) then '' else chr(10) end
    || text || chr(10) || chr(10), '') as c from docs),
  follow as (select unnest(list_zip(c[:-2], c[2:])) as p from chars),
  scores as (select p[1] as prompt_id, p[2] as token, ln(count(*)::double) as logit
    from follow group by all)"""
RANKS = "row_number() over (partition by prompt_id order by {by} desc, token)"
WORDS_RE = r"'[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'"
WORDS_EOS_RE = rf"'{EOS}|[\p{{L}}\p{{N}}]+|[^\s\p{{L}}\p{{N}}]'"


def _word_vocab(src: str, size: int, pattern: str, specials: list[str], min_count: int = 1) -> str:
    listed = ", ".join(f"('{s}', {i}, 0)" for i, s in enumerate(specials))
    names = ", ".join(f"'{s}'" for s in specials)
    return f"""words as (select token, count(*) as n from (select unnest(regexp_extract_all(text,
      {pattern})) as token from {src}) group by token
      having count(*) >= {min_count} and token not in ({names})),
    ranked as (select token, row_number() over (order by n desc, token) as r, n from words),
    vocab as (select token, (r - 1 + {len(specials)})::int as id, n::bigint as n from ranked
      where r <= {size - len(specials)} union all select * from (values {listed}) v(token, id, n))"""


SPECIALS = ["<pad>", EOS, "<unk>"]


def _word_ids(src: str, pattern: str, unknown: int, cut: int | None = None, keep: str = "") -> str:
    kept = f"where pos <= {cut}" if cut else ""
    return f"""tokens as (select row_id{keep}, unnest(w) as token, generate_subscripts(w, 1) as pos
      from (select row_id{keep}, regexp_extract_all(text, {pattern}) as w from {src})),
    coded as (select row_id{keep}, string_agg(coalesce(id, {unknown})::varchar, ',' order by pos)
      as ids, count(*) as len from (select * from tokens {kept}) left join vocab using (token)
      group by all)"""


def _char_ids(src: str, cut: int | None = None) -> str:
    text = f"left(text, {cut})" if cut else "text"
    return f"""lut as (select map_from_entries(list(row(ch, id))) as m from vocab),
    coded as (select row_id, [m[c] for c in string_split({text}, '')] as l
      from {src}, lut where text <> '')"""


def _grown_words(counters: int, min_count: int) -> str:
    """Dictionary and summary after each of two triggers: ``dict``, ``kept2`` and ``off``."""
    names = ", ".join(f"'{s}'" for s in SPECIALS)
    listed = ", ".join(f"('{s}', {i}, 0)" for i, s in enumerate(SPECIALS))

    def summary(i, merged):
        return f"""merged{i} as ({merged}), off{i} as (select coalesce((select n from merged{i}
          order by n desc limit 1 offset {counters}), 0) as off),
        kept{i} as (select token, n - off as n from merged{i}, off{i} where n > off)"""

    return f"""counted as (select row_id % 2 as part, token, count(*) as n from (select row_id,
          unnest(regexp_extract_all(text, {WORDS_RE})) as token from docs)
          where token not in ({names}) group by all),
        {summary(1, "select token, n from counted where part = 0")},
        {summary(2, """select token, sum(n)::bigint as n from (select token, n from counted where part = 1
          union all select token, n from kept1) group by token""")},
        dict1 as (select token, ({len(SPECIALS)} - 1 + row_number() over (order by n desc, token))::int
          as id, 0 as version from kept1 where n >= {min_count}
          union all select * from (values {listed}) v(token, id, version)),
        dict as (select * from dict1 union all select token, ((select count(*) from dict1) - 1
          + row_number() over (order by n desc, token))::int, 1 from kept2
          where n >= {min_count} and token not in (select token from dict1)),
        off as (select off1.off + off2.off as off from off1, off2)"""


def _with_lines() -> str:
    return f"""with lines as (select doc_id as row_id, trim(text, {WS}) as text,
        null::varchar as line from documents where doc_id % 10 <> 3
      union all select null, null, '{{"row_id":' || doc_id || ',"body' from documents
        where doc_id % 10 = 3)"""


SHUFFLED = """shuffled as (select row_id, epoch, row_number() over (partition by epoch order by
  md5('42|' || epoch || '|' || row_id), row_id) - 1 as pos from {src}, range({epochs}) e(epoch))"""


def _grid_step(src: str, where: str = "") -> str:
    """One pass of the keyed permutation over the cells of a grid of ``w`` by ``h``."""
    step = f"""select doc_id, row_id, epoch, v // h as x, v % h as y, w, h
        from {src}, cells {where}"""
    for r in range(6):
        moved, kept, size = ("x", "y", "w") if r % 2 == 0 else ("y", "x", "h")
        digest = f"md5('42|' || epoch || '|{r}|' || {kept})"
        step = f"""select doc_id, row_id, epoch, w, h, {kept},
            ({moved} + ('0x' || left({digest}, 15))::bigint % {size}) % {size} as {moved}
            from ({step})"""
    return f"select doc_id, row_id, epoch, x * h + y as v from ({step})"


def _windows(n_batches: int, docs: str = DOCS) -> str:
    return docs + WHOLE + f""", draws as (select split, total, body, i // 32 as batch_id,
      (i % 32)::int as slot, case when total - 257 <= 0 then 0 else
      ('0x' || substr(md5('1337|' || split || '|' || i), 1, 15))::bigint % (total - 257) end
      as start from parts, range({n_batches * 32}) r(i)),
    cuts as (select split, batch_id, slot, start, substr(body, start + 1, 257) as w from draws)"""


TRAIN_PAIRS = CORPUS + """, train as (select string_split(body, '') as c from parts
    where split = 'train'),
  follow as (select unnest(list_zip(c[:-2], c[2:])) as p from train),
  counts as (select p[1] as token, p[2] as next, count(*)::bigint as n from follow group by all)"""


def _padded(cut: int, batch: int, pad: int, side: str) -> str:
    def fill(value):
        return f"[{value} for i in range(width - len(l))]"

    def cat(c, value):
        both = (fill(value), c) if side == "left" else (c, fill(value))
        return f"array_to_string(list_concat({both[0]}, {both[1]}), ',')"

    labels = f"[case when i = {pad} then -100 else i end for i in l]"
    return f"""with {DOCS}, {VOCAB.format(src='docs')}, full_docs as (select * from docs
      where trim(text, {WS}) <> ''), {_char_ids('full_docs', cut)},
    {SHUFFLED.format(src='full_docs', epochs=1)},
    batches as (select row_id, pos // {batch} as batch_id, (pos % {batch})::int as slot, l,
      max(len(l)) over (partition by pos // {batch}) as width from shuffled join coded
      using (row_id))
    select row_id, batch_id, slot, {cat('l', pad)} as input_ids,
      {cat('[1 for i in l]', 0)} as attention_mask, {cat(labels, -100)} as labels
    from batches"""


def _subwords(docs: str) -> str:
    """Longest entry first; every part that a word could have meets the table on its text."""
    return f"""with recursive docs as ({docs}), said as (select row_id, unnest(w) as word,
          generate_subscripts(w, 1) as pos from (select row_id,
          regexp_extract_all(text, {WORDS_RE}) as w from docs)),
        counted as (select word, count(*) as n from said group by word),
        often as (select word from counted order by n desc, word limit 1000),
        tokens as (select word as token from often
          union select distinct unnest(string_split(text, '')) from docs where text <> ''),
        pc as (select token, row_number() over (order by token) - 1 as id,
          length(token) as len from tokens),
        lens as (select distinct len from pc),
        spots as (select word, unnest(range(1, length(word) + 1)) as spot from counted),
        best as (select word, spot, max(pc.len) as len, max_by(pc.id, pc.len) as id
          from (select word, spot, len, substr(word, spot, len) as part from spots join lens
            on len <= length(word) - spot + 1) join pc on pc.token = part group by word, spot),
        walk as (select word, 1::bigint as spot from counted
          union all select word, spot + len from walk join best using (word, spot)),
        parts as (select word, string_agg(id::varchar, ',' order by spot) as ids
          from walk join best using (word, spot) group by word),
        rows as (select row_id, string_agg(ids, ',' order by pos) as ids
          from said join parts using (word) group by row_id)
        select row_id, coalesce(ids, '') as ids from docs left join rows using (row_id)"""


def _merges(n: int) -> str:
    """One merge a step, all words in each; symbols stand between two spaces."""
    return f"""with recursive {DOCS}, said as (select row_id, unnest(w) as word,
          generate_subscripts(w, 1) as pos from (select row_id,
          regexp_extract_all(text, {WORDS_RE}) as w from docs)),
        counted as (select word, count(*) as n from said group by word),
        merging as (select 0 as step, word, n, null::varchar as a, null::varchar as b, 0::bigint as c,
            ' ' || array_to_string(string_split(word, ''), '  ') || ' ' as s from counted
          union all select step + 1, word, n, p.a, p.b, p.c,
            replace(s, ' ' || p.a || '  ' || p.b || ' ', ' ' || p.a || p.b || ' ')
          from merging, (select x.a, x.b, sum(n)::bigint as c from (select n, unnest(list_transform(
              generate_series(1, len(l) - 1), lambda i: {{'a': l[i], 'b': l[i + 1]}})) as x
              from (select n, string_split(s[2:length(s) - 1], '  ') as l from merging))
            group by 1, 2 order by 3 desc, 1, 2 limit 1) p
          where step < {n})"""


def own_sql() -> dict[str, str]:
    holdout = """select row_id, case when row_number() over (order by md5('42|' || row_id), row_id)
      <= ceil(count(*) over () * 5 / 100.0) then 'validation' else 'train' end as split"""
    threshold = """case when ('0x' || left(md5('42|' || row_id), 8))::bigint / 4294967296.0::double
      < 0.05 then 'validation' else 'train' end"""
    softmax = """soft as (select prompt_id, token, logit,
      exp(logit / 0.7 - max(logit / 0.7) over (partition by prompt_id)) as e from {src}),
      probs as (select prompt_id, token, logit, e / sum(e) over (partition by prompt_id) as prob
      from soft)"""
    sharded = f"""with {DOCS}, held as ({holdout} from docs), sized as (select row_id, split,
      length(text) as n, row_number() over (partition by split order by row_id) - 1 as number,
      sum(length(text)) over (partition by split order by row_id) - length(text) as off
      from held join docs using (row_id)), dealt as (select *, (dense_rank() over (partition by split
      order by greatest(off - case when n = 0 then 1 else 0 end, 0) // 20000) - 1)::int as shard
      from sized)"""
    best20 = f"""kept as (select * from scores qualify {RANKS.format(by='logit')} <= 20)"""
    role = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
    inst = """case role when 'system' then '<<SYS>>' || chr(10) || text || chr(10) || '<</SYS>>'
      || chr(10) || chr(10) when 'user' then '[INST] ' || text || ' [/INST]' else ' ' || text || ' '
      end"""
    shaped = f"trim(text, {WS})"
    return {
        "conv_render": f"with {CHATS} select row_id, {_eos('body')} as text from chats",
        "conv_render_parts": f"with {CHATS} select row_id, {_eos('body')} as text from chats",
        "conv_roles_chatml": f"""select conv_id as row_id, string_agg({role}, '' order by turn)
            as text from conversations group by conv_id""",
        "conv_roles_inst": f"""select conv_id as row_id, string_agg({inst}, '' order by turn)
            as text from conversations group by conv_id""",
        "conv_strings_render": f"""with chats as (select conv_id as row_id, string_agg(text, {NL2}
            order by turn) as body from conversations group by conv_id)
            select row_id, {_eos('body')} as text from chats""",
        "conv_json_render": f"""with {CHATS}, firsts as (select conv_id as row_id,
            first(text order by turn) as head from conversations group by conv_id),
            bodies as (select row_id, case when row_id % 3 = 2 then head else body end as body
            from chats join firsts using (row_id))
            select row_id, {_eos('body')} as text from bodies""",
        "conv_json_odd": f"""with heads as (select conv_id as row_id, count(*) as n,
              translate(first(text order by turn), '"' || chr(92) || chr(10) || chr(9) || chr(13), '')
              as said from conversations group by conv_id),
            bodies as (select row_id, case row_id % 6
              when 0 then '[{{"role":"user","content":"' || said || '"}}] trailing'
              when 1 then replace('[{{"role":"user","content":"' || said || '"}}]', '"', chr(39))
              when 2 then n || {NL2} || 'NaN' || {NL2} || said
              when 3 then 'User: ' || said || {NL2} || n
              when 4 then '{{"turns":' || n || '}}' else said end as body from heads)
            select row_id, {_eos('body')} as text from bodies""",
        "layout_other_key": f"select doc_id, {shaped} as text from documents",
        "instr_render": f"""with {PAIRS}, bodies as (select row_id, '### Instruction:' || {NL}
            || trim(instruction, {WS}) || {NL2} || '### Response:' || {NL} || trim(output, {WS})
            as body from pairs) select row_id, {_eos('body')} as text from bodies""",
        "instr_input_render": f"""with {PAIRS}, bodies as (select row_id, '### Instruction:' || {NL}
            || trim(instruction, {WS}) || case when input <> '' then {NL2} || '### Input:' || {NL}
            || trim(input, {WS}) else '' end || {NL2} || '### Response:' || {NL}
            || trim(output, {WS}) as body from pairs)
            select row_id, {_eos('body')} as text from bodies""",
        "text_render_eos": f"""with {BLANKS}, bodies as (select row_id, split, trim(text, {WS})
            as body from blanks) select row_id, split, {_eos('body')} as text from bodies""",
        "text_render_clean": f"""with {BLANKS}, bodies as (select row_id, split, trim(text, {WS})
            as body from blanks) select row_id, split, {_eos('body')} as text from bodies
            where body <> ''""",
        "trace_render": f"""with {PAIRS} select row_id, coalesce(input, '') || {NL}
            || output || {NL} || '{{"conv_id": ' || conv_id || ', "turn": ' || turn
            || ', "asked": ' || to_json(instruction) || '}}' || {NL} || output as text from pairs""",
        "prompt_wrap": f"""with p as (select item_id, case when item_id % 4 = 0 then
            '### Instruction:' || {NL} || text || {NL2} || '### Response:' || {NL}
            when item_id % 5 = 0 then '[INST] ' || text else text end as prompt from benchmark)
            select item_id, case when contains(prompt, '### Instruction:')
            or starts_with(prompt, '<|im_start|>') or starts_with(prompt, '[INST]') then prompt
            else '### Instruction:' || {NL} || prompt || {NL2} || '### Response:' || {NL} end
            as prompt from p""",
        "layout_fields": f"""with {DOCS} select 'prompt_text' as shape, 'instruction' as layout,
            row_id, '### Instruction:' || {NL} || {shaped} || {NL2}
            || '### Response:' || {NL} || {shaped} as text from docs
            union all select 'query_thinking', 'text', row_id, {shaped} from docs
            union all select 'body_only', 'text', row_id, {shaped} from docs""",
        "holdout": f"with {DOCS} {holdout} from docs",
        "holdout_sizes": """with n as (select count(*) as n from events),
            k as (select n, ceil(n * 25 / 1000.0)::bigint as k from n)
            select 'train' as split, n - k as n_rows from k
            union all select 'validation', k from k""",
        "holdout_threshold": f"""with e as (select event_id as row_id from events)
            select row_id, {threshold} as split from e""",
        "split_alias": f"""with {SPLITS} select row_id, case split when 'train' then 'train'
            else 'validation' end as split from named where split in ('train', 'dev')""",
        "split_alias_clean": f"with {SPLITS} select row_id, split from named",
        "split_no_train": f"""with {SPLITS}, rest as (select row_id from named where split = 'train')
            {holdout} from rest""",
        "percent_slice": """select row_id, text, n_chars from (select doc_id as row_id, text, n_chars,
            row_number() over (order by doc_id) as r, count(*) over () as n from documents)
            where r > round_even(n * 25 / 100.0, 0) and r <= round_even(n * 50 / 100.0, 0)""",
        "percent_slice_events": """select row_id, user_id, value from (select row_id, user_id, value,
            row_number() over (order by row_id) as r, count(*) over () as n from
            (select event_type || '-' || event_id as row_id, user_id, value from events))
            where r <= round_even(n / 100.0, 0)""",
        "global_rank": """select row_id, l_quantity, row_number() over (order by row_id) - 1 as rank
            from (select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
              || '-' || round(l_extendedprice * 100)::bigint as row_id, l_quantity from lineitem)""",
        "shuffle_epochs": f"""with o as (select o_orderkey as row_id from orders),
            {SHUFFLED.format(src='o', epochs=2)} select row_id, epoch::int as epoch, pos
            from shuffled""",
        "shuffle_resume": f"""with recursive docs as (select doc_id,
              row_number() over (order by doc_id) - 1 as row_id from documents),
            facts as (select count(*) as n, floor(sqrt(count(*)))::bigint as root from docs),
            widths as (select unnest(range(greatest(1, root - least(262144, root // 2)), root + 1))
              as w, n from facts),
            cells as (select w, (n + w - 1) // w as h, n from widths
              order by (w - n % w) % w, w desc limit 1),
            walk as ({_grid_step("""(select doc_id, row_id, e as epoch, row_id as v
                from docs, range(2) t(e))""")}
              union all {_grid_step("walk", "where v >= n")})
            select doc_id, row_id, v as pos, epoch::int as epoch from walk, facts
            where v < n and (epoch = 0 or v >= n * 3 // 5)""",
        "exact_k": """select c_custkey as row_id from customer
            order by md5('11|' || c_custkey), c_custkey limit 100""",
        "corpus_length": """select count(*) as n_rows,
            length(string_agg(text, chr(10) || chr(10)))::bigint as n_chars from documents""",
        "corpus_offsets": f"""with {OFFSETS} select row_id, off::bigint as off, n::bigint as n,
            total::bigint as total from placed""",
        "concat_corpus": f"""with {OFFSETS}, whole as (select string_agg(text, {NL2}
            order by row_id) as body from docs)
            select row_id, off::bigint as off, n::bigint as n, total::bigint as total,
            text || case when off + n = total then '' else {NL2} end as text from placed""",
        "contiguous_split": f"""with {OFFSETS}, cut as (select *, floor(0.9::double * total)::bigint
            as brk from placed)
            select 'train' as split, row_id, 0::bigint as skip, off::bigint as off,
              least(n, brk - off)::bigint as n, brk::bigint as total from cut where off < brk
            union all select 'validation', row_id, greatest(0, brk - off)::bigint,
              greatest(0, off - brk)::bigint, (n - greatest(0, brk - off))::bigint,
              (total - brk)::bigint from cut where off + n > brk""",
        "split_segments": f"""with {OFFSETS}, cut as (select *, floor(0.9::double * total)::bigint
            as brk, text || case when off + n = total then '' else {NL2} end as seg from placed)
            select 'train' as split, row_id, left(seg, least(n, brk - off)::bigint) as text from cut
              where off < brk
            union all select 'validation', row_id, substr(seg, greatest(0, brk - off)::bigint + 1)
              from cut where off + n > brk""",
        "sampled_windows": f"""with {_windows(50)}, {VOCAB.format(src='marks')},
            lut as (select map_from_entries(list(row(ch, id))) as m from vocab),
            ids as (select split, batch_id, slot, start, [m[c] for c in string_split(w, '')] as l
              from cuts, lut)
            select split, batch_id, slot, start, array_to_string(l[1:256], ',') as x,
              array_to_string(l[2:257], ',') as y from ids""",
        "null_offsets": f"""with {OFFSETS.replace(DOCS, NULL_DOCS)} select row_id,
            off::bigint as off, n::bigint as n, total::bigint as total from placed""",
        "null_segments": f"""with {OFFSETS.replace(DOCS, NULL_DOCS)}, cut as (select *,
            floor(0.9::double * total)::bigint as brk,
            text || case when off + n = total then '' else {NL2} end as seg from placed)
            select 'train' as split, row_id, left(seg, least(n, brk - off)::bigint) as text from cut
              where off < brk
            union all select 'validation', row_id, substr(seg, greatest(0, brk - off)::bigint + 1)
              from cut where off + n > brk""",
        "null_windows": f"""with {_windows(50, NULL_DOCS)} select split, batch_id, slot, start,
            left(w, 256) as x, substr(w, 2, 256) as y from cuts""",
        "null_next_counts": f"""with {TRAIN_PAIRS.replace(DOCS, NULL_DOCS)}
            select token, next, n from counts""",
        "id_windows": f"""with {DOCS}, {_word_vocab('docs', 5000, WORDS_RE, SPECIALS)},
            tokens as (select row_id, unnest(w) as token, generate_subscripts(w, 1) as pos from
              (select row_id, regexp_extract_all(text, {WORDS_RE}) as w from docs)),
            flat as (select coalesce(id, 2) as id, row_number() over (order by row_id, pos) - 1 as nth
              from tokens left join vocab using (token)),
            size as (select count(*) as total, floor(0.9::double * count(*))::bigint as cut from flat),
            parts as (select 'train' as split, 0 as base, cut as stop from size
              union all select 'validation', cut, total from size),
            draws as (select split, i // 32 as batch_id, (i % 32)::int as slot, base, stop,
              case when stop - base - 257 <= 0 then 0 else
              ('0x' || substr(md5('1337|' || split || '|' || i), 1, 15))::bigint
              % (stop - base - 257) end as start from parts, range(1600) r(i)),
            spots as (select *, unnest(range(base + start, least(base + start + 257, stop))) as nth
              from draws)
            select split, batch_id, slot, start,
              string_agg(id::varchar, ',' order by nth) filter (nth < base + start + 256) as x,
              string_agg(id::varchar, ',' order by nth) filter (nth > base + start) as y
            from spots join flat using (nth) group by split, batch_id, slot, start""",
        "sampled_windows_joined": f"""with {_windows(50)} select split, batch_id, slot, start,
            left(w, 256) as x, substr(w, 2, 256) as y from cuts""",
        "short_windows": f"""with {_windows(50, """docs as (select r_regionkey as row_id,
              r_name as text from region)""")}
            select split, batch_id, slot, start::bigint as start, left(w, 256) as x,
              substr(w, 2, 256) as y from cuts""",
        "char_vocab": f"with {CORPUS}, {VOCAB.format(src='marks')} select ch, id from vocab",
        "vocab_size": f"with {CORPUS}, {VOCAB.format(src='marks')} select count(*) as vocab_size"
                      " from vocab",
        "char_encode": f"""with {DOCS}, {VOCAB.format(src='docs')}, {_char_ids('docs')}
            select row_id, array_to_string(l, ',') as ids from coded""",
        "char_roundtrip": "select doc_id as row_id, text from documents",
        "char_encode_join": f"""with {DOCS}, {VOCAB.format(src='docs')}, {_char_ids('docs')}
            select row_id, array_to_string(l, ',') as ids from coded""",
        "word_vocab": f"""with {_word_vocab('documents', 5000, WORDS_RE, SPECIALS)}
            select token, id, n from vocab""",
        "word_encode": f"""with {DOCS}, {_word_vocab('docs', 5000, WORDS_RE, SPECIALS)},
            {_word_ids('docs', WORDS_RE, 2)} select docs.row_id, coalesce(ids, '') as ids
            from docs left join coded using (row_id)""",
        "word_encode_long_token": f"""with docs as (select doc_id as row_id, text from documents
              union all select -1, repeat(repeat('z', 60000) || ' ', 50)),
            {_word_vocab('docs', 5000, WORDS_RE, SPECIALS)}, {_word_ids('docs', WORDS_RE, 2)}
            select docs.row_id, coalesce(ids, '') as ids from docs left join coded using (row_id)""",
        **dict.fromkeys(("word_encode_large", "word_encode_shuffled"), f"""with {DOCS},
            {_word_vocab('docs', 10 ** 9, WORDS_RE, SPECIALS)},
            {_word_ids('docs', WORDS_RE, 2)} select docs.row_id, coalesce(ids, '') as ids
            from docs left join coded using (row_id)"""),
        "subword_encode": _subwords("select doc_id as row_id, text from documents"),
        "subword_encode_long_token": _subwords("""select doc_id as row_id, text from documents
            union all select -1, repeat(repeat('z', 60000) || ' ', 50) || 'q' || repeat('z', 60000)
              || 'qz'"""),
        "subword_merges": f"""{_merges(64)} select distinct step - 1 as rank, a as left, b as right,
            c as n from merging where step > 0""",
        "subword_merge_encode": f"""{_merges(64)}, {VOCAB.format(src='docs')},
            made as (select a || b as token, min(step) as step from merging where step > 0 group by 1),
            ids as (select ch as token, id from vocab union all select token,
              (select count(*) from vocab) + row_number() over (order by step) - 1 from made),
            parts as (select word, unnest(string_split(s[2:length(s) - 1], '  ')) as token,
              generate_subscripts(string_split(s[2:length(s) - 1], '  '), 1) as place
              from merging where step = 64),
            coded as (select word, string_agg(id::varchar, ',' order by place) as ids
              from parts join ids using (token) group by word),
            rows as (select row_id, string_agg(ids, ',' order by pos) as ids
              from said join coded using (word) group by row_id)
            select row_id, coalesce(ids, '') as ids from docs left join rows using (row_id)""",
        "char_encode_wide": f"""with docs as (select doc_id as row_id, text || '漢字😀한' as text
            from documents), {VOCAB.format(src='docs')}, {_char_ids('docs')}
            select row_id, array_to_string(l, ',') as ids from coded""",
        "tokenize_dataset": f"""with {BLANKS}, bodies as (select row_id, split, trim(text, {WS})
            as body from blanks), rows as (select row_id, split, {_eos('body')} as text from bodies),
            {_word_vocab('docs', 3000, WORDS_EOS_RE, SPECIALS, 2)},
            {_word_ids('rows', WORDS_EOS_RE, 2, 256, ', split')}
            select row_id, split, ids as input_ids, rtrim(repeat('1,', len), ',') as attention_mask,
            ids as labels from coded""",
        "truncate_stats": f"""with {SPLITS}, sized as (select split, length(text) as n from named)
            select split, count(*) as n_rows, count(*) filter (n > 256) as n_truncated,
            sum(n)::bigint as n_tokens, sum(least(n, 256))::bigint as n_tokens_kept,
            max(n)::bigint as longest, quantile_disc(n, 0.5)::bigint as p50,
            quantile_disc(n, 0.9)::bigint as p90, quantile_disc(n, 0.99)::bigint as p99
            from sized group by split""",
        "split_counts": f"""with {BLANKS} select split, count(*) as n_raw,
            count(*) filter (trim(text, {WS}) <> '') as n_kept,
            count(*) filter (trim(text, {WS}) = '') as n_dropped from blanks group by split""",
        "map_batches": "select doc_id as row_id, strlen(text) as n_bytes from documents",
        "batches": f"""with o as (select o_orderkey as row_id from orders),
            {SHUFFLED.format(src='o', epochs=2)} select row_id, epoch::int as epoch,
            pos // 4 as batch_id, (pos % 4)::int as slot from shuffled""",
        "padded": _padded(256, 4, 0, "right"),
        "padded_left": _padded(256, 3, 999, "left"),
        "accumulation": """with e as (select epoch, (row_number() over (partition by epoch) - 1)
            // 16 as step from orders, range(2) r(epoch))
            select epoch::int as epoch, step, count(*) as n_rows from e group by all""",
        "pad_report": f"""with {DOCS}, full_docs as (select row_id, least(length(text), 256) as len
            from docs where trim(text, {WS}) <> ''), {SHUFFLED.format(src='full_docs', epochs=2)},
            b as (select epoch, pos // 2 as batch_id, count(*) as r, sum(len) as t, max(len) as m
              from shuffled join full_docs using (row_id) group by all)
            select epoch::int as epoch, batch_id // 8 as step, sum(r)::bigint as n_rows,
            sum(t)::bigint as real_tokens, sum(r * m - t)::bigint as pad_tokens from b
            group by all""",
        "next_token_counts": f"with {TRAIN_PAIRS} select token, next, n from counts",
        "context_counts": f"""with {GRAMS} select left(g, 3) as token, right(g, 1) as next, n
            from grams""",
        "back_off_loss": f"""with {GRAMS}{_windows(50)[len(DOCS):]}, {VOCAB.format(src='marks')},
            l3 as (select left(g, 3) as ctx, right(g, 1) as nxt, n as c from grams),
            l2 as (select substr(g, 2, 2) as ctx, right(g, 1) as nxt, count(*) as c from grams
              group by 1, 2),
            l1 as (select right(ctx, 1) as ctx, nxt, count(*) as c from l2 group by 1, 2),
            l0 as (select nxt, count(*) as c from l1 group by 1),
            s3 as (select ctx, sum(c) as t, count(*) as k from l3 group by 1),
            s2 as (select ctx, sum(c) as t, count(*) as k from l2 group by 1),
            s1 as (select ctx, sum(c) as t, count(*) as k from l1 group by 1),
            s0 as (select sum(c) as t, count(*) as k from l0),
            spots as (select split, batch_id, w, unnest(range(1, length(w))) as i from cuts),
            seen as (select split, batch_id, substr(w, greatest(1, i - 2), least(i, 3)) as ctx,
              substr(w, i + 1, 1) as nxt, count(*) as n from spots group by all),
            p0 as (select split, batch_id, seen.ctx, nxt, n, (greatest(coalesce(c, 0) - 0.75::double, 0)
              + 0.75::double * k / (select count(*) from vocab)) / t as p
              from seen left join l0 using (nxt), s0),
            p1 as (select p0.* exclude (p), case when s1.t is null then p else
              (greatest(coalesce(c, 0) - 0.75::double, 0) + 0.75::double * k * p) / t end as p
              from p0 left join l1 on l1.ctx = right(p0.ctx, 1) and l1.nxt = p0.nxt
              left join s1 on s1.ctx = right(p0.ctx, 1)),
            p2 as (select p1.* exclude (p), case when s2.t is null then p else
              (greatest(coalesce(c, 0) - 0.75::double, 0) + 0.75::double * k * p) / t end as p
              from p1 left join l2 on l2.ctx = right(p1.ctx, 2) and l2.nxt = p1.nxt
              left join s2 on s2.ctx = right(p1.ctx, 2)),
            p3 as (select p2.* exclude (p), case when s3.t is null then p else
              (greatest(coalesce(c, 0) - 0.75::double, 0) + 0.75::double * k * p) / t end as p
              from p2 left join l3 on l3.ctx = p2.ctx and l3.nxt = p2.nxt
              left join s3 on s3.ctx = p2.ctx),
            losses as (select split, batch_id, sum(n * -ln(p)) / sum(n) as loss from p3 group by all)
            select split, count(*) as n_batches, round(avg(loss), 6) as loss from losses
            group by split""",
        "eval_loss": f"""with {TRAIN_PAIRS}, {VOCAB.format(src='marks')},
            ctx as (select token, sum(n) as total_n from counts group by token),
            size as (select count(*) as v from vocab),
            draws as (select split, total, body, i // 32 as batch_id, case when total - 257 <= 0
              then 0 else ('0x' || substr(md5('1337|' || split || '|' || i), 1, 15))::bigint
              % (total - 257) end as start from parts, range(1600) r(i)),
            w as (select split, batch_id, string_split(substr(body, start + 1, 257), '') as c
              from draws),
            f as (select split, batch_id, unnest(list_zip(c[:-2], c[2:])) as p from w),
            losses as (select f.split, f.batch_id, avg(-ln((coalesce(n, 0) + 1.0::double)
              / (coalesce(total_n, 0) + v::double))) as loss from f
              left join counts on counts.token = p[1] and counts.next = p[2]
              left join ctx on ctx.token = p[1], size group by all)
            select split, count(*) as n_batches, round(avg(loss), 6) as loss from losses
            group by split""",
        "softmax": f"""with {SCORES}, {softmax.format(src='scores')}
            select prompt_id, token, round(prob, 6) as prob from probs""",
        "topk": f"""with {SCORES}, {best20}, {softmax.format(src='kept')}
            select prompt_id, token, round(prob, 6) as prob from probs""",
        "topp": f"""with {SCORES}, {softmax.format(src='scores')}, summed as (select *,
            coalesce(sum(prob) over (partition by prompt_id order by prob desc, token
            rows between unbounded preceding and 1 preceding), 0) as b from probs)
            select prompt_id, token, round(prob, 6) as prob from summed where b < 0.9""",
        "penalty": f"""with {SCORES}, low as (select prompt_id, token, logit - 3 as logit,
            {RANKS.format(by='logit')} as r from scores)
            select prompt_id, token, round(case when r > 5 then logit when logit > 0
            then logit / 1.1 else logit * 1.1 end, 6) as logit from low""",
        "sample": f"""with {SCORES}, {best20}, {softmax.format(src='kept')}, summed as (select *,
            sum(prob) over (partition by prompt_id order by prob desc, token
              rows unbounded preceding) as upto, sum(prob) over (partition by prompt_id) as total,
            ('0x' || left(md5('1337|' || prompt_id), 13))::bigint / 4503599627370496.0::double as u
            from probs)
            select prompt_id, first(token order by prob desc, token) as token from summed
            where upto > u * total group by prompt_id""",
        "choose_next": f"""with {SCORES}, marked as (select prompt_id, token, logit,
            {RANKS.format(by='logit')} as r from scores), lowered as (select prompt_id, token,
            case when r > 5 then logit when logit > 0 then logit / 1.1 else logit * 1.1 end as logit
            from marked),
            kept as (select * from lowered qualify {RANKS.format(by='logit')} <= 20),
            {softmax.format(src='kept')}, summed as (select *, sum(prob) over (partition by prompt_id
              order by prob desc, token rows unbounded preceding) as upto from probs),
            nucleus as (select prompt_id, token, prob, upto from summed where upto - prob < 0.9),
            drawn as (select *, sum(prob) over (partition by prompt_id) as total,
              ('0x' || left(md5('42|' || prompt_id), 13))::bigint / 4503599627370496.0::double as u
              from nucleus)
            select prompt_id, first(token order by prob desc, token) as token from drawn
            where upto > u * total group by prompt_id""",
        "greedy": f"""with {SCORES} select prompt_id, first(token order by logit desc, token)
            as token from scores group by prompt_id""",
        "src_json": "select doc_id, lang, text, 'train' as split from documents",
        "src_json_mixed": "select doc_id, lang, text, 'train' as split from documents",
        "src_json_array": "select doc_id, lang, text, 'train' as split from documents",
        "src_json_bad_lines": f"""{_with_lines()} select row_id, text, line, given from lines,
            (values (true), (false)) v(given)""",
        "stream_bad_lines": f"{_with_lines()} select row_id, text, line from lines",
        "src_csv": "select doc_id, lang, text, 'train' as split from documents",
        "src_csv_inferred": """select o_orderkey, o_orderstatus, o_totalprice, 'train' as split
            from orders""",
        "src_parquet": "select conv_id, turn, role, text, 'train' as split from conversations",
        "src_text": """select text, count(*) as n from (select unnest(string_split(text, chr(10)))
            as text from documents) group by text""",
        "src_dir": "select c_custkey, c_name, 'train' as split from customer",
        "src_catalog": f"with {SPLITS} select row_id, split, text from named",
        "row_ids": """select lang || '/' || doc_id as name,
            row_number() over (order by lang || '/' || doc_id) - 1 as row_id from documents""",
        "write_examples": f"""with {DOCS}, {VOCAB.format(src='docs')}, full_docs as (select * from docs
            where trim(text, {WS}) <> ''), {_char_ids('full_docs', 256)}
            select row_id, 'train' as split, array_to_string(l, ',') as input_ids from coded""",
        "shard_manifest": f"""{sharded} select split, shard, min(row_id) as first_key,
            max(row_id) as last_key, count(*) as n_rows, sum(n)::bigint as n_tokens,
            min(number) as first_number, min(off)::bigint as first_token from dealt group by all""",
        "shard_reads": f"""{sharded}, kinds as (
            select *, 'range' as kind from dealt where split = 'train' and number between 50 and 129
            union all select *, 'some' from dealt where split = 'train' and number < 900
              and sqrt(number) = floor(sqrt(number))
            union all select *, 'all' from dealt where split = 'validation')
            select row_id, split, number, shard, n::int as n, kind from kinds""",
        "stream_counts": f"""with e as (select event_id as row_id, event_type as text from events)
            select {threshold} as split, count(*) as n_raw,
            count(*) filter (trim(text, {WS}) <> '') as n_kept,
            count(*) filter (trim(text, {WS}) = '') as n_dropped from e group by 1""",
        "stream_holdout": f"with {DOCS} {holdout} from docs",
        "stream_chats": f"""with timed as (select *, (conv_id * 3 + turn) % 7 = 0 as straggles,
              conv_id * 600 + turn * 60 + case when turn >= 4 then 3600 else 0 end as sec
              from conversations),
            marked as (select *, straggles and sec < (select max(sec) from timed where not straggles)
              - 20000 as late from timed),
            breaks as (select *, case when sec - lag(sec) over (partition by conv_id order by sec) < 1800
              then null else sec end as begins from marked where not late),
            runs as (select *, last_value(begins ignore nulls) over (partition by conv_id order by sec)
              as start from breaks),
            chats as (select conv_id as row_id, start,
              string_agg({LABEL} || ': ' || text, {NL2} order by turn) as body from runs
              group by conv_id, start)
            select row_id, start, {_eos('body')} as text, false as late from chats
            union all select conv_id, sec, text, true from marked where late""",
        "stream_vocab": f"""with {DOCS}, {_grown_words(1000, 3)}
            select token, id, version, n, n + off as n_most
            from dict left join kept2 using (token), off""",
        "stream_vocab_encode": f"""with {DOCS}, {_grown_words(1000, 3)},
            tokens as (select row_id, row_id % 2 as version, unnest(w) as token,
              generate_subscripts(w, 1) as pos
              from (select row_id, regexp_extract_all(text, {WORDS_RE}) as w from docs)),
            coded as (select row_id, string_agg(coalesce(id, 2)::varchar, ',' order by pos) as ids
              from tokens left join dict on tokens.token = dict.token
              and dict.version <= tokens.version group by row_id)
            select row_id, row_id % 2 as version, coalesce(ids, '') as ids
            from docs left join coded using (row_id)""",
        "stream_sketch": f"""with found as (select lang, regexp_extract_all(text, {WORDS_RE}) as w
              from documents), sizes as (select lang, len(w)::bigint as n from found),
            cells as (select lang, n, greatest(length(bin(n)) - 8, 0) as e from sizes),
            stats as (select lang, count(*) as n_rows, sum(n)::bigint as n_tokens,
              quantile_disc((n >> e) << e, 0.5) as p50_least,
              quantile_disc((n >> e) << e, 0.9) as p90_least,
              quantile_disc((n >> e) << e, 0.99) as p99_least,
              max((n >> e) << e) as longest_least from cells group by lang),
            words as (select lang, count(distinct token) as exact
              from (select lang, unnest(w) as token from found) group by lang)
            select lang, n_rows, n_tokens, p50_least, p90_least, p99_least, longest_least,
              {", ".join(f"{c}_least + (1::bigint << greatest(length(bin({c}_least)) - 8, 0)) - 1 as "
                         f"{c}_most" for c in ("p50", "p90", "p99", "longest"))},
              exact, true as near from stats join words using (lang)""",
        "stream_render": f"""with {DOCS}, bodies as (select row_id, {threshold} as split,
            trim(text, {WS}) as body from docs)
            select row_id, split, {_eos('body')} as text from bodies""",
        "stream_encode": f"""with {DOCS}, chars as (select text from docs
            union all select '{EOS}'), {VOCAB.format(src='chars')},
            bodies as (select row_id, trim(text, {WS}) as body from docs),
            rows as (select row_id, {_eos('body')} as text from bodies), {_char_ids('rows', 256)}
            select row_id, {threshold} as split, array_to_string(l, ',') as input_ids
            from coded""",
        "stream_words": f"""with {DOCS}, bodies as (select row_id, {threshold} as split,
            trim(text, {WS}) as body from docs),
            rows as (select row_id, split, {_eos('body')} as text from bodies),
            {_word_vocab('docs', 3000, WORDS_EOS_RE, SPECIALS)},
            {_word_ids('rows', WORDS_EOS_RE, 2, 256, ', split')}
            select row_id, split, ids as input_ids from coded""",
        "prepared_plain_file": f"""with {DOCS}, bodies as (select row_id, trim(text, {WS}) as body
            from docs), rows as (select row_id, {_eos('body')} as text from bodies),
            {_word_vocab('rows', 2000, WORDS_EOS_RE, SPECIALS)},
            {_word_ids('rows', WORDS_EOS_RE, 2, 256)},
            facts as (select count(*) as n from docs)
            select ids as input_ids, n as n_ids, 0::bigint as first_id, n - 1 as last_id,
              ceil(n * 5 / 100.0)::bigint as n_validation from coded, facts""",
        "prepared_batches": f"""with {CHATS}, rows as (select row_id, {_eos('body')} as text
            from chats), {_word_vocab('rows', 2000, WORDS_EOS_RE, SPECIALS)},
            {_word_ids('rows', WORDS_EOS_RE, 2, 256)}, held as ({holdout} from chats),
            train as (select row_id from held where split = 'train'),
            {SHUFFLED.format(src='train', epochs=2)},
            b as (select epoch, pos // 4 as batch_id, pos % 4 as slot, row_id, string_split(ids, ',')
              as l, max(len) over (partition by epoch, pos // 4) as width
              from shuffled join coded using (row_id))
            select epoch::int as epoch, batch_id // 2 as step, batch_id, slot::int as slot, row_id,
              array_to_string(list_concat(l, ['1' for i in range(width - len(l))]), ',') as input_ids,
              array_to_string(list_concat(['1' for i in l], ['0' for i in range(width - len(l))]),
                ',') as attention_mask,
              array_to_string(list_concat([case when i = '1' then '-100' else i end for i in l],
                ['-100' for i in range(width - len(l))]), ',') as labels from b""",
        "prepared_chars": f"""with {PAIRS}, traces as (select row_id, coalesce(input, '') || {NL}
              || 'so: ' || output || {NL} || '{{"conv_id": ' || conv_id || ', "turn": ' || turn || '}}'
              || {NL} || output as text, row_number() over (order by row_id) as r,
              count(*) over () as n from pairs),
            {_windows(50, "docs as (select row_id, text from traces where r <= round_even(n / 2.0, 0))")},
            {VOCAB.format(src='marks')},
            lut as (select map_from_entries(list(row(ch, id))) as m from vocab),
            ids as (select split, batch_id, slot, start, [m[c] for c in string_split(w, '')] as l
              from cuts, lut)
            select split, batch_id, slot, start, array_to_string(l[1:256], ',') as x,
              array_to_string(l[2:257], ',') as y from ids""",
        "prepared_examples": f"""with {CHATS}, rows as (select row_id, {_eos('body')} as text
            from chats), {_word_vocab('rows', 2000, WORDS_EOS_RE, SPECIALS)},
            {_word_ids('rows', WORDS_EOS_RE, 2, 256)}, held as ({holdout} from chats)
            select row_id, split, ids as input_ids from coded join held using (row_id)""",
    }


# --- contract ------------------------------------------------------------------------------------

def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n[2:]: f for n, f in globals().items() if n.startswith("q_") and callable(f)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return own_sql() | (llm.oracle_sql() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Conversations to token statistics per split."""
    chats = cl.render(cl.holdout(conversations(spark, "/root/testdata/sf0.001")), eos=EOS)
    kept = cl.drop_blank(chats)
    coded = cl.encode_chars(kept, cl.build_char_vocab(kept))
    return cl.token_stats(coded)
