"""The two preparation jobs put together, and the first one on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.config import PrepConfig
from corpusloom.functions.layout import CORRUPT
from corpusloom.operators.batches import (
    accumulation_groups, assign_batches, default_pad_id, pad_batches,
)
from corpusloom.operators.corpus import contiguous_split, corpus_offsets, split_segments
from corpusloom.operators.rendering import render, render_trace, split_bad_lines
from corpusloom.operators.scores import (
    greedy_next, repetition_penalty, sample_next, temperature_softmax, top_k, top_p,
)
from corpusloom.operators.splits import (
    VALIDATION, VALIDATION_NAMES, ensure_train, holdout, holdout_threshold, normalize_validation,
    percent_slice,
)
from corpusloom.operators.tokens import (
    LOOKUP_BYTES, LOOKUP_ROWS, build_char_vocab, build_word_vocab, char_table, fits_plan,
    tokenize_dataset,
)
from corpusloom.operators.windows import sample_windows
from corpusloom.session import materialize
from corpusloom.sources.files import read_files, with_row_id
from corpusloom.sources.tables import read_catalog


def load(spark: SparkSession, cfg: PrepConfig) -> DataFrame:
    """Read the source, number its rows if they have no key, and settle its splits.

    Files other than Parquet are parsed once and written as a table, since the splits need more than
    one look at the rows; lines that do not parse stay in it as ``_corrupt_record`` and are no
    examples. Only a catalog table has other names for its validation split to look for.
    """
    cfg.validate()
    if cfg.source == "files":
        df = read_files(spark, cfg.path, cfg.schema, cfg.clean, cfg.multiline)
        if cfg.key not in df.columns:
            df = with_row_id(df, out=cfg.key)
        elif CORRUPT in df.columns:
            df = materialize(df, "source")
        names = (VALIDATION,)
    else:
        df = read_catalog(spark, cfg.root, cfg.name, cfg.config, cfg.split)
        if cfg.key not in df.columns:
            df = with_row_id(df, out=cfg.key)
        df = normalize_validation(ensure_train(df, clean=cfg.clean), cfg.clean)
        names = VALIDATION_NAMES
    read, bad = split_bad_lines(df)
    if read.where(F.col(cfg.key).isNull()).head(1):
        raise ValueError(f"the key {cfg.key} is null in some rows")
    held = holdout(read, cfg.validation_percent, cfg.seed, cfg.key, names)
    return held if bad is None else held.unionByName(
        df.where(F.col(CORRUPT).isNotNull()), allowMissingColumns=True)


def render_with(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    return render(
        df, cfg.layout, cfg.text_field, cfg.prompt_field, cfg.response_field,
        cfg.conversation_field, cfg.style, cfg.eos, cfg.key, cfg.clean)


def learn_words(text: DataFrame, cfg: PrepConfig) -> DataFrame:
    """The word vocabulary of rendered text by the settings, as a written table."""
    specials = ("<pad>", cfg.eos, "<unk>") if cfg.eos else ("<pad>", "<unk>")
    return materialize(
        build_word_vocab(text, cfg.vocab_size, specials=specials, eos=cfg.eos), "vocab")


def prepare(spark: SparkSession, cfg: PrepConfig, vocab: DataFrame | None = None) -> DataFrame:
    """Source to examples: key, ``split, input_ids, attention_mask, labels``.

    Without a vocabulary, one of words is learned from the rendered text. Rendered text is written
    once then, as it is read for the vocabulary and for the examples.
    """
    text = render_with(load(spark, cfg), cfg)
    if vocab is None:
        text = materialize(text, "rendered")
        vocab = learn_words(text, cfg)
    return tokenize_dataset(text, vocab, cfg.max_len, key=cfg.key, eos=cfg.eos,
                            on_unknown=cfg.on_unknown, clean=cfg.clean)


def prepare_batches(examples: DataFrame, vocab: DataFrame, cfg: PrepConfig,
                    split: str = "train", side: str = "right") -> DataFrame:
    """Examples of a split (best a written table) to padded batches in the order of training:
    ``epoch, step, batch_id, slot``, key and the three example columns.

    Shuffled anew for each of ``cfg.epochs``, ``cfg.batch_size`` rows to a batch and ``cfg.accum``
    batches to a step. Padding is the end marker of the vocabulary, or a new id without one.
    """
    name = "ch" if "ch" in vocab.columns else "token"
    row = vocab.agg(F.count("*").alias("n"), F.max(F.when(
        F.col(name) == F.lit(cfg.eos), F.col("id"))).alias("eos")).first()
    batches = assign_batches(
        examples.where(F.col("split") == split), cfg.batch_size, cfg.epochs, cfg.seed, cfg.key)
    return accumulation_groups(
        pad_batches(batches, default_pad_id(row["n"], row["eos"]), side, cfg.clean), cfg.accum)


def prepare_chars(df: DataFrame, hi: float = 50, row_sep: str = "\n\n", fraction: float = 0.9,
                  n_batches: int = 50, batch_size: int = 32, block_size: int = 256,
                  seed: int = 1337, text: str = "text", key: str = "row_id"):
    """Rendered rows to a vocabulary, split segments and encoded windows.

    Returns ``(table, segments, windows)``. The index is written once: it is read by the split, the
    window totals and the look-up.
    """
    part = percent_slice(df, 0, hi, key)
    separators = row_sep if part.select(key).limit(2).count() > 1 else ""
    table = char_table(build_char_vocab(part, text, extra=separators))
    index = materialize(corpus_offsets(part, row_sep, text, key), "index")
    segments = split_segments(part, index, row_sep, fraction, text, key)
    windows = sample_windows(
        contiguous_split(index, fraction, key), part, n_batches, batch_size, block_size, seed,
        row_sep, table, text, key)
    return table, segments, windows


def prepare_traces(df: DataFrame, cfg: PrepConfig, hi: float = 50, batch_size: int = 32,
                   seed: int = 1337, **fields):
    """Rows of four trace fields to what :func:`prepare_chars` gives, ``cfg.eval_batches`` windows of
    ``cfg.block_size`` each; ``fields`` go to ``render_trace``. Rows are numbered if they have no
    key; the joined text is written once."""
    if cfg.key not in df.columns:
        df = with_row_id(df, out=cfg.key)
    text = materialize(render_trace(df, key=cfg.key, clean=cfg.clean, **fields), "traces")
    return prepare_chars(text, hi, n_batches=cfg.eval_batches, batch_size=batch_size,
                         block_size=cfg.block_size, seed=seed, key=cfg.key)


def prepare_stream(stream: DataFrame, cfg: PrepConfig, vocab: DataFrame) -> DataFrame:
    """A stream of raw rows to examples with a given vocabulary of characters or words.

    Lines that do not parse are left out (take them from the stream with ``split_bad_lines``). What
    happens to characters that the vocabulary lacks is ``cfg.on_unknown``. A word vocabulary must fit
    the plan, as rows of a stream cannot be put together again.
    """
    if "ch" not in vocab.columns and not fits_plan(vocab):
        raise ValueError(f"streams take word vocabularies of up to {LOOKUP_ROWS} tokens of "
                         f"up to {LOOKUP_BYTES} bytes")
    held = holdout_threshold(stream, cfg.validation_percent, cfg.seed, cfg.key)
    return tokenize_dataset(
        render_with(held, cfg), vocab, cfg.max_len, key=cfg.key, eos=cfg.eos,
        on_unknown=cfg.on_unknown, clean=cfg.clean)


def choose_next(scores: DataFrame, cfg: PrepConfig, seen: DataFrame | None = None) -> DataFrame:
    """A next token per prompt from a score table, by the sampling settings.

    Tokens already ``seen`` are made less likely, the best ``top_k`` and of these the likeliest up to
    ``top_p`` are kept, and one is drawn. Temperature 0 takes the best one as it is. The steps share
    one shuffle by prompt.
    """
    if cfg.temperature == 0:
        return greedy_next(scores)
    if seen is not None:
        scores = repetition_penalty(scores, seen, cfg.repetition_penalty)
    probs = temperature_softmax(top_k(scores, cfg.top_k), cfg.temperature)
    return sample_next(top_p(probs, cfg.top_p), cfg.seed)
