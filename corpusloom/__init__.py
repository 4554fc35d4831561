"""Training examples from raw tables, as Spark jobs."""

from corpusloom.config import PrepConfig
from corpusloom.functions.layout import detect_layout, resolve_field
from corpusloom.functions.messages import render_conversation, render_roles
from corpusloom.functions.text import append_eos
from corpusloom.operators.batches import (
    accumulation_groups, assign_batches, default_pad_id, pad_batches, pad_report,
)
from corpusloom.operators.corpus import (
    concat_corpus, contiguous_split, corpus_length, corpus_offsets, split_segments,
)
from corpusloom.operators.counts import split_counts, token_stats
from corpusloom.operators.hooks import map_batches
from corpusloom.operators.order import check_keys, exact_k, global_rank, key_at, prefix_sum
from corpusloom.operators.permute import place_of_row, row_at_place, shuffled_part
from corpusloom.operators.rendering import (
    assemble_conversations, conversation_parts, drop_blank, keep_only, render,
    render_instruction, render_messages, render_text, render_trace, split_bad_lines, wrap_prompts,
)
from corpusloom.operators.scores import (
    back_off_levels, back_off_probability, eval_back_off, eval_loss, greedy_next, next_token_counts, repetition_penalty, sample_next,
    temperature_softmax, top_k, top_p,
)
from corpusloom.operators.sketches import (
    distinct_sketch, length_sketch, merge_distinct, merge_lengths, n_words, sketch_stats, word_rows,
)
from corpusloom.operators.splits import (
    ensure_train, holdout, holdout_threshold, normalize_validation, percent_slice, shuffle_epochs,
)
from corpusloom.operators.store import (
    IdStore, read_id_store, sample_id_windows, write_id_store,
)
from corpusloom.operators.subwords import (
    encode_merges, learn_merges, merge_vocab, split_by_merges,
)
from corpusloom.operators.tokens import (
    build_char_vocab, build_word_vocab, char_table, decode_chars, encode_chars, encode_join,
    encode_subwords, encode_words, split_words, tokenize_dataset, truncate, vocab_size, with_masks,
    word_counts,
)
from corpusloom.operators.windows import sample_windows, shifted_pairs
from corpusloom.plans.prepare import (
    choose_next, learn_words, prepare, prepare_batches, prepare_chars, prepare_stream,
    prepare_traces,
)
from corpusloom.session import drop_scratch, materialize, spread
from corpusloom.sources.files import read_files, with_row_id
from corpusloom.sources.shards import read_at, read_manifest, read_numbers, write_shards
from corpusloom.sources.tables import read_catalog, write_catalog, write_examples
from corpusloom.streaming.chats import (
    read_chat_stream, read_late_turns, with_sessions, write_chat_stream,
)
from corpusloom.streaming.holdouts import read_holdout_stream, write_holdout_stream
from corpusloom.streaming.sketches import read_sketch_stream, write_sketch_stream
from corpusloom.streaming.streams import (
    latest_counts, read_stream, streaming_counts, write_stream,
)
from corpusloom.streaming.vocabs import (
    read_heavy_hitters, read_vocab_ids, read_vocab_stream, write_vocab_stream,
)
