"""Next-token tables: counts, loss, and filters over ranked candidates.

A score table is long: ``prompt_id, token, logit``. The candidates of a prompt are at most the
vocabulary, so windows per prompt have a bounded size however much text was counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.operators.order import hash_key, hash_number
from corpusloom.operators.tokens import characters
from corpusloom.session import materialize


# Characters of a text whose pairs are listed at once.
PIECE = 4096


def _best_first(score: str):
    return Window.partitionBy("prompt_id").orderBy(F.desc(score), "token")


# --- counting and loss ---------------------------------------------------------------------------

def next_token_counts(df: DataFrame, row_sep: str = "\n\n", first_key=None, text: str = "text",
                      key: str = "row_id", order: int = 1) -> DataFrame:
    """How often a character follows ``order`` others in the joined corpus: ``token, next, n``.

    ``df`` holds segments (text with its separator; null is empty). A segment is preceded by the end
    of the separator, repeated to ``order`` characters, except the first one (``first_key``, looked
    up if not given), so a context does not reach into another text. Every run of neighbours is taken
    by a look-ahead, so rows need nothing from each other; a text is cut into pieces that overlap by
    ``order`` characters, so none becomes one array of all its runs.
    """
    if not row_sep:
        raise ValueError("rows need a separator to be counted apart")
    if order < 1:
        raise ValueError("order must be above 0")
    if first_key is None:
        first_key = df.agg(F.min(key)).first()[0]
    known = F.coalesce(F.col(text), F.lit(""))
    before = (row_sep * order)[-order:]
    run = F.when(F.col(key) == F.lit(first_key), known).otherwise(F.concat(F.lit(before), known))
    # Looks at a piece and the characters behind it, moves on by the piece.
    pieces = F.regexp_extract_all(
        run, F.lit(f"(?s)(?=(.{{1,{PIECE + order}}})).{{1,{PIECE}}}"), F.lit(1))
    # Looks at a context and the character behind it, moves on by one.
    runs = F.regexp_extract_all("_piece", F.lit(f"(?s)(?=(.{{{order + 1}}}))."), F.lit(1))
    counted = df.select(F.explode(pieces).alias("_piece")).select(
        F.explode(runs).alias("_run")).groupBy("_run").agg(F.count("*").alias("n"))
    return counted.select(
        F.left("_run", F.lit(order)).alias("token"), F.right("_run", F.lit(1)).alias("next"), "n")


# --- back-off ------------------------------------------------------------------------------------

def back_off_levels(counts: DataFrame, order: int) -> list[DataFrame]:
    """Tables for contexts of 0 to ``order`` characters: ``ctx, next, c, total, kinds``.

    The longest contexts have the counts themselves. For a shorter one ``c`` is the continuation
    count: how many different characters stand before context and next character. ``total`` and
    ``kinds`` sum ``c`` and count the next characters of a context. Every level is made from the one
    above, which is not larger than the text and combined before the shuffle.
    """
    levels = []
    runs = counts.select(F.concat("token", "next").alias("_run"), F.col("n").alias("c"))
    for size in range(order, -1, -1):
        level = runs.select(F.left("_run", F.lit(size)).alias("ctx"),
                            F.right("_run", F.lit(1)).alias("next"), "c")
        sums = level.groupBy("ctx").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        levels.insert(0, materialize(level.join(sums, "ctx"), f"level-{size}"))
        if size:
            runs = levels[0].select(F.substring(F.concat("ctx", "next"), 2, order + 1).alias(
                "_run")).groupBy("_run").agg(F.count("*").alias("c"))
    return levels


def back_off_probability(pairs: DataFrame, levels: list[DataFrame], vocab_size: int,
                         discount: float = 0.75) -> DataFrame:
    """Adds ``p`` to different ``ctx, next`` (contexts of up to the order of the levels).

    From the empty context to the whole one, each level takes ``discount`` off the counts it knows and
    gives what that frees to the level below; below the empty one all characters are equally likely.
    A context that a level does not know leaves the probability as it is. A level is two joins.
    """
    if not 0 < discount < 1:
        raise ValueError("the discount must lie between 0 and 1")
    off = F.lit(float(discount))
    out = pairs.withColumn("p", F.lit(1.0 / vocab_size))
    for size, level in enumerate(levels):
        heard = level.select(F.col("ctx").alias("_h"), F.col("next").alias("_next"), "c")
        sums = level.select(F.col("ctx").alias("_h"), "total", "kinds").distinct()
        # A context that is too short takes no part: it is asked by a text that no level has.
        own = F.when(F.length("ctx") >= size, F.right("ctx", F.lit(size))).otherwise(
            F.concat(F.col("ctx"), F.lit("\0" * len(levels))))
        out = (
            out.withColumn("_own", own)
            .join(heard, (F.col("_own") == F.col("_h")) & (F.col("next") == F.col("_next")), "left")
            .drop("_h", "_next").join(sums, F.col("_own") == F.col("_h"), "left")
            .withColumn("p", F.when(F.col("total").isNull(), F.col("p")).otherwise(
                (F.greatest(F.coalesce("c", F.lit(0)) - off, F.lit(0.0))
                 + off * F.col("kinds") * F.col("p")) / F.col("total")))
            .select(*pairs.columns, "p"))
    return out


def eval_back_off(counts: DataFrame, windows: DataFrame, order: int, vocab_size: int | None = None,
                  discount: float = 0.75) -> DataFrame:
    """Mean over batches of the mean cross-entropy of a batch, by contexts of up to ``order``
    characters with interpolated back-off: ``split, n_batches, loss``.

    ``counts`` are those of :func:`next_token_counts` of the same order; ``x`` and ``y`` of the
    windows are text. At the beginning of a window the context is what there is of it. Contexts are
    counted per batch and each different one is looked up once.
    """
    if windows.schema["x"].dataType.typeName() != "string":
        raise ValueError("contexts need windows of text")
    levels = back_off_levels(counts, order)
    if vocab_size is None:
        vocab_size = max(1, levels[0].count())
    at = F.sequence(F.lit(1), F.length("y"))
    taken = F.transform(at, lambda i: F.struct(
        F.substring("x", F.greatest(F.lit(1), i - order + 1), F.least(i, F.lit(order))).alias("ctx"),
        F.substring("y", i, F.lit(1)).alias("next")))
    seen = materialize(
        windows.where(F.length("y") > 0).select("split", "batch_id", F.inline(taken))
        .groupBy("split", "batch_id", "ctx", "next").agg(F.count("*").alias("_seen")), "seen")
    known = back_off_probability(seen.select("ctx", "next").distinct(), levels, vocab_size, discount)
    loss = F.sum(F.col("_seen") * -F.log("p")) / F.sum("_seen")
    per_batch = seen.join(known, ["ctx", "next"]).groupBy("split", "batch_id").agg(
        loss.alias("_loss"))
    return per_batch.groupBy("split").agg(
        F.count("*").alias("n_batches"), F.avg("_loss").alias("loss"))


def eval_loss(counts: DataFrame, windows: DataFrame, smoothing: float = 1.0,
              vocab_size: int | None = None) -> DataFrame:
    """Mean over batches of the mean cross-entropy of a batch: ``split, n_batches, loss``.

    Probabilities are smoothed next-token counts. ``x`` and ``y`` of the windows may be text or
    arrays. Pairs are counted per batch before they meet the table. The counts are written once:
    they are at most the square of the vocabulary, and their text is read a single time.
    """
    counts = materialize(counts, "next-counts")
    if vocab_size is None:
        vocab_size = counts.select("token").union(counts.select("next")).distinct().count()
    as_text = windows.schema["x"].dataType.typeName() == "string"
    x, y = (characters(F.col(c)) if as_text else F.col(c) for c in ("x", "y"))
    # In a split that is shorter than a window there is one target less than inputs.
    pairs = F.slice(F.arrays_zip(x, y), 1, F.size(y))
    seen = (
        windows.select("split", "batch_id", F.inline(pairs).alias("token", "next"))
        .groupBy("split", "batch_id", "token", "next").agg(F.count("*").alias("_seen"))
    )
    context = counts.groupBy("token").agg(F.sum("n").alias("_context"))
    p = (F.coalesce("n", F.lit(0)) + F.lit(float(smoothing))) / (
        F.coalesce("_context", F.lit(0)) + F.lit(float(smoothing) * vocab_size))
    loss = F.sum(F.col("_seen") * -F.log(p)) / F.sum("_seen")
    per_batch = (
        seen.join(counts, ["token", "next"], "left").join(context, "token", "left")
        .groupBy("split", "batch_id").agg(loss.alias("_loss"))
    )
    return per_batch.groupBy("split").agg(
        F.count("*").alias("n_batches"), F.avg("_loss").alias("loss"))


# --- candidates ----------------------------------------------------------------------------------

def temperature_softmax(scores: DataFrame, t: float = 0.7) -> DataFrame:
    """Adds ``prob``, the softmax of ``logit / t`` per prompt."""
    if t <= 0:
        raise ValueError("temperature must be above 0; use greedy_next for 0")
    per_prompt = Window.partitionBy("prompt_id")
    scaled = F.col("logit") / F.lit(float(t))
    return (
        scores.withColumn("_scaled", scaled)
        .withColumn("_e", F.exp(F.col("_scaled") - F.max("_scaled").over(per_prompt)))
        .withColumn("prob", F.col("_e") / F.sum("_e").over(per_prompt))
        .drop("_scaled", "_e")
    )


def top_k(scores: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best candidates per prompt (all, where there are fewer)."""
    return scores.withColumn("_rank", F.row_number().over(_best_first("logit"))).where(
        F.col("_rank") <= k).drop("_rank")


def top_p(probs: DataFrame, p: float = 0.9) -> DataFrame:
    """The fewest best candidates whose probability reaches ``p``; at least the best one."""
    order = _best_first("prob")
    before = F.coalesce(
        F.sum("prob").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return (
        probs.withColumn("_before", before).withColumn("_rank", F.row_number().over(order))
        .where((F.col("_before") < p) | (F.col("_rank") == 1)).drop("_before", "_rank")
    )


def repetition_penalty(scores: DataFrame, seen: DataFrame, r: float = 1.1) -> DataFrame:
    """Logits of tokens already ``seen`` (``prompt_id, token``): divided by ``r``, or multiplied
    where they are negative."""
    if r <= 0:
        raise ValueError("the penalty must be above 0")
    marks = seen.select("prompt_id", "token").distinct().withColumn("_seen", F.lit(True))
    logit = F.col("logit")
    lowered = F.when(logit > 0, logit / F.lit(float(r))).otherwise(logit * F.lit(float(r)))
    return (
        scores.join(marks, ["prompt_id", "token"], "left")
        .withColumn("logit", F.when(F.col("_seen"), lowered).otherwise(logit))
        .drop("_seen")
    )


def sample_next(probs: DataFrame, seed: int = 1337) -> DataFrame:
    """One seeded draw per prompt by probability: ``prompt_id, token``."""
    order = _best_first("prob")
    total = F.sum("prob").over(Window.partitionBy("prompt_id"))
    upto = F.sum("prob").over(order.rowsBetween(Window.unboundedPreceding, 0))
    u = hash_number(hash_key(seed, "prompt_id"), 13) / F.lit(float(16 ** 13))
    ranked = probs.select(
        "prompt_id", "token", upto.alias("_upto"), F.row_number().over(order).alias("_rank"),
        (u * total).alias("_u"))
    # Rounding may leave the last sum below the total; the last candidate then stands in.
    hit = F.min_by("token", F.when(F.col("_upto") > F.col("_u"), F.col("_rank")))
    return ranked.groupBy("prompt_id").agg(
        F.coalesce(hit, F.max_by("token", "_rank")).alias("token"))


def greedy_next(scores: DataFrame) -> DataFrame:
    """The best candidate per prompt, the smaller token where two are equal."""
    return scores.groupBy("prompt_id").agg(
        F.min_by("token", F.struct(-F.col("logit"), F.col("token"))).alias("token"))
