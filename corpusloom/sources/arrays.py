"""Large JSON arrays as many tasks.

Spark's text source cuts a file at every ``}`` and hands out byte ranges, each from its first whole
piece on. Whether a piece begins within a string, and how deep, is the sum of what stood before it:
quotes count modulo two, brackets outside strings count up and down for either beginning. Ranges are
summed first (one row each), then every range finds the ends of its own records; only a record that
crosses from one range into the next is put together across them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusloom.functions.layout import CORRUPT

RANGE = ["_file", "_start"]


def _depth(outside: Column) -> Column:
    """Opened less closed brackets of a text without strings."""
    return F.octet_length(F.translate(outside, "]}", "")) - F.octet_length(
        F.translate(outside, "[{", ""))


def _without_strings(signs: Column) -> Column:
    return F.regexp_replace(signs, '"[^"]*("|$)', "")


def _signs(text: Column) -> Column:
    """The quotes and brackets of a text. Escaped backslashes go first, escaped quotes then."""
    bare = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    return F.regexp_replace(bare, r'[^"\[\]{}]++', "")


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Texts between closing braces, with quotes and change of depth (``_d0`` begun outside a string,
    ``_d1`` within one; the brace that ends the piece is in both)."""
    pieces = (
        spark.read.option("lineSep", "}").text(paths)
        .select("value", F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_start"),
                F.monotonically_increasing_id().alias("_place"),
                _signs(F.col("value")).alias("_signs"))
        .withColumn("_quotes", F.octet_length("_signs") - F.octet_length(
            F.translate("_signs", '"', "")))
    )
    odd = F.col("_quotes") % 2
    return pieces.withColumn(
        "_d0", _depth(_without_strings(F.col("_signs"))) - (1 - odd)
    ).withColumn(
        "_d1", _depth(_without_strings(F.concat(F.lit('"'), "_signs"))) - odd
    ).drop("_signs")


def _within_ranges(pieces: DataFrame) -> DataFrame:
    """Sums from the beginning of the range: quotes before the piece, depth after it."""
    order = Window.partitionBy(*RANGE).orderBy("_place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = pieces.withColumn("_before", F.coalesce(F.sum("_quotes").over(before), F.lit(0)))
    even = F.col("_before") % 2 == 0
    return (
        summed.withColumn("_e0", F.when(even, F.col("_d0")).otherwise(F.col("_d1")))
        .withColumn("_e1", F.when(even, F.col("_d1")).otherwise(F.col("_d0")))
        .withColumn("_r0", F.sum("_e0").over(upto)).withColumn("_r1", F.sum("_e1").over(upto))
    )


def _range_starts(pieces: DataFrame) -> DataFrame:
    """Per range: whether it begins within a string, and how deep; which is the last of its file."""
    totals = _within_ranges(pieces.drop("value")).groupBy(*RANGE).agg(
        F.sum("_quotes").alias("_quotes"), F.sum("_e0").alias("_t0"), F.sum("_e1").alias("_t1"))
    order = Window.partitionBy("_file").orderBy("_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        totals.withColumn("_inside", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2)
        .withColumn("_t", F.when(F.col("_inside") == 0, F.col("_t0")).otherwise(F.col("_t1")))
        .withColumn("_base", F.coalesce(F.sum("_t").over(before), F.lit(0)))
        .withColumn("_final", F.lead("_start").over(order).isNull())
        .select(*RANGE, "_inside", "_base", "_final")
    )


def _joined(parts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Texts of a record in their order, with where it begins."""
    return parts.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*order, "_text"))).alias("_parts"),
        F.max("_ends").alias("_ends"), F.max("_tail").alias("_tail"))


def array_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The elements of JSON arrays, one text (``value``) per row, in the order of files and elements.

    A file of any size is as many tasks as it has byte ranges; one record must fit a task. Elements
    that are no objects are rows too. Null elements, and files without an element, give no row. What
    follows a place where the file is damaged stays together as texts that do not parse.
    """
    pieces = _pieces(spark, paths)
    own = Window.partitionBy(*RANGE).orderBy("_place")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        _within_ranges(pieces).join(_range_starts(pieces), RANGE)
        .withColumn("_depth", F.col("_base") + F.when(
            F.col("_inside") == 0, F.col("_r0")).otherwise(F.col("_r1")))
        .withColumn("_tail", F.col("_final") & F.lead("_place").over(own).isNull())
        .withColumn("_ends", ~F.col("_tail") & (F.col("_depth") == 1) & (
            (F.col("_inside") + F.col("_before") + F.col("_quotes")) % 2 == 0))
        .withColumn("_record", F.coalesce(F.sum(F.col("_ends").cast("int")).over(before), F.lit(0)))
        .withColumn("_text", F.when(F.col("_tail"), F.col("value")).otherwise(
            F.concat("value", F.lit("}"))))
    )
    text = F.array_join(F.transform("_parts", lambda p: p["_text"]), "")
    # Grouped as the window is: the texts do not move again.
    records = _joined(placed, [*RANGE, "_record"], ["_place"]).withColumn("_text", text)
    edge = (F.col("_record") == 0) | ~F.col("_ends")
    # At most two per range: the end of what began before it, and what goes on after it.
    chain = Window.partitionBy("_file").orderBy("_start", "_record")
    edges = records.where(edge).withColumn("_chain", F.coalesce(F.sum(F.col("_ends").cast(
        "int")).over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    crossing = _joined(edges, ["_file", "_chain"], ["_start", "_record"]).select(
        "_file", F.col("_parts")[0]["_start"].alias("_start"),
        F.col("_parts")[0]["_record"].alias("_record"), text.alias("_text"), "_tail")
    found = records.where(~edge).select(*crossing.columns).unionByName(crossing)

    first = (F.col("_start") == 0) & (F.col("_record") == 0)
    body = F.when(first, F.regexp_replace("_text", r"^[\x{FEFF}\s]*\[\s*", "")).otherwise(
        F.regexp_replace("_text", r"^\s*,\s*", ""))
    body = F.when(F.col("_tail"), F.regexp_replace(body, r"\s*\]\s*$", "")).otherwise(body)
    plain = F.col("_body").startswith("{") & ~F.col("_tail")
    several = F.from_json(F.concat(F.lit("["), "_body", F.lit("]")), "array<string>")
    return (
        found.withColumn("_body", body).where("trim(_body) != ''")
        .withColumn("_all", F.when(plain, F.array("_body")).otherwise(
            F.coalesce(several, F.array("_body"))))
        .select(*RANGE, "_record", F.posexplode("_all").alias("_at", "value"))
        .where(F.col("value").isNotNull())
        .orderBy(*RANGE, "_record", "_at").select("value")
    )


def infer_records(records: DataFrame):
    """The schema of JSON texts, as the reader of lines finds it."""
    spark = records.sparkSession
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT)
    return DataFrame(reader._jreader.json(texts), spark).schema


def parse_records(records: DataFrame, schema) -> DataFrame:
    """JSON texts as columns; a text that is no object, or does not parse, is in the corrupt column."""
    row = F.from_json("value", schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    is_object = F.col("value").startswith("{")
    columns = [F.when(is_object, F.col("_row")[name]).otherwise(
        F.col("value") if name == CORRUPT else F.lit(None)).alias(name) for name in schema.names]
    return records.select("value", row.alias("_row")).select(*columns)
