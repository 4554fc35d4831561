"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from corpusloom.llm.exact import exact_dedup
from corpusloom.llm.html import extract_text
from corpusloom.llm.imatch import build_lexicon, compare_edited
from corpusloom.llm.licenses import KNOWN, SPELLINGS, license_scan
from corpusloom.llm.mixing import mix
from corpusloom.llm.negatives import hard_negatives
from corpusloom.llm.pieces import sample_pieces
from corpusloom.llm.repeats import remove_repeats
from corpusloom.llm.sharding import shard_rows
from corpusloom.llm.simhash import simhash_groups
from corpusloom.llm.toxicity import fit, held_out, score_toxicity
from corpusloom.llm.turns import repair_conversations
from corpusloom.llm.warc import archive_round_trip


#: Public model file that the encoding queries use; every executor has it.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_sampled_pieces(spark, sf_dir):
    rows = sample_pieces(table(spark, sf_dir, "documents"), MODEL)
    return rows.select("doc_id", "sample", F.size("pieces").alias("n_pieces"),
                       F.xxhash64("pieces").alias("pieces_hash"), "log_prob", "log_inclusion",
                       "round_trip")


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("held_out", held_out("doc_id"))


def op4_simhash_groups(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


def op6_imatch_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return compare_edited(docs, build_lexicon(docs))


def op7_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def op8_repeated_passages(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"), texts=True)
    # A removed run may begin or end within a character; what is left of it is U+FFFD here.
    return found.withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op9_warc_round_trip(spark, sf_dir):
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op10_html_main_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


def op11_repair_conversations(spark, sf_dir):
    return repair_conversations(table(spark, sf_dir, "conversations"), damaged=True)


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives(table(spark, sf_dir, "embeddings"), relabel=7)


def op13_best_fit_shards(spark, sf_dir):
    return shard_rows(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


def queries():
    found = {n: f for n, f in globals().items() if n.startswith("op") and callable(f)}
    return {"pipeline": pipeline} | found


# --- SQL twins -----------------------------------------------------------------------------------

LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_lines(expr: str) -> str:
    out = (rf"regexp_replace(lower({expr}), '(?m)^[^\p{{L}}\p{{N}}\n©(]*(?:copyright[ \t]*(?:\(c\)|©|"
           r"[0-9])|\(c\)[ \t]*(?:copyright|[0-9])|©|all rights reserved)[^\n]*$', '', 'g')")
    out = rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for said, meant in SPELLINGS:
        out = f"replace({out}, '{said}', '{meant}')"
    return out


def _canonical(expr: str) -> str:
    return rf"trim(regexp_replace({expr}, '[ \n]+', ' ', 'g'))"


def oracle_sql() -> dict[str, str]:
    known = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN)
    return {
        "op1_exact_dedup": f"""with d as (select doc_id, sha256({LOWER}) as h from documents),
            g as (select h, max(doc_id) as keep_id, count(*) as group_size from d group by h)
            select doc_id, keep_id, group_size, doc_id = keep_id as kept, h as text_sha256
            from d join g using (h)""",
        "op7_license_scan": f"""with k as (select sha256({_canonical(_canonical_lines('t'))}) as h,
              min(n) as license from (values {known}) v(n, t) group by 1),
            d as (select doc_id, {_canonical_lines("coalesce(text, '')")} as c from documents),
            w as (select doc_id, sha256({_canonical('c')}) as digest from d),
            l as (select distinct doc_id, sha256(trim(x)) as h from
              (select doc_id, unnest(string_split(c, chr(10))) as x from d) where trim(x) <> ''),
            f as (select doc_id, count(*) as n_notices, string_agg(distinct license, ','
              order by license) as licenses from l join k using (h) group by doc_id)
            select w.doc_id, w.digest, k.license as whole_license,
              coalesce(n_notices, 0)::bigint as n_notices, coalesce(licenses, '') as licenses
            from w left join k on k.h = w.digest left join f on f.doc_id = w.doc_id""",
        "op9_warc_round_trip": """with p as (select page_id, coalesce(html, '') as t from pages),
            d as (select page_id, octet_length(encode(t)) as n, sha256(t) as h from p),
            f as (select h, min(page_id) as first from d where n >= 100 group by h)
            select page_id, n::bigint as payload_bytes, h as payload_digest,
              case when first <> page_id then 'revisit' else 'response' end as record_type,
              case when first <> page_id then first end as refers_to
            from d left join f using (h)""",
        "op12_hard_negatives": """with v as (select vec_id,
              case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
              list_transform(embedding, lambda x: floor(256 * x::double)) as e
            from embeddings where label is not null and embedding is not null and not coalesce(
              list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x))), false)),
            s as (select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
              list_inner_product(a.e, r.e)::bigint as score
              from v a join v r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
            p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
            select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id
              order by score desc, vec_id))::int as rank, vec_id as negative_id, positive_score,
              score as negative_score
            from p join s using (anchor_id) where not same
              and 100 * score between 30 * positive_score and 90 * positive_score
            qualify rank <= 10""",
    }
