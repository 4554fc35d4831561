import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import imatch


def slow_rows(rows, least, most):
    """Everything by plain loops over all rows."""
    rows = [(i, t or "") for i, t in rows]
    rows.sort(key=lambda r: r[1], reverse=True)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    counts = {}
    for _, t in rows:
        for w in set(re.findall(r"\w+", t.lower())):
            counts[w] = counts.get(w, 0) + 1
    n = len(rows)
    band = {w for w, c in counts.items() if max(2, n * least) <= c <= n * most}
    lex = imatch.Lexicon(np.array([imatch.term_hash(w) for w in band], np.uint64))
    out = []
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 2
        e = t[:len(t) - k] + nxt[:k]
        f, g, h = (imatch.fingerprints(lex, [x])[0] for x in (t, e, nxt))
        out.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), f, g,
                    round(imatch.likeness(f, g), 9), round(imatch.likeness(f, h), 9)))
    return sorted(out), band, lex


@pytest.mark.parametrize("buckets", [None, 3])
def test_against_loops(spark, sf, buckets):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(-5, None), (9002, ""), (9003, "…"), (9003, "…"), (9004, "zzzzq"), (None, "the and"),
         (9006, "the " * 50_000), (9007, "É" * 5)], "doc_id long, text string")
    rows = docs.union(odd).withColumn("fingerprint", F.lit(1)).withColumn("_bucket", F.lit(2))
    lexicon = imatch.build_lexicon(rows, most_share=0.5, least_share=0.01)
    want, band, lex = slow_rows([(r.doc_id, r.text) for r in rows.collect()], 0.01, 0.5)
    assert (lexicon.terms == lex.terms).all() and (lexicon.kept == lex.kept).all()
    got = imatch.compare_edited(rows, lexicon, buckets=buckets).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                   round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    plain = {(r.doc_id, r.n_chars, r.fingerprint)
             for r in imatch.fingerprint_documents(rows, lexicon).collect()}
    assert plain == {(r.doc_id, r.n_chars, r.fingerprint) for r in got}


def test_subsets_thin_out():
    rng = np.random.default_rng(1)
    lex = imatch.Lexicon(rng.integers(0, 1 << 63, 40_000).astype(np.uint64))
    for i in range(imatch.SUBSETS):
        share = (lex.kept >> np.uint64(i) & np.uint64(1)).mean()
        level = 0 if i == 0 else 1 + (i - 1) // imatch.PER_LEVEL
        assert abs(share - 0.5 ** level) < 4 * np.sqrt(0.5 ** level / 40_000) + 1e-9


def test_likeness_follows_shared_terms():
    terms = [f"t{i}" for i in range(5000)]
    lex = imatch.Lexicon(np.array([imatch.term_hash(t) for t in terms], np.uint64))
    rng = np.random.default_rng(2)
    means = []
    for share in (0.0, 0.3, 0.6, 0.9, 1.0):
        got = []
        for _ in range(60):
            a = rng.choice(5000, 200, replace=False)
            rest = np.setdiff1d(np.arange(5000), a)
            k = int(200 * share)
            b = np.append(a[:k], rng.choice(rest, 200 - k, replace=False))
            f, g = imatch.fingerprints(lex, [" ".join(terms[i] for i in x) for x in (a, b)])
            got.append(imatch.likeness(f, g))
        means.append(np.mean(got))
    assert means[0] < 0.03 and means[-1] == 1.0 and means == sorted(means) and means[2] > 0.2


def test_order_and_repeats_do_not_matter():
    lex = imatch.Lexicon(np.array([imatch.term_hash(t) for t in "abc"], np.uint64))
    f = imatch.fingerprints(lex, ["a b c", "C b, a! b x", "", "x", "y x", "!!", "??"])
    assert f[0].split("|")[0] == f[1].split("|")[0] and imatch.likeness(f[0], f[1]) == 1.0
    assert len(set(f[1:])) == 6
    assert imatch.likeness(f[3], f[4]) < 1.0 and imatch.likeness(f[2], f[2]) == 1.0
    assert imatch.likeness(f[5], f[6]) == imatch.likeness(f[2], f[3]) == 0.0


def test_texts_without_a_term_of_the_lexicon(spark):
    """A table too small for a band, and a source of a third of all rows with few words."""
    rng = np.random.default_rng(3)

    def words(names, n):
        return " ".join(rng.choice(names, n))

    small = [(i, words([f"w{i}x{k}" for k in range(60)], 80)) for i in range(12)]
    mixed = [(i, words([f"v{k}" for k in range(3000)], 120)) for i in range(400)]
    mixed += [(400 + i, words([f"hot{k}" for k in range(15)], 120)) for i in range(200)]
    for rows in (small, mixed):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = imatch.compare_edited(df, imatch.build_lexicon(df)).collect()
        lone = got if rows is small else [r for r in got if r.doc_id >= 400]
        assert np.mean([r.near_edited > 0 for r in lone]) > 0.95
        assert rows is not small or all(r.near_edited > r.near_next for r in lone)


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    lexicon = imatch.build_lexicon(df)
    got = imatch.compare_edited(df, lexicon).collect()
    assert len(got) == 1 and got[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert imatch.compare_edited(df.limit(0), imatch.build_lexicon(df.limit(0))).count() == 0
