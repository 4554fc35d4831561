"""run() against plain loops over the rows, and the stages on odd tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import pieces, toxicity
from test_simhash import slow_fingerprint, slow_groups

WORDS = 256


def slow_mix(spark, rows, weights=(5, 2, 1)):
    """Copies of each row in the mix, from the schedule written out slot by slot."""
    hashes = {r.doc_id: r.h for r in spark.createDataFrame(
        [(i,) for i in {r[0] for r in rows}], "doc_id long").select(
        "doc_id", F.xxhash64(F.lit(42), "doc_id").alias("h")).collect()}
    sources = sorted({r[2] for r in rows})
    size = {i: len(t.split()) for i, t, _ in rows}
    total = {s: sum(size[i] for i, _, q in rows if q == s) for s in sources}
    target, free, budget = {}, list(sources), 1.5 * sum(total.values())
    weight = {s: weights[i % 3] for i, s in enumerate(sources)}
    while free:
        unit = budget / sum(weight[s] for s in free)
        above = [s for s in free if unit * weight[s] > 2 * total[s]]
        for s in above:
            target[s] = 2.0 * total[s]
            budget -= target[s]
        if not above:
            target.update({s: unit * weight[s] for s in free})
            break
        free = [s for s in free if s not in above]
    step = {s: max(1, min(WORDS, total[s] // 256)) for s in sources}
    blocks = {s: -(-total[s] // step[s]) for s in sources}
    slots = {s: target[s] / step[s] for s in sources}
    ends = np.cumsum([slots[s] for s in sources]) / sum(slots.values())
    taken, rank = Counter(), Counter()
    for n in range(round(sum(slots.values()))):
        x = (n % 2 ** 31) * 1_327_217_885 % 2 ** 31 / 2 ** 31
        s = sources[min(int(np.searchsorted(ends, x, "right")), len(sources) - 1)]
        if rank[s] < 2 * blocks[s]:
            taken[s, rank[s] % blocks[s]] += 1
        rank[s] += 1
    out = Counter()
    for s in sources:
        at = 0
        # the order of a hash as an unsigned number's leading bits, then as it is
        for i, t, _ in sorted((r for r in rows if r[2] == s),
                              key=lambda r: (hashes[r[0]] % 2 ** 64 >> 52, hashes[r[0]])):
            if size[i]:
                out[i] += taken[s, (at + size[i] // 2) // step[s]]
            at += size[i]
    return +out


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.materialize(stage(spark, docs, sf), name)
        if name != "sentencepiece":
            assert docs.columns == columns
        out.append(docs)
    return out


def test_stages_against_plain_loops(spark, sf, stages):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]

    model = toxicity.fit(docs, labels)
    rows = [r for r in rows
            if next(toxicity.score_lot(model, toxicity._Scores(model), [r[1]]))[0] < 0.5]
    assert sorted(r.doc_id for r in stages[0].collect()) == sorted(r[0] for r in rows)

    best = {}
    for r in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1])
        key = hashlib.sha256(low.encode()).digest()
        best[key] = max(best.get(key, r), r)
    rows = list(best.values())
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(r[0] for r in rows)

    fps = {r[0]: slow_fingerprint(r[1]) for r in rows}
    roots = slow_groups(sorted(set(fps.values())))
    least = defaultdict(lambda: 1 << 62)
    for i, f in fps.items():
        least[roots[f]] = min(least[roots[f]], i)
    rows = [r for r in rows if least[roots[fps[r[0]]]] == r[0]]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(r[0] for r in rows)

    copies = slow_mix(spark, rows)
    assert Counter(r.doc_id for r in stages[3].collect()) == copies

    lat = pieces.Lattices(pieces.load_pieces(corpus_pipeline.MODEL, 1.0))
    text = {r[0]: r[1] for r in rows}
    seeds = {r.doc_id: r.s for r in stages[3].select(
        "doc_id", F.xxhash64(F.lit(42), "doc_id").alias("s")).collect()}
    got = defaultdict(list)
    for r in stages[4].collect():
        assert r.round_trip
        got[r.doc_id].append((r.sample, tuple(r.pieces)))
    assert set(got) == set(copies)
    for i, found in got.items():
        alone = pieces.sample_lot(lat, [text[i]], np.array([seeds[i]]).view(np.uint64), 2)[0]
        want = [(k + 1, tuple(pieces.edge_ids(lat, e).tolist()))
                for k, (e, _, _) in enumerate(alone)]
        assert sorted(found) == sorted(want * copies[i])


def test_stages_on_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
            (2, "A a", None, None, 3), (3, "a A", "en", None, 3), (4, "w " * 60_000, "en", "s", 1),
            (None, "only", "en", "s", 4), (4, "other words here", "en", "t", 5)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn(
        "_uid", F.lit("x")).withColumn("_row", F.lit(1)).withColumn("kept", F.lit(None))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        if name == "sentencepiece":
            assert out.where("round_trip").count() == out.count()
            continue
        assert out.columns == docs.columns, name
        got = Counter((r.doc_id, r.text) for r in out.collect())
        if name == "toxicity":
            assert sum(got.values()) == len(rows)
        elif name == "exact_dedup":
            assert got == {(1, ""): 1, (3, "a A"): 1, (4, "w " * 60_000): 1, (None, "only"): 1,
                           (4, "other words here"): 1}
        elif name == "simhash_near_dedup":
            assert all(n == 1 for n in got.values()) and (1, "") in got and (2, "A a") in got
        else:
            assert max(got.values()) <= 2 and (1, "") not in got


def test_run_returns_the_last_stage(spark, sf, stages):
    got = corpus_pipeline.run(spark, sf)
    assert Counter((r.doc_id, r.sample, tuple(r.pieces)) for r in got.collect()) == Counter(
        (r.doc_id, r.sample, tuple(r.pieces)) for r in stages[-1].collect())
