import os
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no model file")


@pytest.fixture(scope="module")
def model():
    return pieces.load_pieces(MODEL, 1.0)


def brute(model, text):
    """All segmentations of a short text with their chances, by recursion over the whole text."""
    names = {}
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            names[sp.id_to_piece(i)] = i
    marked = "▁" + text.replace(" ", "▁")

    def paths(at):
        if at == len(marked):
            yield (), 0.0
            return
        for to in range(at + 1, len(marked) + 1):
            if marked[at:to] in names:
                head, w = (names[marked[at:to]],), model.weight[names[marked[at:to]]]
            elif to == at + 1:
                head = tuple(int(model.byte_ids[b]) for b in marked[at].encode())
                w = len(head) * model.weight[model.byte_ids[0]]
            else:
                continue
            for rest, v in paths(to):
                yield head + rest, w + v
    found = list(paths(0))
    total = np.logaddexp.reduce([w for _, w in found])
    return {p: w - total for p, w in found}


def run(model, text, n, k):
    lat = pieces.Lattices(model)
    seeds = pieces._key(np.arange(n).astype(np.uint64), 99)
    return [[(tuple(pieces.edge_ids(lat, e).tolist()), lp, li) for e, lp, li in found]
            for found in pieces.sample_lot(lat, [text] * n, seeds, k)]


@pytest.mark.parametrize("text", ["a", "hi the", "of\nit", " x  y", "é日☃", "aaa "])
def test_all_segmentations_of_short_texts(model, text):
    want = brute(model, text)
    got = run(model, text, 3, len(want) + 2)
    for found in got:
        assert len(found) == len(want) == len({p for p, _, _ in found})
        for p, lp, li in found:
            assert lp == pytest.approx(want[p], abs=1e-9) and li == 0.0
            assert pieces.decode_ids(model, p) == text


def test_draws_follow_the_law_without_replacement(model):
    want = brute(model, "the ore")
    n = 6000
    got = run(model, "the ore", n, 2)
    first = Counter(f[0][0] for f in got)
    second = Counter(f[1][0] for f in got)
    for p, lp in want.items():
        chance = np.exp(lp)
        assert abs(first[p] / n - chance) < 4 * np.sqrt(chance / n) + 1e-3
        then = sum(np.exp(q) * chance / (1 - np.exp(q)) for o, q in want.items() if o != p)
        assert abs(second[p] / n - then) < 4 * np.sqrt(then / n) + 1e-3
    assert all(f[0][0] != f[1][0] for f in got)


def test_inclusion_scores_make_sums_unbiased(model):
    want = brute(model, "the ore")
    got = run(model, "the ore", 6000, 3)
    for value in (len, lambda p: float(p[0] % 7)):
        exact = sum(np.exp(lp) * value(p) for p, lp in want.items())
        guess = np.mean([sum(np.exp(lp - li) * value(p) for p, lp, li in f) for f in got])
        assert guess == pytest.approx(exact, rel=0.05)


def test_lots_do_not_matter(model):
    texts = ["one two three", "", "x" * 3000, "Straße\n\n§", "one two three"]
    seeds = np.array([5, 6, 7, 8, 5], np.uint64)
    lat = pieces.Lattices(model)
    whole = pieces.sample_lot(lat, texts, seeds, 3)
    for i, text in enumerate(texts):
        alone = pieces.Lattices(model)
        single = pieces.sample_lot(alone, [text], seeds[i:i + 1], 3)[0]
        assert [(pieces.edge_ids(alone, e).tolist(), round(a, 9), round(b, 6)) for e, a, b in single] \
            == [(pieces.edge_ids(lat, e).tolist(), round(a, 9), round(b, 6)) for e, a, b in whole[i]]


def test_table(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).select("doc_id", "text")
    odd = spark.createDataFrame(
        [(9001, None), (9002, ""), (None, "same id"), (9004, "w " * 40_000), (9005, " "),
         (9005, " "), (9006, "mark ▁ here")], "doc_id long, text string")
    rows = docs.union(odd).selectExpr("*", "1 as sample", "2 as pieces")
    out = pieces.sample_pieces(rows, MODEL, k=2)
    got = out.collect()
    text = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in got:
        assert r.round_trip == ("▁" not in text[r.doc_id])
        assert r.log_prob <= 1e-9 and r.log_inclusion <= 0
    kinds = Counter((r.doc_id, tuple(r.pieces)) for r in got)
    assert all(n == 1 for (i, _), n in kinds.items() if i != 9005)
    assert sum(1 for r in got if r.doc_id == 9002) == 1
    assert {r.doc_id for r in got} == set(text)
    assert {(r.doc_id, r.sample, tuple(r.pieces)) for r in out.collect()} == {
        (r.doc_id, r.sample, tuple(r.pieces)) for r in got}
    back = pieces.decode_pieces(out, MODEL, out="back").where("round_trip").collect()
    assert all(r.back == text[r.doc_id] for r in back)
    assert pieces.sample_pieces(rows.limit(0), MODEL).count() == 0
