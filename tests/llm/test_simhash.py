import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import simhash
from corpusloom.llm.graph import components, spanning


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fps):
    roots = {f: f for f in fps}

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x
    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= 3:
                x, y = find(a), find(b)
                roots[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_every_pair_within_three_bits_shares_a_key():
    rng = np.random.default_rng(1)
    tables = simhash.code_tables()
    x = rng.integers(0, 1 << 63, 3000, dtype=np.int64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, i % 4, replace=False):
            y[i] ^= np.int64(np.uint64(1 << int(b)).view(np.int64))
    row, key, _ = simhash.near_keys(x, tables)
    near = set(zip(row.tolist(), key.tolist()))
    own = np.stack(simhash.own_keys(y, tables), 1)
    assert all(any((i, int(k)) in near for k in ks) for i, ks in enumerate(own))


def test_code_is_perfect():
    low, high, errors = simhash.code_tables()
    assert len(set(errors.tolist())) == 2048
    assert max(bin(e).count("1") for e in errors.tolist()) == 3


def test_spanning_keeps_groups():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, (2, 200)).astype(np.uint64)
    x, y = spanning(a, b)
    assert len(x) < len(np.unique(np.concatenate([a, b])))
    import itertools

    def groups(p, q):
        root = {}

        def find(n):
            while root.setdefault(n, n) != n:
                n = root[n]
            return n
        for i, j in zip(p.tolist(), q.tolist()):
            i, j = find(i), find(j)
            root[max(i, j)] = min(i, j)
        return {n: find(n) for n in list(itertools.chain(p.tolist(), q.tolist()))}
    full, thin = groups(a, b), groups(x, y)
    assert all(thin.get(n, n) == r for n, r in full.items())


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    got = {r.node: r.root for r in components(
        spark.createDataFrame(path + star, "u long, v long")).collect()}
    assert all(got.get(n, n) == 0 for n in range(41))
    assert all(got.get(n, n) == 100 for n in range(100, 160))


@pytest.mark.parametrize("piece", [4096, 2])
def test_links_join_what_brute_force_joins(spark, piece):
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(12):
        hub = int(rng.integers(0, 1 << 63))
        fps.add(hub)
        for _ in range(25):
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                hub ^= 1 << int(b)
            fps.add(hub)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(f,) for f in fps], "_fp long")
    links = simhash.fingerprint_links(df, piece=piece)
    assert links.count() > 0
    got = {r.node: r.root for r in components(links).collect()}
    want = slow_groups([f % (1 << 64) for f in fps])
    for a in fps:
        for b in fps:
            assert (got.get(a, a) == got.get(b, b)) == (want[a % (1 << 64)] == want[b % (1 << 64)])


def test_groups_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(9001, None), (9002, ""), (9003, " \t"), (9004, "One"), (9004, "one"), (None, "ONE two"),
         (9006, "x " * 30000)], "doc_id long, text string")
    rows = docs.union(odd).withColumn("_fp", F.lit("clash"))
    got = simhash.simhash_groups(rows).collect()
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    fps = {t: slow_fingerprint(t) for _, t in texts}
    root = slow_groups(sorted(set(fps.values())))
    least = {}
    for i, t in texts:
        r = root[fps[t]]
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f"{fps[t]:016x}", str(least.get(root[fps[t]]))) for i, t in texts)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.drop_near_copies(rows)
    assert kept.columns == rows.columns
    assert kept.count() == len(set(root[f] for f in fps.values()))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.drop_near_copies(empty).count() == 0
