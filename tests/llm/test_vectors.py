"""Clustering and hard negatives against plain loops, with odd rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import clustering, hard_negatives
from millrace.llm.vectors import pack_planes, planes_of, weights

NAN, INF = float("nan"), float("inf")


def test_planes_hold_the_numbers():
    rng = np.random.default_rng(0)
    for largest in (1, 63, 64, 5000):
        v = rng.integers(-largest, largest + 1, (7, 19))
        v[0, 0], v[0, 1] = largest, -largest
        packed = pack_planes(v, planes_of(largest))
        bits = np.unpackbits(packed, axis=-1, bitorder="little")[:, :, :19].astype(np.int64)
        assert (np.einsum("p,npd->nd", weights(planes_of(largest)), bits) == v).all()


def test_popcounts_give_dot_products():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-300, 301, (50, 64)), rng.integers(-300, 301, (9, 64))
    p = planes_of(300)
    assert (clustering.dots(clustering.words(a, p), clustering.words(b, p)) == a @ b.T).all()
    assert (clustering.norms(clustering.words(a, p)) == (a * a).sum(axis=1)).all()
    of = rng.integers(0, 4, 50)
    n, sums = clustering.component_sums(clustering.words(a, p), of, 5)
    assert n.tolist() == [(of == c).sum() for c in range(5)]
    assert (sums == np.array([a[of == c].sum(axis=0) for c in range(5)])).all()


def test_subset_sums_give_inner_products():
    rng = np.random.default_rng(2)
    for d, largest in ((64, 256), (5, 3), (13, 70000)):
        a, b = rng.integers(-largest, largest + 1, (6, d)), rng.integers(-largest, largest + 1, (40, d))
        a[0], b[0] = -largest, -largest
        got = hard_negatives.scores(hard_negatives.subset_sums(a, np.int64), pack_planes(b, planes_of(largest)))
        assert (got == b @ a.T).all()


def plain_clusters(rows, k, rounds):
    ok = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
          if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    start = sorted(ok, key=lambda r: (r[0] is None, name(r[0]) if r[0] is not None else "", r[1]))[:k]
    x, c = np.array([v for _, v in ok]), np.array([v for _, v in start])
    for step in range(rounds + 1):
        far = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = far.argmin(axis=1)
        if step < rounds:
            c = np.array([x[own == j].sum(axis=0) // (own == j).sum() if (own == j).any() else c[j] for j in range(len(c))])
    d = far[np.arange(len(x)), own]
    digest = [hashlib.sha256(",".join(map(str, m.tolist())).encode()).hexdigest() for m in c]
    return [(i, int(j), int(s), int(d[own == j].sum()), int(d.sum()), digest[j]) for (i, _), j, s in zip(ok, own, d)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(64) / 8).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    rows += [(1000 + i, rows[5][1], i % 2) for i in range(200)]
    odd = [(2000, None, 1), (2001, [0.1] * 63, 1), (2002, [NAN] + [0.1] * 63, 1), (2003, [None] + [0.1] * 63, 1),
           (2004, [INF] + [0.1] * 63, 1), (2005, [], 0), (2006, [0.0] * 64, 2), (None, [0.3] * 64, 0), (2007, [0.2] * 64, None),
           rows[7], (300, rows[9][1], 0), (300, rows[10][1], 0)]
    return rows + odd


SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(5)


def test_clusters_are_those_of_plain_loops(spark, vectors):
    got = [tuple(r) for r in clustering.clusters(frame(spark, vectors)).collect()]
    assert sorted(got, key=repr) == sorted(plain_clusters([r[:2] for r in vectors], 16, 3), key=repr)


def test_few_vectors_are_as_many_clusters(spark, vectors):
    some = frame(spark, vectors[:3])
    got = clustering.clusters(some)
    assert sorted(map(tuple, got.collect())) == sorted(plain_clusters([r[:2] for r in vectors[:3]], 16, 3))
    assert {r.cluster for r in got.collect()} == {0, 1, 2} and got.first().inertia == 0
    empty = clustering.clusters(some.filter("false"))
    assert empty.count() == 0 and empty.columns == got.columns


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        clustering.clusters(frame(spark, [(1, [1e30] * 64, 0)])).collect()


def plain_negatives(rows, every):
    once = {}
    for i, v, label in rows:
        if i is None or label is None or not v or len(v) != 64 or not all(x is not None and np.isfinite(x) for x in v):
            continue
        own = (label, [int(np.floor(256 * float(x))) for x in v])
        once[i] = min(once.get(i, own), own)
    ids = sorted(once)
    x = np.array([once[i][1] for i in ids])
    found = []
    for a in (i for i in ids if i % every == 0):
        score = dict(zip(ids, (x @ np.array(once[a][1])).tolist()))
        order = sorted((i for i in ids if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if once[i][0] == once[a][0]][:5]:
            near = [i for i in order if once[i][0] != once[a][0] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            found += [(a, p, r, n, score[p], score[n]) for r, n in enumerate(near[:5], 1)]
    return found


def test_negatives_are_those_of_plain_loops(spark, vectors):
    want = plain_negatives(vectors, 20)
    got = hard_negatives.hard_negatives(frame(spark, vectors), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100


def test_blocks_of_anchors_make_no_difference(spark, vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 11)
    monkeypatch.setattr(hard_negatives, "TABLE_BYTES", 1 << 16)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_ROWS", 64)
    got = hard_negatives.hard_negatives(frame(spark, vectors), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(plain_negatives(vectors, 20))


def test_nothing_to_mine(spark, vectors):
    df = frame(spark, vectors)
    anchor = F.col("vec_id") % 20 == 0
    got = hard_negatives.hard_negatives(df, anchor)
    for less, which in ((df.filter("false"), anchor), (df, F.lit(None).cast("boolean")), (df.filter("vec_id = 2000"), anchor)):
        empty = hard_negatives.hard_negatives(less, which)
        assert empty.count() == 0 and empty.columns == got.columns
