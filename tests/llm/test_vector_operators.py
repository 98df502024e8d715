"""Brute-force versions of the operators on vectors."""

import math
from collections import defaultdict

import numpy as np
import pytest

from postlytics.llm import embedding_dedup, topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, norm string, v int, n string, cell int"


def odd_vectors():
    rng = np.random.default_rng(7)
    rows = []
    for i in range(160):
        centre = np.random.default_rng(i % 9).normal(size=8)
        rows.append((i, (centre + rng.normal(size=8) * (0.05 if i % 2 else 0.6)).tolist(), i % 3))
    rows += [(200, None, 1), (250, [1.0, None] + [0.0] * 6, 1), (300, [float("nan")] + [0.0] * 7, 1), (350, [float("inf")] + [1.0] * 7, 0),
             (400, [0.0] * 8, 1), (401, [], 1), (450, [0.5, 0.25], 1), (451, [0.5, 0.26], 1), (452, [-3.0, 2.0], 1),
             (500, rows[7][1], 1), (501, rows[7][1], 1), (502, rows[7][1], None), (503, [2 * x for x in rows[7][1]], 1), (None, rows[7][1], 1),
             (504, rows[7][1], 2), (504, rows[7][1], 2), (600, [1e-30] * 8, 2), (601, [2e-30] * 8, 2), (700, [-0.0] + [1.0] * 7, 2), (701, [0.0] + [1.0] * 7, 2)]
    return [(i, e, y, "x", 1, "y", 2) for i, e, y in rows]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(odd_vectors(), SCHEMA).repartition(4)


def single(e):
    return None if e is None else [None if x is None else float(np.float32(x)) for x in e]


def fine(e):
    return bool(e) and all(x is not None and math.isfinite(x) for x in e)


def test_top_k_equals_brute_force(spark, vectors):
    rows = [(i, np.floor(256 * np.array(single(e)))) for i, e, *_ in odd_vectors() if i is not None and fine(e)]
    expect = []
    for q in {i for i, _ in rows if i % 50 == 0}:
        v = next(v for i, v in rows if i == q)
        scored = sorted((-int(v @ c), i) for i, c in rows if i != q and len(c) == len(v))[:5]
        expect += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    for options in ({}, {"bucket_rows": 16, "query_rows": 1, "seed_rows": 6}):
        got = [tuple(r) for r in topk.top_k(vectors, **options).select("query_id", "rank", "vec_id", "score").collect()]
        assert sorted(got) == sorted(expect)
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_top_k_of_large_vectors_is_exact(spark):
    """Components of up to 1e30 beside small ones: products beyond 2^53 are exact, beyond 64 bits held at its ends."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=2).tolist()) for i in range(101)]
    rows += [(150, [1e10, -3.0]), (200, [7e7, 9e7]), (201, [7e7, 9.1e7]), (202, [-7e7, 9e7]), (250, [1e30, 1.0]), (251, [1e30, -1.0]),
             (300, [2.5e12, 1.0]), (301, [2.5e12, 2.0])]
    df = spark.createDataFrame([(i, e, 1, "x", 1, "y", 2) for i, e in rows], SCHEMA).repartition(3)
    whole = {i: [int(math.floor(256 * x)) for x in single(e)] for i, e in rows}
    expect, most = [], 2 ** 63 - 1
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-max(-most, min(most, sum(a * b for a, b in zip(whole[q], whole[i])))), i) for i in whole if i != q)[:5]
        expect += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    for options in ({}, {"bucket_rows": 16, "query_rows": 1, "seed_rows": 6}):
        got = [tuple(r) for r in topk.top_k(df, **options).select("query_id", "rank", "vec_id", "score").collect()]
        assert sorted(got) == sorted(expect)


def test_pruning_by_length_and_by_coordinates_is_exact():
    rng = np.random.default_rng(4)
    c = np.floor(rng.normal(size=(600, 16)) * 200 * rng.gamma(1, size=(600, 1)))
    norm = np.sqrt((c * c).sum(1))
    order = np.argsort(-norm)
    c, norm, ids = c[order], norm[order], np.arange(600)
    q = np.floor(rng.normal(size=(40, 16)) * 100)
    q_norm = np.sqrt((q * q).sum(1))
    products = q @ c.T
    theta = np.partition(products, 595, axis=1)[:, 595]
    for high in (0.0, 0.5, 2.0):  # all by coordinates, mixed, all by length
        found = {int(row): sorted(zip(-scores, pick)) for row, pick, scores in topk.search_block(
            np.full(40, -1), q, q_norm, theta, ids, c, norm, 5, high=high)}
        for row in range(40):
            assert found[row] == sorted(zip(-products[row], ids))[:5]
    with pytest.raises(ValueError):
        list(topk.search_block(np.array([1]), q[:1] * 1e9, q_norm[:1] * 1e9, theta[:1], ids, c * 1e6, norm * 1e6, 5))


def links(rows, t=0.93):
    n, out = len(rows), [0] * len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = []
    for _, e, y, *_ in rows:
        e = single(e)
        ok = y is not None and fine(e) and any(e)
        unit.append(np.array(e) / max(map(abs, e)) if ok else None)
        if ok:
            unit[-1] = unit[-1] / np.sqrt(unit[-1] @ unit[-1])
    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= t:
                out[i] += 1
                out[j] += 1
                root[find(i)] = find(j)
    smallest = defaultdict(list)
    for i in range(n):
        if rows[i][0] is not None:
            smallest[find(i)].append(rows[i][0])
    result = []
    for i in range(n):
        component = min(smallest[find(i)], default=None)
        result.append((rows[i][0], out[i], component, rows[i][0] == component))
    return sorted(result, key=str)


def test_embedding_links_equal_brute_force(spark, vectors):
    for options in ({}, {"cell_rows": 5, "block": 7, "sample": 40}):
        got = embedding_dedup.near_duplicates(vectors, **options).select("vec_id", "n_links", "component_id", "kept")
        assert sorted((tuple(r) for r in got.collect()), key=str) == links(odd_vectors())
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def shuffled_bytes(spark, run):
    """Shuffle bytes that the stages of ``run`` write."""
    sc = spark.sparkContext
    jsc, none = sc._jsc.sc(), sc._gateway.new_array(sc._jvm.double, 0)

    def stages():
        jsc.listenerBus().waitUntilEmpty(60_000)
        found = jsc.statusStore().stageList(None, False, False, none, sc._jvm.java.util.ArrayList())
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before = stages()
    run()
    return sum(n for stage, n in stages().items() if stage not in before)


def test_embedding_dedup_moves_a_vector_once_however_many_blocks(spark):
    rng = np.random.default_rng(11)
    options = {"cell_rows": 200, "block": 50, "sample": 1000}
    moved, raw = [], []
    for n in (600, 4800):
        rows = [(i, x, 1) for i, x in enumerate(rng.normal(size=(n, 64)).tolist())]
        vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
        moved.append(shuffled_bytes(spark, lambda: embedding_dedup.near_duplicates(vectors, **options).collect()))
        raw.append(n * 64 * 4)
    assert moved[1] < 12 * moved[0]
    assert moved[1] < 2 * raw[1]


def test_embedding_links_across_blocks_and_cells(spark):
    """Chains, crowds of near copies and exact copies that no block holds whole, and lengths beside each other."""
    rng = np.random.default_rng(12)
    rows = []
    for i in range(400):  # a chain on a circle: neighbours at 8 degrees link, up to 2 on each side
        a = math.radians(8 * i / 10)
        rows.append((10 * i, [math.cos(a), math.sin(a), 0.0, 0.0, 0.0, 0.0], 1))
    crowd = rng.normal(size=6)
    rows += [(5 + 10 * i, (crowd + rng.normal(size=6) * 0.02).tolist(), i % 2) for i in range(200)]
    rows += [(7 + 10 * (i % 30), (-crowd).tolist(), 1) for i in range(90)]
    rows += [(8000 + i, x, 1) for i, x in enumerate(rng.normal(size=(200, 6)).tolist())]
    rows += [(9000 + i, x, 1) for i, x in enumerate(rng.normal(size=(90, 3)).tolist())]
    rows += [(9500 + i, x, None) for i, x in enumerate(rng.normal(size=(20, 6)).tolist())]
    vectors = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(5)
    for options in ({}, {"cell_rows": 40, "block": 16, "sample": 300}, {"cell_rows": 500, "block": 60}):
        got = embedding_dedup.near_duplicates(vectors, **options).select("vec_id", "n_links", "component_id", "kept")
        assert sorted((tuple(r) for r in got.collect()), key=str) == links(rows)


def test_double_precision_decides_near_the_threshold():
    """Cosines within 1e-8 of t, which single precision can't tell apart, and links counted with copies."""
    t, n = 0.93, 200
    angle = math.acos(t) + np.linspace(-1e-8, 1e-8, n) + 5e-12
    x = np.r_[[[1.0, 0.0]], np.stack([np.cos(angle), np.sin(angle)], 1)]
    x = np.pad(x, ((0, 0), (0, 3)))
    count = np.r_[1, np.full(n, 3)]
    rows = embedding_dedup.Rows(np.arange(n + 1), count, np.arange(n + 1), np.ones(n + 1, bool), x, x.astype(np.float32), np.empty((n + 1, 0)))
    tile = embedding_dedup.Tile(rows, t)
    tile.meet(rows, np.arange(n + 1), np.arange(n + 1), 0)
    assert tile.links[0] == 3 * (angle <= math.acos(t)).sum() == 3 * n / 2
    assert (tile.root == 0).all()


def test_pieces_of_a_link_matrix():
    rng = np.random.default_rng(13)
    for a, b, share in ((1, 1, 1), (30, 40, 0.03), (60, 20, 0.05), (50, 50, 0.5), (40, 300, 0.005)):
        near = rng.random((a, b)) < share
        near[np.arange(a), rng.integers(0, b, a)] = True
        near = near[:, near.any(0)]
        row, col = embedding_dedup.pieces(near)
        found = list(range(a))
        for _ in range(a):
            for j in range(near.shape[1]):
                least = min(found[i] for i in range(a) if near[i, j])
                found = [least if near[i, j] else found[i] for i in range(a)]
            found = [min(found[i], found[found[i]]) for i in range(a)]
        assert row.tolist() == found
        assert all(col[j] == found[i] for i, j in zip(*np.nonzero(near)))


def test_heads_bound_products():
    rng = np.random.default_rng(14)
    x = embedding_dedup.unit(rng.normal(size=(300, 24)) * np.linspace(1, 0.1, 24))
    turn = embedding_dedup.leading(x, 0.93)
    assert 0 < turn.shape[1] < 24 and np.allclose(turn.T @ turn, np.eye(turn.shape[1]))
    head = embedding_dedup.heads(x, turn).astype(float)
    assert (head @ head.T >= x @ x.T - 1e-6).all()
    assert embedding_dedup.leading(x[:1].repeat(50, 0), 0.93).shape[1] <= 3
