"""The scoring step of op3: tiles in the order of their bounds, and what a pair costs."""

import time

import numpy as np

from weir.llm import topk


def directions(rng, n):
    x = rng.normal(size=(n, 64))
    return np.floor(64 * x / np.linalg.norm(x, axis=1, keepdims=True))


def test_a_pair_costs_little_where_bounds_leave_all():
    """Random directions: no bound leaves anything out, and a pair costs a small multiple of its share of a matrix product."""
    rng = np.random.default_rng(1)
    x, q = directions(rng, 8_192), directions(rng, 1_024)
    q[:50] = x[:50]
    rows, own, pivots = np.arange(len(x)), np.r_[np.arange(50), 10**6 + np.arange(len(q) - 50)], topk.far_apart(x[:2_048], 64)
    to_q, to_x, floor = topk.distances(q, pivots), topk.distances(x, pivots), np.full(len(q), -np.inf)
    took = time.process_time()
    dense = q @ x.T
    product = time.process_time() - took
    took = time.process_time()
    i, j, s, _ = topk.best(q, to_q, own, floor, x, to_x, rows, rows, 20)
    took = time.process_time() - took
    dense[np.arange(50), np.arange(50)] = -np.inf
    assert j.reshape(len(q), 20).tolist() == [np.lexsort((rows, -d))[:20].tolist() for d in dense] and (s == dense[i, j]).all()
    assert took < 40 * max(product, 0.02)


def test_tiles_hold_one_cell_and_bounds_hold():
    rng = np.random.default_rng(2)
    x, q, pivots = (rng.integers(-90, 90, (n, 5)).astype(float) for n in (3_000, 40, 6))
    to_x, to_q = topk.distances(x, pivots), topk.distances(q, pivots)
    order, starts = topk.tiles(x, to_x)
    ends = np.r_[starts[1:], len(x)]
    assert sorted(order) == list(range(len(x))) and (ends - starts).max() <= topk.TILE
    for s, e in zip(starts, ends, strict=True):
        part = order[s:e]
        assert len(set(to_x[part].argmin(axis=1))) == 1
        bound = topk.tile_bounds(q, to_q, to_x[part].min(axis=0)[None], to_x[part].max(axis=0)[None], topk.squares(x[part]).max()[None])
        assert (bound[:, 0] >= (q @ x[part].T).max(axis=1)).all()


def test_scores_that_no_float_holds():
    rng = np.random.default_rng(3)
    for scale in (1, 1e6, 1e12):
        x = np.floor(rng.normal(size=(300, 5)) * scale)
        x[7], ids, none = x[3], rng.integers(0, 40, 300), np.zeros((300, 0))
        i, j, s, _ = topk.best(x[:30], none[:30], np.arange(30), np.full(30, -np.inf), x, none, np.arange(300), ids, 9)
        for a in range(30):
            want = sorted((-min(topk.LONG, max(-topk.LONG - 1, sum(int(m) * int(n) for m, n in zip(x[a], v, strict=True)))), ids[b], b) for b, v in enumerate(x) if b != a)[:9]
            assert [(-c, ids[b], b) for b, c in zip(j[i == a].tolist(), s[i == a].tolist(), strict=True)] == want
