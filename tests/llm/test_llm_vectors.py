import hashlib
import math
import random

import numpy as np
import pytest

from transferlake.llm import codes, whitening
from transferlake.llm.common import read

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, label int, part string, n int, code string, _label string, number string, ids string"


def frame(spark, rows):
    """Rows of (vec_id, embedding, label) beside columns whose names clash."""
    return spark.createDataFrame([(*r, "x", 7, "x", "x", "x", "x") for r in rows], SCHEMA)


AWKWARD = [
    (1, [0.5, -0.25, 1.0, 0.125], 1), (1, [0.5, -0.25, 1.0, 0.125], 1), (2, [0.1, 0.2, -0.3, 0.7], None), (None, [0.9, -0.9, 0.4, 0.4], None),
    (3, None, 1), (4, [0.1, None, 0.2, 0.3], 1), (5, [float("nan"), 0.0, 0.0, 0.0], 2), (6, [float("inf"), 0.0, 0.0, 0.0], 2),
    (7, [0.2, 0.2, 0.2, 0.2], 2), (8, [-0.5, 0.0], 2), (9, [], 2), (10, [0.3, 0.1, -0.8, -0.2], 3), (11, [-0.0, 1e-9, -1e-9, 0.5], 3)]


# --- vector codes ---

def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not fine:
        return []
    length = -(-max(len(r[1]) for r in fine) // parts)
    exact = lambda x: int(x) * scale if abs(x) >= 1 << 52 else math.floor(x * scale)
    cut = lambda v: [(list(map(exact, v)) + [0] * (parts * length - len(v)))[p * length:(p + 1) * length] for p in range(parts)]
    first = sorted(fine, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1])[p] for r in first] for p in range(parts)]

    def assigned(v):
        out = []
        for p, own in enumerate(cut(v)):
            far = [sum((a - b) ** 2 for a, b in zip(own, e)) for e in books[p]]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = [(cut(r[1]), assigned(r[1])) for r in fine]
        books = [[[sum(c) // len(c) for c in zip(*own)] if (own := [x[p] for x, a in found if a[p][0] == e]) else old
                  for e, old in enumerate(books[p])] for p in range(parts)]
    sha = hashlib.sha256(",".join(str(x) for part in books for e in part for x in e).encode()).hexdigest()
    found = [(r, assigned(r[1])) for r in fine]
    total = {}
    for r, a in found:
        total[r[2]] = total.get(r[2], 0) + sum(d for _, d in a)
    held = lambda x: x if x < 1 << 63 else None
    each = [(r, "".join(f"{e:02x}" for e, _ in a), held(sum(d for _, d in a))) for r, a in found]
    spoilt = {r[2] for r, _, e in each if e is None}
    return [(r[0], code, e, None if r[2] in spoilt else held(total[r[2]]), sha) for r, code, e in each]


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr)


def test_codes_against_brute_force(spark):
    rows = [tuple(r) for r in read(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    same(codes.op13_vector_codes(spark, SF), brute_codes(rows))


def test_codes_of_awkward_rows(spark):
    same(codes.coded(frame(spark, AWKWARD)), brute_codes(AWKWARD))
    same(codes.coded(frame(spark, [])), [])
    same(codes.coded(frame(spark, [(3, None, 1), (4, [None], 1)])), [])
    same(codes.coded(frame(spark, [(9, [], 1), (2, [], None)])), brute_codes([(9, [], 1), (2, [], None)]))
    few = AWKWARD[:3]
    same(codes.coded(frame(spark, few), parts=3, entries=2, rounds=2), brute_codes(few, 3, 2, 2))


def test_codes_of_entries_too_large_for_int64(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1.0, 1e6, 1e12, 3e15]) * rng.uniform(-1, 1) for _ in range(10)], i % 3) for i in range(60)]
    same(codes.coded(frame(spark, rows), entries=4), brute_codes(rows, entries=4))


def test_codes_do_not_depend_on_partitions(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(24)], i % 4) for i in range(400)]
    same(codes.coded(frame(spark, rows).repartition(13)), brute_codes(rows))


@pytest.mark.parametrize("size", [1, 2, 8, 16, 64])
def test_hadamard_keeps_scaled_distances(size):
    signs = codes.transformed(np.eye(size, dtype=np.int64))
    order = signs.T                                            # coefficient by entry
    assert (order @ order.T == size * np.eye(size, dtype=np.int64)).all()
    assert [(np.diff(r) != 0).sum() for r in order] == list(range(size))


def test_nearest_takes_the_lowest_of_equal_entries():
    rng = np.random.default_rng(7)
    points, entries = rng.integers(-3, 4, (500, 6)), rng.integers(-3, 4, (9, 6))
    found, far = codes.nearest(codes.transformed(points), codes.transformed(entries))
    exact = ((points[:, None] - entries) ** 2).sum(axis=2)
    assert (found == exact.argmin(axis=1)).all() and (far == exact.min(axis=1)).all()


# --- whitening ---

def check_whitening(found, rows, components=32):
    fine = [(r[0], r[1]) for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(len(v) for _, v in fine)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in fine], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    gap = n * x - sums
    centred = (gap / n).astype(float)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    shown = len(values)
    usable = int((values > width * np.finfo(float).eps * max(values[0], 0)).sum())
    assert len(found) == len(fine) * shown and {r["n"] for r in found} == {n}
    deviations = (gap ** 2).sum(axis=1)
    assert sorted(((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1), key=repr) == sorted(zip((i for i, _ in fine), deviations), key=repr)
    white = centred @ vectors[:, :usable] / np.sqrt(values[:usable])
    for j in range(shown):
        own = sorted(((r["deviation"], r["vec_id"], r["whitened"]) for r in found if r["component"] == j + 1), key=repr)
        if j >= usable:
            assert all(w is None for *_, w in own) and all(r["explained"] == 0 for r in found if r["component"] == j + 1)
            continue
        mine = lambda sign: sorted(((d, i, sign * w) for d, (i, _), w in zip(deviations, fine, white[:, j])), key=repr)
        assert any(np.allclose([w for *_, w in own], [w for *_, w in mine(s)], rtol=1e-7, atol=1e-7) for s in (1, -1))
        assert all(abs(r["explained"] - values[j] / np.trace(cov)) <= 1e-9 for r in found if r["component"] == j + 1)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] <= 1e-4


def test_whitening_against_numpy(spark):
    rows = [tuple(r) for r in read(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    check_whitening(whitening.op12_whitening(spark, SF).collect(), rows)


def test_whitening_over_many_small_blocks(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, k + 1) for k in range(6)], 0) for i in range(333)]
    check_whitening(whitening.whiten(frame(spark, rows).repartition(9), components=4, block=8).collect(), rows, 4)


def test_whitening_of_awkward_rows(spark):
    check_whitening(whitening.whiten(frame(spark, AWKWARD)).collect(), AWKWARD)
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(3, None, 1), (9, [], 1)])).collect() == []
    flat = [(i, [0.5, 0.5, float(i)], 0) for i in range(5)]                                # one direction only
    check_whitening(whitening.whiten(frame(spark, flat)).collect(), flat)
    one = whitening.whiten(frame(spark, [(1, [0.5, 1e30], 0)])).collect()                  # no variance, held at the bound
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, 0.0, 0.0)] * 2
    far = whitening.whiten(frame(spark, [(1, [1e30], 0), (2, [-1e30], 0)])).collect()
    assert [r["deviation"] for r in far] == [None, None] and sorted(round(r["whitened"]) for r in far) == [-1, 1]
