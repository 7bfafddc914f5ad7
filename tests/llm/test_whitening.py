import math

import numpy as np
import pytest

from contentloom.llm.common import table
from contentloom.llm.whitening import WhitenSettings, deviations, whiten

FORM = "vec_id long, embedding array<float>, n long"


def scaled(vectors):
    return [[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors]


def expected(x):
    """Counts, exact deviations, eigenvalues and unit vectors by a dense solver."""
    n, sums = len(x), [sum(c) for c in zip(*x)]
    exact = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, exact, centred, values[::-1], vectors[:, ::-1]


def check(found, x, ids, k):
    n, exact, centred, values, vectors = expected(x)
    assert len(found) == n * k and {r.n for r in found} == {n}
    by = {(r.vec_id, r.component): r for r in found}
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9
    whitened = np.array([[by[i, c + 1].whitened for c in range(k)] for i in ids])
    assert abs(np.cov(whitened.T, bias=True).reshape(k, k) - np.eye(k)).max() < 1e-9
    for c in range(k):
        plain = centred @ vectors[:, c] / math.sqrt(values[c])
        sign = np.sign(plain @ whitened[:, c])
        assert abs(plain * sign - whitened[:, c]).max() < 1e-7
        assert by[ids[0], c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
    assert [by[i, 1].deviation for i in ids] == exact


@pytest.mark.parametrize("d, n", [(64, 700), (90, 400), (5, 60)])
def test_whitened_values(spark, d, n):
    pick = np.random.default_rng(d)
    plain = pick.standard_normal((n, d)) * np.geomspace(3, 0.2, d) + pick.standard_normal(d) * 5
    vectors = plain.astype(np.float32).tolist()
    rows = spark.createDataFrame([(i, v, i) for i, v in enumerate(vectors)], FORM).repartition(3)
    check(whiten(rows).collect(), scaled(vectors), list(range(n)), min(32, d))


def test_small_block_needs_several_cycles(spark):
    pick = np.random.default_rng(1)
    vectors = (pick.standard_normal((300, 40)) * np.linspace(2, 1, 40)).tolist()
    rows = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], FORM.replace("float", "double"))
    found = whiten(rows, settings=WhitenSettings(components=4, guard=3, degree=6))
    check(found.collect(), scaled(vectors), list(range(300)), 4)


def test_given_embeddings(spark, tables):
    vectors = {r.vec_id: r.embedding for r in tables("embeddings").collect()}
    ids = sorted(vectors)
    check(whiten(tables("embeddings")).collect(), scaled([vectors[i] for i in ids]), ids, 32)


def test_deviations_beyond_64_bits():
    centred = np.array([[3, -2], [2**39, 1], [0, 0]], np.int64)
    n, part = 2**22, [5, 7]
    exact = [sum((n * int(c) - p) ** 2 for c, p in zip(row, part)) for row in centred]
    assert deviations(centred, n, part).to_pylist() == [x if x < 2**63 else None for x in exact]
    assert exact[1] >= 2**63


def test_odd_vectors(spark):
    pick = np.random.default_rng(3)
    good = [[float(x) for x in pick.standard_normal(6)] for _ in range(50)]
    odd = [None, [], [1.0] * 5 + [None], [1.0] * 5 + [math.nan], [math.inf] + [1.0] * 5, [1e30] * 6, [1.0] * 4]
    rows = [(i, v, 0) for i, v in enumerate(good)] + [(1000 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(None, good[0], 1), (3, good[3], 1)]
    found = whiten(spark.createDataFrame(rows, FORM)).collect()
    assert len(found) == 52 * 6 and {r.n for r in found} == {52}
    assert sorted({r.vec_id for r in found} - {None}) == list(range(50))
    assert sum(r.vec_id is None for r in found) == 6 and sum(r.vec_id == 3 for r in found) == 12


def test_tables_without_variance(spark):
    equal = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(9)], FORM)
    assert whiten(equal).count() == 0
    assert whiten(equal.limit(1)).count() == 0
    assert whiten(equal.limit(0)).columns == whiten(equal).columns and whiten(equal.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 0) for i in range(9)], FORM)
    found = whiten(line).collect()
    assert {r.component for r in found} == {1} and all(r.explained == pytest.approx(1) for r in found)
    constant = [(i, [float(i % 7)] + [float(i % 3)] + [1.0] * 70, 0) for i in range(63)]
    found = whiten(spark.createDataFrame(constant, FORM)).collect()
    assert {r.component for r in found} == {1, 2} and {r.identity_error < 1e-9 for r in found} == {True}


def test_whole_table_is_used(spark):
    folder = "/root/testdata/sf0.01"
    rows = table(spark, folder, "embeddings")
    assert whiten(rows).select("vec_id").distinct().count() == rows.count()
