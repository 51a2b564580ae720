import math
import random

import numpy as np
import pytest

from hubcat.llm import whitening
from hubcat.llm.queries import op11_chebyshev_whitening

SF = "/root/testdata/sf0.001"


def plain(rows, components=4):
    """By id, the exact deviation and the whitened values up to sign; by component e / trace."""
    whole = [(i, tuple(math.floor(whitening.SCALE * c) for c in v)) for i, v in rows]
    fit = np.asarray(sorted({x for _, x in whole}), "f8")
    n, sums = len(fit), [sum(int(c) for c in col) for col in fit.T]
    mean = np.asarray([s / n for s in sums])
    v = (fit - mean).T @ (fit - mean) / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    out = {}
    for i, x in whole:
        out[i] = (sum((n * c - s) ** 2 for c, s in zip(x, sums)), (np.asarray(x) - mean) @ q / np.sqrt(e))
    return n, out, e / np.trace(v)


def check(found, rows):
    n, expected, explained = plain(rows)
    k = len(explained)
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(found) == k * len(rows) and set(by_id) == {i for i, _ in rows}
    signs = None
    for i, per in by_id.items():
        deviation, white = expected[i]
        got = np.asarray([per[c]["whitened"] for c in range(1, k + 1)])
        if signs is None and (np.abs(white) > 1e-3).all():
            signs = np.sign(got * white)
        assert all(per[c]["n"] == n and per[c]["deviation"] == deviation and per[c]["identity_error"] < 1e-9 for c in per)
        assert np.allclose([per[c]["explained"] for c in range(1, k + 1)], explained, rtol=1e-9)
        assert signs is None or np.allclose(got, white * signs, atol=1e-7), (got, white)


def vectors(n, d, seed=3, flat=False):
    rng = np.random.default_rng(seed)
    width = np.ones(d) if flat else np.linspace(1, 3, d)
    return [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(n, d)) * width)]


def frame(spark, rows, schema="vec_id long, embedding array<double>"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("d, flat", [(4, False), (7, False), (40, False), (40, True)])
def test_against_a_full_decomposition(spark, d, flat):
    rows = vectors(300, d, flat=flat)
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_copies_weigh_nothing_and_come_back(spark):
    rows = vectors(60, 6)
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_rows_that_take_no_part(spark):
    rows = vectors(40, 5)
    bad = [(-1, None), (-2, []), (-3, [1.0, None, 1.0, 1.0, 1.0]), (-4, [float("nan")] * 5), (-5, [float("inf")] + [0.0] * 4), (-6, [1.0, 2.0])]
    check(whitening.whiten(frame(spark, rows + bad)).collect(), rows)
    assert whitening.whiten(frame(spark, bad[:1])).collect() == []
    assert whitening.whiten(frame(spark, [])).collect() == []


def test_no_variance_repeated_and_missing_ids_clashing_columns(spark):
    same = frame(spark, [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (None, [0.5, 0.5])])
    found = whitening.whiten(same).collect()
    assert len(found) == 6 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in found)
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]
    wide = spark.createDataFrame([(i, v, "x", 1, [9.0]) for i, v in line], "vec_id long, embedding array<double>, x string, n int, vector array<double>")
    found = whitening.whiten(wide).collect()
    assert [r["whitened"] is None for r in found if r["vec_id"] == 3] == [False, True, True]
    assert all(r["identity_error"] < 1e-9 for r in found)


def test_the_lower_bound_and_the_filter_cut_the_passes(spark):
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(4000, 64)) * 256)
    made = spark.createDataFrame([(r.tolist(),) for r in x.astype(int)], "x array<long>").repartition(3)
    blocks = made.mapInArrow(whitening._packed, "rows int, block binary")
    n, sums = whitening.exact_sums(blocks)
    assert n == 4000 and sums == tuple(int(c) for c in x.sum(axis=0))
    v = whitening.Covariance(blocks, n, sums)
    values, vectors = whitening.leading_components(v, 4)
    full = np.cov(x.T, bias=True)
    assert np.allclose(values, np.linalg.eigvalsh(full)[::-1][:4], rtol=1e-12)
    assert np.abs(full @ vectors - vectors * values).max() < 1e-10 * values[0]
    assert v.passes < 80


def test_deviations_are_exact_or_null():
    rng = random.Random(1)
    x = np.asarray([[rng.randrange(-10 ** k, 10 ** k) for _ in range(3)] for k in range(1, 18)])
    for n in (1, 7, 10 ** 6, 10 ** 12):
        sums = tuple(rng.randrange(-n * 100, n * 100) for _ in range(3))
        plain = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
        assert whitening.deviations(x, n, sums) == [p if p < 1 << 63 else None for p in plain]


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(op11_chebyshev_whitening(spark, SF).collect(), rows)
