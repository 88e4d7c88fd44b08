import numpy as np
import pytest

from tidemark.llm import whitening as W

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute(rows, components=W.COMPONENTS):
    """The contract over Python integers and a library eigendecomposition: (n, {vec_id: deviation}, ids, |whitened|, explained)."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[a - s / n for a, s in zip(r, sums, strict=True)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviations, [i for i, _ in kept], np.abs(centred @ vectors / np.sqrt(values)), values / np.trace(centred.T @ centred / n)


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["vec_id"], {}).setdefault(r["component"], r)
    return out


def hold(got, rows, components=W.COMPONENTS):
    n, deviations, ids, whitened, explained = brute(rows, components)
    assert set(got) == set(ids)
    for i, deviation, w in zip(ids, deviations, whitened, strict=True):
        cells = got[i]
        assert sorted(cells) == list(range(1, len(explained) + 1))
        assert {(c["n"], c["deviation"]) for c in cells.values()} == {(n, deviation)}
        assert np.allclose([abs(cells[k + 1]["whitened"]) for k in range(len(w))], w, atol=1e-8)
        assert np.allclose([cells[k + 1]["explained"] for k in range(len(w))], explained, rtol=1e-9)
        assert all(0 <= c["identity_error"] < 1e-9 for c in cells.values())


def vectors(seed, n, d, spread=None):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, d)) * (1 if spread is None else spread)).astype(np.float32).tolist()


@pytest.mark.parametrize("n, d, spread", [(200, 6, None), (300, 40, None), (150, 64, np.linspace(0.1, 3, 64))])
def test_matches_brute_force(spark, n, d, spread):
    rows = list(enumerate(vectors(n, n, d, spread)))
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], COLUMNS).repartition(7)
    hold(collected(W.whiten(df)), rows)


def test_given_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    hold(collected(W.whiten(df)), rows)


def test_unusable_vectors_repeats_and_clashing_names(spark):
    good = list(enumerate(vectors(5, 80, 5)))
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [1.0, float("nan"), 2.0, 3.0, 4.0]),
           (903, [1.0, float("inf"), 2.0, 3.0, 4.0]), (904, [1.0, 2.0]), (905, []), (906, [1e30, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in [*good, *bad, good[3]]], COLUMNS)
    df = df.selectExpr("*", "'x' AS component", "'y' AS n", "'z' AS place", "'v' AS vector")
    out = W.whiten(df)
    assert out.filter("vec_id = 3 AND component = 1").count() == 2
    got = collected(out)
    assert set(got) == set(range(80)) and got[0][1]["n"] == 81


def test_no_component_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(5)], [(1, None, 0)]):
        assert W.whiten(spark.createDataFrame(rows, COLUMNS)).collect() == []
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 0) for i in range(6)] + [(None, [9.0, 18.0, 5.0], 0)], COLUMNS)).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 7 and abs(line[0]["explained"] - 1) < 1e-12


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5], [9, 9, 9, 4, 4, 1, 1e-9, 0], [100, 1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.1],
                                    list(range(1, 40)), [1e12, 1e6, 1, 1e-3]])
def test_intervals_of_difficult_spectra(spark, values):
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((len(values), len(values))))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    found, vectors_ = W.leading_components(spark, v, 10)
    expected = [x for x in sorted(values, reverse=True)[:10] if x > 8 * len(values) * W._EPS * max(values)]
    assert np.allclose(found, expected, rtol=1e-9, atol=1e-12 * max(values))
    assert np.allclose(vectors_.T @ vectors_, np.eye(len(found)), atol=1e-10)
    assert np.abs(v @ vectors_ - vectors_ * found).max() < 1e-11 * max(values)


def test_inertia_counts_and_places():
    r = np.random.default_rng(4)
    for d in (1, 2, 3, 17, 64):
        a = r.standard_normal((d, d))
        v = a @ a.T
        exact, tri = np.linalg.eigvalsh(v), W.tridiagonal(v)
        shifts = np.r_[exact - 1e-6, exact + 1e-6, 0.5, -1.0]
        assert W.inertia(tri, shifts).tolist() == [int((exact < s).sum()) for s in shifts]
        assert np.allclose(W.locate(tri), exact, atol=1e-8 * exact.max())


def test_missing_component_is_an_error():
    with pytest.raises(ArithmeticError):
        W.eigenvectors_between(np.diag([1.0, 2.0, 3.0]), 0.5, 2.5, 3)


def test_deviation_beyond_a_long_is_null():
    model = W.Whitening(1 << 40, [0, 0], np.eye(2), np.ones(2), np.eye(2))
    assert model.deviations(np.array([[1, 2], [1 << 40, 0]])) == [None, None]
    exact = W.Whitening(3_000_000_000, [5, 0], np.eye(2), np.ones(2), np.eye(2))
    assert exact.deviations(np.array([[1, 0]])) == [(3_000_000_000 - 5) ** 2]
