"""Vector codes and whitening against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import vector_codes, whitening
from starloom.llm.vectors import whole

SMALL = vector_codes.Spec(parts=2, entries=3)
NAN, INF = float("nan"), float("inf")


def table(spark, rows, columns="vec_id long, embedding array<float>, label int"):
    return spark.createDataFrame(rows, columns)


def plain_codes(rows, spec):
    """``vec_id, code, error, label_error, sha`` by comparing every part with every entry."""
    kept = [r for r in rows if r[1] and all(v is not None and np.isfinite(v) for v in r[1])]
    kept = [r for r in kept if len(r[1]) == max(len(k[1]) for k in kept)]
    if not kept:
        return []
    x = [[int(np.floor(spec.scale * np.float64(np.float32(v)))) for v in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, x[i]))
    width = len(x[0]) // spec.parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(spec.parts)] for v in x]
    books = [[cut[i][p] for i in order[: spec.entries]] for p in range(spec.parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(spec.rounds):
        for p in range(spec.parts):
            chosen = [near(v[p], books[p])[1] for v in cut]
            for e in range(len(books[p])):
                mine = [v[p] for v, c in zip(cut, chosen, strict=True) if c == e]
                if mine:
                    books[p][e] = tuple(sum(column) // len(mine) for column in zip(*mine, strict=True))
    found = [[near(v[p], books[p]) for p in range(spec.parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {r[2]: sum(e for q, e in zip(kept, errors, strict=True) if q[2] == r[2]) for r in kept}
    text = ",".join(str(c) for book in books for e in book for c in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(
        ((r[0], "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], sha)
         for r, f, e in zip(kept, found, errors, strict=True)),
        key=repr,
    )


def codes(df, spec=SMALL):
    found = vector_codes.compress(df, spec=spec).collect()
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r[c] for c in columns) for r in found), key=repr)


def test_codes_equal_plain_ones(spark):
    random = np.random.default_rng(1)
    rows = [(int(i), random.normal(size=8).round(1).tolist(), int(i) % 3) for i in random.permutation(60)]
    spec = vector_codes.Spec(parts=4, entries=7)
    assert codes(table(spark, rows), spec) == plain_codes(rows, spec)


def test_codes_of_odd_rows(spark):
    rows = [
        (5, [0.1, -0.1, 3.0, 0.0], None),
        (5, [0.1, -0.1, 2.0, 0.0], None),  # a key again: in the order of the vectors
        (None, [9.0, 9.0, 9.0, 9.0], 1),
        (3, [0.1, -0.1, 3.0, 0.0], 1),
        (3, [0.1, -0.1, 3.0, 0.0], 1),  # a whole row again
        (1, None, 1), (2, [], 1), (0, [1.0, None, 1.0, 1.0], 1), (4, [1.0, NAN, 1.0, 1.0], 2),
        (6, [1.0, -INF, 1.0, 1.0], 2), (7, [1.0, 2.0], 2),
    ]
    found = codes(table(spark, rows))
    assert found == plain_codes(rows, SMALL)
    assert len(found) == 5


def test_codes_with_fewer_rows_than_entries_and_with_none(spark):
    rows = [(1, [0.5, 0.5], 0), (2, [0.25, 0.5], 0)]
    assert codes(table(spark, rows)) == plain_codes(rows, SMALL)
    assert codes(table(spark, [])) == []
    assert codes(table(spark, [(1, None, 0)])) == []


def test_codes_beside_clashing_columns(spark):
    df = table(spark, [(1, [0.5, 0.5], 0), (2, [0.25, 0.5], 1)])
    plain = codes(df)
    for name in ("k", "x", "codes", "error", "code", "l", "c0"):
        assert codes(df.withColumn(name, F.lit("?"))) == plain
    renamed = df.withColumnsRenamed({"vec_id": "x", "label": "error_"})
    found = vector_codes.compress(renamed, key="x", label="error_", spec=SMALL)
    assert sorted(r["code"] for r in found.collect()) == sorted(r[1] for r in plain)


def test_parts_must_divide_and_numbers_must_fit(spark):
    with pytest.raises(ValueError, match="do not divide"):
        codes(table(spark, [(1, [1.0, 2.0, 3.0], 0)]))
    with pytest.raises(Exception, match="lies beyond"):
        codes(table(spark, [(1, [1e30, 2.0], 0)]))


def test_codes_decode_to_entries(spark):
    df = table(spark, [(i, [i / 8, -i / 8], 0) for i in range(9)])
    books = vector_codes.train(df, spec=SMALL)
    for row in vector_codes.encode(df, books, more=["embedding"]).collect():
        decoded = books.decode(np.array([row["codes"]]))[0]
        x = np.floor(256 * np.array(row["embedding"])).astype(int)
        assert ((decoded - x) ** 2).sum() == row["error"]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 4), st.integers(1, 9), st.integers(0, 2**32 - 1))
def test_equal_average_search_is_exact(width, entries, seed):
    """Small numbers, so that sums, gaps and distances tie often."""
    random = np.random.default_rng(seed)
    books = random.integers(-3, 4, (2, entries, width))
    x = random.integers(-4, 5, (12, 2, width))
    index, distance = vector_codes.Nearest(books)(x)
    every = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    assert (index == every.argmin(axis=2)).all()
    assert (distance == every.min(axis=2)).all()


def test_equal_average_search_leaves_entries_out():
    random = np.random.default_rng(0)
    nearest = vector_codes.Nearest(random.integers(-100, 100, (1, 64, 4)))
    nearest(random.integers(-100, 100, (500, 1, 4)))
    assert nearest.looked_at < 0.6 * 500 * 64


def test_hot_vector_reaches_the_shuffle_once_a_task(spark):
    df = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"),
        F.lit(1).alias("label"),
    )
    found = vector_codes.compress(df, spec=SMALL)
    assert found.agg(F.count("*"), F.max("label_error")).first() == (4000, 0)


def test_whole_vectors(spark):
    rows = [([1.0],), ([],), (None,), ([None],), ([NAN],), ([INF],), ([-INF],), ([1.0, 2.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    assert [r[0] for r in df.select(whole(F.col("v"))).collect()] == [
        True, False, False, False, False, False, False, True,
    ]


# --- whitening ------------------------------------------------------------


def plain_whitening(x, spec):
    """``whitened (up to sign), deviation, explained`` from a full eigendecomposition."""
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][: spec.components], vectors[:, ::-1][:, : spec.components]
    real = values > 1e-9 * values[0]
    values, vectors = values[real], vectors[:, real]
    white = ((n * x - sums) / n) @ vectors / np.sqrt(values)
    return n, white, ((n * x - sums) ** 2).sum(axis=1), values / np.trace(covariance)


def whitened(df, spec=whitening.Spec()):
    return whitening.whiten(df, spec=spec).orderBy("vec_id", "component").toPandas()


def close_up_to_sign(got, wanted):
    sign = np.sign((got * wanted).sum(axis=0))
    return np.allclose(got * sign, wanted, atol=1e-8)


def test_whitening_equals_the_full_decomposition(spark):
    random = np.random.default_rng(3)
    spread = np.linspace(0.05, 0.9, 40)
    vectors = (random.normal(size=(300, 40)) * spread).astype(np.float32)
    vectors[250:] = vectors[0]  # copies count once in the fit
    df = table(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)])
    spec = whitening.Spec(components=5, guards=4)
    out = whitened(df, spec)
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + spec.offset
    n, white, deviation, explained = plain_whitening(x, spec)
    assert (out["n"] == n).all() and n == 250
    assert close_up_to_sign(out["whitened"].to_numpy().reshape(-1, 5), white)
    assert (out["deviation"].to_numpy().reshape(-1, 5) == deviation[:, None]).all()
    assert np.allclose(out["explained"][:5], explained, rtol=1e-10)
    assert out["identity_error"].max() < 1e-10 and out["identity_error"].nunique() == 1


def test_filter_rounds_are_needed_and_end(spark):
    random = np.random.default_rng(4)
    vectors = random.normal(size=(400, 48))  # eigenvalues close together
    df = table(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)])
    model = whitening.fit(df, spec=whitening.Spec(components=4, guards=4))
    assert model.passes > 20
    assert model.residual < 1e-11 * model.eigenvalues[0]
    with pytest.raises(ArithmeticError, match="no certified"):
        whitening.fit(df, spec=whitening.Spec(components=4, guards=4, rounds=2))


def test_rank_bounds_the_components(spark):
    rows = [(i, [i / 4, 2.0 * i, 1.0], None) for i in range(20)]
    out = whitened(table(spark, rows))
    assert set(out["component"]) == {1} and len(out) == 20
    assert abs(out["explained"][0] - 1) < 1e-9
    assert out["identity_error"][0] < 1e-9


def test_whitening_of_odd_rows(spark):
    good = [(None, [0.5, 1.0], 0), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 0.25], None)]
    bad = [(3, None, 0), (4, [], 0), (5, [1.0, None], 0), (6, [NAN, 1.0], 0), (7, [INF, 1.0], 0)]
    out = whitened(table(spark, good + bad))
    assert len(out) == 8 and (out["n"] == 3).all()
    assert whitened(table(spark, bad)).empty
    assert whitened(table(spark, [])).empty
    assert whitened(table(spark, [(1, [1.0, 2.0], 0)] * 3)).empty  # one distinct vector


def test_whitening_beside_clashing_columns(spark):
    df = table(spark, [(i, [i / 4, (i * i % 5) / 2], 0) for i in range(9)])
    plain = whitened(df)
    for name in ("k", "x", "pos", "col", "n", "deviation", "whitened"):
        assert whitened(df.withColumn(name, F.lit("?"))).equals(plain)


def test_deviations_are_exact_or_null():
    big = np.array([[1 << 33, 0], [3, 4]], object)
    assert whitening._deviations(big) == [None, 25]
    assert whitening._deviations(np.array([[(1 << 31) - 1, 1]])) == [((1 << 31) - 1) ** 2 + 1]
    edge = np.array([[3037000499, 0]], object)  # its square is the largest that fits
    assert whitening._deviations(edge) == [3037000499**2]


def test_passes_send_matrices_not_rows(spark):
    """What is shuffled by a pass has a row per dimension and task."""
    df = spark.range(0, 1000, 1, 4).select(
        F.col("id").alias("vec_id"), F.array(*[(F.col("id") * p % 97 / 9).cast("float") for p in (3, 5, 7)]).alias("embedding")
    )
    model = whitening.fit(df, spec=whitening.Spec(components=2, guards=1))
    assert model.rank == 2 and model.n == 97
