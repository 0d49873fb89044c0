"""Whitened vectors against the same arithmetic on plain arrays."""

import numpy as np
import pytest

import __spark_entry__ as contract
from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, key binary, weight long, size string"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, b"k", 5, "s") for i, v in rows], SCHEMA)


def check(got, rows, components, weigh_copies=True):
    """Rows of whole vectors, shorter ones with zeros behind."""
    size = max(len(v) for _, v in rows)
    x = np.array([np.floor(64 * np.array([*v, *[0.0] * (size - len(v))])) for _, v in rows]) + 1_000_000
    fitted = x if weigh_copies else np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = fitted - sums / n
    variances = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    wanted = min(components, size)
    assert len(got) == len(rows) * wanted
    deviations = {}
    for (row_id, _), whole in zip(rows, x, strict=True):
        deviations.setdefault(row_id, set()).add(sum((n * int(a) - int(s)) ** 2 for a, s in zip(whole, sums, strict=True)))
    for row in got:
        assert row.n == n
        assert row.deviation in deviations[row.id]
        assert row.explained == pytest.approx(variances[row.component - 1] / variances.sum(), rel=1e-6, abs=1e-12)
        assert row.identity_error <= 1e-9
    return x


def test_whitened_vectors(spark):
    pick = np.random.default_rng(3)
    vectors = [pick.normal(size=6).astype(np.float32).tolist() for _ in range(300)]
    rows = [(n if n else None, v) for n, v in enumerate(vectors)]
    rows += [(1000 + n, vectors[7]) for n in range(400)]  # a vector of over half of all rows
    rows += [(7, vectors[7])] * 3 + [(2000, [1.0, -2.0])]
    dropped = [(1, None), (2, [1.0, None]), (3, [NAN] * 6), (4, [INF, 0.0, 0.0, 0.0, 0.0, 0.0])]
    for weigh in (True, False):
        got = whitening.whiten(table(spark, rows + dropped), components=4, weigh_copies=weigh).collect()
        x = check(got, rows, 4, weigh)
        if not weigh:
            continue
        values = {}
        for row in got:
            values.setdefault(row.id, {})[row.component] = row.whitened
        centred = x - x.mean(axis=0)
        variances, axes = np.linalg.eigh(centred.T @ centred / len(x))
        for at, (row_id, _) in enumerate(rows):
            want = centred[at] @ axes[:, ::-1][:, :4] / np.sqrt(variances[::-1][:4])
            assert np.allclose(np.abs(want), [abs(values[row_id][c]) for c in range(1, 5)], atol=1e-8)


def test_no_variance_no_rows_and_large_entries(spark):
    same = whitening.whiten(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r.id, r.component, r.n, r.deviation, r.whitened) for r in sorted(same)] == [
        (1, 1, 2, 0, None), (1, 2, 2, 0, None), (2, 1, 2, 0, None), (2, 2, 2, 0, None)
    ]
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [])])).count() == 0
    large = whitening.whiten(table(spark, [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, 3.0])])).collect()
    assert len(large) == 6 and {r.deviation for r in large if r.id == 1} == {None}
    exact = whitening.whiten(table(spark, [(1, [float(2**20), 1.0]), (2, [0.0, 2.0]), (3, [0.0, 3.0])])).collect()
    check(exact, [(1, [float(2**20), 1.0]), (2, [0.0, 2.0]), (3, [0.0, 3.0])], 2)


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = contract.queries()["op13_whitened_embeddings"](spark, sf_dir)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.withColumnRenamed("vec_id", "id").collect(), rows, 32)
