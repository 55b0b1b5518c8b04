"""Robust outliers: the estimate against numpy, what correlation and starts do, degenerate groups."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohmbridge.llm import robust

STATS = "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_distinct_words bigint"


def plain(n, seed, lang="en", source="a", first=0):
    """Texts whose variety falls with their length, as vocabularies do."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        words = int(math.exp(rng.normal(6, 0.7))) + 12
        distinct = int(min(words, words ** (1.02 - 0.02 * math.log(words) + rng.normal(0, 0.004))))
        chars = int(words * (5 + rng.normal(0, 0.12)))
        out.append((first + i, lang, source, words, chars, int(rng.poisson(chars / 900)), int(rng.poisson(0.2)), int(rng.poisson(0.5)) * 5, words // 20 + 1, max(distinct, 1)))
    return out


def chi2_by_sum(x, dof, steps=200_000):
    at = (np.arange(steps) + 0.5) * x / steps
    return float(np.sum(at ** (dof / 2 - 1) * np.exp(-at / 2)) * x / steps / (2 ** (dof / 2) * math.gamma(dof / 2)))


def test_chi2():
    for dof in (2, 6, 8):
        for x in (0.5, 5.0, 20.0):
            assert robust.chi2_share(x, dof) == pytest.approx(chi2_by_sum(x, dof), abs=1e-6)
    assert robust.chi2_share(robust.chi2_quantile(0.975, 6), 6) == pytest.approx(0.975)


def brute(rows):
    """The whole estimate in numpy: (distances, determinant by start)."""
    v = np.array([[getattr(r, f) for f in robust.FEATURES] for r in rows])
    noise = np.array([[getattr(r, f"w{i}") for i in range(robust.N)] for r in rows])
    base = np.diag(noise.mean(0))
    n = len(v)

    def rank(x, share):
        x = np.sort(x)
        at = share * (n - 1)
        low = int(at)
        return x[low] + (x[min(low + 1, n - 1)] - x[low]) * (at - low)

    def moments(x):
        return x.mean(0), np.cov(x.T, bias=True)

    def far(m, c):
        z = np.linalg.solve(np.linalg.cholesky(c + base), (v - m).T)
        return (z**2).sum(0)

    med = np.median(v, 0)
    scale = np.sqrt((1.4826 * np.median(abs(v - med), 0)) ** 2 + np.diag(base))
    x = (v - med) / scale
    starts = [np.eye(robust.N), robust.N * np.cov((x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).T, bias=True), np.cov(np.tanh(x).T, bias=True)]
    found = []
    for k, c in enumerate(starts):
        m, c, before = med, c * np.outer(scale, scale), None
        while True:
            b = np.floor(np.log2(1 + far(m, c)) * 64)
            m, c = moments(v[b <= rank(b, robust.H)])
            det = np.linalg.slogdet(c + base)[1]
            found.append((det, k, m, c))
            if before is not None and before - det <= robust.TOLERANCE:
                break
            before = det
    _, _, m, c = min(found, key=lambda f: f[:2])
    b = np.floor(np.log2(1 + far(m, c)) * 64)
    half = 2 ** ((rank(b, 0.5) + 0.5) / 64) - 1
    m, c = moments(v[2 ** ((b + 0.5) / 64) - 1 <= half * robust.NEAR / robust.MEDIAN])
    c = c * robust.WHOLE
    out = []
    for row, own in zip(v, np.maximum(noise, np.diag(base) - np.diag(c)), strict=True):
        z = np.linalg.solve(np.linalg.cholesky(c + np.diag(own)), row - m)
        out.append(float(z @ z))
    return np.array(out), found


def test_estimate_equals_numpy(spark):
    df = spark.createDataFrame(plain(150, 3) + [(900 + i, "en", "a", 400, 1200, 150, 5, 40, 21, 200) for i in range(20)], STATS)
    got = np.array([r.distance for r in robust.robust_outliers(df).orderBy("doc_id").collect()])
    rows = robust.vectors(df).withColumns({f"w{i}": v for i, v in enumerate(robust.noise())}).orderBy("doc_id").collect()
    expected, found = brute(rows)
    assert np.allclose(got, expected, rtol=1e-6, atol=1e-6)
    # every start went down, and the winner is no worse than any
    assert len({k for _, k, _, _ in found}) == 3


def test_correlated_outliers_are_rejected_within_every_single_range(spark):
    """Long texts as varied as short ones: no statistic stands out by itself."""
    docs = plain(400, 5)
    odd = []
    for i in range(12):
        words = 1500 + i
        distinct = int(words**0.93)
        odd.append((1000 + i, "en", "a", words, words * 5, words * 5 // 900, 0, 0, words // 20 + 1, distinct))
    df = spark.createDataFrame(docs + odd, STATS)
    got = {r.doc_id: r for r in robust.robust_outliers(df).collect()}
    v = {r.doc_id: [getattr(r, f) for f in robust.FEATURES] for r in robust.vectors(df).collect()}
    clean = np.array([v[d[0]] for d in docs])
    low, high = clean.min(0), clean.max(0)
    inside = [i for i in range(1000, 1012) if (np.array(v[i]) >= low).all() and (np.array(v[i]) <= high).all()]
    assert len(inside) >= 8
    assert all(got[i].outlier for i in inside)
    # a rule for each statistic alone, at the same share of normal rows, rejects none of them
    med = np.median(clean, 0)
    mad = 1.4826 * np.median(abs(clean - med), 0) + 1e-9
    varied = [robust.FEATURES.index(f) for f in ("word_length", "variety", "length")]
    assert not any((abs((np.array(v[i]) - med) / mad)[varied] ** 2 > robust.CUT).any() for i in inside)
    assert sum(got[d[0]].outlier for d in docs) <= 4


def test_starts_in_a_cluster_of_outliers(spark):
    """A fifth of the rows lie together; the rest decides."""
    docs = plain(300, 8) + [(2000 + i, "en", "a", 300 + i, (300 + i) * 8, 300, 0, 0, 10, 150) for i in range(75)]
    got = {r.doc_id: r.outlier for r in robust.robust_outliers(spark.createDataFrame(docs, STATS)).collect()}
    assert all(got[2000 + i] for i in range(75))
    assert sum(got[i] for i in range(300)) <= 3


def test_statistics_on_which_all_agree(spark):
    """Rows alike in all statistics make no singular estimate: noise alone decides."""
    same = [(i, "en", "a", 200, 1000, 0, 0, 0, 10, 150) for i in range(100)]
    one = [(500, "en", "a", 200, 1000, 1, 0, 0, 10, 150), (501, "en", "a", 200, 1000, 300, 0, 0, 10, 150)]
    got = {r.doc_id: r for r in robust.robust_outliers(spark.createDataFrame(same + one, STATS)).collect()}
    assert got[0].distance == pytest.approx(0, abs=1e-9) and not got[500].outlier and got[501].outlier


def test_short_texts_scatter_more(spark):
    """The same share of symbols tells more of a long text than of a short one."""
    docs = plain(300, 2) + [(700, "en", "a", 60, 300, 6, 0, 0, 4, 46), (701, "en", "a", 2000, 10000, 200, 0, 0, 101, int(2000**0.868))]
    got = {r.doc_id: r.outlier for r in robust.robust_outliers(spark.createDataFrame(docs, STATS)).collect()}
    assert not got[700] and got[701]


def test_groups_have_their_own_estimates(spark):
    wordy = [(i + 5000, "de", "a", w, int(c * 1.6), s, d, r, n, k) for i, _, _, w, c, s, d, r, n, k in plain(200, 4)]
    docs = plain(200, 4) + wordy + [(9000, "en", "a", 300, 2400, 3, 0, 0, 16, 200), (9001, "de", "a", 300, 2400, 3, 0, 0, 16, 200), (9002, "de", "few", 300, 2400, 3, 0, 0, 16, 200), (9003, None, None, 300, 2400, 3, 0, 0, 16, 200)]
    got = {r.doc_id: r for r in robust.robust_outliers(spark.createDataFrame(docs, STATS)).collect()}
    assert got[9000].outlier and not got[9001].outlier
    # a small group has its language's estimate, a small language that of all
    assert got[9002].distance == pytest.approx(got[9001].distance, rel=0.2) and got[9003].distance is not None


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame(plain(150, 6), STATS)
    a = [r.distance for r in robust.robust_outliers(df.repartition(1)).orderBy("doc_id").collect()]
    b = [r.distance for r in robust.robust_outliers(df.repartition(7, F.rand(3))).orderBy("doc_id").collect()]
    assert np.allclose(a, b, rtol=1e-9)
