"""Quality rules and robust multivariate outliers, in DataFrame operations only.

Each text becomes a vector of six transformed statistics. For every language and
source the minimum-covariance-determinant estimate of their mean and covariance
is sought by concentration steps from three deterministic starts: the diagonal of
scaled median absolute deviations, the covariance of spatial signs, and that of
hyperbolic tangents. A step takes the h = 3/4 of the rows that lie nearest by
Mahalanobis distance and estimates anew from these; each start goes on until the
determinant stops falling, and the least determinant wins. Its covariance is made
consistent for normal data by the median distance, rows within the 0.975 quantile
of chi-squared give the last estimate, corrected for what that cuts off, and rows
beyond the 1 - ``TAIL`` quantile are rejected.

Statistics on which most rows agree would make a covariance singular, and short
texts scatter more than long ones. So every statistic has a sampling variance of
its own, that of a count of its size (``noise``): a group's mean of them is added
to its covariance in the steps, and a row's own to the covariance for its verdict,
where a spread below the group's mean noise counts as that noise.
Nothing is set by hand but the share h, the two quantiles and the least rows of a group.

Rows are never collected: each step is two aggregations by group and joins with
tables of one row per group and start, broadcast if there are few. Statistics are
rounded to 1/1024 and distances to 1/64 of a doubling, so that exact percentiles
hold a bounded number of distinct values for a group of any size and come out
alike for any partitioning.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ohmbridge.llm import common

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = ("word_length", "symbol_rate", "line_repeat", "word_repeat", "variety", "length")
N = len(FEATURES)
#: Share of a group's rows that the steps estimate from.
H = 0.75
#: A start is done when a step lowers the logarithm of the determinant by no more than this.
TOLERANCE = 1e-3
#: Groups of fewer rows share their language's estimate, and languages of fewer rows the estimate of all.
MIN_ROWS = 10 * N
#: Share of the rows of a normal group that is rejected.
TAIL = 1e-6
#: Estimates of at most so many groups (a row of some 250 bytes for each start) are broadcast.
BROADCAST_GROUPS = 50_000


def chi2_share(x: float, dof: int) -> float:
    """The share of chi-squared of an even number of degrees of freedom below ``x``."""
    terms = [1.0]
    for i in range(1, dof // 2):
        terms.append(terms[-1] * x / 2 / i)
    return 1 - math.exp(-x / 2) * sum(terms)


def chi2_quantile(share: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, dof) < share else (low, mid)
    return low


MEDIAN, NEAR, CUT = (chi2_quantile(x, N) for x in (0.5, 0.975, 1 - TAIL))
#: What makes the covariance of rows within ``NEAR`` that of all rows of a normal group.
WHOLE = 0.975 / chi2_share(NEAR, N + 2)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(p):
        twice = F.transform(p, lambda x, j: F.when((F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"]), x["i"]))
        return F.sort_array(F.filter(twice, lambda i: i.isNotNull()))

    def count(acc, i):
        end = i + F.lit(WINDOW)
        return F.struct((acc["n"] + end - F.greatest(acc["to"], i)).alias("n"), end.alias("to"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    return _let(pairs, lambda p: F.aggregate(places(p), start, count, lambda acc: acc["n"]))


def _repeat_words(found: Column) -> Column:
    """Words within five-word windows that occur twice or more, the first one included.

    Windows are compared by 64-bit hash within one text.
    """
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))

    def count(h):
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h))

    return F.when(F.size(found) <= WINDOW, F.lit(0)).otherwise(_let(windows(found), count))


def base_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The base statistics of each whole text, beside the columns ``keep``.

    A null text has no words. n_dup_lines counts lines with a word that equal an earlier line.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    return docs.select(
        *keep,
        _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words"), F.size(F.array_distinct(w)).cast("long").alias("d"))).alias("__w"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).cast("long").alias("n"))).alias("__l"),
    ).select(*keep, F.col("__w.n_words").alias("n_words"), "word_chars", "n_symbols", F.col("__l.dup").alias("n_dup_lines"), F.col("__w.n_repeat_words").alias("n_repeat_words"), F.col("__l.n").alias("n_lines"), F.col("__w.d").alias("n_distinct_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _grid(c: Column) -> Column:
    return F.round(c * 1024) / 1024


def vectors(stats: DataFrame) -> DataFrame:
    """Adds the transformed statistics; a text without words has zeros."""
    some = F.greatest(F.col("n_words"), F.lit(1))
    return stats.withColumns({
        "word_length": _grid(F.log1p(F.col("word_chars") / some)),
        "symbol_rate": _grid(F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)))),
        "line_repeat": _grid(F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)))),
        "word_repeat": _grid(F.sqrt(F.col("n_repeat_words") / some)),
        "variety": _grid(F.log1p("n_distinct_words") / F.log1p(some)),
        "length": _grid(F.log1p(F.col("n_words"))),
    })


def noise() -> list[Column]:
    """The sampling variance of each transformed statistic, in the order of FEATURES.

    The root of a share k / n of independent counts varies by 1 / 4n, the
    logarithm of a count k by 1 / k. Repeated words come by two windows at least.
    """
    chars, words, lines, distinct = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("word_chars", "n_words", "n_lines", "n_distinct_words"))
    again = F.col("n_words") - F.col("n_distinct_words") + 1
    return [1 / chars, 1 / (4 * chars), 1 / (4 * lines), 2 * WINDOW / (4 * words), again / (((distinct + 1) * F.log1p(words)) ** 2), 1 / words]


def _sum(terms) -> Column:
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def _factor(rows: DataFrame, diagonal: list[Column], last: list[Column] | None = None) -> DataFrame:
    """Adds l_i_j, the Cholesky factor of c_j_i with ``diagonal`` added, a column of it at a time.

    With ``last``, the vector that the factor is solved for, adds z_i too, in the same steps.
    """
    for j in range(N):
        at = F.sqrt(F.greatest(F.col(f"c_{j}_{j}") + diagonal[j] - _sum(F.col(f"l_{j}_{k}") ** 2 for k in range(j)), F.lit(1e-12)))
        rows = rows.withColumn(f"l_{j}_{j}", at)
        made = {f"l_{i}_{j}": (F.col(f"c_{j}_{i}") - _sum(F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j))) / F.col(f"l_{j}_{j}") for i in range(j + 1, N)}
        if last:
            made[f"z_{j}"] = (last[j] - _sum(F.col(f"l_{j}_{k}") * F.col(f"z_{k}") for k in range(j))) / F.col(f"l_{j}_{j}")
        if made:
            rows = rows.withColumns(made)
    return rows


def _square() -> Column:
    return _sum(F.col(f"z_{i}") ** 2 for i in range(N))


MEANS = [f"m_{i}" for i in range(N)]
SPREAD = [f"c_{i}_{j}" for i in range(N) for j in range(i, N)]
LOWER = [f"l_{i}_{j}" for i in range(N) for j in range(i + 1)]
NOISE = [f"v_{i}" for i in range(N)]


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2, by forward substitution through the factor l_i_j."""
    for i in range(N):
        rows = rows.withColumn(f"z_{i}", (F.col(FEATURES[i]) - F.col(f"m_{i}") - _sum(F.col(f"l_{i}_{k}") * F.col(f"z_{k}") for k in range(i))) / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", _square())


def _moments(rows: DataFrame, by: list[str], values: list[Column]) -> DataFrame:
    """(by, m_i, c_i_j): means and covariances of ``values``."""
    rows = rows.select(*by, *(v.alias(f"x_{i}") for i, v in enumerate(values)))
    sums = [F.avg(f"x_{i}").alias(f"m_{i}") for i in range(N)] + [F.avg(F.col(f"x_{i}") * F.col(f"x_{j}")).alias(f"s_{i}_{j}") for i in range(N) for j in range(i, N)]
    return rows.groupBy(*by).agg(*sums).select(*by, *MEANS, *((F.col(f"s_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")).alias(f"c_{i}_{j}") for i in range(N) for j in range(i, N)))


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(1 + d2) * 64)


def _of_bin(b: Column) -> Column:
    return F.pow(F.lit(2.0), (b + 0.5) / 64) - 1


def _few(table: DataFrame, groups: int) -> DataFrame:
    """A table of some rows for each group, broadcast if there are few groups."""
    return F.broadcast(table) if groups <= BROADCAST_GROUPS else table


def _starts(rows: DataFrame, groups: int) -> DataFrame:
    """(__g, start, m_i, c_i_j, v_i): medians and three covariances of each group, and its mean noise."""
    med = rows.groupBy("__g").agg(*(F.percentile(f, F.lit(0.5)).alias(f"m_{i}") for i, f in enumerate(FEATURES)), *(F.avg(v).alias(v) for v in NOISE))
    med = common.materialize(med, "mcd-medians")
    dev = rows.drop(*NOISE).join(_few(med, groups), "__g").groupBy("__g").agg(*(F.percentile(F.abs(F.col(f) - F.col(f"m_{i}")), F.lit(0.5)).alias(f"mad_{i}") for i, f in enumerate(FEATURES)))
    scale = med.join(_few(dev, groups), "__g").select("__g", *MEANS, *NOISE, *(F.sqrt((1.4826 * F.col(f"mad_{i}")) ** 2 + F.col(f"v_{i}")).alias(f"s_{i}") for i in range(N)))
    scale = common.materialize(scale, "mcd-scales")
    placed = rows.drop(*NOISE).join(_few(scale, groups), "__g").select("__g", *(((F.col(f) - F.col(f"m_{i}")) / F.col(f"s_{i}")).alias(f"x_{i}") for i, f in enumerate(FEATURES)))
    long = F.greatest(F.sqrt(_sum(F.col(f"x_{i}") ** 2 for i in range(N))), F.lit(1e-9))
    zero = F.lit(0.0)
    flat = scale.select("__g", F.lit(0).alias("start"), *((F.lit(1.0) if i == j else zero).alias(f"c_{i}_{j}") for i in range(N) for j in range(i, N)))
    signs = _moments(placed, ["__g"], [F.col(f"x_{i}") / long for i in range(N)]).select("__g", F.lit(1).alias("start"), *((F.col(c) * N).alias(c) for c in SPREAD))
    bent = _moments(placed, ["__g"], [F.tanh(f"x_{i}") for i in range(N)]).select("__g", F.lit(2).alias("start"), *SPREAD)
    every = flat.unionByName(signs).unionByName(bent)
    return every.join(_few(scale, groups), "__g").select("__g", "start", *MEANS, *NOISE, *((F.col(f"c_{i}_{j}") * F.col(f"s_{i}") * F.col(f"s_{j}")).alias(f"c_{i}_{j}") for i in range(N) for j in range(i, N)))


def _factored(est: DataFrame) -> DataFrame:
    """Estimates with the factor of their covariance and mean noise, and the logarithm of its determinant."""
    keys = [c for c in ("__g", "start") if c in est.columns]
    est = _factor(est, [F.col(v) for v in NOISE])
    return est.select(*keys, *MEANS, *SPREAD, *NOISE, *LOWER, (2 * _sum(F.log(f"l_{i}_{i}") for i in range(N))).alias("det"))


def estimates(rows: DataFrame, groups: int) -> DataFrame:
    """(__g, m_i, c_i_j, v_i): of each group the robust mean and covariance, and its mean noise.

    ``rows``: __g, the statistics, and their noise v_i; ``groups``: how many there are.
    """
    active = common.materialize(_factored(_starts(rows, groups)).withColumn("det", F.lit(None).cast("double")), "mcd")
    steps = []
    while True:
        far = _distance(rows.drop(*NOISE).join(_few(active, groups), "__g")).select("__g", "start", *FEATURES, _bin(F.col("d2")).alias("b"))
        cut = common.materialize(far.groupBy("__g", "start").agg(F.percentile("b", F.lit(H)).alias("cut")), "mcd-cuts")
        best = far.join(_few(cut, groups), ["__g", "start"]).where("b <= cut")
        made = _moments(best, ["__g", "start"], [F.col(f) for f in FEATURES])
        before = active.select("__g", "start", F.col("det").alias("before"))
        made = _factored(made.join(_few(active.select("__g", "start", *NOISE), groups), ["__g", "start"])).join(_few(before, groups), ["__g", "start"])
        made = common.materialize(made, "mcd")
        steps.append(made.drop("before"))
        active = made.where("before is null or before - det > " + repr(TOLERANCE)).drop("before")
        if active.isEmpty():
            break
    # the least determinant of all; of equal ones the earlier start
    found = reduce(DataFrame.unionByName, steps)
    least = found.groupBy("__g").agg(F.min_by(F.struct(*MEANS, *SPREAD, *NOISE, *LOWER), F.struct("det", "start")).alias("e")).select("__g", "e.*")
    least = common.materialize(least, "mcd")
    far = _distance(rows.drop(*NOISE).join(_few(least, groups), "__g")).select("__g", *FEATURES, _bin(F.col("d2")).alias("b"))
    half = common.materialize(far.groupBy("__g").agg(_of_bin(F.percentile("b", F.lit(0.5))).alias("half")), "mcd-cuts")
    near = far.join(_few(half, groups), "__g").where(_of_bin(F.col("b")) <= F.col("half") * F.lit(NEAR / MEDIAN))
    last = _moments(near, ["__g"], [F.col(f) for f in FEATURES]).select("__g", *MEANS, *((F.col(c) * WHOLE).alias(c) for c in SPREAD))
    return common.materialize(last.join(_few(least.select("__g", *NOISE), groups), "__g"), "mcd")


def robust_outliers(stats: DataFrame, group: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Adds distance (double, the squared Mahalanobis distance) and outlier (boolean).

    ``stats``: what base_statistics gives, with the two group columns. Rows that
    base_failed() rejects take no part in the estimates. Null groups are groups
    of their own; groups of fewer than MIN_ROWS rows that pass use their
    language's estimate, such languages that of all; without MIN_ROWS rows in
    all, and in groups none of whose rows pass, nothing is an outlier and
    distances are null. A statistic on which all rows of a group agree varies by
    its noise alone.
    """
    a, b = group
    rows = vectors(stats)
    good = rows.where(~base_failed())
    key = lambda *c: F.concat_ws("\u0001", *(F.coalesce(F.col(x).cast("string"), F.lit("\u0002")) for x in c))
    counts = good.groupBy(a, b).agg(F.count("*").alias("__n"))
    by_a = counts.groupBy(F.col(a).alias("__a")).agg(F.sum("__n").alias("__na"))
    every = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    if every < MIN_ROWS:
        return rows.withColumns({"distance": F.lit(None).cast("double"), "outlier": F.lit(False)})
    own = counts.join(by_a, F.col(a).eqNullSafe(F.col("__a"))).select(
        F.col(a).alias("__a"), F.col(b).alias("__b"),
        F.when(F.col("__n") >= MIN_ROWS, key(a, b)).when(F.col("__na") >= MIN_ROWS, key(a)).otherwise(F.lit("")).alias("__g"),
    )
    own = common.materialize(own, "mcd-groups")
    groups = own.count()
    # a group's rows feed its own estimate, its language's and the one of all, as far as some group needs them
    wide = {r[0] for r in own.select(F.when(F.col("__g") == "", 2).when(F.col("__g").contains("\u0001"), 0).otherwise(1)).distinct().collect()}
    levels = F.array(*([key(a, b)] if 0 in wide else []), *([key(a)] if 1 in wide else []), *([F.lit("")] if 2 in wide else []))
    feed = good.select(F.explode(levels).alias("__g"), *FEATURES, *(v.alias(f"v_{i}") for i, v in enumerate(noise())))
    # an estimate that no group uses is not made
    feed = common.materialize(feed.join(_few(own.select("__g").distinct(), groups), "__g", "left_semi"), "mcd-rows")
    est = estimates(feed, groups)
    placed = rows.join(_few(own, groups), rows[a].eqNullSafe(F.col("__a")) & rows[b].eqNullSafe(F.col("__b")), "left").drop("__a", "__b")
    placed = placed.join(_few(est, groups), "__g", "left")
    # a spread counts as the group's mean noise at least
    varies = [F.greatest(F.col(f"v_{i}") - F.col(f"c_{i}_{i}"), v) for i, v in enumerate(noise())]
    far = _factor(placed, varies, [F.col(f) - F.col(f"m_{i}") for i, f in enumerate(FEATURES)]).withColumn("distance", _square())
    return far.withColumn("outlier", F.coalesce(F.col("distance") > CUT, F.lit(False))).drop("__g", *MEANS, *SPREAD, *NOISE, *LOWER, *(f"z_{i}" for i in range(N)))


def quality_rules(docs: DataFrame, group: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Per row of ``docs``: doc_id, the group columns, the base statistics, base_failed, distance, outlier, kept.

    Null and empty texts have no words and fail. Each row is judged by itself,
    so repeated rows are judged alike; other columns are not read.
    """
    stats = common.materialize(base_statistics(docs, "doc_id", *group), "quality-statistics")
    rows = robust_outliers(stats, group)
    return rows.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~F.col("outlier"))


def op10_outliers(spark, sf_dir) -> DataFrame:
    rows = quality_rules(common.documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 3).alias("distance"))
