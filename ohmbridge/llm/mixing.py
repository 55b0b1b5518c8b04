"""Mixing sources to target weights by budgets that flow down a tree.

The tree is domain, language, source. A node's budget goes to its children in
proportion to their weights; a child that holds less than its share (its tokens
times the most epochs) is filled up, and what it leaves goes to its siblings in
proportion to theirs. A child's capacity is that of its whole subtree, so a
shortage leaves a subtree only when all of it is used up: siblings come before
ancestors.

A leaf's target is then so many whole epochs and the beginning of one more. Each
epoch has an order of its own, by md5 of seed, epoch and doc_id; of the last one
the shortest prefix that reaches the target is taken. Where that prefix ends is
found by sums over hash ranges, as many as the root of the leaf's rows, and one
sort of a single range, so no leaf, however hot, is sorted as a whole, and the
decision on a row is a comparison with its leaf's last hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmbridge.llm import common

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
EPOCHS = 4
#: A plan of at most so many leaves (a row of some 100 bytes each) is broadcast.
BROADCAST_LEAVES = 100_000
SEED = 17

#: The weights of the registered query: domains, languages in any domain; sources count alike.
DOMAIN_WEIGHTS = {"d0": 3.0, "d1": 2.0, "d2": 1.0}
LANG_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}


def domain_of(source: Column) -> Column:
    """The registered query's domain of a source: its number modulo three; d2 without a number."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]+)$", 1)
    return F.when(number == "", F.lit("d2")).otherwise(F.concat(F.lit("d"), F.pmod(F.substring(number, -9, 9).cast("long"), F.lit(3)).cast("string")))


def _weight(column: str, weights: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(float(w))).otherwise(out)
    return out


def share_budget(nodes: DataFrame, parent: tuple[str, ...]) -> DataFrame:
    """Adds ``share``: what each child of ``parent`` gets of ``budget``, by ``weight`` and within ``capacity``.

    Each round is one aggregation: children that hold no more than their share of
    what is left are full, and what they leave goes to the others, until no more
    become full. Children without weight get nothing.
    """
    nodes = common.materialize(nodes.withColumn("__full", F.lit(False)), "mix-nodes")
    while True:
        open_ = ~F.col("__full") & (F.col("weight") > 0)
        left = F.max("budget") - F.sum(F.when(F.col("__full"), F.col("capacity")).otherwise(F.lit(0.0)))
        level = nodes.groupBy(*parent).agg((left / F.nullif(F.sum(F.when(open_, F.col("weight")).otherwise(F.lit(0.0))), F.lit(0.0))).alias("__level"))
        placed = nodes.join(_small(level), list(parent)) if parent else nodes.crossJoin(F.broadcast(level))
        now = F.coalesce(open_ & (F.col("capacity") <= F.col("weight") * F.col("__level")), F.lit(False))
        placed = common.materialize(placed.withColumn("__now", now), "mix-nodes")
        if placed.where("__now").isEmpty():
            share = F.when(F.col("__full"), F.col("capacity")).when(F.col("weight") > 0, F.col("weight") * F.col("__level")).otherwise(F.lit(0.0))
            return placed.withColumn("share", share).drop("__full", "__level", "__now")
        nodes = placed.withColumn("__full", F.col("__full") | F.col("__now")).drop("__level", "__now")


def order_key(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def with_leaves(docs: DataFrame, domain: Column) -> DataFrame:
    """Adds __domain, __lang, __source (a null is the empty name) and __tokens, the number of words."""
    return docs.withColumns({
        "__domain": F.coalesce(domain, F.lit("")), "__lang": F.coalesce(F.col("lang"), F.lit("")), "__source": F.coalesce(F.col("source"), F.lit("")),
        "__tokens": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
    })


def plan(docs: DataFrame, domain: Column, budget: float, weights: dict[str, dict[str, float]], epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """One row for each leaf: domain, lang, source, n_docs, tokens, target, full (whole epochs), last_key.

    ``budget``: tokens wanted, as a share of all tokens of ``docs``; ``weights``:
    by level, by name; a name that is not there weighs 1. A weight of 0 leaves a
    name out, whatever lies below it; its siblings share what it would have had.
    """
    slim = common.materialize(with_leaves(docs, domain).select(F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), "doc_id", F.col("__tokens").alias("tokens")), "mix-rows")
    leaves = common.materialize(slim.groupBy(*LEVELS).agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("tokens")), "mix-leaves")
    # what is left out has no capacity, so that budgets do not flow there
    taken = reduce(lambda a, b: a & b, (_weight(x, weights.get(x, {})) > 0 for x in LEVELS))
    leaves = leaves.withColumn("capacity", F.when(taken, (F.col("tokens") * epochs).cast("double")).otherwise(F.lit(0.0)))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    nodes = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity")).withColumns({"budget": F.lit(float(total) * budget), "weight": _weight("domain", weights.get("domain", {}))})
    shares = share_budget(nodes, ()).select("domain", F.col("share").alias("budget"))
    nodes = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).join(shares, "domain").withColumn("weight", _weight("lang", weights.get("lang", {})))
    shares = share_budget(nodes, ("domain",)).select("domain", "lang", F.col("share").alias("budget"))
    nodes = leaves.join(shares, ["domain", "lang"]).withColumn("weight", _weight("source", weights.get("source", {})))
    target = F.floor(F.col("share") + 1e-6).cast("long")
    made = share_budget(nodes, ("domain", "lang")).select(*LEVELS, "n_docs", "tokens", target.alias("target"))
    made = made.withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.greatest(F.col("tokens"), F.lit(1)))).otherwise(0).cast("long"))
    made = made.withColumns({"rest": F.col("target") - F.col("full") * F.col("tokens"), "ranges": F.ceil(F.sqrt("n_docs"))})
    made = common.materialize(made, "mix-targets")
    # where the prefix of the last epoch ends: first the hash range, then the hash
    open_leaves = _small(made.where("rest > 0").select(*LEVELS, "full", "rest", "ranges"))
    keyed = slim.join(open_leaves, list(LEVELS)).withColumn("key", order_key(F.col("full") + 1, seed))
    keyed = keyed.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32) * F.col("ranges")))
    ranges = keyed.groupBy(*LEVELS, "range").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
    upto = ranges.withColumn("upto", F.sum("t").over(Window.partitionBy(*LEVELS).orderBy("range")))
    ends = common.materialize(upto.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("t") < F.col("rest"))).select(*LEVELS, "range", (F.col("upto") - F.col("t")).alias("before")), "mix-ranges")
    last = keyed.join(_small(ends), [*LEVELS, "range"])
    keys = last.groupBy(*LEVELS, "key").agg(F.sum("tokens").alias("t"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    keys = keys.withColumn("upto", F.col("before") + F.sum("t").over(Window.partitionBy(*LEVELS).orderBy("key")))
    # zero-token rows stand before the row that reaches the target, or not at all
    end = keys.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("t") < F.col("rest"))).select(*LEVELS, F.col("key").alias("last_key"))
    return common.materialize(made.join(end, list(LEVELS), "left").select(*LEVELS, "n_docs", "tokens", "target", "full", "last_key"), "mix-plan")


def _small(leaves: DataFrame) -> DataFrame:
    """Broadcast a table of leaves if it is small enough."""
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def with_copies(docs: DataFrame, domain: Column, made: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with __domain, __lang, __source, __tokens and __copies: how often the mixture takes each row."""
    leaf = _small(made.select(F.col("domain").alias("__domain"), F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.col("full").alias("__full"), F.col("last_key").alias("__last")))
    rows = with_leaves(docs, domain).join(leaf, ["__domain", "__lang", "__source"])
    more = F.coalesce(order_key(F.col("__full") + 1, seed) <= F.col("__last"), F.lit(False)).cast("long")
    return rows.withColumn("__copies", F.col("__full") + more).drop("__full", "__last")


def mix(docs: DataFrame, budget: float, weights: dict[str, dict[str, float]], domain: Column | None = None, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixture of ``docs``: its columns, each row as often as it is taken.

    Nulls of lang or source are a language or source of their own; a row without
    a doc_id is ordered as if its id were empty. Rows of one id and leaf are
    taken together. Rows without words cost nothing and come and go with their
    place in the order; a leaf without words, like an empty table, gives nothing.
    Columns of any name are kept.
    """
    given = docs.columns
    # this module's own columns begin with two underscores
    own = [c for c in given if c.startswith("__")]
    docs = docs.withColumnsRenamed(dict(zip(own, common.free_names(given, *(f"c{i}" for i in range(len(own)))), strict=True)))
    domain = domain_of(F.col("source")) if domain is None else domain
    rows = with_copies(docs, domain, plan(docs, domain, budget, weights, epochs, seed), seed).where("__copies > 0")
    if epochs > 1:
        rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    return rows.select(*docs.columns).toDF(*given)


WEIGHTS = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}


def op2_mixing(spark, sf_dir) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    domain = domain_of(F.col("source"))
    rows = with_copies(docs, domain, plan(docs, domain, 1.0, WEIGHTS))
    return rows.select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), F.col("__tokens").alias("n_tokens"), F.col("__copies").alias("copies"))


def _share_sql(nodes: str, parent: str, child: str, name: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    order = f"{by} ORDER BY capacity / weight, {child}"
    return f"""
{name}_a AS (
    SELECT *, budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
           sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w FROM ({nodes})
), {name}_b AS (
    SELECT *, capacity * w <= weight * left_over AS is_full FROM {name}_a
), {name} AS (
    SELECT *, CASE WHEN is_full THEN capacity ELSE weight * ((budget - coalesce(sum(CASE WHEN is_full THEN capacity END) OVER ({by}), 0))
           / sum(CASE WHEN NOT is_full THEN weight END) OVER ({by})) END AS share FROM {name}_b
)"""


def _weight_sql(column: str, weights: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in weights.items()) + " ELSE 1.0::DOUBLE END"


OP2_SQL = rf"""
WITH slim AS (
    SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'd2'
           ELSE 'd' || (right(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), 9)::BIGINT % 3) END AS domain,
           coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
    FROM documents
), leaves AS (
    SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, (sum(tokens) * {EPOCHS})::DOUBLE AS capacity FROM slim GROUP BY ALL
), {_share_sql(f"SELECT domain, sum(capacity) AS capacity, (SELECT sum(tokens)::DOUBLE FROM leaves) AS budget, {_weight_sql('domain', DOMAIN_WEIGHTS)} AS weight FROM leaves GROUP BY domain", "", "domain", "dom")},
{_share_sql(f"SELECT l.domain, l.lang, sum(l.capacity) AS capacity, any_value(dom.share) AS budget, {_weight_sql('l.lang', LANG_WEIGHTS)} AS weight FROM leaves l JOIN dom ON l.domain = dom.domain GROUP BY l.domain, l.lang", "domain", "lang", "lng")},
{_share_sql("SELECT l.domain, l.lang, l.source, l.tokens, l.capacity, lng.share AS budget, 1.0::DOUBLE AS weight FROM leaves l JOIN lng ON l.domain = lng.domain AND l.lang = lng.lang", "domain, lang", "source", "src")},
targets AS (
    SELECT domain, lang, source, floor(share + 1e-6)::BIGINT AS target, CASE WHEN tokens > 0 THEN floor(floor(share + 1e-6) / tokens)::BIGINT ELSE 0 END AS full_epochs, tokens AS leaf_tokens FROM src
), keyed AS (
    SELECT s.*, t.full_epochs, t.target - t.full_epochs * t.leaf_tokens AS rest, md5('{SEED}:' || (t.full_epochs + 1) || ':' || coalesce(s.doc_id::VARCHAR, '')) AS k
    FROM slim s JOIN targets t ON s.domain = t.domain AND s.lang = t.lang AND s.source = t.source
), ordered AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed
)
SELECT doc_id, domain, lang, source, tokens AS n_tokens, full_epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS copies FROM ordered
"""
