"""Near-duplicate documents by MinHash, with odd sketches for the candidates.

1. Each text's distinct five-word shingles give 240 MinHash samples. 48 bands of
   five samples become bucket keys; all samples fold into an odd sketch, a bitmap
   of the parity of how many samples fall on each of 1024 positions.
2. Texts of equal shingle sets are one class, with its least doc_id for it.
3. Each class of a bucket meets the bucket's hub, the class with the most
   bucket-mates in all: for edited copies, that is the text they come from. What
   links a family is found here, by one pair for each class and hub. Only buckets
   that then still hold several components are looked at again: the classes of a
   hub are packed into blocks of ``BLOCK_BYTES``, sorted by component, and blocks
   meet each other; sketches and then full sets are compared within the task, and
   only links leave it. Nothing is capped and no link is lost.
4. A pair whose sketches differ in so many bits that the estimate lies below
   ``SKETCH_LEAST`` is dropped: at similarity 0.75 that takes four standard
   deviations. All others are confirmed on full shingle sets.
5. Confirmed links give connected components.

A pair of similarity 0.75 shares no bucket with probability (1 - 0.75**5)**48, about 2e-6.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ohmbridge.llm import common, textkernel as tk
from ohmbridge.operators.graph import connected_components as components

SIZE = 5
BANDS, ROWS = 48, 5
SAMPLES = BANDS * ROWS
BITS = 1024
#: Confirmed where 100 * intersection >= PERCENT * union.
PERCENT = 75
SKETCH_LEAST = 0.58
_U = np.uint64
_rng = np.random.default_rng(424243)
_XOR = _rng.integers(0, 2**63, SAMPLES, dtype=np.uint64) * _U(2) + _rng.integers(0, 2, SAMPLES, dtype=np.uint64)
_MUL = _rng.integers(0, 2**63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the SAMPLES permutations over distinct shingles (at least one)."""
    out = None
    for a in range(0, len(shingles), 512):
        low = ((shingles[a : a + 512, None] ^ _XOR) * _MUL).min(0)
        out = low if out is None else np.minimum(out, low)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """A row of BITS / 64 words for each row of samples."""
    n = len(samples)
    place = (tk.mix(samples + np.arange(SAMPLES, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) % _U(BITS)).astype(np.int64)
    odd = np.bincount((place + np.arange(n)[:, None] * BITS).ravel(), minlength=n * BITS).reshape(n, BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def sketch_distance(similarity: float) -> int:
    """The number of differing bits that sets of this similarity are expected to have."""
    return int(BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - similarity) / BITS)))


def sketch_similarity(differing):
    """The similarity that a number of differing bits estimates."""
    return 1 + BITS / (4 * SAMPLES) * F.log(F.greatest(1 - 2 * differing / F.lit(float(BITS)), F.lit(1e-9)))


def _sets(column: pa.Array) -> list[np.ndarray]:
    buf, off = tk.string_buffer(column)
    hashes, _, woff = tk.words(buf, off)
    s, soff = tk.shingles(hashes, woff, SIZE)
    out = []
    for a, b in zip(soff[:-1], soff[1:], strict=True):
        x = np.sort(s[a:b])
        out.append(x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, bands, odd): s1 and s2 stand for the set; bands and odd are null without shingles."""
    common.tune(docs.sparkSession)

    def run(batches):
        for batch in batches:
            sets = _sets(batch.column(1))
            n = np.array([len(x) for x in sets], np.int64)
            some = np.flatnonzero(n)
            samples = np.stack([min_hashes(sets[i]) for i in some]) if len(some) else np.zeros((0, SAMPLES), np.uint64)
            keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(some), BANDS)).copy()
            parts = samples.reshape(-1, BANDS, ROWS)
            for k in range(ROWS):
                keys = tk.mix(keys * _U(0x9FB21C651E98DF25) + parts[:, :, k])
            odd = odd_sketches(samples)
            fill = lambda x: pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, x.shape[1], 0)))).astype(np.int32), mask=np.concatenate((n == 0, [False]))), pa.array(x.view(np.int64).ravel()))
            s1 = np.array([tk.mix(x).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
            s2 = np.array([tk.mix(x ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(s1), pa.array(s2), fill(keys), fill(odd)], names=["doc_id", "n_shingles", "s1", "s2", "bands", "odd"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>, odd array<bigint>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(id, shingles): the sorted distinct 64-bit shingle hashes of each text, as bytes."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in _sets(batch.column(1))], pa.binary())], names=["id", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "id bigint, shingles binary")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int(np.count_nonzero(y[at] == x))
    return 100 * both >= percent * (len(x) + len(y) - both)


#: Pairs of one hub that one part of a stream holds, on average.
PART_ROWS = 2000


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    A set a with many partners is dealt to several tasks by b. In each it comes
    once, before its partners' sets, which stream past it one by one.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    parts = common.materialize(parts, "near-parts")
    few = F.broadcast(parts) if parts.count() <= BROADCAST_HUBS else parts
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    mine = pairs.join(few, "a").select("a", "b", part.alias("part")).join(sets.select(F.col("id").alias("b"), "shingles"), "b").select("a", "part", "b", "shingles")
    hubs = parts.join(sets.select(F.col("id").alias("a"), "shingles"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("bigint").alias("b"), "shingles")
    stream = hubs.unionByName(mine).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").isNotNull())

    def run(batches):
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            out_a, out_b = [], []
            for a, b, x in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                here = np.frombuffer(x.as_buffer(), np.uint64)
                if b is None:
                    hub = here.copy()
                elif _similar(hub, here, percent):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return stream.mapInArrow(run, "a bigint, b bigint")


#: Hubs whose numbers of parts (12 bytes each) are broadcast at most.
BROADCAST_HUBS = 1_000_000
#: A block's sets, with 8 KiB counted for each class besides: 256 classes at most.
BLOCK_BYTES = 2 << 20


def _block_links(named: DataFrame, sets: DataFrame, odd: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of one hub that are in different components.

    ``named``: hub, id, n (set size), c (component), up (more central hubs). A
    pair is compared under the most central hub that both have.
    """
    # the set sizes alone decide the blocks. Ids are dealt by ranges, so a hub's lie in several tasks;
    # a running sum within each and the sums of those before it give the place
    size = F.col("n") * 8 + 8192
    ranged = common.materialize(named.repartitionByRange("hub", "c", "id").withColumn("p", F.spark_partition_id()), "near-ranged")
    sums = ranged.groupBy("hub", "p").agg(F.sum(size).alias("s"))
    # one row for each hub and task
    sums = sums.withColumn("before", F.sum("s").over(Window.partitionBy("hub").orderBy("p")) - F.col("s")).drop("s")
    place = Window.partitionBy("hub", "p").orderBy("c", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = ranged.withColumn("upto", F.sum(size).over(place)).join(sums, ["hub", "p"]).withColumn("block", F.floor((F.col("before") + F.col("upto")) / BLOCK_BYTES)).drop("p", "upto", "before")
    full = cut.join(sets, "id").join(odd, "id")
    # a single set can be larger than a block; then it is a block of its own
    blocks = full.groupBy("hub", "block").agg(F.collect_list(F.struct("id", "c", "n", "up", "shingles", "odd")).alias("rows"), F.min("c").alias("c0"), F.max("c").alias("c1"))
    blocks = common.materialize(blocks, "near-blocks")
    slim = blocks.select("hub", "block", "c0", "c1")
    x, y = (slim.select("hub", *(F.col(k).alias(f"{s}_{k}") for k in ("block", "c0", "c1"))) for s in "xy")
    apart = (F.col("x_block") <= F.col("y_block")) & ((F.col("x_c0") != F.col("y_c1")) | (F.col("x_c1") != F.col("y_c0")))
    # which blocks meet is settled by their numbers; rows then come to each pair of blocks, wherever its task is
    met = x.join(y, "hub").where(apart).select("hub", "x_block", "y_block")
    rows = lambda s: blocks.select("hub", F.col("block").alias(f"{s}_block"), F.col("rows").alias(f"{s}_rows"))
    # few block pairs in a batch: each may hold some MB
    pairs = met.join(rows("x"), ["hub", "x_block"]).join(rows("y"), ["hub", "y_block"]).select("x_rows", "y_rows", (F.col("x_block") == F.col("y_block")).alias("same"))
    most = sketch_distance(SKETCH_LEAST)

    def unpack(rows: pa.Array, n: int):
        r = rows.slice(n, 1).flatten()
        odd = r.field("odd").flatten().to_numpy(zero_copy_only=False).reshape(len(r), -1).view(np.uint64)
        sets_ = [np.frombuffer(v.as_buffer(), np.uint64) for v in r.field("shingles")]
        return r.field("id").to_numpy(), r.field("c").to_numpy(), r.field("n").to_numpy(), [set(v) for v in r.field("up").to_pylist()], sets_, odd

    def run(batches):
        for batch in batches:
            a, b = [], []
            for n in range(batch.num_rows):
                i1, c1, n1, u1, s1, o1 = unpack(batch.column(0), n)
                i2, c2, n2, u2, s2, o2 = unpack(batch.column(1), n)
                same = batch.column(2)[n].as_py()
                for k in range(len(i1)):
                    ok = (c2 != c1[k]) & (100 * np.minimum(n2, n1[k]) >= percent * np.maximum(n2, n1[k]))
                    if same:
                        ok[: k + 1] = False
                    at = np.flatnonzero(ok)
                    if not len(at):
                        continue
                    at = at[np.bitwise_count(o2[at] ^ o1[k]).sum(1) <= most]
                    for j in at.tolist():
                        if u1[k] & u2[j]:
                            continue
                        if _similar(s1[k], s2[j], percent):
                            a.append(min(i1[k], i2[j]))
                            b.append(max(i1[k], i2[j]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least doc_id reachable), kept.

    A null text or one without words has no shingles and is linked with nothing.
    A row without a doc_id is linked with nothing, its component_id is null and
    it is kept. Rows of one doc_id with equal texts come out alike; with unlike
    texts, each goes with its own text. Columns other than doc_id and text are
    not read.
    """
    sig = common.materialize(signatures(docs), "near-signatures")
    some = sig.where("n_shingles > 0 and doc_id is not null")
    classes = common.materialize(some.groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = some.join(classes.select(F.col("rep").alias("doc_id"), "n_shingles", "s1", "s2"), ["doc_id", "n_shingles", "s1", "s2"], "left_semi").select("doc_id", "n_shingles", "bands", "odd")
    rows = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    # counts and hubs of buckets are sums and maxima, made before rows move: a bucket of any size is no single task
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = common.materialize(rows.join(sizes, "key"), "near-buckets")
    mates = shared.groupBy("id").agg(F.sum("size").alias("mates"))
    ranked = common.materialize(shared.drop("size").join(mates, "id"), "near-mates")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("mates", (-F.col("id")).alias("low"), "n")).alias("h")).select("key", (-F.col("h.low")).alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.mates").alias("hub_mates"))
    placed = ranked.select("key", "id", "n").join(hubs, "key")
    placed = common.materialize(placed, "near-hubs")
    ids = shared.select("id").distinct()
    sets = common.materialize(shingle_sets(docs.where("doc_id is not null").join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])), "near-sets")
    odd = common.materialize(reps.join(ids, F.col("doc_id") == F.col("id"), "left_semi").select(F.col("doc_id").alias("id"), "odd"), "near-sketches")
    most = sketch_distance(SKETCH_LEAST)
    near = lambda a, b: F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)

    def links(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.join(odd.select(F.col("id").alias("a"), F.col("odd").alias("x")), "a").join(odd.select(F.col("id").alias("b"), F.col("odd").alias("y")), "b")
        differing = F.aggregate(F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, v: acc + v)
        close = common.materialize(both.where(differing <= most).select("a", "b"), name + "-close")
        return common.materialize(_confirm(close, sets, percent), name)

    members = placed.where("id <> hub")
    star = members.where(near(F.col("n"), F.col("hub_n"))).select(F.col("hub").alias("a"), F.col("id").alias("b"))
    found = links(star.distinct(), "near-links")
    comp = common.materialize(components(found), "near-components")
    # only buckets that hold classes of several components beside the hub can still have links
    named = members.join(comp.select("id", "component"), "id", "left").select("key", "hub", "hub_mates", "id", "n", F.coalesce("component", "id").alias("c"))
    named = common.materialize(named, "near-named")
    mixed = named.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("key")
    open_ = named.join(mixed, "key").select("hub", "hub_mates", "id", "n", "c").distinct()
    # a class has at most BANDS hubs; ``up`` lists those of its hubs that are more central than the row's
    above = Window.partitionBy("id").orderBy(F.desc("hub_mates"), "hub").rowsBetween(Window.unboundedPreceding, -1)
    named = open_.withColumn("up", F.collect_list("hub").over(above)).drop("hub_mates")
    more = common.materialize(_block_links(named, sets, odd, percent), "near-links")
    if not more.isEmpty():
        comp = common.materialize(components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)), "near-components")
    name = classes.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left").select("n_shingles", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = sig.select("doc_id", "n_shingles", "s1", "s2").join(name, ["n_shingles", "s1", "s2"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.cast("long").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1_near_duplicates(spark, sf_dir) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir))


OP1_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), h AS (
    SELECT doc_id, hash(g) AS g FROM s
), both_in AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM h a JOIN h b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
    SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), e AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT doc_id AS id, doc_id AS top FROM documents
    UNION
    SELECT e.b, reach.top FROM reach JOIN e ON e.a = reach.id AND reach.top < e.b
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(top) AS component_id, d.doc_id = min(top) AS kept
FROM documents d JOIN reach ON reach.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""
