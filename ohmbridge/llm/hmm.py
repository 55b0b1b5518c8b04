"""Hidden Markov language model over words, trained by Baum-Welch across partitions.

Counts of all training words come first, by 64-bit word hash: they give the
unigram base score. Texts are then written once as ids of the ``EMITTED`` most
frequent words, with the hashes of all other words in order beside them, and a
random projection of their word counts. Hidden states start from clusters of all
training texts. Each Baum-Welch step runs the scaled forward and backward
recursions over every training text where it lies and adds up expected counts in
one aggregation, until the likelihood stops rising. In these steps the states
share out the probability of all other words together, in proportion to the
words' counts. One more step over all texts then gathers the states' expected
counts of every word by itself, in a table by word hash that grows with the input.
A last pass gives each text its exact log-likelihood by the scaled forward recursion.

What is broadcast is bounded: counts and emissions of the ``EMITTED`` most frequent
words in the steps, of the ``KEPT`` most frequent for the scores. All others join
from their table, by the texts' distinct words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmbridge.llm import common, textkernel as tk

STATES = 8
#: Clusters and Baum-Welch stop when a round raises the likelihood by no more than this share of it.
TOLERANCE = 1e-4
#: Places of the random projection of a text's words: each word adds one, with a sign, to the place of its hash.
PLACES = 64
#: Texts of a task of a clustering step, on average and at least.
CLUSTER_TASK = 100_000
#: Words whose counts and emissions are broadcast for the scores, and in the steps. The others join.
KEPT, EMITTED = 500_000, 65_536
#: Prior weight of the unigram shares in a state's emissions, and of even transitions.
PRIOR, EVEN = 2000.0, 5.0
#: Tokens that one recursion runs over together, unless a single text has more.
TOGETHER = 500_000
#: Tokens of the pool that such runs are taken from.
POOL = 2_000_000
#: Tokens of a task of a step, on average and at least: each task sends its sums of the vocabulary's words.
TASK = 4_000_000


def held_out(doc_id):
    return F.coalesce(common.crc_mod(doc_id, 7) == 2, F.lit(False))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets per text)."""
    h, _, woff = tk.words(*tk.string_buffer(column))
    return h, woff


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n): how often each word occurs in ``docs``."""
    common.tune(docs.sparkSession)

    def run(batches):
        held: list[pd.DataFrame] = []
        size = 0

        def reduce():
            return pd.concat(held).groupby("h", sort=False).agg({"n": "sum"}).reset_index()

        for batch in batches:
            inv, uniq = pd.factorize(tokens(batch.column(0))[0])
            held.append(pd.DataFrame({"h": uniq.view(np.int64), "n": np.bincount(inv, minlength=len(uniq))}))
            size += len(uniq)
            if size > 700_000:
                held = [reduce()]
                size = len(held[0]) if len(held[0]) < 350_000 else 0
                if not size:
                    yield pa.RecordBatch.from_pandas(held.pop(), preserve_index=False)
        if held:
            yield pa.RecordBatch.from_pandas(reduce(), preserve_index=False)

    return docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Sorted hashes and counts of the most frequent words; a word's id is its place, the end's the place after the last.

    ``far``: how often training texts have the words that are not here.
    """

    def __init__(self, h: np.ndarray, n: np.ndarray, texts: int, total: int, distinct: int):
        by = np.argsort(h)
        self.h, self.n, self.texts = h[by], n[by], texts
        self.far = total - int(n.sum())
        #: all training tokens, ends included, and the distinct ones
        self.total, self.distinct = total + texts, distinct + (texts > 0)

    @property
    def size(self) -> int:
        return len(self.h) + 1

    def base(self, n):
        return (n + 1.0) / (self.total + self.distinct + 1.0)

    def unigram(self) -> np.ndarray:
        return self.base(np.concatenate((self.n, [self.texts])))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids; of words that are not here, -1."""
        inv, uniq = pd.factorize(h)
        out = np.full(len(uniq), -1)
        if len(self.h):
            at = np.minimum(np.searchsorted(self.h, uniq), len(self.h) - 1)
            hit = self.h[at] == uniq
            out[hit] = at[hit]
        return out[inv]


class Layout:
    """Token ids of several texts in time-major order, longest text first; each ends with the end token."""

    def __init__(self, ids: np.ndarray, woff: np.ndarray, end: int):
        size = np.diff(woff) + 1
        self.order = np.argsort(-size, kind="stable")
        sorted_size = size[self.order]
        steps = int(sorted_size[0])
        # active[t]: texts with more than t tokens
        self.active = len(size) - np.searchsorted(sorted_size[::-1], np.arange(steps), "right")
        self.at = np.concatenate(([0], np.cumsum(self.active)))
        full = np.full(int(size.sum()), end, np.int64)
        new_off = woff + np.arange(len(woff))
        word_place = np.arange(len(ids)) + np.repeat(np.arange(len(size)), size - 1)
        full[word_place] = ids
        rank = np.empty(len(size), np.int64)
        rank[self.order] = np.arange(len(size))
        time = np.arange(len(full)) - np.repeat(new_off[:-1], size)
        self.ids = np.empty_like(full)
        self.ids[self.at[time] + np.repeat(rank, size)] = full


class Hmm:
    """Start shares (S), transitions (S x S) and emissions by word (V x S); weight: what emissions were divided by (S)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, weight: np.ndarray | None = None):
        self.start, self.move, self.emit, self.weight = start, move, np.ascontiguousarray(emit), weight

    def single(self) -> Hmm:
        """The model in single precision, for the steps."""
        return Hmm(*(np.ascontiguousarray(x, np.float32) for x in (self.start, self.move, self.emit)), self.weight)

    def forward(self, lay: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scaled forward values, emissions, scales) of all tokens."""
        e = self.emit[lay.ids]
        alpha, scale = np.empty_like(e), np.empty(len(e), e.dtype)
        at, move = lay.at.tolist(), self.move
        now = self.start * e[: at[1]]
        for t in range(len(at) - 1):
            a, b = at[t], at[t + 1]
            if t:
                now = now[: b - a] @ move
                now *= e[a:b]
            c = now.sum(1)
            now /= c[:, None]
            alpha[a:b] = now
            scale[a:b] = c
        return alpha, e, scale

    def log10_likelihood(self, lay: Layout) -> np.ndarray:
        """Of each text, in the order it was given in."""
        out, ids, at, now = np.zeros(len(lay.order)), lay.ids, lay.at.tolist(), self.start
        for t in range(len(at) - 1):
            a, b = at[t], at[t + 1]
            now = (now[: b - a] @ self.move if t else now) * self.emit[ids[a:b]]
            c = now.sum(1)
            now /= c[:, None]
            out[: b - a] += np.log10(c)
        back = np.empty_like(out)
        back[lay.order] = out
        return back

    def expected(self, lay: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts: starts, moves, and the states' shares of each token."""
        return self.expected_and_log(lay)[:3]

    def expected_and_log(self, lay: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """``expected``, and the natural logarithm of all texts' likelihood."""
        alpha, e, scale = self.forward(lay)
        e /= scale[:, None]
        moves = np.zeros(self.move.shape)
        at, back_move = lay.at.tolist(), np.ascontiguousarray(self.move.T)
        beta = np.ones((at[-1] - at[-2], e.shape[1]), e.dtype)
        for t in range(len(at) - 2, 0, -1):
            a, b, z = at[t - 1], at[t], at[t + 1]
            up = e[b:z] * beta
            moves += alpha[a : a + z - b].T @ up
            alpha[b:z] *= beta
            nxt = np.ones((b - a, e.shape[1]), e.dtype)
            nxt[: z - b] = up @ back_move
            beta = nxt
        alpha[: at[1]] *= beta
        return alpha[: at[1]].sum(0, dtype=float), moves * self.move, alpha, float(np.log(scale).sum(dtype=float))


def directions(h: np.ndarray, woff: np.ndarray) -> np.ndarray:
    """Unit vectors of the texts' word counts, projected to PLACES."""
    n = len(woff) - 1
    text = np.repeat(np.arange(n), np.diff(woff))
    sign = 1.0 - 2.0 * (h >> np.uint64(63)).astype(float)
    x = np.bincount(text * PLACES + (h % np.uint64(PLACES)).astype(np.int64), sign, n * PLACES).reshape(n, PLACES)
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A row of bytes for each range of ``values``: lists of numbers cross to Spark and back as they lie."""
    at = pa.py_buffer((offsets * values.itemsize).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _unpacked(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of rows of bytes."""
    raw, off = tk.string_buffer(column)
    return np.ascontiguousarray(raw).view(dtype), off // np.dtype(dtype).itemsize


def token_rows(docs: DataFrame, voc: Vocabulary) -> DataFrame:
    """(row, doc_id, held, size, ids, far, v): the number of words; ids by ``voc``, 32 bits each, where the id after the end's stands for any other word; the hashes of those in order; and the text's direction."""
    common.tune(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(voc)

    def run(batches):
        voc = held.value
        for batch in batches:
            h, woff = tokens(batch.column(3))
            ids = voc.find(h)
            far = np.flatnonzero(ids < 0)
            ids[far] = voc.size
            x = directions(h, woff)
            lists = [_packed(ids.astype(np.int32), woff), _packed(h[far], np.searchsorted(far, woff)), _packed(x.ravel(), np.arange(len(x) + 1) * PLACES)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(woff)), *lists], names=["row", "doc_id", "held", "size", "ids", "far", "v"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), "text")
    return common.materialize(rows.mapInArrow(run, "row bigint, doc_id bigint, held boolean, size bigint, ids binary, far binary, v binary"), "hmm-rows", compression="zstd")


def _matrix(column: pa.Array) -> np.ndarray:
    return _unpacked(column, np.float32)[0].reshape(-1, PLACES).astype(float)


def clusters(rows: DataFrame, states: int) -> np.ndarray:
    """Centres of spherical k-means over the directions ``v`` of all rows, from far-apart ones; each step is one pass."""
    spark = rows.sparkSession
    # many small tasks would cost more than their work
    texts = rows.select("v", "size").coalesce(max(spark.sparkContext.defaultParallelism, rows.count() // CLUSTER_TASK))
    centre = np.zeros((0, PLACES))
    for _ in range(states):

        def farthest(batches, centre=centre):
            best = None
            for batch in batches:
                x, size = _matrix(batch.column(0)), batch.column(1).to_numpy()
                # the next centre lies far from the others, but is no lone short text
                far = (1 - (x @ centre.T).max(1)) * np.minimum(1, size / 100) if len(centre) else size.astype(float)
                if len(far):
                    ties = [(float(far[i]), x[i].tobytes()) for i in np.flatnonzero(far == far.max())[:1]] if len(centre) else [max((float(far[i]), x[i].tobytes()) for i in np.flatnonzero(far == far.max()))]
                    best = max(*ties, *([best] if best else []), (-1.0, b""))
            if best:
                yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.binary())], names=["far", "x"])

        got = texts.mapInArrow(farthest, "far double, x binary").agg(F.max(F.struct("far", "x")).alias("m")).first().m
        centre = np.concatenate((centre, [np.frombuffer(bytes(got.x))]))
    before = -1.0
    while True:
        held = spark.sparkContext.broadcast(centre)

        def assign(batches, held=held):
            sums, close = np.zeros((states, PLACES)), 0.0
            for batch in batches:
                x = _matrix(batch.column(0))
                near = x @ held.value.T
                sums += np.eye(states)[near.argmax(1)].T @ x
                close += near.max(1).sum() if len(x) else 0.0
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, states * PLACES)), pa.array(np.concatenate(([close], sums.ravel())))], names=["at", "v"])

        table = texts.mapInArrow(assign, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").toArrow()
        held.destroy()
        v = table.column("v").to_numpy()
        if v[0] - before <= TOLERANCE * abs(v[0]):
            return centre
        before, sums = v[0], v[1:].reshape(states, PLACES)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centre)


def least_count(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach."""
    # how many words occur n times; counts above a million are one
    top = 1 << 20
    often = np.array([tuple(r) for r in counts.groupBy(F.least("n", F.lit(top)).alias("n")).agg(F.count("*")).orderBy("n").collect()], np.int64).reshape(-1, 2)
    fits = np.flatnonzero(often[::-1, 1].cumsum()[::-1] <= most)
    return int(often[fits[0], 0]) if len(fits) else top + 1


def vocabulary(counts: DataFrame, texts: int, kept: int = KEPT, emitted: int = EMITTED) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    table = counts.where(F.col("n") >= least_count(counts, min(kept, emitted))).select("h", "n").toArrow()
    return Vocabulary(table.column("h").to_numpy().view(np.uint64), table.column("n").to_numpy(), texts, total, distinct)


def _groups(batches, ids: int):
    """Batches of at most TOGETHER tokens in the column ``ids``, of texts of like lengths, from pools of POOL tokens: one long text among short ones would cost its many steps alone."""
    held, size = [], 0

    def cut():
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        many = pa.compute.binary_length(batch.column(ids)).to_numpy() // 4
        by = np.argsort(-many, kind="stable")
        batch, off = batch.take(pa.array(by)), np.concatenate(([0], np.cumsum(many[by])))
        a = 0
        while a < batch.num_rows:
            b = min(max(a + 1, int(np.searchsorted(off, off[a] + TOGETHER, "right")) - 1), batch.num_rows)
            yield batch.slice(a, b - a)
            a = b

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += pa.compute.sum(pa.compute.binary_length(batch.column(ids))).as_py() // 4
        if size >= POOL:
            yield from cut()
            held, size = [], 0
    if held:
        yield from cut()


#: Parts that a share of a word's expected count is given in.
PARTS = 65535


def _out(far: bool, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """Expected counts by state as their sum and shares of 16 bits, four to a number."""
    m = rows.sum(1, dtype=float)
    q = np.rint(rows / np.where(m == 0, 1, m)[:, None] * PARTS).astype(np.uint64)
    packed = [sum((q[:, k] << np.uint64(16 * (k % 4)) for k in range(a, min(a + 4, q.shape[1]))), np.zeros(len(q), np.uint64)) for a in range(0, q.shape[1], 4)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), far)), pa.array(ids), pa.array(m), *(pa.array(p.view(np.int64)) for p in packed)], names=["far", "id", "m", *(f"p{j}" for j in range(len(packed)))])


def _schema(states: int) -> str:
    return "far boolean, id bigint, m double, " + ", ".join(f"p{j} bigint" for j in range(-(-states // 4)))


def _summed(found: DataFrame, states: int) -> DataFrame:
    """(far, id, m, a column for each state): sums by id. Rows travel packed and are unpacked where their id is."""
    part = lambda k: F.col("m") * F.shiftrightunsigned(f"p{k // 4}", 16 * (k % 4)).bitwiseAND(F.lit(PARTS)) / F.lit(float(PARTS))
    return found.repartition("far", "id").groupBy("far", "id").agg(F.sum("m").alias("m"), *(F.sum(part(k)).alias(f"s{k}") for k in range(states)))


def _near(found: DataFrame, voc: Vocabulary, states: int) -> tuple[np.ndarray, dict[int, np.ndarray], float]:
    """(sums by id of all ids to that of other words, rows below zero, the likelihood) of what ``_summed`` gives."""
    cols = [f"s{k}" for k in range(states)]
    table = found.where("not far").select("id", "m", *cols).toArrow()
    ids, values = table.column("id").to_numpy(), np.stack([table.column(c).to_numpy() for c in cols], 1)
    count = np.zeros((voc.size + 1, states))
    count[ids[ids >= 0]] = values[ids >= 0]
    log = table.column("m").to_numpy()[ids == -2 - states]
    return count, {int(i): r for i, r in zip(ids[ids < 0], values[ids < 0], strict=True)}, float(log[0]) if len(log) else 0.0


def _shares(voc: Vocabulary) -> np.ndarray:
    """The unigram shares by id; of all other training words together the last."""
    far = voc.far + voc.distinct - voc.size + (voc.texts == 0)
    return np.concatenate((voc.unigram(), [max(far, 0) / (voc.total + voc.distinct + 1.0) + 1e-12]))


def _emissions(count: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(emissions by id, what they were divided by)."""
    rows = count + PRIOR * _shares(voc)[:, None]
    # the share of words that no training text has is in the weight as well
    weight = rows.sum(0) + PRIOR / (voc.total + voc.distinct + 1.0)
    return rows / weight, weight


def first_model(learn: DataFrame, voc: Vocabulary, texts: int, states: int) -> Hmm:
    """The model whose emissions are the word counts of clusters of all texts."""
    move = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    start, count = np.full(states, 1 / states), np.zeros((voc.size + 1, states))
    if texts:
        held = learn.sparkSession.sparkContext.broadcast(clusters(learn, states))

        def run(batches):
            near = np.zeros((states, voc.size + 1))
            for batch in batches:
                ids, off = _unpacked(batch.column(0), np.int32)
                of = (_matrix(batch.column(1)) @ held.value.T).argmax(1)
                for k in np.unique(of):
                    near[k] += np.bincount(ids[np.repeat(of == k, np.diff(off))], minlength=voc.size + 1)
                near[:, voc.size - 1] += np.bincount(of, minlength=states)
            some = np.flatnonzero(near.any(0))
            yield _out(False, some, near[:, some].T)

        count, _, _ = _near(_summed(learn.select("ids", "v").mapInArrow(run, _schema(states)), states), voc, states)
        held.destroy()
    emit, weight = _emissions(count, voc)
    return Hmm(start, move, emit, weight)


def expectations(learn: DataFrame, voc: Vocabulary, model: Hmm, far: bool) -> DataFrame:
    """Expected counts of one step over every text of ``learn``: (far, id, their sum m, a column for each state).

    Rows below zero: the starts, the moves out of each state, and the likelihood as a sum.
    With ``far``, words other than the vocabulary's come by hash too.
    """
    spark, states = learn.sparkSession, len(model.start)
    held = spark.sparkContext.broadcast((voc, model.single()))

    def run(batches):
        voc, model = held.value
        count = np.zeros((states, voc.size + 1))
        start, moves, log = np.zeros(states), np.zeros((states, states)), 0.0
        for batch in _groups(batches, 0):
            ids, off = _unpacked(batch.column(0), np.int32)
            ids, others, here = ids.astype(np.int64), np.zeros(0, np.int64), model
            if far:
                # other words are apart for their counts, but emitted alike
                inv, others = pd.factorize(_unpacked(batch.column(1), np.int64)[0])
                ids[ids == voc.size] += inv
                here = Hmm(model.start, model.move, np.concatenate((model.emit, np.repeat(model.emit[-1:], max(len(others) - 1, 0), 0))))
            lay = Layout(ids, off, voc.size - 1)
            s, m, share, likelihood = here.expected_and_log(lay)
            start += s
            moves += m
            log += likelihood
            both = np.stack([np.bincount(lay.ids, share[:, k], len(here.emit)) for k in range(states)])
            count[:, : voc.size] += both[:, : voc.size]
            count[:, voc.size] += both[:, voc.size :].sum(1)
            if len(others):
                yield _out(True, others, both[:, voc.size :].T)
        some = np.flatnonzero(count.any(0))
        yield _out(False, np.concatenate((some, -1 - np.arange(states + 1))), np.concatenate((count[:, some].T, [start], moves)))
        yield pa.RecordBatch.from_arrays([pa.array([False]), pa.array([-2 - states]), pa.array([log]), *(pa.array([0]) for _ in range(-(-states // 4)))], names=["far", "id", "m", *(f"p{j}" for j in range(-(-states // 4)))])

    # fewer tasks, fewer sums of the same words
    tasks = max(spark.sparkContext.defaultParallelism, int(voc.total // TASK))
    found = _summed(learn.select("ids", *(["far"] if far else [])).coalesce(tasks).mapInArrow(run, _schema(states)), states)
    # the table of all words is read twice
    return common.materialize(found, "hmm-expected") if far else found


def _step(found: DataFrame, voc: Vocabulary, states: int) -> tuple[Hmm, float]:
    """(the model of the expected counts, the likelihood before)."""
    count, rest, log = _near(found, voc, states)
    moves = np.stack([rest[-2 - k] for k in range(states)]) + EVEN / states
    start = rest[-1] + EVEN / states
    emit, weight = _emissions(count, voc)
    return Hmm(start / start.sum(), moves / moves.sum(1, keepdims=True), emit, weight), log


def baum_welch(learn: DataFrame, voc: Vocabulary, model: Hmm, steps: int | None = None) -> tuple[Hmm, DataFrame]:
    """Steps over every text of ``learn`` until the likelihood stops rising, or ``steps``, and the one for all words: the model, and (h, n, s0 to the last state) of the words that are not the vocabulary's."""
    states = len(model.start)
    before, done = -np.inf, 0
    while steps is None or done < steps:
        model, log = _step(expectations(learn, voc, model, False), voc, states)
        done += 1
        if log - before <= TOLERANCE * abs(log):
            break
        before = log
    found = expectations(learn, voc, model, True)
    model, _ = _step(found, voc, states)
    # the states' expected counts of a word add up to its count
    return model, found.where("far").select(F.col("id").alias("h"), F.round("m").cast("long").alias("n"), *(f"s{k}" for k in range(states)))


def _arrays(table: pa.Table | pa.RecordBatch, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted hashes, counts, expected counts by state) of the columns h, n, s0 to the last state."""
    h, n = (table.column(x).to_numpy() for x in ("h", "n"))
    c = np.stack([table.column(f"s{k}").to_numpy().astype(np.float32) for k in range(states)], 1)
    h = h.view(np.uint64)
    by = np.argsort(h)
    return h[by], n[by], c[by]


def _with_joined(rows: DataFrame, table: DataFrame, known: np.ndarray, states: int) -> DataFrame:
    """``rows`` with w: those of its other words that ``known`` has not, as (h, n, expected counts by state)."""
    held = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            h, off = _unpacked(batch.column(1), np.int64)
            text = np.repeat(np.arange(batch.num_rows), np.diff(off))
            inv, uniq = pd.factorize(h)
            at = np.minimum(np.searchsorted(held.value, uniq.view(np.uint64)), max(len(held.value) - 1, 0))
            new = held.value[at] != uniq.view(np.uint64) if len(held.value) else np.ones(len(uniq), bool)
            width = max(len(uniq), 1)
            pair = np.unique((text * width + inv)[new[inv]]) if len(h) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(pair // width)), pa.array(uniq[pair % width] if len(uniq) else np.zeros(0, np.int64))], names=["row", "h"])

    pairs = rows.select("row", "far").mapInArrow(run, "row bigint, h bigint")
    cols = ["h", "n", *(f"s{k}" for k in range(states))]
    lists = pairs.join(table.select(*(F.col(c).cast("float") if c[0] == "s" else c for c in cols)), "h").groupBy("row").agg(F.collect_list(F.struct(*cols)).alias("w"))
    return rows.join(lists, "row", "left")


def score_texts(rows: DataFrame, voc: Vocabulary, model: Hmm, table: DataFrame | None, kept: int = KEPT) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) for each row of ``rows``."""
    states = len(model.start)
    near = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, states), np.float32))
    more = None
    if table is not None and voc.distinct > voc.size:
        least = least_count(table, max(kept - voc.size, 0))
        near = _arrays(table.where(F.col("n") >= least).toArrow(), states)
        more = table.where(F.col("n") < least)
    held = rows.sparkSession.sparkContext.broadcast((voc, model, near))
    joined = more is not None and not more.isEmpty()
    found = _with_joined(rows, more, near[0], states) if joined else rows

    def run(batches):
        voc, model, (kh, kn, kc) = held.value
        end = np.log10(voc.base(voc.texts))
        for batch in _groups(batches, 1):
            ids, off = _unpacked(batch.column(1), np.int32)
            ids, m = ids.astype(np.int64), batch.num_rows
            inv, uniq = pd.factorize(_unpacked(batch.column(2), np.int64)[0])
            n, c, hashes = np.zeros(len(uniq), np.int64), np.zeros((len(uniq), states)), uniq.view(np.uint64)
            tables = [(kh, kn, kc)]
            if joined:
                w = batch.column(3).flatten()
                h, first = np.unique(w.field("h").to_numpy().view(np.uint64), return_index=True)
                tables.append((h, w.field("n").to_numpy()[first], np.stack([w.field(f"s{k}").to_numpy()[first] for k in range(states)], 1)))
            for th, tn, tc in tables:
                if len(th) and len(hashes):
                    at = np.minimum(np.searchsorted(th, hashes), len(th) - 1)
                    hit = th[at] == hashes
                    n[hit], c[hit] = tn[at[hit]], tc[at[hit]]
            ids[ids == voc.size] += inv
            emit = np.concatenate((model.emit[: voc.size], (c + PRIOR * voc.base(n)[:, None]) / model.weight))
            count = np.concatenate((voc.n, [voc.texts], n))[ids]
            text = np.repeat(np.arange(m), np.diff(off))
            base, known = (np.bincount(text, x, m) for x in (np.log10(voc.base(count)), (count > 0).astype(float)))
            score = Hmm(model.start, model.move, emit).log10_likelihood(Layout(ids, off, voc.size - 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off) + 1), pa.array(known.astype(np.int64) + (voc.texts > 0)), pa.array(base + end), pa.array(score)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return found.select("doc_id", "ids", "far", *(["w"] if joined else [])).mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def language_scores(docs: DataFrame, states: int = STATES, steps: int | None = None, kept: int = KEPT, emitted: int = EMITTED) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trains on the rows that are not held out; a row without a doc_id is not held
    out. A null or empty text is its end token alone. Repeated rows train as
    often as they occur and score alike. Without any training text all tokens
    are unknown. Other columns are not read.
    """
    learn = docs.where(~held_out(F.col("doc_id")))
    counts = common.materialize(word_counts(learn), "hmm-counts")
    texts = learn.count()
    voc = vocabulary(counts, texts, kept, emitted)
    rows = token_rows(docs, voc)
    learn = rows.where("not held")
    model, far_table = first_model(learn, voc, texts, states), None
    if texts:
        model, far_table = baum_welch(learn, voc, model, steps)
    out = score_texts(rows, voc, model, far_table, kept)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(int(voc.total)).cast("long").alias("train_tokens"), "base_score", "score")


def op6_language_model(spark, sf_dir) -> DataFrame:
    return language_scores(common.documents(spark, sf_dir))
