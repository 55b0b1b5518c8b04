"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Statistics are computed with numpy over Arrow buffers. Trees are grown level by
level from histograms of binned statistics (at most ``BINS`` bins by quantile)
and kept as flat arrays of complete binary trees, so that scoring walks all
texts of a batch at once: node = 2 * node + 1 + (value > threshold).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmbridge.llm import common, textkernel as tk

#: Labelled rows that a model is fitted on, at most in expectation; chosen by hash of the id.
MAX_TRAIN = 50_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 80, 4, 64, 0.15, 1.0, 5

_LOWER, _UPPER, _DIGIT, _SPACE, _NEWLINE, _END, _MARK, _SYMBOL, _QUOTE, _WIDE, _CONTROL, _OTHER = range(12)
_CLASS = np.full(256, _OTHER, np.uint8)
for _chars, _c in ((range(97, 123), _LOWER), (range(65, 91), _UPPER), (range(48, 58), _DIGIT), (b" \t\r\x0b\x0c", _SPACE), (b"\n", _NEWLINE), (b".,;:", _END), (b"!?", _MARK), (b"#*$%&|<>", _SYMBOL), (b"\"'()[]{}", _QUOTE), (range(128, 256), _WIDE), ([*range(9), *range(14, 32), 127], _CONTROL)):
    _CLASS[list(_chars)] = _c

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_sd", "longest_word", "lower", "upper", "digit", "space", "newline", "end", "mark", "symbol", "quote", "wide", "control", "other",
    "distinct_words", "top_word", "doubled_words", "distinct_windows", "short_words", "words_per_line", "upper_share",
)


def statistics(column: pa.Array) -> np.ndarray:
    """float32 matrix, a row for each text; texts without words have zeros for what words define."""
    buf, off = tk.string_buffer(column)
    n, size = len(off) - 1, np.diff(off)
    out = np.zeros((n, len(FEATURES)), np.float32)
    counts = np.zeros((n, 12))
    step = np.searchsorted(off, np.arange(0, off[-1] + tk.BLOCK, tk.BLOCK), "right") - 1
    for a, b in zip(step[:-1], [*step[1:-1], n], strict=True) if len(step) > 1 else []:
        if b > a:
            part = buf[off[a] : off[b]]
            row = np.repeat(np.arange(b - a, dtype=np.int32), size[a:b])
            counts[a:b] = np.bincount(row * 12 + _CLASS[part], minlength=12 * (b - a)).reshape(-1, 12)
    hashes, lengths, woff = tk.words(buf, off)
    words = np.diff(woff)
    some, long = np.maximum(words, 1), np.maximum(size, 1)
    mean = tk.per_text_sum(lengths, woff) / some
    out[:, 0], out[:, 1], out[:, 2] = np.log1p(size), np.log1p(words), mean
    out[:, 3] = np.sqrt(np.maximum(tk.per_text_sum(lengths * lengths, woff) / some - mean**2, 0))
    out[:, 5:17] = counts / long[:, None]
    same = np.zeros(len(hashes), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    first = woff[:-1][words > 0]
    same[first] = 0
    out[:, 19] = tk.per_text_sum(same, woff) / some
    out[:, 21] = tk.per_text_sum((lengths <= 3).astype(np.int64), woff) / some
    out[:, 22] = np.log1p(words / (counts[:, _NEWLINE] + 1))
    out[:, 23] = counts[:, _UPPER] / np.maximum(counts[:, _UPPER] + counts[:, _LOWER], 1)
    windows, soff = tk.shingles(hashes, woff)
    for i in np.flatnonzero(words):
        w = np.sort(hashes[woff[i] : woff[i + 1]])
        edge = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1], [True])))
        out[i, 17] = (len(edge) - 1) / len(w)
        out[i, 18] = np.diff(edge).max() / len(w)
        s = np.sort(windows[soff[i] : soff[i + 1]])
        out[i, 20] = (1 + np.count_nonzero(s[1:] != s[:-1])) / len(s)
        out[i, 4] = np.log1p(lengths[woff[i] : woff[i + 1]].max())
    return out


class Forest:
    """Flat arrays: feature and threshold of each inner node, value of each leaf, of trees of one depth."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, start: float):
        self.feature, self.threshold, self.value, self.start = feature, threshold, value, start

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
        """Logistic loss. Without two classes the score is the smoothed share of ones."""
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        start = float(np.log(share / (1 - share)))
        inner, leaves = 2**depth - 1, 2**depth
        feature, threshold, value = np.zeros((trees, inner), np.int32), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves), np.float32)
        if len(np.unique(y)) < 2:
            return cls(feature, threshold, value, start)
        n, m = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for j in range(m)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)]).astype(np.int64)
        margin = np.full(n, start)
        for t in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(depth):
                width = 2**level
                best = np.full(width, 1e-6)
                pick, cut = np.zeros(width, np.int64), np.full(width, BINS, np.int64)
                for j in range(m):
                    at = node * BINS + binned[j]
                    hist = [np.bincount(at, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (g, h, None)]
                    gl, hl, nl = hist
                    gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
                    gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                    gain[(nl < LEAST) | (nt - nl < LEAST)] = 0
                    gain[:, len(edges[j]) :] = 0
                    b = gain.argmax(1)
                    top = gain[np.arange(width), b]
                    better = top > best
                    best[better], pick[better], cut[better] = top[better], j, b[better]
                base = width - 1
                for k in np.flatnonzero(cut < BINS):
                    feature[t, base + k], threshold[t, base + k] = pick[k], edges[pick[k]][cut[k]]
                node = 2 * node + (binned[pick[node], np.arange(n)] > cut[node])
            gs, hs = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
            value[t] = -RATE * gs / (hs + RIDGE)
            margin += value[t][node]
        return cls(feature, threshold, value, start)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        total = np.full(len(x), self.start)
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``stats`` (array of float)."""
    common.tune(docs.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches):
        for batch in batches:
            x = statistics(batch.column(len(keep)))
            ends = pa.array((np.arange(len(x) + 1) * x.shape[1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=[*keep, "stats"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "stats array<float>"]))


def held_out(doc_id):
    return F.coalesce(common.crc_mod(doc_id, 3) == 1, F.lit(False))


def fit(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Forest:
    """Fit on the labelled rows of ``stats`` that are not held out.

    ``max_train`` bounds the rows that reach the driver: of more labelled rows,
    those with the least hashes of their ids are taken. Rows with a null id or a
    quality other than 0 and 1 are no labels.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).where(~held_out(F.col("doc_id")))
    rows = common.materialize(stats.join(known, "doc_id").select("doc_id", "stats", "quality"), "quality-train")
    n = rows.count()
    grid = 1 << 30
    some = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(grid)) < F.lit(int(grid * min(1.0, max_train / max(n, 1)))))
    table = some.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").select("stats", "quality").toArrow()
    x = table.column("stats").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)) if len(table) else np.zeros((0, len(FEATURES)), np.float32)
    return Forest.fit(x, table.column("quality").to_numpy().astype(np.float64))


def _scorer(forest: Forest, make, at: int, keep: list[int], name: str):
    def run(batches):
        for batch in batches:
            score = forest.score(make(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(score)], names=[*(batch.schema.names[i] for i in keep), name])

    return run


def score_documents(docs: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """``docs`` with ``name`` (double, 0 to 1) added, from whole texts alone; a column of that name is replaced."""
    common.tune(docs.sparkSession)
    fields = docs.schema.fields
    keep = [i for i, f in enumerate(fields) if f.name.lower() != name.lower()]
    schema = ", ".join([*(f"`{fields[i].name}` {fields[i].dataType.simpleString()}" for i in keep), f"`{name}` double"])
    return docs.mapInArrow(_scorer(forest, statistics, docs.columns.index("text"), keep, name), schema)


def score_statistics(stats: DataFrame, forest: Forest) -> DataFrame:
    def matrix(column):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(-1, len(FEATURES))

    fields = stats.schema.fields
    keep = [i for i, f in enumerate(fields) if f.name != "stats"]
    schema = ", ".join([*(f"`{fields[i].name}` {fields[i].dataType.simpleString()}" for i in keep), "score double"])
    return stats.mapInArrow(_scorer(forest, matrix, stats.columns.index("stats"), keep, "score"), schema)


def keep_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, that score at least ``least`` by a model fitted on ``docs`` and ``labels``.

    Null and empty texts score by their zero statistics. Repeated rows stay or go
    together; a row without a doc_id is scored like any other. Without labels of
    both kinds all rows have one score, the share of ones.
    """
    # ids are small beside texts: Spark broadcasts them if they are few, and texts do not move to be looked at
    stats = with_statistics(docs.where("doc_id is not null").select("doc_id", "text").join(_labelled_ids(labels), "doc_id", "left_semi"), "doc_id")
    (score,) = common.free_names(docs.columns, "score")
    return score_documents(docs, fit(stats, labels), score).where(F.col(score) >= least).select(*docs.columns)


#: Labelled ids (8 bytes each) that are broadcast at most; more of them join.
BROADCAST_IDS = 2_000_000


def _labelled_ids(labels: DataFrame) -> DataFrame:
    ids = labels.select("doc_id").distinct()
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts score by their zero statistics. Repeated rows score
    alike; a null doc_id is not held out. Columns other than doc_id and text are
    not read.
    """
    stats = common.materialize(with_statistics(docs, "doc_id"), "quality-stats")
    rows = score_statistics(stats, fit(stats, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_quality(spark, sf_dir) -> DataFrame:
    return quality_scores(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
