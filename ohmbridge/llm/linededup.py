"""Reversible line dedup: exact reference counts, and sharded cuckoo filters over them.

A line's key is the line stripped of spaces, tabs and line ends, with A-Z
lower-cased; keys of fewer than ``MIN_CHARS`` code points never count. The
*postings* hold one row for each key and document, by a 128-bit hash of the key;
the *reference table* holds, for each key, its number of documents and the
largest doc_id. Keys that at least ``MIN_DOCS`` documents hold are *live*: their
fingerprints lie in cuckoo filters, one for each shard of the hash space. A line
is looked up in its shard's filter first; only hits meet the exact table, which decides.

All tables are kept by shard. Inserting documents merges their postings into the
shards of their keys, counts those keys anew and puts the ones that became live
into their shard's filter; deleting documents takes their postings out and the
keys that fell below the count out of the filters, so any insertion can be undone.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohmbridge.llm import common

MIN_CHARS, MIN_DOCS = 40, 5
#: Postings of a shard, on average.
SHARD_ROWS = 1_000_000
#: Filters up to this size in all are broadcast; more of them travel to their own shards' postings.
FILTER_BYTES = 64 << 20
#: Shards whose sizes (12 bytes each) are broadcast at most.
BROADCAST_SHARDS = 1_000_000
SPACE = " \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes | None:
    """The 16-byte hash of a line's key; None where the key is too short to count."""
    if len(line) < MIN_CHARS:
        return None
    line = line.strip(SPACE)
    if len(line) < MIN_CHARS:
        return None
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


class Full(Exception):
    """A key found no place in its filter."""


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; supports insertion, deletion and vectorised lookup."""

    def __init__(self, buckets: int):
        self.table = np.zeros((1 << max(1, math.ceil(math.log2(max(2, buckets)))), 4), np.uint16)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(math.ceil((keys + 8) / 4 / 0.6))

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        out = cls(2)
        out.table = np.frombuffer(raw, np.uint16).reshape(-1, 4).copy()
        return out

    def dump(self) -> bytes:
        return self.table.tobytes()

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        mark = (raw[:, 1] >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        mask = len(self.table) - 1
        first = (raw[:, 1] & np.uint64(0xFFFFFFFF)).astype(np.int64) & mask
        return mark, first, first ^ (self.other(mark) & mask)

    @staticmethod
    def other(mark: np.ndarray) -> np.ndarray:
        return ((mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64)

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, bool)
        mark, a, b = self.places(keys)
        return (self.table[a] == mark[:, None]).any(1) | (self.table[b] == mark[:, None]).any(1)

    def insert(self, keys: list[bytes]) -> None:
        if not keys:
            return
        mask, table = len(self.table) - 1, self.table
        for n, (mark, a, b) in enumerate(zip(*(x.tolist() for x in self.places(keys)), strict=True)):
            for at in (a, b):
                free = np.flatnonzero(table[at] == 0)
                if len(free):
                    table[at, free[0]] = mark
                    break
            else:
                at = a
                for kick in range(500):
                    slot = (n + kick) & 3
                    mark, table[at, slot] = int(table[at, slot]), mark
                    at ^= int(self.other(np.array([mark], np.uint16))[0]) & mask
                    free = np.flatnonzero(table[at] == 0)
                    if len(free):
                        table[at, free[0]] = mark
                        break
                else:
                    raise Full

    def delete(self, keys: list[bytes]) -> None:
        """Take out keys that were inserted."""
        if not keys:
            return
        for mark, a, b in zip(*(x.tolist() for x in self.places(keys)), strict=True):
            for at in (a, b):
                found = np.flatnonzero(self.table[at] == mark)
                if len(found):
                    self.table[at, found[0]] = 0
                    break


def filled(keys: list[bytes]) -> CuckooFilter:
    """A filter that holds ``keys``, with room for as many again where they do not fit at once."""
    size = len(keys)
    while True:
        made = CuckooFilter.sized(size)
        try:
            made.insert(keys)
            return made
        except Full:
            size *= 2


def _probed(batch: pa.RecordBatch, filters: dict[int, CuckooFilter]) -> pa.RecordBatch:
    """The columns h and doc_id of the rows (h, doc_id, shard, ...) that their shard's filter may hold."""
    keys, shard = batch.column(0).to_pylist(), batch.column(2).to_numpy()
    ok = np.zeros(len(keys), bool)
    for s in np.unique(shard):
        if int(s) in filters:
            at = np.flatnonzero(shard == s)
            ok[at] = filters[int(s)].contains([keys[i] for i in at])
    return pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], names=["h", "doc_id"])


def postings(docs: DataFrame) -> DataFrame:
    """(h, doc_id): each counting key of each document; rows without an id hold none."""
    common.tune(docs.sparkSession)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            out_id, out_key = [], []
            for doc_id, text in zip(ids, texts.to_pylist(), strict=True):
                if text and len(text) >= MIN_CHARS:
                    keys = {k for line in text.split("\n") if (k := line_key(line))}
                    out_key += keys
                    out_id += [doc_id] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(out_key, pa.binary()), pa.array(out_id, pa.int64())], names=["h", "doc_id"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(run, "h binary, doc_id bigint")


def reference(posts: DataFrame) -> DataFrame:
    """(h, n_docs, max_doc): exact counts of distinct postings."""
    return posts.groupBy("h").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))


def shard_of(shards: int, key: str = "h"):
    return (F.crc32(key) % F.lit(shards)).cast("int")


class Sharded:
    """A table in the shared folder, partitioned by ``shard``; each shard lies in the folder that wrote it last."""

    def __init__(self, spark: SparkSession, name: str, schema: str):
        self.spark, self.name, self.schema = spark, name, schema
        self.folder: dict[int, str] = {}

    def write(self, rows: DataFrame, shards: list[int] | None = None) -> None:
        """Replace ``shards`` (all without any) by ``rows``, which have the columns of the schema and shard."""
        path = common.scratch_path(self.spark, self.name)
        # large shards are dealt to several tasks, small ones share one
        rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
        written = {r[0] for r in self._read(path).select("shard").distinct().collect()}
        for s in list(self.folder) if shards is None else shards:
            self.folder.pop(s, None)
        self.folder |= dict.fromkeys(sorted(written), path)

    def _read(self, path: str, *folders: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, shard int").option("basePath", path).parquet(*(folders or (path,)))

    def read(self, shards: list[int] | None = None) -> DataFrame:
        """The rows of ``shards``, or all; no other shard's files are opened."""
        by_path: dict[str, list[int]] = {}
        for s in sorted(self.folder if shards is None else self.folder.keys() & set(shards)):
            by_path.setdefault(self.folder[s], []).append(s)
        found = [self._read(p, *(f"{p}/shard={s}" for s in of)) for p, of in by_path.items()]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], f"{self.schema}, shard int")


class LineDedup:
    """The state: postings by key and by document, exact reference counts, and filters, each a table by shards.

    A change merges into the shards of its own keys and documents and leaves the
    others as they are.
    """

    def __init__(self, posts: DataFrame, min_docs: int = MIN_DOCS):
        """``posts``: (h, doc_id), repeated or not."""
        spark = posts.sparkSession
        self.spark, self.min_docs = spark, min_docs
        raw = common.materialize(posts, "line-postings")
        self.shards = max(1, math.ceil(raw.count() / SHARD_ROWS))
        self.posts = Sharded(spark, "line-postings", "h binary, doc_id bigint")
        self.posts.write(raw.distinct().withColumn("shard", shard_of(self.shards)))
        common.release(raw)
        self.refs = Sharded(spark, "line-references", "h binary, n_docs bigint, max_doc bigint")
        self.refs.write(reference(self.posts.read()).withColumn("shard", shard_of(self.shards)))
        self.filters = Sharded(spark, "line-filters", "raw binary")
        self.filters.write(self._built(self.live))
        #: the postings by document, which the first change makes
        self.by_doc: Sharded | None = None

    @classmethod
    def of(cls, docs: DataFrame, min_docs: int = MIN_DOCS) -> LineDedup:
        return cls(postings(docs), min_docs)

    @property
    def live(self) -> DataFrame:
        """(h, n_docs, max_doc, shard) of the keys that lose lines."""
        return self.refs.read().where(F.col("n_docs") >= self.min_docs)

    @staticmethod
    def _built(live: DataFrame) -> DataFrame:
        """(raw, shard): a filter of the keys of each shard."""

        def build(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"raw": [filled([bytes(x) for x in group["h"]]).dump()], "shard": [int(group["shard"].iloc[0])]})

        return live.select("h", "shard").groupBy("shard").applyInPandas(build, "raw binary, shard int")

    def _doc_bucket(self):
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.shards)).cast("int")

    def _held(self, ids: DataFrame) -> DataFrame:
        """(h, doc_id): what the documents ``ids`` hold, read from their buckets alone."""
        if self.by_doc is None:
            self.by_doc = Sharded(self.spark, "line-documents", "h binary, doc_id bigint")
            self.by_doc.write(self.posts.read().select("h", "doc_id").withColumn("shard", self._doc_bucket()))
        buckets = [r[0] for r in ids.select(self._doc_bucket()).distinct().collect()]
        return self.by_doc.read(buckets).select("h", "doc_id").join(ids, "doc_id", "left_semi")

    @staticmethod
    def _ids(docs: DataFrame) -> DataFrame:
        return common.materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct(), "line-ids")

    def insert(self, docs: DataFrame) -> None:
        """Count the lines of more documents; a document that is there already is replaced."""
        ids = self._ids(docs)
        new = common.materialize(postings(docs).distinct(), "line-new")
        held = common.materialize(self._held(ids), "line-held")
        self._merge(new.join(held, ["h", "doc_id"], "left_anti"), held.join(new, ["h", "doc_id"], "left_anti"))
        common.release(ids, new, held)

    def delete(self, docs: DataFrame) -> None:
        """Forget the documents with the ids of ``docs``."""
        ids = self._ids(docs)
        held = common.materialize(self._held(ids), "line-held")
        self._merge(held.limit(0), held)
        common.release(ids, held)

    def _merge(self, added: DataFrame, removed: DataFrame) -> None:
        """Merge postings (h, doc_id) that come and go into their shards."""
        change = added.select("h", "doc_id", F.lit(True).alias("add")).unionByName(removed.select("h", "doc_id", F.lit(False).alias("add")))
        change = common.materialize(change.withColumns({"shard": shard_of(self.shards), "bucket": self._doc_bucket()}), "line-change")
        shards = [r[0] for r in change.select("shard").distinct().collect()]
        if not shards:
            return
        add, gone = change.where("add"), change.where("not add").select("h", "doc_id")
        keys = change.select("h").distinct()
        before = common.materialize(self.refs.read(shards).join(keys, "h", "left_semi").where(F.col("n_docs") >= self.min_docs).select("h"), "line-before")
        self.posts.write(self.posts.read(shards).join(gone, ["h", "doc_id"], "left_anti").unionByName(add.select("h", "doc_id", "shard")), shards)
        changed = reference(self.posts.read(shards).join(keys, "h", "left_semi")).withColumn("shard", shard_of(self.shards))
        changed = common.materialize(changed, "line-changed")
        self.refs.write(self.refs.read(shards).join(keys, "h", "left_anti").unionByName(changed), shards)
        buckets = [r[0] for r in change.select("bucket").distinct().collect()]
        if self.by_doc is not None:
            self.by_doc.write(self.by_doc.read(buckets).join(gone, ["h", "doc_id"], "left_anti").unionByName(add.select("h", "doc_id", F.col("bucket").alias("shard"))), buckets)
        now = changed.where(F.col("n_docs") >= self.min_docs).select("h")
        turned = before.join(now, "h", "left_anti").select("h", F.lit(False).alias("add")).unionByName(now.join(before, "h", "left_anti").select("h", F.lit(True).alias("add")))
        self._refill(common.materialize(turned.withColumn("shard", shard_of(self.shards)), "line-turned"))
        common.release(change, before, changed)

    def _refill(self, turned: DataFrame) -> None:
        """Take keys out of their shards' filters and put others in; ``turned``: h, add, shard."""
        shards = [r[0] for r in turned.select("shard").distinct().collect()]
        if not shards:
            return

        def change(key, had: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            one = CuckooFilter.load(bytes(had["raw"].iloc[0])) if len(had) else CuckooFilter.sized(len(rows))
            add, full = rows["add"].astype(bool), False
            try:
                one.delete([bytes(x) for x in rows["h"][~add]])
                one.insert([bytes(x) for x in rows["h"][add]])
            except Full:
                full = True
            return pd.DataFrame({"raw": [one.dump()], "shard": [int(key[0])], "full": [full]})

        made = self.filters.read(shards).groupBy("shard").cogroup(turned.groupBy("shard")).applyInPandas(change, "raw binary, shard int, full boolean")
        made = common.materialize(made, "line-filters")
        full = [r[0] for r in made.where("full").select("shard").collect()]
        # a filter without room is built anew from its shard's counts
        anew = self._built(self.refs.read(full).where(F.col("n_docs") >= self.min_docs))
        self.filters.write(made.where("not full").select("raw", "shard").unionByName(anew), shards)
        common.release(made, turned)

    def hits(self) -> DataFrame:
        """Postings whose key its shard's filter may hold: all live ones, and few others.

        Filters of FILTER_BYTES in all are broadcast. More of them travel each to
        the postings of its own shard, those of large shards in several parts.
        """
        raw = self.filters.read()
        size = raw.agg(F.coalesce(F.sum(F.length("raw")), F.lit(0))).first()[0]
        posts = self.posts.read().select("h", "doc_id", "shard")
        if size > FILTER_BYTES:
            return self._streamed(posts, raw)
        held = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["raw"]) for r in raw.collect()})

        def probe(batches):
            filters = {k: CuckooFilter.load(v) for k, v in held.value.items()}
            for batch in batches:
                yield _probed(batch, filters)

        return posts.mapInArrow(probe, "h binary, doc_id bigint")

    def _streamed(self, posts: DataFrame, raw: DataFrame) -> DataFrame:
        """Each filter comes before the postings of its shard, or of a part of it, in one sorted stream."""
        rows = posts.groupBy("shard").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("parts"))
        rows = common.materialize(rows, "line-parts")
        part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
        # one row for each shard: 12 bytes of some million postings
        shards = F.broadcast(rows) if rows.count() <= BROADCAST_SHARDS else rows
        mine = posts.join(shards, "shard").select("h", "doc_id", "shard", part.alias("part"), F.lit(None).cast("binary").alias("raw"))
        own = raw.join(rows, "shard").select(F.lit(None).cast("binary").alias("h"), F.lit(None).cast("bigint").alias("doc_id"), "shard", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"), "raw")
        stream = own.unionByName(mine).repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("raw").isNull())

        def probe(batches):
            filters: dict[int, CuckooFilter] = {}
            for batch in batches:
                made = batch.column(4)
                for i in np.flatnonzero(made.is_valid().to_numpy(zero_copy_only=False)):
                    # rows before this one were of other shards, or of none
                    filters[int(batch.column(2)[int(i)].as_py())] = CuckooFilter.load(made[int(i)].as_py())
                out = batch.filter(made.is_null())
                yield _probed(out, filters)
                if out.num_rows:
                    last = int(out.column(2)[out.num_rows - 1].as_py())
                    filters = {k: v for k, v in filters.items() if k >= last}

        return stream.mapInArrow(probe, "h binary, doc_id bigint")

    def drops(self) -> DataFrame:
        """(doc_id, drops): the keys that each document loses, all but the largest document that holds them."""
        found = self.hits().join(self.live.select("h", "max_doc"), "h").where("doc_id < max_doc")
        return found.groupBy("doc_id").agg(F.collect_set("h").alias("drops"))

    def apply(self, docs: DataFrame, added: tuple[str, str, str] = ("kept", "n_lines", "n_dropped")) -> DataFrame:
        """``docs`` with the text left, its lines before and the lines dropped added, under three names; columns of those names are replaced."""
        docs = docs.drop(*added)
        names = docs.columns
        own, gone = common.free_names(names, "id", "drops")
        drops = self.drops().select(F.col("doc_id").alias(own), F.col("drops").alias(gone))
        rows = docs.join(drops, docs["doc_id"].cast("long") == F.col(own), "left").drop(own)
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{added[0]}` string, `{added[1]}` bigint, `{added[2]}` bigint"])
        at_text = names.index("text")

        def run(batches):
            for batch in batches:
                kept, lines, dropped = [], [], []
                for text, drop in zip(batch.column(at_text).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                    rows_in = (text or "").split("\n")
                    lines.append(len(rows_in))
                    if drop:
                        gone = set(drop)
                        stay = [x for x in rows_in if line_key(x) not in gone]
                        kept.append("\n".join(stay))
                        dropped.append(len(rows_in) - len(stay))
                    else:
                        kept.append(text or "")
                        dropped.append(0)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, *added])

        return rows.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop repeated lines over all of ``docs``.

    Adds kept (string), n_lines and n_dropped (long) to the columns of ``docs``;
    columns of those names are replaced. A null or empty text is one empty line and stays empty. A row without
    a doc_id counts for no key and loses no line. Rows that repeat a doc_id count
    once and keep or lose lines alike.
    """
    return LineDedup.of(docs, min_docs).apply(docs)


def op9_line_dedup(spark, sf_dir) -> DataFrame:
    rows = dedup_lines(common.documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = """
WITH lines AS (
    SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
    FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i)
), keyed AS (
    SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), live AS (
    SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT keyed.*, live.k IS NOT NULL AND doc_id < last AS gone FROM keyed LEFT JOIN live ON keyed.k = live.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
