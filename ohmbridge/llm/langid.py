"""Language ID: interpolated Kneser-Ney character models, one for each language.

Characters become 16-bit symbols: each lower-cased letter and each combining mark
is its own UTF-16 unit or, beyond U+FFFF, its own pair of units; digits fold to one
symbol, runs of anything else to one space. Counts of four-symbol windows are
gathered over all training texts; lower orders follow from them as continuation
counts. A model is one sorted array of
64-bit hashes of n-grams of all orders, with each n-gram's discounted share and,
as a context, the mass that it leaves to shorter contexts. A text goes to the
language of lowest cross-entropy per symbol. It is *rejected* if that entropy lies
beyond what the language's own training texts show, or its lead on the second
language is too small for its length.

Models of more than ``MAX_GRAMS`` windows are not collected: shares and masses stay
tables by n-gram, with a map by language, and the texts' distinct windows join them.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmbridge.llm import common, textkernel as tk

ORDER = 4
#: Bits of a symbol of the models; those of 8 bits are the folded ones of ``fold_tables``.
BITS = 16
SYMBOLS = 256
#: n-grams of all languages up to which the models are collected and broadcast. Beyond that, the same models stay tables, and texts' windows join them.
MAX_GRAMS = 12_000_000
#: Standard deviations above the mean entropy of a language's texts, per square root of a tenth of the text's symbols at most.
REJECT = 6.0
UNKNOWN = "und"
_U = np.uint64


@lru_cache(maxsize=1)
def fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each code point, whether it is a letter)."""
    cps = np.arange(0x110000)
    kind = np.array([unicodedata.category(chr(c)) for c in cps])
    letter = np.char.startswith(kind, "L")
    symbol = np.zeros(len(cps), np.uint8)
    symbol[kind == "Nd"] = 1
    latin = {}
    for c in range(0x180):
        low = chr(c).lower()
        if letter[c] and len(low) == 1:
            symbol[c] = latin.setdefault(low, 2 + len(latin))
    first = 2 + len(latin)
    other = letter.copy()
    other[:0x180] = False
    symbol[other] = first + (cps[other] >> 6) % (SYMBOLS - first)
    symbol[0x130] = symbol[ord("i")]
    return symbol, letter


@lru_cache(maxsize=1)
def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased code point of each letter and mark, 1 for digits, 0 for the rest; whether it is a letter)."""
    cps = np.arange(0x110000)
    kind = np.array([unicodedata.category(chr(c)) for c in cps])
    letter = np.char.startswith(kind, "L")
    symbol = np.zeros(len(cps), np.uint32)
    symbol[kind == "Nd"] = 1
    for c in np.flatnonzero(letter | np.char.startswith(kind, "M")).tolist():
        low = chr(c).lower()
        symbol[c] = ord(low) if len(low) == 1 else c
    symbol[0x130] = ord("i")
    return symbol, letter


def windows(column: pa.Array, bits: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of windows of four symbols of ``bits`` bits, their offsets per text, whether each text has a letter)."""
    kind = np.uint32 if bits == 8 else np.uint64
    buf, off = tk.string_buffer(column)
    n = len(off) - 1
    if not len(buf):
        return np.zeros(0, kind), np.zeros(n + 1, np.int64), np.zeros(n, bool)
    lead = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    at = lead[off]
    cps = np.frombuffer(buf.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol, letter = fold_tables() if bits == 8 else letter_tables()
    run = np.concatenate(([0], np.cumsum(letter[cps])))
    s = symbol[cps]
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    starts = at[:-1][np.diff(at) > 0]
    keep[starts] = True
    kept = np.concatenate(([0], np.cumsum(keep)))[at]
    s = s[keep].astype(kind)
    far = s > 0xFFFF
    if far.any():
        # letters beyond U+FFFF are two units
        place = np.concatenate(([0], np.cumsum(1 + far)))
        v, s = s[far] - kind(0x10000), np.repeat(s, 1 + far)
        s[place[:-1][far]], s[place[:-1][far] + 1] = kind(0xD800) + (v >> kind(10)), kind(0xDC00) + (v & kind(0x3FF))
        kept = place[kept]
    # a text's symbols, with ORDER - 1 spaces before and one after
    size = np.diff(kept)
    out_off = np.concatenate(([0], np.cumsum(size + ORDER)))
    padded = np.zeros(out_off[-1], kind)
    padded[np.arange(len(s)) + np.repeat(out_off[:-1] + ORDER - 1 - kept[:-1], size)] = s
    code = padded[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        code |= padded[ORDER - 1 - k : len(padded) - k] << kind(bits * k)
    # windows that end on a text's symbols or on its closing space
    ends = np.ones(len(padded), bool)
    for k in range(ORDER - 1):
        ends[out_off[:-1] + k] = False
    code = code[ends[ORDER - 1 :]]
    return code, np.concatenate(([0], np.cumsum(size + 1))), np.diff(run[at]) > 0


def _reduce(lang: np.ndarray, code: np.ndarray, n: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inv, codes = pd.factorize(code)
    pair, uniq = pd.factorize(inv * langs + lang)
    return uniq % langs, codes[uniq // langs], np.bincount(pair, n, len(uniq)).astype(np.int64)


def count_windows(docs: DataFrame) -> DataFrame:
    """(lang, code, n) over all rows of ``docs`` (lang, text)."""
    common.tune(docs.sparkSession)

    def run(batches):
        names: dict[str, int] = {}
        parts, held = [], 0
        for batch in batches:
            code, off, _ = windows(batch.column(1), BITS)
            lang = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()], np.int64)
            if len(code):
                parts.append(_reduce(np.repeat(lang, np.diff(off)), code, np.ones(len(code)), len(names)))
                held += len(parts[-1][0])
            if held > 2_000_000:
                parts, held = [_reduce(*map(np.concatenate, zip(*parts, strict=True)), len(names))], 0
        if parts:
            lang, code, n = _reduce(*map(np.concatenate, zip(*parts, strict=True)), len(names))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(list(names), object)[lang], pa.string()), pa.array(code.view(np.int64)), pa.array(n)], names=["lang", "code", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _key(order: int, code: np.ndarray) -> np.ndarray:
    return tk.mix(tk.mix(code.astype(_U)) + _U(order << 40))


class KneserNey:
    """One language's model: sorted hashes, with the share and the left-over mass of each n-gram."""

    def __init__(self, code: np.ndarray, n: np.ndarray, bits: int = 8):
        self.bits = bits
        hashes, shares, masses = [], [], []
        grams, counts = code.astype(_U), n.astype(np.float64)
        for order in range(ORDER, 0, -1):
            ones, twos = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
            cut = ones / (ones + 2 * twos) if ones else 0.5
            context = grams >> _U(bits)
            cu, inv = np.unique(context, return_inverse=True)
            total = np.bincount(inv, counts, len(cu))
            kinds = np.bincount(inv, minlength=len(cu))
            hashes.append(_key(order, grams))
            shares.append(np.maximum(counts - cut, 0) / total[inv])
            masses.append(np.zeros(len(grams)))
            hashes.append(_key(order + 32, cu))
            shares.append(np.zeros(len(cu)))
            masses.append(cut * kinds / total)
            # continuation counts: how many symbols stand before each shorter n-gram
            grams, counts = np.unique(grams & _U((1 << bits * (order - 1)) - 1), return_counts=True)
            counts = counts.astype(np.float64)
        by = np.argsort(h := np.concatenate(hashes))
        self.hashes, self.share, self.mass = h[by], np.concatenate(shares)[by], np.concatenate(masses)[by]

    def _find(self, key: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
        return np.where(self.hashes[at] == key, values[at], missing)

    def log_prob(self, code: np.ndarray) -> np.ndarray:
        """Natural logarithm of the last symbol's probability after the symbols before it."""
        code, bits = code.astype(_U), self.bits
        p = np.full(len(code), 0.5**bits)
        for order in range(1, ORDER + 1):
            gram = code & _U((1 << bits * order) - 1)
            p = self._find(_key(order, gram), self.share, 0.0) + self._find(_key(order + 32, gram >> _U(bits)), self.mass, 1.0) * p
        return np.log(p)


class LanguageModels:
    def __init__(self, models: dict[str, KneserNey | None]):
        self.langs = sorted(models)
        self.models = models
        #: the models as tables, where they are too many n-grams to broadcast
        self.tables: list[tuple[DataFrame, DataFrame | list[float]]] | None = None
        #: mean and deviation of the entropy of a language's texts; sharpness of scores
        self.mean, self.sd, self.sharp = np.zeros(len(models)), np.full(len(models), np.inf), 1.0
        self.codes, self.logs = pd.Index(np.zeros(0, np.uint64)), np.zeros((0, len(models)), np.float32)

    def __getstate__(self):
        return self.__dict__ | {"tables": None, "codes": pd.Index(np.zeros(0, np.uint64)), "logs": np.zeros((0, len(self.langs)), np.float32)}

    def entropies(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy per symbol by text and language, symbols, whether there is a letter)."""
        code, off, letter = windows(column, BITS)
        inv, uniq = pd.factorize(code)
        at = self.codes.get_indexer(uniq)
        if (at < 0).any():
            new = uniq[at < 0]
            if len(self.codes) > 2_000_000:
                self.codes, self.logs, new = self.codes[:0], self.logs[:0], uniq
            logs = np.stack([self.models[x].log_prob(new) for x in self.langs], 1).astype(np.float32)
            self.codes, self.logs = self.codes.append(pd.Index(new)), np.concatenate((self.logs, logs))
            at = self.codes.get_indexer(uniq)
        n = np.diff(off)
        out = np.empty((len(n), len(self.langs)))
        for j in range(len(self.langs)):
            log = self.logs[at, j].astype(np.float64)
            # a text at a time is rounded alike wherever it stands
            v = log[inv]
            out[:, j] = [-v[a:b].sum() / max(b - a, 1) for a, b in zip(off[:-1], off[1:], strict=True)]
        return out, n, letter

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, rejected, cross-entropy) of each text."""
        if not self.langs:
            n = len(column)
            return np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool), np.zeros(n)
        return self.decide(*self.entropies(column))

    def decide(self, e: np.ndarray, n: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        best = e.argmin(1)
        low = e[np.arange(len(e)), best]
        lead = e - low[:, None]
        score = 1 / np.exp(-np.minimum(self.sharp * np.sqrt(n)[:, None] * lead, 700)).sum(1)
        slack = np.sqrt(np.maximum(1, 100 / np.maximum(n, 1)))
        rejected = (low > self.mean[best] + REJECT * self.sd[best] * slack) | (score < 0.5)
        lang = np.array(self.langs, object)[best]
        lang[~letter] = UNKNOWN
        return lang, np.where(letter, score, 0.0), rejected | ~letter, low


def gram_tables(counts: DataFrame, langs: list[str]) -> list[tuple[DataFrame, DataFrame | list[float]]]:
    """What ``KneserNey`` holds, for each order from 1: (gram, shares by language), and (context, masses by language), of order 1 a list."""
    number = F.create_map(*(F.lit(x) for j, lang in enumerate(langs) for x in (lang, j)))
    grams = counts.select(number[F.col("lang")].alias("l"), F.col("code").alias("gram"), F.col("n").cast("double").alias("n"))
    by_lang = lambda x: F.map_from_entries(F.collect_list(F.struct("l", x)))
    out = []
    for order in range(ORDER, 0, -1):
        grams = common.materialize(grams.withColumn("context", F.shiftrightunsigned("gram", BITS)), f"language-grams-{order}")
        seen = {r.l: (r.ones, r.twos) for r in grams.groupBy("l").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()}
        cuts = [ones / (ones + 2 * twos) if ones else 0.5 for ones, twos in (seen[j] for j in range(len(langs)))]
        cut = F.element_at(F.array(*map(F.lit, cuts)), F.col("l") + 1)
        sums = common.materialize(grams.groupBy("l", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")), f"language-contexts-{order}")
        share = grams.join(sums, ["l", "context"]).groupBy("gram").agg(by_lang(F.greatest(F.col("n") - cut, F.lit(0.0)) / F.col("total")).alias("share"))
        if order > 1:
            mass = common.materialize(sums.groupBy("context").agg(by_lang(cut * F.col("kinds") / F.col("total")).alias("mass")), f"language-masses-{order}")
        else:
            left = {r.l: r.mass for r in sums.select("l", (cut * F.col("kinds") / F.col("total")).alias("mass")).collect()}
            mass = [left[j] for j in range(len(langs))]
        out.append((common.materialize(share, f"language-shares-{order}"), mass))
        grams = grams.groupBy("l", F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1)).alias("gram")).agg(F.count("*").cast("double").alias("n"))
    return out[::-1]


def joined_entropies(docs: DataFrame, models: LanguageModels, *keep: str) -> DataFrame:
    """The columns ``keep`` with what ``LanguageModels.entropies`` gives, e, size and letter, by joins with the models' tables."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches):
        for batch in batches:
            code, off, letter = windows(batch.column(len(keep)), BITS)
            # each text's distinct windows
            inv, uniq = pd.factorize(code)
            text, width = np.repeat(np.arange(len(letter)), np.diff(off)), max(len(uniq), 1)
            pair, n = np.unique(text * width + inv, return_counts=True)
            ends = pa.array(np.searchsorted(pair, np.arange(len(letter) + 1) * width).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (uniq[pair % width].view(np.int64), n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *lists, pa.array(np.diff(off)), pa.array(letter)], names=[*keep, "__w", "__k", "size", "letter"])

    found = docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "__w array<bigint>, __k array<bigint>, size bigint, letter boolean"]))
    rows = common.materialize(found.withColumn("__row", F.monotonically_increasing_id()), "language-text-windows")
    flat = rows.select("__row", F.explode(F.arrays_zip("__w", "__k")).alias("x")).select("__row", F.col("x.__w").alias("w"), F.col("x.__k").alias("k"))
    table, langs = flat.select("w").distinct(), range(len(models.langs))
    p = [F.lit(0.5**BITS)] * len(langs)
    for order, (share, mass) in enumerate(models.tables, 1):
        gram = F.col("w").bitwiseAND(F.lit((1 << BITS * order) - 1)) if order < ORDER else F.col("w")
        table = table.withColumn("g", gram).join(share.select(F.col("gram").alias("g"), "share"), "g", "left")
        if order > 1:
            table = table.withColumn("c", F.shiftrightunsigned("g", BITS)).join(mass.select(F.col("context").alias("c"), "mass"), "c", "left")
        left = [F.coalesce(F.col("mass")[j], F.lit(1.0)) if order > 1 else F.lit(mass[j]) for j in langs]
        table = table.select("w", F.array(*(F.coalesce(F.col("share")[j], F.lit(0.0)) + left[j] * p[j] for j in langs)).alias("p"))
        p = [F.col("p")[j] for j in langs]
    sums = flat.join(table, "w").groupBy("__row").agg(F.array(*(F.sum(F.col("k") * F.ln(x)) for x in p)).alias("e"))
    each = F.transform(F.coalesce("e", F.array(*(F.lit(0.0) for _ in langs))), lambda x: -x / F.greatest("size", F.lit(1)))
    return rows.drop("__w", "__k").join(sums, "__row", "left").select(*keep, each.alias("e"), "size", "letter")


def _arrays(batch: pa.RecordBatch, first: int, langs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stands in the columns e, size and letter."""
    e = batch.column(first).flatten().to_numpy().reshape(-1, langs).copy()
    return e, batch.column(first + 1).to_numpy(), batch.column(first + 2).to_numpy(zero_copy_only=False)


def held_out(doc_id):
    return F.coalesce(common.crc_mod(doc_id, 5) == 0, F.lit(False))


def train(docs: DataFrame, max_grams: int = MAX_GRAMS) -> LanguageModels:
    """Models of all languages of ``docs`` (doc_id, text, lang); rows without a text or language are left out."""
    rows = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    counts = common.materialize(count_windows(rows), "language-windows")
    if counts.count() > max_grams:
        models = LanguageModels({r.lang: None for r in counts.select("lang").distinct().collect()})
        models.tables = gram_tables(counts, models.langs)
    else:
        table = counts.orderBy("lang", "code").toArrow().to_pandas()
        models = LanguageModels({lang: KneserNey(part["code"].to_numpy().view(np.uint64), part["n"].to_numpy(), BITS) for lang, part in table.groupby("lang", sort=True)})
    if not models.langs:
        return models
    held = docs.sparkSession.sparkContext.broadcast(models)
    joined, sharp = models.tables is not None, 2.0 ** np.arange(-4, 4)

    def run(batches):
        own, sums = held.value.langs, np.zeros((len(held.value.langs), 3 + len(sharp)))
        number = {x: j for j, x in enumerate(own)}
        for batch in batches:
            e, n, letter = _arrays(batch, 1, len(own)) if joined else held.value.entropies(batch.column(1))
            ok = letter & (n >= 30)
            e, n, lang = e[ok], n[ok], np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)[ok]
            mine = e[np.arange(len(e)), lang]
            e[np.arange(len(e)), lang] = np.inf
            root = np.sqrt(n) * (e.min(1) - mine) if len(own) > 1 else np.zeros(len(e))
            # whole numbers, so that sums are the same in any order
            q = np.rint(mine * 4096)
            for k, x in enumerate((np.ones(len(q)), q, q * q, *(np.rint(np.logaddexp(0, -a * root) * 4096) for a in sharp))):
                sums[:, k] += np.bincount(lang, x, len(own))
        some = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(sums[some, k].astype(np.int64)) for k in range(sums.shape[1]))], names=["lang", *names])

    names = [f"s{k}" for k in range(3 + len(sharp))]
    scored = joined_entropies(rows, models, "lang") if joined else rows.select("lang", "text")
    seen = scored.mapInArrow(run, "lang bigint, " + ", ".join(f"{x} bigint" for x in names)).groupBy("lang").agg(*(F.sum(F.col(x).cast("decimal(38, 0)")).cast("double").alias(x) for x in names)).toPandas().sort_values("lang")
    for _, r in seen.iterrows():
        if r["s0"] >= 20:
            mean = r["s1"] / r["s0"]
            models.mean[int(r["lang"])], models.sd[int(r["lang"])] = mean / 4096, max(np.sqrt(max(r["s2"] / r["s0"] - mean * mean, 0)) / 4096, 0.02)
    if len(seen) and len(models.langs) > 1:
        models.sharp = min((seen[x].sum(), a) for x, a in zip(names[3:], sharp.tolist(), strict=True))[1]
    return models


def identify(docs: DataFrame, models: LanguageModels, *keep: str) -> DataFrame:
    """The columns ``keep`` with lang_pred, score, rejected and cross_entropy, from whole texts alone.

    A null text or one without a letter is ``und`` with score 0 and rejected. Of
    equal entropies the language first by name wins. Repeated rows come out alike.
    """
    common.tune(docs.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    held, joined = docs.sparkSession.sparkContext.broadcast(models), models.tables is not None

    def run(batches):
        for batch in batches:
            lang, score, rejected, low = held.value.decide(*_arrays(batch, len(keep), len(held.value.langs))) if joined else held.value.predict(batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected), pa.array(low)], names=[*keep, "lang_pred", "score", "rejected", "cross_entropy"])

    rows = joined_entropies(docs, models, *keep) if joined else docs.select(*keep, "text")
    return rows.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "lang_pred string, score double, rejected boolean, cross_entropy double"]))


def op8_language(spark, sf_dir) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    models = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, models, "doc_id").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
