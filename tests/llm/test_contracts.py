"""Every registered query on tables of its own: names, types, and values against brute force, the library, or its SQL."""

import collections
import hashlib
import math
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__
from ohmbridge.llm import bpe, jpeg, queries

sys.path.insert(0, os.path.dirname(__file__))
from test_models import brute_secrets, voiced  # noqa: E402
from test_text_ops import LOW, WORD, brute_lines  # noqa: E402

KEYS = ["password: abcdef123", "AKIA" + "A1B2" * 5, "token = short", "deadbeef" * 4, "ghp_" + "a1B2" * 9, "https://me:secretword@host/x", "éé api_key='0123456789'"]


def made():
    rng = random.Random(31)
    long_line = "This line is shared by many documents and long enough to count"
    out = []
    for i, text, lang in voiced(150, 17):
        if i % 9 == 0:
            text += "\n" + rng.choice(KEYS) + " " + rng.choice(KEYS)
        if i % 7 == 0:
            text += f"\n  {long_line.upper() if i % 2 else long_line}\t"
        out.append((i, text, None if i % 31 == 0 else lang, f"src{i % 4}"))
    twin = out[5][1]
    out += [(200, twin, "en", "src0"), (201, None, "en", "src1"), (202, "", None, None), (203, "one two three", "de", "src2"), (204, "#$% " * 40, "en", "src3"), (205, "again and again and again " * 30, "en", "src0"), (206, "漢字 😀 \U00020000", "fr", "src1"), (207, twin + " one more word", "en", "src2")]
    return out


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    d = tmp_path_factory.mktemp("contract")
    docs = made()
    ids, texts, langs, sources = zip(*docs, strict=True)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string()), "source": pa.array(sources, pa.string()), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), d / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "quality": pa.array([int("#" not in (t or "") and len(t or "") > 40) for t in texts], pa.int32()), "toxic": pa.array([0] * len(ids), pa.int32())}), d / "labels.parquet")
    return str(d), docs


def run(spark, tables, name):
    df = __spark_entry__.queries()[name](spark, tables[0])
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(d[0] for d in tables[1])
    return dict(df.dtypes), {r.doc_id: r for r in rows}


def test_all_are_registered():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and set(names) == set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_with_sql(spark, tables, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tables[0]}/documents.parquet'")
    rel = con.sql(queries.ORACLE_SQL[name])
    cols = sorted(rel.columns)
    df = queries.QUERIES[name](spark, tables[0])
    assert sorted(df.columns) == cols
    key = lambda r: [repr(x) for x in r]
    assert sorted(([r[c] for c in cols] for r in df.collect()), key=key) == sorted(([r[rel.columns.index(c)] for c in cols] for r in rel.fetchall()), key=key)


def test_op3(spark, tables):
    types, got = run(spark, tables, "op3_media")
    assert [types[c] for c in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")] == ["bigint", "bigint", "string", "bigint", "bigint", "string", "string"]
    for i, t, _, _ in tables[1]:
        raw = (t or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        media = jpeg.pack(payload)
        image = jpeg.Decoder(media)
        feature = f"{image.height}x{image.width};rgb:{zlib.crc32(image.rgb().tobytes()):08x}"
        assert tuple(got[i])[1:] == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature)


def test_op4(spark, tables):
    types, got = run(spark, tables, "op4_secrets")
    assert [types[c] for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")] == ["bigint"] * 3 + ["string"] * 2
    seen = 0
    for i, t, _, _ in tables[1]:
        found = brute_secrets(t)
        base = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        count = collections.Counter(k for *_, k in found)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (count["assign"], count["access"], count["hex"], hashlib.sha256(base.encode()).hexdigest())
        mine = r.spans.split(",") if r.spans else []
        assert ",".join(s for s in mine if s.split(":")[0] in ("assign", "access", "hex")) == base
        assert [int(s.split(":")[1]) for s in mine] == sorted(int(s.split(":")[1]) for s in mine)
        seen += any(s.startswith("forge") for s in mine)
    assert seen


def test_op5(spark, tables):
    types, got = run(spark, tables, "op5_quality")
    assert [types[c] for c in ("held_out", "score", "predicted")] == ["boolean", "double", "int"]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())


def test_op6(spark, tables):
    types, got = run(spark, tables, "op6_language_model")
    assert [types[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")] == ["boolean", "bigint", "bigint", "bigint", "double", "double"]
    tokens = {i: WORD.findall((t or "").translate(LOW)) + [None] for i, t, _, _ in tables[1]}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), abs=1e-6) and math.isfinite(r.score) and r.score < 0
    assert got[5].score == pytest.approx(got[200].score)


def test_op7(spark, tables):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.vocabulary_path())
    _, got = run(spark, tables, "op7_bpe")
    for i, t, _, _ in tables[1]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_op8(spark, tables):
    types, got = run(spark, tables, "op8_language")
    assert [types[c] for c in ("held_out", "lang_pred", "score")] == ["boolean", "string", "double"]
    right = [got[i].lang_pred == lang for i, t, lang, _ in tables[1] if i < 150 and lang and zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(right) > 0.9 and all(0 <= r.score <= 1 for r in got.values())
    assert got[201].lang_pred == got[202].lang_pred == got[204].lang_pred == "und" and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_op9_text(spark, tables):
    _, got = run(spark, tables, "op9_line_dedup")
    for i, (n, gone, kept) in brute_lines([(i, t) for i, t, _, _ in tables[1]]).items():
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


def test_op10(spark, tables):
    types, got = run(spark, tables, "op10_outliers")
    assert [types[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")] == ["bigint"] * 5 + ["boolean"] * 2
    for i, t, _, _ in tables[1]:
        w = WORD.findall(t or "")
        at = collections.defaultdict(list)
        for k in range(len(w) - 4):
            at[tuple(w[k : k + 5])].append(k)
        again = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(5)}
        full = [x for x in (t or "").split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(full) - len(set(full)), len(again), failed)
        assert not (failed and r.kept)
    clean = [got[i].kept for i in range(150) if not got[i].base_failed and i % 9]
    assert np.mean(clean) > 0.95
