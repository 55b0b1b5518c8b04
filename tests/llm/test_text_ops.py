"""BPE, near duplicates, line dedup, quality rules: against brute force, and odd inputs."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ohmbridge.llm import bpe, linededup, neardup, robust, textkernel as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(texts):
    return [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


def odd_rows():
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (None, "no id here at all, but five words", None, "a", 1), (4, long, "de", "b", len(long)),
        (5, "one two three four five six", None, None, 5), (5, "one two three four five six", None, None, 5), (7, "one two three four five six", "en", "a", None), (8, " \n\t ", "en", "a", 4), (9, "É漢字 😀", "fr", "c", 5),
    ]


def wide(df):
    """The same rows with columns whose names clash with common ones."""
    return df.withColumns({"n": F.lit(1), "id": F.lit(2), "key": F.lit("x"), "score": F.lit(0.5), "kept": F.lit(1), "n_lines": F.lit(2), "h": F.lit(3), "a": F.lit(1), "b": F.lit(2)})


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.vocabulary_path())


def test_words_are_those_of_the_pattern():
    random.seed(5)
    texts = ["".join(random.choice("aB é\t\n漢 .-") for _ in range(random.randrange(60))) for _ in range(300)] + ["", None, "x" * 600_000 + " y"]
    buf, off = tk.string_buffer(pa.array(texts))
    h, length, woff = tk.words(buf, off)
    expected = [[w.translate(LOW) for w in WORD.findall(t or "")] for t in texts]
    assert np.diff(woff).tolist() == [len(x) for x in expected]
    flat = [w for x in expected for w in x]
    assert length.tolist() == [len(w.encode()) for w in flat]
    seen = {}
    for w, v in zip(flat, h.tolist(), strict=True):
        assert seen.setdefault(w, v) == v
    assert len(set(seen.values())) == len(seen)


def test_shingles_are_distinct_by_words():
    buf, off = tk.string_buffer(pa.array(["a b c d e f", "A  b\tc d e", "a b", "b a", "a b", "", "a b c d e f"]))
    h, _, woff = tk.words(buf, off)
    s, soff = tk.shingles(h, woff)
    got = [s[a:b].tolist() for a, b in zip(soff[:-1], soff[1:], strict=True)]
    assert [len(x) for x in got] == [2, 1, 1, 1, 1, 0, 2]
    assert got[0][0] == got[1][0] and got[2] == got[4] != got[3] and got[0] == got[6]


def test_bpe_equals_the_library(tokenizer):
    random.seed(2)
    parts = ["a", "th", " ", "  ", "\n", "é", "漢字", "😀", "'s", "9", "!!", "<|endoftext|>", "\t", "　", "ing", "====", "x" * 40, "\r\n", "0", "A"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(40))) for _ in range(3000)] + ["", " ", "a" * 4000, "the " * 50 + "\n  x \n "]
    own = bpe.encoder(bpe.vocabulary_path())
    for mine, ref in zip(own.encode_batch(texts), tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(mine, "<u4").tolist() == ref.ids
        assert own.decode(mine) == tokenizer.decode(ref.ids, skip_special_tokens=False)


def test_bpe_blanks_beside_other_whitespace_equal_the_library(tokenizer):
    random.seed(5)
    parts = ["a", " ", " ", "\u00a0", "\u00a0", "\n", "\t", "\u3000", "b!", "7"]
    texts = ["a \u00a0 \u00a0 b", "a \u00a0 \u00a0", "a \u00a0 \u00a0 \u00a0b"] + ["".join(random.choice(parts) for _ in range(random.randrange(16))) for _ in range(3000)]
    own = bpe.TrieBpe(bpe.vocabulary_path())
    for mine, ref in zip(own.encode_batch(texts), tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(mine, "<u4").tolist() == ref.ids


def test_bpe_cache_does_not_change_results(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    own = bpe.TrieBpe(bpe.vocabulary_path())
    texts = [f"word{i} other{i % 7} the end {i}" for i in range(200)]
    for a in range(0, 200, 25):
        for mine, ref in zip(own.encode_batch(texts[a : a + 25]), tokenizer.encode_batch(texts[a : a + 25], add_special_tokens=False), strict=True):
            assert np.frombuffer(mine, "<u4").tolist() == ref.ids


def test_bpe_odd_rows(spark, tokenizer):
    df = wide(spark.createDataFrame(odd_rows(), SCHEMA))
    got = bpe.encode_documents(df).collect()
    assert len(got) == 9
    for r in got:
        assert len(r.ids) == r.n_tokens and r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    assert sorted(r.decoded for r in got) == sorted((x[1] or "") for x in odd_rows())
    assert bpe.encode_documents(df.limit(0)).count() == 0


def sets_of(text):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(docs):
    top = {i: i for i, _ in docs}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    s = {i: sets_of(t) for i, t in docs}
    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(s[a] & s[b])
            if both and 100 * both >= 75 * (len(s[a]) + len(s[b]) - both):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s[i]) for i in ids}


def edited_family(seed, n, words=120, edits=18):
    rng = random.Random(seed)
    base = [f"v{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(edits)):
            p = rng.randrange(len(t))
            t[p : p + 1] = rng.choice(([], [f"e{rng.randrange(10**6)}"], [t[p], f"e{rng.randrange(10**6)}"]))
        out.append(" ".join(t))
    return out


def test_near_duplicates_equal_brute_force(spark):
    texts = edited_family(1, 60) + edited_family(2, 40, 40, 6) + edited_family(3, 30, 9, 3) + ["a b", "A  b", "b a", "", None, "a b c d e"] + [f"only {i} words {i * 7} of {i * 13} no {i} group" for i in range(40)]
    texts += texts[:15]
    top, size = brute_components(list(enumerate(texts)))
    got = neardup.near_duplicates(wide(spark.createDataFrame(rows(texts), SCHEMA))).collect()
    assert {r.doc_id: r.component_id for r in got} == top
    assert {r.doc_id: r.n_shingles for r in got} == size
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_pairs_outside_the_hub_are_found(spark):
    """Two copies that share their edits, each too far from the hub: only their common shingles tell."""
    rng = random.Random(9)
    base = [f"h{i}" for i in range(200)]
    texts = [" ".join(base)]
    for _ in range(12):
        t = list(base)
        for p in rng.sample(range(200), 2):
            t[p] = f"s{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    twin = list(base)
    for p in range(0, 200, 16):
        twin[p] = f"twin{p}"
    texts += [" ".join(twin), " ".join([*twin[:-1], "last"])]
    top, _ = brute_components(list(enumerate(texts)))
    assert top[13] == top[14] == 13 and top[5] == 0
    got = neardup.near_duplicates(spark.createDataFrame(rows(texts), SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == top


def test_near_duplicates_odd_rows(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    got = sorted(neardup.near_duplicates(df).collect(), key=str)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == 9 and len(by[5]) == 2 and {r.component_id for r in by[5]} == {5} and by[7][0].component_id == 5 and not by[7][0].kept
    assert by[None][0].component_id is None and by[None][0].kept
    assert by[1][0].n_shingles == by[2][0].n_shingles == by[8][0].n_shingles == 0 and by[1][0].kept
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(4)
    for share in (0.6, 0.75, 0.9):
        n = 2000
        both = int(n * 2 * share / (1 + share))
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        y = np.concatenate((x[:both], rng.integers(0, 2**63, n - both, dtype=np.uint64)))
        o = neardup.odd_sketches(np.stack([neardup.min_hashes(x), neardup.min_hashes(y)]))
        z = sum(bin(int(v) & (2**64 - 1)).count("1") for v in o[0] ^ o[1])
        assert abs(1 + neardup.BITS / (4 * neardup.SAMPLES) * np.log(1 - 2 * z / neardup.BITS) - share) < 0.12


def brute_lines(docs):
    split = {i: (t or "").split("\n") for i, t in docs}
    key = lambda x: (k := x.strip(linededup.SPACE).translate(LOW)) if len(x.strip(linededup.SPACE)) >= 40 else None
    where = {}
    for i, ls in split.items():
        for x in ls:
            if key(x):
                where.setdefault(key(x), set()).add(i)
    out = {}
    for i, ls in split.items():
        stay = [x for x in ls if not (key(x) and len(where[key(x)]) >= 5 and max(where[key(x)]) != i)]
        out[i] = (len(ls), len(ls) - len(stay), "\n".join(stay))
    return out


def line_docs(n=60):
    rng = random.Random(3)
    pool = [f"Passage number {i} that is long enough to be counted" for i in range(8)] + ["short line", "", "ÄÖÜ passage with letters beyond ascii, long enough"]
    return [(i, "\n".join(rng.choice((str.upper, str, lambda x: f"  {x}\t"))(rng.choice(pool)) if rng.random() < 0.7 else f"own line {i} {k}" for k in range(rng.randrange(1, 9)))) for i in range(n)]


def test_line_dedup_equals_brute_force(spark):
    docs = [*line_docs(), (100, None), (101, "")]
    got = linededup.dedup_lines(wide(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got} == brute_lines(docs)


@pytest.mark.parametrize("rows", [7, 40, 10**6])
def test_filters_that_travel_to_their_postings_give_the_same(spark, monkeypatch, rows):
    docs = line_docs()
    monkeypatch.setattr(linededup, "FILTER_BYTES", 0)
    monkeypatch.setattr(linededup, "SHARD_ROWS", rows)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = linededup.dedup_lines(df).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got} == brute_lines(docs)
    # the filters do their work: hardly a posting that is not live gets through
    state = linededup.LineDedup.of(df)
    live = {bytes(r.h) for r in state.live.collect()}
    hits = [bytes(r.h) for r in state.hits().collect()]
    assert set(hits) >= live and sum(h not in live for h in hits) <= 1 + len(hits) // 50


def test_changes_touch_their_own_shards_only(spark, monkeypatch):
    """A sequence of insertions, replacements and deletions, each held against brute force."""
    monkeypatch.setattr(linededup, "SHARD_ROWS", 4)
    rng = random.Random(12)
    now = dict(line_docs(40))
    df = lambda d: spark.createDataFrame(list(d.items()), "doc_id bigint, text string")
    state = linededup.LineDedup.of(df(now))

    def right():
        refs = {bytes(r.h): (r.n_docs, r.max_doc) for r in state.refs.read().collect()}
        where = {}
        for i, text in now.items():
            for k in {linededup.line_key(x) for x in (text or "").split("\n")} - {None}:
                where.setdefault(k, set()).add(i)
        assert refs == {k: (len(v), max(v)) for k, v in where.items()}
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in state.apply(df(now)).collect()}
        assert got == brute_lines(list(now.items()))

    for step in range(4):
        if step == 0:
            change = {100: "Passage number 3 that is long enough to be counted"}
        elif step == 1:
            change = {i: dict(line_docs(200))[i + 100] for i in rng.sample(sorted(now), 5)}
        elif step == 2:
            change = {100: "Passage number 5 that is long enough to be counted\nshort", 39: None}
        else:
            change = {}
        folders = dict(state.refs.folder)
        if change:
            state.insert(df(change))
            now |= change
        else:
            gone = rng.sample(sorted(now), 12)
            state.delete(df({i: None for i in gone}))
            now = {i: t for i, t in now.items() if i not in gone}
        if step == 0:
            # one key: one shard of many was written
            changed = [s for s in state.refs.folder if state.refs.folder[s] != folders.get(s)]
            assert len(changed) == 1 and len(state.refs.folder) > 5
        right()


def test_line_dedup_is_reversible(spark):
    docs = line_docs()
    df = lambda d: spark.createDataFrame(d, "doc_id bigint, text string")
    kept = lambda state, d: {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in state.apply(df(d)).collect()}
    state = linededup.LineDedup.of(df(docs[:40]))
    assert kept(state, docs[:40]) == brute_lines(docs[:40])
    state.insert(df(docs[40:]))
    state.insert(df(docs[45:]))
    assert kept(state, docs) == brute_lines(docs)
    state.delete(df(docs[20:]))
    assert kept(state, docs[:20]) == brute_lines(docs[:20])


def test_line_dedup_odd_rows(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    got = linededup.dedup_lines(df).collect()
    assert len(got) == 9 and sorted(r.kept for r in got) == sorted(x[1] or "" for x in odd_rows())
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_cuckoo_filter():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(20_000)]
    f = linededup.CuckooFilter.sized(10_000)
    f.insert(keys[:10_000])
    assert f.contains(keys[:10_000]).all() and f.contains(keys[10_000:]).mean() < 0.01
    f.delete(keys[:5000])
    assert linededup.CuckooFilter.load(f.dump()).contains(keys[5000:10_000]).all() and f.contains(keys[:5000]).mean() < 0.01
    with pytest.raises(linededup.Full):
        linededup.CuckooFilter(8).insert(keys[:100])


def test_base_statistics_equal_brute_force(spark):
    rng = random.Random(8)
    texts = ["\n".join(" ".join(rng.choice(["a", "b", "c#", "dé", "e|e"]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(9))) for _ in range(150)] + ["", None, "w " * 3000]
    got = {r.doc_id: r for r in robust.base_statistics(spark.createDataFrame(rows(texts), SCHEMA), "doc_id").collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        places = {}
        for k in range(len(w) - 4):
            places.setdefault(tuple(w[k : k + 5]), []).append(k)
        covered = {p for v in places.values() if len(v) > 1 for k in v for p in range(k, k + 5)}
        full = [x for x in t.split("\n") if WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (len(w), sum(map(len, w)), sum(c in robust.SYMBOLS for c in t), len(full) - len(set(full)), len(covered))


def test_outliers_follow_the_group(spark):
    rng = random.Random(1)
    clean = [" ".join("x" * rng.randrange(3, 9) + f"{rng.randrange(10**6)}" for _ in range(rng.randrange(60, 200))) for _ in range(300)]
    marked = [" ".join(w + "###$$$" for w in t.split()) for t in clean[:12]]
    docs = [(i, t, "en", "s") for i, t in enumerate(clean + marked)]
    got = {r.doc_id: r for r in robust.quality_rules(spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(got[i].kept for i in range(300)) and not any(got[i].kept for i in range(300, 312))


def test_quality_rules_odd_rows(spark):
    df = wide(spark.createDataFrame(odd_rows(), SCHEMA))
    got = robust.quality_rules(df).collect()
    assert len(got) == 9 and not any(r.kept for r in got if r.n_words < 10)
    assert robust.quality_rules(df.limit(0)).count() == 0
