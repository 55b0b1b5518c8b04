"""Trained models, secrets, media and mixing: held-out quality, exact recomputation, round trips, odd inputs."""

import collections
import hashlib
import itertools
import math
import os
import random
import re
import sys
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ohmbridge.llm import automaton, gbdt, hmm, jpeg, langid, mixing, secrets, textkernel as tk
from ohmbridge.operators.graph import connected_components as components

sys.path.insert(0, os.path.dirname(__file__))
from jpeg_encoder import encode  # noqa: E402
from test_text_ops import LOW, SCHEMA, WORD, odd_rows, wide  # noqa: E402


def held(i, m, r):
    return zlib.crc32(str(i).encode()) % m == r


VOICES = {
    "en": "the of and with from house river stone light water under over never people walking slowly towards evening".split(),
    "de": "der die und nicht über straße größe zwischen mädchen schön haus fluss stein licht wasser unter abend gehen".split(),
    "fr": "le la les été près forêt maison rivière pierre lumière eau sous jamais gens marchant vers soirée où".split(),
}


def voiced(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = sorted(VOICES)[i % 3]
        out.append((i, " ".join(rng.choice(VOICES[lang]) for _ in range(rng.randrange(5, 60))), lang))
    return out


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: find(i) for i in top}


# --- quality classifier ---


def graded(n):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = [rng.choice(VOICES["en"]) + str(rng.randrange(50)) for _ in range(rng.randrange(30, 90))]
        docs.append((i, " ".join(w + "###" if bad and rng.random() < 0.7 else w for w in words)))
        labels.append((i, 0 if bad else 1))
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = graded(600)
    got = {r.doc_id: r for r in gbdt.quality_scores(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality bigint")).collect()}
    rows = [(got[i].predicted, q) for i, q in labels if got[i].held_out]
    assert all(got[i].held_out == held(i, 3, 1) for i, _ in labels) and len(rows) > 100
    assert sum(p == q for p, q in rows) / len(rows) > 0.97


def test_quality_does_not_learn_from_held_out_labels(spark):
    docs, labels = graded(300)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    swapped = [(i, 1 - q if held(i, 3, 1) else q) for i, q in labels]
    one, two = ({r.doc_id: r.score for r in gbdt.quality_scores(df, spark.createDataFrame(x, "doc_id bigint, quality bigint")).collect()} for x in (labels, swapped))
    assert one == two


def test_forest_walks_like_a_plain_tree():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    f = gbdt.Forest.fit(x, (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float), trees=10, depth=3)
    for row, score in zip(x[:50], f.score(x[:50]), strict=True):
        total = f.start
        for feature, threshold, value in zip(f.feature, f.threshold, f.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert abs(score - 1 / (1 + math.exp(-total))) < 1e-6


def test_histogram_fit_equals_a_plain_one():
    """The first tree's root, by trying every cut of every statistic, and its leaves by their rows."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (400, 5)).astype(np.float32)
    y = ((x[:, 2] > 6) ^ (rng.random(400) < 0.1)).astype(float)
    forest = gbdt.Forest.fit(x, y, trees=2, depth=2)
    share = (y.sum() + 1) / (len(y) + 2)
    g, h = share - y, np.full(len(y), share * (1 - share))

    def best(at):
        found = []
        for j in range(x.shape[1]):
            edges = np.unique(np.quantile(x[:, j], np.linspace(0, 1, gbdt.BINS + 1)[1:-1]).astype(np.float32))
            for e in edges:
                left = at & (x[:, j] <= e)
                right = at & ~left
                if min(left.sum(), right.sum()) >= gbdt.LEAST:
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + gbdt.RIDGE) for s in (left, right)) - g[at].sum() ** 2 / (h[at].sum() + gbdt.RIDGE)
                    found.append((gain, j, float(e)))
        return max(found, key=lambda f: f[0])

    every = np.ones(len(x), bool)
    _, j, e = best(every)
    assert (forest.feature[0, 0], forest.threshold[0, 0]) == (j, e)
    sides = [x[:, j] <= e, x[:, j] > e]
    for k, side in enumerate(sides):
        gain, j2, e2 = best(side)
        if forest.threshold[0, 1 + k] != np.inf:
            assert (forest.feature[0, 1 + k], forest.threshold[0, 1 + k]) == (j2, e2)
            for leaf, rows in enumerate((side & (x[:, j2] <= e2), side & (x[:, j2] > e2))):
                assert forest.value[0, 2 * k + leaf] == pytest.approx(-gbdt.RATE * g[rows].sum() / (h[rows].sum() + gbdt.RIDGE), rel=1e-4)


def test_quality_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumns({"__text": F.lit("x"), "score": F.lit(2), "_score": F.lit(3), "stats": F.lit(4), "__score": F.lit(5)})
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1)], "doc_id bigint, quality int")
    got = gbdt.keep_quality(df, labels)
    assert got.columns == df.columns and got.count() <= 9
    assert all((r["__text"], r.score, r["_score"], r.stats, r["__score"]) == ("x", 2, 3, 4, 5) for r in got.collect())
    scored = gbdt.score_documents(df, gbdt.Forest.fit(np.zeros((0, len(gbdt.FEATURES))), np.zeros(0)))
    assert scored.count() == 9 and set(scored.columns) == set(df.columns)


def test_quality_odd_rows(spark):
    df = wide(spark.createDataFrame(odd_rows(), SCHEMA))
    none = spark.createDataFrame([], "doc_id bigint, quality bigint")
    some = spark.createDataFrame([(1, None), (2, 0), (4, 1), (4, 1), (None, 1), (5, 7)], "doc_id bigint, quality bigint")
    for labels in (none, some):
        got = gbdt.quality_scores(df, labels).collect()
        assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
        assert gbdt.keep_quality(df, labels).columns == df.columns
    assert gbdt.quality_scores(df.limit(0), some).count() == 0


# --- language ID ---


def test_language_on_held_out_rows(spark):
    docs = voiced(600)
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = langid.identify(df, langid.train(df.where(~langid.held_out(F.col("doc_id")))), "doc_id").collect()
    right = [r.lang_pred == docs[r.doc_id][2] for r in got if held(r.doc_id, 5, 0)]
    assert len(right) > 80 and sum(right) / len(right) > 0.98
    junk = spark.createDataFrame([(1, "zxqj wvkz qqxz jjwq zzkx qxqx vvzj " * 20), (2, "12 34 ..."), (3, None)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in langid.identify(junk, langid.train(df), "doc_id").collect()}
    assert rows[1].rejected and rows[1].lang_pred in VOICES and rows[2].lang_pred == rows[3].lang_pred == "und"


def test_kneser_ney_sums_to_one():
    code, off, _ = langid.windows(pa.array([t for _, t, _ in voiced(30)]))
    u, n = np.unique(code, return_counts=True)
    model = langid.KneserNey(u, n)
    for context in (int(u[0]) >> 8, int(u[len(u) // 2]) >> 8, 0x7F7E7D):
        p = np.exp(model.log_prob(np.array([(context & 0xFFFFFF) << 8 | s for s in range(256)])))
        assert abs(p.sum() - 1) < 1e-9


def test_windows_equal_plain_ones():
    texts = ["Ab é1!", "", None, "  x", "漢字ж"]
    symbol, letter = langid.fold_tables()
    code, off, has = langid.windows(pa.array(texts))
    for t, a, b, h in zip(texts, off[:-1], off[1:], has, strict=True):
        s = []
        for ch in t or "":
            v = int(symbol[ord(ch)])
            if v or not s or s[-1]:
                s.append(v)
        s = [0, 0, 0, *s, 0]
        assert code[a:b].tolist() == [s[i] << 24 | s[i + 1] << 16 | s[i + 2] << 8 | s[i + 3] for i in range(len(s) - 3)]
        assert h == any(c.isalpha() for c in t or "")


def test_each_letter_has_its_own_symbols():
    letters = "абвгдежзиклмнопрстуфхцчшщыэюяіїєґ" + "αβγδεζηθ" + "ابتثجحخپچژگ" + "कखगघािी" + "אבגדה" + "漢字" + "\U00020000\U00020400\U00020401"
    code, off, has = langid.windows(pa.array(list(letters)), 16)
    assert len({tuple(code[a:b].tolist()) for a, b in zip(off[:-1], off[1:], strict=True)}) == len(letters)
    code, off, _ = langid.windows(pa.array(["Жab", "ж AB", "жab", "\U00020400x"]), 16)
    assert code[off[0] : off[1]].tolist() == code[off[2] : off[3]].tolist() == [0x436, 0x436_0061, 0x436_0061_0062, 0x436_0061_0062_0000]
    assert code[off[3] : off[4]].tolist()[:3] == [0xD841, 0xD841_DC00, 0xD841_DC00_0078]


def test_wide_kneser_ney_sums_to_one():
    code, _, _ = langid.windows(pa.array(["где дом и река", "а тут лес", "дом у реки"]), 16)
    model = langid.KneserNey(*np.unique(code, return_counts=True), 16)
    for context in (int(code[5]) >> 16, 0xFFFF_FFFE_FFFD):
        p = np.exp(model.log_prob(np.array([(context & 0xFFFF_FFFF_FFFF) << 16 | s for s in range(1 << 16)], np.uint64)))
        assert abs(p.sum() - 1) < 1e-9


def test_languages_of_one_script_are_told_apart(spark):
    voices = {"ru": "где дом река лес они были вода снег поле утро ночь день стол рука нога".split(), "xx": "кун руб тош маз опа ложа гита фара зико пела дыма шару рене мака бува".split()}
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(voices[lang]) for _ in range(20)), lang) for i in range(300) for lang in [sorted(voices)[i % 2]]]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = langid.identify(df, langid.train(df.where(~langid.held_out(F.col("doc_id")))), "doc_id").where(langid.held_out(F.col("doc_id"))).collect()
    assert len(got) > 30 and all(r.lang_pred == docs[r.doc_id][2] for r in got)


def test_models_beyond_the_bound_are_whole(spark):
    docs = voiced(90) + [(1000 + i, t, "rare") for i, t in enumerate(["qual zwo drei wub", "wub qual xol", "xol trem zwo kem"])] + [(2000, None, "en"), (2001, "", "de"), (2002, "1 2", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    near, far = langid.train(df), langid.train(df, max_grams=200)
    assert far.tables is not None and far.langs == near.langs and far.sharp == near.sharp
    assert np.allclose(far.mean, near.mean, atol=1e-3)
    a, b = ({r.doc_id: r for r in langid.identify(df, m, "doc_id").collect()} for m in (near, far))
    assert len(a) == len(b) == len(docs)
    for i, r in a.items():
        assert (r.lang_pred, r.rejected) == (b[i].lang_pred, b[i].rejected)
        assert abs(r.cross_entropy - b[i].cross_entropy) < 1e-5 and abs(r.score - b[i].score) < 1e-3
    assert {b[1000 + i].lang_pred for i in range(3)} == {"rare"}


def test_rare_languages_are_calibrated(spark):
    many = spark.range(60_000).select("id", F.concat(F.lit("the river and the house under the evening light "), F.col("id") % 7).alias("text"), F.lit("en").alias("lang"))
    rare = spark.range(60_000, 60_030).select("id", F.concat(F.lit("der fluss und das haus unter dem abend und licht "), F.col("id") % 3).alias("text"), F.lit("de").alias("lang"))
    models = langid.train(many.unionByName(rare).withColumnRenamed("id", "doc_id"))
    assert models.langs == ["de", "en"] and np.isfinite(models.sd).all()


def test_language_odd_rows(spark):
    df = wide(spark.createDataFrame(odd_rows(), SCHEMA))
    got = langid.identify(df, langid.train(df), "doc_id").collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert langid.identify(df, langid.train(df.limit(0)), "doc_id").where("lang_pred = 'und'").count() == 9


# --- hidden Markov model ---


def brute_likelihood(model, ids):
    total = 0.0
    for path in itertools.product(range(len(model.start)), repeat=len(ids)):
        p = model.start[path[0]] * model.emit[ids[0], path[0]]
        for a, b, w in zip(path, path[1:], ids[1:], strict=False):
            p *= model.move[a, b] * model.emit[w, b]
        total += p
    return math.log10(total)


def small_model(seed=0, states=3, words=5):
    rng = np.random.default_rng(seed)
    share = lambda *s: (x := rng.random(s) + 0.05) / x.sum(-1, keepdims=True)
    return hmm.Hmm(share(states), share(states, states), share(states, words).T)


def test_forward_equals_all_paths():
    model = small_model()
    texts = [[0, 1, 2, 3], [], [3], [2, 2, 1, 0, 0]]
    woff = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    lay = hmm.Layout(np.array(sum(texts, [])), woff, 4)
    assert np.allclose(model.log10_likelihood(lay), [brute_likelihood(model, [*t, 4]) for t in texts])


def test_expected_counts_and_likelihood_rise():
    model = small_model(1)
    texts = [[0, 1, 1], [2, 0], [1], [3, 3, 2, 1]]
    woff = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    before = -1e9
    for _ in range(5):
        lay = hmm.Layout(np.array(sum(texts, [])), woff, 4)
        start, moves, share = model.expected(lay)
        assert abs(start.sum() - 4) < 1e-9 and abs(moves.sum() - 10) < 1e-9 and np.allclose(share.sum(1), 1)
        now = model.log10_likelihood(lay).sum()
        assert now >= before - 1e-9
        before = now
        count = np.zeros((5, 3))
        np.add.at(count, lay.ids, share)
        model = hmm.Hmm(start / start.sum(), moves / moves.sum(1, keepdims=True), (count + 1e-9) / (count + 1e-9).sum(0))


@pytest.mark.parametrize("kept,emitted", [(10**6, 65536), (15, 8)])
def test_language_scores(spark, kept, emitted):
    docs = [(i, t) for i, t, _ in voiced(300, 5)] + [(900, None), (901, ""), (902, "never seen words here")]
    got = {r.doc_id: r for r in hmm.language_scores(spark.createDataFrame(docs, "doc_id bigint, text string"), states=3, kept=kept, emitted=emitted).collect()}
    tokens = {i: WORD.findall((t or "").translate(LOW)) + [None] for i, t in docs}
    c = collections.Counter(w for i, t in tokens.items() if not held(i, 7, 2) for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        assert abs(got[i].base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) < 1e-6
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (len(t), sum(c[w] > 0 for w in t), n, held(i, 7, 2))
    out = [got[i] for i in tokens if i < 900 and held(i, 7, 2)]
    # with few emitted words the states know little but classes
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * (1 if emitted > 100 else 1.05)


def test_words_that_are_not_broadcast_have_emissions(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in voiced(200, 6)] + [(900, None), (901, "unseen words")], "doc_id bigint, text string")
    near, far = ({r.doc_id: r for r in hmm.language_scores(docs, states=3, emitted=n).collect()} for n in (65536, 0))
    # only the first model differs: from there on, words have the states' shares either way
    assert near.keys() == far.keys() and all((near[i].n_known, near[i].n_tokens) == (far[i].n_known, far[i].n_tokens) for i in near)
    assert all(abs(near[i].base_score - far[i].base_score) < 1e-9 for i in near)
    voc = hmm.Vocabulary(np.array([5, 7], np.uint64), np.array([4, 3]), 2, 12, 4)
    assert voc.find(np.array([7, 5, 9, 8], np.uint64)).tolist() == [1, 0, -1, -1] and voc.far == 5
    # mixed bounds: the same start for all words that are broadcast gives a close fit
    some = {r.doc_id: r for r in hmm.language_scores(docs, states=3, emitted=25).collect()}
    gain = lambda x: sum(r.score - r.base_score for r in x.values())
    assert gain(some) > 0.7 * gain(near) > 0


def test_a_rare_voice_has_part_in_the_start(spark):
    many = [(i, " ".join(VOICES["en"] * 8)) for i in range(4000)]
    rare = [(9000, " ".join(VOICES["fr"] * 8))]
    docs = spark.createDataFrame(many + rare, "doc_id bigint, text string")
    voc = hmm.vocabulary(hmm.word_counts(docs), 4001)
    centre = hmm.clusters(hmm.token_rows(docs, voc), 2)
    x = hmm.directions(*hmm.tokens(pa.array([many[0][1], rare[0][1]])))
    assert sorted((x @ centre.T).argmax(1).tolist()) == [0, 1] and np.allclose((x @ centre.T).max(1), 1)


def test_rounds_go_on_until_the_likelihood_stops(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in voiced(150, 8)], "doc_id bigint, text string")
    gain = lambda **k: hmm.language_scores(docs, states=3, emitted=30, **k).where("not held_out").agg(F.sum("score")).first()[0]
    one, two, full = gain(steps=1), gain(steps=2), gain()
    assert one <= two <= full + 1e-6 * abs(full)


def test_language_model_odd_rows(spark):
    df = wide(spark.createDataFrame(odd_rows(), SCHEMA))
    got = hmm.language_scores(df, states=2).collect()
    assert len(got) == 9 and all(math.isfinite(r.score) for r in got)
    assert hmm.language_scores(df.limit(0), states=2).count() == 0


# --- secrets ---


def test_automaton_equals_regexes():
    random.seed(3)
    patterns = [r"ab+c?", r"(?i:key)=\d{2,4}x", r"[^a-c\s]{3}z", r"(foo|ba(r|z))*qux", r"\.\x2d[0-9a-f]{5,}"]
    made = automaton.Automaton(patterns)
    plain = [re.compile(p.encode(), re.ASCII) for p in patterns]
    texts = ["".join(random.choice(["a", "b", "c", "KEY=", "key=", "12", "345", "x", "z", "foo", "bar", "qux", ".-", "0af", " ", "é"]) for _ in range(random.randrange(25))) for _ in range(3000)]
    for part in (texts, texts[:7], ["", "ab"], [""]):
        buf, off = tk.string_buffer(pa.array(part))
        assert made.scan(buf, off) == sorted((i, r) for i, t in enumerate(part) for r, p in enumerate(plain) if p.search(t.encode()))


def test_automaton_is_minimal():
    made = automaton.Automaton(["abc", "abd"])
    # start, a, ab, and the two hits
    assert len(made.table) == 5


def test_lanes_do_not_matter():
    made = automaton.Automaton([r"a[b ]{200}c"])
    text = "x" * 1000 + "a" + "b" * 200 + "c" + "y" * 3000
    buf, off = tk.string_buffer(pa.array([text, "a" + "b" * 199, "bc"]))
    assert all(made.scan(buf, off, lanes) == [(0, 0)] for lanes in (1, 3, 17, 64))


def brute_secrets(t):
    t = t or ""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets_equal_brute_force(spark):
    random.seed(7)
    al = ["password", "PassWd", "token", "api_key", "secret", "=", ":", " ", '"', "abc", "deadbeef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é", "\n", "漢", "ſecret", "ghp_" + "a1B2" * 9]
    docs = [(i, "".join(random.choice(al) for _ in range(random.randrange(30)))) for i in range(1500)] + [(2000, None), (2001, ""), (2002, "secret=token: abcdefgh")]
    got = {r.doc_id: r.secrets for r in secrets.find_secrets(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id").collect()}
    seen = 0
    for i, t in docs:
        base = [(s.start, s.stop, s.kind) for s in got[i] if s.kind in ("assign", "access", "hex")]
        assert base == [(a, b, k) for a, _, b, k in brute_secrets(t)]
        seen += any(s.kind == "forge" for s in got[i])
    assert seen and got[2002] == []


#: The rules as another engine reads them; each with the least length of what it finds.
PLAIN = {
    "forge": (r"gh[opsur]_[A-Za-z0-9]+", 40), "chat": (r"xox[abprs]-[0-9A-Za-z-]+", 15), "maps": (r"AIza[0-9A-Za-z_-]{35}", 0), "pay": (r"[sr]k_live_[0-9A-Za-z]+", 24),
    "web": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0), "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0), "login": (r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@", 0),
}


def test_all_rules_equal_brute_force():
    random.seed(11)
    made = secrets.compiled(secrets.RULES)
    run = lambda al, n: "".join(random.choice(al) for _ in range(n))
    word, parts = "abcdefABCDEF0123456789", []
    for _ in range(40):
        n = random.choice([0, 3, 7, 8, 9, 15, 16, 23, 24, 34, 35, 36, 40, 300])
        parts += ["ghp_" + run(word, n), "gho_" + run(word, 36) + "_", "xoxb-" + run(word + "-", n), "AIza" + run(word + "_-", n), "sk_live_" + run(word, n), "eyJ" + run(word, n) + ".eyJ" + run(word + "-_", n) + "." + run(word, n)]
        parts += [f"-----BEGIN {random.choice(['', 'RSA ', 'EC '])}PRIVATE KEY-----", "https://" + run(word, 3) + ":" + run(word + "é漢", 4) + "@host", "a+b://:@", "AKIA" + run("ABC123", n), "token: '" + run(word, n), run("0123456789abcdef", n)]
    glue = ["", " ", "\n", "é", "漢", ":", "/", "@", ".", "-", "eyJ", "AIza", "ghp_", "://", "secret=", '"']
    texts = ["".join(random.choice(parts) + random.choice(glue) for _ in range(random.randrange(12))) for _ in range(1500)] + ["", "x"]
    found = made.spans(*tk.string_buffer(pa.array(texts)))
    kinds = [r.kind for r in secrets.RULES]
    seen = collections.Counter()
    for i, t in enumerate(texts):
        expected = [(a, kinds.index(k), b) for a, _, b, k in brute_secrets(t)]
        expected += [(m.start(), kinds.index(k), m.end()) for k, (p, least) in PLAIN.items() for m in re.finditer(p, t, re.ASCII) if len(m[0]) >= least]
        assert found.get(i, []) == sorted(expected)
        seen.update(r for _, r, _ in found.get(i, []))
    assert min(seen[r] for r in range(len(kinds))) > 20


def test_pieces_and_lanes_do_not_matter():
    made = secrets.compiled(secrets.RULES).starts
    random.seed(4)
    texts = ["".join(random.choice(["deadbeef", "token=abcdefgh", " ", "é", "https://a:b@", "xyz"]) for _ in range(random.randrange(60))) for _ in range(40)] + [None, ""]
    buf, off = tk.string_buffer(pa.array(texts))
    whole = [x.tolist() for x in made.places(buf, off)]
    for lanes, piece in ((1, 1 << 20), (5, 777), (64, 100), (2048, 13)):
        assert [x.tolist() for x in made.places(buf, off, lanes, piece)] == whole


def test_long_runs_take_linear_time():
    """A million characters without a break, with and without a finding at the end."""
    made = secrets.compiled(secrets.RULES)
    started = time.time()
    for text, n in (("a" * 1_000_000, 1), ("x" * 1_000_000 + "://", 0), ("x" * 1_000_000 + "://u:p@", 1), ("eyJ" * 300_000, 0), ("x" * 500_000 + "://" + "y" * 500_000, 0), ("AKIA" * 250_000, 1)):
        found = made.spans(*tk.string_buffer(pa.array([text])))
        assert len(found.get(0, [])) == n
    assert time.time() - started < 120


def test_secrets_odd_rows(spark):
    df = wide(spark.createDataFrame(odd_rows(), SCHEMA))
    assert [r.secrets for r in secrets.find_secrets(df, "doc_id").collect()] == [[]] * 9
    assert secrets.find_secrets(df.limit(0), "doc_id").count() == 0


# --- media ---


def frame(width, height, sampling, seed, dense):
    rng = np.random.default_rng(seed)
    d = jpeg.Decoder.__new__(jpeg.Decoder)
    d.width, d.height = width, height
    d.components = [jpeg.Component(i + 1, h, v, 0) for i, (h, v) in enumerate(sampling)]
    d.hmax, d.vmax = max(h for h, _ in sampling), max(v for _, v in sampling)
    d.quant = {0: np.arange(1, 65).astype(np.int32) // 8 + 1}
    for c in d.components:
        c.lay(width, height, d.hmax, d.vmax)
        own = c.own_order()
        blocks = np.zeros((len(own), 64), np.int64)
        blocks[:, 0] = rng.integers(-200, 200, len(own))
        for b in blocks:
            k = rng.choice(63, rng.integers(0, dense), replace=False) + 1
            b[k] = rng.integers(-40, 41, len(k))
        c.coef[own] = blocks
        if len(d.components) > 1:
            rest = np.setdiff1d(np.arange(len(c.coef)), own)
            c.coef[rest, 0] = 5
    return d


@pytest.mark.parametrize("width,height,sampling", [(40, 24, [(1, 1)]), (50, 37, [(2, 2), (1, 1), (1, 1)]), (33, 20, [(2, 1), (1, 1), (1, 1)]), (16, 16, [(1, 1)] * 3)])
@pytest.mark.parametrize("dense", [1, 6, 60])
def test_decoder_reads_all_scans(width, height, sampling, dense):
    d = frame(width, height, sampling, width + dense, dense)
    got = jpeg.Decoder(encode(d, d.quant[0].tolist()))
    for x, y in zip(d.components, got.components, strict=True):
        assert (x.coef == y.coef).all()
    assert got.rgb().shape == (height, width, 3)


def test_inverse_transform_and_upsampling():
    d = frame(32, 32, [(2, 2), (1, 1), (1, 1)], 1, 5)
    planes = []
    for c in d.components:
        plane = np.zeros((c.bh * 8, c.bw * 8))
        for n, block in enumerate(c.coef):
            f = np.zeros(64)
            f[jpeg.ZIGZAG] = block * d.quant[0]
            f = f.reshape(8, 8)
            y, x = divmod(n, c.bw)
            for i, j in itertools.product(range(8), repeat=2):
                plane[y * 8 + i, x * 8 + j] = sum((math.sqrt(0.5) if u == 0 else 1) * (math.sqrt(0.5) if v == 0 else 1) * f[u, v] * math.cos((2 * i + 1) * u * math.pi / 16) * math.cos((2 * j + 1) * v * math.pi / 16) for u, v in itertools.product(range(8), repeat=2) if f[u, v]) / 4
        planes.append(np.clip(plane + 128, 0, 255))
    for mine, plain in zip(d.planes(), planes, strict=True):
        assert np.abs(mine - plain).max() <= 0.51
    y, cb, cr = planes[0], *(np.kron(p, np.ones((2, 2))) for p in planes[1:])
    plain = np.stack([y + 1.402 * (cr - 128), y - 0.344136 * (cb - 128) - 0.714136 * (cr - 128), y + 1.772 * (cb - 128)], 2)
    assert np.abs(d.rgb() - np.clip(plain, 0, 255)).max() <= 2.5


def test_pack_is_lossless():
    for n in (64, 128, 384, 64 * 37, 64 * 7000, 64 * 32767 * 7):
        p = os.urandom(n) if n < 10**6 else bytes(range(256)) * (n // 256)
        assert jpeg.unpack(jpeg.Decoder(jpeg.pack(p))) == p
    for p in (b"\x00" * 64, b"\xff" * 640, b"\x7f\x80" * 32):
        assert jpeg.unpack(jpeg.Decoder(jpeg.pack(p))) == p


def test_frames_larger_than_their_file_are_refused(spark):
    raw = bytearray(jpeg.pack(b"x" * 64))
    at = raw.index(b"\xff\xc2")
    raw[at + 5 : at + 9] = b"\xff\xff\xff\xff"
    started = time.time()
    df = spark.createDataFrame([(bytes(raw),)], "media binary").withColumns({"height": F.lit("x"), "rgb": F.lit(1), "error": F.lit(2), "payload": F.lit(3), "width": F.lit(4)})
    (r,) = jpeg.decode_media(df).collect()
    assert r.rgb is None and "larger" in r.error and time.time() - started < 20


def test_tensors_are_stored_and_read_back(spark, tmp_path):
    docs = spark.createDataFrame([(1, "abc" * 100), (2, None)], "doc_id bigint, text string")
    media = jpeg.store_texts(docs, "doc_id")
    rows = jpeg.store_tensors(media, str(tmp_path / "tensors")).collect()
    for r, m in zip(sorted(rows, key=lambda r: r.doc_id), media.orderBy("doc_id").collect(), strict=True):
        assert bytes(r.rgb) == jpeg.Decoder(bytes(m.media)).rgb().tobytes() and len(r.rgb) == 3 * r.height * r.width


def test_media_odd_rows(spark):
    df = wide(spark.createDataFrame(odd_rows(), SCHEMA))
    got = jpeg.decode_media(jpeg.store_texts(df, "doc_id", "text")).collect()
    assert len(got) == 9
    for r in got:
        raw = (r.text or "").encode()
        assert bytes(r.payload) == raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0") and r.n_bytes == len(raw) and len(r.rgb) == r.height * r.width * 3 and r.error is None
    bad = spark.createDataFrame([(None,), (b"",), (b"\xff\xd8 no",), (bytes(jpeg.pack(b"x" * 64))[:200],)], "media binary")
    assert all(r.rgb is None and r.error for r in jpeg.decode_media(bad).collect())
    assert jpeg.decode_media(bad.limit(0)).count() == 0


# --- mixing ---


def brute_share(budget, kids):
    """Fill children one by one by capacity over weight."""
    out, left, open_ = {}, budget, dict(kids)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, c) in open_.items() if c <= left * w / total + 1e-12]
        if not full:
            out |= {k: left * w / total for k, (w, _) in open_.items()}
            break
        k = min(full, key=lambda k: (open_[k][1] / open_[k][0], k))
        out[k] = open_[k][1]
        left -= open_.pop(k)[1]
    return out


@pytest.mark.parametrize("budget,epochs", [(0.4, 1), (1.0, 4), (3.5, 4), (9.0, 2)])
def test_mixing_equals_brute_force(spark, budget, epochs):
    rng = random.Random(2)
    docs = [(i, " ".join("w" for _ in range(rng.randrange(0, 40))), rng.choice(["en", "en", "de", None]), rng.choice([f"src{k}" for k in range(5)] + ["src0"] * 6)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    dom = mixing.domain_of(F.col("source"))
    got = {r.doc_id: r for r in mixing.with_copies(df, dom, mixing.plan(df, dom, budget, mixing.WEIGHTS, epochs)).collect()}
    leaf = {i: (got[i]["__domain"], got[i]["__lang"], got[i]["__source"]) for i in got}
    size = collections.Counter()
    for i, t, _, _ in docs:
        size[leaf[i]] += len(t.split())
    total = sum(size.values())
    cap = lambda pre: sum(v for k, v in size.items() if k[: len(pre)] == pre) * epochs
    kids = lambda pre: sorted({k[: len(pre) + 1] for k in size if k[: len(pre)] == pre})
    weight = lambda k: (mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, {})[len(k) - 1].get(k[-1], 1.0)
    share = {(): budget * total}
    for depth in range(3):
        for pre in [p for p in share if len(p) == depth]:
            share |= brute_share(share[pre], {k: (weight(k), cap(k)) for k in kids(pre)})
    for k in size:
        target = math.floor(share[k] + 1e-6)
        full = target // size[k] if size[k] else 0
        rest, run = target - full * size[k], 0
        mine = sorted((i for i in leaf if leaf[i] == k), key=lambda i: hashlib.md5(f"{mixing.SEED}:{full + 1}:{i}".encode()).hexdigest())
        for i in mine:
            assert got[i]["__copies"] == full + (run < rest), (k, i)
            run += got[i]["__tokens"]
    if budget <= epochs:
        assert abs(sum(share[k] for k in size) - budget * total) < 1e-6


def test_a_weight_of_zero_leaves_out(spark):
    docs = [(i, "w " * 10, lang, f"src{k}") for i, (lang, k) in enumerate([("en", 0), ("de", 0), ("en", 1), ("de", 1), ("fr", 2)] * 20)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    count = lambda w, budget=0.3: collections.Counter((r.lang, r.source) for r in mixing.mix(df, budget, w, epochs=1).collect())
    some = count({"lang": {"de": 0.0}})
    assert not any(lang == "de" for lang, _ in some) and sum(some.values()) >= 30
    # a domain all of whose languages are left out gives its budget to its siblings
    assert set(count({"lang": {"fr": 0.0}}, 1.0)) == {("en", "src0"), ("de", "src0"), ("en", "src1"), ("de", "src1")}
    assert count({"domain": {"d0": 0.0, "d1": 0.0, "d2": 0.0}}) == {} == count({"source": {"src0": 0, "src1": 0, "src2": 0}})


def test_mixing_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumns({"__domain": F.lit(1), "__copies": F.lit("x"), "__tokens": F.lit(2), "c0": F.lit(3)})
    got = mixing.mix(df, 1.0, mixing.WEIGHTS)
    assert got.columns == df.columns and {(r["__domain"], r["__copies"], r["__tokens"], r.c0) for r in got.collect()} == {(1, "x", 2, 3)}


def test_mixing_odd_rows(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumns({"n": F.lit(1), "tokens": F.lit("x"), "domain": F.lit(2), "key": F.lit(3), "full": F.lit(4), "copies": F.lit(5)})
    got = mixing.mix(df, 1.0, mixing.WEIGHTS)
    assert got.columns == df.columns and got.count() > 0
    assert mixing.mix(df.limit(0), 1.0, mixing.WEIGHTS).count() == 0
