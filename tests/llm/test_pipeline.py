"""The corpus pipeline, stage by stage, against brute force on what each stage was given."""

import os
import random
import sys

import numpy as np
import pytest

import corpus_pipeline
from ohmbridge.llm import bpe, gbdt, mixing

sys.path.insert(0, os.path.dirname(__file__))
from test_models import graded  # noqa: E402
from test_text_ops import SCHEMA, brute_components, brute_lines, edited_family, odd_rows  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(4)
    docs, labels = graded(240)
    shared = [f"A passage that many documents share, number {k}, long enough" for k in range(4)]
    texts = [t + ("\n" + rng.choice(shared) if rng.random() < 0.5 else "") for _, t in docs] + edited_family(3, 40) + [shared[0]] * 3
    rows = [(i, t, rng.choice(["en", "de", None]), f"src{rng.randrange(4)}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, tables):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "mixture", "encode"]
    docs = corpus_pipeline.common.documents(spark, tables)
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.materialize(stage(spark, docs, tables), name)
        seen[name] = docs.collect()
        if name != "encode":
            assert docs.columns == columns
    start = corpus_pipeline.common.documents(spark, tables).collect()
    scores = {r.doc_id: r.score for r in gbdt.quality_scores(corpus_pipeline.common.documents(spark, tables), spark.read.parquet(f"{tables}/labels.parquet")).collect()}
    assert {r.doc_id for r in seen["quality"]} == {r.doc_id for r in start if scores[r.doc_id] >= 0.5} and len(seen["quality"]) < len(start)
    left = brute_lines([(r.doc_id, r.text) for r in seen["quality"]])
    expected = {i: t for i, (_, n, t) in left.items() if t or not n}
    assert {r.doc_id: r.text for r in seen["lines"]} == expected and any(n for _, n, _ in left.values())
    assert all(r.n_chars == len(r.text) for r in seen["lines"])
    top, _ = brute_components([(r.doc_id, r.text) for r in seen["lines"]])
    assert {r.doc_id for r in seen["near_duplicates"]} == {i for i in top if top[i] == i}
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    given, kept = words(seen["near_duplicates"]), words(seen["mixture"])
    assert len({r.doc_id for r in seen["mixture"]}) == len(seen["mixture"]) and abs(kept - corpus_pipeline.BUDGET * given) < 0.15 * given and kept < given
    own = bpe.encoder(bpe.vocabulary_path())
    texts = {r.doc_id: r.text for r in seen["mixture"]}
    for r in seen["encode"]:
        assert np.array(r.ids, "<u4").tobytes() == own.encode_batch([texts[r.doc_id]])[0] and own.decode(np.array(r.ids, "<u4").tobytes()) == texts[r.doc_id]
    assert {tuple(r) for r in corpus_pipeline.run(spark, tables).select("doc_id", "n_tokens").collect()} == {(r.doc_id, r.n_tokens) for r in seen["encode"]}
    assert mixing.EPOCHS == 4


def test_odd_rows_pass_through(spark, tables):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, tables)
        assert docs.count() >= 0
