"""Columns of any name beside those that the operators and stages read."""

import corpus_pipeline
import numpy as np
import pytest

from lidarlattice.llm import byte_bpe, language_id, quality, sentencepiece_codec, simhash, toxicity


@pytest.fixture(scope="module")
def docs(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet").selectExpr("*", "doc_id as `a.b`", "'x' as `Score`", "1 as `c d`")


def test_operators_take_any_column_name(spark, docs, tiny):
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    few = docs.where("doc_id < 30")
    n = few.count()
    made = {
        "language": language_id.identify(few, language_id.fit(docs)), "quality": quality.score_texts(few, quality.fit(docs, labels)), "toxicity": toxicity.score_toxicity(few, toxicity.fit(docs, labels.select("doc_id", "toxic"))),
        "pieces": sentencepiece_codec.digest_texts(few), "bytes": byte_bpe.digest_texts(few),
    }
    for name, out in made.items():
        rows = out.collect()
        assert len(rows) == n and "a.b" in out.columns and "c d" in out.columns and all(r["a.b"] == r["doc_id"] for r in rows), name


def test_stages_take_any_column_name(spark, docs, tiny):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, tiny)
        assert kept.columns == docs.columns, name
    rows = kept.collect()
    assert rows and all(r["a.b"] == r["doc_id"] and r["Score"] == "x" for r in rows)


def test_large_scripts_stay_within_the_table(spark, monkeypatch):
    """More n-grams than the table has room for: cells are shared, and the languages are still told apart."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(240):
        start, size = ((0x4E00, 6000) if i % 2 else (0xAC00, 9000))
        rows.append((i, "zh" if i % 2 else "ko", "".join(map(chr, start + (size * rng.random(600) ** 3).astype(int)))))
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    monkeypatch.setattr(language_id, "MOST", 1 << 17)
    model = language_id.fit(df.where("doc_id < 200"))
    assert model.cells.nbytes <= 1 << 17
    got = language_id.identify(df.where("doc_id >= 200"), model).collect()
    assert len(got) == 40 and all(r["lang_pred"] == r["lang"] for r in got)


def test_sparse_rows_fit_like_a_matrix():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["ab", "cd", "Ef", "12", "x!"], 40)) for _ in range(700)]
    terms = np.stack([quality.term_counts(t) for t in texts])
    at = [np.flatnonzero(x).astype(np.int16) for x in terms]
    sparse = quality.Sparse([(a.tobytes(), x[a].tobytes()) for a, x in zip(at, terms, strict=True)])
    assert (sparse[3:9] == terms[3:9]).all()
    labels = [int("12" in t[:20]) for t in texts]
    assert np.allclose(quality.Voter(terms, labels).score(texts[:50]), quality.Voter(sparse, labels).score(texts[:50]))


def test_near_duplicates_take_any_column_name(docs):
    assert set(simhash.keep_one(docs).columns) == set(docs.columns)
