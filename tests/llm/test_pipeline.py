"""The pipeline's stages on a small table, each against what it must do by hand."""

import hashlib
import re

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from lidarlattice.llm import language_id, quality, sentencepiece_codec, simhash
from lidarlattice.llm._common import cut, held_out, table


def groups_by_hand(rows):
    prints = [simhash.fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        best[find(i)] = min(doc_id, best.get(find(i), doc_id))
    return sorted(best.values())


def test_stages(spark, tiny):
    docs = table(spark, tiny, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = cut(stage(spark, docs, tiny))
        seen.append((name, docs, out))
        docs = out
    assert [n for n, *_ in seen] == ["quality classifier", "language ID", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]
    assert all(out.columns == columns for _, _, out in seen[:-1])
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    _, before, after = seen[0]
    model = quality.fit(before, table(spark, tiny, "labels"))
    assert ids(after) == sorted(r["doc_id"] for r in before.collect() if model.score([r["text"]])[0] >= 0.3) and len(ids(after)) < len(ids(before))

    _, before, after = seen[1]
    model = language_id.fit(before.where(~held_out()))
    rows = before.collect()
    named = zip(*model.predict([r["text"] for r in rows]), strict=True)
    assert ids(after) == sorted(r["doc_id"] for r, (lang, score) in zip(rows, named, strict=True) if lang != "und" and score >= corpus_pipeline.LANGUAGE_SCORE)

    _, before, after = seen[2]
    assert ids(after) == groups_by_hand(sorted((r["doc_id"], r["text"]) for r in before.collect())) and len(ids(after)) < len(ids(before))
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}

    _, before, after = seen[3]
    words = lambda t: re.findall(r"\w+", t.lower())
    windows = {tuple(w[k : k + 10]) for b in table(spark, tiny, "benchmark").collect() for w in [words(b["text"])] for k in range(len(w) - 9)}
    clean = sorted(r["doc_id"] for r in before.collect() if not any(tuple(w[k : k + 10]) in windows for w in [words(r["text"])] for k in range(len(w) - 9)))
    assert ids(after) == clean

    _, before, after = seen[4]
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    want = {r["doc_id"]: hashlib.sha256(",".join(map(str, library.encode(r["text"]))).encode()).hexdigest() for r in before.collect()}
    assert {r["doc_id"]: r["ids_sha256"] for r in after.collect()} == want


def test_stages_on_odd_rows(spark, tiny):
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "12 34 !!", "en", "s", 8), (4, "Of the and a text.", None, None, 1), (4, "Of the and a text.", None, None, 1), (None, "Of the and a text.", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, tiny).collect()
        assert len(out) <= odd.count(), name
        assert stage(spark, odd.limit(0), tiny).collect() == []
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, tiny).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["text"] == "Of the and a text.") == [(4, "Of the and a text.")]


def test_close_languages_keep_clean_documents(spark, small):
    """The labels of each language split into six, as close varieties would be: no clean document may go, whatever the number of languages."""
    docs = table(spark, small, "documents").where("lang is not null and n_chars >= 200")
    split = docs.withColumn("lang", F.concat("lang", (F.col("doc_id") % 6).cast("string")))
    clean = table(spark, small, "labels").where("quality = 1").select("doc_id")
    few, many = (ids.join(clean, "doc_id").select("doc_id") for ids in (corpus_pipeline.keep_language(spark, d, small) for d in (docs, split)))
    want = sorted(r["doc_id"] for r in docs.join(clean, "doc_id").select("doc_id").collect())
    assert sorted(r["doc_id"] for r in few.collect()) == want
    assert sorted(r["doc_id"] for r in many.collect()) == want
    strange = spark.createDataFrame([(1, "xqzv wkjq zzxv qqwp vbnm kjhg xzcv qwpt", "en", "s", 40)], docs.schema)
    held = split.where("lang is not null").unionByName(strange.withColumn("doc_id", F.lit(-5).cast("long")))
    assert corpus_pipeline.keep_language(spark, held, small).where("doc_id = -5").count() == 0
