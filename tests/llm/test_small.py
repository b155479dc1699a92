"""Nulls, empty and long texts, ties, repeats, empty tables and clashing names, for every text operator."""

import gzip
import hashlib
import math
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lidarlattice.llm import decontaminate, html_extract, language_id, quality, sentencepiece_codec, sharding, toxicity, vectors, warc
from lidarlattice.llm._common import held_out

ROWS = [(1, None), (2, ""), (3, "Of the and a."), (3, "Of the and a."), (None, "één wörd ▁ 日本 🙂 \n\t x"), (5, "long text of words " * 20000), (6, "  ")]


@pytest.fixture(scope="module")
def docs(spark):
    """Columns beside id and text clash with what the operators add."""
    return spark.createDataFrame([(i, t, 7, "x", 0.5, "y", 1) for i, t in ROWS], "doc_id long, text string, size int, key string, score_ double, word string, id int")


def test_sentencepiece(spark, docs, tiny):
    path = sentencepiece_codec.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)

    def want(t):
        ids = library.encode(t or "")
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    for df in (docs.select("doc_id", "text"), spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")):
        texts = sorted(((r[0], *want(r[1])) for r in df.collect()), key=str)
        assert sorted(map(tuple, sentencepiece_codec.digest_texts(df, path).collect()), key=str) == texts
    got = sentencepiece_codec.encode_texts(docs, path).collect()
    assert all(r["ids"] == library.encode(r["text"] or "") and r["decoded"] == library.decode(r["ids"]) for r in got)
    assert sentencepiece_codec.digest_texts(docs.limit(0), path).collect() == []


def test_sentencepiece_on_hard_texts():
    import random

    path = sentencepiece_codec.default_model()
    codec, library, rng = sentencepiece_codec.codec(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(4)
    alphabet = ["a", " ", "  ", "▁", "the", "ing", "1", "\n", "é", "日", "🙂", "\x00", "aaa", "er", "st", "tion", "<0x0A>", "<s>", "́", "    ", "==", "//"]
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert codec.encode(t) == library.encode(t) and codec.decode(library.encode(t)) == library.decode(library.encode(t))


def by_hand(doc_id, tree):
    """Spark's xxhash64 of (path, id) is XXH64 of the id's bytes seeded by XXH64 of the path's."""
    import xxhash

    path, node = "", tree
    while isinstance(node, dict):
        best = None
        children = list(node.items())
        for i, (name, child) in enumerate(children):
            h = xxhash.xxh64_intdigest(f"{path}/{name}".encode(), 42)
            h = xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), h) if doc_id is not None else h
            draw = -math.log(((h >> 11) + 0.5) / 2**53) / sharding.weight(child)
            best = min(best or (draw, i), (draw, i))
        name, node = children[best[1]] if len(children) > 1 else children[0]
        path = f"{path}/{name}"
    return node[0]


def test_shards(spark, docs, small):
    tree = sharding.balanced_tree()
    for df in (docs, spark.read.parquet(f"{small}/documents.parquet")):
        texts = sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
        got = sharding.shard_documents(df, tree).collect()
        assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got), key=str) == sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), by_hand(i, tree), by_hand(i, sharding.grow(tree))) for i, t in texts), key=str)
        for shard in range(24):
            slots = sorted(r["slot"] for r in got if r["shard"] == shard)
            assert slots == list(range(len(slots)))
        assert all(r["grown_shard"] in (r["shard"], 24) and r["law"] == "key" for r in got)
    assert sharding.shard_documents(docs.limit(0), tree).collect() == []


def test_weights_move_rows_in_their_subtree_only(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = sharding.balanced_tree(2, 2, 2)
    changed = {r: {k: dict(v) for k, v in racks.items()} for r, racks in tree.items()}
    changed["region0"]["rack0"]["shard0"] = (0, 3.0)
    rows = ids.select(sharding.descend(tree).alias("a"), sharding.descend(changed).alias("b")).collect()
    moved = [(r["a"], r["b"]) for r in rows if r["a"] != r["b"]]
    assert moved and all(b < 4 for a, b in moved if a >= 4) and not any(a < 4 and b >= 4 for a, b in moved)
    share = sum(r["b"] == 0 for r in rows) / len(rows)
    assert abs(share - 0.3) < 0.03


PAGE = '<html lang="en"><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a><li><a href="/b">More</a></ul></nav><div class="ad">Buy now.</div><article><h1>A &amp; B</h1><p>First  line\n of the text, with some words in it.<p>Second&nbsp;one: caf&eacute; &#8364;5.<aside class="related">See also this.</aside></article><section class="comments"><p>I like it a lot.</p></section><footer>&copy; x</footer></body></html>'


def test_main_text(spark, tiny):
    import html
    import re

    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    model = html_extract.fit(pages)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, PAGE), (3, PAGE), (None, "just text"), (5, "<p>" * 3000 + "x"), (6, "<div <p a='>' \"")], "page_id long, html string")
    got = {(r["page_id"], r["n_chars"]): r["text"] for r in html_extract.main_text(odd, model).collect()}
    assert [t for (i, _), t in got.items() if i == 3] == ["A & B\nFirst line of the text, with some words in it.\nSecond one: café €5."]
    assert got[1, 0] == "" and got[2, 0] == "" and all(n == len(t) for (_, n), t in got.items())
    assert html_extract.main_text(odd.limit(0), model).collect() == []

    def gold(source):
        body = re.search(r"<article>(.*)</article>", source, re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " ")))).strip() for p in re.split(r"</?(?:p|h1)>", body))
        return "\n".join(p for p in parts if p)

    assert all(r["text"] == gold(r["html"]) for r in html_extract.main_text(pages.withColumn("copy", F.col("html")), model).withColumnRenamed("copy", "html").collect())


def test_decoding_never_keeps_below_what_it_drops(spark):
    page = html_extract.Page(PAGE)
    rng = np.random.default_rng(1)
    for _ in range(50):
        logit = rng.normal(size=len(page.tag)) * 3
        keep = html_extract.decode(page, logit)
        assert all(keep[page.parent[k]] or not keep[k] for k in range(1, len(keep)))


def test_warc(spark, tiny, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", PAGE), (1, "http://a", PAGE), (2, None, None), (None, "http://b", "")], "page_id long, url string, html string")
    source = warc.responses(pages)
    made = warc.derivatives(source.withColumn("extra", F.lit(1)).unionByName(source.limit(1).withColumn("warc_type", F.lit("request")).withColumn("extra", F.lit(1))))
    rows = [r.asDict() for r in made.collect()]
    by_id = {r["record_id"]: r.asDict() for r in source.collect()}
    assert len(rows) == 8 and {r["warc_type"] for r in rows} == {"metadata", "conversion"}
    for r in rows:
        origin = by_id[r["refers_to"]]
        assert (r["payload_digest"], r["target_uri"], r["warc_date"]) == (origin["payload_digest"], origin["target_uri"], origin["warc_date"])
        assert r["block_digest"] == warc.digest(r["block"]) and r["content_length"] == len(r["block"])
        payload = origin["block"].partition(b"\r\n\r\n")[2]
        assert origin["payload_digest"] == warc.digest(payload) and origin["block_digest"] == warc.digest(origin["block"])
    metadata = next(r for r in rows if r["warc_type"] == "metadata" and r["key"] == 1)
    assert b"via-header: Content-Type: text/html; charset=utf-8" in metadata["block"] and b"outlinks: 2" in metadata["block"] and any(r["record_id"] == metadata["concurrent_to"] and r["warc_type"] == "conversion" for r in rows)
    every = made.drop("key").unionByName(source.drop("key"))
    warc.write_warc(every, str(tmp_path / "w"))
    files = warc.read_warc(spark, str(tmp_path / "w" / "part-*")).drop("key")
    back = files.where("warc_type <> 'warcinfo'")
    assert files.where("warc_type = 'warcinfo'").count() == len([p for p in (tmp_path / "w").glob("part-*") if p.stat().st_size])
    same = lambda df: sorted((tuple((k, r[k] or None) for k in sorted(r.asDict())) for r in df.collect()), key=str)
    assert same(back) == same(every)
    assert gzip and warc.derivatives(source.limit(0)).collect() == []


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, "Tom has 5 apples and gives 3 apples to Mary before walking 12 km to the old school on Friday"), (2, "short one here now"), (3, ""), (4, None), (5, "7 8 9")], "item_id long, text string")
    rows = [
        (1, "So here: Tom has 7 apples and gives 4 apples to Anna before walking 15 miles to the old school on Friday.", [1], True),
        (2, "Then Tom has 7 apples and gives 7 apples to Anna before walking 7 km to the old school on Friday.", [], False),
        (3, "a short one here now", [2], False), (3, "a short one here now", [2], False), (4, None, [], False), (5, "", [], False), (None, "x Tom has 5 apples and gives 3 apples to Mary before walking 12 km to the old school on Friday", [1], False), (7, "nothing to see here " * 20000, [], False), (8, "1 2 3", [], False),
    ]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t, *_ in rows], "doc_id long, text string, key string, n_windows int")
    got = sorted(((r["doc_id"], r["item_ids"], r["reparameterised"], r["contaminated"]) for r in decontaminate.mark(df, bench).collect()), key=str)
    assert got == sorted(((i, ids, changed, bool(ids)) for i, _, ids, changed in rows), key=str)
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((i for i, _, ids, _ in rows if not ids), key=str)
    assert decontaminate.mark(df.limit(0), bench).collect() == [] and not any(r["contaminated"] for r in decontaminate.mark(df, bench.limit(0)).collect())


def test_decontamination_finds_copies_word_for_word(spark):
    items = ["What is 12 + 7 * 3 - 4 ?", "A B C D A C B D", "New York Los Angeles San Diego Santa Fe Las Vegas", "Paris is the capital of France", "如果小明有十二个苹果他还剩几个", "小明有几个", "Der Hund Bello von Herrn Karl Meier aus Bonn"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, f"{before}{t}{after}", [i]) for i, t in enumerate(items[:4] + items[6:]) for before, after in (("", ""), ("we were asked: ", " and so on"), ("and then ", " or not"))]
    rows = [(i, t, ids if i < 4 else [6]) for i, t, ids in rows]
    rows += [(20, f"老师问大家{items[4]}呢", [4]), (21, f"老师问{items[5]}呢", [5]), (22, "老师问大家苹果还剩几个呢", []), (23, "What is 15 + 9 * 2 - 6 ?", []), (24, "D C B A B A D C", []), (25, "Berlin is the town of France", []), (26, "Der Hund Rex von Frau Eva Weber aus Kiel", [])]
    docs = spark.createDataFrame([(k, t) for k, (_, t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.mark(docs, bench).collect()}
    assert got == {k: ids for k, (*_, ids) in enumerate(rows)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench).collect()) == [k for k, (*_, ids) in enumerate(rows) if not ids]


def test_decontamination_of_a_table_by_hand(spark, small):
    import re

    docs, bench = (spark.read.parquet(f"{small}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    words = lambda t: re.findall(r"\w+", t.lower())
    index = {}
    for b in bench:
        w = words(b["text"])
        for k in range(len(w) - 9):
            index.setdefault(tuple(w[k : k + 10]), set()).add(b["item_id"])
    want = {}
    for r in docs:
        w = words(r["text"])
        if found := set().union(*(index.get(tuple(w[k : k + 10]), ()) for k in range(len(w) - 9))):
            want[r["doc_id"]] = sorted(found)
    assert want and {r["doc_id"]: r["item_ids"] for r in decontaminate.op1_decontaminate(spark, small).where("contaminated").collect()} == want


def test_top_k(spark):
    rng = np.random.default_rng(3)
    vecs = [(i, [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(180)]
    vecs += [(200, vecs[0][1]), (201, vecs[0][1]), (202, None), (203, [None] * 16), (204, [float("nan")] * 16), (250, [0.0] * 16), (300, [-1.5] * 16), (None, [0.1] * 16)]
    df = spark.createDataFrame([(i, v, 3) for i, v in vecs], "vec_id long, embedding array<float>, score int")
    want = []
    whole = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in vecs if i is not None and v and None not in v and not np.isnan(v).any()}
    for q, qv in whole.items():
        if q % 50 == 0:
            best = sorted(((-int(qv @ v), i) for i, v in whole.items() if i != q))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    for shards, block in ((3, 2), (1, 100)):
        got = sorted(map(tuple, vectors.top_k(df, 5, 50, shards=shards, block=block).collect()))
        assert got == sorted(want)
    assert vectors.top_k(df.limit(0), 5, 50).collect() == []


def test_top_k_of_a_table(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.floor(256 * np.array([r["embedding"] for r in rows], np.float64)).astype(np.int64)
    want = []
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        order = [i for i in np.lexsort((ids, -s)) if i != q][:5]
        want += [(int(ids[q]), k + 1, int(ids[i]), int(s[i])) for k, i in enumerate(order)]
    assert sorted(map(tuple, vectors.op3_maxscore(spark, small).select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)


def test_language(spark, docs, small):
    r = language_id.op6_language_id(spark, small).join(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = r.where("lang_pred = lang").count(), r.count()
    assert n > 100 and right / n > 0.95
    model = language_id.fit(spark.read.parquet(f"{small}/documents.parquet"))
    got = sorted(((x["doc_id"], x["lang_pred"], x["score"]) for x in language_id.identify(docs, model).collect()), key=str)
    assert len(got) == len(ROWS) and all(0 <= s <= 1 for *_, s in got) and [p for i, p, _ in got if i in (1, 2, 6)] == ["und"] * 3 and language_id.identify(docs.limit(0), model).collect() == []
    assert {x["lang_pred"] for x in language_id.identify(docs, language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.95), (toxicity, "toxic", 0.85)])
def test_classifiers(spark, docs, small, module, label, least):
    table = {"quality": quality.op8_quality, "toxic": toxicity.op9_toxicity}[label](spark, small)
    r = table.join(spark.read.parquet(f"{small}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(x["predicted"] == x[label] for x in r) / len(r) > least and table.count() == 1000
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (5, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        model = module.fit(docs, given)
        got = (module.score_texts if module is quality else module.score_toxicity)(docs, model).collect()
        assert len(got) == len(ROWS) and all(0 <= x["score"] <= 1 for x in got)
    assert quality.score_texts(docs.limit(0), model).collect() == []


def test_toxic_words_with_gaps_are_found():
    random = np.random.default_rng(0)
    common = ["house", "river", "green", "stone", "walked", "slowly", "under", "bright", "window", "garden"]
    clean = [" ".join(random.choice(common, 12)) + "." for _ in range(300)]
    bad = [" ".join(random.choice(common, 6)) + " wretchbag " + " ".join(random.choice(common, 5)) for _ in range(60)]
    model = toxicity.Scorer(clean + bad, [0] * 300 + [1] * 60)
    scores = model.score(["you wretchbag.", "you w r e t c h b a g now", "you w.r.e.t.c.h.b.a.g", "you wretcxhbag", "the green garden", "", None])
    assert min(scores[:4]) > 0.5 > max(scores[4:])


def test_folds(spark):
    ids = [0, 1, 2, 17, -5, 10**12]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out().alias("h")).collect()
    assert {r["doc_id"]: r["h"] for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}
