"""Tokens, packing, search, language, toxicity, WARC and the pipeline."""

import base64
import hashlib
import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from kerbline.llm import langid, packing, tokens, topk, toxicity, warc
from kerbline.llm.queries import QUERIES
from tests.llm import brute

SF = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not SF.is_dir(), reason="test tables not found")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokens.VOCABULARY)


def texts():
    rng = random.Random(8)
    shared = " ".join(f"word{rng.randrange(500)}" for _ in range(900))
    return [
        None, "", " ", "a", "it's  two\n\nlines ", "<|endoftext|>", "pre <|endoftext|>  post <|endoftext", "   x 　 y", "é" * 5000, " " * 3000,
        "x" * 20000, "中文 " * 2000, shared, "head " + shared, shared + " tail", " " * 25_000 + "z", "1234567890 " * 1500, "\U0001f600'll don't " * 400,
    ]


def test_encoder_equals_library_on_every_code_point(plain):
    codec = tokens.load(tokens.VOCABULARY)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(chars), 40_000):
        rows = [f"a{c}b {c}1{c}{c} .{c}'s  {c}" for c in chars[low : low + 40_000 : 7]]
        assert all(e.ids == codec.encode(t) for e, t in zip(plain.encode_batch_fast(rows, add_special_tokens=False), rows, strict=True))


def test_chunked_encoding_equals_library(spark, plain):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in tokens.encode_digests(docs).collect()}
    full = {r["doc_id"]: r for r in tokens.encode_documents(docs).collect()}
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False)
        assert list(full[i]["ids"]) == ids and full[i]["decoded"] == decoded
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_shared_chunks_are_encoded_once():
    encoder = tokens.ChunkEncoder(tokens.load(tokens.VOCABULARY))
    for t in texts()[12:15]:
        encoder.encode(t, tokens.cuts(np.frombuffer(t.encode(), np.uint8)).tolist())
    assert encoder.reused >= 4


def check_packing(rows, lengths, plain, texts_by_id):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert by_doc.keys() == texts_by_id.keys()
    for i, own in by_doc.items():
        ids = np.array([*plain.encode(texts_by_id[i] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        at = 0
        for k, r in enumerate(own):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert r["length"] == packing.CAPACITY or k == 0
            at += r["length"]
        assert at == len(ids)
    return by_sequence


def test_packing_places_every_piece(spark, plain):
    rows = dict(enumerate(texts()))
    got = packing.pack(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), block=6).collect()
    sequences = check_packing(got, None, plain, rows)
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // packing.CAPACITY) + 1
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    twice = packing.pack(spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")).collect()
    assert len(twice) == 3 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3


def test_genetic_search_keeps_pieces_and_does_not_get_worse():
    rng = random.Random(2)
    packer = packing.Packer([rng.randrange(1, 700) for _ in range(300)], 1024, 1)
    start = packer.start(0)
    best = packer.evolve([], 10, 4)[0]
    assert sorted(i for b in best for i in b) == list(range(300))
    assert packer.bound <= len(best) <= len(start) and all(packer.fill(b) <= 1024 for b in best)
    child = packer.crossover(start, packer.start(0.1))
    assert sorted(i for b in child for i in b) == list(range(300))
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]


def test_top_k_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 340)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")]), (403, [float("inf")]), (404, []), (None, [1.0]), (7, [0.25] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = df.filter("vec_id % 50 = 0")
    got = sorted(tuple(r) for r in topk.top_k(df, queries).collect())
    live = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in live:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in live if i != q)
            want += [(q, k, i, -s) for k, (s, i) in enumerate(scores[:5], 1)]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0), queries).count() == 0


def test_forward_sums_all_segmentations():
    pieces = langid.vocabulary(langid.VOCABULARY)
    rng = np.random.default_rng(0)
    probs = np.zeros((pieces.size + 1, 2))
    probs[:-1] = rng.random((pieces.size, 2)) / pieces.size
    place = {w: i for i, w in enumerate(pieces.words)}

    def plainly(word, k):
        word = langid.START + word
        sums = [1.0] + [0.0] * len(word)
        for i in range(len(word)):
            for j in range(i + 1, len(word) + 1):
                p = place.get(word[i:j], pieces.unknown if j == i + 1 else None)
                sums[j] += sums[i] * (probs[p, k] if p is not None else 0)
        return math.log(sums[-1])

    for word in ("hello", "straße", "中文字", "a", "xyz" * 5):
        (at, chars), = langid._rows([word]).values()
        for block in (4, 256):
            got = langid.forward(pieces, chars, probs, block)
            assert np.allclose(got[0], [plainly(word, k) for k in range(2)])


@needs_tables
def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [r for r in QUERIES["op4_langid"](spark, str(SF)).collect() if r["held_out"]]
    assert rows and sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.98 * len(rows)
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, None), (2, "12 34 !"), (3, "zß" * 3000), (None, "the")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[3]["lang_pred"] != "und" and 0 <= got[3]["score"] <= 1
    assert langid.predict(odd, langid.fit(docs.limit(0))).filter("lang_pred <> 'und'").count() == 0


def test_languages_without_blanks_are_taught(spark):
    rng = random.Random(5)
    chars = {"ja": "これは日本語の文章です私たちは本を読みました", "zh": "这是中文句子我们读了很多书没有空格你好世界"}
    rows = [(k, lang, "".join(rng.choice(chars[lang]) for _ in range(rng.randrange(50, 400)))) for k, lang in enumerate(["ja", "zh"] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(docs.filter("doc_id < 40"))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs.filter("doc_id >= 40"), model).collect()}
    assert got == {k: lang for k, lang, _ in rows if k >= 40}


def test_expected_counts_of_long_words():
    pieces = langid.vocabulary(langid.VOCABULARY)
    start = np.array([0.02 ** len(w) for w in pieces.words] + [1e-6])
    probs = np.append(start / start.sum(), 0)
    sizes = np.array([len(w) for w in pieces.words] + [1])
    words = ["".join(random.Random(k).choices("abcdef 中é".replace(" ", ""), k=3000)) for k in range(2)]
    (at, chars), = langid._rows(words).values()
    counts = [langid.expected(pieces, chars, np.array([1.0, 3.0]), probs, block) for block in (100, 256, 4000)]
    # The pieces of any cut cover each character once.
    assert all(np.allclose(c, counts[0]) and math.isclose((c * sizes).sum(), 4 * 3001) for c in counts)


def toxic_rows(n=400):
    rng = random.Random(5)
    for i in range(n):
        w = [f"w{rng.randrange(200)}" for _ in range(60)]
        if i % 8 == 0:
            for at in rng.sample(range(60), 4):
                w[at] = rng.choice(["idiot", "scum", "zorkel", "zorkelig"])
        yield i, " ".join(w), int(i % 8 == 0)


def test_toxicity_separates_held_out_rows(spark):
    rows = list(toxic_rows())
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(None, 1), (5, None), (77777, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, _, y in rows)
    assert got[900] == got[901] < 0.5
    bare = toxicity.fit(docs, labels.limit(0))
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, bare).collect())


def test_label_model_finds_accuracies_without_labels():
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.2
    fires = np.stack([rng.random(len(y)) < np.where(y, 0.7, 0.03) for _ in toxicity.VOTERS], axis=1)
    fires[:, 1] = np.where(rng.random(len(y)) < 0.9, fires[:, 0], fires[:, 1])
    patterns, n = np.unique(fires @ (1 << np.arange(fires.shape[1])), return_counts=True)
    model = toxicity.fit_label_model(patterns, n.astype(float), np.full(len(n), -1))
    guess = model.posterior(fires @ (1 << np.arange(fires.shape[1]))) >= 0.5
    assert (guess == y).mean() > 0.99 and abs(model.share - 0.2) < 0.02
    assert model.parent[1] == 0


def test_archives_are_read_back_through_the_index(spark):
    rows = [(1, "http://www.Example.com/a?b=2&a=1", "<p>é</p>"), (2, "http://example.com/a/", "<p>é</p>"), (3, None, None), (None, "u\nv", "<p>é</p>"), (4, "http://[bad", ""), (5, "http://x.org:81/", "\r\n\r\nWARC/1.1\r\n\r\n")]
    rows += [(i, f"http://host{i % 3}.net/{i}", "y" * i) for i in range(10, 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r for r in warc.archive(pages).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        body = (html or "").encode()
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        r = got[i]
        first = min(same)
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == first else ("revisit", first))
        assert bytes(r["payload"]) == (body if i == first else b"")
    assert warc.archive(pages.limit(0)).count() == 0
    assert all(r["record_type"] == "response" for r in warc.archive(pages, least=1000).collect())


def test_index_finds_single_urls(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.com/{i // 50}", "x") for i in range(500)], "page_id long, url string, html string")
    captures = warc.write_archives(pages, f"{tmp_path}/data")
    files = warc.build_index(captures, f"{tmp_path}/index", lines=10)
    asked = spark.createDataFrame([("http://h3.com/2",), ("http://h3.com/2/",), ("http://none.com/",)], "url string")
    got = sorted(r["page_id"] for r in warc.lookup(asked, files, f"{tmp_path}/index").collect())
    assert got == [i for i in range(500) if i % 7 == 3 and i // 50 == 2]
    assert warc.url_key("http://www2.Example.com:8080/A/?b=1&a=2") == "com,example:8080)/a?a=2&b=1"


@needs_tables
def test_pipeline_stages_keep_columns_and_clean_documents(spark, plain):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.settle(stage(spark, docs, str(SF)))
        assert out.columns == docs.columns
        assert 0 < out.count() <= before
        old, new = ({r["doc_id"]: r["text"] for r in df.collect()} for df in (docs, out))
        if name == "near_dedup":
            groups = brute.components({i: brute.shingles(t, 5) for i, t in old.items()}, 80)
            assert new == {i: old[i] for i, c in groups.items() if i == c}
        if name == "substring_dedup":
            want = brute.repeats(list(old.items()))
            assert {i: hashlib.sha256(" ".join(brute.words(t)).encode()).hexdigest() for i, t in new.items()} == {i: w[2] for i, w in want.items()}
        if name == "personal_data":
            assert all(not brute.base_spans(t) for t in new.values())
            assert all(new[i] == t for i, t in old.items() if not brute.base_spans(t) and "[" not in new[i])
        docs, before = out, out.count()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, str(SF)).collect(), None, plain, rows)


def test_pipeline_stages_on_odd_and_empty_tables(spark, plain):
    """Nulls in any column, no id, repeated rows, empty and long texts, and columns with clashing names."""
    import corpus_pipeline

    rng = random.Random(3)
    prose = [" ".join(f"Sentence {k} of text {i} tells about the {rng.choice(('river', 'city', 'garden'))} number {rng.randrange(9999)}." for k in range(30)) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(prose)] + [(0, prose[0]), (None, prose[1]), (None, None), (None, ""), (50, None), (51, ""), (52, prose[2]), (53, prose[3] * 40)]
    clash = ("row", "__part", "__good", "mark", "n", "set", "bucket")
    schema = "doc_id long, text string, n_chars int, " + ", ".join(f"`{c}` string" for c in clash)
    docs = spark.createDataFrame([(i, t, None, *[None if k % 2 else c for k, c in enumerate(clash)]) for i, t in rows], schema)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = corpus_pipeline.settle(stage(spark, table, ""))
            assert out.columns == docs.columns, name
            held = [(r["doc_id"], r["text"]) for r in out.collect()]
            assert len(held) <= table.count()
            if name == "near_dedup" and held:
                assert (52, prose[2]) not in held and all((i, prose[i]) in held for i in range(2, 6))
            table = out
        last = corpus_pipeline.STAGES[-1][1](spark, table, "")
        assert (last.count() > 0) == (table.count() > 0)


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    assert QUERIES[name](spark, str(SF)).count() > 0
