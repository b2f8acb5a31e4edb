"""Token alignment against a plain version."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from kerbline.llm import alignment

SCHEMA = "doc_id long, text string"
ALPHABET = " \n\t\r ▁　aéß中😀0129.,'!<s></s><|endoftext|>\x00\x1c\u0085​"


def groups_of(enc, text):
    """[(ids of A, ids of B)] by the ends both have."""
    if not text:
        return []
    a = enc.plain.encode(f" {text}", add_special_tokens=False).ids
    b = enc.b.encode(text)
    parts = [enc.a.table[x] for x in a], [enc.bytes_b[x] for x in b]
    if any(b"".join(p) != f" {text}".encode() for p in parts):
        return []
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    out, i, j = [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def plain(rows):
    enc = alignment.encoder(alignment.VOCABULARY, alignment.PIECES)
    found = [(i, groups_of(enc, t)) for i, t in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for _, g in found]
    df = Counter(p for one in links for p in set(one))
    top = defaultdict(int)
    for (a, _), n in df.items():
        top[a] = max(top[a], n)
    out = []
    for (i, g), one in zip(found, links, strict=True):
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        digest = hashlib.sha256(line.encode()).hexdigest() if g else ""
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(one), sum(df[p] == top[p[0]] for p in one), sum(df[p] for p in one), digest))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(k, "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 60)))) for k in range(300)]
    odd = [None, "", " ", "<|endoftext|> <s>", "x" * 9000, "▁▁a", "中" * 500, " " * 300, "\n" * 50, "the cat sat on the mat. " * 3000]
    out += [(1000 + i, t) for i, t in enumerate(odd)]
    return [*out, (2000, "the cat sat"), (2000, "the cat sat"), (2000, "the dog"), (None, "no id"), (None, "no id")]


@pytest.mark.parametrize("hot", [alignment.HOT, 40, 0])
def test_counts_equal_the_plain_version(spark, rows, hot):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, alignment.align_counts(docs, hot=hot).collect()), key=str) == plain(rows)


def test_wide_groups_are_added_up_by_ids(monkeypatch):
    enc = alignment.encoder(alignment.VOCABULARY, alignment.PIECES)
    texts = ["中文😀 unbelievable unbelievable", None, "ééé ▁", "straightforwardly 中中中"]
    usual = alignment.Aligned(enc, texts).pairs(32_000)
    monkeypatch.setattr(alignment, "WIDE", 1)
    for x, y in zip(alignment.Aligned(enc, texts).pairs(32_000), usual, strict=True):
        assert x.tolist() == y.tolist()


def test_lanes_find_every_common_end():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.02, 0.5, 0.98, 1.0):
        ends = np.arange(1, 4000)
        a, b = (np.append(ends[rng.random(len(ends)) < keep], 4000) for keep in (0.9, max(share, 0.01)))
        if share == 1.0:
            b = a.copy()
        x, y = alignment.common_ends(a, b)
        assert a[x - 1].tolist() == b[y - 1].tolist() == np.intersect1d(a, b).tolist()


def test_whole_alignment_gives_ids_and_group_sizes(spark):
    enc = alignment.encoder(alignment.VOCABULARY, alignment.PIECES)
    got = alignment.align(spark.createDataFrame([(1, "straightforwardly é"), (2, None)], SCHEMA)).orderBy("doc_id").collect()
    want = groups_of(enc, "straightforwardly é")
    assert got[0]["a_ids"] == [x for a, _ in want for x in a] and got[0]["b_ids"] == [x for _, b in want for x in b]
    assert got[0]["a_sizes"] == [len(a) for a, _ in want] and got[0]["b_sizes"] == [len(b) for _, b in want]
    assert got[1]["a_ids"] == got[1]["b_sizes"] == []


def test_empty_table_and_clashing_columns(spark):
    assert alignment.align_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    extra = spark.createDataFrame([(1, "a b", 7, "x", b"y")], "doc_id long, text string, row long, pairs string, links binary")
    assert alignment.align_counts(extra).first()["n_a"] == 2
