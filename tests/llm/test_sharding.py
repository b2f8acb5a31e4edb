"""Shards of equal size that match the mixture."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbline.llm import queries, sharding

SCHEMA = "doc_id long, text string, source string, extra map<string,int>"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    sources = ["hot"] * 400 + ["warm"] * 150 + ["cold"] * 40 + [None] * 60 + [""] * 9 + [f"tiny{k}" for k in range(120)]
    out = [(i, rng.choice(["", None, "same text", f"text {i}", "x" * 20_000]), s, {"a": 1}) for i, s in enumerate(sources)]
    out += [(5000, "again", "hot", None)] * 4 + [(None, None, None, None)] * 3
    rng.shuffle(out)
    return out


def check(rows, got, shards):
    assert Counter(r["source"] for r in got) == Counter(r[2] for r in rows)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == shards
    for k in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sizes[k]))
    each = Counter((r["source"], r["shard"]) for r in got)
    return {s: max(abs(each[s, k] - n / shards) for k in range(shards)) for s, n in Counter(r[2] for r in rows).items()}


@pytest.mark.parametrize("shards", [1, 7, 8])
def test_every_shard_matches_the_mixture(spark, rows, shards):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    off = check(rows, sharding.interleave(docs, shards).collect(), shards)
    assert max(off.values()) <= 6
    assert off["cold"] < 2


def test_small_sources_do_not_meet_in_the_middle(spark, rows):
    got = sharding.interleave(spark.createDataFrame(rows, SCHEMA), 8).collect()
    tiny = Counter(r["shard"] for r in got if (r["source"] or "").startswith("tiny"))
    assert min(tiny[k] for k in range(8)) >= 5


def test_places_do_not_depend_on_the_layout(spark, rows):
    unique = [r for r in rows if r[0] not in (None, 5000)]
    docs = spark.createDataFrame(unique, SCHEMA)
    one, two = ({r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(d, 8).collect()} for d in (docs.repartition(1), docs.repartition(9)))
    assert one == two
    assert one != {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(docs, 8, seed=99).collect()}


def test_whole_rows_are_written_by_shard(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA).drop("extra").withColumns({"part": F.lit(1), "number": F.lit("n"), "c0": F.lit(0)})
    sharding.write_shards(docs, f"{tmp_path}/s", 4)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert set(back.columns) == {*docs.columns, "shard", "slot"} and back.count() == len(rows)
    with pytest.raises(ValueError):
        sharding.interleave(docs.withColumn("slot", F.lit(1)), 4)


def test_empty_and_tiny_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sharding.interleave(docs.limit(0), 8).count() == 0
    assert sorted((r["slot"]) for r in sharding.interleave(docs.limit(3), 8).collect()) == [0, 0, 0]


def test_query_columns(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).drop("extra").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_sharding(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
