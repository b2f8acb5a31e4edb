"""Shards that all match the source mixture, by proportional stratified interleaving.

Rows are shuffled by a seeded hash inside their source and numbered there. Row ``r`` of a source
with ``n`` rows stands at the fraction ``(r + phase) / n``; the phase, from 0 to 1, is a hash of the
source, so that sources of a few rows do not all stand in the middle. All rows are sorted by that
fraction and cut into runs whose sizes differ by one at most. A run takes the same share of every
source, and so does the beginning of a run.

Both orders come from range sorts. A stored part knows its own order, and the sizes of the parts
before it give the place in the whole, so neither a source with a third of all rows nor the whole
table is ever ordered in one task.

Defined cases: rows without a source are a source of their own. Rows that are equal in the id and
all other columns given can change places. Ties of the fraction fall by source, then by hash. An
empty table gives no rows. Columns of the input may have any names but ``shard`` and ``slot``,
which are refused; they keep their names and order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from kerbline.scale import BROADCAST_ROWS, settle, within

SEED = 13


def _in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """The rows sorted by range and stored with their part and a number that rises within it."""
    return settle(df.orderBy(*order).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("number")))


def _hashable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def _upto(df: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Attach one row a key, by broadcast only if it is small."""
    return df.join(F.broadcast(parts) if within(parts, BROADCAST_ROWS) else parts, keys)


def interleave(docs: DataFrame, shards: int, source: str = "source", seed: int = SEED) -> DataFrame:
    """All rows with ``shard`` (from 0) and ``slot`` (their place there, without gaps)."""
    names = docs.columns
    if taken := {"shard", "slot"} & {n.lower() for n in names}:
        raise ValueError(f"input has the columns {sorted(taken)}")
    inner = [f"c{i}" for i in range(len(names))]
    plain = docs.toDF(*inner)
    stratum = F.col(inner[names.index(source)]).cast("string")
    hashed = [F.col(f.name) for f in plain.schema.fields if _hashable(f.dataType)]
    rows = plain.withColumns({
        "none": stratum.isNull(),
        "stratum": F.coalesce(stratum, F.lit("")),
        "hash": F.xxhash64(F.lit(seed), *hashed),
    })
    placed = _in_order(rows, "none", "stratum", "hash")
    keys = ["none", "stratum"]
    runs = settle(placed.groupBy(*keys, "part").agg(F.count("*").alias("rows"), F.min("number").alias("first")))
    # A source meets only as many rows here as it has parts.
    totals = runs.groupBy(*keys).agg(F.sum("rows").alias("total"), F.sort_array(F.collect_list(F.struct("part", "rows", "first"))).alias("parts"))
    before = F.aggregate(F.slice("parts", 1, F.col("k")), F.lit(0).cast("long"), lambda n, p: n + p["rows"])
    starts = totals.select(*keys, "total", "parts", F.posexplode("parts").alias("k", "here")).select(
        *keys, "total", F.col("here.part").alias("part"), F.col("here.first").alias("first"), before.alias("before")
    )
    phase = F.pmod(F.xxhash64(F.lit(seed + 1), *keys), F.lit(1 << 20)) / (1 << 20)
    ranked = _upto(placed, settle(starts), [*keys, "part"])
    fraction = (F.col("before") + F.col("number") - F.col("first") + phase) / F.col("total")
    mixed = _in_order(ranked.select(*inner, *keys, "hash", fraction.alias("fraction")), "fraction", *keys, "hash")
    # Bounded: one row a part.
    parts = sorted(mixed.groupBy("part").agg(F.count("*").alias("rows"), F.min("number").alias("first")).collect())
    starts, n = [], 0
    for part, size, first in parts:
        starts.append((part, n - first))
        n += size
    shift = mixed.sparkSession.createDataFrame(starts, "part int, shift long")
    place = mixed.join(F.broadcast(shift), "part").withColumn("place", F.col("number") + F.col("shift"))
    # Shard k takes the places from k * n div shards up to the next such number.
    out = place.withColumn("shard", F.expr(f"({shards} * place + {shards - 1}) div {max(n, 1)}").cast("int"))
    slot = F.col("place") - F.expr(f"(cast(shard as bigint) * {n}) div {shards}")
    return out.select(*[F.col(i).alias(name) for i, name in zip(inner, names, strict=True)], "shard", slot.alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, source: str = "source", seed: int = SEED) -> None:
    """One folder ``shard=k`` for each shard, its rows sorted by slot within each file."""
    out = interleave(docs, shards, source, seed)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
