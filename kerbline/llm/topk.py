"""Exact top-k by inner product: term-at-a-time accumulation over blocks of postings.

Vectors are sparse rows of integer weights; a component is a term. Candidates and queries are
dealt at random to groups of bounded size. In a cell (one candidate group, one query group) each
term of a query adds its weighted postings to a dense array of scores; a partial selection keeps
the ``k`` best, and the cells of a query are merged.

Defined cases: rows with a null id, a null vector, or a null or non-finite component take no part;
components beyond the shorter vector count as zero; equal scores go to the smaller id; rows that
repeat an id are candidates each, but never for a query of their own id; every query row gets its
own result; no queries or candidates give no rows. Scores are exact while they fit in 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbline.scale import settle

CANDIDATES = 16_384
QUERIES = 2_048
TOGETHER = 32


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, null if any is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(fine, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of the non-zero components of a list column."""
    lists = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    size = np.diff(lists.offsets.to_numpy())
    weights = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(size)), size)
    terms = np.arange(len(weights)) - np.repeat(np.cumsum(size) - size, size)
    live = weights != 0
    return rows[live], terms[live], weights[live]


def _postings(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    rows, terms, weights = _flat(column)
    order = np.argsort(terms, kind="stable")
    rows, terms, weights = rows[order], terms[order], weights[order]
    starts = np.flatnonzero(np.diff(terms, prepend=-1))
    return {int(terms[a]): (rows[a:b], weights[a:b]) for a, b in zip(starts, np.append(starts[1:], len(terms)), strict=True)}


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; of equal ones the first places."""
    if len(scores) <= k:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > edge)
    return np.concatenate([above, np.flatnonzero(scores == edge)[: k - len(above)]])


def _cell(k: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_key", "query_id", "vec_id", "score"]
        if not candidates.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        candidates = candidates.sort_by("vec_id")
        ids = candidates.column("vec_id").to_numpy()
        postings = _postings(candidates.column("w"))
        keys, own = queries.column("query_key").to_numpy(), queries.column("query_id").to_numpy()
        rows, terms, weights = _flat(queries.column("w"))
        out = []
        lowest = np.iinfo(np.int64).min
        for low in range(0, len(keys), TOGETHER):
            high = min(low + TOGETHER, len(keys))
            scores = np.zeros((high - low, len(ids)), dtype=np.int64)
            mine = (rows >= low) & (rows < high)
            for term in np.unique(terms[mine]).tolist():
                if term not in postings:
                    continue
                at = mine & (terms == term)
                docs, values = postings[term]
                part = weights[at][:, None] * values[None, :]
                if len(docs) == len(ids):
                    scores[rows[at] - low] += part
                else:
                    scores[np.ix_(rows[at] - low, docs)] += part
            for q in range(high - low):
                line = scores[q]
                same = slice(np.searchsorted(ids, own[low + q]), np.searchsorted(ids, own[low + q], side="right"))
                others = np.ones(len(ids), dtype=bool)
                others[same] = False
                if others.all():
                    best = _best(line, k)
                else:
                    line[same] = lowest
                    best = _best(line, k + same.stop - same.start)
                    best = best[others[best]]
                    best = best[np.lexsort((ids[best], -line[best]))][:k]
                out.append((np.full(len(best), keys[low + q]), np.full(len(best), own[low + q]), ids[best], line[best]))
        return pa.table({n: pa.array(np.concatenate(c)) for n, c in zip(names, zip(*out, strict=True), strict=True)})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query row."""

    def prepared(df: DataFrame, seed: int) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector), scale).alias("w"))
        # The salt is stored, so groups stay the same if a task runs again.
        return settle(rows.filter("vec_id is not null and w is not null").withColumn("salt", F.floor(F.rand(seed) * F.lit(float(1 << 52))).cast("long")))

    cand, quer = prepared(vectors, 3), prepared(queries, 5)
    tasks = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n, m = cand.count(), quer.count()
    n_cand = max(-(-n // CANDIDATES), min(tasks, -(-n // 512)), 1)
    n_quer = max(-(-m // QUERIES), 1)
    # Both sides are copied along one edge of the grid of cells, so a cell holds two bounded groups.
    cand = cand.withColumn("c", F.pmod("salt", F.lit(n_cand)).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_quer - 1))))
    quer = quer.withColumn("q", F.pmod("salt", F.lit(n_quer)).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_cand - 1))))
    left = cand.select("c", "q", "vec_id", "w").groupBy("c", "q")
    right = quer.select("c", "q", F.col("salt").alias("query_key"), F.col("vec_id").alias("query_id"), "w").groupBy("c", "q")
    found = left.cogroup(right).applyInArrow(_cell(k), "query_key long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_key", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
