"""Isolation forest (Liu, Ting and Zhou, 2008) on Spark tasks.

Trees are grown in parallel on small random subsets; rows are scored by
batches against the shipped trees. Both the subset size and the number of trees
are parameters, so the trees are bounded whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from kerbline.columns import col, measured, numeric, present
from kerbline.operators.sampling import sample_at_most
from kerbline.profile import CONTAMINATION
from kerbline.scale import likely_tasks, settle

FEWEST_ROWS = 100
TREES = 100
SUBSET = 256
ROWS_PER_TASK = 2_000
# Rows scored together: a matrix of rows by trees.
BLOCK = 1_024


def _complete_rows(df: DataFrame, names: list[str], key: str) -> DataFrame:
    rows = df.select(col(key).alias("key"), *[numeric(n).alias(f"x{i}") for i, n in enumerate(names)])
    for i in range(len(names)):
        rows = rows.filter(measured(F.col(f"x{i}")))
    return rows


def grow_trees(rows: DataFrame, n_rows: int, n_features: int, trees: int = TREES, subset: int = SUBSET, seed: int = 42) -> DataFrame:
    """One row per node of every tree. Each tree sees about ``subset`` rows, apart from the others' if there are enough."""
    # One hash of the whole row deals it: a retried task repeats it, and a frequent key does not
    # come as a block. Large tables give each row to one tree at most, small ones to several.
    wanted = trees * subset
    dealt = F.xxhash64(F.lit(seed), "key", *[F.col(f"x{i}") for i in range(n_features)])
    if n_rows >= wanted:
        # The hash as a number in [0, 1), stretched so that the trees take the first part of it.
        place = (F.shiftrightunsigned(dealt, 11) / float(1 << 53)) * (n_rows / subset)
        chosen = rows.withColumn("tree", F.floor(place).cast("long")).filter(F.col("tree") < trees).withColumn("tree", F.col("tree").cast("int"))
    else:
        repeats = min(trees, -(-wanted // max(1, n_rows)))
        ways = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
        chosen = rows.withColumn("__way", ways).withColumn("tree", F.pmod(F.pmod(dealt, F.lit(trees)) + F.col("__way"), F.lit(trees)).cast("int")).drop("__way")
    depth_limit = max(1, (min(subset, max(n_rows, 2)) - 1).bit_length())

    def grow(frame):
        import numpy as np
        import pandas as pd

        tree = int(frame["tree"].iloc[0])
        ordered = frame.sort_values("key", kind="stable")
        data = ordered[[f"x{i}" for i in range(n_features)]].to_numpy(dtype=float)
        draw = np.random.default_rng([seed, tree])
        nodes = []

        def split(block, depth):
            number = len(nodes)
            nodes.append(None)
            low, high = block.min(axis=0), block.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(block) <= 1 or len(usable) == 0:
                nodes[number] = (tree, number, -1, 0.0, -1, -1, len(block), depth)
                return number
            feature = int(draw.choice(usable))
            cut = float(draw.uniform(low[feature], high[feature]))
            goes_left = block[:, feature] <= cut
            if goes_left.all():
                cut = float(low[feature])
                goes_left = block[:, feature] <= cut
            left = split(block[goes_left], depth + 1)
            right = split(block[~goes_left], depth + 1)
            nodes[number] = (tree, number, feature, cut, left, right, len(block), depth)
            return number

        split(data, 0)
        names = ["tree", "node", "feature", "cut", "left", "right", "size", "depth"]
        return pd.DataFrame(nodes, columns=names)

    schema = "tree int, node int, feature int, cut double, left int, right int, size int, depth int"
    return chosen.groupBy("tree").applyInPandas(grow, schema)


def _average_path(n):
    """Mean depth of a search that ends without a match among ``n`` rows."""
    import numpy as np

    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    full = 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


def _flat(table):
    """All trees as flat arrays (feature, cut, high and low child, path length), their roots and levels.

    A leaf is its own child, so all rows take as many steps as the deepest tree has levels.
    """
    import numpy as np

    table = table.sort_values(["tree", "node"], kind="stable").reset_index(drop=True)
    roots = np.flatnonzero(table["node"].to_numpy() == 0)
    base = np.repeat(roots, np.diff(np.append(roots, len(table))))
    leaf = table["feature"].to_numpy() < 0
    own = np.arange(len(table))
    low = np.where(leaf, own, base + table["left"].to_numpy())
    high = np.where(leaf, own, base + table["right"].to_numpy())
    path = table["depth"].to_numpy() + _average_path(table["size"].to_numpy())
    children = np.stack([high, low], axis=1).ravel()
    return np.where(leaf, 0, table["feature"]), table["cut"].to_numpy(), children, path, roots, int(table["depth"].max())


def isolation_scores(df: DataFrame, names: Iterable[str], key: str, sample: int | None = None, seed: int = 42, n_rows: int | None = None) -> DataFrame:
    """Rows (key, score): the nearer to 1, the easier a row is to set apart.

    Every complete row is scored, unless a ``sample`` is asked for; trees are
    always grown on the small subsets. ``n_rows`` saves counting the complete
    rows again.
    """
    found = present(df, names)
    n_features = len(found)
    rows = _complete_rows(df, found, key)
    if sample is not None:
        rows = settle(sample_at_most(rows, sample, "key", seed))
    if sample is not None or n_rows is None:
        n_rows = rows.count()
    subset = min(SUBSET, max(n_rows, 2))
    cores = df.sparkSession.sparkContext.defaultParallelism
    scored = rows
    if sample is not None or likely_tasks(rows) < cores:
        # A top-k arrives in one partition and a small table in few; score on all cores.
        scored = rows.repartition(max(1, min(cores, n_rows // ROWS_PER_TASK)))
    # Bounded: TREES trees of at most 2 x (about SUBSET rows) nodes.
    feature, cut, children, path, roots, levels = _flat(grow_trees(rows, n_rows, n_features, subset=subset, seed=seed).toPandas())
    scale = float(_average_path(subset)) * len(roots)

    def score(batches):
        import numpy as np

        for batch in batches:
            data = batch[[f"x{i}" for i in range(n_features)]].to_numpy(dtype=float)
            out = np.empty(len(data))
            # A block of rows goes through all trees at once.
            for a in range(0, len(data), BLOCK):
                part = data[a : a + BLOCK]
                flat, row = part.ravel(), np.arange(len(part))[:, None] * n_features
                at = np.broadcast_to(roots, (len(part), len(roots)))
                for _ in range(levels):
                    goes_low = flat.take(row + feature.take(at)) <= cut.take(at)
                    # The two children of a node stand in one row.
                    at = children.take(2 * at + goes_low)
                out[a : a + BLOCK] = path.take(at).sum(axis=1)
            batch["score"] = 2.0 ** (-out / scale)
            yield batch[["key", "score"]]

    return scored.mapInPandas(score, f"key {dict(rows.dtypes)['key']}, score double")


def isolation_summary(
    df: DataFrame,
    names: Iterable[str],
    key: str,
    table: str,
    contamination: float = CONTAMINATION,
    sample: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """One row: rows scored, anomalies above the score cut, their percentage, status.

    With fewer than two columns or fewer than 100 complete rows the status is
    SKIPPED and only the rows are counted.
    """
    found = present(df, names)
    rows = _complete_rows(df, found, key).count() if found else 0
    if len(found) < 2 or rows < FEWEST_ROWS:
        return df.sparkSession.createDataFrame(
            [(table, ", ".join(found), rows, None, None, "SKIPPED")],
            "`table` string, features string, sample_size long, n_anomalies long, anomaly_pct double, status string",
        )
    scores = settle(isolation_scores(df, found, key, sample, seed, rows))
    cut = scores.agg(F.percentile_approx("score", 1.0 - contamination, 100_000)).scalar()
    above = scores.withColumn("cut", cut)
    return above.agg(F.count("*").alias("sample_size"), F.count_if(F.col("score") > F.col("cut")).alias("n_anomalies")).select(
        F.lit(table).alias("table"),
        F.lit(", ".join(found)).alias("features"),
        "sample_size",
        "n_anomalies",
        F.round(F.col("n_anomalies") / F.col("sample_size") * 100, 2).alias("anomaly_pct"),
        F.lit("DONE").alias("status"),
    )
