"""Personal data: wide span generators, boosted trees over format and context, set thresholds.

``base_spans`` are the fixed patterns and always stay. ``candidates`` proposes overlapping spans
that the fixed patterns may miss. ``fit`` trains boosted trees on the candidates of all documents:
those that equal a base span are positive, all others negative, and the features leave out
the check digit, so that a span is judged by its format and context. The threshold is the lowest
score at which held-out precision reaches ``precision``, where every candidate is scored by trees
that have not seen its text. ``spans`` joins base spans and the
accepted candidates that overlap none of them. Only DataFrame functions and Spark ML are used.

Candidates, unlike base spans, are bounded: parts of addresses end at 64 characters and 8 labels,
numbers at 19 digits.

Defined cases: null or empty text has no spans; rows are judged alone, so repeats and ties are
judged alike, and copies of a text count once in the fit; without enough candidates of either
class nothing is added to the base spans.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from kerbline.scale import settle

KINDS = ("email", "ip", "card", "phone")
# The patterns never step back into what they have read. A run that failed once is not tried
# again from its middle, unless the previous match ended there (\G).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -]{10}", "phone": r"\+[0-9]"}
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]{1,64}+\s?(?:@|\(at\)|\[at\])\s?[A-Za-z0-9-]{1,64}+(?:\s?(?:\.|\(dot\)|\[dot\])[A-Za-z0-9-]{1,64}+){1,8}+",
    "number": r"[+(]?[0-9](?:[ ().\-]{0,3}+[0-9]){6,18}+",
}
WIDE_HINTS = {"email": r"@|\(at\)|\[at\]", "number": r"[0-9][0-9 ().\-]{6}"}
CONTEXT = 32
# Words that often stand before such data.
CUES = {
    "cue_phone": r"(?i)\b(?:tel|phone|call|mobile|fax|cell)",
    "cue_card": r"(?i)\b(?:card|visa|credit|payment)",
    "cue_ip": r"(?i)\b(?:ip|host|server|address)",
    "cue_other": r"(?i)\b(?:order|invoice|isbn|date|version|token|no)\b",
}
FEATURES = (
    "size", "digits", "groups", "longest", "dots", "dashes", "blanks", "plus", "paren", "at", "spelled",
    "zero", "glued_before", "glued_after", *CUES,
)
FEWEST = 30
FOLDS = 3
# Spark reads the cuts of a feature off at most about this number squared of training rows.
LEAST_BINS, MOST_BINS = 32, 46_000


def found(text: Column, pattern: str, hint: str) -> Column:
    """Matches of a pattern as array of (start, stop, s); places are code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    kind = "array<struct<start:int,stop:int,s:string>>"
    placed = F.aggregate(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g")),
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["g"]) + F.length(x["m"])).alias("at"),
            F.array_append(
                acc["out"],
                F.struct((acc["at"] + F.length(x["g"])).alias("start"), (acc["at"] + F.length(x["g"]) + F.length(x["m"])).alias("stop"), x["m"].alias("s")),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(hint), placed).otherwise(F.array().cast(kind))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+", "")
        return F.forall(F.split(s, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.coalesce(F.substring(part(x), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(s)).between(12, 19) & F.call_function("luhn_check", _digits(s))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda x: _valid(kind, x["s"])


def _ranked(rank: int):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["stop"].alias("stop"))


def base_spans(text: Column) -> dict[str, Column]:
    """Valid spans of each kind."""
    t = F.coalesce(text, F.lit(""))
    out = {}
    for kind in KINDS:
        all_spans = found(t, PATTERNS[kind], HINTS[kind])
        out[kind] = all_spans if kind == "email" else F.filter(all_spans, _check(kind))
    return out


def with_base(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__base``: all base spans as (start, rank, stop), by start, then kind as listed."""
    df = df.withColumns({f"__{k}": c for k, c in base_spans(F.col(text)).items()})
    ranked = [F.transform(f"__{k}", _ranked(i)) for i, k in enumerate(KINDS)]
    df = df.withColumns({"__base": F.sort_array(F.concat(*ranked)), **{f"n_{k}": F.size(f"__{k}").cast("long") for k in KINDS}})
    return df.drop(*[f"__{k}" for k in KINDS])


def _features(x: Column, text: Column) -> list[Column]:
    s = x["s"]
    count = lambda chars: (F.length(s) - F.length(F.regexp_replace(s, chars, ""))).cast("double")
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    runs = F.array_remove(F.split(s, "[^0-9]+"), "")
    # Places count from 1 in substring().
    low = F.greatest(x["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, low + 1, x["start"] - low)
    after = F.substring(text, x["stop"] + 1, F.lit(1))
    return [
        F.length(s).cast("double"),
        count("[0-9]"),
        F.size(runs).cast("double"),
        F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)).cast("double"),
        count(r"\."),
        count("-"),
        count(" "),
        yes(s.startswith("+")),
        yes(s.contains("(")),
        yes(s.contains("@")),
        yes(s.rlike(r"\(at\)|\[at\]")),
        yes(s.rlike("^[+(]?0")),
        yes(before.rlike(r"[\p{L}\p{N}]$")),
        yes(after.rlike(r"^[\p{L}\p{N}]")),
        *[yes(before.rlike(cue)) for cue in CUES.values()],
    ]


def with_candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__cand``: proposed spans with features; needs ``__base``.

    Each is (start, stop, rank, label, features): the kind follows the shape, the label says
    whether the fixed patterns found the same span.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("__wide", F.concat(*[found(t, WIDE[k], WIDE_HINTS[k]) for k in WIDE]))

    def describe(x: Column) -> Column:
        s = x["s"]
        rank = F.when(s.rlike(r"@|\(at\)|\[at\]"), 0).when(s.rlike(r"^[0-9]+(\.[0-9]+){3}$"), 1).when(s.rlike(r"^[+(]"), 3).when(F.length(_digits(s)) >= 12, 2).otherwise(3)
        same = F.exists("__base", lambda b: (b["start"] == x["start"]) & (b["stop"] == x["stop"]))
        near = F.exists("__base", lambda b: (b["start"] < x["stop"]) & (b["stop"] > x["start"]))
        return F.struct(
            x["start"].alias("start"), x["stop"].alias("stop"), rank.alias("rank"), same.alias("label"), near.alias("near"), F.array(*_features(x, t)).alias("f")
        )

    return df.withColumn("__cand", F.transform("__wide", describe)).drop("__wide")


@dataclass
class Model:
    """Trees as (weight, nested rules) and the threshold; ``None`` trees accept nothing."""

    trees: list | None
    threshold: float

    def score(self, f: Column) -> Column:
        def walk(node):
            if isinstance(node, float):
                return F.lit(node)
            at, cut, low, high = node
            return F.when(F.get(f, F.lit(at)) <= cut, walk(low)).otherwise(walk(high))

        raw = sum((F.lit(w) * walk(t) for w, t in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * raw))


def parse_trees(text: str, weights: list[float]) -> list:
    """The rules of Spark's printed trees as nested tuples (feature, cut, low, high)."""
    trees, lines = [], [x.strip() for x in text.splitlines()]
    starts = [i for i, x in enumerate(lines) if x.startswith("Tree ")]
    for k, at in enumerate(starts):
        rows = iter(lines[at + 1 : starts[k + 1] if k + 1 < len(starts) else None])

        def node(rows=rows):
            line = next(rows)
            if m := re.fullmatch(r"Predict: (\S+)", line):
                return float(m[1])
            m = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
            low = node()
            next(rows)  # Else
            return int(m[1]), float(m[2]), low, node()

        trees.append((float(weights[k]), node()))
    return trees


def marked(df: DataFrame, text: str = "text") -> DataFrame:
    """Base spans, candidates and ``__copy``, a digest that copies of a text share."""
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    return with_candidates(with_base(df, text), text).withColumn("__copy", digest)


def training_rows(rows: DataFrame) -> DataFrame:
    """(label, fold, features, weight): the candidates of all different texts in ``marked`` rows.

    Candidates that look the same in a fold are one row, weighted by their number.
    """
    c = rows.select("__copy", F.explode("__cand").alias("c"))
    flat = [F.get("c.f", F.lit(i)).alias(x) for i, x in enumerate(FEATURES)]
    # Both steps are partial before the shuffle, so many copies of one text are few rows.
    c = c.select("__copy", "c.start", "c.stop", F.col("c.label").cast("double").alias("label"), *flat).distinct()
    fold = F.pmod(F.xxhash64("__copy"), F.lit(FOLDS)).alias("fold")
    return c.groupBy("label", fold, *FEATURES).agg(F.count("*").cast("double").alias("weight"))


def _boosted(rows: DataFrame, bins: int, rounds: int, depth: int):
    return GBTClassifier(maxIter=rounds, maxDepth=depth, maxBins=bins, stepSize=0.3, seed=7, weightCol="weight").fit(rows)


def learn(rows: DataFrame, precision: float = 0.98, rounds: int = 10, depth: int = 3) -> Model:
    """Trees and threshold from all candidates of ``marked`` rows, which should be stored.

    The threshold counts every candidate: each fold is scored by trees fitted on the others. The
    trees returned are fitted on all folds.
    """
    # Stored: every tree reads them again.
    rows = settle(training_rows(rows))
    # Bounded: two labels a fold.
    sizes = {(r["label"], r["fold"]): (r["weight"], r["n"]) for r in rows.groupBy("label", "fold").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).collect()}
    outside = [sum(w for (y, f), (w, _) in sizes.items() if y == label and f != fold) for label in (0.0, 1.0) for fold in range(FOLDS)]
    if min(outside) < FEWEST:
        return Model(None, 1.0)
    # Enough bins for Spark to take the cuts from all rows.
    bins = min(MOST_BINS, max(LEAST_BINS, math.isqrt(sum(n for _, n in sizes.values())) + 1))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("label", "fold", "features", "weight")
    step = F.floor(F.get(vector_to_array("probability"), F.lit(1)) * 100).alias("step")
    good, n = F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")
    table: dict[int, list[float]] = {}
    for fold in range(FOLDS):
        held = _boosted(rows.filter(F.col("fold") != fold), bins, rounds, depth).transform(rows.filter(F.col("fold") == fold))
        # Bounded: 101 steps.
        for r in held.groupBy(step).agg(good, n).collect():
            at = table.setdefault(r["step"], [0.0, 0.0])
            at[0], at[1] = at[0] + r["good"], at[1] + r["n"]
    kept = total = 0.0
    threshold = 1.01
    for k in range(100, 49, -1):
        kept, total = kept + table.get(k, (0, 0))[0], total + table.get(k, (0, 0))[1]
        if total and kept >= precision * total:
            threshold = k / 100
    model = _boosted(rows, bins, rounds, depth)
    return Model(parse_trees(model.toDebugString, model.treeWeights), threshold)


def fit(df: DataFrame, text: str = "text", precision: float = 0.98, rounds: int = 10, depth: int = 3) -> Model:
    """Trees and threshold from the candidates of all rows; only spans, not texts, are stored."""
    found = marked(df.select(F.col(text).alias("text"))).select("__copy", "__cand")
    return learn(settle(found), precision, rounds, depth)


def accepted(df: DataFrame, model: Model) -> DataFrame:
    """Add ``__spans`` (base and accepted) to rows that have ``__base`` and ``__cand``."""
    if model.trees is None:
        return df.withColumn("__spans", F.col("__base")).drop("__cand")
    added = F.transform(
        F.filter("__cand", lambda c: ~c["near"] & (model.score(c["f"]) >= model.threshold)),
        lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["stop"].alias("stop")),
    )
    return df.withColumn("__spans", F.sort_array(F.array_union("__base", added))).drop("__cand")


def spans(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add n_email .. n_phone (base), ``__base`` and ``__spans`` (base and accepted)."""
    df = with_base(df, text)
    if model.trees is not None:
        df = with_candidates(df, text)
    return accepted(df, model)


def listed(column: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["stop"])), ",")


def redacted(text: Column, column: str = "__spans") -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # Places count from 1 in substring().
    out = F.aggregate(
        column,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["stop"]).alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.get(names, x["rank"]))))
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )
    rest = lambda o: F.concat(F.array_join(o["out"], ""), F.substring(text, o["at"] + 1, F.length(text)))
    return F.when(F.size(column) == 0, text).otherwise(F.get(F.transform(F.array(out), rest), F.lit(0)))
