"""Toxicity by weak supervision: many voters, a label model, a linear classifier.

1. Voters are lexicons, patterns and lists of words and word beginnings that a bounded sample of
   labelled rows shows to be telling. Each fires or abstains.
2. The label model is generative: a hidden class and, for each voter, a chance to fire given the
   class and the voter it depends on most (a tree over the voters). Expectation maximisation over
   the counts of all firing patterns of all documents estimates accuracies and correlations;
   labelled rows of the sample keep their class. Twelve voters make at most 4,096 patterns.
3. A logistic regression over the voters' counts and rates is trained on the sample, each target
   half posterior and half true label, and scores every whole text.

Defined cases: null and empty texts fire no voter and get the lowest evidence; a label row without
a class or document teaches nothing, repeated label rows count as toxic if one is; without labels
of both classes the fixed voters and priors decide alone.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.scale import settle

# Common insults by kind, lower case.
LEXICONS = {
    "mind": "idiot idiots idiotic moron moronic stupid dumb imbecile fool fools foolish clown clowns dumbass halfwit dimwit brainless",
    "worth": "worthless pathetic loser losers trash garbage scum useless failure vermin parasite lowlife",
    "disgust": "disgusting disgusted vile filthy filth gross nasty revolting repulsive sickening",
    "hate": "hate hated hateful despise kill die murder destroy hurt beat",
    "abuse": "bitch bastard asshole jerk creep freak pig shit crap damn bullshit fuck fucking fucker whore slut",
    "other": "dummkopf arschloch scheisse scheiße blöd trottel connard salaud merde imbécile crétin imbécil estúpido estúpida mierda cabrón",
}
PATTERNS = {
    "you": r"(?i)\byou(?:'re| are)?\s+(?:an? |such an? |all |so )?(?:idiots?|morons?|stupid|dumb|fools?|clowns?|losers?|trash|scum|pathetic|worthless|disgusting)\b",
    "shout": r"[A-Z]{3,}[!?]{2,}",
    "masked": r"(?i)\b[a-z]{1,3}[*@#$]{1,5}[a-z]{1,4}\b",
}
HINTS = {"you": ("you",), "shout": ("!!", "??", "!?", "?!"), "masked": ("*", "@", "#", "$")}
LEARNED = ("words", "starts")
VOTERS = (*LEXICONS, *PATTERNS, *LEARNED, "many")
WORD = re.compile(r"[^\W\d_]+")
STARTS = range(4, 8)
SAMPLE_ROWS = 20_000
FEWEST_ROWS = 5
PRECISION = 0.6
_LEXICON_OF = {w: k for k, ws in LEXICONS.items() for w in ws.split()}
_PATTERNS = {k: re.compile(p) for k, p in PATTERNS.items()}


def _features(text: str | None) -> set[str]:
    """Distinct words, and beginnings of longer words marked by a star."""
    out = set(WORD.findall((text or "").lower()))
    for w in list(out):
        out.update(w[:k] + "*" for k in STARTS if len(w) > k)
    return out


def counts(text: str | None, learned: dict) -> list[float]:
    """Hits of each voter and the number of words; ``many`` is the weight of distinct hits."""
    text = text or ""
    low = text.lower()
    words = Counter(WORD.findall(low))
    hits = dict.fromkeys(VOTERS, 0.0)
    table, starts, heads = learned["words"], learned["starts"], learned["heads"]
    for w, n in words.items():
        if (kind := _LEXICON_OF.get(w)) is not None:
            hits[kind] += n
        if w in table:
            hits["words"] += n
            hits["many"] += table[w]
        elif w[: STARTS[0]] in heads:
            best = max((starts[s] for k in STARTS if len(w) > k and (s := w[:k]) in starts), default=0.0)
            if best:
                hits["starts"] += n
                hits["many"] += best
    for k, p in _PATTERNS.items():
        # A pattern needs its hint somewhere in the text.
        if any(h in low for h in HINTS[k]):
            hits[k] = float(len(p.findall(text)))
    return [*hits.values(), float(sum(words.values()))]


def _pattern(hits: np.ndarray) -> np.ndarray:
    """Which voters fire, as bits. ``many`` fires on evidence of more than one usual hit."""
    fires = hits[:, : len(VOTERS)] > 0
    fires[:, VOTERS.index("many")] = hits[:, VOTERS.index("many")] > 6.0
    return fires @ (1 << np.arange(len(VOTERS)))


@dataclass
class LabelModel:
    """Class share and chances to fire given class and parent (class, voter, parent's state)."""

    share: float
    parent: list[int]
    fire: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        on = (patterns[:, None] >> np.arange(len(self.parent))) & 1
        log = np.tile(np.log([1 - self.share, self.share]), (len(patterns), 1))
        for j, up in enumerate(self.parent):
            state = on[:, up] if up >= 0 else np.zeros(len(patterns), int)
            for y in (0, 1):
                p = self.fire[y, j, state]
                log[:, y] += np.log(np.where(on[:, j] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))


def fit_label_model(patterns: np.ndarray, n: np.ndarray, known: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation maximisation over pattern counts; ``known`` is 0, 1 or -1 (no label)."""
    voters = len(VOTERS)
    on = ((patterns[:, None] >> np.arange(voters)) & 1).astype(float)
    # Start: a voter that fires is right more often than not.
    model = LabelModel(0.1, [-1] * voters, np.stack([np.full((voters, 2), 0.02), np.full((voters, 2), 0.4)]))
    for k in range(rounds):
        q = model.posterior(patterns)
        q = np.where(known >= 0, known, q)
        parent = _tree(on, n, q) if k >= rounds // 3 else [-1] * voters
        fire = np.empty((2, voters, 2))
        for y, w in ((0, n * (1 - q)), (1, n * q)):
            for j, up in enumerate(parent):
                for state in (0, 1):
                    at = w * (on[:, up] == state) if up >= 0 else w
                    # Pulled towards the voter's own rate, so that rare states don't decide.
                    own = ((w * on[:, j]).sum() + 0.5) / (w.sum() + 1)
                    fire[y, j, state] = ((at * on[:, j]).sum() + 5 * own) / (at.sum() + 5)
        share = ((n * q).sum() + 1) / (n.sum() + 2)
        model = LabelModel(float(share), parent, np.clip(fire, 1e-4, 1 - 1e-4))
    return model


def _tree(on: np.ndarray, n: np.ndarray, q: np.ndarray) -> list[int]:
    """For each voter the one it depends on most given the class: a maximum spanning tree."""
    voters = on.shape[1]
    info = np.zeros((voters, voters))
    total = n.sum()
    for w in (n * (1 - q), n * q):
        if w.sum() <= 0:
            continue
        both = (on * w[:, None]).T @ on / w.sum()
        one = (on * w[:, None]).sum(axis=0) / w.sum()
        for a in (0, 1):
            for b in (0, 1):
                pa_, pb = (one if a else 1 - one)[:, None], (one if b else 1 - one)[None, :]
                joint = both if a and b else one[:, None] - both if a else one[None, :] - both if b else 1 - one[:, None] - one[None, :] + both
                joint = np.maximum(joint, 1e-12)
                info += w.sum() / total * joint * np.log(joint / np.maximum(pa_ * pb, 1e-12))
    parent, inside = [-1] * voters, {0}
    while len(inside) < voters:
        _, a, b = max((info[a, b], a, b) for a in inside for b in range(voters) if b not in inside)
        parent[b] = a
        inside.add(b)
    return parent


def _design(hits: np.ndarray) -> np.ndarray:
    """Inputs of the classifier: fires, logarithmic counts and rates."""
    words = np.maximum(hits[:, -1:], 1)
    own = hits[:, :-1]
    return np.hstack([np.ones((len(hits), 1)), own > 0, np.log1p(own), np.log1p(100 * own / words), np.log1p(words) / 10])


def fit_linear(hits: np.ndarray, soft: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    x = _design(hits)
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge, x.T @ (p - soft) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    learned: dict
    labels: LabelModel
    weights: np.ndarray


def _tally(column: str):
    """(feature, n): in how many rows of a batch each feature occurs, within a list if given."""

    def run(batches, wanted=None):
        for batch in batches:
            seen: Counter[str] = Counter()
            for text in batch.column(column).to_pylist():
                found = _features(text)
                seen.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["feature", "n"])

    return run


def _learn(sample: DataFrame) -> dict:
    """Telling words and word beginnings of the labelled sample with their evidence.

    ``heads`` are the shortest beginnings of those beginnings, asked first.
    """
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {"words": {}, "starts": {}, "heads": frozenset()}
    tally = _tally("text")
    often = sample.filter("y = 1").mapInArrow(tally, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST_ROWS)
    # Bounded by the sample: features of FEWEST_ROWS or more of its toxic rows.
    bad = {r["feature"]: r["n"] for r in often.collect()}
    wanted = frozenset(bad)
    others = sample.filter("y = 0").mapInArrow(lambda it: tally(it, wanted), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    good = {r["feature"]: r["n"] for r in others.collect()}
    scored = []
    for f, n in bad.items():
        rate, base = n / toxic, (good.get(f, 0) + 0.5) / (clean + 1)
        if n >= PRECISION * (n + good.get(f, 0)):
            scored.append((f, float(np.log(rate / base))))
    best = dict(sorted(scored))
    starts = {f[:-1]: e for f, e in best.items() if f.endswith("*")}
    words = {f: e for f, e in best.items() if not f.endswith("*")}
    return {"words": words, "starts": starts, "heads": frozenset(f[: STARTS[0]] for f in starts)}


def _hits(learned):
    def run(batches):
        for batch in batches:
            rows = np.array([counts(t, learned) for t in batch.column("text").to_pylist()]).reshape(-1, len(VOTERS) + 1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(VOTERS) + 1).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("y"), lists], names=["y", "hits"])

    return run


def _patterns(learned):
    """(pattern, n) of a batch."""

    def run(batches):
        for batch in batches:
            rows = np.array([counts(t, learned) for t in batch.column("text").to_pylist()]).reshape(-1, len(VOTERS) + 1)
            seen, n = np.unique(_pattern(rows), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(n.astype(np.int64))], names=["pattern", "n"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``labels`` (doc_id, toxic) of at most about ``sample_rows`` rows, by hash."""
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    n = marked.count()
    share = min(1.0, sample_rows / max(n, 1))
    picked = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_003)) < share * 1_000_003)
    texts = docs.select("doc_id", "text")
    # The sample is bounded by ``sample_rows``, so it can be sent to the documents.
    sample = settle(texts.join(F.broadcast(picked), "doc_id").select("text", "y"))
    learned = _learn(sample)
    rows = sample.mapInArrow(_hits(learned), "y int, hits array<double>").collect()
    hits = np.array([r["hits"] for r in rows]).reshape(-1, len(VOTERS) + 1)
    known = np.array([r["y"] for r in rows], dtype=int)
    every = texts.mapInArrow(_patterns(learned), "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    patterns = np.array([r["pattern"] for r in every], dtype=np.int64)
    n_all = np.array([float(r["n"]) for r in every])
    own = _pattern(hits) if len(hits) else np.zeros(0, np.int64)
    model = fit_label_model(
        np.concatenate([patterns, own]), np.concatenate([n_all, np.ones(len(own))]), np.concatenate([np.full(len(patterns), -1), known])
    )
    if not len(hits):
        return Model(learned, model, np.array([-2.0, *np.ones(len(VOTERS)), *np.zeros(2 * len(VOTERS) + 1)]))
    soft = model.posterior(own)
    # A labelled row keeps part of its label: the model cannot tell rows of one pattern apart.
    soft = 0.5 * soft + 0.5 * known
    return Model(learned, model, fit_linear(hits, soft))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            hits = np.array([counts(t, m.learned) for t in batch.column("text").to_pylist()]).reshape(-1, len(VOTERS) + 1)
            p = 1 / (1 + np.exp(-np.clip(_design(hits) @ m.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
