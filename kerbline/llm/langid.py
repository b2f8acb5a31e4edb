"""Language of whole texts by unigram pieces, summed over all segmentations.

The pieces are a fixed public vocabulary. A language is a probability for each piece; the
probability of a word is the sum over all ways to cut it into pieces, found by the forward
algorithm, and a text is the product over its words (pieces never cross white space). Piece
probabilities are learned by expectation maximisation: forward and backward sums give each piece's
expected count in each distinct word of a sample of at most ``SAMPLE_DOCS`` documents a language.

Words are scored in batches of equal length and kept in a bounded store, so a frequent word is
scored once a task.

Defined cases: null texts and texts without a letter are ``und`` with score 0; rows with a null
language teach nothing; characters outside the vocabulary share one unknown piece; words of any
length teach and are scored whole; without training rows every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm.wordhash import mix
from kerbline.scale import settle

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SAMPLE_DOCS = 3_000
ITERATIONS = 3
SMOOTH = 0.1
STORED_WORDS = 300_000
TAUGHT_CHARS = 200_000  # of one batch of equally long words
RESCALED = 4
START = "▁"
_G = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20


class Pieces:
    """A vocabulary that finds the piece of many substrings at once."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        words = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.words = sorted(w for w in words if w)
        self.longest = max(map(len, self.words))
        #: The last two ids: an unknown character, and no piece at all.
        self.unknown, self.absent = len(self.words), len(self.words) + 1
        self.size = len(self.words) + 1
        keys = np.array([self._key(w) for w in self.words], dtype=np.uint64)
        # Open addressing in one array; a probe for each step of the longest chain.
        self.table = np.full(1 << _TABLE_BITS, -1, dtype=np.int32)
        self.keys = np.append(keys, np.uint64(0))
        self.probes = 1
        for i, at in enumerate(self._slot(keys).tolist()):
            step = 1
            while self.table[at] >= 0:
                at, step = (at + 1) & ((1 << _TABLE_BITS) - 1), step + 1
            self.table[at] = i
            self.probes = max(self.probes, step)

    def _key(self, word: str) -> int:
        with np.errstate(over="ignore"):
            h = np.uint64(len(word))
            for c in word:
                h = h * _G + np.uint64(ord(c) + 1)
        return int(h)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, keys: np.ndarray, single: bool) -> np.ndarray:
        """Piece ids of substring keys."""
        at = self._slot(keys)
        out = np.full(keys.shape, self.unknown if single else self.absent, dtype=np.int32)
        for _ in range(self.probes):
            ids = self.table[at]
            hit = self.keys[ids] == keys
            hit &= ids >= 0
            out[hit] = ids[hit]
            at = (at + 1) & ((1 << _TABLE_BITS) - 1)
        return out

    def substrings(self, chars: np.ndarray) -> Iterator[np.ndarray]:
        """Piece ids of all substrings of length 1, 2, ..., for rows of equal length."""
        n, m = chars.shape
        with np.errstate(over="ignore"):
            codes = chars.astype(np.uint64) + np.uint64(1)
            rolled = np.zeros((n, m), dtype=np.uint64)
            for size in range(1, min(m, self.longest) + 1):
                # key(size) of a substring: size * G^size plus its characters' polynomial.
                rolled = codes if size == 1 else rolled[:, :-1] * _G + codes[:, size - 1 :]
                lead = np.uint64(size) * np.uint64(pow(int(_G), size, 1 << 64))
                yield self.find(rolled + lead, size == 1)

    def lattice(self, chars: np.ndarray) -> list[list[np.ndarray | None]]:
        """ids[l][i] of the substrings of length l + 1 from i; None where no row has a piece."""
        return [
            [ids[:, i] if size == 1 or (ids[:, i] != self.absent).any() else None for i in range(ids.shape[1])] for size, ids in enumerate(self.substrings(chars), 1)
        ]

    def dense(self, chars: np.ndarray, low: int, block: int, wide: int) -> np.ndarray:
        """ids[i - low, l] of the substrings of length l + 1 from i, for the places of a block."""
        n, m = chars.shape
        out = np.full((min(block, m - low), wide, n), self.absent, dtype=np.int32)
        for size, ids in enumerate(self.substrings(chars[:, low : low + block + self.longest - 1]), 1):
            k = min(len(out), ids.shape[1])
            out[:k, size - 1] = ids[:, :k].T
        return out


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def _rows(words: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Words with the start mark as code points, by length: (places, matrix)."""
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_size.setdefault(len(w) + 1, []).append(i)
    out = {}
    for size, at in by_size.items():
        raw = "".join(START + words[i] for i in at).encode("utf-32-le", "surrogatepass")
        out[size] = (np.array(at), np.frombuffer(raw, dtype="<u4").reshape(len(at), size))
    return out


def forward(pieces: Pieces, chars: np.ndarray, probs: np.ndarray, block: int = 256) -> np.ndarray:
    """log P of each row under each column of ``probs`` (pieces x languages)."""
    n, m = chars.shape
    alpha = {0: np.ones((n, probs.shape[1]))}
    scale = np.zeros((n, 1))
    for i in range(m):
        if i % block == 0:
            # A long word's lattice is held in parts.
            lattice = pieces.lattice(chars[:, i : i + block + pieces.longest - 1])
        here = alpha.pop(i)
        if i and i % 16 == 0:
            # Keep numbers in range: the same factor for all sums still in use.
            top = np.maximum(here.max(axis=1, keepdims=True), 1e-300)
            scale += np.log(top)
            here = here / top
            for j in alpha:
                alpha[j] /= top
        for size, starts in enumerate(lattice, 1):
            if i + size > m:
                break
            if (ids := starts[i % block]) is not None:
                step = here * probs[ids]
                alpha[i + size] = alpha[i + size] + step if i + size in alpha else step
    return np.log(np.maximum(alpha[m], 1e-300)) + scale


def expected(pieces: Pieces, chars: np.ndarray, weight: np.ndarray, probs: np.ndarray, block: int = 256) -> np.ndarray:
    """Expected counts of all pieces in words with weights, under one language.

    The forward sums of a place and those after it are divided by the place's own sum every
    ``RESCALED`` characters, and the backward sums by the same factors, so words of any length stay
    in range. The lattice of a long word is held in parts.
    """
    n, m = chars.shape
    wide = min(m, pieces.longest)
    alpha, beta = np.zeros((m + wide, n)), np.zeros((m + wide, n))
    factor: dict[int, np.ndarray] = {}
    alpha[0] = 1
    for low in range(0, m, block):
        ids = pieces.dense(chars, low, block, wide)
        step = probs[ids]
        for i in range(low, low + len(ids)):
            if i and i % RESCALED == 0:
                factor[i] = alpha[i].copy()
                alpha[i : i + wide] /= factor[i]
            alpha[i + 1 : i + 1 + wide] += alpha[i] * step[i - low]
    out = np.zeros(pieces.size + 1)
    # Sums to 1 over the pieces that cover any one character.
    beta[m] = 1 / alpha[m]
    for low in range((m - 1) // block * block, -1, -block):
        if m > block:
            ids = pieces.dense(chars, low, block, wide)
            step = probs[ids]
        for i in range(low + len(ids) - 1, low - 1, -1):
            if i + 1 in factor:
                beta[i + 1 : i + 1 + wide] /= factor[i + 1]
            mass = step[i - low]
            mass *= beta[i + 1 : i + 1 + wide]
            beta[i] = mass.sum(axis=0)
            mass *= alpha[i] * weight
        out += np.bincount(ids.ravel(), weights=step.ravel(), minlength=pieces.size + 1)
    return out[:-1]


class Model:
    """Languages and the piece probabilities (pieces and unknown and absent x languages)."""

    def __init__(self, languages: list[str], probs: np.ndarray, path: str):
        self.languages, self.probs, self.path = languages, probs, path


def _expectations(path: str, languages: list[str], probs: np.ndarray):
    def run(batches):
        pieces = vocabulary(path)
        total = np.zeros((len(languages), pieces.size))
        for batch in batches:
            lang = np.array([languages.index(x) for x in batch.column("lang").to_pylist()])
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(float)
            for k in np.unique(lang).tolist():
                mine = np.flatnonzero(lang == k)
                for at, chars in _rows([words[i] for i in mine]).values():
                    step = max(1, TAUGHT_CHARS // chars.shape[1])
                    for low in range(0, len(at), step):
                        part = slice(low, low + step)
                        total[k] += expected(pieces, chars[part], n[mine[at[part]]], probs[:, k])
        k, p = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(p.astype(np.int32)), pa.array(total[k, p])], names=["k", "p", "e"])

    return run


def fit(docs: DataFrame, path: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS, iterations: int = ITERATIONS) -> Model:
    """Learn from (text, lang) rows; at most about ``sample_docs`` of each language, by hash."""
    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    pieces = vocabulary(path)
    if not languages:
        return Model([], np.zeros((pieces.size + 1, 0)), path)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample_docs / counts[lang]))])
    picked = rows.filter(F.pmod(F.xxhash64("text", F.lit(9)), F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)
    # Bounded by the words of the sample.
    words = picked.select("lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).filter(F.length("word") > 0)
    words = settle(words.groupBy("lang", "word").agg(F.count("*").alias("n")))
    # Longer pieces start rarer, so that no cut is favoured only for having few pieces.
    start = np.array([0.02 ** len(w) for w in pieces.words] + [1e-6])
    probs = np.zeros((pieces.size + 1, len(languages)))
    probs[:-1] = (start / start.sum())[:, None]
    for _ in range(iterations):
        found = words.mapInArrow(_expectations(path, languages, probs), "k int, p int, e double").groupBy("k", "p").agg(F.sum("e").alias("e"))
        # Bounded by pieces x languages.
        counted = np.full((pieces.size, len(languages)), SMOOTH)
        table = found.toPandas()
        counted[table["p"], table["k"]] += table["e"]
        probs = np.zeros((pieces.size + 1, len(languages)))
        probs[:-1] = counted / counted.sum(axis=0)
    return Model(languages, probs, path)


class Scorer:
    """Scores texts; keeps the words it has seen up to a bound."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, vocabulary(model.path)
        self.place: dict[str, int] = {}
        self.logs = np.zeros((STORED_WORDS, len(model.languages)))

    def learn(self, words: list[str]) -> None:
        for at, chars in _rows(words).values():
            step = max(1, 2_000_000 // (chars.shape[1] * 16 * len(self.model.languages)))
            for low in range(0, len(at), step):
                part = at[low : low + step]
                logs = forward(self.pieces, chars[low : low + step], self.model.probs)
                first = len(self.place)
                self.logs[first : first + len(part)] = logs
                for j, i in enumerate(part.tolist()):
                    self.place[words[i]] = first + j

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.model.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        split = [(t or "").lower().split() for t in texts]
        labels, scores, low = [], [], 0
        while low < len(split):
            # As many texts as the store can hold words of.
            new: dict[str, None] = {}
            high = low
            while high < len(split) and (high == low or len(new) < STORED_WORDS // 4):
                new.update(dict.fromkeys(w for w in split[high] if w not in self.place))
                high += 1
            fresh = list(new)
            if len(self.place) + len(fresh) > STORED_WORDS:
                self.place.clear()
                fresh = list(dict.fromkeys(w for s in split[low:high] for w in s))
            sums = np.zeros((high - low, len(self.model.languages)))
            if len(fresh) <= STORED_WORDS:
                self.learn(fresh)
                for k in range(low, high):
                    if split[k]:
                        sums[k - low] = self.logs[[self.place[w] for w in split[k]]].sum(axis=0)
            else:
                for k in range(low, high):
                    for part in range(0, len(split[k]), STORED_WORDS // 2):
                        some = split[k][part : part + STORED_WORDS // 2]
                        self.place.clear()
                        self.learn(list(dict.fromkeys(some)))
                        sums[k - low] += self.logs[[self.place[w] for w in some]].sum(axis=0)
            for k in range(low, high):
                text = texts[k]
                if text is None or not any(map(str.isalpha, text)):
                    labels.append("und")
                    scores.append(0.0)
                    continue
                s = sums[k - low]
                p = np.exp(s - s.max())
                labels.append(self.model.languages[int(s.argmax())])
                scores.append(float(1 / p.sum()))
            low = high
        return labels, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                labels, scores = scorer.texts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
