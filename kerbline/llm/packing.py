"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Texts become pieces of at most ``CAPACITY`` tokens. Full pieces are sequences of their own; the
rest is dealt at random to blocks of about ``BLOCK`` pieces, and each block evolves on ``ISLANDS``
islands. A chromosome is a grouping of pieces into bins. Crossover takes whole well-filled bins
of one parent, drops the other's bins that hold the same pieces, and puts the displaced pieces
back by best fit. Between epochs an island receives the elites of its neighbour. The emptiest
eighth of a block's bins goes, with those of other blocks, into new blocks, until one block is
left; so the waste is a few bins in all, not in each block. A block at its lower bound stops early.

Defined cases: null and empty texts are one piece of one token; repeated rows are packed as often
as they occur (a piece is a row, not an id); an empty table gives no rows.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm.tokens import VOCABULARY, load
from kerbline.scale import settle

CAPACITY = 1024
END = 2
BLOCK = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 6
POPULATION = 4
FULL_ENOUGH = 0.98
LOOSE_SHARE = 8
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first one takes the remainder."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    out = [(0, head)] if head else []
    return out + [(at, capacity) for at in range(head, n, capacity)]


def _pieces(path: str, capacity: int):
    def run(batches):
        codec = load(path)
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id").to_pylist()
            rows = []
            for i, doc in enumerate(ids):
                tokens = np.array([*codec.encode(texts[i].as_py() or ""), END], dtype="<u4")
                rows += [(doc, k, at, size, zlib.crc32(tokens[at : at + size].tobytes())) for k, (at, size) in enumerate(cut(len(tokens), capacity))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return run


class Packer:
    """Groupings of pieces into bins of one capacity."""

    def __init__(self, sizes: list[int], capacity: int, seed: int):
        self.sizes, self.capacity, self.rng = sizes, capacity, random.Random(seed)
        self.bound = -(-sum(sizes) // capacity)

    def fit(self, order: list[int], bins: list[list[int]] | None = None) -> list[list[int]]:
        """Put pieces, in this order, into the fullest bin that takes them."""
        bins = [list(b) for b in bins or []]
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for k, b in enumerate(bins):
            room = self.capacity - sum(self.sizes[i] for i in b)
            if room:
                by_room[room].append(k)
                mask |= 1 << room
        for i in order:
            size = self.sizes[i]
            above = mask >> size
            if above:
                room = size + (above & -above).bit_length() - 1
                k = by_room[room].pop()
                if not by_room[room]:
                    mask ^= 1 << room
                bins[k].append(i)
            else:
                room, k = self.capacity, len(bins)
                bins.append([i])
            if left := room - size:
                by_room[left].append(k)
                mask |= 1 << left
        return bins

    def fill(self, b: list[int]) -> int:
        return sum(self.sizes[i] for i in b)

    def worth(self, bins: list[list[int]]) -> tuple[int, int]:
        """Fewer bins first; then the sum of squared fills, which favours full bins."""
        return -len(bins), sum(self.fill(b) ** 2 for b in bins)

    def start(self, noise: float) -> list[list[int]]:
        scale = lambda i: self.sizes[i] * (1 + noise * (self.rng.random() - 0.5))
        return self.fit(sorted(range(len(self.sizes)), key=scale, reverse=True))

    def crossover(self, own: list[list[int]], other: list[list[int]]) -> list[list[int]]:
        fills = [(self.fill(b), self.rng.random(), k) for k, b in enumerate(other)]
        best = sorted(fills, reverse=True)[: max(1, len(fills) // 2)]
        chosen = [other[k] for _, r, k in best if r < 0.6] or [other[best[0][2]]]
        taken = {i for b in chosen for i in b}
        kept, displaced = [], []
        for b in own:
            if taken.isdisjoint(b):
                kept.append(b)
            else:
                displaced += [i for i in b if i not in taken]
        return self._refit(chosen + kept, displaced)

    def mutate(self, bins: list[list[int]]) -> list[list[int]]:
        """Empty the worst bins and some others."""
        ranked = sorted(bins, key=lambda b: self.fill(b) * (1 - 0.05 * self.rng.random()))
        n = max(2, len(ranked) // 20)
        return self._refit(ranked[n:], [i for b in ranked[:n] for i in b])

    def _refit(self, bins: list[list[int]], displaced: list[int]) -> list[list[int]]:
        displaced.sort(key=lambda i: self.sizes[i], reverse=True)
        return self.fit(displaced, bins)

    def evolve(self, guests: list[list[list[int]]], generations: int, population: int) -> list[list[list[int]]]:
        """The population after some generations, best first."""
        people = [*guests, *[self.start(0.02 * k) for k in range(max(1, population - len(guests)))]]
        people = sorted(people, key=self.worth, reverse=True)[:population]
        for _ in range(generations):
            if len(people[0]) <= self.bound:
                break
            a, b = (min(self.rng.sample(range(len(people)), 2)) if len(people) > 1 else 0 for _ in range(2))
            children = [self.crossover(people[a], people[b]), self.mutate(people[a])]
            people = sorted(people + children, key=self.worth, reverse=True)[:population]
        return people


def _labels(bins: list[list[int]], n: int) -> bytes:
    out = np.zeros(n, dtype="<i4")
    for k, b in enumerate(bins):
        out[b] = k
    return out.tobytes()


def _bins(blob: bytes) -> list[list[int]]:
    labels = np.frombuffer(blob, "<i4")
    out: list[list[int]] = [[] for _ in range(int(labels.max(initial=-1)) + 1)]
    for i, k in enumerate(labels.tolist()):
        out[k].append(i)
    return out


def _island(capacity: int, generations: int, population: int):
    """Evolve (block, island, sizes, guests); emits the two best chromosomes."""

    def run(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                sizes = batch.column("sizes")[i].as_py()
                guests = [_bins(g) for g in batch.column("guests")[i].as_py() or []]
                block, island = batch.column("block")[i].as_py(), batch.column("island")[i].as_py()
                packer = Packer(sizes, capacity, block * 1_000_003 + island)
                best = packer.evolve(guests, generations, population)[:2]
                rows += [(block, island, -packer.worth(b)[0], packer.worth(b)[1], _labels(b, len(sizes))) for b in best]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["block", "island", "bins", "squares", "labels"])

    return run


def _pack_blocks(rows: DataFrame, n_blocks: int, capacity: int, islands: int, epochs: int, generations: int, population: int) -> DataFrame:
    """Rows with ``block`` gain bin, offset and whether the bin is to be packed again, within their block."""
    # A block is little data but much work: tasks are counted by blocks, not by bytes.
    most = 4 * rows.sparkSession.sparkContext.defaultParallelism
    # A block holds about BLOCK pieces whatever the table holds.
    blocks = settle(rows.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(F.col("length").alias("length"), "salt", "doc_id", "piece", "start", "ids_crc32")), asc=False).alias("items")))
    sized = blocks.select("block", F.transform("items", lambda x: x["length"].cast("int")).alias("sizes"))
    homes = sized.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    elites = None
    schema = "block long, island int, bins long, squares long, labels binary"
    for _ in range(epochs):
        if elites is None:
            here = homes.withColumn("guests", F.lit(None).cast("array<binary>"))
        else:
            # Own elites stay, the neighbour's arrive.
            moved = elites.unionAll(elites.withColumn("island", ((F.col("island") + 1) % islands).cast("int")))
            guests = moved.groupBy("block", "island").agg(F.collect_list("labels").alias("guests"))
            here = homes.join(guests, ["block", "island"])
        here = here.select("block", "island", "sizes", "guests").repartition(min(n_blocks * islands, most))
        elites = settle(here.mapInArrow(_island(capacity, generations, population), schema))
    best = elites.groupBy("block").agg(F.min_by("labels", F.struct("bins", -F.col("squares"), "island")).alias("labels"))

    def place(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                items = batch.column("items")[i].values
                labels = np.frombuffer(batch.column("labels")[i].as_py(), "<i4")
                sizes = items.field("length").to_numpy()
                order = np.argsort(labels, kind="stable")
                run = np.cumsum(sizes[order]) - sizes[order]
                starts = np.flatnonzero(np.diff(labels[order], prepend=-1))
                offset = np.zeros(len(sizes), dtype=np.int64)
                offset[order] = run - np.repeat(run[starts], np.diff(np.append(starts, len(order))))
                fill = np.bincount(labels, weights=sizes)
                emptiest = np.argsort(fill, kind="stable")[: -(-len(fill) // LOOSE_SHARE)]
                loose = np.zeros(len(fill), dtype=bool)
                loose[emptiest] = fill[emptiest] < FULL_ENOUGH * capacity
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
                block = batch.column("block")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [*[items.field(c) for c in names], pa.array(np.full(len(sizes), block)), pa.array(labels.astype(np.int64)), pa.array(offset), pa.array(loose[labels])],
                    names=[*names, "block", "bin", "offset", "loose"],
                )

    solved = blocks.join(best, "block").select("block", "items", "labels").repartition(min(n_blocks, most))
    return solved.mapInArrow(place, f"{_PIECE}, salt long, block long, bin long, offset long, loose boolean")


def pack(
    docs: DataFrame, path: str = VOCABULARY, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS,
    generations: int = GENERATIONS, population: int = POPULATION,
) -> DataFrame:
    """Pieces of all documents with sequence_id and offset."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The salt is drawn once and stored: blocks are the same if a task runs again.
    pieces = settle(rows.mapInArrow(_pieces(path, capacity), _PIECE).withColumn("salt", F.floor(F.rand(11) * F.lit(float(1 << 52))).cast("long")))
    done = pieces.filter(F.col("length") >= capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    left = pieces.filter(F.col("length") < capacity)
    level, n = 0, left.count()
    while n:
        blocks = -(-n // block)
        packed = settle(_pack_blocks(left.withColumn("block", F.pmod(F.col("salt"), F.lit(blocks)).cast("long")), blocks, capacity, islands, epochs, generations, population))
        last = blocks == 1
        good = packed if last else packed.filter(~F.col("loose"))
        number = F.lit(level << 56) + F.col("block") * (1 << 20) + F.col("bin")
        done = done.unionAll(good.select("doc_id", "piece", "start", "length", "ids_crc32", number.cast("long").alias("sequence_id"), F.col("offset")))
        if last:
            break
        left = packed.filter("loose").select("doc_id", "piece", "start", "length", "ids_crc32", F.shiftright(F.xxhash64("salt", "doc_id"), 12).alias("salt"))
        n, level = left.count(), level + 1
    return done
