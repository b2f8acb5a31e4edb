"""Near-duplicate groups by bottom-k sketches, exact Jaccard and connected components.

One hash function orders the shingles of a text; its ``k`` smallest values are the sketch.

1. Texts with one shingle set become one class.
2. Inverted lists of retained values show which values two classes or more hold. A class can only
   have a partner if enough of its sketch is shared; it is listed under its rarest shared values,
   of which any partner must hold one.
3. In each list the most central class (fewest values of its own) meets every other: the
   Jaccard of the full sets decides.
4. Classes that met the same centre and are still in different components can only be linked if
   they share enough shingles that the centre lacks. These are ordered from the rarest on and
   listed, and two classes meet where the places of a common shingle in both orders leave room for
   enough others, and where the parity bits of their sets (a shingle flips one of 512 bits) differ
   in no more places than the threshold lets the sets differ. So members of a large group are not
   paired, but for links and near misses.
5. For such pairs the sketch of the union estimates the Jaccard; pairs below the bound go, the full
   sets of the others decide.
6. Links are joined to components by alternating star contraction, stored each round.

A pair at the threshold shares ``k * threshold`` sketch values on average, and fewer than
``least_shared`` with a probability below ``MISSED``: 1.5e-9 at 0.85 and 4.4e-9 at 0.80 with
64 values. Only the two steps on sketches (2 and 5) can miss a link, each with that bound.

Defined cases: null or wordless texts have no set and stand alone; fewer words than a shingle
count as one shingle; rows repeated with one id and text are one document; rows without an id
belong to no group and are kept. A row is a document: where one id has several texts, each of its
rows is in the group of its own text, and only the rows that another document stands for go.
Other columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm.wordhash import mix, pieces, window_hash, words_of
from kerbline.scale import settle

K = 64
MISSED = 5e-9
BITS = 512
# Bits of the map that tells which rows a join may need (8 MB whatever the table holds), and of one
# of Spark's bitmaps, both as powers of two.
MAP_BITS, PART_BITS = 26, 15
_PARITY = [f"p{i}" for i in range(BITS // 64)]


def _fewest(num: int, den: int, k: int) -> int:
    """Of ``k`` values, how many a link at the threshold shares but for a probability below MISSED.

    Of the ``k`` smallest values of a union those held by both are in both sketches; their number
    has a lighter tail than the binomial one summed here.
    """
    tail, share = 0.0, num / den
    for need in range(k + 1):
        tail += comb(k, need) * share**need * (1 - share) ** (k - need)
        if tail > MISSED:
            return need
    return k


def least_shared(num: int, den: int, k: int) -> int:
    """The sketch values that a link at the threshold shares but for a probability below MISSED."""
    need = _fewest(num, den, k)
    if need == 0:
        raise ValueError(f"a sketch of {k} values is too short for a threshold of {num}/{den}")
    return need


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z folded)."""
    w = words_of(column, lower=True)
    for i in range(len(column)):
        h = w.row(i)
        if len(h) == 0:
            yield h
        elif len(h) < size:
            yield window_hash(h, len(h), seed=len(h) + 101)
        else:
            yield np.unique(window_hash(h, size))


def _signs(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell one shingle set from another."""
    return int(np.bitwise_xor.reduce(mix(s + np.uint64(77))).astype(np.int64)) if len(s) else 0, int(mix(s + np.uint64(5)).sum().astype(np.int64))


def _parity(s: np.ndarray) -> bytes:
    """64 bytes; every shingle flips one bit, so two sets differ in at least as many shingles as bits."""
    place, times = np.unique(mix(s + np.uint64(31)) >> np.uint64(64 - 9), return_counts=True)
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[place] = times % 2
    return np.packbits(bits).tobytes()


def _sketches(size: int, k: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                counts, signs, others, sketches, parity = [], [], [], [], []
                for s in shingle_sets(part.column("text"), size):
                    counts.append(len(s))
                    for held, sign in zip((signs, others), _signs(s), strict=True):
                        held.append(sign)
                    sketches.append(s[:k].astype(np.int64))
                    parity.append(_parity(s))
                bits = np.frombuffer(b"".join(parity), np.int64).reshape(len(parity), -1)
                flat = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sketches])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("mark"), pa.array(counts, pa.int64()), pa.array(signs, pa.int64()), pa.array(others, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), *[pa.array(c) for c in bits.T]],
                    names=["id", "mark", "n", "sign", "sign2", "sketch", *_PARITY],
                )

    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = list(shingle_sets(part.column("text"), size))
                signs = [_signs(s) for s in sets]
                columns = [pa.array([x for x, _ in signs], pa.int64()), pa.array([y for _, y in signs], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("rep"), *columns], names=["rep", "sign", "sign2", "set"])

    return run


def _arrays(batch, i):
    return (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("sx", "sy"))


def _verify(num: int, den: int):
    """Keep pairs whose sets reach the threshold."""

    def linked(a: np.ndarray, b: np.ndarray) -> bool:
        inner = len(np.intersect1d(a, b, assume_unique=True))
        return den * inner >= num * (len(a) + len(b) - inner)

    def run(batches):
        for batch in batches:
            keep = [linked(*_arrays(batch, i)) for i in range(batch.num_rows)]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _likely(num: int, den: int, k: int):
    """Keep pairs whose union's sketch does not rule the threshold out."""
    needed = [_fewest(num, den, j) for j in range(k + 1)]

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy().view(np.uint64) for c in ("sx", "sy"))
                union = np.union1d(a, b)[:k]
                both = np.intersect1d(a, b, assume_unique=True)
                keep.append(int(np.searchsorted(both, union[-1], side="right")) >= needed[len(union)])
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _overlap(batches):
    """Sizes, exact intersection and the shingles of ``x`` that ``y`` lacks, for each pair."""
    for batch in batches:
        only, sizes = [], []
        for i in range(batch.num_rows):
            a, b = _arrays(batch, i)
            only.append(np.setdiff1d(a, b, assume_unique=True).view(np.int64))
            sizes.append((len(a), len(b), len(a) - len(only[-1])))
        counts = np.array(sizes, np.int64).reshape(-1, 3)
        flat = np.concatenate(only) if only else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in only])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("x"), batch.column("y"), *[pa.array(c) for c in counts.T], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["x", "y", "nx", "ny", "inner", "only"],
        )


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over links (x, y).

    Each round links every neighbour above a node to the smallest known one, then the reverse;
    rounds needed grow with the logarithm of the longest path. Counts and minima are partial
    before the shuffle, so a hub costs no task more than its share.
    """
    edges = settle(links.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).filter("hi <> lo").distinct())
    while True:
        # Large star: neighbours above a node move to the smallest of its neighbourhood.
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(least, "u").filter("v > u and v > m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        large = settle(large)
        low = settle(large.groupBy("hi").agg(F.min("lo").alias("m")))
        moved = large.join(low, "hi")
        edges = settle(
            moved.select("hi", F.col("m").alias("lo")).unionAll(moved.filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct()
        )
        # Done once every node is either a smallest one or linked to a smallest one only.
        ends = edges.select(F.col("hi").alias("u"), F.lit(1).alias("up")).unionAll(edges.select(F.col("lo").alias("u"), F.lit(0).alias("up")))
        left = ends.groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("low")).filter("up > 1 or up > 0 and low = 0")
        if left.count() == 0:
            break
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))


def _among(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is in the one column of ``ids``, and few others, without a shuffle.

    A map of ``2 ** MAP_BITS`` bits is sent, so memory is bounded and no size of ``ids`` moves the
    wide rows; the exact join that has to follow moves only what is left.
    """

    def place(c: str):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << MAP_BITS))

    at = ids.select(place(ids.columns[0]).alias("__at"))
    bit = F.col("__at") % (1 << PART_BITS)
    maps = at.groupBy(F.shiftright("__at", PART_BITS).alias("__part")).agg(F.bitmap_construct_agg(bit).alias("__map"))
    df = df.withColumn("__at", place(column)).withColumn("__part", F.shiftright("__at", PART_BITS))
    # Bounded: 2,048 rows of 4 kB.
    df = df.join(F.broadcast(maps), "__part")
    byte = F.conv(F.hex(F.substring("__map", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return df.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).drop("__at", "__part", "__map")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Stored pairs with both sets. Only the sets asked for are moved, and those that stand second
    are stored, so that the join with a hot one is split."""
    asked = pairs.select(F.col("y").alias("id")).distinct()
    # No semi join: the optimizer would run it before the map.
    second = settle(_among(sets, "id", asked).join(asked, "id").select(F.col("id").alias("y"), F.col("set").alias("sy")))
    first = pairs.join(_among(sets, "id", pairs.select("x")).select(F.col("id").alias("x"), F.col("set").alias("sx")), "x")
    full = first.join(second, "y")
    return full.select("x", "y", "sx", "sy")


def _grouped(docs: DataFrame, id_col: str, text: str, size: int, num: int, den: int, k: int) -> DataFrame:
    """(id, mark of the text, n, component) of every row."""
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole.alias("text"), F.xxhash64(whole).alias("mark"))
    sketched = settle(rows.mapInArrow(_sketches(size, k), "id long, mark long, n long, sign long, sign2 long, sketch array<long>, " + ", ".join(f"{p} long" for p in _PARITY)))
    named = sketched.filter("id is not null and n > 0")
    first = named.groupBy("sign", "sign2", "n").agg(F.min_by(F.struct("id", "sketch", *_PARITY), "id").alias("r"))
    # A class is a text, so an id with several texts is in several; its number is stored with it.
    classes = settle(first.select("sign", "sign2", "n", F.col("r.id").alias("rep"), F.col("r.sketch").alias("sketch"), *[F.col(f"r.{p}").alias(p) for p in _PARITY], F.monotonically_increasing_id().alias("node")))
    links = _links(rows, classes, size, num, den, k)
    comp = settle(classes.select("node", "rep").join(components(links).withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = comp.groupBy("component").agg(F.min("rep").alias("least"))
    by_class = settle(classes.select("sign", "sign2", "n", "node").join(comp.join(least, "component").select("node", "least"), "node").drop("node"))
    # One class may hold a third of the rows: both sides are stored, so a skewed join is split.
    out = sketched.select("id", "mark", "n", "sign", "sign2").join(by_class, ["sign", "sign2", "n"], "left")
    alone = F.col("id").isNull() | (F.col("n") == 0)
    return out.select("id", "mark", "n", F.when(alone, F.col("id")).otherwise(F.col("least")).alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 3, num: int = 85, den: int = 100, k: int = K) -> DataFrame:
    """(id, n_shingles, component): groups of documents whose sets reach ``num``/``den``."""
    out = _grouped(docs, id_col, text, size, num, den, k)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component")


def _links(rows: DataFrame, classes: DataFrame, size: int, num: int, den: int, k: int) -> DataFrame:
    """Links (x, y) between classes that give the same components as all links."""
    held = classes.select("node", F.explode("sketch").alias("v"))
    often = settle(held.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1"))
    # Bounded by k values a class; as plain rows they move in fewer bytes than as parts of arrays.
    shared = held.join(often, "v").repartition("node").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    shared = shared.withColumn("s", F.size("vs")).join(classes.select("node", "n", F.size("sketch").alias("m")), "node")
    need = F.greatest(F.floor(F.col("m") * least_shared(num, den, k) / k), F.lit(1))
    # Any partner holds one of the rarest (shared - needed + 1).
    rarest = F.slice("vs", F.lit(1), (F.col("s") - need + 1).cast("int"))
    lists = settle(shared.filter(F.col("s") >= need).select("node", (F.col("m") - F.col("s")).alias("own"), F.explode(rarest).alias("e")).select("node", "own", F.col("e.v").alias("v")))
    # Round one: everyone meets the most central class of each list.
    centre = settle(lists.groupBy("v").agg(F.min(F.struct("own", "node")).alias("c"), F.count("*").alias("members")).filter("members > 1").select("v", F.col("c.node").alias("y")))
    stars = settle(lists.select("v", F.col("node").alias("x")).join(centre, "v").filter("x <> y").select("x", "y").distinct())
    # The centres a class meets, at most one a list, are stored with its set: it moves to them at once.
    ends = stars.select(F.col("x").alias("node"), "y").unionAll(stars.select(F.col("y").alias("node"), F.lit(None).cast("long").alias("y")))
    ends = ends.groupBy("node").agg(F.collect_list("y").alias("ys"), F.max(F.col("y").isNull()).alias("centre"))
    members = settle(classes.select("node", "rep", "sign", "sign2").join(ends, "node"))
    # All texts of a class's smallest id are read; the signs tell which is the class's own.
    texts = _among(rows.select(F.col("id").alias("rep"), "text"), "rep", members.select("rep"))
    found = texts.mapInArrow(_sets(size), "rep long, sign long, sign2 long, set binary").dropDuplicates(["rep", "sign", "sign2"])
    sets = settle(found.join(members, ["rep", "sign", "sign2"]).select(F.col("node").alias("id"), "set", "ys", "centre"))
    met = sets.select(F.col("id").alias("x"), F.explode("ys").alias("y"), F.col("set").alias("sx"))
    met = met.join(sets.filter("centre").select(F.col("id").alias("y"), F.col("set").alias("sy")), "y").select("x", "y", "sx", "sy")
    stars = settle(met.mapInArrow(_overlap, "x long, y long, nx long, ny long, inner long, only array<long>"))
    first = stars.filter(den * F.col("inner") >= num * (F.col("nx") + F.col("ny") - F.col("inner"))).select("x", "y")
    comp = settle(components(first))
    second = _rest(stars, sets.select("id", "set"), classes, comp, num, den, k)
    # The components found so far stand for the links that gave them.
    return comp.select(F.col("id").alias("x"), F.col("component").alias("y")).unionAll(second)


def _rest(stars: DataFrame, sets: DataFrame, classes: DataFrame, comp: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """Links between classes that met the same centre and are still in different components.

    ``f`` shingles of a class are "foreign", its centre lacks them; the other ``n - f`` bound what
    two classes share with the centre. Without a common foreign shingle both must almost lie in
    the centre. Otherwise their link needs at least ``least`` common foreign ones. If these are
    ordered alike, and the first common one is number ``p`` of ``f`` in one class, at most
    ``f - p + 1`` can be common: they meet only where both places leave enough.
    """
    placed = stars.select("x", "y", F.col("nx").alias("n"), (F.col("nx") - F.col("inner")).alias("f"))
    placed = settle(placed.join(comp.withColumnRenamed("id", "x"), "x", "left").withColumn("component", F.coalesce("component", "x")))
    sizes = placed.groupBy("y", "component").agg(F.count("*").alias("here"))
    mixed = settle(sizes.groupBy("y").agg(F.max(F.struct("here", "component")).alias("big"), F.count("*").alias("parts")).filter("parts > 1").select("y", F.col("big.component").alias("main")))
    bits = classes.select(F.col("node").alias("x"), *_PARITY)
    contested = settle(placed.join(mixed, "y").join(bits, "x"))
    lone = F.col("component") != F.col("main")

    def sides(rows: DataFrame, keys: list[str], fit) -> DataFrame:
        """Pairs of a lone class and any other under the same keys for which ``fit`` holds."""
        names = [c for c in ("x", "n", "f", "component", "place", *_PARITY) if c in rows.columns]
        left = settle(rows.filter(lone).select(*keys, *[F.col(c).alias(f"{c}_a") for c in names]))
        right = settle(rows.select(*keys, *[F.col(c).alias(f"{c}_b") for c in names], (~lone).alias("major")))
        once = (F.col("component_a") != F.col("component_b")) & (F.col("major") | (F.col("x_a") < F.col("x_b")))
        fair = den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")
        # Linked sets differ in at most this share of their sizes together.
        differ = sum((F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in _PARITY), F.lit(0))
        alike = (num + den) * differ <= (den - num) * (F.col("n_a") + F.col("n_b"))
        return left.join(right, keys).filter(once & fair & fit & alike).select("x_a", "x_b")

    # An intersection o is enough for a link if (num + den) * o >= num * (na + nb).
    both = num * (F.col("n_a") + F.col("n_b"))
    most = F.least(F.col("n_a") - F.col("f_a"), F.col("n_b") - F.col("f_b"))
    # Who lies in the centre but for a few has partners up to this size only.
    reach = contested.withColumn("reach", (num + den) * (F.col("n") - F.col("f")) - num * F.col("n"))
    near = reach.filter(F.col("reach") >= num * (F.col("n") - F.col("f")))
    floor = near.groupBy("y").agg(F.min("n").alias("low"))
    near = near.join(floor, "y").filter(F.col("reach") >= num * F.col("low"))
    plain = sides(near, ["y"], (num + den) * most >= both)
    foreign = _among(stars, "y", mixed.select("y")).join(mixed.select("y"), "y")
    foreign = settle(foreign.select("x", "y", F.explode("only").alias("h")))
    often = settle(foreign.groupBy("y", "h").agg(F.count("*").alias("df")).filter("df > 1"))
    # Bounded by the shingles of one document. Those no other class has come first.
    held = foreign.join(often, ["y", "h"]).groupBy("x", "y").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("hs"))
    held = contested.join(held, ["x", "y"]).withColumn("own", F.col("f") - F.size("hs"))
    # Even the smallest possible partner asks for this many of the foreign ones.
    last = F.col("n") - F.ceil(F.col("n") * num / den) + 1 - F.col("own")
    rarest = F.posexplode(F.slice("hs", F.lit(1), F.greatest(last, F.lit(0)).cast("int"))).alias("i", "e")
    listed = held.select("x", "y", "n", "f", "component", "main", "own", *_PARITY, rarest).withColumn("place", F.col("own") + F.col("i") + 1).withColumn("h", F.col("e.h")).drop("e", "i", "own")
    left = 1 + F.least(F.col("f_a") - F.col("place_a"), F.col("f_b") - F.col("place_b"))
    common = sides(listed, ["y", "h"], (num + den) * (most + left) >= both)
    pairs = settle(plain.unionAll(common).select(F.least("x_a", "x_b").alias("x"), F.greatest("x_a", "x_b").alias("y")).distinct())
    sketches = classes.select(F.col("node").alias("id"), F.col("sketch").alias("set"))
    likely = settle(_with_sets(pairs, sketches).mapInArrow(_likely(num, den, k), "x long, y long"))
    return settle(_with_sets(likely, sets).mapInArrow(_verify(num, den), "x long, y long"))


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, k: int = K) -> DataFrame:
    """The documents that stay: of each group the one with the smallest id."""
    groups = _grouped(docs, "doc_id", "text", size, num, den, k)
    drop = groups.filter("id is not null and component <> id").select(F.col("id").alias("__id"), F.col("mark").alias("__mark"))
    return docs.join(drop, (F.col("doc_id") == F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__mark")), "left_anti")
