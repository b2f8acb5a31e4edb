"""Conversation repair by aligning turns to the alternating grammar.

A conversation is well formed if the initials of its roles give ``(s?(ua)+)?``. Turns can be kept
(0), given the role user or assistant (3) or deleted (4), and an empty turn of user or assistant
can be inserted anywhere (3). Blank turns and repeats must be deleted; a truncated turn that stays
adds 3. The cheapest edits win; among equally cheap ones the least sequence of edit initials
(D, I, K, R) in ASCII order.

``cheapest`` aligns the turns to the grammar's string of each feasible length (Wagner and Fischer).
Costs already needed by the number of turns and targets on either side of a cell bound the band of
cells that can beat the incumbent (Ukkonen), and the lengths that can. Each alignment is traced
back along its least letters, and the audits of all lengths are compared.

The work of an alignment grows with the cube of its length, so conversations of more than ``LONG``
turns take ``cheapest_long``: the grammar's four states in one pass from the end, with the order of
the four suffixes kept by rank. Both give the same result; a test compares them.

Turns are dealt by conversation and sorted, and stream through the tasks: a conversation holds one
letter and one 16-byte digest a turn, never its texts. A second stream, sorted the same way and led
by the audit, applies the edits.

Defined cases: null roles and texts are one blank, in turns with a null number too, which come
first. Turns with one number are ordered by role and digest. Rows without a conversation id are
one conversation. An initial that is not s, u or a, or an empty role, can not be kept. A
conversation whose rows are all dropped has zeros and no turns. An empty table gives no rows. Only
the four named columns are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.scale import settle

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LONG = 96
_ROLES = {"u": "user", "a": "assistant"}
_FAIR = ("su", "ua", "au")
BLANKS = " \t\n\v\f\r"


def _needed(forced: int, others: int, cut: int, targets: int) -> int:
    """The least cost of turning ``others`` turns (``cut`` of them truncated) into ``targets``."""
    if targets > others:
        return DELETE * forced + INSERT * (targets - others) + TRUNCATED * cut
    gone = others - targets
    return DELETE * (forced + gone) + TRUNCATED * max(0, cut - gone)


def grammar(length: int) -> str:
    """The well-formed string of this length (there is none of length one)."""
    return "s" * (length % 2) + "ua" * (length // 2)


def _align(codes: str, target: str, limit: int) -> tuple[int, str] | None:
    """Cost and least audit of the alignment to one target, if it costs at most ``limit``."""
    n, size = len(codes), len(target)
    forced, others, cut = [0], [0], [0]
    for c in codes:
        forced.append(forced[-1] + (c == "d"))
        others.append(others[-1] + (c != "d"))
        cut.append(cut[-1] + c.isupper())
    far = limit + 1
    value = [[far] * (size + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        here, below = value[i], value[i + 1]
        code = codes[i] if i < n else ""
        role, extra = code.lower(), TRUNCATED * code.isupper()
        rest = forced[n] - forced[i], others[n] - others[i], cut[n] - cut[i]
        for j in range(size, -1, -1):
            if _needed(forced[i], others[i], cut[i], j) + _needed(*rest, size - j) > limit:
                continue
            if i == n and j == size:
                here[j] = 0
                continue
            best = far
            if i < n:
                best = DELETE + below[j]
                if j < size and role != "d":
                    if role == target[j]:
                        best = min(best, extra + below[j + 1])
                    elif target[j] != "s":
                        best = min(best, REROLE + extra + below[j + 1])
            if j < size and target[j] != "s":
                best = min(best, INSERT + here[j + 1])
            here[j] = best
    if value[0][0] > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < size:
        left = value[i][j]
        code = codes[i] if i < n else ""
        role, extra = code.lower(), TRUNCATED * code.isupper()
        if i < n and left == DELETE + value[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < size and target[j] != "s" and left == INSERT + value[i][j + 1]:
            audit.append("I")
            j += 1
        elif role == target[j] and left == extra + value[i + 1][j + 1]:
            audit.append("K")
            i, j = i + 1, j + 1
        else:
            audit.append("R")
            i, j = i + 1, j + 1
    return value[0][0], "".join(audit)


def cheapest(codes: str) -> tuple[int, str]:
    """(cost, audit) of turns given as letters: the initial s, u, a or x, upper case if truncated, d if it must go."""
    forced = codes.count("d")
    others, cut = len(codes) - forced, sum(map(str.isupper, codes))
    # Deleting everything is always possible.
    best = (DELETE * len(codes), "D" * len(codes))
    lengths = [k for k in range(2, 2 * len(codes) + 3) if _needed(forced, others, cut, k) <= best[0]]
    for k in sorted(lengths, key=lambda k: (_needed(forced, others, cut, k), k)):
        if _needed(forced, others, cut, k) > best[0]:
            break
        found = _align(codes, grammar(k), best[0])
        if found is not None:
            best = min(best, found)
    return best


_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEPS = {_START: {"s": _SYSTEM, "u": _USER}, _SYSTEM: {"u": _USER}, _USER: {"a": _ASSISTANT}, _ASSISTANT: {"u": _USER}}
_FAR = 1 << 60


def cheapest_long(codes: str) -> tuple[int, str]:
    """The same in time and memory that grow with the number of turns.

    Equally cheap suffixes of a state differ first in their letter, then in the order of two
    suffixes of one column, so the order of the four suffixes is all that is kept.
    """
    costs = [0, _FAR, _FAR, 0]
    keys = [("", 0), ("", 0), ("", 0), ("", 0)]
    moves = bytearray()
    for code in [None, *reversed(codes)]:
        if code is None:
            base = [(c, k, 0, q) for q, (c, k) in enumerate(zip(costs, keys, strict=True))]
        else:
            order = {k: r for r, k in enumerate(sorted(set(keys)))}
            ranks = [order[k] for k in keys]
            role, extra = code.lower(), TRUNCATED * code.isupper()
            base = []
            for q in range(4):
                options = [(DELETE + costs[q], ("D", ranks[q]), 0, q)]
                if role != "d":
                    for c, to in _STEPS[q].items():
                        if c == role:
                            options.append((extra + costs[to], ("K", ranks[to]), 2, to))
                        elif c != "s":
                            options.append((REROLE + extra + costs[to], ("R", ranks[to]), 3, to))
                base.append(min(options))
        inserted = lambda to, found: (INSERT + found[0], ("I", found[1]), 1, to)
        user = min(base[_USER], inserted(_ASSISTANT, base[_ASSISTANT]))
        assistant = min(base[_ASSISTANT], inserted(_USER, base[_USER]))
        column = [min(base[_START], inserted(_USER, user)), min(base[_SYSTEM], inserted(_USER, user)), user, assistant]
        costs, keys = [c[0] for c in column], [c[1] for c in column]
        moves += bytes(c[2] << 2 | c[3] for c in column)
    audit, q, at = [], _START, len(codes)
    while True:
        move = moves[4 * at + q]
        letter, to = move >> 2, move & 3
        if at == 0 and letter != 1:
            break
        audit.append("DIKR"[letter])
        q = to
        at -= letter != 1
    return costs[_START], "".join(audit)


@lru_cache(maxsize=1 << 16)
def _short(codes: str) -> tuple[int, str]:
    return cheapest(codes)


def edits(codes: str) -> tuple[int, str]:
    return _short(codes) if len(codes) <= LONG else cheapest_long(codes)


def damage(turns: DataFrame) -> DataFrame:
    """The rows with faults planted by a hash of conversation and turn; ``times`` tells how often a row stands there."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )


def _plain(turns: DataFrame) -> DataFrame:
    times = F.col("times").cast("int") if "times" in turns.columns else F.lit(1)
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    said = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), times.alias("times"), said.alias("said"))


def _streamed(rows: DataFrame, *first: str) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *first, "turn", "role", "said")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


class _Report:
    """What is known of a conversation while its turns pass."""

    def __init__(self, conv):
        self.conv, self.codes, self.seen = conv, [], set()
        self.low = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, initial, blank, cut, said):
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn = turn
            self.turns += 1
        if self.before is not None and self.before + initial not in _FAIR:
            self.illegal += 1
        self.before = initial
        code = initial if initial and initial in "sua" else "x"
        if blank:
            self.blank += 1
            code = "d"
        elif said in self.seen:
            self.duplicate += 1
            code = "d"
        elif cut:
            self.truncated += 1
            code = code.upper()
        self.seen.add(said)
        self.codes.append(code)

    def row(self):
        cost, audit = edits("".join(self.codes))
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_AUDIT_NAMES = [c.split()[0] for c in _AUDIT.split(", ")]


def _examine(batches):
    """One row a conversation; rows of a conversation follow each other."""

    def packed(rows):
        columns = list(zip(*rows, strict=True))
        kinds = [*[pa.int64()] * 7, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_AUDIT_NAMES)

    current, done = None, []
    for batch in batches:
        for conv, turn, initial, blank, cut, said, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if current is None or current.conv != conv:
                if current is not None:
                    done.append(current.row())
                current = _Report(conv)
            for _ in range(times):
                current.add(turn, initial, blank, cut, said)
        if len(done) >= 4096:
            yield packed(done)
            done = []
    if current is not None:
        yield packed([*done, current.row()])


def examine(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
    # The last character that is no blank; none leaves an empty string.
    real = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    rows = _streamed(_plain(turns).select("conv_id", "turn", "role", "said", "times", F.substring("role", 1, 1).alias("initial"), real.alias("last")))
    facts = rows.select("conv_id", "turn", "initial", (F.col("last") == "").alias("blank"), (~F.col("last").isin(".", "!", "?")).alias("cut"), "said", "times")
    return facts.mapInArrow(_examine, _AUDIT)


def _apply(whole: bool):
    """Apply each audit to the turns that follow it: turns with their edit, or one digest a conversation."""

    def finish(state, out):
        conv, audit, _, at, digest, n = state
        for letter in audit[at:]:
            if letter == "I":
                n = _give(state, out, n, "I", None, None)
        if not whole:
            out.append((conv, digest.hexdigest()))

    def _give(state, out, n, edit, role, text):
        conv, _, target, _, digest, _ = state
        if edit in "IR":
            role = _ROLES[target(n)]
        text = "" if edit == "I" else text
        if whole:
            out.append((conv, n, edit, role, text))
        else:
            digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
        return n + 1

    def packed(out):
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()] if whole else [pa.int64(), pa.string()]
        names = ["conv_id", "place", "edit", "role", "text"] if whole else ["conv_id", "repaired_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches):
        state, out = None, []
        for batch in batches:
            held = 0
            for conv, audit, role, text, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if audit is not None:
                    if state is not None:
                        finish(state, out)
                    odd = sum(audit.count(c) for c in "IKR") % 2
                    target = lambda n, odd=odd: "s" if odd and n == 0 else "ua"[(n - odd) % 2]
                    state = [conv, audit, target, 0, hashlib.sha256(), 0]
                    continue
                for _ in range(times):
                    while state[1][state[3]] == "I":
                        state[5] = _give(state, out, state[5], "I", None, None)
                        state[3] += 1
                    edit = state[1][state[3]]
                    state[3] += 1
                    if edit != "D":
                        state[5] = _give(state, out, state[5], edit, role, text)
                        held += len(text)
                if held > 1 << 22 and out:
                    yield packed(out)
                    out, held = [], 0
            if out:
                yield packed(out)
                out = []
        if state is not None:
            finish(state, out)
            if out:
                yield packed(out)

    return run


def _edited(turns: DataFrame, audits: DataFrame) -> DataFrame:
    rows = _plain(turns).filter("times > 0").withColumns({"kind": F.lit(1), "audit": F.lit(None).cast("string")})
    null = lambda kind: F.lit(None).cast(kind)
    heads = audits.select("conv_id", null("long").alias("turn"), null("string").alias("role"), null("string").alias("text"), F.lit(0).alias("times"), null("binary").alias("said"), F.lit(0).alias("kind"), "audit")
    return _streamed(rows.unionByName(heads), "kind").select("conv_id", "audit", "role", "text", "times")


def repaired(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns that stay, in order; ``audits`` comes from ``examine``."""
    return _edited(turns, audits).mapInArrow(_apply(True), "conv_id long, place long, edit string, role string, text string")


def repair_digests(turns: DataFrame) -> DataFrame:
    """The report of every conversation with the hash of its repaired ``role:text`` lines."""
    audits = settle(examine(turns))
    hashed = _edited(turns, audits).mapInArrow(_apply(False), "conv_id long, repaired_sha256 string")
    return audits.join(hashed.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
