"""Conversation repair against a search over all edits, and against SQL."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

from kerbline.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def search(codes):
    """(cost, audit) over all edits by their definition."""

    @lru_cache(None)
    def best(i, made):
        state = "" if not made else made
        out = [(0, "")] if i == len(codes) and state in ("", "a") else []
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        if i < len(codes):
            role, extra = codes[i].lower(), 3 * codes[i].isupper()
            moves = [(4, "D", made)]
            if role != "d":
                moves += [(extra + 3 * (t != role), "K" if t == role else "R", t) for t in after if t == role or t != "s"]
            for cost, letter, to in moves:
                rest = best(i + 1, to)
                out.append((cost + rest[0], letter + rest[1]))
        return min(out + [(c, a) for c, a in inserted(i, state, after, 0)], default=(10**6, "~"))

    def inserted(i, state, after, depth):
        """Inserted turns before turn ``i``; more than three in a row are never cheapest."""
        found = []
        for t in after:
            if t == "s":
                continue
            for cost, audit in tails(i, t, depth + 1):
                found.append((3 + cost, "I" + audit))
        return found

    def tails(i, state, depth):
        after = {"s": "u", "u": "a", "a": "u"}[state]
        out = [(0, "")] if i == len(codes) and state == "a" else []
        if i < len(codes):
            role, extra = codes[i].lower(), 3 * codes[i].isupper()
            rest = best(i + 1, state)
            out.append((4 + rest[0], "D" + rest[1]))
            if role != "d":
                for t in after:
                    rest = best(i + 1, t)
                    out.append((extra + 3 * (t != role) + rest[0], ("K" if t == role else "R") + rest[1]))
        return out + (inserted(i, state, after, depth) if depth < 3 else [])

    return best(0, "")


def test_both_ways_find_the_least_edits():
    rng = random.Random(2)
    for _ in range(800):
        codes = "".join(rng.choice("suaxuaSUAXdua") for _ in range(rng.randrange(10)))
        want = search(codes)
        assert conversations.cheapest(codes) == want
        assert conversations.cheapest_long(codes) == want


def test_long_conversations_take_one_pass():
    rng = random.Random(3)
    codes = "".join(rng.choice("uauauauausdUAx") for _ in range(70))
    assert conversations.cheapest(codes) == conversations.cheapest_long(codes)
    assert conversations.edits("ua" * 20_000 + "u") == (3, "K" * 40_001 + "I")


def plain(rows):
    """The whole query for (conv_id, turn, role, text) rows."""
    out = {}
    blank = " \t\n\v\f\r"
    for conv in {r[0] for r in rows}:
        turns = []
        for c, t, role, text in rows:
            if c != conv:
                continue
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            turns += [(t, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
        key = lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(f"{len(x[1].encode())}:{x[1]}{x[2]}".encode()).digest())
        turns.sort(key=key)
        seen, codes, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not text.strip(blank):
                counts["blank"], code = counts["blank"] + 1, "d"
            elif (role, text) in seen:
                counts["duplicate"], code = counts["duplicate"] + 1, "d"
            elif text.rstrip(blank)[-1] not in ".!?":
                counts["truncated"], code = counts["truncated"] + 1, code.upper()
            seen.add((role, text))
            codes += code
        cost, audit = search(codes) if turns else (0, "")
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        stay = len(audit.replace("D", ""))
        target = "s" * (stay % 2) + "ua" * (stay // 2)
        lines, left, j = [], list(turns), 0
        for e in audit:
            turn = left.pop(0) if e != "I" else None
            if e == "D":
                continue
            role = turn[1] if e == "K" else {"u": "user", "a": "assistant"}[target[j]]
            lines.append(f"{role}:{turn[2] if turn else ''}")
            j += 1
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = ["Hello there.", "No end", "", None, " \n\t", "Why?", "Yes!", "Yes! ", "é.", " x", "y" * 50_000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 8)):
            out.append((conv, None if rng.random() < 0.05 else turn * rng.randrange(1, 3), rng.choice(roles[:2] * 4 + roles), rng.choice(texts)))
    out += [(99, 1, "user", "Once.")] * 5
    # A conversation whose only row is dropped.
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*out, (gone, 0, "user", "Lost.")]


def test_query_equals_the_plain_version(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r[0]: tuple(r)[1:] for r in conversations.repair_digests(conversations.damage(turns)).collect()}
    assert got == plain(rows)


def test_query_equals_sql(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(queries.OP12_SQL)
    names = [d[0] for d in want.description]
    got = queries.op12_conversations(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)


def test_repaired_turns_follow_the_grammar(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA)
    audits = conversations.examine(turns)
    said = {}
    for r in sorted(conversations.repaired(turns, audits).collect(), key=lambda r: (str(r["conv_id"]), r["place"])):
        said.setdefault(r["conv_id"], []).append(r)
    for own in said.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in own))
        assert [r["place"] for r in own] == list(range(len(own)))


def test_empty_table_and_clashing_columns(spark):
    assert conversations.repair_digests(conversations.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    extra = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 1)], SCHEMA + ", said string, kind int")
    assert conversations.repair_digests(extra).first()["cost"] == 3
