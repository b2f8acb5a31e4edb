"""Plain versions of the operators for small tables."""

import hashlib
import re
from collections import Counter

LETTERS = "[^\\x20\\x09-\\x0D]+"


def words(text):
    return re.findall(LETTERS, text or "")


def shingles(text, size=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def components(sets, num=85, den=100):
    """Smallest id reachable of each id in {id: set}."""
    ids = sorted(sets)
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            inner = len(sets[a] & sets[b])
            if inner and den * inner >= num * (len(sets[a]) + len(sets[b]) - inner):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def repeats(rows, size=20):
    """{id: (n_words, n_removed, hash)} of (id, text) rows."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if key in seen:
                gone[k : k + size] = [True] * size
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    out = []
    for rank, (kind, pattern, fine) in enumerate(rules):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if fine(m[0])]
    return [s for _, _, s in sorted(out)]


def quality(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed
