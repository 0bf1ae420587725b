"""Plain versions of the operators, one text at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeats(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k):
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def classes(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)].append(doc)
    return [(doc, len(sets[i]), min(ids[find(i)], default=None)) for i, (doc, _) in enumerate(rows)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def spans(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def rules(text):
    t = text or ""
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    n, r = len(w), len(covered)
    failed = n < 10 or 100 * r > 20 * n
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r, failed
