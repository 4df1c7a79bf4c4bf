"""Plain Python forms of the operators' definitions."""

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, size):
    w = [x.translate(LOWER) for x in words(text)]
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components(rows, size, percent=80):
    """{position: smallest id of its component} of (id, text) rows; null ids never are the smallest."""
    sets, parent = [shingle_set(t, size) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(rows))]


def without_repeats(texts, length):
    raw, count, out = [(t or "").encode() for t in texts], Counter(), []
    for b in raw:
        count.update(b[p:p + length] for p in range(len(b) - length + 1))
    for b in raw:
        cut = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                cut[p:p + length] = True
        runs = int((np.diff(np.concatenate([[0], cut.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~cut].tobytes()
        out.append((len(b), int(cut.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def line_stats(text):
    w, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count, hit = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2)), set()
    for i in range(len(w) - 2):
        if count[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for kind, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if least <= len(d) <= most and (kind == 3 or luhn(d)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def secrets(text):
    key = "|".join("".join(f"[{c.upper()}{c}]" for c in k) for k in ("password", "passwd", "secret", "token"))
    key += "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
           if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32])


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
