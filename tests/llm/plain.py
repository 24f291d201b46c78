"""Plain versions of the operators, one text or table at a time, for comparison."""

import hashlib
import math
import random
import re
from collections import Counter

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k):
    w = SPACE_WORD.findall(fold(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k=4, num=85, den=100):
    """{row number: (set size, smallest id reachable)} of (id, text) rows."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)] = min(ids.get(find(i), key), key)
    return [(rows[i][0], len(sets[i]), ids.get(find(i))) for i in range(len(rows))]


def contamination(text, items, n=10):
    """(words, hit words, sorted items) of a text against [(item_id, text)]."""
    w = ALNUM_WORD.findall(fold(text))
    hit, found = set(), set()
    for key, body in items:
        b = ALNUM_WORD.findall(fold(body))
        size = min(n, len(b))
        if not size or key is None:
            continue
        wins = {tuple(b[i:i + size]) for i in range(len(b) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in wins:
                hit.update(range(i, i + size))
                found.add(str(key))
    return len(w), len(hit), sorted(found)


def secrets(text):
    """(kind, start, end) spans of the base rules, sorted."""
    text = text or ""
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
                         r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def base_counts(text):
    """(words, their characters, symbols, repeated lines, words in repeated windows)."""
    text = text or ""
    w = SPACE_WORD.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def ppm_bits(text, training, order):
    """Code length of a text after the whole texts of one language, method C without exclusion."""
    counts = {}
    for body in training:
        b = body.encode()
        for i in range(len(b)):
            for k in range(min(i, order) + 1):
                counts.setdefault(b[i - k:i], Counter())[b[i]] += 1
    total = 0.0
    b = text.encode()
    for i in range(len(b)):
        for k in range(min(i, order), -1, -1):
            c = counts.get(b[i - k:i])
            if c is None:
                continue
            n, d = sum(c.values()), len(c)
            if c[b[i]]:
                total -= math.log2(c[b[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


def vocabulary(seed, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
