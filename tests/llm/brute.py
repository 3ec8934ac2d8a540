"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def suffix_dedup(rows, width):
    """{doc_id: (n_bytes, n_removed, n_spans, kept)}; rows: (doc_id, text)."""
    texts = {d: (t or "").encode() for d, t in rows}
    where = defaultdict(int)
    for b in texts.values():
        for p in range(len(b) - width + 1):
            where[hash(b[p: p + width])] += 1
    out = {}
    for d, b in texts.items():
        upto, gone = 0, bytearray(len(b))
        for p in range(len(b) - width + 1):
            if where[hash(b[p: p + width])] > 1:
                for q in range(max(p, upto), p + width):
                    gone[q] = 1
                upto = p + width
        spans = sum(1 for q in range(len(b)) if gone[q] and (not q or not gone[q - 1]))
        out[d] = (len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g))
    return out


def substring_dedup(rows, width):
    """{doc_id: (n_words, n_removed, kept)}"""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            key = tuple(w[p: p + width])
            if key in seen:
                gone[p: p + width] = [True] * width
            seen.add(key)
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def jaccard_classes(rows, n=3, percent=90):
    """{doc_id: (set size, smallest linked id)}"""
    sets = {}
    for d, t in rows:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[d] = frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    by_gram, done = defaultdict(list), set()
    for d, s in sets.items():
        for g in s:
            by_gram[g].append(d)
    for members in by_gram.values():
        for i, a in enumerate(members):
            for b in members[:i]:
                if (a, b) in done or find(a) == find(b):
                    continue
                done.add((a, b))
                x, y = sets[a], sets[b]
                if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                    both = len(x & y)
                    if both * 100 >= percent * (len(x) + len(y) - both):
                        lo, hi = sorted((find(a), find(b)))
                        root[hi] = lo
    return {d: (len(s), find(d)) for d, s in sets.items()}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def pii_base(text):
    """[(start, kind index, end)] by the patterns as they are stated."""
    text, out = text or "", []
    pats = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for k, p in enumerate(pats):
        for m in re.finditer(p, text, re.A):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or k == 2 and 14 <= len(d) <= 19 and luhn(d) or k == 3 and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def pii_digest(text):
    b = pii_base(text)
    names = ("email", "ip", "card", "phone")
    return (*[sum(k == i for _, k, _ in b) for i in range(4)], sha(",".join(f"{names[k]}:{s}:{e}" for s, k, e in b)))
