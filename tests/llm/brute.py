"""Plain Python versions of the training-data operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, rows, extra=False):
    """rows: (doc_id, text[, lang[, source]]); ``extra`` adds columns whose names the operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    if extra:
        for name in ("mark", "key", "size", "spans", "fp", "score", "kind", "start", "bucket", "ids"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


def simhash(text, shingle=3):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, most=2):
    """{doc_id: smallest linked doc_id} of (doc_id, text) rows."""
    fps = [(i, simhash(t)) for i, t in rows]
    root = {i: i for i, _ in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(fps):
        for j, b in fps[:k]:
            if (a ^ b).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in fps}


def base_quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def keep_windows(rows, window=20):
    """{doc_id: kept words} of (doc_id, text) rows with different ids."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        gone = set()
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if k in seen:
                gone.update(range(s, s + window))
            seen.add(k)
        out[i] = [x for j, x in enumerate(w) if j not in gone]
    return out


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def pii_base(text):
    def passes(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            luhn = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
            return 13 <= len(digits) <= 19 and luhn % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def sainte_lague(votes, seats):
    """Seats per item by highest quotients, one at a time; ties to the smaller item."""
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min((i for i in votes if votes[i] > 0), key=lambda i: (-votes[i] / (2 * won[i] + 1), i))
        won[best] += 1
    return won


def mix_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """{source: target} by sharing out the excess until no target is above its cap."""
    order = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        goal = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if goal[s] > cap * sizes[s] + 1e-9]
        if not above:
            return {**stopped, **goal}
        stopped.update({s: float(cap * sizes[s]) for s in above})
