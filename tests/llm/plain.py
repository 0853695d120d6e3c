"""Plain versions of the operators' results, for tables small enough to compare everything with everything."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def decontaminated(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(ascii_lower(text or ""))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc, text in docs:
        w = word.findall(ascii_lower(text or ""))
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    ids |= found
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def repeated_bytes(docs: list[tuple], size: int = 200) -> list[tuple]:
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in docs]
    for _, b in texts:
        seen.update(b[k : k + size] for k in range(len(b) - size + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text: str | None, width: int = 5) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def near_duplicates(docs: list[tuple]) -> list[tuple]:
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b or 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
                continue
            shared = len(a & b)
            if 100 * shared >= 75 * (len(a) + len(b) - shared):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets]


def best_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments by their recursive definition: the best one, then those on either side."""

    def split(lo: int, hi: int) -> list[tuple[int, int, float]]:
        best = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += scores[b]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                    best = (a, b + 1, total)
        if best is None:
            return []
        return [*split(lo, best[0]), best, *split(best[1], hi)]

    return split(0, len(scores))


def toxic_terms(rows: list[tuple], prior: float, least_z: float, floor: float) -> dict[str, float]:
    """Weights of the terms of (toxic, text) rows: words and prefixes of 4 to 6 letters with a large and significant excess among toxic rows."""
    held = (Counter(), Counter())
    size = [0, 0]
    for y, text in rows:
        size[y] += 1
        words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
        held[y].update(words | {w[:k] + "*" for w in words for k in (4, 5, 6) if len(w) > k})
    total, out = sum(size), {}
    for term, a in held[1].items():
        b = held[0][term]
        if a * size[0] <= b * size[1]:
            continue
        spread = prior * (a + b) / total
        odds = [math.log((n + spread) / (m + prior - n - spread)) for n, m in ((b, size[0]), (a, size[1]))]
        ratio = sum(n * math.log(n * total / ((a + b) * m)) for n, m in ((b, size[0]), (a, size[1])) if n)
        if math.sqrt(max(0.0, 2 * ratio)) >= least_z and odds[1] - odds[0] >= floor:
            out[term] = odds[1] - odds[0]
    return out


def word_counts(docs: list[tuple], least_length: int = 6, least_count: int = 5) -> dict[str, int]:
    """Counts of the runs of letters of (doc_id, text) rows, each with a letter dropped where the rule of the query says so."""
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{doc}:{run}".encode()) if doc is not None else 1
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}


def one_edit(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def variants(n: dict[str, int], lead: int = 5) -> list[tuple]:
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= lead * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def ranked(docs: list[tuple], items: list[tuple], top: int = 10) -> list[tuple]:
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(d, Counter(term.findall(ascii_lower(t or "")))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    size, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted({(i, t) for i, t in items if t is not None}, key=str):
        scores = []
        for doc, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * size) // length
            score = sum(math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in term.findall(ascii_lower(text)) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank + 1, None if unnamed else doc, -score) for rank, (score, unnamed, doc) in enumerate(sorted(scores)[:top])]
    return out


def block_labels(blocks: list[tuple]) -> list[bool]:
    """Whether each (region, size, linked, stops, heading, marked) block is main text, by the two passes' rules, block by block."""
    many = any(region != "chrome" and size >= 140 and linked <= 0.25 and stops >= 0.12 for region, size, linked, stops, *_ in blocks)

    def first(region, size, linked, stops, heading, marked):
        if region == "chrome":
            return False
        if linked > 0.5:
            return None if region == "main" and heading else False
        if region == "body" and size < 140 and (linked > 0.25 or (marked and stops < 0.12)):
            return False
        return True if size >= 140 and linked <= 0.25 and (stops >= 0.12 or not many) else None

    own = [first(*b) for b in blocks]
    out = list(own)
    for i, (region, _, _, _, heading, _) in enumerate(blocks):
        if own[i] is None:
            same = [j for j, b in enumerate(blocks) if b[0] == region]
            at = same.index(i)
            before = [(k, own[j]) for k, j in enumerate(same[:at]) if own[j] is not None][-1:]
            after = [(k, own[j]) for k, j in enumerate(same) if k > at and own[j] is not None][:1]
            if region == "main":
                out[i] = not (before and after and not before[0][1] and not after[0][1])
            elif before and after:
                out[i] = after[0][1] if heading or after[0][0] - at < at - before[0][0] else before[0][1]
            elif before or after:
                out[i] = (before or after)[0][1]
    if not any(x for x in out if x is not None):
        out = [True if b[0] == "main" else x for b, x in zip(blocks, out, strict=True)]
    nothing = not any(out)
    return [nothing if x is None else x for x in out]
