"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n=5):
    w = words(ascii_lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def classes(docs, percent=85):
    """doc_id -> (number of shingles, smallest reachable id)."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                if 100 * len(x & y) >= percent * len(x | y):
                    lo, hi = sorted((find(a), find(b)))
                    root[hi] = lo
    return {d: (len(sets[d]), find(d)) for d in ids}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def contamination(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = bench_words(text)
        if w:
            for i in range(max(1, len(w) - n + 1)):
                windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for d, text in docs:
        w = bench_words(text)
        hit, names = set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found:
                    names |= found
                    hit.update(range(i, i + size))
        joined = ",".join(sorted(names))
        out[d] = (len(w), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))
    return out


def repeated_windows(docs, n=35):
    """doc_id -> (words, removed, digest of what is kept)."""
    seen: dict = {}
    split = {d: words(t) for d, t in docs}
    for d, w in split.items():
        for i in range(len(w) - n + 1):
            seen.setdefault(tuple(w[i : i + n]), []).append((d, i))
    gone: dict = {d: set() for d in split}
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + n))
    return {
        d: (len(w), len(gone[d]), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone[d]).encode()).hexdigest())
        for d, w in split.items()
    }


def repeated_bytes(docs, n=100):
    """doc_id -> (bytes, removed, runs, digest of what is kept)."""
    seen: set = set()
    out = {}
    for d, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - n + 1):
            own = raw[i : i + n]
            if own in seen:
                gone[i : i + n] = b"\x01" * n
            else:
                seen.add(own)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def similar_lines(docs, percent=80):
    """(doc_id, line) of lines with an earlier line of at least that similarity."""
    before: list = []
    gone = set()
    for d, text in sorted(docs, key=lambda x: x[0]):
        for k, line in enumerate((text or "").split("\n")):
            own = set(words(line))
            if not own:
                continue
            for other in before:
                both = len(own & other)
                if 100 * both >= percent * (len(own) + len(other) - both):
                    gone.add((d, k))
                    break
            before.append(own)
    return gone
