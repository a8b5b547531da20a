"""Plain models of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def shingle_set(text, size):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def near_duplicates(docs, size=2):
    """{doc_id: (n_shingles, component)} from all pairs."""
    sets = {d: shingle_set(t, size) for d, t in docs}
    by_shingle = {}
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d, s in sets.items():
        seen = {}
        for x in s:
            for e in by_shingle[x]:
                if e < d:
                    seen[e] = seen.get(e, 0) + 1
        for e, both in seen.items():
            if 100 * both >= 80 * (len(s) + len(sets[e]) - both):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def line_key(line):
    return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))


def line_dedup(docs):
    """{doc_id: (n_lines, n_dropped, text)}"""
    where = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= 20:
                where.setdefault(line_key(line), set()).add(d)
    owner = {k: max(v) for k, v in where.items() if len(v) >= 3}
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if owner.get(line_key(x), d) == d]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for v in windows.values() if len(v) > 1 for i in v for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def sha256(data):
    return hashlib.sha256(data).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
