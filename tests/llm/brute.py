"""Plain Python versions of the operators, by definition and without any of their methods."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import xxhash

WHITE = "[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(WHITE, text or "") if w]


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    w = words(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fingerprints, most=4):
    """{fingerprint: smallest fingerprint of its component}"""
    fps = sorted(set(fingerprints))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def near_duplicates(docs):
    """[(doc_id, text)] -> [(doc_id, hex fingerprint, component id)]"""
    fps = [fingerprint(t) for _, t in docs]
    comp = components(fps)
    least = {}
    for (d, _), f in zip(docs, fps):
        if d is not None:
            least[comp[f]] = min(least.get(comp[f], d), d)
    return [(d, f"{f:016x}", least.get(comp[f])) for (d, _), f in zip(docs, fps)]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    inside = repeated(w, 3)
    n_repeat = sum(inside)
    failed = len(w) < 50 or 100 * n_repeat > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, n_repeat, failed


def repeated(w, n):
    count = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    inside = [False] * len(w)
    for i in range(len(w) - n + 1):
        if count[tuple(w[i:i + n])] > 1:
            inside[i:i + n] = [True] * n
    return inside


def quality_kept(text, limits, most_line_chars, most_symbols):
    n, chars, symbols, _, _, failed = quality(text)
    if failed:
        return False
    w = words(text)
    for k, limit in limits.items():
        if sum(len(x) for x, r in zip(w, repeated(w, k)) if r) > limit * chars:
            return False
    seen, line_chars = set(), 0
    for line in (text or "").split("\n"):
        if line in seen:
            line_chars += sum(map(len, words(line)))
        if words(line):
            seen.add(line)
    return line_chars <= most_line_chars * chars and symbols <= most_symbols * n


def removed_lines(docs):
    """[(doc_id, text)] -> {(doc_id, text): sorted numbers of the lines removed}.  Lines of the same number
    in texts that share an id are no earlier or later than each other here."""
    lines = []
    for d, t in {(d, t or "") for d, t in docs}:
        for i, line in enumerate(lower(t).split("\n")):
            if words(line):
                lines.append(((d is not None, d or 0, i), (d, t), i, frozenset(words(line))))
    lines.sort(key=lambda x: x[0])
    out = {}
    for k, (place, doc, i, s) in enumerate(lines):
        for earlier, _, _, e in lines[:k]:
            both = len(s & e)
            if earlier < place and 5 * both >= 4 * (len(s) + len(e) - both):
                out.setdefault(doc, []).append(i)
                break
    return out


def cut(text, removed):
    return "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in set(removed))


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
