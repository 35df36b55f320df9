"""Plain, slow versions of the operators, written from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def secrets(text):
    text = text or ""
    spans = []
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                        r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    for kind, pattern, group, least in (
            ("assign", assign, 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
            ("hex", re.compile("[0-9a-f]+"), 0, 32)):
        for m in pattern.finditer(text):
            if len(m.group(group)) >= least:
                spans.append((m.start(), ("assign", "access", "hex").index(kind), kind, m.end()))
    spans.sort()
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    count = Counter(k for _, _, k, _ in spans)
    return (count["assign"], count["access"], count["hex"],
            hashlib.sha256(joined.encode()).hexdigest(), joined)


def fingerprint(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    parts = ([" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
             or [" ".join(words)])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, distance=3):
    """rows: (doc_id, text) -> sorted (doc_id, fingerprint, component_id)."""
    prints = [(k, fingerprint(t)) for k, t in rows]
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array([p for _, p in prints], np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= distance):
            a, b = root(i), root(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (k, _) in enumerate(prints):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return [(k, f"{p:016x}", least.get(root(i))) for i, (k, p) in enumerate(prints)]


def quality(text, min_words, max_covered, max_longest):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    repeat = {j for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1
              for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    covered, longest = set(), 0
    for i in range(n):
        size = 0
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                size = max(size, k)
        if size >= min_words:
            covered |= set(range(i, i + size))
            longest = max(longest, size)
    base = n < 50 or 100 * len(repeat) > 50 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(repeat), base,
            not base and len(covered) <= max_covered * n and longest <= max_longest,
            len(covered), longest)


def line_dedup(rows, ratio, min_pages):
    """rows: (doc_id, host, text) -> (doc_id, clean text, lines, dropped)."""
    pages, seen = Counter(h for _, h, _ in rows), Counter()
    key = lambda x: x.strip(" \t\r")
    for _, h, t in rows:
        seen.update((h, x) for x in {key(x) for x in (t or "").split("\n")} if x)
    out = []
    for k, h, t in rows:
        if t is None:
            out.append((k, None, 0, 0))
            continue
        lines = t.split("\n")
        kept = [x for x in lines if not key(x) or seen[h, key(x)] < min_pages
                or seen[h, key(x)] <= ratio * pages[h]]
        out.append((k, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def check_packing(rows, pieces, tokenizer, length=4096):
    """rows: (doc_id, text) with distinct ids; pieces: rows of the query. Returns the padding."""
    of = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for k, t in rows}
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(of)
    for k, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            ids = of[k][p.start:p.start + p.length]
            assert p.start == at and p.length == len(ids) > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            assert p.doc_tokens == len(of[k])
            at += p.length
        assert at == len(of[k])
    padding = 0
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding
