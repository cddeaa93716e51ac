"""Plain versions of the corpus operators for small inputs."""

from __future__ import annotations

import collections
import hashlib

import regex


def words(text):
    return regex.sub(r"[^\p{L}\p{N}\p{M}]+", " ", (text or "").lower()).split()


def shingles(text, size=5):
    found = words(text)
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))) if found else frozenset()


def near_duplicates(rows):
    """{row index: (class id, links)} of (doc_id, text) rows, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            linked = 5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared) if sets[a] and sets[b] else False
            if not sets[a] and not sets[b]:
                linked = bool(rows[a][1]) and rows[a][1] == rows[b][1]
            if linked:
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return [(least.get(top(i)), links[i]) for i in range(len(rows))]


def cut(texts, length=400):
    """(bytes, removed, spans, kept bytes) of each text."""
    data = [(text or "").encode() for text in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def cut_passages(texts, length=200, words=50, size=400):
    """What stays of each text, or None where nothing is cut."""
    data = [(text or "").encode() for text in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept, at, i = [], 0, 0
        while i < len(d):
            if not gone[i]:
                i += 1
                continue
            j = i
            while j < len(d) and gone[j]:
                j += 1
            a, b = i, j
            while a and d[a - 1] > 32 and a < j and d[a] not in b" \t\n\r\x0b\x0c":
                a += 1
                if d[a - 1] in b" \t\n\r\x0b\x0c":
                    a -= 1
                    break
            while b < len(d) and d[b] > 32 and b > i and d[b - 1] not in b" \t\n\r\x0b\x0c":
                b -= 1
            b -= b < j and b > i
            if a < b and len(d[a:b].split()) >= words:
                kept, at = [*kept, d[at:a]], b
            elif j - i >= size:
                kept, at = [*kept, d[at:i]], j
            i = j
        kept.append(d[at:])
        out.append("".join(k.decode("utf-8", "ignore") for k in kept) if len(kept) > 1 else None)
    return out


def tiles(item, document, least=5):
    """Greedy string tiling by trying every pair of positions."""
    used_a, used_b, found = set(), set(), []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(document)):
                n = 0
                while (
                    a + n < len(item) and b + n < len(document) and item[a + n] == document[b + n]
                    and a + n not in used_a and b + n not in used_b
                ):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return found
        found.append(best)
        used_a.update(range(best[0], best[0] + best[2]))
        used_b.update(range(best[1], best[1] + best[2]))


def sha256(data):
    return hashlib.sha256(data).hexdigest()
