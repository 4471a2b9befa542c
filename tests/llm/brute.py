"""Plain Python versions of the operators, for small tables."""

import hashlib
import re

import xxhash


def components(ids, linked):
    """Smallest id reachable from each position; `linked` tells whether two positions are linked."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(ids))]


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def simhash_rows(rows):
    prints = [simhash(t) for _, t in rows]
    roots = components([d for d, _ in rows], lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 4)
    return {(d, f"{p:016x}", r) for (d, _), p, r in zip(rows, prints, roots)}


def substrings(rows, length=50):
    """{doc_id: (bytes, removed, spans, digest)} for unique ids."""
    first = {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * (len(b) + 1)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def sentence_rows(rows, span, min_words):
    cut = lambda t: [p for p in re.split(r"(?<=[.!?])(?=\s)|(?<=\n)(?=\S)", t) if p]
    plain = {d: [" ".join(p.lower().split()) for p in cut(t)] for d, t in rows}
    plain = {d: [p for p in ps if p] for d, ps in plain.items()}
    seen, gone = {}, {d: set() for d, _ in rows}
    for d, _ in sorted(rows):
        n = min(span, len(plain[d]))
        for i in range(len(plain[d]) - n + 1 if n else 0):
            run = tuple(plain[d][i : i + n])
            if sum(len(p.split()) for p in run) < min_words:
                continue
            if run in seen:
                gone[d] |= set(range(i, i + n))
            seen.setdefault(run, (d, i))
    return {d: (len(plain[d]), len(gone[d]), [p for i, p in enumerate(plain[d]) if i not in gone[d]]) for d, _ in rows}


ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def secrets(text):
    """Base spans as listed in the result."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
    counts = tuple(sum(k == i for _, k, _ in found) for i in range(3))
    return counts, hashlib.sha256(listed.encode()).hexdigest()
