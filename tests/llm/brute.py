"""Plain versions of the document operators, for small inputs."""
import hashlib
import re
from itertools import combinations

import xxhash


def spans_removed(rows, length=100):
    """doc_id -> (bytes, removed, spans, sha256) by comparing every window."""
    seen, out = set(), {}
    for d, t in sorted({(d, t or "") for d, t in rows}):
        b = t.encode()
        cov = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                cov[s:s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, c in zip(b, cov) if not c)
        runs = sum(1 for i in range(len(b)) if cov[i] and (i == 0 or not cov[i - 1]))
        out[d] = (len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def fingerprint(text):
    small = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", small)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(marks, distance=3):
    """id -> smallest id reachable among (id, fingerprint)."""
    up = {d: d for d, _ in marks}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, x), (b, y) in combinations(marks, 2):
        if bin(x ^ y).count("1") <= distance:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {d: root(d) for d, _ in marks}
