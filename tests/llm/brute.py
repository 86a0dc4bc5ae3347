"""Plain-Python versions that the operators' results are compared with."""

import hashlib
import re

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ("email", "ip", "card", "phone")
PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in PII[kind].finditer(text or ""):
            d = "".join(c for c in m.group() if c in "0123456789")
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                  "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    out.sort()
    counts = [sum(k == i for _, k, _ in out) for i in range(4)]
    listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in out)
    return counts, hashlib.sha256(listed.encode()).hexdigest(), listed


def simhash(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_components(rows):
    """rows (doc_id, fp) -> list of smallest reachable ids, by all pairs."""
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(n)]


def quality(text):
    text = text or ""
    w = WORDS.findall(text)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    hit = set()
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=sum(c in "#*$%&|<>" for c in text),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(hit),
                base_failed=len(w) < 10 or 100 * len(hit) > 20 * len(w))


def repeats(texts, width=200):
    """Per text: (n_bytes, n_removed, n_spans, kept bytes)."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(raws):
        for i in range(len(b) - width + 1):
            seen.setdefault(b[i:i + width], []).append((d, i))
    marks = [np.zeros(len(b) + 1, bool) for b in raws]
    for at in seen.values():
        if len(at) > 1:
            for d, i in at:
                marks[d][i:i + width] = True
    out = []
    for b, m in zip(raws, marks):
        m = m[:len(b)]
        spans = int((m & ~np.r_[False, m[:-1]]).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~m]) if len(b) else b""
        out.append((len(b), int(m.sum()), spans, kept))
    return out
