"""Plain Python versions of what the operators compute, for small tables."""
import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

BASE = (("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32))


def base_spans(text):
    out = []
    for n, (kind, pattern, group, least) in enumerate(BASE):
        out += [(m.start(), n, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(docs, k, percent):
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            n = len(a & b)
            if n and 100 * n >= percent * (len(a) + len(b) - n):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    first = {}
    for i, (doc, _) in enumerate(docs):
        first[find(i)] = min(doc, first.get(find(i), doc))
    return [(doc, len(sets[i]), first[find(i)]) for i, (doc, _) in enumerate(docs)]


def kept_lines(docs, percent=80, least=3):
    """Docs in order of (doc_id): the kept lines of each."""
    seen, out = [], []
    for _, text in docs:
        mine = []
        for line in (text or "").split("\n") if text is not None else []:
            s = frozenset(w for w in re.split(r"[\x20\x09\x0b-\x0D]", line) if w)
            hit = len(s) >= least and any(100 * len(s & t) >= percent * len(s | t) for t in seen if percent * len(s) <= 100 * len(t) and percent * len(t) <= 100 * len(s))
            if not hit:
                mine.append(line)
            if len(s) >= least:
                seen.append(s)
        out.append(mine)
    return out


def repeats(texts, length):
    """(n_bytes, n_removed, n_spans, sha) per text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def jaccard(a, b):
    x, y = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0
