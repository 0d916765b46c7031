"""Plain, slow versions of the operators, written from their contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


def contaminated(docs, bench, size=10):
    """doc rows (id, text) and items (id, text) -> rows (id, n_words, n_hit, n_items, sha)."""
    def cut(s):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s or ""))
    wins = defaultdict(set)
    for item, text in bench:
        w = cut(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[i:i + size])].add("" if item is None else str(item))
    sizes = {len(k) for k in wins}
    out = []
    for d, text in docs:
        w, hit, items = cut(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = wins.get(tuple(w[i:i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    items |= got
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(items), sha, bool(hit)))
    return out


def fingerprint(text, k=3):
    w = words(lower(text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked_components(docs, distance=3):
    """rows (id, text) -> {(id, fingerprint hex): component} by comparing all distinct fingerprints."""
    fps = [(d, fingerprint(t)) for d, t in docs]
    u = np.array(sorted({f for _, f in fps}), np.uint64)
    root = {int(x): int(x) for x in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x in u:
        for y in u[np.bitwise_count(u ^ x) <= distance]:
            a, b = find(int(x)), find(int(y))
            root[max(a, b)] = min(a, b)
    least = {}
    for d, f in fps:
        r = find(f)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{f:016x}", least.get(find(f))) for d, f in fps), key=str)


def lines_kept(docs, min_chars=20, min_docs=3):
    """rows (id, text) -> rows (id, n_lines, n_dropped, sha)."""
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            held[key(line)].add(d)
    best = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in best or best[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


def pieces(docs, path, size=2048):
    """rows (id, text) -> (id, piece, start, length, crc)."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    out = []
    for d, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % size or size if len(ids) > size else len(ids)
        bounds = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out.append((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def quality(docs):
    """rows (id, text) -> (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed)."""
    out = []
    for d, t in docs:
        t = t or ""
        w = words(t)
        wins = Counter(zip(w, w[1:], w[2:]))
        rep = {j for i in range(len(w) - 2) if wins[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if words(x)]
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep),
                    len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    return out


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    """Base spans of a text: (n_assign, n_access, n_hex, joined)."""
    text = text or ""
    a = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    k = [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    h = [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    names = ("assign", "access", "hex")
    return len(a), len(k), len(h), ",".join(f"{names[n]}:{s}:{e}" for s, n, e in sorted(a + k + h))
