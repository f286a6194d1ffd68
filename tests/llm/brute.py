"""Plain single-process versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


def contamination(docs, items, width=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)} by trying every window."""
    windows: dict[tuple, set] = {}
    sizes = set()
    for item_id, text in items:
        w = words(text)
        n = min(width, len(w))
        for a in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(item_id)
            sizes.add(n)
    out = {}
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                ids = windows.get(tuple(w[a:a + n]))
                if ids:
                    hit.update(range(a, a + n))
                    found |= ids
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out[doc_id] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                       bool(hit))
    return out


def shingles(text: str | None, k=5) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[a:a + k]) for a in range(max(1, len(w) - k + 1)))


def near_duplicates(docs, threshold=0.8):
    """{row: (class row, links)} comparing all pairs; rows are numbered in order."""
    sets = [shingles(t) for _, t in docs]
    links = [0] * len(sets)
    part = list(range(len(sets)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for l in by.values() for i, a in enumerate(l) for b in l[i + 1:]}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            links[a] += 1
            links[b] += 1
            i, j = find(a), find(b)
            part[max(i, j)] = min(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        r = find(i)
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return [(d, least.get(find(i)), links[i]) for i, (d, _) in enumerate(docs)]


def quality(text: str | None):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[a:a + 8]) for a in range(len(w) - 7))
    covered = set()
    for a in range(len(w) - 7):
        if seen[tuple(w[a:a + 8])] > 1:
            covered.update(range(a, a + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), failed)


def secrets(text: str | None):
    """Base spans by the stated patterns as they are written."""
    text = text or ""
    out = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                         r"([A-Za-z0-9+/_.=-]+)", text, re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, m.end(), "hex"))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def url_parts(url: str | None):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return m[1].translate(_LOWER), m[2]
