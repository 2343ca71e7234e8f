"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD9 = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD6 = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def decontamination(docs, items):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    phrases = {}
    for item, text in items:
        w = WORD9.findall(lower(text))
        for s in range(max(1, len(w) - 9) if w else 0):
            phrases.setdefault(tuple(w[s:s + 10]), set()).add("" if item is None else str(item))
    sizes, out = {len(p) for p in phrases}, []
    for doc, text in docs:
        w, hit, found = WORD9.findall(lower(text)), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (p := tuple(w[s:s + n])) in phrases:
                    hit.update(range(s, s + n))
                    found |= phrases[p]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def near_duplicates(docs, k=3, share=85):
    """[(doc_id, n_shingles, component_id, kept)] by comparing every pair that shares a shingle."""
    sets, by = {}, {}
    for doc, text in docs:
        w = WORD6.findall(lower(text))
        sets[doc] = {tuple(w[s:s + k]) for s in range(max(1, len(w) - k + 1))} if w else set()
        for x in sets[doc]:
            by.setdefault(x, []).append(doc)
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    seen = set()
    for group in by.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                if a != b and (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= share * len(sets[a] | sets[b]):
                        x, y = sorted((top(a), top(b)))
                        up[y] = x
    return [(d, len(s), top(d), top(d) == d) for d, s in sets.items()]


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal_data(text):
    """{kind: [(start, end)]}"""
    out = {}
    for kind, pattern in BASE:
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) \
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15:
                out[kind].append(m.span())
    return out
