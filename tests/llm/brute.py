"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    named = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            named[find(k)] = min(doc_id, named.get(find(k), doc_id))
    return [(d, len(sets[k]), named.get(find(k))) for k, (d, _) in enumerate(rows)]


def contamination(text: str | None, items: list[tuple]) -> tuple:
    """(n_words, n_hit, n_items, items_sha256, contaminated) of one document."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = re.findall(pattern, lower(text))
    hit, found = [False] * len(words), set()
    for item_id, item in items:
        item_words = re.findall(pattern, lower(item))
        size = min(13, len(item_words))
        windows = {tuple(item_words[i : i + size]) for i in range(len(item_words) - size + 1)}
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in windows:
                hit[i : i + size] = [True] * size
                found.add(item_id)
    names = ",".join(sorted(str(x) for x in found if x is not None))
    n = sum(hit)
    digest = hashlib.sha256(names.encode()).hexdigest()
    return len(words), n, len([x for x in found if x is not None]), digest, (
        n > 0 and 20 * n >= len(words))
