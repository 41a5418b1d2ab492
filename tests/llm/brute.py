"""Plain Python versions of what the operators return, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def base_counts(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(w) < 10 or 100 * len(covered) > 20 * len(w),
    }


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    if 0 < len(w) < width:
        return {tuple(w)}
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def components(texts):
    """doc_id -> smallest doc_id reachable, by links of Jaccard similarity 0.8 or more."""
    sets = {i: shingles(t) for i, t in texts.items()}
    found = {i: i for i in texts}

    def root(i):
        while found[i] != i:
            i = found[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                found[y] = x
    return {i: root(i) for i in texts}


def without_repeats(texts):
    """doc_id -> (words, removed, hash of the kept words)."""
    first, out = {}, {}
    for i in sorted(texts):
        w = words(texts[i])
        cut = set()
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), i) < i:
                cut.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in cut)
        out[i] = (len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest())
    return out


def leaks(texts, items):
    """(doc_id, item_id) of the items of which 80 % of the shingles are in the text."""
    found = set()
    for item, text in items.items():
        width = min(len(words(text)), 5)
        own = shingles(text)
        for doc, whole in texts.items():
            if own:
                w = words((whole or "").translate(LOWER))
                there = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
                if 100 * len(own & there) >= 80 * len(own):
                    found.add((doc, item))
    return found
