"""Plain versions of what SQL can't express."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import regex


def normal(line: str) -> str:
    return regex.sub(r"[^\p{L}\p{M}\p{N}]+", " ", line.lower()).strip(" ")


def simhash(features: list[int], bits: int) -> int:
    return sum(1 << j for j in range(bits) if 2 * sum(h >> j & 1 for h in features) > len(features))


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def groups(nodes: list, links: list[tuple]) -> dict:
    """Smallest node in reach of each node."""
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            top[n] = top[top[n]]
            n = top[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def dedup_lines(docs: list[tuple[int, str]]) -> dict[int, str]:
    """By edit similarity alone, of all pairs of lines."""
    first: dict[str, tuple[int, int]] = {}
    for doc_id, text in sorted(docs):
        for k, line in enumerate(text.split("\n")):
            if norm := normal(line):
                first.setdefault(norm, (doc_id, k))
    links = []
    for a, b in combinations(first, 2):
        long = max(len(a), len(b))
        if min(len(a), len(b)) * 100 >= long * 80 and edits(a, b) <= long * 20 // 100:
            links.append((first[a], first[b]))
    keep = set(groups(list(first.values()), links).values())
    out = {}
    for doc_id, text in docs:
        out[doc_id] = "\n".join(line for k, line in enumerate(text.split("\n")) if not (n := normal(line)) or first[n] == (doc_id, k) and (doc_id, k) in keep)
    return out


def words(text: str | None, pattern: str) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(pattern, lowered)


def jaccard_groups(docs: list[tuple[int, str | None]], k: int = 2) -> dict[int, int]:
    """Smallest id in reach by links of sets of k-word shingles of similarity 0.8 or more."""
    sets = {}
    for i, t in docs:
        w = words(t, r"[^\x20\x09-\x0D]+")
        sets[i] = {tuple(w[at : at + k]) for at in range(max(1, len(w) - k + 1))} if w else set()
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return groups(list(sets), links)


def contaminated(text: str | None, items: list[str | None]) -> bool:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    own = f" {' '.join(words(text, pattern))} "
    for item in items:
        w = words(item, pattern)
        if any(f" {' '.join(w[k : k + 10])} " in own for k in range(max(1, len(w) - 9)) if w):
            return True
    return False


def suffix_tree_base(texts):
    """n_tokens, n_known, train_tokens and base score of each id."""
    own = {i: [*(t or "").encode().lower().split(), None] for i, t in texts}
    counts = Counter(w for i, ws in own.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n = counts.total()
    below = math.log10(n + len(counts) + 1)
    return {i: (len(ws), sum(counts[w] > 0 for w in ws), n, math.fsum(math.log10(counts[w] + 1) for w in ws) - below * len(ws)) for i, ws in own.items()}


def suffix_tree_scores(texts, depth, least_count, least_gain):
    """Score of each id: every context counted in a dictionary, each distribution whole."""
    symbols = {i: b"\n" * depth + b" ".join((t or "").encode().lower().split()) + b"\n" for i, t in texts}
    after = defaultdict(Counter)
    for i, s in symbols.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for at in range(depth, len(s)):
                for k in range(depth + 1):
                    after[s[at - k : at]][s[at]] += 1
    n = after[b""].total()
    kept = {b"": {x: (after[b""][x] + 1) / (n + 256) for x in range(256)}}

    def longest(context):
        while context not in kept:
            context = context[1:]
        return kept[context]

    for context in sorted((c for c in after if c), key=len):
        counts, parent = after[context], longest(context[1:])
        total, kinds = counts.total(), len(counts)
        gain = sum(c * math.log(c / total / parent[x]) for x, c in counts.items())
        if total >= least_count and gain >= least_gain * kinds:
            kept[context] = {x: (counts[x] + kinds * parent[x]) / (total + kinds) for x in range(256)}
    return {i: math.fsum(math.log10(longest(s[at - depth : at])[s[at]]) for at in range(depth, len(s))) for i, s in symbols.items()}
