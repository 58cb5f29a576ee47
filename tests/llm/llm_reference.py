"""Plain versions of what the operators compute at scale."""

import math
from collections import Counter


def near_duplicate_groups(docs, threshold=0.8):
    """doc_id to smallest doc_id of its group, comparing all pairs that share a shingle."""
    texts = {d: tuple((t or "").split()) for d, t in docs}
    n = sum(t is not None for _, t in docs)
    sets = {w: Counter(w[k : k + 5] for k in range(max(1, len(w) - 4))) for w in set(texts.values()) if w}
    df = Counter(s for w in texts.values() if w for s in sets[w])
    idf = {s: 1 + math.log(n / c) / math.log(max(n, 2)) for s, c in df.items()}
    weights = {w: {s: c * idf[s] for s, c in x.items()} for w, x in sets.items()}
    group = {w: w for w in weights}
    for a in weights:
        for b in weights:
            common = weights[a].keys() & weights[b].keys()
            if a < b and common:
                least = sum(min(weights[a][s], weights[b][s]) for s in common)
                if least >= threshold * (sum(weights[a].values()) + sum(weights[b].values()) - least):
                    old, new = group[b], group[a]
                    group = {w: new if g == old else g for w, g in group.items()}
    first = {}
    for d in sorted(texts):
        if texts[d]:
            first.setdefault(group[texts[d]], d)
    return {d: first[group[w]] if w else d for d, w in texts.items()}
