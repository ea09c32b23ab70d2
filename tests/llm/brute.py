"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text, lower=False):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(UP) if lower else text)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def shingles(text, k=5):
    w = spaced(text, lower=True)
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def components(rows, percent=80):
    """Row number -> least id of its component (None ids name nothing)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * inter >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) if sets[i] else rows[i][0] for i in range(len(rows))], sets


def removed(rows, window=13):
    """For each row the words and a mask of those to remove."""
    key = [float("inf") if i is None else i for i, _ in rows]
    words = [spaced(t) for _, t in rows]
    least = {}
    for k, w in zip(key, words):
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least.get(g, k), k)
    out = []
    for k, w in zip(key, words):
        mask = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < k:
                mask[i:i + window] = [True] * window
        out.append((w, mask))
    return out


def contamination(docs, items, window=13):
    wins = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        if item is None or not w:
            continue
        for i in range(max(len(w) - window + 1, 1)):
            wins[tuple(w[i:i + window])].add(str(item))
    sizes = {len(g) for g in wins}
    out = []
    for _, text in docs:
        w = alnum(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                g = tuple(w[i:i + n])
                if g in wins:
                    hit.update(range(i, i + n))
                    found |= wins[g]
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out
