"""Small tables and plain Python versions for the tests of this folder."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow.dataset as ds

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: chr(i + 32) for i in range(65, 91)}


def table(name: str, sf: str = SF):
    return ds.dataset(f"{sf}/{name}.parquet").to_table().to_pylist()


def sentence(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def corpus(seed: int = 1):
    """(doc_id, text): random texts, exact copies, near copies of one base, a passage in many, and odd texts."""
    r = random.Random(seed)
    base, passage = sentence(r, 120).split(), sentence(r, 60) + "."
    docs = [sentence(r, r.randint(6, 200)) for _ in range(40)]
    docs += [docs[0]] * 5 + [docs[3].upper()] * 2
    for _ in range(100):
        w = base[:]
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = sentence(r, 1)
        docs.append(" ".join(w))
    docs += [f"{sentence(r, r.randint(5, 40))} {passage} {sentence(r, r.randint(5, 40))}" for _ in range(20)]
    docs += [None, "", "   \n\t ", "one", "one", "one two three four", "One two three FOUR", "a b c d e", sentence(r, 4000), "x" * 30000]
    return list(enumerate(docs))


def shingle_set(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) >= k:
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)] if w else [])


def union_find(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    holders, pairs = defaultdict(list), []
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                pairs.append((i, j))
    return {i: (len(sets[i]), c) for i, c in union_find(sets, pairs).items()}
