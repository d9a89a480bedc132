"""Plain Python versions of what the operators compute, for small inputs."""

import re
from collections import defaultdict

DOC = "doc_id bigint, text string"


def docs(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if len(words) >= size:
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    return {tuple(words)} if words else set()


def jaccard(rows, size, percent):
    """Per id the set size and the component, from all pairs that share a shingle."""
    sets = {d: shingles(t, size) for d, t in rows}
    holders = defaultdict(list)
    edges = []
    for d, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for other in holders[x]:
                shared[other] += 1
            holders[x].append(d)
        edges += [(d, o) for o, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[o]) - n)]
    found = components(sets, edges)
    return {d: (len(s), found[d]) for d, s in sets.items()}
