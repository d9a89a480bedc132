import hashlib
import random
import re
import zlib

import pytest

from docspark.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows, rebuild=True):
    """Every prefix of every conversation, with the members in a list."""
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children, subtree = {}, {}
    for node in members:
        for d in range(len(node) + 1):
            subtree.setdefault(node[:d], []).append(node)
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                children.get(node, 0),
                sum(n not in children for n in subtree[node]),
                sum((len(members[n]) - 1) * words(n) for n in subtree[node]),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def nodes(spark, rows, schema=SCHEMA, rebuild=True, **kw):
    turns = T.number_turns(spark.createDataFrame(rows, schema))
    return sorted((tuple(r) for r in T.prefix_nodes(T.share_starts(turns) if rebuild else turns, **kw).collect()), key=str)


@pytest.mark.parametrize("width", [1, 3, 8])
def test_equals_plain_trie(spark, width):
    rng = random.Random(width)
    rows = []
    for c in list(range(-25, 70)) + [10**12 + 7]:
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d  e\tf"])))
    rows += [(200 + i, t, "user", f"word {t}") for i in range(40) for t in range(5)]  # one conversation many times
    rows += [(300, t, "user", "x y") for t in range(60)]
    assert nodes(spark, rows, width=width) == plain(rows)
    assert nodes(spark, rows, rebuild=False, width=width) == plain(rows, rebuild=False)


def test_many_ends_in_pieces(spark, monkeypatch):
    rows = [(i * 3, 0, "user", "the same turn") for i in range(1, 900)]
    monkeypatch.setattr(T, "CHUNK_BITS", 4)
    monkeypatch.setattr(T, "LARGEST", 1)
    assert nodes(spark, rows) == plain(rows)


def test_odd_rows(spark):
    assert nodes(spark, []) == []
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 2, "user", "w " * 200_000), (1, 2, "user", "w " * 200_000), (2, None, "", "")]
    extra = [(*r, "n", 1) for r in rows]
    schema = SCHEMA + ", depth string, node_x int"
    assert nodes(spark, extra, schema) == plain(rows)


def test_only_turnless_conversations(spark):
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone")]
    assert nodes(spark, rows) == plain(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
