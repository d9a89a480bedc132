import math
import random
import re

from docspark.llm import licenses as L
from tests.llm.helpers import ascii_lower, docs

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text, templates=L.TEMPLATES, threshold=0.9):
    words = re.findall(WORD, ascii_lower(text or ""))
    places = [(i, label) for label, phrase in L.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    labels, best = {label for _, label in places}, 0.0
    for label, template in templates:
        own = re.findall(WORD, ascii_lower(template))
        distinct, pairs = set(own), set(zip(own, own[1:]))
        need = math.ceil(len(distinct) * threshold - 1e-9)
        spare = len(distinct) - need
        if len(distinct & set(words)) < need:
            continue
        for i in range(len(words)):
            block = words[i : i + len(own) + spare]
            share = len(distinct.intersection(block)) / len(distinct)
            if share >= need / len(distinct) and len(pairs.intersection(zip(block, block[1:]))) >= len(pairs) - 2 * spare:
                labels.add(label)
                best = max(best, share)
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})),
        ",".join(sorted(labels)), 1.0 if places else best,
    )


def test_equals_brute_force(spark, small):
    rng = random.Random(1)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    parts = [t for _, t in (*L.TEMPLATES, *L.PHRASES)] + ["ééé", "License", "\n", "...", "x y z " * 30]
    for i in range(150):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 12)))
        rows.append((1000 + i, "".join(c for c in text if rng.random() > 0.004).title() if i % 2 else text))
    rows += [(5000, None), (5001, ""), (5002, "CC-BY"), (5003, "cc\nby"), (5004, "General  Public\tLicense" * 2), (5005, "all rights reserved " * 20_000), (5006, "ccé by")]
    got = {r["doc_id"]: tuple(r)[1:] for r in L.digest(L.scan(docs(spark, rows))).collect()}
    for d, text in rows:
        assert got[d] == brute(text), (d, (text or "")[:200])


def test_odd_tables(spark):
    df = docs(spark, [(None, "MIT? Released under the MIT License.", 1), (7, "cc by", 2), (7, "cc by", 2)], "doc_id bigint, text string, n_words bigint")
    got = L.scan(df).collect()
    assert [[m["label"] for m in r["matches"]] for r in got] == [["mit"], [], []]
    assert got[0]["matches"][0]["first"] == 1 and got[0]["matches"][0]["last"] == 5
    assert [r["n_words"] for r in got] == [6, 2, 2]
    assert L.scan(df.limit(0)).count() == 0


def test_wrapped_templates_are_found(spark):
    wrapped = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software",
        "bsd": "Redistribution and use in source and binary forms, with or without\r\n * modification, are permitted",
        "apache-2.0": "Licensed\nunder\nthe\nApache\nLicense,\nVersion\n2.0",
    }
    rows = list(enumerate(wrapped.values()))
    rows += [(10 + i, "x y\n" * n + t + "\nz" * n) for n in (13, 30, 47) for i, t in enumerate(wrapped.values(), n)]
    rows += [(900, "Permission is hereby granted, free of charge, to any"), (901, "person obtaining a copy of this software")]  # two texts
    got = {r["doc_id"]: r for r in L.digest(L.scan(docs(spark, rows))).collect()}
    for i, label in enumerate(wrapped):
        assert got[i]["labels"] == label and got[i]["score"] == 1.0
        assert all(got[10 + n + i]["labels"] == label for n in (13, 30, 47))
    assert got[900]["labels"] == got[901]["labels"] == ""
    (r,) = L.scan(docs(spark, [(1, "a b\n\n" + wrapped["mit"])])).collect()
    assert [(m["label"], m["first"], m["last"]) for m in r["matches"]] == [("mit", 2, 17)]


def _made(n, seed):
    """A template of ``n`` words, some of them repeated."""
    rng = random.Random(seed)
    return " ".join(f"w{seed}x{rng.randrange(n)}" for _ in range(n))


def test_templates_of_any_length_are_found_at_every_offset(spark):
    templates = [(f"t{n}", _made(n, n)) for n in (1, 2, 34, 80, 130, 400)]
    rows, want = [], {}
    for label, text in templates:
        for offset in (0, 1, 10, 28, 63, 64, 65, 200):
            want[len(rows)] = label
            rows.append((len(rows), "x y " * offset + text.replace(" ", " \n", offset) + " z" * offset))
    got = {r["doc_id"]: r for r in L.scan(docs(spark, rows), templates).collect()}
    for d, label in want.items():
        assert [(m["label"], m["containment"]) for m in got[d]["matches"]] == [(label, 1.0)], (d, label)
        n = int(label[1:])
        assert got[d]["matches"][0]["last"] - got[d]["matches"][0]["first"] == n - 1


def test_a_tenth_of_the_words_may_be_missing_but_not_the_order(spark):
    (label, text), rng = ("long", _made(130, 7)), random.Random(3)
    words = text.split()
    shuffled = rng.sample(words, len(words))
    distinct = sorted(set(words))
    spare = len(distinct) - math.ceil(0.9 * len(distinct) - 1e-9)
    lost = lambda n: " ".join("other" if w in distinct[:n] else w for w in words)
    rows = [(0, text), (1, " ".join(shuffled)), (2, lost(spare)), (3, lost(spare + 1)), (4, " ".join(reversed(words)))]
    got = L.digest(L.scan(docs(spark, rows), [(label, text)])).collect()
    for r, (_, t) in zip(sorted(got, key=lambda r: r["doc_id"]), rows):
        assert (r["labels"], r["score"]) == brute(t, [(label, text)])[5:]
    assert {r["doc_id"] for r in got if r["labels"]} >= {0} and not {r["doc_id"] for r in got if r["labels"]} & {1, 3, 4}
    (bag,) = L.scan(docs(spark, [(1, "licensed for 4 0 reasons by cc, under nc, and more")])).collect()
    assert bag["matches"] == []


def test_copies_in_a_row_are_all_reported(spark):
    text = "Released under the MIT License. "
    (r,) = L.scan(docs(spark, [(1, text * 50)])).collect()
    assert [(m["first"], m["last"]) for m in sorted(r["matches"], key=lambda m: m["first"])] == [(5 * i, 5 * i + 4) for i in range(50)]
