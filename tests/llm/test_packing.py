import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from docspark.llm import catalog, packing, tokens
from tests.llm.helpers import docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


ODD = ["", None, " ", "  a  b\n\n c\t", "It's we'll <|endoftext|> x", "ééß　 \x85q", "a" * 5000, "1234567 !!! ###", "word " * 3000, "tie", "tie"]


def test_pieces_are_the_tokenizers_ids(spark, model):
    got = tokens.pieces(docs(spark, list(enumerate(ODD))), PATH, 1024, 2, with_ids=True).collect()
    by_doc = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(ODD):
        ids = model.encode(text or "", add_special_tokens=False).ids + [2]
        rows = by_doc[i]
        assert [x for r in rows for x in r["ids"]] == ids
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        at = 0
        for k, r in enumerate(rows):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert r["length"] == 1024 or k == 0
            at += r["length"]


def test_packs_everything_without_gaps(spark, small, model):
    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = docs(spark, [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (10_001, "again")])
    got = packing.pack_documents(table.unionByName(odd).withColumn("piece_uid", F.lit("clash")), PATH, block_size=64).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    texts = [r["text"] for r in table.collect()] + ODD + ["no id", "again"]
    total = sum(len(model.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    assert sum(r["length"] for r in got) == total
    assert len(sequences) <= -(-total // 1024) * 1.02 + 1


def test_solver_never_breaks_a_packing():
    solver = packing.Solver([7, 7, 6, 6, 5, 5, 4, 4, 3, 3, 2, 1] * 5, 10, seed=3)
    items = list(range(len(solver.sizes)))
    a, b = solver.best_fit([], solver.decreasing(items)), solver.best_fit([], solver.decreasing(items, 0.5))
    for packed in (solver.cross(a, b), solver.mutate(a), solver.evolve([], 4, 20)):
        assert sorted(i for held in packed for i in held) == items
        assert all(sum(solver.sizes[i] for i in held) <= 10 for held in packed)
    assert len(solver.evolve([], 4, 20)) <= len(a)


def test_empty_table(spark):
    assert packing.pack_documents(docs(spark, []), PATH).count() == 0


def test_registered_ids_are_the_tokenizers_at_its_defaults(spark, tmp_path):
    model = Tokenizer.from_file(PATH)
    texts = [t or "" for t in ODD] + ["a <|endoftext|> b", "<|endoftext|><|endoftext|>\n", "x" * 3000 + "<|endoftext|>", "<|endoftext| >"]
    assert model.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    table = docs(spark, list(enumerate(texts)))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    for got in (catalog.op2_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, table, str(tmp_path))):
        rows = sorted(got.select("doc_id", "start", "length", "ids_crc32").collect())
        for i, text in enumerate(texts):
            ids = model.encode(text, add_special_tokens=False).ids + [2]
            own = [r for r in rows if r["doc_id"] == i]
            assert sum(r["length"] for r in own) == len(ids), text[:40]
            for r in own:
                part = ids[r["start"] : r["start"] + r["length"]]
                assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()), text[:40]
