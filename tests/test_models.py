import json
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docspark.operators import entities as E
from docspark.operators import models as M
from docspark.operators import roles as R
from docspark.sources.scratch import stage
from tests.test_quality import record


def test_calls_in_flight_are_bounded_and_in_order():
    open_now, most, lock = [0], [0], threading.Lock()
    taken = []

    def inputs():
        for i in range(20):
            taken.append(i)
            yield i

    def call(i):
        with lock:
            open_now[0] += 1
            most[0] = max(most[0], open_now[0])
        time.sleep(0.002 * (5 - i % 5))
        with lock:
            open_now[0] -= 1
        if i == 7:
            raise ValueError("seven")
        return i * i

    out = []
    for x, y, failed in M.in_flight(inputs(), call, at_once=3):
        out.append((x, y, str(failed) if failed else None))
        assert len(taken) <= len(out) + 3
    assert out == [(i, None, "seven") if i == 7 else (i, i * i, None) for i in range(20)]
    assert 1 < most[0] <= 3


def test_retries_wait_longer_each_time(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(M.time, "sleep", waits.append)

    def call(x):
        calls.append(x)
        if len(calls) < 5:
            raise OSError("busy")
        return x

    assert M.with_retries(call, tries=5, first_wait=2, longest_wait=10)("a") == "a"
    assert waits == [2, 4, 8, 10]
    calls.clear()
    with pytest.raises(OSError):
        M.with_retries(call, tries=2)("b")


def test_bad_rows_are_found_by_halving():
    asked = []

    def model(rows):
        asked.append(len(rows))
        if rows["x"].isin([3, 11]).any():
            raise RuntimeError("bad")
        return rows * 2

    rows = pd.DataFrame({"x": range(16)})
    good, bad = [], []
    for part, found, error in M.isolated(model, rows):
        good += [] if found is None else found["x"].tolist()
        bad += [] if error is None else [(part["x"].iloc[0], error)]
    assert good == [2 * i for i in range(16) if i not in (3, 11)]
    assert bad == [(3, "RuntimeError: bad"), (11, "RuntimeError: bad")]
    assert len(asked) < 20


def answerer():
    whole = record()
    full, short = json.dumps(whole), json.dumps({k: v for k, v in whole.items() if k != "total_pages"})

    def load():
        import pandas as pd

        def model(rows):
            out = []
            for key, prompt in zip(rows["doc_id"], rows["prompt"]):
                again = "does not fit" in prompt
                if key == "raises" or (key == "raises once" and not again):
                    raise TimeoutError("late")
                answer = {"no json": "sorry", "missing": full if "total_pages: field required" in prompt else short}.get(key, full)
                out += [(key, answer)] * {"lost": 0, "twice": 2}.get(key, 1)
                if key == "good":
                    out.append(("made up", answer))
            return pd.DataFrame(out, columns=["doc_id", "answer"])

        return model

    return load


def test_answers_are_checked_and_asked_for_again(spark):
    keys = ["good", "no json", "missing", "raises", "raises once", "lost", "twice"]
    prompts = spark.createDataFrame([(k, "the document") for k in keys], "doc_id string, prompt string")
    got = {r["doc_id"]: r for r in M.checked_answers(prompts, answerer()).collect()}
    assert {k: r["outcome"] for k, r in got.items()} == {
        "good": "accepted",
        "no json": "quarantined",
        "missing": "corrected",
        "raises": "quarantined",
        "raises once": "corrected",
        "lost": "quarantined",
        "twice": "quarantined",
        "made up": "unasked",
    }
    assert json.loads(got["missing"]["record"]) == record() and got["missing"]["tries"] == 2 and got["good"]["tries"] == 1
    assert got["raises"]["problems"] == ["TimeoutError: late"] and got["lost"]["problems"] == ["no answer"] and got["twice"]["problems"] == ["2 answers"]
    assert got["no json"]["record"] is None and got["no json"]["problems"] == ["no JSON object"]
    once = {r["doc_id"]: r["outcome"] for r in M.checked_answers(prompts, answerer(), corrections=0).collect()}
    assert once["missing"] == "quarantined" and once["good"] == "accepted"
    assert M.checked_answers(prompts.limit(0), answerer()).count() == 0


def recognisers():
    def load():
        def words(rows):
            if rows["text"].str.contains("BAD").any():
                raise ValueError("cannot read")
            text = rows["text"].str.split().str[0]
            return rows[["doc_id", "page_number"]].assign(text=text, label="W", char_start=0, char_end=text.str.len())

        def all_of_it(rows):
            return rows[["doc_id", "page_number"]].assign(text=rows["text"], label="A", char_start=0, char_end=rows["text"].str.len())

        return {"words": words, "all": all_of_it}

    return load


def test_one_bad_page_costs_one_page(spark):
    rows = [(f"d{i}", 1, "BAD page" if i in (4, 17) else f"w{i} text") for i in range(40)] + [("blank", 1, " "), ("none", 1, None)]
    mentions, bad = E.recognise_models(spark.createDataFrame(rows, "doc_id string, page_number int, text string").coalesce(1), recognisers())
    counts = {r["source_model"]: r["count"] for r in mentions.groupBy("source_model").count().collect()}
    assert counts == {"words": 38, "all": 40}
    assert sorted(tuple(r) for r in bad.collect()) == [("d17", 1, "words", "ValueError: cannot read"), ("d4", 1, "words", "ValueError: cannot read")]


def sent_blocks(spark, n=70):
    rows = [(d, f"{d}-{i}", 1, i, "p", "x | y" if i % 3 else "x") for d in ("a", "b") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, block_id string, page_number int, ord int, section_path string, text string")


def test_scorer_batches_come_whole_and_failures_cost_their_batch(spark):
    seen = {}

    def scorer(rows):
        key = (rows["doc_id"].iloc[0], int(rows["batch"].iloc[0]))
        assert len(set(rows["doc_id"])) == 1 and len(rows) <= 30 and rows["ord"].is_monotonic_increasing
        seen[key] = seen.get(key, 0) + 1
        if key == ("a", 1) or (key == ("b", 0) and seen[key] < 3):
            raise ConnectionError("busy")
        return rows[["doc_id", "block_id", "page_number"]].assign(text_role="other", hints=[["none"]] * len(rows), confidence=0.5, rationale=str(len(rows)))

    blocks = sent_blocks(spark)
    scored = R.score_blocks(blocks, scorer, size=30, first_wait=0.01).collect()
    assert len(scored) == 110 and {r["rationale"] for r in scored if r["doc_id"] == "b"} == {"30", "10"}
    lost = [r["block_id"] for r in R.parity_violations(blocks, spark.createDataFrame(scored)).where("problem = 'missing'").collect()]
    assert sorted(lost) == sorted(f"a-{i}" for i in range(30, 60))


def test_nulls_do_not_pass_the_gate(spark):
    schema = "doc_id string, block_id string, page_number int, text_role string, hints array<string>, confidence double, rationale string"
    sent = sent_blocks(spark, 3).where("doc_id = 'a'")
    rows = [
        ("a", "a-0", 1, None, ["none"], None, ""),
        ("a", "a-1", 1, "other", ["none"], 0.5, ""),
        ("a", "a-2", None, "other", ["none"], 0.5, ""),
        ("a", None, 1, "other", ["none"], 0.5, "made up"),
    ]
    accepted, wrong = R.accept_scores(sent, spark.createDataFrame(rows, schema))
    assert [r["block_id"] for r in accepted.collect()] == ["a-1"]
    assert {(r["block_id"], r["problem"]) for r in wrong.collect()} == {("a-0", "text_role"), ("a-2", "page_number"), (None, "extra")}
    blank = sent.withColumn("text", F.lit(None).cast("string"))
    done, bad = R.profile_with_model(blank, F.col("text").rlike("x"), lambda rows: rows[["doc_id", "block_id", "page_number"]].assign(text_role="other", hints=[["none"]] * len(rows), confidence=1.0, rationale=""))
    assert done.count() == 3 and bad.count() == 0


def test_a_mention_gets_the_first_span_that_holds_it(spark):
    spans = [("long", 0, 100), ("inside", 10, 20), ("late", 90, 130), ("same", 0, 100), ("empty", 50, 50), ("after", 140, 150)]
    s = spark.createDataFrame([("d", 1, *x) for x in spans], "doc_id string, page_number int, block_id string, start int, end int")
    mentions = spark.createDataFrame([("d", 1, o) for o in (0, 15, 15, 95, 100, 129, 130, 145)], "doc_id string, page_number int, char_start int")
    for width in (7, 1024):
        got = sorted((r["char_start"], r["block_id"]) for r in E.attach_blocks(mentions, s, width).collect())
        assert got == [(0, "long"), (15, "long"), (15, "long"), (95, "long"), (100, "late"), (129, "late"), (130, None), (145, "after")]
    cut = E.first_spans(s).collect()
    assert sorted((r["block_id"], r["start"], r["end"]) for r in cut) == [("after", 140, 150), ("late", 100, 130), ("long", 0, 100)]


def test_spans_equal_a_plain_search(spark):
    import random

    rng = random.Random(4)
    spans = [(f"d{rng.randrange(3)}", 1, f"b{i:03}", a, a + rng.randrange(0, 30)) for i in range(150) for a in [rng.randrange(0, 300)]]
    mentions = [(f"d{rng.randrange(3)}", 1, rng.randrange(0, 340)) for _ in range(400)]
    s = spark.createDataFrame(spans, "doc_id string, page_number int, block_id string, start int, end int")
    m = spark.createDataFrame(mentions, "doc_id string, page_number int, char_start int")
    want = sorted(
        (d, o, next((b for a, e, b in sorted((a, e, b) for dd, _, b, a, e in spans if dd == d) if a <= o < e), None) or "") for d, _, o in mentions
    )
    assert sorted((r["doc_id"], r["char_start"], r["block_id"] or "") for r in E.attach_blocks(m, s, 16).collect()) == want


def test_batches_are_whole_across_frames_and_values_stay_as_they_are():
    """Calls get whole batches however Arrow cuts the rows; an integer beside a null of another small frame is no float."""
    def rows(*ids):
        return pd.DataFrame([(d, b) for d, b in ids], columns=["doc_id", "batch"], dtype=object)

    frame = rows((1, 0), (1, 0), (1, 1), (None, 1), (None, 1), (2, 1))
    assert R._batch_cuts(frame) == [0, 2, 3, 5, 6] and R._batch_cuts(frame[:0]) == []
    small = [pd.DataFrame({"a": [2**53 + 1], "b": [1]}), pd.DataFrame({"a": [None], "b": [2]}, dtype=object)]
    joined = list(M.gathered(iter(small), columns=["a"]))
    assert len(joined) == 1 and joined[0]["a"].tolist() == [2**53 + 1, None] and list(joined[0]) == ["a"]


def test_texts_are_cut_twice_for_a_model(spark, monkeypatch):
    """Once for the ids of the blocks and once for the model; the rest works on the ids that were written."""
    monkeypatch.setattr(R, "stage", lambda df, name: staged.append(name) or stage(df, name))
    staged: list[str] = []
    blocks = sent_blocks(spark, 30)

    def scorer(rows):
        return rows[["doc_id", "block_id", "page_number"]].assign(text_role="other", hints=[["none"]] * len(rows), confidence=0.5, rationale="")

    accepted, wrong = R.profile_with_model(blocks, F.col("ord") % 10 == 3, scorer, size=7)
    assert staged == ["marked-blocks", "scored-blocks"] and accepted.count() == blocks.count() and wrong.isEmpty()
    assert all("docspark-" in f for df in (accepted, wrong) for f in df.inputFiles())


def test_a_scorer_may_answer_in_lists(spark):
    """Columns as lists cost less than a frame for a small batch, and give the same profiles."""
    blocks = sent_blocks(spark)

    def lists(rows):
        n = len(rows)
        ids = {c: rows[c].tolist() for c in ("doc_id", "block_id", "page_number")}
        return ids | {"text_role": ["other"] * n, "hints": [["none"]] * n, "confidence": [0.5] * n, "rationale": [str(n)] * n}

    def frame(rows):
        return pd.DataFrame(lists(rows))

    got, want = (sorted(tuple(map(str, r)) for r in R.score_blocks(blocks, f, size=30).collect()) for f in (lists, frame))
    assert got == want and len(got) == 140
    assert [f["a"].tolist() for f in M.gathered([{"a": [1, None]}, {"a": []}, pd.DataFrame({"a": [2]})])] == [[1, None, 2]]
