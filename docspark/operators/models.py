"""Calling models from Spark tasks: bounded calls in flight, retries, isolation of bad rows, checked answers."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.answers import json_of_answer
from docspark.operators import validate as V
from docspark.sources.scratch import stage

T = TypeVar("T")
R = TypeVar("R")
#: Calls that one task has open at most, tries of a call, and the seconds of the first and the longest wait between them.
IN_FLIGHT, TRIES, FIRST_WAIT, LONGEST_WAIT = 3, 3, 2.0, 10.0
#: Rows of small results that are handed back to Spark together.
GATHERED_ROWS = 2_000


def with_retries(call: Callable[[T], R], tries: int = TRIES, first_wait: float = FIRST_WAIT, longest_wait: float = LONGEST_WAIT) -> Callable[[T], R]:
    """``call``, tried again after waits that double up to ``longest_wait``; the last failure is raised."""

    def run(x: T) -> R:
        for i in range(tries):
            try:
                return call(x)
            except Exception:
                if i == tries - 1:
                    raise
                time.sleep(min(first_wait * 2**i, longest_wait))
        raise ValueError("tries must be at least 1")

    return run


def in_flight(inputs: Iterable[T], call: Callable[[T], R], at_once: int = IN_FLIGHT) -> Iterator[tuple[T, R | None, Exception | None]]:
    """Results of ``call`` in the order of the inputs, with at most ``at_once`` calls open.

    No more than ``at_once`` inputs are taken ahead, so memory has a bound. A
    call that raises gives its exception in place of a result.
    """
    with ThreadPoolExecutor(at_once) as pool:
        open_calls: deque = deque()

        def oldest() -> tuple[T, R | None, Exception | None]:
            x, future = open_calls.popleft()
            failed = future.exception()
            return (x, None, failed) if failed else (x, future.result(), None)

        for x in inputs:
            if len(open_calls) == at_once:
                yield oldest()
            open_calls.append((x, pool.submit(call, x)))
        while open_calls:
            yield oldest()


def isolated(model: Callable[[pd.DataFrame], pd.DataFrame], rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame | None, str | None]]:
    """Answers for ``rows``; where the model raises, rows are halved until the bad one is alone, with its error."""
    waiting = [rows]
    while waiting:
        part = waiting.pop()
        if part.empty:
            continue
        try:
            yield part, model(part), None
        except Exception as e:  # the model is foreign code: any failure belongs to its rows
            if len(part) == 1:
                yield part, None, f"{type(e).__name__}: {e}"
            else:
                half = len(part) // 2
                waiting += [part.iloc[half:], part.iloc[:half]]


def gathered(frames: Iterable[pd.DataFrame | Mapping[str, list]], rows: int = GATHERED_ROWS, columns: Sequence[str] | None = None) -> Iterator[pd.DataFrame]:
    """Small frames joined, by all their columns or the given ones, to larger ones of about ``rows`` rows, since each frame handed back to Spark has a cost of its own.

    A frame may also be a mapping from column names to lists of one length. Values are kept as they are, in object
    columns: an integer beside a null stays one.
    """
    held: dict[str, list] = {}
    n = 0
    for f in frames:
        lists = {c: f[c].tolist() if isinstance(f, pd.DataFrame) else f[c] for c in (f if columns is None else columns)}
        sizes = {len(x) for x in lists.values()}
        if len(sizes) > 1:
            raise ValueError(f"columns of different lengths: { {c: len(x) for c, x in lists.items()} }")
        if sizes <= {0}:
            continue
        for c, x in lists.items():
            held.setdefault(c, []).extend(x)
        n += sizes.pop()
        if n >= rows:
            yield pd.DataFrame(held, dtype=object)
            held, n = {}, 0
    if n:
        yield pd.DataFrame(held, dtype=object)


def answers_of(prompts: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> DataFrame:
    """``doc_id, answer, error`` of a model for ``prompts(doc_id, prompt)``, over Arrow batches.

    ``load`` runs once per task; its function returns ``(doc_id, answer)``. A
    prompt on which it raises gives a row with the error and no answer.
    """
    id_type = prompts.schema["doc_id"].dataType.simpleString()

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in frames:
            model = model or load()
            for rows, found, error in isolated(model, pdf):
                if found is None:
                    yield pd.DataFrame({"doc_id": rows["doc_id"], "answer": None, "error": error}, dtype=object)
                else:
                    yield found[["doc_id", "answer"]].assign(error=None)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return gathered(each(frames))

    return prompts.select("doc_id", "prompt").mapInPandas(run, f"doc_id {id_type}, answer string, error string")


def _judged(asked: DataFrame, answers: DataFrame, section: str) -> DataFrame:
    """Each prompt with the record in its answer and the list of what is wrong with it."""
    each = answers.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("answer").alias("answer"), F.min("error").alias("error"))
    found = asked.alias("p").join(each.alias("a"), F.col("p.doc_id").eqNullSafe(F.col("a.doc_id")), "left")
    rows = found.select("p.doc_id", "prompt", F.coalesce("n", F.lit(0)).alias("n"), "error", json_of_answer(F.col("answer")).alias("candidate"), F.lit(section).alias("section"))
    checked = V.check_sections(rows)
    texts = F.transform("errors", lambda e: F.concat(F.array_join(e["loc"], "."), F.lit(": "), e["msg"]))
    problems = (
        F.when(F.col("error").isNotNull(), F.array("error"))
        .when(F.col("n") == 0, F.array(F.lit("no answer")))
        .when(F.col("n") > 1, F.array(F.concat(F.col("n").cast("string"), F.lit(" answers"))))
        .when(F.col("candidate").isNull(), F.array(F.lit("no JSON object")))
        .otherwise(texts)
    )
    return checked.select("doc_id", "prompt", F.col("candidate").alias("record"), problems.alias("problems"))


def correction(prompt: Column, problems: Column, section: str) -> Column:
    """The prompt with a note on what was wrong with the last answer."""
    return F.concat(
        prompt,
        F.lit(f"\n\nThe last answer does not fit the section {section}:\n- "),
        F.array_join(problems, "\n- "),
        F.lit("\nAnswer with the corrected JSON object alone."),
    )


def checked_answers(
    prompts: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], section: str = "report_metadata", corrections: int = 1
) -> DataFrame:
    """Records by a model for ``prompts(doc_id, prompt)``, checked against the rules of a section.

    An answer that does not fit is asked for again with the errors in the prompt,
    at most ``corrections`` times; only failed rows run again. One row per prompt:
    ``doc_id, outcome, tries, record, problems`` with the outcomes ``accepted``,
    ``corrected`` and ``quarantined``, the last with a null record and what was
    wrong in the end; answers to nothing that was asked are ``unasked``. Every
    pass is written once, so a rerun of a lost task never asks twice for
    what is done. ``doc_id`` is unique in ``prompts``.
    """
    todo, found = prompts.select("doc_id", "prompt"), None
    for tries in range(1, corrections + 2):
        answers = stage(answers_of(todo, load), "model-answers")
        judged = stage(_judged(todo, answers, section), "model-judged")
        good = judged.where(F.size("problems") == 0).select(
            "doc_id", F.lit("accepted" if tries == 1 else "corrected").alias("outcome"), F.lit(tries).alias("tries"), "record", "problems"
        )
        known = todo.select("doc_id").distinct().alias("t")
        lost = answers.alias("a").join(known, F.col("a.doc_id").eqNullSafe(F.col("t.doc_id")), "left_anti")
        unasked = lost.select(
            "a.doc_id", F.lit("unasked").alias("outcome"), F.lit(tries).alias("tries"), F.lit(None).cast("string").alias("record"), F.array(F.lit("answer to no prompt")).alias("problems")
        )
        found = good.unionByName(unasked) if found is None else found.unionByName(good).unionByName(unasked)
        failed = judged.where(F.size("problems") > 0)
        todo = failed.select("doc_id", correction(F.col("prompt"), F.col("problems"), section).alias("prompt"))
    rest = failed.select("doc_id", F.lit("quarantined").alias("outcome"), F.lit(corrections + 1).alias("tries"), F.lit(None).cast("string").alias("record"), "problems")
    return found.unionByName(rest)
