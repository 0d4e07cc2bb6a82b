"""Text generators as a plug-in: batches with bisection on failure, resume, responses matched to requests."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Takes (id, prompt) pairs, gives responses by id; may raise, may leave ids out.
TeacherFn = Callable[[list[tuple[str, str]]], dict[str, str]]


def ask(teacher: TeacherFn, batch: list[tuple[str, str]], attempts: int = 8) -> tuple[dict[str, str], dict[str, str]]:
    """(responses, errors by id). A failing batch is halved; ids left out are asked again; attempts are bounded."""
    done: dict[str, str] = {}
    errors: dict[str, str] = {}
    queue = [(batch, attempts)] if batch else []
    while queue:
        part, left = queue.pop()
        try:
            got = {i: r for i, r in teacher(part).items() if r}
            why = "missing_response"
        except Exception as e:  # noqa: BLE001 - whatever a plug-in raises is data here
            got, why = {}, f"{type(e).__name__}: {e}"
        done.update((i, got[i]) for i, _ in part if i in got)
        missing = [x for x in part if x[0] not in got]
        if not missing:
            continue
        if left <= 1 or len(missing) == 1 and not got and left <= attempts // 2:
            errors.update((i, why) for i, _ in missing)
        elif got or len(missing) == 1:
            queue.append((missing, left - 1))
        else:
            half = len(missing) // 2
            queue += [(missing[half:], left - 1), (missing[:half], left - 1)]
    return done, errors


# HTTP states after which a call is worth another try, of the two kinds of services.
RETRIED = [429, 500, 502, 503, 504]
RETRIED_MORE = [408, 409, *RETRIED]


class StatusError(RuntimeError):
    """What a generator raises for a failed call, with the state it got (None where there was no answer)."""

    def __init__(self, status: int | None, text: str = ""):
        super().__init__(f"http_{status}: {text}" if status else text)
        self.status = status


def with_retries(teacher: TeacherFn, attempts: int = 5, backoff: float = 1.0, retried: list[int] = RETRIED, sleep: Callable[[float], None] = time.sleep) -> TeacherFn:
    """A generator that is asked again after failures that may pass, each time after a longer wait (backoff x attempt)."""

    def asked(batch: list[tuple[str, str]]) -> dict[str, str]:
        for attempt in range(1, attempts + 1):
            try:
                return teacher(batch)
            except StatusError as e:
                if attempt == attempts or e.status is not None and e.status not in retried:
                    raise
            sleep(backoff * attempt)
        raise StatusError(None, "no attempts")

    return asked


def generate(requests: DataFrame, answered: DataFrame | None, make: Callable[[], TeacherFn], size: int = 5, attempts: int = 8) -> DataFrame:
    """id, response, error for requests (id, prompt) whose id has no response yet. The generator is made once per task."""
    todo = requests.select("id", "prompt")
    if answered is not None:
        todo = todo.join(answered.filter("trim(response) <> ''").select("id").distinct(), "id", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teacher = make()
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            done: dict[str, str] = {}
            errors: dict[str, str] = {}
            for k in range(0, len(rows), size):
                d, e = ask(teacher, rows[k : k + size], attempts)
                done |= d
                errors |= e
            ids = [i for i, _ in rows]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array([done.get(i) for i in ids], pa.string()), pa.array([errors.get(i) for i in ids], pa.string())], ["id", "response", "error"])

    return todo.mapInArrow(run, "id string, response string, error string")


def match_responses(batch: DataFrame, responses: DataFrame) -> DataFrame:
    """id, outcome: `succeeded`, `failed` (no or an empty response), `extra` (never asked)."""
    asked = batch.select("id").distinct().withColumn("_asked", F.lit(True))
    given = responses.groupBy("id").agg(F.max(F.coalesce(F.trim("response"), F.lit("")) != "").alias("_given"))
    outcome = F.when(F.col("_asked").isNull(), "extra").when(F.col("_given"), "succeeded").otherwise("failed")
    return asked.join(given, "id", "full_outer").select("id", outcome.alias("outcome"))


def answered_ids(rows: DataFrame) -> DataFrame:
    from millrace.functions import text as T

    return rows.filter((T.norm_ascii(F.col("id")) != "") & (T.norm_ascii(F.col("response")) != "")).select(T.norm_ascii(F.col("id")).alias("id")).distinct()


def first_parsed(passes: list[Column]) -> Column:
    """struct(value, pass): the first of several passes (primary, repair, fallback) that gave a value, and its number."""
    told = F.lit(None)
    for i, p in reversed(list(enumerate(passes))):
        told = F.when(p.isNotNull(), F.struct(p.alias("value"), F.lit(i).alias("pass"))).otherwise(told)
    return told


def first_valid(items: DataFrame, call: str, order: str, reason: str = "reason") -> DataFrame:
    """Of each call's items the first that is `ok`: a pool of candidates gives one."""
    good = items.filter(F.col(reason) == "ok")
    return good.groupBy(call).agg(F.min_by(F.struct(*good.columns), order).alias("r")).select("r.*")
