"""Steps outside Spark (fetching, probing, downloading, speech synthesis, language and voice models) as interfaces with retries.

A step is a factory that each worker calls once; what it returns is called per row. Its failures are results: every try leaves
attempt-<k>:<reason>, and a row that never succeeds has its last status. Nothing here opens a connection itself.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOME = "status string, body string, content binary, number double, attempts int, errors array<string>"
#: Answers that another try may mend.
RETRIED = ("throttled", "failed")


class Failed(Exception):
    """Raised by a step: status throttled, failed (both tried again), skipped or needs-login (final)."""

    def __init__(self, status: str, reason: str):
        super().__init__(reason)
        self.status = status


def back_off(attempt: int, unit: float) -> float:
    """Seconds to wait behind a try that failed: doubling."""
    return unit * 2**attempt


def with_retries(rows: DataFrame, key: str, columns: list[str], step: Callable[[], Callable], tries: int, wait: float = 0.0) -> DataFrame:
    """key and OUTCOME of each row. The step gets (attempt, *values of columns) and gives text, bytes or a number."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        call = step()
        for frame in frames:
            out = []
            for values in frame.itertuples(index=False):
                errors, status, found = [], "failed", None
                for attempt in range(tries):
                    try:
                        found, status = call(attempt, *values[1:]), "ok"
                        break
                    except Failed as e:
                        errors.append(f"attempt-{attempt + 1}:{e}")
                        status = e.status
                        if status not in RETRIED:
                            break
                    except Exception as e:  # the step is foreign code: its failure is a row's result
                        errors.append(f"attempt-{attempt + 1}:{type(e).__name__}: {e}")
                        status = "failed"
                    if wait and attempt + 1 < tries:
                        time.sleep(back_off(attempt, wait))
                body, content, number = (found if isinstance(found, kind) else None for kind in (str, (bytes, bytearray), (int, float)))
                out.append((values[0], status, body, content, None if number is None else float(number), len(errors) + (status == "ok"), errors))
            yield pd.DataFrame(out, columns=[key, "status", "body", "content", "number", "attempts", "errors"])

    return rows.select(key, *columns).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {OUTCOME}")


def fetched(urls: DataFrame, client: Callable[[], Callable[[int, str, str], str]], agents: list[str], tries: int = 4, wait: float = 0.0) -> DataFrame:
    """url, html, status, errors of pages; the client gets the try, the address and an agent name that rotates by address."""
    named = urls.select("url", F.element_at(F.array(*map(F.lit, agents)), (F.pmod(F.xxhash64("url"), F.lit(len(agents))) + 1).cast("int")).alias("agent"))
    return with_retries(named.withColumn("address", F.col("url")), "url", ["address", "agent"], client, tries, wait).select("url", F.col("body").alias("html"), "status", "errors")


def downloaded(urls: DataFrame, client: Callable, tries: int = 3, wait: float = 0.0) -> DataFrame:
    """url, content, status, errors of media."""
    return with_retries(urls.select("url", F.col("url").alias("address")), "url", ["address"], client, tries, wait).select("url", "content", "status", "errors")


def probed(urls: DataFrame, probe: Callable, whole: bool = True) -> DataFrame:
    """url, duration: of a container (whole: cut to seconds as text, blank on failure; else a number, 0.0 on failure)."""
    found = with_retries(urls.select("url", F.col("url").alias("address")), "url", ["address"], probe, 1)
    duration: Column = F.coalesce(F.floor("number").cast("string"), F.lit("")) if whole else F.coalesce("number", F.lit(0.0))
    return found.select("url", duration.alias("duration"))


def generated(requests: DataFrame, model: Callable, tries: int = 10, wait: float = 0.0) -> DataFrame:
    """id, answer (JSON text), status, errors of prompts (id, prompt)."""
    return with_retries(requests, "id", ["prompt"], model, tries, wait).select("id", F.col("body").alias("answer"), "status", "errors")


def synthesized(items: DataFrame, model: Callable, tries: int = 3) -> DataFrame:
    """id, content, attempts, status, errors of speech for (id, text, instruct); a try may draw its voice anew from its number."""
    return with_retries(items, "id", ["text", "instruct"], model, tries).select("id", "content", "attempts", "status", "errors")


def converted(files: DataFrame, command: Callable) -> DataFrame:
    """path, content, status, errors of a voice conversion (path, content, settings map); settings go to the command as values, never through a shell."""
    return with_retries(files, "path", ["content", "settings"], command, 1).select("path", F.col("content"), "status", "errors")
