"""Independent jobs side by side: a bounded pool, isolation, cancellation, and the time each took.

Every job is submitted from a thread of its own, under its own job group and in one scheduler pool
(fair where the session's scheduler is), so a wide job does not hold up narrow ones. A job that fails
or outlives its limit is a result with an error; its group is cancelled and the others go on.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

POOL = "tidemark"
WORKERS = 4


@dataclass(frozen=True)
class JobResult:
    """``value`` is what the job returned; ``error`` is set if it failed or was stopped."""

    name: str
    value: Any
    error: str | None
    seconds: float
    failure: Exception | None = None


def run_jobs(
    spark: SparkSession, jobs: Mapping[str, Callable[[], Any]], workers: int = WORKERS, limit_s: float | None = None, pool: str = POOL
) -> list[JobResult]:
    """Run the jobs, at most ``workers`` at a time; results in the order of ``jobs``.

    ``limit_s`` bounds the time of one job from its start, not its time in the queue; it holds for
    the outermost jobs.
    """
    context = spark.sparkContext
    # jobs submitted from inside another job share its group, so that stopping it stops them too
    outer = context.getLocalProperty("spark.jobGroup.id")
    nested = bool(outer and outer.startswith(f"{pool}-"))
    groups = {name: outer if nested else f"{pool}-{uuid.uuid4().hex}" for name in jobs}
    started: dict[str, float] = {}
    stopped: set[str] = set()

    def run(name: str) -> JobResult:
        context.setLocalProperty("spark.scheduler.pool", pool)
        context.setJobGroup(groups[name], name, interruptOnCancel=True)
        began = started[name] = time.monotonic()
        value = error = cause = None
        try:
            value = jobs[name]()
        except Exception as failure:  # the failure of a job is its result
            error, cause = str(failure) or type(failure).__name__, failure
        if name in stopped:
            value, error = None, f"stopped after {limit_s:g} seconds"
        return JobResult(name, value, error, time.monotonic() - began, cause)

    with ThreadPoolExecutor(max_workers=max(1, workers), thread_name_prefix=pool) as threads:
        waiting = {threads.submit(run, name): name for name in jobs}
        done: dict[str, JobResult] = {}
        while waiting:
            ended, _ = wait(waiting, timeout=0.2 if limit_s else None, return_when=FIRST_COMPLETED)
            for future in ended:
                done[waiting.pop(future)] = future.result()
            for name in waiting.values() if limit_s and not nested else ():
                if name in started and name not in stopped and time.monotonic() - started[name] > limit_s:
                    stopped.add(name)
                    # also what the job would submit later
                    context._jsc.sc().cancelJobGroupAndFutureJobs(groups[name])
    return [done[name] for name in jobs]
