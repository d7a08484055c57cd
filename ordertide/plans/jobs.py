"""Run independent Spark actions concurrently from the driver.

Spark schedules jobs submitted from several driver threads side by side on
the same executors, so a job with few tasks (a small table, a tiny
micro-batch) does not leave the cluster idle while the next one waits.  Only
for actions that touch different outputs.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_concurrently(*actions: Callable[[], object]) -> list:
    """Run the callables in parallel threads; results in order, first error raised."""
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]
