"""Run independent Spark actions of one step side by side.

A daily step writes several independent outputs (four clean datasets, three
staging tables, three merged tables). Submitting them from separate driver
threads lets the scheduler overlap their stages instead of running small
jobs one after another; the step finishes when all have, and the first
failure is raised after every action has ended.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_all(actions: dict[str, Callable[[], object]], max_workers: int = 4) -> dict[str, object]:
    if len(actions) <= 1 or max_workers <= 1:
        return {name: fn() for name, fn in actions.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(actions))) as pool:
        futures = {name: pool.submit(fn) for name, fn in actions.items()}
        errors = [f.exception() for f in futures.values() if f.exception() is not None]
        if errors:
            raise errors[0]
        return {name: f.result() for name, f in futures.items()}
