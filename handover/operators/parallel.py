"""Independent steps at once: while one job has few tasks left, another one's fill the cluster."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

WORKERS = 4


def at_once(*steps: Callable[[], Any]) -> list[Any]:
    """Results of steps that each start Spark jobs, in order; the first error is raised when all have ended."""
    with ThreadPoolExecutor(min(WORKERS, max(len(steps), 1))) as pool:
        started = [pool.submit(step) for step in steps]
    return [s.result() for s in started]
