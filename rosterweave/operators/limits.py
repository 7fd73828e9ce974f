"""QS12: time limits. Of a whole action by a timer that interrupts its jobs, of a record by an alarm within its task."""

from __future__ import annotations

import contextlib
import signal
import threading
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")


class RecordTimeout(Exception):
    """A record took longer than it may."""


def within(spark: SparkSession, seconds: float, action: Callable[[], T]) -> T:
    """action's result. If it takes longer, its Spark jobs are interrupted and TimeoutError is raised; jobs of other threads go on."""
    context, tag, fired = spark.sparkContext, f"within-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        fired.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    context.addJobTag(tag)
    timer.start()
    try:
        return action()
    except Exception as e:
        if fired.is_set():
            raise TimeoutError(f"interrupted after {seconds:g} seconds") from e
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)


@contextlib.contextmanager
def record_limit(seconds: float | None) -> Iterator[None]:
    """Raises RecordTimeout in what runs inside, when it takes longer. Python code is stopped between two of its steps; a single call into C is stopped when it returns. For the main thread of a task's Python process; elsewhere, and where seconds is None, it does nothing."""
    if seconds is None or threading.current_thread() is not threading.main_thread():
        yield
        return

    def ring(*_) -> None:
        raise RecordTimeout(f"took over {seconds:g} seconds")

    before = signal.signal(signal.SIGALRM, ring)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)
