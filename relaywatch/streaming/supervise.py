"""Supervision of several streaming queries by their progress (ST11).

``run_supervised`` keeps every query of a program going by itself: one that fails,
is stopped from outside, or makes no progress for ``stall_seconds`` is started
again from its checkpoint after a growing pause, while the others go on. A
``StreamingQueryListener`` records when each query last finished a micro-batch or
found nothing to do (idle is not stalled). A query that has used up its restarts
ends the program: all are stopped and the failure is raised, so that nothing goes
unseen (F15).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LastSigns(StreamingQueryListener):
    """When each run of a query last gave a sign of life, by its run id."""

    def __init__(self, clock: Callable[[], float] = time.monotonic):
        self.clock, self.at, self.ended = clock, {}, set()

    def _sign(self, run_id) -> None:
        self.at[str(run_id)] = self.clock()

    def onQueryStarted(self, event) -> None:
        self._sign(event.runId)

    def onQueryProgress(self, event) -> None:
        self._sign(event.progress.runId)

    def onQueryIdle(self, event) -> None:
        self._sign(event.runId)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


@dataclass
class Watched:
    """One query: how to start it, and what became of it."""
    start: Callable[[], StreamingQuery]
    query: StreamingQuery | None = None
    restarts: int = 0
    resume_at: float = 0.0
    since: float = 0.0
    done: bool = False
    reasons: list[str] = field(default_factory=list)


def run_supervised(spark: SparkSession, starts: dict[str, Callable[[], StreamingQuery]], *,
                   stall_seconds: float = 300.0, max_restarts: int = 5, pause: float = 1.0,
                   longest_pause: float = 60.0, finite: bool = False, poll: float = 0.2,
                   keep_going: Callable[[], bool] = lambda: True) -> dict[str, Watched]:
    """Start every query and keep it going until ``keep_going`` turns false or, with
    ``finite`` (``availableNow`` triggers), until each has ended by itself. ``spark``
    is the session that the queries run in.

    A finite query that ended without an error has only ended by itself if its last
    run got to the end of its input, which a query stopped from outside did not: a
    finite query is therefore run until a run brings no new micro-batch.
    """
    watched = {name: Watched(s) for name, s in starts.items()}
    signs = LastSigns()
    spark.streams.addListener(signs)

    def again(w: Watched, reason: str) -> None:
        w.reasons.append(reason)
        w.restarts += 1
        if w.restarts > max_restarts:
            raise RuntimeError(f"given up after {max_restarts} restarts: {reason}")
        w.query = None
        w.resume_at = time.monotonic() + min(longest_pause, pause * 2 ** (w.restarts - 1))

    try:
        while keep_going() and not all(w.done for w in watched.values()):
            for name, w in watched.items():
                now = time.monotonic()
                if w.done or (w.query is None and now < w.resume_at):
                    continue
                if w.query is None:
                    w.query, w.since = w.start(), now
                elif w.query.isActive:
                    last = max(w.since, signs.at.get(str(w.query.runId), 0.0))
                    if now - last > stall_seconds:
                        w.query.stop()
                        again(w, f"{name} made no progress for {stall_seconds:g} s")
                elif w.query.exception() is not None:
                    again(w, f"{name} failed: {w.query.exception()}")
                elif finite:
                    if any(p["numInputRows"] for p in w.query.recentProgress):
                        w.query = None  # once more, to see that nothing is left
                    else:
                        w.done = True
                else:
                    again(w, f"{name} was stopped")
            time.sleep(poll)
    finally:
        for w in watched.values():
            if w.query is not None and w.query.isActive:
                w.query.stop()
        spark.streams.removeListener(signs)
    return watched
