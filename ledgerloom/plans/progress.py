"""Phases of an operation: named in the log and on the engine's jobs, timed, and told of every half minute."""

from __future__ import annotations

import contextlib
import logging
import threading
import time

from pyspark.sql import SparkSession

LOG = logging.getLogger("ledgerloom")
#: Seconds from one sign of life to the next.
EVERY = 30.0


class Progress:
    def __init__(self, spark: SparkSession, operation: str, every: float = EVERY):
        self.spark, self.operation, self.every = spark, operation, every
        self.phases: list[dict] = []

    def view(self) -> dict:
        """Tasks of the jobs that run now: done, all, and the share of them in percent."""
        tracker = self.spark.sparkContext.statusTracker()
        stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s]
        done, every = sum(s.numCompletedTasks for s in stages), sum(s.numTasks for s in stages)
        return {"tasks_done": done, "tasks": every, "percent": round(100 * done / every, 1) if every else 0.0}

    @contextlib.contextmanager
    def phase(self, name: str):
        """Gives a dict for what the phase has to say of itself (counts, a root); its rate a second is worked out for `records`."""
        say, began, over = {}, time.monotonic(), threading.Event()

        def tick():
            while not over.wait(self.every):
                LOG.info("%s: %s goes on, %.0f s, %s", self.operation, name, time.monotonic() - began, self.view())

        self.spark.sparkContext.setJobDescription(f"{self.operation}: {name}")
        threading.Thread(target=tick, daemon=True).start()
        row = {"phase": name, "ok": False}
        try:
            yield say
            row["ok"] = True
        finally:
            over.set()
            row |= say | {"seconds": round(time.monotonic() - began, 3)}
            if "records" in say and row["seconds"]:
                row["per_second"] = round(say["records"] / row["seconds"], 1)
            self.phases.append(row)
            LOG.info("%s: %s", self.operation, row)
            self.spark.sparkContext.setJobDescription(None)
