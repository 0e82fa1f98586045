"""The manifest of a run: which stages of which attempt are done, and what they gave.

A repeat of a run over the same input starts at the first stage that no attempt has finished. A run
that ended well is not done again; one that ended badly, or whose input has changed, starts anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from quayside.sinks.commits import CommitLog


class RunManifest:
    """The attempts of one run, as commits in the run's own folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = CommitLog(spark, path)
        self.attempt = 0
        self.done: dict[str, dict] = {}
        self.resumed = False

    def _commit(self, body: dict) -> None:
        while not self.log.commit(self.log.newest() + 1, {"attempt": self.attempt, **body}):
            pass  # another driver was first: its marks stand beside these

    def begin(self, fingerprint: str) -> bool:
        """Start an attempt; False where the run has ended well over this very input."""
        same, done, ended = False, {}, None
        for body in self.log.bodies():
            self.attempt = max(self.attempt, body["attempt"])
            if "fingerprint" in body:
                anew = body["fingerprint"] != fingerprint or ended is not None
                same, ended = body["fingerprint"] == fingerprint, None
                done = {} if anew else done
            elif "stage" in body and same:
                done[body["stage"]] = body["data"]
            elif "outcome" in body:
                ended = body["outcome"]
        if same and ended == "success":
            self.done, self.resumed = done, True
            return False
        self.done = done if same and ended is None else {}
        self.resumed = bool(self.done)
        self.attempt += 1
        self._commit({"fingerprint": fingerprint})
        return True

    def stage(self, name: str, work: Callable[[], dict]) -> dict:
        """What ``work`` gave when the stage was finished, now or by an earlier attempt."""
        if name not in self.done:
            data = work()
            self._commit({"stage": name, "data": data})
            self.done[name] = data
        return self.done[name]

    def end(self, outcome: str) -> None:
        self._commit({"outcome": outcome})
