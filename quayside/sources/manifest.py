"""The manifest of an extraction: which ranges are landed, so that a run that failed goes on where it stopped.

It lies in a folder beside the landed files that readers pass over. One file holds the plan, one for each commit tells
the ranges it finished, what was reported of them, the files they are in, and ranges that came up meanwhile. A file of
records that no commit names is from a commit that did not end, and goes.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

from quayside.sources.storage import delete_directory, list_files, read_small, write_small

FOLDER = "_manifest"


@dataclass
class Manifest:
    """The state of the extraction into `path`. `key` tells what is extracted; another key is another extraction."""

    spark: SparkSession
    path: str
    key: str
    ranges: list[dict] = field(default_factory=list)
    reports: list[Any] = field(default_factory=list)
    commits: int = 0
    finished: set[int] = field(default_factory=set)
    files: set[str] = field(default_factory=set)

    def _file(self, name: str) -> str:
        return f"{self.path}/{FOLDER}/{name}.json"

    def _read(self, name: str) -> dict | None:
        try:
            return json.loads(read_small(self.spark, self._file(name)) or "null")
        except ValueError:  # cut off while it was written
            return None

    def resume(self) -> bool:
        """Take up an extraction of the same key that has not ended; False where there is none."""
        plan = self._read("plan")
        if not plan or plan["key"] != self.key or self._read("done"):
            return False
        self.ranges = plan["ranges"]
        while commit := self._read(f"commit-{self.commits}"):
            self._add(commit)
        for name in list_files(self.spark, self.path):
            if name not in self.files:
                delete_directory(self.spark, f"{self.path}/{name}")
        return True

    def begin(self, ranges: list[dict]) -> None:
        """Forget what lies in the folder and start with these ranges."""
        delete_directory(self.spark, self.path)
        self.ranges = ranges
        write_small(self.spark, self._file("plan"), json.dumps({"key": self.key, "ranges": ranges}))

    def pending(self) -> list[dict]:
        return [r for r in self.ranges if r["range_id"] not in self.finished]

    def commit(self, finished: list[int], reports: Any, more: list[dict]) -> None:
        """Note that ranges are landed, in whatever files are new since the last commit, and further ranges to read."""
        files = sorted(set(list_files(self.spark, self.path)) - self.files)
        commit = {"finished": finished, "reports": reports, "more": more, "files": files}
        write_small(self.spark, self._file(f"commit-{self.commits}"), json.dumps(commit))
        self._add(commit)

    def end(self) -> None:
        write_small(self.spark, self._file("done"), "{\"done\": true}")

    def _add(self, commit: dict) -> None:
        self.finished.update(commit["finished"])
        self.files.update(commit["files"])
        self.ranges = self.ranges + commit["more"]
        self.reports.append(commit["reports"])
        self.commits += 1
