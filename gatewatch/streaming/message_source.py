"""A bounded queue of message files as a streaming source (`envelope_queue`).

A queue is a folder of JSON-lines files, one message a line. Each trigger plans a
pull of at most `max_messages` messages that no earlier pull holds: byte ranges of
files, written to `log` as `pull-<n>.json` before the offset `{"pull": n}` goes to
Spark. The stream's checkpoint says which pulls have landed; a crash between landing
and commit replays the same pull from its log, however the folder has changed. Files
are taken in order of their times, then names; one with an older time is not missed;
a file must be complete when it appears (as Spark writes it). Every line comes with
its place in the order of delivery: pull, range of the pull, byte.

Options: `path`, `log`, `max_messages` (50,000), `split_messages` (5,000, messages of
one task), `acknowledge` (`keep`, or `delete`: files go when all their messages have
landed). Paths are local or URIs that Arrow's file systems read. With
`trigger(availableNow=True)` a run is one pull.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "line string, pull long, part int, at long"
BLOCK = 4 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    """Some messages of one file, by bytes."""

    pull: int
    part: int
    file: str
    start: int
    end: int


class QueueReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path, self.log = options["path"], options["log"]
        self.max_messages = int(options.get("max_messages", 50_000))
        self.split = int(options.get("split_messages", 5_000))
        self.delete = options.get("acknowledge", "keep") == "delete"
        if self.max_messages <= 0 or self.split <= 0:
            raise ValueError("max_messages and split_messages must be above zero")

    # ---- the log of pulls

    def _pulls(self) -> list[int]:
        fs, root = file_system(self.log)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return sorted(int(f.base_name[5:-5]) for f in found if f.base_name.startswith("pull-") and f.base_name.endswith(".json"))

    def _load(self, n: int) -> dict:
        fs, root = file_system(self.log)
        with fs.open_input_stream(f"{root}/pull-{n:09d}.json") as f:
            return json.loads(f.read())

    def _store(self, n: int, plan: dict) -> None:
        fs, root = file_system(self.log)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/.pull-{n:09d}.tmp") as f:
            f.write(json.dumps(plan).encode())
        fs.move(f"{root}/.pull-{n:09d}.tmp", f"{root}/pull-{n:09d}.json")

    # ---- planning

    def _plan(self, taken: dict[str, int]) -> tuple[list[list], dict[str, int]]:
        """Ranges of the next messages, and up to where every file is then taken."""
        fs, root = file_system(self.path)
        files = sorted((f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
                        if f.type == pafs.FileType.File and not f.base_name.startswith(("_", "."))), key=lambda f: (f.mtime_ns or 0, f.base_name))
        ranges: list[list] = []
        after = {f.base_name: taken[f.base_name] for f in files if f.base_name in taken}  # deleted files are forgotten
        left = self.max_messages
        for f in files:
            at = taken.get(f.base_name, 0)
            if at >= f.size:
                continue
            with fs.open_input_file(f"{root}/{f.base_name}") as stream:
                while left and at < f.size:
                    end, n = self._advance(stream, at, f.size, min(left, self.split))
                    if n:
                        ranges.append([f.base_name, at, end])
                    at, left = end, left - n
            after[f.base_name] = at
            if not left:
                break
        return ranges, after

    @staticmethod
    def _advance(stream: pa.NativeFile, at: int, size: int, most: int) -> tuple[int, int]:
        """The end of up to `most` messages from `at` on, and their number."""
        n, blank = 0, True
        while at < size:
            block = stream.read_at(min(BLOCK, size - at), at)
            place = 0
            while place < len(block):
                stop = block.find(b"\n", place)
                line = block[place : stop if stop >= 0 else len(block)]
                blank = blank and not line.strip()
                if stop < 0:
                    place = len(block)
                    break
                place = stop + 1
                n, blank = n + (not blank), True
                if n == most:
                    return at + place, n
            at += place
        return size, n + (not blank)

    # ---- the source

    def initialOffset(self) -> dict:
        return {"pull": 0}

    def latestOffset(self) -> dict:
        last = max(self._pulls(), default=0)
        ranges, taken = self._plan(self._load(last)["taken"] if last else {})
        if ranges:
            last += 1
            self._store(last, {"ranges": ranges, "taken": taken})
        return {"pull": last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Range(n, k, *r) for n in range(start["pull"] + 1, end["pull"] + 1) for k, r in enumerate(self._load(n)["ranges"])]

    def read(self, partition: Range) -> Iterator[tuple]:
        fs, root = file_system(self.path)
        with fs.open_input_file(f"{root}/{partition.file}") as stream:
            at = partition.start
            rest = b""
            while at < partition.end or rest:
                block = stream.read_at(min(BLOCK, partition.end - at), at) if at < partition.end else b""
                begin, at = at - len(rest), at + len(block)
                lines = (rest + block).split(b"\n")
                rest = lines.pop() if at < partition.end else b""
                for line in lines:
                    if line.strip():
                        yield line.decode("utf-8", "replace").rstrip("\r"), partition.pull, partition.part, begin
                    begin += len(line) + 1

    def commit(self, end: dict) -> None:
        """Plans before the last landed one are no longer needed: its `taken` holds
        what they took."""
        fs, root = file_system(self.log)
        for n in self._pulls():
            if n < end["pull"]:
                fs.delete_file(f"{root}/pull-{n:09d}.json")
        if self.delete and end["pull"]:
            queue, folder = file_system(self.path)
            for name, at in self._load(end["pull"])["taken"].items():
                info = queue.get_file_info(f"{folder}/{name}")
                if info.type == pafs.FileType.File and at >= info.size:
                    queue.delete_file(f"{folder}/{name}")


class EnvelopeQueue(DataSource):
    @classmethod
    def name(cls) -> str:
        return "envelope_queue"

    def schema(self) -> StructType | str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> QueueReader:
        for needed in ("path", "log"):
            if needed not in self.options:
                raise ValueError(f"set the option {needed}")
        return QueueReader(dict(self.options))
