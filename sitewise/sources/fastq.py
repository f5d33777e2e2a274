"""Reads files as a data source: plain files in byte ranges, packed ones whole.

A range begins at any byte. Its first record is the first line that starts with @ and has a line that starts with + two lines on: sequences start with neither, so a quality line that
starts with @ is told from a name for certain. A task reads the records whose names begin in its range, the last one beyond the range's end where needed; no line is shuffled.

Files are opened by pyarrow's file systems, local or in the stores that those know. Files whose names begin with _ or . are left out, as elsewhere.
"""

from __future__ import annotations

import fnmatch
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "sitewise_fastq"
SCHEMA = "file string, read_no bigint, name string, seq string, qual string"
SPLIT_BYTES = 64 << 20
#: Ranges below SPLIT_BYTES are made as much longer as it takes for so many of them to hold all bytes, so that a small range doesn't make tasks without end.
MOST_SMALL = 512
#: Bytes read at once, and suffixes of packed files, which are read whole.
_BLOCK = 4 << 20
PACKED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
_LINES = 4


@dataclass
class Pieces(InputPartition):
    """What one task reads: (file, first byte, byte after the last)."""

    pieces: list[tuple[str, int, int]]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it; fails where it is none of pyarrow's."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    head = path.split("*")[0].rsplit("/", 1)[0] if any(c in path for c in "*?[") else path
    system, inside = fs.FileSystem.from_uri(head)
    return system, inside + path[len(head) :]


def files_of(path: str) -> list[tuple[str, int]]:
    """Files of a path (a file, a folder or a pattern) with their sizes, by name."""
    system, inside = opened(path)
    if any(c in inside for c in "*?["):
        base = posixpath.dirname(inside[: min(inside.index(c) for c in "*?[" if c in inside)] + "x")
        found = [f for f in system.get_file_info(fs.FileSelector(base, recursive=True)) if len(f.path.split("/")) == len(inside.split("/")) and fnmatch.fnmatchcase(f.path, inside)]
        folders = [f.path for f in found if f.type == fs.FileType.Directory]
    else:
        found = [system.get_file_info(inside)]
        if found[0].type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        folders = [inside] if found[0].type == fs.FileType.Directory else []
    found += [f for folder in folders for f in system.get_file_info(fs.FileSelector(folder, recursive=True))]
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "_.")


def pieces_of(files: list[tuple[str, int]], split_bytes: int) -> list[list[tuple[str, int, int]]]:
    """Pieces for each task: large plain files are cut, small files share a task."""
    split_bytes = max(split_bytes, min(SPLIT_BYTES, -(-sum(size for _, size in files) // MOST_SMALL)))
    tasks: list[list[tuple[str, int, int]]] = []
    room = 0
    for path, size in files:
        step = size if posixpath.splitext(path)[1] in PACKED else split_bytes
        for start in range(0, size, max(1, step)):
            piece = (path, start, min(size, start + step))
            if piece[2] - start > room or not tasks:
                tasks.append([])
                room = split_bytes
            tasks[-1].append(piece)
            room -= piece[2] - start
    return tasks


def record_start(lines: list[bytes]) -> int | None:
    """Which of the lines is the first name; None where more lines are needed to tell."""
    for i in range(len(lines) - 2):
        if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+":
            return i
    return None


def _first_record(stream, start: int, size: int) -> int:
    """The byte of the first record that begins at start or later; size where there is none."""
    if start == 0:
        return 0
    stream.seek(start - 1)
    held = b""
    while True:
        more = stream.read(1 << 16)
        held += more
        cut = held.find(b"\n")
        if cut >= 0:
            lines = held[cut + 1 :].split(b"\n")
            if more:
                lines = lines[:-1]  # the last one may go on
            i = record_start(lines)
            if i is not None:
                return start + cut + sum(len(x) + 1 for x in lines[:i])
        if not more:
            return size


def _records(path: str, held: bytes, at: int, end: int | None) -> tuple[pa.RecordBatch | None, int, bool]:
    """The records of whole lines in held, which begins at byte at; how many bytes they take; whether the next one begins at end or later."""
    stops = np.flatnonzero(np.frombuffer(held, dtype=np.uint8) == 10)
    n = len(stops) // _LINES
    starts = np.concatenate([[0], stops[: n * _LINES] + 1])
    names = at + starts[: n * _LINES : _LINES]
    if end is not None:
        n = int(np.searchsorted(names, end))
    over = n < len(names) or (end is not None and at + int(starts[n * _LINES]) >= end)
    if not n:
        return None, 0, over
    used = int(starts[n * _LINES])
    offsets = pa.py_buffer(starts[: n * _LINES + 1].astype(np.int32).tobytes())
    lines = pc.ascii_rtrim(pa.StringArray.from_buffers(n * _LINES, offsets, pa.py_buffer(held[:used])), characters="\r\n")
    name, seq, plus, qual = (lines.take(pa.array(np.arange(i, n * _LINES, _LINES))) for i in range(_LINES))
    good = pc.and_(pc.starts_with(name, "@"), pc.starts_with(plus, "+"))
    if not pc.all(good).as_py():
        raise ValueError(f"not a record of a reads file: {path}, byte {int(names[good.index(False).as_py()])}")
    columns = [pa.array([path] * n, pa.string()), pa.array(names[:n], pa.int64()), pc.utf8_slice_codeunits(name, 1), seq, qual]
    return pa.RecordBatch.from_arrays(columns, ["file", "read_no", "name", "seq", "qual"]), used, over


def read_piece(path: str, start: int, end: int, block: int = _BLOCK) -> Iterator[pa.RecordBatch]:
    """The records whose names begin in the range; of packed files all, numbered by their byte in the unpacked text."""
    system, inside = opened(path)
    codec = PACKED.get(posixpath.splitext(path)[1])
    if codec:
        stream, at, last = system.open_input_stream(inside, compression=codec), 0, None
    else:
        stream = system.open_input_file(inside)
        at, last = _first_record(stream, start, end), end
        block = min(block, max(end - start, 1 << 16))  # what lies beyond the range is another task's
        stream.seek(at)
        if at >= end:
            return
    held, over = b"", False
    while not over:
        more = stream.read(block)
        held += more
        if not more and held and not held.endswith(b"\n"):
            held += b"\n"
        batch, used, over = _records(path, held, at, last)
        if batch is not None:
            yield batch
        held, at = held[used:], at + used
        if not more:
            if not over and held.strip(b"\r\n"):
                raise ValueError(f"the last record of a reads file is cut short: {path}, byte {at}")
            return


class ReadsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split_bytes = options["path"], int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        return [Pieces(pieces) for pieces in pieces_of(files_of(self.path), self.split_bytes)] or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        for piece in partition.pieces:
            yield from read_piece(*piece)


class ReadsSource(DataSource):
    """spark.read.format("sitewise_fastq").option("splitBytes", ...).load(path)"""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ReadsReader:
        return ReadsReader({k.lower(): v for k, v in self.options.items()})
