"""Token datasets in two files: the tokens (.bin) and their index (.idx), as a Spark data source.

Index: magic, version (u64), element code (u8), numbers of sequences and of document bounds (u64), lengths (i32),
byte pointers (i64), document bounds (i64). Each task streams its own pair to the target's file system (a URI as pyarrow
reads it, or a plain path), so a dataset is written as PREFIX_00000.bin/.idx and so on and no bytes pass the driver. The
option ``single`` joins them into PREFIX.bin/.idx at the end, as a dataset for one reader needs it. Readers take either.
"""

from __future__ import annotations

import re
import struct
import uuid
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tarnlake.functions.fixed import ELEMENT_CODES, INDEX_MAGIC, INDEX_VERSION, TWO_BYTE_VOCABULARY

_NAMES = {v: k for k, v in ELEMENT_CODES.items()}


def best_type(vocabulary: int | None) -> str:
    """uint16 if every token id fits, else int32."""
    return "uint16" if vocabulary is not None and vocabulary < TWO_BYTE_VOCABULARY else "int32"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def index_bytes(dtype: str, lengths: np.ndarray, bounds: np.ndarray) -> bytes:
    pointers = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))[:-1]]) * np.dtype(dtype).itemsize if len(lengths) else np.zeros(0)
    head = INDEX_MAGIC + struct.pack("<QBQQ", INDEX_VERSION, ELEMENT_CODES[dtype], len(lengths), len(bounds))
    return head + lengths.astype("<i4").tobytes() + pointers.astype("<i8").tobytes() + bounds.astype("<i8").tobytes()


def write_index(path: str, dtype: str, lengths: np.ndarray, bounds: np.ndarray) -> None:
    system, at = located(path)
    with system.open_output_stream(at) as f:
        f.write(index_bytes(dtype, lengths, bounds))


@dataclass
class Index:
    dtype: str
    lengths: np.ndarray
    pointers: np.ndarray
    bounds: np.ndarray


def read_index(path: str) -> Index:
    system, at = located(path)
    with system.open_input_file(at) as f:
        dtype, n, m = _header(f, path)
        data = f.read_at(12 * n + 8 * m, 34)
    return Index(dtype, np.frombuffer(data, "<i4", n, 0), np.frombuffer(data, "<i8", n, 4 * n), np.frombuffer(data, "<i8", m, 12 * n))


def read_sequence(prefix: str, index: Index, i: int, offset: int = 0, length: int | None = None) -> np.ndarray:
    """Sequence ``i``, or ``length`` tokens of it from ``offset``."""
    d = np.dtype(index.dtype)
    n = int(index.lengths[i]) - offset if length is None else length
    system, at = located(f"{prefix}.bin")
    with system.open_input_file(at) as f:
        return np.frombuffer(f.read_at(n * d.itemsize, int(index.pointers[i]) + offset * d.itemsize), d)


def prefixes(prefix: str) -> list[str]:
    """The prefixes of a dataset's pairs: its own, or those with numbers."""
    system, at = located(f"{prefix}.idx")
    if system.get_file_info(at).type == fs.FileType.File:
        return [prefix]
    folder, name = at[: -len(".idx")].rpartition("/")[::2]
    found = system.get_file_info(fs.FileSelector(folder or ".", allow_not_found=True))
    numbered = sorted(f.base_name[: -len(".idx")] for f in found if re.fullmatch(rf"{re.escape(name)}_\d{{5}}\.idx", f.base_name))
    return [f"{prefix[: len(prefix) - len(name)]}{n}" for n in numbered]


def merge_indexes(parts: list[Index]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and document bounds of datasets one after another; each later one's first bound, 0, is dropped."""
    bounds, n = [np.zeros(1, np.int64)], 0
    for p in parts:
        bounds.append(p.bounds[1:] + n)
        n += len(p.lengths)
    return np.concatenate([p.lengths for p in parts]) if parts else np.zeros(0, np.int32), np.concatenate(bounds)


@dataclass
class _Part(WriterCommitMessage):
    path: str
    n: int


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.prefix, self.dtype, self.single = options["path"], options.get("dtype", "int32"), options.get("single", "false").lower() == "true"

    def write(self, iterator):
        from pyspark import TaskContext

        part = f"{self.prefix}.part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}"
        lengths, bounds, n = [], [0], 0
        limits = np.iinfo(self.dtype)
        system, at = located(part)
        with system.open_output_stream(f"{at}.bin") as f:
            for row in iterator:
                a = np.array(row["ids"] or [], np.int64)
                if len(a) and (a.min() < limits.min or a.max() > limits.max):
                    raise ValueError(f"a token doesn't fit {self.dtype}")
                f.write(a.astype(self.dtype).tobytes())
                own = list(row["lens"]) if "lens" in row and row["lens"] is not None else [len(a)]
                lengths += own
                n += len(own)
                bounds.append(n)
        write_index(f"{part}.idx", self.dtype, np.array(lengths, np.int32), np.array(bounds, np.int64))
        return _Part(part, n)

    def commit(self, messages):
        """Parts in task order get their numbers, or with ``single`` become one pair: files are appended, none is held in memory."""
        parts = sorted(m.path for m in messages if m is not None)
        system, at = located(self.prefix)
        own = lambda p: located(p)[1]
        if not self.single:
            for k, p in enumerate(parts):
                for s in (".bin", ".idx"):
                    system.move(own(p) + s, f"{at}_{k:05d}{s}")
            return
        with system.open_output_stream(f"{at}.bin") as out:
            for p in parts:
                with system.open_input_stream(own(p) + ".bin") as f:
                    while chunk := f.read(1 << 24):
                        out.write(chunk)
        lengths, bounds = merge_indexes([read_index(f"{p}.idx") for p in parts])
        write_index(f"{self.prefix}.idx", self.dtype, lengths, bounds)
        self._clean(parts)

    def abort(self, messages):
        self._clean([m.path for m in messages if m is not None])

    def _clean(self, parts):
        for p in parts:
            system, at = located(p)
            for s in (".bin", ".idx"):
                if system.get_file_info(at + s).type == fs.FileType.File:
                    system.delete_file(at + s)


@dataclass
class _Range(InputPartition):
    prefix: str
    before: int
    first: int
    last: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.prefix, self.rows = options["path"], int(options.get("rowsPerPartition", 65_536))

    def partitions(self):
        """Ranges of documents of one pair each; of an index only the counts are read here."""
        out, before = [], 0
        found = prefixes(self.prefix)
        if not found:
            raise FileNotFoundError(f"no token dataset {self.prefix}")
        for p in found:
            n = document_count(f"{p}.idx")
            out += [_Range(p, before, a, min(a + self.rows, n)) for a in range(0, max(n, 1), self.rows)]
            before += n
        return out

    def read(self, partition):
        dtype, lengths, pointers, bounds = read_index_range(f"{partition.prefix}.idx", partition.first, partition.last)
        d = np.dtype(dtype)
        system, at = located(f"{partition.prefix}.bin")
        with system.open_input_file(at) as f:
            for k in range(len(bounds) - 1):
                a, b = bounds[k] - bounds[0], bounds[k + 1] - bounds[0]
                lens = lengths[a:b]
                data = np.frombuffer(f.read_at(int(lens.sum()) * d.itemsize, int(pointers[a])), d) if b > a else np.zeros(0, d)
                yield (partition.before + partition.first + k, data.astype(int).tolist(), [int(x) for x in lens])


def _header(f, path: str) -> tuple[str, int, int]:
    head = f.read_at(34, 0)
    if head[:9] != INDEX_MAGIC:
        raise ValueError(f"{path} is no token index")
    version, code, n, m = struct.unpack_from("<QBQQ", head, 9)
    if version != INDEX_VERSION or code not in _NAMES:
        raise ValueError(f"{path}: version {version}, element code {code}")
    return _NAMES[code], n, m


def document_count(path: str) -> int:
    system, at = located(path)
    with system.open_input_file(at) as f:
        return _header(f, path)[2] - 1


def read_index_range(path: str, first: int, last: int) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """Element type, lengths, pointers and bounds of the documents from ``first`` to before ``last``; no more of the index is read."""
    system, at = located(path)
    with system.open_input_file(at) as f:
        dtype, n, m = _header(f, path)
        last = min(last, m - 1)
        bounds = np.frombuffer(f.read_at(8 * (last - first + 1), 34 + 12 * n + 8 * first), "<i8")
        a, b = int(bounds[0]), int(bounds[-1])
        return dtype, np.frombuffer(f.read_at(4 * (b - a), 34 + 4 * a), "<i4"), np.frombuffer(f.read_at(8 * (b - a), 34 + 4 * n + 8 * a), "<i8"), bounds


class TokenFiles(DataSource):
    """``spark.dataSource.register(TokenFiles)``; then format("tokens"), path without suffix, option dtype when writing."""

    @classmethod
    def name(cls):
        return "tokens"

    def schema(self):
        return "doc long, ids array<int>, lens array<int>"

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options)
