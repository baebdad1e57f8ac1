"""The line formats (S1-S4, K1-K5) as a data source of their own: ``spark.read.format("cohort_lines")``.

After :func:`register` a session reads and writes them like any other format::

    spark.read.format("cohort_lines").option("kind", "measurements").load(path)
    df.write.format("cohort_lines").option("kind", "itemsets").mode("append").save(path)

Options of a read: ``kind`` (``measurements``, ``subjects``, ``itemsets``, ``baskets``), ``header``
(first field of header lines), ``mode`` for lines that do not parse and ``splitBytes``. Modes are
``failfast`` (the default: the query fails and names the line), ``dropmalformed``, and
``permissive``, which keeps the line in a further column ``bad_line``, the others null. A schema
given by the user may leave out or reorder columns, not change their types. Values mean what they
mean in :mod:`cohortmine.sources.text_io`: whole numbers with an optional sign, doubles as decimal
numbers with an optional exponent, ``NaN`` or ``Infinity`` in any case; white space around them is
not read.

Reading is planned in byte ranges of ``splitBytes`` (by default a 256th of the input, 4 MB at least and
128 MB at most): a line belongs to the range its first byte
lies in, so every task reads its own range and the end of its last line. A task holds one block
of ``BLOCK`` bytes, or its longest line. Compressed files are one range each. Lines end at
``\\n``, ``\\r`` or ``\\r\\n``; ranges and blocks are cut at ``\\n`` only. Bytes that are not UTF-8
become U+FFFD. Files named ``_*`` or ``.*`` are not read; a path without files is an error.

Writing takes the same kinds and ``label_counts``, ``report`` and ``rules``, in the modes
``append`` and ``overwrite``. A task writes one file below ``_temporary`` under a name of its own
attempt; the commit moves the files that the successful attempts named, then drops what an
overwrite replaces, then writes ``_SUCCESS``. What lost attempts wrote goes with the temporary
folder, so retried tasks leave no lines twice. (A task that outlives an abort may leave its file below
``_temporary`` on stores without folders; nothing reads it.)
"""

from __future__ import annotations

import fnmatch
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from cohortmine.schemas import ITEMSET, MEASUREMENT
from cohortmine.sources.text_io import MEASUREMENT_HEADER, SUBJECT_HEADER

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "cohort_lines"
SPLIT_BYTES = 4 << 20, 128 << 20  # least and most by default; between them the input is cut in SPLITS
SPLITS = 256
BLOCK = 4 << 20
BAD_LINE = "bad_line"
SCHEMAS = {
    "measurements": MEASUREMENT,
    "subjects": T.StructType([T.StructField(c, T.StringType()) for c in ("subject_id", "labels", "last")]),
    "itemsets": ITEMSET,
    "baskets": T.StructType([T.StructField("items", T.ArrayType(T.StringType()))]),
}
HEADERS = {"measurements": MEASUREMENT_HEADER, "subjects": SUBJECT_HEADER}
WRITTEN = {  # columns each kind of line is made of
    "measurements": ["subject_id", "feature_id", "value"], "subjects": ["subject_id", "labels", "last"],
    "itemsets": ["items", "cnt"], "baskets": ["items"], "label_counts": ["label", "cnt"],
    "report": ["support", "items"], "rules": ["antecedent", "consequent", "confidence"],
}
_EDGE = r"^[\x00-\x20]+|[\x00-\x20]+$"
_WHOLE = r"^[+-]?0*[0-9]{1,10}$"
_DOUBLE = r"^(?i:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|nan|[+-]?inf(?:inity)?)$"


# ---- lines to columns ---------------------------------------------------------------

def _whole(text: pa.Array, low: int, high: int) -> pa.Array:
    """Whole numbers within the bounds (of at most ten digits); null for any other text."""
    text = pc.replace_substring_regex(text, _EDGE, "")
    text = pc.if_else(pc.match_substring_regex(text, _WHOLE), text, None)
    numbers = pc.cast(pc.replace_substring_regex(text, r"^\+", ""), pa.int64())
    inside = pc.and_(pc.greater_equal(numbers, low), pc.less_equal(numbers, high))
    return pc.if_else(inside, numbers, None)


def _double(text: pa.Array) -> pa.Array:
    text = pc.replace_substring_regex(text, _EDGE, "")
    text = pc.if_else(pc.match_substring_regex(text, _DOUBLE), text, None)
    return pc.cast(pc.replace_substring_regex(text, r"^\+", ""), pa.float64())


def _fields(lines: pa.Array, pattern: str) -> list[pa.Array]:
    found = pc.extract_regex(lines, pattern)
    return [pc.struct_field(found, [i]) for i in range(found.type.num_fields)]


def _measurements(lines: pa.Array) -> tuple[dict[str, pa.Array], pa.Array]:
    subject, feature, value = _fields(lines, r"^(?P<s>[^,]*),(?P<f>[^,]*),(?P<v>[^,]*)")
    feature, value = _whole(feature, -2**31, 2**31 - 1).cast(pa.int32()), _double(value)
    return ({"subject_id": subject, "feature_id": feature, "value": value},
            pc.and_(pc.is_valid(feature), pc.is_valid(value)))


def _subjects(lines: pa.Array) -> tuple[dict[str, pa.Array], pa.Array]:
    subject, = _fields(lines, r"^(?P<s>[^,]*)")
    labels, last = _fields(lines, r"^(?:(?s:.*),)?(?P<l>[^,]*),(?P<e>[^,]*)$")
    return {"subject_id": subject, "labels": labels, "last": last}, pc.is_valid(last)


def _itemset(line: str) -> tuple[list[int], int] | None:
    count, _, rest = line.partition(",")
    items = [x for x in rest.split(",")[0].split(";") if x]
    if not _ or not re.fullmatch(r"[+-]?[0-9]+", count) or not all(re.fullmatch(r"[+-]?[0-9]+", x) for x in items):
        return None
    found = sorted(map(int, items))
    if any(not -2**31 <= x < 2**31 for x in found) or not -2**63 <= int(count) < 2**63:
        return None
    return found, int(count)


def _itemsets(lines: pa.Array) -> tuple[dict[str, pa.Array], pa.Array]:
    got = [_itemset(x) for x in lines.to_pylist()]
    items = pa.array([g and g[0] for g in got], pa.list_(pa.int32()))
    return ({"items": items, "k": pc.list_value_length(items), "cnt": pa.array([g and g[1] for g in got], pa.int64())},
            pa.array([g is not None for g in got], pa.bool_()))


def _baskets(lines: pa.Array) -> tuple[dict[str, pa.Array], pa.Array]:
    items = [list(dict.fromkeys(t for t in x.split(" ") if t)) for x in lines.to_pylist()]
    return {"items": pa.array(items, pa.list_(pa.string()))}, pa.array([True] * len(items), pa.bool_())


_PARSE = {"measurements": _measurements, "subjects": _subjects, "itemsets": _itemsets, "baskets": _baskets}


def _content(kind: str, lines: pa.Array, header: str | None) -> pa.Array:
    """The lines that hold a row: no header, and for itemsets no blank line."""
    if kind == "itemsets":
        lines = pc.replace_substring_regex(lines, r"[ \t\n\x0b\f\r()]+", "")
        return lines.filter(pc.not_equal(lines, ""))
    if header is not None:
        first, = _fields(lines, r"^(?P<s>[^,]*)")
        return lines.filter(pc.not_equal(first, header))
    return lines


# ---- reading ------------------------------------------------------------------------

def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _files(path: str) -> list[tuple[str, fs.FileInfo]]:
    """(scheme and host to put before the path, file) for a file, a folder or a glob."""
    system, inner = _file_system(path)
    before = path[:len(path) - len(inner)] if path.endswith(inner) else ""
    wild = re.search(r"[*?\[]", inner)
    if not wild:
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [(before, info)]
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
    root = inner[:inner.rindex("/", 0, wild.start())] if wild else inner
    pattern = inner if wild else inner.rstrip("/") + "/*"
    depth = pattern.count("/")
    out = []
    for info in system.get_file_info(fs.FileSelector(root, recursive=wild is not None)):
        same = info.path.count("/") == depth and fnmatch.fnmatchcase(info.path, pattern)
        if info.type == fs.FileType.File and same and info.base_name[0] not in "._":
            out.append((before, info))
    return sorted(out, key=lambda f: f[1].path)


@dataclass
class LineRange(InputPartition):
    """Bytes ``start`` to ``end`` of a file; ``end`` None is the whole of a compressed file."""

    path: str
    start: int
    end: int | None


def _blocks(part: LineRange, block: int) -> Iterator[bytes]:
    """Whole lines whose first byte lies in the range, some MB at a time."""
    system, inner = _file_system(part.path)
    if part.end is None:
        source = system.open_input_stream(inner)  # told from the file's name how it is compressed
    else:
        source = system.open_input_file(inner)
        source.seek(max(part.start - 1, 0))
    with source:
        at = max(part.start - 1, 0)  # offset of rest[0]
        rest, started = b"", part.start == 0
        while part.end is None or at < part.end:
            got = source.read(block)
            rest += got
            if not started:  # the line that reaches into the range is another's
                cut = rest.find(b"\n") + 1
                if not cut and got:
                    at, rest = at + len(rest), b""
                    continue
                at, rest, started = at + cut, rest[cut:] if cut else b"", True
                if part.end is not None and at >= part.end:
                    return
            if part.end is not None and at + len(rest) >= part.end:
                last = rest.find(b"\n", part.end - at - 1) + 1  # end of the last line begun in the range
                if last or not got:
                    if rest:
                        yield rest[:last] if last else rest
                    return
            cut = rest.rfind(b"\n") + 1 if got else len(rest)
            if cut:
                yield rest[:cut]
                at, rest = at + cut, rest[cut:]
            if not got:
                return


class LineReader(DataSourceReader):
    def __init__(self, options: dict, kind: str, schema: T.StructType):
        self.paths = [p for p in str(options.get("path", "")).split(",") if p]
        if not self.paths:
            raise ValueError(f"{NAME}: no path to load")
        self.kind, self.schema = kind, to_arrow_schema(schema)
        self.header = options.get("header", HEADERS.get(kind))
        self.mode = _mode(options)
        self.split = int(options["splitBytes"]) if "splitBytes" in options else None
        self.block = int(options.get("blockBytes", BLOCK))
        if (self.split is not None and self.split < 1) or self.block < 1:
            raise ValueError(f"{NAME}: splitBytes and blockBytes must be positive")

    def partitions(self) -> list[InputPartition]:
        files, out = [f for path in self.paths for f in _files(path)], []
        split = self.split or min(max(sum(info.size for _, info in files) // SPLITS, SPLIT_BYTES[0]), SPLIT_BYTES[1])
        for before, info in files:
            name = before + info.path
            if re.search(r"\.(gz|bz2|zst|lz4)$", name):
                out.append(LineRange(name, 0, None))
            else:
                out += [LineRange(name, lo, min(lo + split, info.size)) for lo in range(0, info.size, split)]
        return out or [LineRange("", 0, 0)]

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        for block in _blocks(partition, self.block) if partition.path else ():
            text = block.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")
            lines = text.split("\n")
            if not lines[-1]:
                lines.pop()
            content = _content(self.kind, pa.array(lines, pa.string()), self.header)
            columns, good = _PARSE[self.kind](content)
            if not pc.all(good, min_count=0).as_py():
                if self.mode == "failfast":
                    first = content.filter(pc.invert(good))[0].as_py()
                    raise ValueError(f"bad {self.kind} line: {first[:1000]}")
                if self.mode == "dropmalformed":
                    columns = {name: c.filter(good) for name, c in columns.items()}
                else:
                    columns = {name: pc.if_else(good, c, pa.scalar(None, c.type)) for name, c in columns.items()}
            columns[BAD_LINE] = (pc.if_else(good, pa.scalar(None, pa.string()), content) if self.mode == "permissive"
                                 else pa.nulls(len(next(iter(columns.values()))), pa.string()))
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in self.schema], schema=self.schema)


# ---- writing ------------------------------------------------------------------------

def _number(x: float | int | None) -> str:
    """A number as Spark prints it."""
    if not isinstance(x, float):
        return "" if x is None else str(x)
    if x != x or x in (float("inf"), float("-inf")):
        return "NaN" if x != x else "Infinity" if x > 0 else "-Infinity"
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x)
    sign, digits, power = Decimal(repr(x)).as_tuple()
    figures = "".join(map(str, digits))
    return f"{'-' * sign}{figures[0]}.{figures[1:].rstrip('0') or '0'}E{len(figures) + power - 1}"


def _semicolons(items: list) -> str:
    return "".join(f"{i};" for i in items)


def _line(kind: str, row: tuple) -> str:
    if kind == "itemsets":
        return f"({row[1]},{_semicolons(row[0])})"
    if kind == "baskets":
        return " ".join(row[0])
    if kind == "label_counts":
        return f"({row[0]},{row[1]})"
    if kind == "report":
        return "\t".join([_number(row[0]), *map(str, row[1])])
    return "\t".join([_semicolons(row[0]), _semicolons(row[1]), _number(row[2])])


def _field(column: pa.Array) -> list[str]:
    """A column as the fields of comma lines; null is empty."""
    if pa.types.is_floating(column.type):
        size = pc.abs(column)
        usual = pc.and_(pc.greater_equal(size, 1e-3), pc.less(size, 1e7))
        if column.null_count == 0 and pc.all(usual, min_count=0).as_py():
            return list(map(repr, column.cast(pa.float64()).to_numpy(zero_copy_only=False).tolist()))
        return list(map(_number, column.cast(pa.float64()).to_pylist()))
    return pc.fill_null(pc.cast(column, pa.string()), "").to_numpy(zero_copy_only=False).tolist()


def _formatted(kind: str, columns: list[pa.Array]) -> list[str]:
    if kind in HEADERS:
        return list(map(",".join, zip(*map(_field, columns), strict=True)))
    return [_line(kind, row) for row in zip(*[c.to_pylist() for c in columns], strict=True)]


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str


class LineWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, kind: str, schema: T.StructType, overwrite: bool):
        self.path, self.kind, self.overwrite = options["path"].rstrip("/"), kind, overwrite
        self.header = options.get("header") if kind in HEADERS else None
        missing = [c for c in WRITTEN[kind] if c not in schema.names]
        if missing:
            raise ValueError(f"{NAME}: {kind} lines need the columns {missing}")
        self.job = uuid.uuid4().hex
        system, _, folder = self._folders()
        system.create_dir(folder, recursive=True)  # here, so that a task outliving an abort finds no folder

    def _folders(self) -> tuple[fs.FileSystem, str, str]:
        system, inner = _file_system(self.path)
        return system, inner, f"{inner}/_temporary-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        system, _, folder = self._folders()
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{self.job}-{context.taskAttemptId()}.txt"
        with system.open_output_stream(f"{folder}/{name}") as out:
            if self.header is not None:
                out.write((self.header + "\n").encode())
            for batch in iterator:
                lines = _formatted(self.kind, [batch.column(c) for c in WRITTEN[self.kind]])
                text = "".join(x + "\n" for x in lines)
                if text.count("\n") != len(lines) or "\r" in text:
                    raise ValueError(f"{NAME}: a value holds a line end")
                out.write(text.encode("utf-8"))
        return WrittenFile(name)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        system, inner, folder = self._folders()
        system.create_dir(inner, recursive=True)
        old = [f for f in system.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File] if self.overwrite else []
        for m in messages:
            if m is not None:
                system.move(f"{folder}/{m.name}", f"{inner}/{m.name}")
        for f in old:
            system.delete_file(f.path)
        with system.open_output_stream(f"{inner}/_SUCCESS"):
            pass
        self._drop(system, folder)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        system, _, folder = self._folders()
        self._drop(system, folder)

    @staticmethod
    def _drop(system: fs.FileSystem, folder: str) -> None:
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


# ---- the format ---------------------------------------------------------------------

def _mode(options: dict) -> str:
    mode = str(options.get("mode", "failfast")).lower()
    if mode not in ("failfast", "dropmalformed", "permissive"):
        raise ValueError(f"{NAME}: unknown mode {mode!r}")
    return mode


class CohortLines(DataSource):
    """``cohort_lines``, see the module."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _kind(self, known: dict) -> str:
        kind = self.options.get("kind", "")
        if kind not in known:
            raise ValueError(f"{NAME}: option kind must be one of {sorted(known)}, not {kind!r}")
        return kind

    def _full(self) -> T.StructType:
        full = T.StructType(list(SCHEMAS[self._kind(SCHEMAS)].fields))
        return full.add(BAD_LINE, T.StringType()) if _mode(self.options) == "permissive" else full

    def schema(self) -> T.StructType:
        return self._full()

    def reader(self, schema: T.StructType) -> LineReader:
        full = {f.name: f.dataType for f in self._full()}
        wrong = [f.name for f in schema if full.get(f.name) != f.dataType]
        if wrong:
            raise ValueError(f"{NAME}: columns {wrong} are not of this kind's schema {self._full().simpleString()}")
        return LineReader(self.options, self._kind(SCHEMAS), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> LineWriter:
        return LineWriter(self.options, self._kind(WRITTEN), schema, overwrite)


def register(spark: SparkSession) -> str:
    """Make the format known to a session; returns its name."""
    spark.dataSource.register(CohortLines)
    return NAME
