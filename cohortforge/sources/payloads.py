"""Feature payloads: ZIP files of pickled tensors, as a data source of Spark and as files to write.

A payload is a nested dictionary, group to feature to tensor or number, pickled with its tensors' bytes beside it in
``<name>/data/<key>``.  Its pickle is read by a closed list of operation codes and globals: dictionaries, lists, text,
numbers and tensors can come of it, anything else is an error, and nothing in it is ever called.

``spark.read.format("payloads")`` lists the files below ``path`` once and deals them to tasks by size.  Filters by
equality (=, IN) on participant_id, session_id and task_name drop files before they are opened, those on feature_group
and feature_name drop tensors before their bytes are read: of a file its directory, its pickle and the wanted tensors are
read, by ranges.
"""

from __future__ import annotations

import io
import pickle
import pickletools
import re
import struct
import zipfile
from collections import OrderedDict
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from cohortforge.sources import filesystems

# Storage names of the format and their numbers.
STORAGES = {"FloatStorage": "<f4", "DoubleStorage": "<f8", "HalfStorage": "<f2", "LongStorage": "<i8", "IntStorage": "<i4", "ShortStorage": "<i2", "CharStorage": "<i1", "ByteStorage": "<u1", "BoolStorage": "?"}
CODES = frozenset("PROTO GLOBAL STACK_GLOBAL EMPTY_DICT DICT EMPTY_LIST LIST EMPTY_TUPLE TUPLE TUPLE1 TUPLE2 TUPLE3 MARK SETITEM SETITEMS APPEND APPENDS BINUNICODE SHORT_BINUNICODE BININT BININT1 BININT2 LONG1 BINFLOAT NONE NEWTRUE NEWFALSE BINPUT LONG_BINPUT BINGET LONG_BINGET MEMOIZE FRAME BINPERSID REDUCE STOP".split())
SCHEMA = "path string, participant_id string, session_id string, task_name string, feature_group string, feature_name string, shape array<int>, numbers array<double>, value double"
ENTITIES = re.compile(r"^sub-([^_]+)_ses-([^_]+)_task-(.+?)_features\.pt$")


class _Tensor:
    """A tensor whose bytes are still in the file."""

    def __init__(self, storage, offset, shape, strides):
        (self.dtype, self.key, self.total), self.offset, self.shape, self.strides = storage, offset, shape, strides

    def numbers(self, raw: bytes) -> np.ndarray:
        flat = np.frombuffer(raw, self.dtype)
        last = self.offset + sum((n - 1) * s for n, s in zip(self.shape, self.strides)) if all(self.shape) else self.offset - 1
        if min((*self.shape, *self.strides, self.offset), default=0) < 0 or last >= len(flat):
            raise pickle.UnpicklingError("a tensor reaches beyond its storage")
        step = flat.itemsize
        return np.lib.stride_tricks.as_strided(flat[self.offset :], self.shape, [s * step for s in self.strides]).copy()


def _rebuilt(storage, offset, shape, strides, *_) -> _Tensor:
    return _Tensor(storage, offset, tuple(shape), tuple(strides))


def _parameter(data, *_) -> _Tensor:
    return data


class _Unpickler(pickle.Unpickler):
    known = {("torch._utils", "_rebuild_tensor_v2"): _rebuilt, ("torch._utils", "_rebuild_parameter"): _parameter, ("collections", "OrderedDict"): OrderedDict, **{("torch", n): d for n, d in STORAGES.items()}}

    def find_class(self, module, name):
        if (module, name) not in self.known:
            raise pickle.UnpicklingError(f"{module}.{name} isn't part of a payload")
        return self.known[module, name]

    def persistent_load(self, pid):
        if not (isinstance(pid, tuple) and len(pid) == 5 and pid[0] == "storage" and pid[1] in STORAGES.values()):
            raise pickle.UnpicklingError("not a storage")
        return pid[1], str(pid[2]), int(pid[4])


def unpickled(data: bytes):
    """What a payload's pickle describes; UnpicklingError for any code or global outside the lists above."""
    for code, _, at in pickletools.genops(data):
        if code.name not in CODES:
            raise pickle.UnpicklingError(f"{code.name} at {at} isn't part of a payload")
    return _Unpickler(io.BytesIO(data)).load()


def entries(handle, wanted=lambda group, name: True):
    """group, name, shape, numbers, value of a payload's features; of tensors that aren't wanted nothing is read."""
    with zipfile.ZipFile(handle) as z:
        inside = next((n for n in z.namelist() if n.endswith("/data.pkl") or n == "data.pkl"), None)
        if inside is None:
            raise ValueError("no payload: data.pkl is missing")
        base = inside[: -len("data.pkl")]
        tree = unpickled(z.read(inside))
        if not isinstance(tree, Mapping):
            raise ValueError("a payload is a dictionary")
        flat = []
        for group, features in tree.items():
            flat += [(str(group), str(name), x) for name, x in features.items()] if isinstance(features, Mapping) else [(str(group), None, features)]
        for group, name, x in flat:
            if not wanted(group, name):
                continue
            if isinstance(x, _Tensor):
                numbers = x.numbers(z.read(f"{base}data/{x.key}"))
                yield group, name, list(x.shape), numbers.ravel().astype(np.float64), None
            elif isinstance(x, (bool, int, float)):
                yield group, name, None, None, float(x)
            elif isinstance(x, (list, tuple)) and all(isinstance(v, (int, float)) for v in x):
                yield group, name, [len(x)], np.array(x, np.float64), None
            else:  # text and what is nested deeper has no numbers
                yield group, name, None, None, None


# --- reading -------------------------------------------------------------------------------------


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, root: str, most_bytes: int):
        self.root, self.most_bytes = root, most_bytes
        self.allowed: dict[str, set] = {}

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else set()
            if name in ("participant_id", "session_id", "task_name", "feature_group", "feature_name") and None not in values:
                self.allowed[name] = self.allowed.get(name, values) & values
            else:
                yield f  # Spark applies it

    def _wanted(self, **given) -> bool:
        return all(name not in self.allowed or value in self.allowed[name] for name, value in given.items())

    def partitions(self):
        from pyarrow import fs as arrow

        fs, root = filesystems.located(self.root)
        prefix = self.root[: len(self.root) - len(root)] if self.root.endswith(root) else ""
        if prefix in ("file:", "file://"):
            prefix = ""
        found = []
        for info in fs.get_file_info(arrow.FileSelector(root, recursive=True)):
            m = ENTITIES.match(info.base_name)
            if info.type == arrow.FileType.File and m and self._wanted(participant_id=m[1], session_id=m[2], task_name=m[3]):
                found.append((prefix + info.path, info.size))
        parts, size = [], 0
        for path, n in sorted(found):
            if not parts or size + n > self.most_bytes:
                parts.append([])
                size = 0
            parts[-1].append(path)
            size += n
        return [_Files(p) for p in parts] or [_Files([])]

    def read(self, partition):
        wanted = lambda group, name: self._wanted(feature_group=group, feature_name=name)
        for path in partition.paths:
            m = ENTITIES.match(path.rsplit("/", 1)[-1])
            fs, own = filesystems.located(path)
            with fs.open_input_file(own) as handle:
                for group, name, shape, numbers, value in entries(handle, wanted):
                    yield path, m[1], m[2], m[3], group, name, shape, None if numbers is None else numbers.tolist(), value


class Payloads(DataSource):
    """Options: path (a folder), partitionBytes (of files in one task; one file at least)."""

    @classmethod
    def name(cls):
        return "payloads"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"], int(self.options.get("partitionBytes", 32 << 20)))


def payloads(spark: SparkSession, root: str, partition_bytes: int = 32 << 20) -> DataFrame:
    """The features of all payload files sub-<p>_ses-<s>_task-<t>_features.pt below a folder, one row each."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Payloads)
    return spark.read.format("payloads").option("partitionBytes", partition_bytes).load(root)


def as_matrix(shape="shape", numbers="numbers"):
    """Rows of numbers (ARRAY<ARRAY<FLOAT>>) of a feature's shape; one dimension is one row, more than two fold into rows."""
    dims = F.col(shape)
    wide = F.element_at(dims, -1)
    high = F.when(F.size(dims) == 1, F.lit(1)).otherwise((F.size(numbers) / F.greatest(wide, F.lit(1))).cast("int"))
    rows = F.transform(F.sequence(F.lit(0), high - 1), lambda i: F.slice(F.col(numbers), i * wide + 1, wide).cast("array<float>"))
    return F.when((high > 0) & (wide > 0), rows)


# --- writing -------------------------------------------------------------------------------------


def _text(s: str) -> bytes:
    b = s.encode()
    return b"X" + struct.pack("<I", len(b)) + b


def _whole(n: int) -> bytes:
    return b"J" + struct.pack("<i", n) if -(1 << 31) <= n < 1 << 31 else b"\x8a\x08" + struct.pack("<q", n)


def _tuple(items: list[bytes]) -> bytes:
    return b"(" + b"".join(items) + b"t"


def packed(features: Mapping[str, Mapping[str, object]], name: str = "features") -> bytes:
    """A payload of groups of features: arrays of numbers become tensors, numbers and text stay."""
    storages = {np.dtype(d): n for n, d in STORAGES.items()}
    tensors: list[np.ndarray] = []

    def value(x) -> bytes:
        if isinstance(x, np.ndarray):
            x = np.ascontiguousarray(x)
            tensors.append(x)
            pid = _tuple([_text("storage"), f"ctorch\n{storages[x.dtype]}\n".encode(), _text(str(len(tensors) - 1)), _text("cpu"), _whole(x.size)]) + b"Q"
            strides = [s // x.itemsize for s in x.strides]
            return b"ctorch._utils\n_rebuild_tensor_v2\n" + _tuple([pid, _whole(0), _tuple(list(map(_whole, x.shape))), _tuple(list(map(_whole, strides))), b"\x89", b"ccollections\nOrderedDict\n)R"]) + b"R"
        if isinstance(x, Mapping):
            return b"}(" + b"".join(_text(str(k)) + value(v) for k, v in x.items()) + b"u"
        if x is None or isinstance(x, bool):
            return b"N" if x is None else b"\x88" if x else b"\x89"
        return _text(x) if isinstance(x, str) else _whole(x) if isinstance(x, int) else b"G" + struct.pack(">d", x)

    data = b"\x80\x02" + value(features) + b"."
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(f"{name}/data.pkl", data)
        z.writestr(f"{name}/byteorder", "little")
        for k, x in enumerate(tensors):
            z.writestr(f"{name}/data/{k}", x.tobytes())
        z.writestr(f"{name}/version", "3\n")
    return out.getvalue()


def payload_files(features: DataFrame, root: str) -> DataFrame:
    """path, n_bytes, sha256, error of one payload for each recording, written below ``root``.

    ``features``: participant_id, session_id, task_name, feature_group, feature_name, shape, numbers, value; a recording's
    features are gathered in one task, a recording being what one file holds.
    """
    ids = ["participant_id", "session_id", "task_name"]
    own = features.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("feature_group", "feature_name", "shape", "numbers", "value"))).alias("f"))

    def run(batches):
        for batch in batches:
            rows = []
            for p, s, t, held in zip(*(c.to_pylist() for c in batch.columns)):
                path = f"{root}/sub-{p}/ses-{s}/audio/sub-{p}_ses-{s}_task-{t}_features.pt"
                tree: dict[str, dict[str, object]] = {}
                for f in held:
                    x = f["value"] if f["numbers"] is None else np.array(f["numbers"], np.float32).reshape(f["shape"])
                    tree.setdefault(f["feature_group"], {})[f["feature_name"]] = x
                try:
                    rows.append((path, *filesystems.written(path, [packed(tree)]), None))
                except (OSError, ValueError) as failure:
                    rows.append((path, None, None, f"{type(failure).__name__}: {failure}"))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.string()))], names=["path", "n_bytes", "sha256", "error"])

    return own.mapInArrow(run, "path string, n_bytes long, sha256 string, error string")
