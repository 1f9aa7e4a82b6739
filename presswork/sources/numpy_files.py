"""Vectors in NumPy's file formats as a Spark data source.

Read: a ``.npy`` matrix (a row a vector, the key its number), a ``.npz`` archive with the members ``keys``
and ``vectors``, or a folder written here. A file is cut into ranges of rows that tasks seek to and read
on their own; only a compressed member is read by one task, from its start. Written: a folder of
uncompressed ``.npz`` archives of bounded size, which NumPy opens as they are. A task writes under names
of its own; the list of files that Spark committed says what is read, so repeated tasks leave no rows.
"""

from __future__ import annotations

import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "key BIGINT, vector ARRAY<DOUBLE>"
RANGE_BYTES = 64 << 20  # of vectors that a task reads
FILE_BYTES = 64 << 20  # of vectors in a written archive
BATCH = 4096
LISTED = "_files.json"


def _open(path: str):
    """File system and place of a path or URI."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Matrix:
    """Where an array lies in a file: bytes from ``offset`` on, or the member of a compressed archive."""

    path: str
    offset: int
    kind: str
    rows: int
    width: int
    member: str = ""

    @classmethod
    def found(cls, path: str, source, start: int, member: str = "") -> Matrix:
        """Read the array's header at the source's place."""
        version = np.lib.format.read_magic(source)
        header = {(1, 0): np.lib.format.read_array_header_1_0, (2, 0): np.lib.format.read_array_header_2_0}.get(version)
        if header is None:
            raise ValueError(f"{path}: format {version} is not known")
        shape, fortran, kind = header(source)
        if len(shape) not in (1, 2) or kind.hasobject or (fortran and len(shape) == 2 and min(shape) > 1):
            raise ValueError(f"{path}: only numeric arrays of one or two dimensions, rows first, can be read")
        return cls(path, start + source.tell(), kind.str, shape[0], shape[1] if len(shape) == 2 else 1, member)

    @property
    def row_bytes(self) -> int:
        return np.dtype(self.kind).itemsize * self.width

    def read(self, start: int, stop: int) -> np.ndarray:
        fs, place = _open(self.path)
        with fs.open_input_file(place) as source:
            if self.member:
                with zipfile.ZipFile(source).open(self.member) as inner:
                    inner.read(self.offset + start * self.row_bytes)
                    raw = inner.read((stop - start) * self.row_bytes)
            else:
                source.seek(self.offset + start * self.row_bytes)
                raw = source.read((stop - start) * self.row_bytes)
        return np.frombuffer(raw, self.kind).reshape(stop - start, self.width)


def _members(path: str) -> tuple[Matrix, Matrix | None]:
    """Vectors and, if there are any, keys of a file."""
    fs, place = _open(path)
    with fs.open_input_file(place) as source:
        if not path.endswith(".npz"):
            return Matrix.found(path, source, 0), None
        archive, made = zipfile.ZipFile(source), {}
        for info in archive.infolist():
            if info.compress_type == zipfile.ZIP_STORED:
                source.seek(info.header_offset + 26)
                name, extra = np.frombuffer(source.read(4), "<u2").tolist()
                source.seek(info.header_offset + 30 + name + extra)
                made[info.filename] = Matrix.found(path, source, 0)
            else:
                with archive.open(info.filename) as inner:
                    made[info.filename] = Matrix.found(path, inner, 0, info.filename)
    if "vectors.npy" not in made:
        raise ValueError(f"{path} has no member 'vectors'")
    return made["vectors.npy"], made.get("keys.npy")


@dataclass
class Range(InputPartition):
    vectors: Matrix
    keys: Matrix | None
    start: int
    stop: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def partitions(self) -> list[Range]:
        fs, place = _open(self.path)
        if fs.get_file_info(place).type == pafs.FileType.Directory:
            with fs.open_input_file(f"{place}/{LISTED}") as listed:
                files = [tuple(m and Matrix(f"{self.path}/{f['name']}", **m) for m in (f["vectors"], f["keys"])) for f in json.loads(listed.read())]
        else:
            files = [_members(self.path)]
        made = []
        for vectors, keys in files:
            step = max(1, self.range_bytes // max(1, vectors.row_bytes))
            if vectors.member or (keys and keys.member):
                step = max(1, vectors.rows)
            made += [Range(vectors, keys, i, min(i + step, vectors.rows)) for i in range(0, vectors.rows, step)]
        return made or [Range(Matrix(self.path, 0, "<f8", 0, 1), None, 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part.stop == part.start:
            return
        keys = part.keys.read(part.start, part.stop)[:, 0].astype(np.int64) if part.keys else np.arange(part.start, part.stop)
        vectors, width = part.vectors.read(part.start, part.stop), part.vectors.width
        for i in range(0, len(keys), BATCH):
            some = vectors[i : i + BATCH].astype(np.float64)
            ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * width)
            columns = [pa.array(keys[i : i + BATCH]), pa.ListArray.from_arrays(ends, pa.array(some.reshape(-1)))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "vector"])


@dataclass
class Written(WriterCommitMessage):
    files: list


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, held, size = [], [], 0
        for batch in iterator:
            if not len(batch):
                continue
            keys, vectors = batch.column(0), batch.column(1)
            widths = set(vectors.value_lengths().to_pylist())
            if keys.null_count or len(widths) != 1 or None in widths or vectors.flatten().null_count:
                raise ValueError("keys must not be null, vectors of one length without null entries")
            held.append((keys.to_numpy(), vectors.flatten().to_numpy().reshape(len(batch), -1)))
            size += held[-1][1].nbytes
            if size >= FILE_BYTES:
                files.append(self._file(held))
                held, size = [], 0
        if held:
            files.append(self._file(held))
        return Written(files)

    def _file(self, held: list) -> dict:
        keys, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
        name = f"part-{uuid.uuid4().hex}.npz"
        raw = io.BytesIO()
        np.savez(raw, keys=keys.astype(np.int64), vectors=vectors.astype(np.float64))
        fs, place = _open(f"{self.path}/{name}")
        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(place, compression=None) as out:
            out.write(raw.getbuffer())
        found = {n: {k: v for k, v in asdict(m).items() if k != "path"} for n, m in zip(("vectors", "keys"), _members(f"{self.path}/{name}"), strict=True)}
        return {"name": name, **found}

    def _list(self, files: list) -> None:
        fs, place = _open(f"{self.path}/{LISTED}")
        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(place, compression=None) as out:
            out.write(json.dumps(files).encode())

    def commit(self, messages: list) -> None:
        files = [f for m in messages if m for f in m.files]
        fs, place = _open(self.path)
        older = []
        if fs.get_file_info(f"{place}/{LISTED}").type == pafs.FileType.File:
            with fs.open_input_file(f"{place}/{LISTED}") as listed:
                older = json.loads(listed.read())
        widths = {f["vectors"]["width"] for f in (files if self.overwrite else older + files)}
        if len(widths) > 1:
            self._drop(files)
            raise ValueError(f"vectors have several lengths: {sorted(widths)}")
        self._list(files if self.overwrite else older + files)
        if self.overwrite:
            self._drop(older)

    def abort(self, messages: list) -> None:
        self._drop([f for m in messages if m for f in m.files])

    def _drop(self, files: list) -> None:
        fs, place = _open(self.path)
        for f in files:
            fs.delete_file(f"{place}/{f['name']}")


class NumpyVectors(DataSource):
    """Format ``numpy_vectors``: (key, vector); options ``path`` and, for reading, ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "numpy_vectors"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("range_bytes", RANGE_BYTES)))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def save_numpy(vectors: DataFrame, path: str, key: str, vector: str, overwrite: bool = True) -> None:
    """Write (key, vector) as a folder of ``.npz`` archives, or add to it.

    Null keys, null vectors or entries and vectors of several lengths raise ``ValueError``. Repeated
    rows stay; an empty table gives a folder without archives.
    """
    vectors.sparkSession.dataSource.register(NumpyVectors)
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows.write.format("numpy_vectors").mode("overwrite" if overwrite else "append").option("path", path).save()


def load_numpy(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(key, vector) of a ``.npy`` or ``.npz`` file, or of a folder that ``save_numpy`` wrote."""
    spark.dataSource.register(NumpyVectors)
    return spark.read.format("numpy_vectors").option("path", path).option("range_bytes", range_bytes).load()
