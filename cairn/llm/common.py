"""Plumbing shared by the training-data operators.

* ``shared_dir`` / ``durable`` / ``forget``: intermediate tables live in the folder that the cluster names in
  ``spark.checkpoint.dir``, so they outlive any executor, and go as soon as nothing reads them any more.
* ``write_store`` / ``Store``: sorted arrays of 64-bit keys (128 bits with ``low``) with value columns, in files of
  bounded size, memory-mapped by the Python workers.  A store grows with what is put in it; nothing of it passes
  through the driver except one line of metadata a file.
"""

from __future__ import annotations

import atexit
import io
import json
import os
import shutil
import tempfile
import uuid
from collections import OrderedDict
from contextlib import contextmanager
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a store's file; a file ends at the next change of key.
FILE_ROWS = 4_000_000
#: Bytes that a worker holds of arrays that it cannot map.
REMOTE_BYTES = 256 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a folder of our own only where none is set and Spark is one local process."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="cairn-"))
            atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
        base = f"file://{_own_dir[0]}"
    return f"{base.rstrip('/')}/cairn"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def tidy(spark: SparkSession):
    """Spark drops the shuffle files of the actions run within as soon as each is done; the caller's setting comes back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def durable(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and returns the table read back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cairn_path = path
    return out


def forget(spark: SparkSession, *used: DataFrame | str | None) -> None:
    """Deletes tables that ``durable`` made, and folders, that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for x in used:
        path = x if isinstance(x, str) else getattr(x, "cairn_path", None)
        if path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Cuts a batch so that a slice holds at most ``limit`` bytes of ``column``, or one row."""
    col = batch.column(batch.schema.get_field_index(column))
    if batch.num_rows == 0:
        return
    offs = string_offsets(col)
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(offs, offs[row] + limit, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def string_offsets(col: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    return offs[col.offset : col.offset + len(col) + 1].astype(np.int64)


# --- files of the shared folder, as the Python workers see them -------------------------------


def _local(path: str) -> str | None:
    u = urlparse(path)
    return u.path if u.scheme in ("", "file") else None


def _remote(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def put_file(path: str, data: bytes) -> None:
    """Atomic: a task that is run twice leaves one whole file."""
    local = _local(path)
    if local is None:
        f, p = _remote(path)
        f.create_dir(os.path.dirname(p), recursive=True)
        with f.open_output_stream(p) as s:
            s.write(data)
        return
    os.makedirs(os.path.dirname(local), exist_ok=True)
    part = f"{local}.{uuid.uuid4().hex}"
    with open(part, "wb") as s:
        s.write(data)
    os.replace(part, local)


def put_array(path: str, x: np.ndarray) -> None:
    buf = io.BytesIO()
    np.save(buf, x)
    put_file(path, buf.getvalue())


def get_file(path: str) -> bytes:
    local = _local(path)
    if local is not None:
        with open(local, "rb") as s:
            return s.read()
    f, p = _remote(path)
    with f.open_input_stream(p) as s:
        return s.read()


def get_array(path: str) -> np.ndarray:
    """Memory-mapped where the shared folder is mounted, else read into memory."""
    local = _local(path)
    if local is not None:
        return np.load(local, mmap_mode="r").view(np.ndarray)
    return np.load(io.BytesIO(get_file(path)))


# --- sorted arrays -----------------------------------------------------------------------------


def write_store(df: DataFrame, key: str, values: dict[str, str], path: str, shard=None, shards: int | None = None, low: str | None = None) -> tuple[int, int]:
    """Writes ``df`` as sorted arrays; returns the number of rows and the sum of the first value column.

    ``key`` is a long; with ``low``, a long too, the two together tell rows apart, else ``key`` alone does.
    ``values`` maps columns to numpy types.  ``shard`` is an integer expression that never falls as the key grows; by
    default the key's leading bits, which suits hashes.  A task holds ``FILE_ROWS`` rows, not a whole shard.
    """
    spark = df.sparkSession
    if shard is None:
        bits = max(1, (max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1)).bit_length())
        shards = 1 << bits
        shard = F.shiftright(F.col(key), 64 - bits).cast("int") + (1 << (bits - 1))
    kinds = ({low: "int64"} if low else {}) | values
    first = next(iter(values), None)

    def write(batches):
        run, held, size, made = None, [], 0, 0

        def flush():
            nonlocal size, made
            t = pa.Table.from_batches(held)
            held.clear()
            k, name = t.column(key).to_numpy(), f"{run:06d}-{made:04d}"
            size, made = 0, made + 1
            put_array(f"{path}/{name}.key.npy", k)
            for n, kind in kinds.items():
                put_array(f"{path}/{name}.{n}.npy", t.column(n).to_numpy().astype(kind))
            total = int(np.sum(t.column(first).to_numpy())) if first else 0
            row = (name, len(k), int(k[0]), int(k[-1]), total)
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["name", "n", "lo", "hi", "total"])

        for b in batches:
            s = b.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), len(s)]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if run is not None and run != int(s[lo]):
                    yield flush()
                    made = 0
                run = int(s[lo])
                piece = b.slice(lo, hi - lo)
                if size > FILE_ROWS:
                    k = piece.column(1).to_numpy()
                    cut = 0 if held[-1].column(1)[-1].as_py() != k[0] else int(np.searchsorted(k, k[0], "right"))
                    if cut < len(k):  # rows of one key stay in one file
                        if cut:
                            held.append(piece.slice(0, cut))
                        yield flush()
                        piece = piece.slice(cut)
                held.append(piece)
                size += piece.num_rows
        if held:
            yield flush()

    rows = df.select(shard.alias("_shard"), key, *kinds).repartitionById(shards, "_shard")
    out = rows.sortWithinPartitions("_shard", key, *([low] if low else [])).mapInArrow(write, "name string, n long, lo long, hi long, total long")
    with tidy(spark):
        meta = sorted((r.lo, r.hi, r.name, r.n, r.total) for r in out.collect())  # one row a file
    put_store(path, [(name, n, lo, hi) for lo, hi, name, n, _ in meta], kinds, low)
    return sum(m[3] for m in meta), sum(m[4] for m in meta)


def put_store(path: str, files: list[tuple], kinds: dict[str, str], low: str | None = None) -> None:
    """A store's metadata: (name, rows, least key, largest key) of each file, by key."""
    put_file(f"{path}/meta.json", json.dumps({"files": files, "kinds": kinds, "low": low}).encode())


_arrays: OrderedDict[str, np.ndarray] = OrderedDict()
_unmapped = 0


def cached_array(path: str) -> np.ndarray:
    """``get_array``, opened once in a worker; of what is not mapped the last ``REMOTE_BYTES`` are held."""
    global _unmapped
    if path in _arrays:
        _arrays.move_to_end(path)
        return _arrays[path]
    x = get_array(path)
    held = lambda p, y: 0 if _local(p) is not None else y.nbytes
    _arrays[path] = x
    _unmapped += held(path, x)
    while len(_arrays) > 1 and (_unmapped > REMOTE_BYTES or len(_arrays) > 8192):
        _unmapped -= held(*_arrays.popitem(last=False))
    return x


class Store:
    """Reads what ``write_store`` wrote; a file is opened when a key falls into it."""

    _open: OrderedDict[str, Store] = OrderedDict()

    def __init__(self, path: str):
        meta = json.loads(get_file(f"{path}/meta.json"))
        self.path, self.files, self.kinds, self.low = path, meta["files"], meta["kinds"], meta["low"]
        self.lo = np.array([m[2] for m in self.files], dtype=np.int64)
        self.base = np.cumsum([0, *(m[1] for m in self.files)])

    @classmethod
    def open(cls, path: str) -> Store:
        """Kept by path within a worker, the last few."""
        if path not in cls._open:
            while len(cls._open) >= 8:
                cls._open.popitem(last=False)
            cls._open[path] = cls(path)
        return cls._open[path]

    def array(self, i: int, name: str) -> np.ndarray:
        return cached_array(f"{self.path}/{self.files[i][0]}.{name}.npy")

    def find(self, keys: np.ndarray, *names: str, low: np.ndarray | None = None):
        """For each key (in any order): its rank in the store or -1, then its value in each named column (0 if absent)."""
        keys = np.asarray(keys, dtype=np.int64)
        rank = np.full(len(keys), -1, dtype=np.int64)
        outs = [np.zeros(len(keys), dtype=self.kinds[n]) for n in names]
        if not len(keys) or not self.files:
            return (rank, *outs)
        order = np.argsort(keys)
        q = keys[order]
        edges = [*np.searchsorted(q, self.lo, "left").tolist(), len(q)]
        for i in range(len(self.files)):
            a, b = edges[i], edges[i + 1]
            if a == b:
                continue
            k, want = self.array(i, "key"), q[a:b]
            j = np.searchsorted(k, want)
            if low is not None:
                lows, also = self.array(i, self.low), np.asarray(low)[order[a:b]]
                while True:  # keys that repeat stand together
                    at = np.minimum(j, len(k) - 1)
                    on = (j < len(k)) & (k[at] == want) & (lows[at] != also)
                    if not on.any():
                        break
                    j[on] += 1
            j[j == len(k)] = 0
            same = k[j] == want
            if low is not None:
                same &= lows[j] == also
            hit = np.flatnonzero(same)
            at, j = order[a:b][hit], j[hit]
            rank[at] = j + self.base[i]
            for o, n in zip(outs, names):
                o[at] = self.array(i, n)[j]
        return (rank, *outs)

    def find_all(self, keys: np.ndarray, *names: str):
        """For rows that may share a key: (places in ``keys``, their values in each named column), time and again until
        no key has another row."""
        keys, nth = np.asarray(keys, dtype=np.int64), 0
        left = np.arange(len(keys))
        while len(left) and self.files:
            at, outs = [], [[] for _ in names]
            order = left[np.argsort(keys[left])]
            q = keys[order]
            edges = [*np.searchsorted(q, self.lo, "left").tolist(), len(q)]
            for i in range(len(self.files)):
                a, b = edges[i], edges[i + 1]
                if a == b:
                    continue
                k = self.array(i, "key")
                j = np.searchsorted(k, q[a:b]) + nth
                there = np.flatnonzero(j < len(k))
                there = there[k[j[there]] == q[a:b][there]]
                at.append(order[a:b][there])
                for o, n in zip(outs, names):
                    o.append(self.array(i, n)[j[there]])
            left = np.concatenate(at) if at else left[:0]
            yield (left, *(np.concatenate(o) if o else np.zeros(0, np.int64) for o in outs))
            nth += 1


def digests(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each, as two longs: what tells them apart is never 64 bits alone."""
    import xxhash

    x = np.frombuffer(b"".join(xxhash.xxh3_128_digest(p) for p in parts), dtype=">i8").reshape(-1, 2)
    return x[:, 0].astype(np.int64), x[:, 1].astype(np.int64)


# --- documents in, documents out ----------------------------------------------------------------


def small_batches(spark: SparkSession) -> None:
    """Batches of at most 4 MB between the JVM and its workers, unless the session asks for a size of its own: whole
    texts differ in length by orders of magnitude, and the default, by rows, lets a batch take tens of MB on both sides."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == _batch_default.setdefault(key, spark.conf.get(key)):
        spark.conf.set(key, str(4 << 20))


_batch_default: dict[str, str] = {}


def framed(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """_id long, _text string and, with ``carry``, _row: the rest of the input row, in a struct so that no name can clash."""
    small_batches(docs.sparkSession)
    cols = [F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")]
    return docs.select(*cols, *([F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("_row")] if carry else []))


def out_schema(frame: DataFrame, fields: str, text_col: str = "text"):
    """The output's schema: ``fields`` and, if the frame carries rows, row: the input's other columns, then the text."""
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(fields)
    if "_row" in frame.columns:
        schema = schema.add("row", T.StructType([*frame.schema["_row"].dataType.fields, T.StructField(text_col, frame.schema[1].dataType)]), False)
    return schema


def with_row(part: pa.RecordBatch, arrays: dict, text_col: str = "text") -> pa.RecordBatch:
    if "_row" in part.schema.names:
        rest = part.column("_row")
        names = [rest.type.field(i).name for i in range(rest.type.num_fields)]
        arrays = arrays | {"row": pa.StructArray.from_arrays([*rest.flatten(), part.column(1)], [*names, text_col])}
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def by_range(df: DataFrame, key: str, *then) -> DataFrame:
    """Range partitions of a uniform 64-bit hash by its leading bits (no sampling pass), sorted by it and ``then``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.floor((F.shiftright(F.col(key), 32) + F.lit(1 << 31)) * n / F.lit(1 << 32)).cast("int")
    return df.repartitionById(n, part).sortWithinPartitions(key, *then)
