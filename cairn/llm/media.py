"""Media columns: ISO base media files (MP4 and kin) in a binary column.

``probe`` walks nested boxes and decodes the sample tables (stts, stsc, stsz, stco / co64, stss) into codec,
duration and the byte ranges of key frames, without decoding - or touching - a payload.  ``read_samples``
follows the same tables to a track's stored bytes.  ``mux`` writes a file: one video track of raw 8 x 8
RGB frames (192 bytes a sample) with a sync sample every ``gop`` frames.

Defined cases: null stays null; a file that is cut short, has no movie box, has tables that contradict
each other or claim more than the file can hold, or nests boxes more than ``DEPTH`` deep gives status ``corrupt`` and
null features; nothing is allocated for a claim before it is checked against the file's size, and boxes are walked with
a stack of their own.  Boxes of unknown types are skipped; a movie without samples has no key frames; ids may be null
or repeat; other columns, whatever their names, are ignored, or kept in ``row``.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import framed, out_schema, slices, small_batches, with_row

#: Fixed values of the format: boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf"}
FRAME, CHUNK, GOP, RATE = 192, 32, 16, 25
#: The format needs seven levels (moov, trak, mdia, minf, stbl, stsd, entry).
DEPTH = 32


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def full(kind: bytes, *parts: bytes) -> bytes:
    return box(kind, bytes(4), *parts)


def _u32(*x: int) -> bytes:
    return struct.pack(f">{len(x)}I", *x)


def pad(data: bytes, frame: int = FRAME) -> bytes:
    """Appends bytes 32 up to a positive multiple of the frame size."""
    return data + b" " * (max(1, -(-len(data) // frame)) * frame - len(data))


def mux(payload: bytes, frame: int = FRAME, chunk: int = CHUNK, gop: int = GOP, rate: int = RATE) -> bytes:
    """Stores a payload (a positive multiple of ``frame`` bytes) losslessly as raw frames."""
    n = len(payload) // frame
    head = box(b"ftyp", b"isom", _u32(512), b"isom", b"mp41")
    wide = len(payload) + 8 >= 1 << 32
    data = (struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) if wide else struct.pack(">I4s", len(payload) + 8, b"mdat")) + payload
    first = len(head) + len(data) - len(payload)
    starts = first + np.arange(0, n, chunk, dtype=np.int64) * frame
    chunks = len(starts)
    last = n - (chunks - 1) * chunk
    runs = [(1, min(n, chunk), 1)] + ([(chunks, last, 1)] if chunks > 1 and last != chunk else [])
    matrix = _u32(65536, 0, 0, 0, 65536, 0, 0, 0, 1 << 30)
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HH", 8, 8), _u32(72 << 16, 72 << 16, 0), struct.pack(">H", 1), bytes(32), struct.pack(">Hh", 24, -1))
    keys = np.arange(1, n + 1, gop, dtype=">u4")
    table = box(
        b"stbl",
        full(b"stsd", _u32(1), entry),
        full(b"stts", _u32(1, n, 1)),
        full(b"stss", _u32(len(keys)), keys.tobytes()),
        full(b"stsc", _u32(len(runs)), *(_u32(*r) for r in runs)),
        full(b"stsz", _u32(frame, n)),
        full(b"co64", _u32(chunks), starts.astype(">u8").tobytes()) if starts[-1] >= 1 << 32 else full(b"stco", _u32(chunks), starts.astype(">u4").tobytes()),
    )
    media = box(
        b"mdia",
        full(b"mdhd", _u32(0, 0, rate, n), struct.pack(">HH", 0x55C4, 0)),
        full(b"hdlr", _u32(0), b"vide", bytes(12), b"frames\0"),
        box(b"minf", box(b"vmhd", _u32(1), bytes(8)), box(b"dinf", full(b"dref", _u32(1), box(b"url ", _u32(1)))), table),
    )
    track = box(b"trak", box(b"tkhd", _u32(7, 0, 0, 1, 0, n), bytes(8), bytes(8), matrix, _u32(8 << 16, 8 << 16)), media)
    movie = box(b"moov", full(b"mvhd", _u32(0, 0, rate, n, 65536), struct.pack(">H", 256), bytes(10), matrix, bytes(24), _u32(2)), track)
    return head + data + movie


def walk(data, lo: int = 0, hi: int | None = None):
    """(path, begin, end) of each box's body, parents before their children."""
    open_boxes: list[tuple[tuple, int]] = [((), len(data) if hi is None else hi)]  # (path, end), the innermost last
    while open_boxes:
        path, end = open_boxes[-1]
        if lo >= end:
            open_boxes.pop()
            continue
        if end - lo < 8:
            raise ValueError("a box is cut short")
        size, kind = struct.unpack_from(">I4s", data, lo)
        begin = lo + 8
        if size == 1:
            if end - lo < 16:
                raise ValueError("a box is cut short")
            size, begin = struct.unpack_from(">Q", data, begin)[0], begin + 8
        elif size == 0:
            size = end - lo
        if size < begin - lo or lo + size > end:
            raise ValueError("a box leaves its parent")
        here = (*path, kind)
        yield here, begin, lo + size
        if kind in CONTAINERS:
            if len(here) > DEPTH:
                raise ValueError("boxes nested too deep")
            open_boxes.append((here, lo + size))
            lo = begin
        else:
            lo += size


def _table(data, begin: int, end: int, fields: int, kind: str = ">u4") -> np.ndarray:
    if begin + 8 > end:
        raise ValueError("a table is cut short")
    count = struct.unpack_from(">I", data, begin + 4)[0]
    width = np.dtype(kind).itemsize * fields
    if begin + 8 + count * width > end:
        raise ValueError("a table leaves its box")
    return np.frombuffer(data, dtype=kind, count=count * fields, offset=begin + 8).astype(np.int64).reshape(count, fields)


def _sizes(data, begin: int, end: int, room: int) -> np.ndarray:
    """Sizes of all samples: from the table, or one size for all.  ``room``: bytes that other tracks leave."""
    if begin + 12 > end:
        raise ValueError("a table is cut short")
    fixed, n = struct.unpack_from(">II", data, begin + 4)
    if not fixed:
        sizes = _table(data, begin + 4, end, 1)[:, 0]
        if sizes.sum() > room:
            raise ValueError("more samples than the file holds")
        return sizes
    if fixed * n > room:
        raise ValueError("more samples than the file holds")
    return np.full(n, fixed, dtype=np.int64)


def _samples_of_chunks(runs: np.ndarray, chunks: int) -> np.ndarray:
    """How many samples each chunk has, from the runs (first chunk, samples, description)."""
    first = runs[:, 0]
    if not len(runs) or not chunks:
        return np.zeros(0, np.int64)
    if first[0] != 1 or first[-1] > chunks or (np.diff(first) <= 0).any():
        raise ValueError("runs of chunks that the file does not have")
    return np.repeat(runs[:, 1], np.diff(np.append(first, chunks + 1)))


def tracks(data) -> list[dict]:
    """Each track: handler, codec, timescale, duration, offsets, sizes and keys (0-based) of its samples."""
    found: list[dict] = []
    seen, room = False, len(data)
    for path, a, b in walk(data):
        kind, inside = path[-1], path[:-1]
        seen |= path == (b"moov",)
        if path == (b"moov", b"trak"):
            found.append({})
        if not found or b"trak" not in inside:
            continue
        t = found[-1]
        if kind == b"hdlr":
            t["handler"] = bytes(data[a + 8 : a + 12]).decode("latin-1")
        elif kind == b"mdhd":
            t["timescale"], t["duration"] = struct.unpack_from(">IQ", data, a + 20) if data[a] == 1 else struct.unpack_from(">II", data, a + 12)
        elif kind == b"stsd":
            t["codec"] = bytes(data[a + 12 : a + 16]).decode("latin-1").strip() if b - a >= 16 else None
        elif kind == b"stsz":
            t["sizes"] = _sizes(data, a, b, room)
            room -= int(t["sizes"].sum())
        elif kind in (b"stts", b"stsc"):
            t[kind.decode()] = _table(data, a, b, 2 if kind == b"stts" else 3)
        elif kind in (b"stco", b"co64"):
            t["chunks"] = _table(data, a, b, 1, ">u4" if kind == b"stco" else ">u8")[:, 0]
        elif kind == b"stss":
            t["keys"] = _table(data, a, b, 1)[:, 0] - 1
    if not seen:
        raise ValueError("no movie box")
    for t in found:
        sizes, chunks, runs = t.get("sizes", np.zeros(0, np.int64)), t.get("chunks", np.zeros(0, np.int64)), t.get("stsc", np.zeros((0, 3), np.int64))
        n = len(sizes)
        each = _samples_of_chunks(runs, len(chunks))
        if len(each) != len(chunks) or each.sum() != n or ("stts" in t and t["stts"][:, 0].sum() != n):
            raise ValueError("the sample tables contradict each other")
        ends = np.cumsum(sizes)
        firsts = np.cumsum(each) - each  # index of each chunk's first sample
        within = ends - sizes - np.repeat((ends - sizes)[firsts], each) if n else ends
        t["offsets"] = np.repeat(chunks, each) + within
        if n and (t["offsets"].min() < 0 or (t["offsets"] + sizes).max() > len(data)):
            raise ValueError("a sample leaves the file")
        t["sizes"] = sizes
        t.setdefault("keys", np.arange(n))  # without the table, each sample is one
        if len(t["keys"]) and (t["keys"].min() < 0 or t["keys"].max() >= n):
            raise ValueError("a key frame that is no sample")
        if not t.get("duration") and "stts" in t:
            t["duration"] = int((t["stts"][:, 0] * t["stts"][:, 1]).sum())
    return found


def read_samples(data, track: int = 0) -> bytes:
    """The stored bytes of a track's samples, in order; neighbours in the file are read as one range."""
    t = tracks(data)[track]
    off, size = t["offsets"], t["sizes"]
    if not len(off):
        return b""
    cut = np.flatnonzero(np.append(True, off[1:] != off[:-1] + size[:-1]))
    last = np.append(cut[1:], len(off)) - 1
    return b"".join(bytes(data[a : b + n]) for a, b, n in zip(off[cut].tolist(), off[last].tolist(), size[last].tolist()))


FEATURES = "status string, codec string, timescale long, duration long, seconds double, n_samples long, keyframes array<struct<sample:long,begin:long,end:long>>"


def probe(data) -> dict:
    """What ``FEATURES`` names, of the first video track or else the first track."""
    try:
        all_tracks = tracks(data)
        t = next((t for t in all_tracks if t.get("handler") == "vide"), all_tracks[0])
        scale = t.get("timescale") or None
        keys = t["keys"]
        return {"status": "ok", "codec": t.get("codec"), "timescale": scale, "duration": t.get("duration"), "seconds": t["duration"] / scale if scale and t.get("duration") is not None else None, "n_samples": len(t["sizes"]), "keyframes": (keys, t["offsets"][keys], t["offsets"][keys] + t["sizes"][keys])}
    except (ValueError, IndexError, KeyError, struct.error, OverflowError, MemoryError):
        return {"status": "corrupt"}


def media_columns(df: DataFrame, media_col: str, id_col: str, payload: bool = False, carry: bool = False) -> DataFrame:
    """id, the features of ``FEATURES``, with ``payload`` the stored bytes read back, with ``carry`` the input row."""
    small_batches(df.sparkSession)
    cols = [F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{media_col}`").cast("binary").alias("_media")]
    frame = df.select(*cols, *([F.struct(*(F.col(f"`{c}`") for c in df.columns if c != media_col)).alias("_row")] if carry else []))
    kinds = {"status": pa.string(), "codec": pa.string(), "timescale": pa.int64(), "duration": pa.int64(), "seconds": pa.float64(), "n_samples": pa.int64()}

    def look(batches):
        for batch in batches:
            for part in slices(batch, "_media", 8 << 20):
                files = [x.as_buffer() if x.is_valid else None for x in part.column(1)]
                seen = [{} if f is None else probe(memoryview(f)) for f in files]
                keys = [s.get("keyframes") for s in seen]
                offsets = [None if k is None else 0 for k in keys]
                at = 0
                for i, k in enumerate(keys):
                    if k is not None:
                        offsets[i], at = at, at + len(k[0])
                flat = [np.concatenate([k[j] for k in keys if k is not None] or [np.zeros(0, np.int64)]) for j in range(3)]
                frames = pa.ListArray.from_arrays(pa.array([*offsets, at], pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], ["sample", "begin", "end"]))
                arrays = {"id": part.column(0)} | {k: pa.array([s.get(k) for s in seen], t) for k, t in kinds.items()} | {"keyframes": frames}
                if payload:
                    arrays["payload"] = pa.array([read_samples(memoryview(f)) if s.get("status") == "ok" else None for f, s in zip(files, seen)], pa.binary())
                yield with_row(part, arrays, media_col)

    return frame.mapInArrow(look, out_schema(frame, f"id long, {FEATURES}" + ", payload binary" * payload, media_col))


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each whole text (null: empty), padded with spaces, as a media file."""
    frame = framed(docs, id_col, text_col, False)

    def write(batches):
        for batch in batches:
            for part in slices(batch, "_text", 8 << 20):
                data = [(t.as_py() or "").encode("utf-8") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, data), pa.int64()), pa.array([mux(pad(x)) for x in data], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return frame.mapInArrow(write, "doc_id long, n_bytes long, media binary")


def op2_media_columns(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    seen = media_columns(store_media(docs), "media", "doc_id", payload=True, carry=True)
    ranges = F.concat_ws(",", F.transform("keyframes", lambda k: F.concat_ws("-", k["begin"].cast("string"), k["end"].cast("string"))))
    return seen.select(
        F.col("id").alias("doc_id"),
        F.col("row.n_bytes").alias("n_bytes"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16, 16)")).alias("tail_crc32"),
        F.length("row.media").cast("long").alias("media_bytes"),
        F.sha2(F.col("row.media"), 256).alias("media_sha256"),
        F.concat_ws(";", "codec", F.col("timescale").cast("string"), F.col("duration").cast("string"), F.col("n_samples").cast("string"), F.size("keyframes").cast("string"), F.xxhash64(ranges).cast("string")).alias("feature"),
    )
