"""Line dedup: which lines of each document stay, as compressed bitmaps.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case.  Keys of at
least ``min_chars`` code points that ``min_docs`` documents hold lose all their lines except in the
largest document id that holds them; every other line stays.

A key is told from others by 128 bits of hash, so that no line goes for another's sake.

Plan: (1) each task keeps, for a key, only its ``min_docs`` largest documents - enough to tell both
whether the key is common and who keeps it, so a line that a third of the corpus shares sends a few
rows a task; (2) these rows are range-partitioned by the key's hash with a secondary sort by document,
and a streaming pass that holds one key's state names common keys and their keepers; (3) these go to
sorted arrays, and one more pass over the documents turns them into bitmaps.  Texts are never shuffled.

Defined cases: a null or empty text is one empty line; a null id counts as one document smaller than
all others; rows with the same id are one document; columns besides id and text are ignored, or kept
in ``row``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import Store, by_range, digests, framed, new_path, out_schema, slices, with_row, write_store

NULL_ID = -(1 << 63)
STATE = 200_000


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key, or None if it is shorter than min_chars code points."""
    key = line.strip().lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def keyed_lines(texts: pa.Array, min_chars: int) -> tuple[list[int], list[int], list[int], np.ndarray, np.ndarray]:
    """Lines of each text; for every line with a key, its text and place, and the two longs of its key's hash."""
    total, owner, place, keys = [], [], [], []
    for row, t in enumerate(texts):
        lines = (t.as_py() or "").encode("utf-8").split(b"\n")
        total.append(len(lines))
        for at, line in enumerate(lines):
            if (key := line_key(line, min_chars)) is not None:
                keys.append(key)
                owner.append(row)
                place.append(at)
    return total, owner, place, *digests(keys)


def common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(key, low, keeper): hash of each common line (128 bits, in two longs) and the document that keeps it."""

    def largest(batches):
        held: dict[tuple[int, int], list[int]] = {}

        def flush():
            rows = [(*k, d) for k, v in held.items() for d in v]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)] or [pa.array([], pa.int64())] * 3, names=["key", "low", "doc"])

        for batch in batches:
            for part in slices(batch, "_text"):
                ids = [NULL_ID if i is None else i for i in part.column(0).to_pylist()]
                _, owner, _, high, low = keyed_lines(part.column(1), min_chars)
                for row, key in zip(owner, zip(high.tolist(), low.tolist())):
                    doc = ids[row]
                    own = held.setdefault(key, [])
                    if doc in own:
                        continue
                    if len(own) < min_docs:
                        own.append(doc)
                    elif doc > (least := min(own)):
                        own[own.index(least)] = doc
                if len(held) > STATE:
                    yield flush()
        yield flush()

    def keepers(batches):
        key, last, keeper, n = None, None, None, 0
        for batch in batches:
            found = []
            for *k, d in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if k != key:
                    key, last, keeper, n = k, d, d, 1
                elif d != last:
                    last, n = d, n + 1
                else:
                    continue
                if n == min_docs:
                    found.append((*key, keeper))
            columns = [pa.array(x, pa.int64()) for x in zip(*found)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(columns, names=["key", "low", "keeper"])

    rows = framed(docs, id_col, text_col, False).mapInArrow(largest, "key long, low long, doc long")
    return by_range(rows, "key", "low", F.desc("doc")).mapInArrow(keepers, "key long, low long, keeper long")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, carry: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, keep_bits (zlib of one bit a line, first line first) and, with carry, row."""
    path = new_path(docs.sparkSession, "lines")
    write_store(common_lines(docs, id_col, text_col, min_chars, min_docs), "key", {"keeper": "int64"}, path, low="low")
    frame = framed(docs, id_col, text_col, carry)

    def judge(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                ids = [NULL_ID if i is None else i for i in part.column(0).to_pylist()]
                total, owner, place, high, low = keyed_lines(part.column(1), min_chars)
                rank, keeper = Store.open(path).find(high, "keeper", low=low)
                own = np.array(owner, dtype=np.int64)
                lose = np.flatnonzero((rank >= 0) & (keeper != np.array(ids, dtype=np.int64)[own])) if len(own) else np.zeros(0, np.int64)
                begin = np.cumsum([0, *total])
                keep = np.ones(begin[-1], dtype=bool)
                keep[begin[own[lose]] + np.array(place, dtype=np.int64)[lose]] = False
                bits = [zlib.compress(np.packbits(keep[a:b]).tobytes(), 1) for a, b in zip(begin, begin[1:])]
                dropped = np.bincount(own[lose], minlength=len(ids)) if len(lose) else np.zeros(len(ids), np.int64)
                yield with_row(part, {"doc_id": part.column(0), "n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()), "keep_bits": pa.array(bits, pa.binary())}, text_col)

    return frame.mapInArrow(judge, out_schema(frame, "doc_id long, n_lines long, n_dropped long, keep_bits binary", text_col))


def kept_lines(text: str | None, bits: bytes) -> bytes:
    """Applies a bitmap: the lines that stay, joined by \\n, as UTF-8."""
    return kept_lines_of((text or "").encode("utf-8"), bits)


def kept_lines_of(text: bytes, bits: bytes) -> bytes:
    lines = text.split(b"\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8), count=len(lines)).astype(bool)
    return b"\n".join(lines) if keep.all() else b"\n".join(x for x, k in zip(lines, keep) if k)


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def digest(batches):
        for b in batches:
            text, bits = b.column("text"), b.column("keep_bits")
            sha = [hashlib.sha256(kept_lines(t.as_py(), x.as_py())).hexdigest() for t, x in zip(text, bits)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_lines", "n_dropped")), pa.array(sha, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    out = line_dedup(docs, carry=True).selectExpr("doc_id", "n_lines", "n_dropped", "keep_bits", "row.text as text")
    return out.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, k.pos, k.line, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS lose FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (lose) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lose), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
