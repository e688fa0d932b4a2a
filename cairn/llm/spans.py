"""Substring dedup: removes long word sequences that occur more than once, by De Bruijn compaction.

Every ``window`` consecutive words of a document are an edge of a De Bruijn graph of words.  The edges
that occur twice or more are the repeats; maximal paths of them without a branch are compacted into
unitigs, and each document is cleaned of the unitigs that occur in it.

Plan: (1) minimizers.  A window that repeats holds a k-mer (the window's least hash) that repeats, so only
these few k-mers are counted first.  (2) Windows whose minimizer repeats are the candidate edges; each
task adds its copies together, some ``SEND`` of them at a time, before a range partition by hash, where a streaming
pass drops the edges that occur once and notes whether all copies agree on the word before and the word after.  Each
edge keeps its first source coordinate: (fingerprint of the text, word position).  (3) Compaction: two edges are
joined where neither end branches; all copies of a path shift alike, so neighbours in a path are neighbours in
their first source.  Runs within ``BLOCK`` positions of a source are one row; joins of the end of one with the begin of
the next, doubled until no end is open, make them whole unitigs, so that no source, however long, is one task's.  (4) The
words at each unitig's source coordinates are written out once, to files; one more pass over the texts finds first
edges, reads those words and compares them byte by byte with the document's own before it removes them.

Defined cases: null and empty texts have no words; documents shorter than the window keep all; ids may be
null or repeat (rows are judged one by one); columns besides id and text are ignored, or kept in ``row``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import (
    Store,
    by_range,
    cached_array,
    durable,
    forget,
    framed,
    new_path,
    out_schema,
    put_array,
    slices,
    with_row,
    write_store,
)
from cairn.llm.words import Words, kgrams, mix

_POS = np.uint64(0x9E3779B97F4A7C15)
SEND, BLOCK, FILE = 1_000_000, 1024, 32 << 20


def _sliding_least(x: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each w consecutive entries and the place of its first occurrence."""
    v, p, size = x, np.arange(len(x)), 1

    def step(v, p, a, b):
        n = min(len(v) - a, len(v) - b)
        take = v[b : b + n] < v[a : a + n]
        return np.where(take, v[b : b + n], v[a : a + n]), np.where(take, p[b : b + n], p[a : a + n])

    while size * 2 <= w:
        v, p = step(v, p, 0, size)
        size *= 2
    return step(v, p, 0, w - size) if size < w else (v, p)


class _Windows:
    """All windows of a slice: at (word index), edge and check hashes, minimizer and its place."""

    def __init__(self, col: pa.Array, window: int):
        self.words = Words(col)
        self.at = self.words.whole(window)
        h, k = self.words.hashes, max(1, window // 3)
        if len(self.at):
            least, place = _sliding_least(kgrams(h, k), window - k + 1)
            # mixed again: the leading bits of minima are not uniform, and shards go by leading bits
            self.least, self.place = mix(least[self.at]).view(np.int64), place[self.at]

    def edges(self, window: int, lane: int) -> np.ndarray:
        return kgrams(self.words.hashes, window, lane)

    def sources(self) -> np.ndarray:
        """A fingerprint of each document's words, in order."""
        words = self.words
        h, lo, counts = words.hashes, words.first[:-1], words.counts()
        inner = np.arange(len(h)) - np.repeat(lo, counts)
        full = np.flatnonzero(counts)
        src = np.zeros(len(lo), dtype=np.uint64)
        if len(full):
            src[full] = mix(np.add.reduceat(h * (mix((inner + 1).astype(np.uint64) * _POS) | np.uint64(1)), lo[full]))
        return src.view(np.int64)

    def plain(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slice's words with one space after each; where each begins and ends there."""
        words = self.words
        stop = words.starts + words.lengths()
        keep = words.is_word.copy()
        size = np.diff(np.append(0, np.cumsum(words.lengths() + 1)))
        begin = np.cumsum(size) - size
        out = np.full(int(size.sum()), 32, dtype=np.uint8)
        place = np.ones(len(out), dtype=bool)
        place[begin + stop - words.starts] = False
        out[place] = words.buf[keep]
        return out, begin, begin + stop - words.starts

    def repeated(self, store: Store) -> np.ndarray:
        """Which windows have a minimizer that repeats."""
        uniq, inv = np.unique(self.least, return_inverse=True)
        return (store.find(uniq)[0] >= 0)[inv]


def _sums(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h = h[order]
    cut = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    return h[cut], np.add.reduceat(n[order], cut)


def repeated_minimizers(frame: DataFrame, window: int) -> DataFrame:
    def count(batches):
        parts, size = [], 0

        def flush():
            h, n = _sums(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["m", "n"])

        for batch in batches:
            for part in slices(batch, "_text"):
                w = _Windows(part.column(1), window)
                if not len(w.at):
                    continue
                new = np.append(True, w.place[1:] != w.place[:-1])
                parts.append(_sums(w.least[new], np.ones(int(new.sum()), np.int64)))
                size += len(parts[-1][0])
                if size > SEND:
                    yield flush()
                    size = 0
        if parts:
            yield flush()

    return frame.mapInArrow(count, "m long, n long").groupBy("m").agg(F.sum("n").alias("n")).where("n >= 2").select("m")


def repeated_edges(frame: DataFrame, window: int, minimizers: str) -> DataFrame:
    """h, src, pos (first source coordinate), one_prev, one_next for each edge that occurs twice or more."""
    names = ["h", "at", "src", "prev", "after"]

    def merge(cols: list[np.ndarray]) -> list[np.ndarray]:
        """Rows sorted by (h, at, src), in five longs -> one row an edge.  at: check hash (32 bits), position (31), seen
        twice or more (1); prev and after: hashes of the words before and after (0 none, 1 they differ)."""
        h, at, src, *ends = cols
        check = at >> 32
        cut = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])))
        many = np.maximum(np.maximum.reduceat(at & 1, cut), np.diff(np.append(cut, len(h))) > 1)
        out = []
        for side in ends:
            lo, hi = np.minimum.reduceat(side, cut), np.maximum.reduceat(side, cut)
            out.append(np.where(lo == hi, lo, 1))
        return [h[cut], at[cut] & ~np.int64(1) | many, src[cut], *out]

    def batch_of(cols):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    def candidates(batches):
        store, held, size = None, [], 0

        def flush():
            cols = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            order = np.lexsort(cols[2::-1])
            cols = merge([c[order] for c in cols])
            for i in range(0, len(cols[0]), 250_000):
                yield batch_of([c[i : i + 250_000] for c in cols])

        for batch in batches:
            for part in slices(batch, "_text"):
                w = _Windows(part.column(1), window)
                store = store or Store.open(minimizers)
                if not len(w.at) or not len(i := np.flatnonzero(w.repeated(store))):
                    continue
                at, words = w.at[i], w.words
                h = words.hashes
                doc = np.searchsorted(words.first, at, "right") - 1
                lo, hi = words.first[:-1], words.first[1:]
                word = h.view(np.int64) | 2
                prev = np.where(at > lo[doc], word[np.maximum(at - 1, 0)], 0)
                after = np.where(at + window < hi[doc], word[np.minimum(at + window, len(h) - 1)], 0)
                edge, check = w.edges(window, 0)[at].view(np.int64), w.edges(window, 1)[at].view(np.int64) >> 32
                held.append([edge, check << 32 | (at - lo[doc]) << 1, w.sources()[doc], prev, after])
                size += len(at)
                if size > SEND:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    def repeats(batches):
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            out = merge(cols)
            held = [c[-1:] for c in out]
            yield said([c[:-1] for c in out])
        if held is not None:
            yield said(held)

    def said(cols):
        h, at, src, prev, after = (c[(cols[1] & 1) == 1] for c in cols)
        one = [pa.array((x != 0) & (x != 1)) for x in (prev, after)]
        pos = pa.array((at & 0xFFFFFFFF).astype(np.int64) >> 1, pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(src), pos, *one], names=["h", "src", "pos", "one_prev", "one_next"])

    rows = frame.mapInArrow(candidates, ", ".join(f"{n} long" for n in names))
    return by_range(rows, "h", "at", "src").mapInArrow(repeats, "h long, src long, pos int, one_prev boolean, one_next boolean")


def unitigs(edges: DataFrame, block: int = BLOCK, rounds: int = 40) -> DataFrame:
    """h (of a path's first edge), src, pos, length (edges): maximal paths without a branch.

    Edges that follow each other within a block of a source are one run, from one exchange.  A run that goes on in the
    next block is joined with it there; every round joins each open run with what its next has become by then, so a
    path of n blocks is whole after log2(n) rounds.  Only runs at a block's edge take part."""
    spark = edges.sparkSession
    edges = edges.withColumn("block", F.floor(F.col("pos") / block).cast("int"))
    along = Window.partitionBy("src", "block").orderBy("pos")
    goes_on = F.coalesce((F.lag("pos").over(along) == F.col("pos") - 1) & F.lag("one_next").over(along) & F.col("one_prev"), F.lit(False))
    marked = edges.withColumn("run", F.sum((~goes_on).cast("int")).over(along))
    first = F.min_by(F.struct("h", "one_prev"), "pos").alias("first")
    runs = marked.groupBy("src", "block", "run").agg(F.min("pos").alias("pos"), F.max("pos").alias("end"), first, F.max_by("one_next", "pos").alias("one_next"))
    runs = durable(runs.select("src", "pos", "end", "first.h", "first.one_prev", "one_next"), "runs")
    begins, ends = runs.where((F.col("pos") % block == 0) & F.col("one_prev")), runs.where((F.col("end") % block == block - 1) & F.col("one_next"))
    # open ends: (src, pos) of a run, and the position where the run begins that it goes on in
    open_ends = ends.alias("a").join(begins.alias("b"), (F.col("a.src") == F.col("b.src")) & (F.col("a.end") + 1 == F.col("b.pos")))
    links = durable(open_ends.select("a.src", "a.pos", F.col("b.pos").alias("next"), "b.end"), "open-runs")
    inner = links.select("src", F.col("next").alias("pos"))
    grown = links
    for _ in range(rounds):
        if grown.where("next is not null").isEmpty():
            break
        x, y = grown.alias("x"), grown.alias("y")
        step = x.join(y, (F.col("x.src") == F.col("y.src")) & (F.col("x.next") == F.col("y.pos")), "left")
        old = grown
        grown = durable(step.select("x.src", "x.pos", F.col("y.next").alias("next"), F.coalesce("y.end", "x.end").alias("end")), "open-runs")
        if old is not links:
            forget(spark, old)
    else:
        raise RuntimeError(f"paths still grow after {rounds} rounds")
    whole = runs.drop("one_prev", "one_next").join(inner, ["src", "pos"], "left_anti")
    whole = whole.join(grown.select("src", "pos", F.col("end").alias("last")), ["src", "pos"], "left")
    whole = durable(whole.select("h", "src", "pos", (F.coalesce("last", "end") - F.col("pos") + 1).alias("length")), "unitigs")
    forget(spark, runs, links, grown)
    return whole


def source_words(frame: DataFrame, window: int, minimizers: str, paths: str, out: str) -> DataFrame:
    """Writes the words at every unitig's source coordinates (one space between them) to files below ``out``; gives
    h, src, length and where the words are: file, begin, size."""

    def run(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), set()
        held, at, files = [], 0, 0

        for batch in batches:
            for part in slices(batch, "_text"):
                w = _Windows(part.column(1), window)
                rows = []
                if len(w.at) and len(i := np.flatnonzero(w.repeated(Store.open(minimizers)))):
                    begin = w.at[i]
                    doc = np.searchsorted(w.words.first, begin, "right") - 1
                    edge, src = w.edges(window, 0)[begin].view(np.int64), w.sources()[doc]
                    rank, length, pos = Store.open(paths).find(edge, "length", "pos", low=src)
                    own = np.flatnonzero((rank >= 0) & (pos == begin - w.words.first[:-1][doc]))
                    if len(own):
                        text, lo, hi = w.plain()
                    for k in own.tolist():
                        key = (int(edge[k]), int(src[k]))
                        if key in seen:
                            continue
                        if len(seen) > 200_000:
                            seen.clear()
                        seen.add(key)
                        last = begin[k] + length[k] + window - 2
                        words = text[lo[begin[k]] : hi[last]]
                        if at > FILE:
                            put_array(f"{out}/{task << 16 | files}.npy", np.concatenate(held))
                            held, at, files = [], 0, files + 1
                        held.append(words)
                        rows.append((*key, int(length[k]), task << 16 | files, at, len(words)))
                        at += len(words)
                columns = [pa.array(x, pa.int64()) for x in zip(*rows)] or [pa.array([], pa.int64())] * 6
                yield pa.RecordBatch.from_arrays(columns, names=["h", "src", "length", "file", "begin", "size"])
        if held:
            put_array(f"{out}/{task << 16 | files}.npy", np.concatenate(held))

    places = frame.mapInArrow(run, "h long, src long, length long, file long, begin long, size long")
    place = F.min(F.struct("file", "begin", "size", "length")).alias("at")  # copies of a source hold the same words
    return places.groupBy("h", "src").agg(place).select("h", "src", "at.length", "at.file", "at.begin", "at.size")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed words as [begin, end) pairs, in order) and, with carry, row."""
    spark = docs.sparkSession
    slim, frame = framed(docs, id_col, text_col, False), framed(docs, id_col, text_col, carry)
    minimizers, paths, words, places = (new_path(spark, x) for x in ("minimizers", "unitigs", "unitig-words", "unitig-places"))
    write_store(repeated_minimizers(slim, window), "m", {}, minimizers)
    edges = durable(repeated_edges(slim, window, minimizers), "edges")
    whole = unitigs(edges)
    forget(spark, edges)
    write_store(whole, "h", {"length": "int32", "pos": "int32"}, paths, low="src")
    forget(spark, whole)
    write_store(source_words(slim, window, minimizers, paths, words), "h", {"length": "int32", "file": "int64", "begin": "int64", "size": "int64"}, places, low="src")
    forget(spark, paths)

    def verified(w: _Windows, at: np.ndarray):
        """(first word, word after the last) of every unitig that begins at one of the windows ``at``, word for word."""
        store = Store.open(places)
        edge, stop = w.edges(window, 0)[at].view(np.int64), np.repeat(w.words.first[1:], w.words.counts())[at]
        for found in store.find_all(edge, "length", "file", "begin", "size"):
            if not len(found[0]):
                continue
            text, lo, hi = w.plain()
            for k, length, file, begin, size in zip(*(x.tolist() for x in found)):
                last = at[k] + length + window - 1
                if last > stop[k]:
                    continue
                own = text[lo[at[k]] : hi[last - 1]]
                if len(own) == size and np.array_equal(own, cached_array(f"{words}/{file}.npy")[begin : begin + size]):
                    yield at[k], last

    def clean(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                w = _Windows(part.column(1), window)
                n = len(w.words.hashes)
                cover = np.zeros(n + 1, dtype=np.int64)
                if len(w.at) and len(i := np.flatnonzero(w.repeated(Store.open(minimizers)))):
                    for begin, end in verified(w, w.at[i]):
                        cover[begin] += 1
                        cover[end] -= 1
                gone = np.cumsum(cover[:n]) > 0
                step = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
                first, counts = w.words.first, w.words.counts()
                cut = first[1:-1]
                split = cut[(cut > 0) & (cut < n)]
                split = split[gone[split - 1] & gone[split]] if n else split
                begins = np.union1d(np.flatnonzero(step == 1), split)
                ends = np.union1d(np.flatnonzero(step == -1), split)
                doc = np.searchsorted(first, begins, "right") - 1
                offsets = np.searchsorted(begins, first)
                spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(begins - first[doc], pa.int32()), pa.array(ends - first[doc], pa.int32())], ["begin", "end"]))
                total = np.append(0, np.cumsum(gone))
                removed = total[first[1:]] - total[first[:-1]]
                yield with_row(part, {"doc_id": part.column(0), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": spans}, text_col)

    return frame.mapInArrow(clean, out_schema(frame, "doc_id long, n_words long, n_removed long, spans array<struct<begin:int,end:int>>", text_col))


def kept_words(text: str | None, spans: list[dict]) -> list[bytes]:
    words = (text or "").encode("utf-8").split()
    for s in reversed(spans):
        del words[s["begin"] : s["end"]]
    return words


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def digest(batches):
        for b in batches:
            sha = [hashlib.sha256(b" ".join(kept_words(t.as_py(), s.as_py()))).hexdigest() for t, s in zip(b.column("text"), b.column("spans"))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_words", "n_removed")), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    out = repeated_spans(docs, carry=True).selectExpr("doc_id", "n_words", "n_removed", "spans", "row.text as text")
    return out.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
