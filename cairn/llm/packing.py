"""Packing documents into sequences of at most ``size`` tokens: bounded-space, online, best fit.

Each task tokenizes its documents (ids, then an end id) and holds ``windows`` open windows.  Whole
windows of a long document leave at once; what remains goes to the open window it fits best; if it
fits none and no more may be opened, the fullest is sent out - filled first with the head of the
piece if it would waste more than ``slack`` tokens.  What is open at a task's end is merged in
rounds, ``fan`` tasks' leftovers in one group, until one group is left; all but its last tokens are
again in full windows, and the last few go to sequences whose lengths are powers of two.

The first pass is written to the shared folder, so full windows and leftovers come from one run of
the packer, whatever executors are lost.  A merge task holds at most ``fan * windows`` windows.

Defined cases: a null or empty text is the end id alone; ids may be null or repeat (a row is packed
on its own); columns besides id and text are ignored.
"""

from __future__ import annotations

import base64
import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import durable, framed, slices

FIELDS = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_tokenizers: dict[str, object] = {}


def byte_bpe(path: str):
    """text -> ids of the byte-level BPE at ``path``; the same vocabulary as ranks, beside it, is read instead where it exists: its encoder gives the same ids several times as fast.  The ranks lack the file's added tokens, so a text that holds one goes to the library."""
    if path not in _tokenizers:
        import json
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        whole = lambda text: library.encode(text, add_special_tokens=False).ids
        ranks = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks):
            import tiktoken

            with open(path, encoding="utf-8") as file:
                added = [t["content"] for t in json.load(file).get("added_tokens", [])]
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            plain = tiktoken.Encoding("cairn", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary
            _tokenizers[path] = lambda text: whole(text) if any(a in text for a in added) else plain(text)
        else:
            _tokenizers[path] = whole
    return _tokenizers[path]


class Packer:
    """Bounded-space best fit.  A piece is (doc_id, start, ids, doc_tokens); ``out`` gets closed windows as lists of pieces."""

    def __init__(self, size: int, windows: int, slack: int):
        self.size, self.windows, self.slack = size, windows, slack
        self.open: list[tuple[int, int]] = []  # (free, window), least free first
        self.held: dict[int, list] = {}
        self.made = 0
        self.out: list[list] = []

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        done, size = 0, self.size
        while len(ids) - done >= size:
            self.out.append([(doc, start + done, ids[done : done + size], total)])
            done += size
        while done < len(ids):
            need = len(ids) - done
            i = bisect.bisect_left(self.open, (need, -1))
            if i == len(self.open) and len(self.open) >= self.windows:  # none fits: the fullest goes
                free, w = self.open.pop(0)
                pieces = self.held.pop(w)
                if free > self.slack:
                    pieces.append((doc, start + done, ids[done : done + free], total))
                    done += free
                self.out.append(pieces)
                continue
            if i == len(self.open):
                free, w = size, self.made
                self.made += 1
                self.held[w] = []
            else:
                free, w = self.open.pop(i)
            self.held[w].append((doc, start + done, ids[done:], total))
            if free == need:
                self.out.append(self.held.pop(w))
            else:
                bisect.insort(self.open, (free - need, w))
            return

    def leftovers(self) -> list[list]:
        rest = [self.held[w] for _, w in self.open]
        self.open, self.held = [], {}
        return rest


def _batch(windows: list[tuple[int, list]], extra: dict[str, object]) -> pa.RecordBatch:
    rows = [(d, s, len(x), x.tobytes(), n, q, o) for q, pieces in windows for (d, s, x, n), o in zip(pieces, np.cumsum([0, *(len(p[2]) for p in pieces)]).tolist())]
    cols = list(zip(*rows)) or [()] * 7
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in FIELDS.split(", ")]
    arrays = {n: pa.array(c, t) for n, c, t in zip(names, cols, types)}
    for k, v in extra.items():
        arrays[k] = pa.array([v] * len(rows), pa.bool_() if isinstance(v, bool) else pa.int64())
    return pa.RecordBatch.from_pydict(arrays)


def _pieces(t: pa.Table) -> list[tuple]:
    return [(d, s, np.frombuffer(x, dtype="<u4"), n) for d, s, x, n in zip(*(t.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")))]


def powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def merge_windows(pieces: list[tuple], size: int, slack: int, last: bool) -> tuple[list[list], list]:
    """Packs loose pieces, the longest first, then runs what is open together and cuts it at ``size``.
    Returns closed windows and the pieces of the one that is left, which ``last`` cuts into powers of two."""
    p = Packer(size, 1 << 60, slack)
    for d, s, x, n in sorted(pieces, key=lambda q: (-len(q[2]), q[0] is None, q[0] or 0, q[1])):
        p.add(d, s, x, n)
    closed, loose = p.out, []
    for w in p.leftovers():
        (closed.append if sum(len(q[2]) for q in w) >= size - slack else loose.extend)(w)
    total = sum(len(q[2]) for q in loose)
    sizes = [size] * (total // size) + (powers(total % size) if last else [total % size] if total % size else [])
    cuts, at, i, used = [], [], 0, 0
    for want in sizes:
        while want:
            d, s, x, n = loose[i]
            take = min(want, len(x) - used)
            at.append((d, s + used, x[used : used + take], n))
            used, want = used + take, want - take
            if used == len(x):
                i, used = i + 1, 0
        cuts.append(at)
        at = []
    if last or not total % size:
        return closed + cuts, []
    return closed + cuts[:-1], cuts[-1]


def _merger(level: int, last: bool, size: int, slack: int):
    def merge(key, t):
        group = key[0].as_py()
        closed, left = merge_windows(_pieces(t), size, slack, last)
        base = (1 << 62) | level << 52 | group << 24
        parts = [_batch([(base | i, w) for i, w in enumerate(closed)], {"task": group, "open": False})]
        parts += [_batch([(base | len(closed), left)], {"task": group, "open": True})] if left else []
        return pa.Table.from_batches(parts)

    return merge


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, windows: int = 64, slack: int = 16, end_id: int = 0, fan: int = 16) -> DataFrame:
    """One row a piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""

    def first_pass(batches):
        import os

        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encode, packer, sent = byte_bpe(os.fspath(tokenizer)), Packer(size, windows, slack), 0
        for batch in batches:
            for part in slices(batch, "_text"):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                    packer.add(doc, 0, ids, len(ids))
                if packer.out:
                    yield _batch([(task << 32 | sent + i, w) for i, w in enumerate(packer.out)], {"task": task, "open": False})
                    sent += len(packer.out)
                    packer.out = []
        if rest := packer.leftovers():
            yield _batch([(task << 32 | sent + i, w) for i, w in enumerate(rest)], {"task": task, "open": True})

    packed = durable(framed(docs, id_col, text_col, False).mapInArrow(first_pass, FIELDS + ", task long, open boolean"), "packed")
    out, rest = packed.where("not open").drop("task", "open"), packed.where("open").drop("open")
    tasks = (rest.agg(F.max("task")).first()[0] or 0) + 1
    level = 0
    while True:
        level += 1
        groups = -(-tasks // fan)
        merged = rest.withColumn("task", F.floor(F.col("task") / fan)).groupBy("task").applyInArrow(_merger(level, groups == 1, size, slack), FIELDS + ", task long, open boolean")
        merged = durable(merged, "merged")
        out = out.unionByName(merged.where("not open").drop("task", "open"))
        if groups == 1:
            return out
        rest, tasks = merged.where("open").drop("open"), groups


def op1_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
