"""Language identification by prediction by partial matching.

For each language a variable-order byte context tree is counted on a bounded sample of labelled rows and then
frozen.  A byte's code length is that of PPM with escape method C: from the longest context of at most
``order`` bytes that the language has seen, a byte seen there costs -log2(c / (n + d)) (c: its count, n: the
context's, d: distinct bytes seen), any other costs an escape, -log2(d / (n + d)), and goes on with the
context one byte shorter; below the empty context all 256 bytes cost 8 bits.  The language with the shortest
code for the whole text wins; nothing but the text's bytes enters.

The trees share one set of nodes, so code lengths of all languages are looked up at once.  The node of a position is
found by walking back over the bytes before it, for all positions of a text in step (numpy, no loop over bytes).  A
node lists the bytes that any language saw after it, each with a row of exact code lengths, escapes included; where a
byte is not listed, the escapes of all languages are added and the node one byte shorter is asked.  So the tables grow
with what the sample holds, not with nodes x bytes, and no context is dropped for room; contexts seen fewer than
``least`` times are no nodes.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; without labelled rows
every text is ``und``; ties go to the name that sorts first; ids may be null or repeat (rows are judged one
by one; a null id is not learnt from); columns besides those named are ignored, or kept in ``row``.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import framed, get_array, get_file, new_path, out_schema, put_array, put_file, slices, tidy, with_row
from cairn.llm.words import text_bytes

ORDER, LEAST, ROWS, MAX_BYTES = 4, 3, 400, 1_500_000
_ASCII = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_ASCII.search(text)) or any(map(str.isalpha, text))


def sample(docs: DataFrame, rows: int, id_col: str, text_col: str, lang_col: str, learn, max_bytes: int = MAX_BYTES) -> list[tuple[str, str]]:
    """At most ``rows`` (lang, text) and ``max_bytes`` of whole texts of each language among the rows ``learn`` admits,
    the same ones on every run: in the order of the id's hash, texts that no longer fit being passed over (the first
    is taken if none fits).

    Rows are counted first, and only ids whose hash is so low that some ``3 * rows`` of a language are expected are looked at
    (all, where those turn out too few), so that what comes to the driver does not grow with the table."""
    own = docs.where(learn).where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
    keyed = own.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(f"`{id_col}`").alias("h"))
    picked: list[tuple[str, int]] = []
    with tidy(docs.sparkSession):
        counts = {r.lang: r.n for r in keyed.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
        if not counts:
            return []
        below = {x: min(1.0, 3 * rows / n) for x, n in counts.items()}
        while True:
            limit = F.coalesce(*(F.when(F.col("lang") == x, F.lit(int(share * 2**64) - 2**63 - (share >= 1))) for x, share in below.items()))
            seen = sorted(tuple(r) for r in keyed.where(F.col("h") <= limit).select("lang", "h", F.octet_length("text")).collect())
            have = {x: sum(r[0] == x for r in seen) for x in counts}
            short = [x for x in counts if have[x] < min(rows, counts[x]) and below[x] < 1]
            if not short:
                break
            below |= {x: min(1.0, 4 * below[x]) for x in short}
        for x in counts:
            room, taken = max_bytes, []
            for _, h, size in (r for r in seen if r[0] == x):
                if size <= room and len(taken) < rows:
                    room -= size
                    taken.append((x, h))
            picked += taken or [next((x, r[1]) for r in seen if r[0] == x)]
        ids = sorted({h for _, h in picked})
        fetched = keyed.where(F.col("h").isin(ids)).select("lang", "h", "text").collect()
    # the same bounds once more: rows may share an id
    out: dict[str, list[str]] = {x: [] for x in counts}
    room = dict.fromkeys(counts, max_bytes)
    for x, _, text in sorted((r.lang, r.h, r.text) for r in fetched if (r.lang, r.h) in set(picked)):
        size = len(text.encode("utf-8"))
        if len(out[x]) < rows and (size <= room[x] or not out[x]):
            out[x].append(text)
            room[x] -= size
    return [(x, text) for x, texts in out.items() for text in texts]


class Trees:
    """kids[node, class]: the node one byte further back, or -1; up[node]: the node one byte shorter; escape[node,
    language] in bits; listed[node, word]: which byte classes follow, a bit each; first[node, word]: the entry of the first
    of these; cost[entry, language]: exact code lengths in bits."""

    PARTS = ("kids", "up", "escape", "listed", "first", "cost")

    def __init__(self, langs, classes, *parts):
        self.langs, self.classes = langs, classes
        for name, x in zip(self.PARTS, parts):
            setattr(self, name, x)

    @classmethod
    def fit(cls, texts: list[tuple[str, str]], order: int = ORDER, least: int = LEAST) -> Trees:
        langs = sorted({x for x, _ in texts})
        data = {x: [np.frombuffer(t.encode("utf-8"), np.uint8) for y, t in texts if y == x] for x in langs}
        seen = np.zeros(256, dtype=bool)
        for parts in data.values():
            for p in parts:
                seen[p] = True
        # bytes never seen share one class: whatever the context, they escape all the way down
        classes = np.full(256, int(seen.sum()), dtype=np.uint8 if seen.sum() < 256 else np.int16)
        classes[seen] = np.arange(seen.sum())
        width = int(seen.sum()) + 1
        # a context of k bytes is a number: the byte before counts 1, the one before that ``width``, and so on
        counts = []  # by order: (context, byte class, language, count)
        for k in range(order + 1):
            rows = []
            for at, x in enumerate(langs):
                keys = []
                for p in data[x]:
                    c = classes[p].astype(np.int64)
                    if len(c) <= k:
                        continue
                    ctx = np.zeros(len(c) - k, dtype=np.int64)
                    for j in range(1, k + 1):
                        ctx += c[k - j : len(c) - j] * width ** (j - 1)
                    keys.append(ctx * width + c[k:])
                if keys:
                    u, n = np.unique(np.concatenate(keys), return_counts=True)
                    rows.append((u // width, u % width, np.full(len(u), at), n))
            counts.append([np.concatenate(z) for z in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 4)
        nodes, kept, kids = [np.array([0])], 1, [np.full((1, width), -1, dtype=np.int32)]
        for k in range(1, order + 1):
            ctx, _, _, n = counts[k]
            u, inv = np.unique(ctx, return_inverse=True)
            total = np.bincount(inv, weights=n) if len(u) else np.zeros(0)
            parent = np.searchsorted(nodes[k - 1], u % width ** (k - 1))
            parent[parent == len(nodes[k - 1])] = 0
            ok = (total >= least) & (nodes[k - 1][parent] == u % width ** (k - 1)) if len(nodes[k - 1]) else np.zeros(len(u), bool)
            i = np.flatnonzero(ok)
            kids[k - 1][parent[i], u[i] // width ** (k - 1)] = np.arange(len(i)) + kept
            nodes.append(u[i])
            kids.append(np.full((len(i), width), -1, dtype=np.int32))
            kept += len(i)
        words = -(-width // 64)
        up, escape = np.full(kept, -1, dtype=np.int32), np.zeros((kept, len(langs)), dtype=np.float32)
        listed, first = np.zeros((kept, words), dtype=np.uint64), np.zeros((kept, words), dtype=np.int64)
        keys: list[np.ndarray] = []  # by order: node * width + class of each entry
        costs: list[np.ndarray] = []
        base, entries = 0, 0
        for k in range(order + 1):
            ctx, sym, lang, n = counts[k]
            size = len(nodes[k])
            if not size:
                break
            node = np.searchsorted(nodes[k], ctx)
            node[node == size] = 0
            own = nodes[k][node] == ctx
            node, sym, lang, n = node[own], sym[own], lang[own], n[own]
            total, kinds = np.zeros((size, len(langs))), np.zeros((size, len(langs)))
            np.add.at(total, (node, lang), n)
            np.add.at(kinds, (node, lang), 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                gone = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
            escape[base : base + size] = gone
            key, entry = np.unique(node * width + sym, return_inverse=True)
            at, byte = key // width, key % width
            if k:  # the same byte after the shorter context is listed there
                above = np.searchsorted(nodes[k - 1], nodes[k] % width ** (k - 1))
                up[base : base + size] = above + base - len(nodes[k - 1])
                row = costs[-1][np.searchsorted(keys[-1], above[at] * width + byte)] + gone[at]
            else:
                row = np.full((len(key), len(langs)), 8.0) + gone[at]
            row[entry, lang] = -np.log2(n / (total + kinds)[node, lang])
            keys.append(key)
            costs.append(row)
            np.bitwise_or.at(listed, (at + base, byte >> 6), np.uint64(1) << (byte & 63).astype(np.uint64))
            for j in range(words):
                first[base : base + size, j] = entries + np.searchsorted(key, np.arange(size) * width + 64 * j)
            base, entries = base + size, entries + len(key)
        cost = np.concatenate(costs).astype(np.float32) if costs else np.zeros((0, len(langs)), np.float32)
        return cls(langs, classes, np.concatenate(kids), up, escape, listed, first, cost)

    def bits(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Code lengths of bytes after nodes: a row each, a column a language."""
        words = self.listed.shape[1]
        listed, first = self.listed.reshape(-1), self.first.reshape(-1)
        word, bit = byte >> 6, (byte & 63).astype(np.uint64)
        one = np.uint64(1)
        at = node * words + word
        mask = listed[at]
        known = (mask >> bit) & one == 1
        entry = first[at] + np.bitwise_count(mask & ((one << bit) - one))
        if len(self.cost):
            out = self.cost[np.where(known, entry, 0)]
        else:
            out = np.zeros((len(node), len(self.langs)), dtype=np.float32)
        live = np.flatnonzero(~known)
        out[live] = 0
        node = node[live]
        while len(live):  # one byte shorter at a time
            out[live] += self.escape[node]
            node = self.up[node]
            end = node < 0
            out[live[end]] += 8
            live, node = live[~end], node[~end].astype(np.int64)
            at = node * words + word[live]
            mask, b = listed[at], bit[live]
            known = (mask >> b) & one == 1
            hit = live[known]
            out[hit] += self.cost[first[at[known]] + np.bitwise_count(mask[known] & ((one << b[known]) - one))]
            live, node = live[~known], node[~known]
        return out

    def lengths(self, col: pa.Array, step: int = 1 << 19) -> np.ndarray:
        """Bits of each text under each language."""
        buf, offs = text_bytes(col)
        out = np.zeros((len(offs) - 1, len(self.langs)))
        if not len(buf) or not self.langs:
            return out
        order = _depth(self.kids)
        c = self.classes[buf].astype(np.int64)
        doc_begin = np.repeat(offs[:-1], np.diff(offs))
        sums = []
        width = self.kids.shape[1]
        kids = self.kids.reshape(-1)
        cuts = np.unique(np.concatenate([np.arange(0, len(buf), step), offs[:-1][offs[:-1] < len(buf)]]))
        for lo in range(0, len(buf), step):
            hi = min(len(buf), lo + step)
            at = np.arange(lo, hi)
            node = np.zeros(hi - lo, dtype=np.int64)
            live = np.arange(hi - lo)
            for j in range(1, order + 1):
                live = live[at[live] - j >= doc_begin[at[live]]]
                nxt = kids[node[live] * width + c[at[live] - j]]
                deeper = nxt >= 0
                live = live[deeper]
                node[live] = nxt[deeper]
            own = cuts[(cuts >= lo) & (cuts < hi)] - lo
            sums.append(np.add.reduceat(self.bits(node, c[lo:hi]), own, axis=0, dtype=np.float64))
        doc = np.searchsorted(offs, cuts, "right") - 1
        np.add.at(out, doc, np.concatenate(sums))
        return out

    def save(self, path: str) -> None:
        for name in self.PARTS:
            put_array(f"{path}/{name}.npy", getattr(self, name))
        put_file(f"{path}/meta.json", json.dumps({"langs": self.langs, "classes": self.classes.tolist()}).encode())

    @classmethod
    def load(cls, path: str) -> Trees:
        if path not in _loaded:
            _loaded.clear()
            meta = json.loads(get_file(f"{path}/meta.json"))
            _loaded[path] = cls(meta["langs"], np.array(meta["classes"], dtype=np.int16), *(get_array(f"{path}/{name}.npy") for name in cls.PARTS))
        return _loaded[path]


_loaded: dict[str, Trees] = {}


def _depth(kids: np.ndarray) -> int:
    """Levels below the root."""
    level, depth = np.array([0]), -1
    while len(level):
        level = kids[level].reshape(-1)
        level, depth = level[level >= 0], depth + 1
    return depth


def train(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, max_bytes: int = MAX_BYTES, order: int = ORDER, least: int = LEAST) -> str:
    """Fits the trees on at most ``rows`` rows and ``max_bytes`` of each language and writes them to the shared folder; returns
    where."""
    path = new_path(docs.sparkSession, "langid")
    Trees.fit(sample(docs, rows, id_col, text_col, lang_col, learn, max_bytes), order, least).save(path)
    return path


def identify(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, bits_per_byte and, with carry, row.

    score: the winner's share when each language weighs 2 ** -(bits more than the winner),
    so 1 / number of languages to 1."""
    frame = framed(docs, id_col, text_col, carry)

    def run(batches):
        trees = Trees.load(model)
        for batch in batches:
            for part in slices(batch, "_text"):
                col = part.column(1)
                bits = trees.lengths(col)
                n = np.maximum(1, np.diff(text_bytes(col)[1]))
                known = np.array([t.is_valid and has_letter(t.as_py()) for t in col], dtype=bool) & bool(trees.langs)
                if trees.langs:
                    best = bits.argmin(1)
                    low = bits[np.arange(len(bits)), best]
                    more = np.minimum(bits - low[:, None], 60)
                    score = 1 / np.exp2(-more).sum(1)
                else:
                    best, low, score = np.zeros(len(n), int), np.zeros(len(n)), np.zeros(len(n))
                pred = [trees.langs[b] if k else "und" for b, k in zip(best, known)]
                yield with_row(part, {"doc_id": part.column(0), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(np.where(known, score, 0.0)), "bits_per_byte": pa.array(np.where(known, low / n, 8.0))}, text_col)

    return frame.mapInArrow(run, out_schema(frame, "doc_id long, lang_pred string, score double, bits_per_byte double", text_col))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, ~held_out())
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")
