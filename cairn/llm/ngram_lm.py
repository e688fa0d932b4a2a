"""Language-model scoring: an interpolated modified Kneser-Ney model of order 2 or 3.

Words are counted in Spark and get dense ids, their ranks in a store of sorted hashes; n-grams of ids are counted
in Spark, dealt out by their last word but one, and each part is written as a trie of sorted arrays: the word before
(v), the word (w) and, at order 3, the word two before (u), with offsets from each level to the next.  Workers
memory-map these arrays and score whole texts.  Nothing is sampled, pruned or collected: the arrays grow with the
corpus, and the driver sees a line of metadata a file and a few totals.

    p3(w | uv) = max(c(uvw) - D3, 0) / c(uv.) + g(uv) p2(w | v)
    p2(w | v)  = max(a(vw) - D2, 0) / a(v.) + g(v) p1(w)
    p1(w)      = max(N(.w) - D1, 0) / N(..) + l / (V + 1)

c: counts; N: numbers of distinct left neighbours; a(vw): N(.vw), but the count where v is the start mark (at order 2
the count everywhere, and the second line is the model); each order has three discounts, from counts of counts; g(h):
what the discounts leave of h's total, l: of N(..).  The unknown word has the last term alone; after a context never
seen the next shorter one is used.  Each text begins with a start mark and ends with an end mark, which is a token.

Hot keys: a word with more than a part's share of the tokens is dealt over as many parts as that calls for, by the
word after it; a pair of two such words once more by the word before it.  What then falls to several parts is partial
and added up afterwards.  Contexts of a word that is not hot are whole where they are counted, and stay there, beside
the trie; those of hot words have a store.  Contexts seen once are in neither: their pair is in the trie, though.
N-grams are counted in ``PASSES`` passes over the texts, a share of the parts in each, so that what is shuffled at one time is
that share.

Defined cases: a null or empty text is the end mark alone; a null id is neither learnt from nor held out; ids
may repeat (rows are judged one by one); with nothing to learn from, every token is unknown; columns
besides id and text are ignored; any number of distinct words has ids (beyond 2**31 - 2 two of them no longer share a long).
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import Store, cached_array, durable, forget, framed, get_file, new_path, put_array, put_file, slices, tidy, write_store
from cairn.llm.words import Words, mix

END = int(mix(np.array([0xE0D], dtype=np.uint64)).view(np.int64)[0])
SEND, SHARD, ORDER, PASSES = 2_000_000, 3_000_000, 3, 2
#: Up to this many words, two ids share a long.
NARROW = (1 << 31) - 2
WORD, CONTEXT, HEAVY = 0, 1, 2
#: Of the places where a pair's list begins every so many-th is stored; lengths tell the others.
STRIDE = 4
STATS = ["kind", "a", "b", "c", "n1", "n2", "n3", "cont"]


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, each text's followed by END, and where each text begins (n + 1)."""
    w = Words(col, fold=True)
    return np.insert(w.hashes.view(np.int64), w.first[1:], END), w.first + np.arange(len(w.first))


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct entries, in no order, and which of them each entry is."""
    d = pa.array(h).dictionary_encode()
    return d.dictionary.to_numpy(), d.indices.to_numpy()


def _merged(cols: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows sorted by ``cols``: equal ones become one, with the sum of their counts."""
    if not len(n):
        return cols, n
    differ = np.zeros(len(n) - 1, dtype=bool)
    for c in cols:
        differ |= c[1:] != c[:-1]
    cut = np.flatnonzero(np.append(True, differ))
    return [c[cut] for c in cols], np.add.reduceat(n, cut)


def _by_hash(cols: list[np.ndarray], ids: int, wide: bool) -> np.ndarray:
    """An order of n-grams by their word v, and then so that equal ones (but for a few) stand together, by one key."""
    shift = 63 - int(ids).bit_length()
    _, v, *rest = cols
    if wide:
        rest = [(rest[0].astype(np.uint64)), *rest[1:]]
    else:
        v, rest = v >> 32, [v.astype(np.uint64), *rest]
    low = rest[0].copy()
    for c in rest[1:]:
        low = mix(low) * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64)
    return np.argsort(v << shift | (mix(low) >> np.uint64(64 - shift)).astype(np.int64))


def _send(batches, make, names, order=None):
    """Adds up rows of longs in chunks of about SEND, then hands them on, sorted, with their number."""
    held, size = [], 0

    def flush():
        cols = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        by = order(cols) if order else np.argsort(cols[0])
        cols, n = _merged([c[by] for c in cols], np.ones(len(by), np.int64))
        for i in range(0, len(n), 250_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 250_000]) for c in (*cols, n)], names=names)

    for batch in batches:
        for part in slices(batch, "_text", 4 << 20):
            held.append(make(part.column(1)))
            size += len(held[-1][0])
            if size > SEND:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from how many were seen once, twice, three and four times; a half of k where there are none to tell."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else None
    return [0.5 * k if y is None or not n[k - 1] or not n[k] else min(float(k), max(0.05 * k, k - (k + 1) * y * n[k] / n[k - 1])) for k in (1, 2, 3)]


class Parts:
    """Which part an n-gram of ids falls to."""

    def __init__(self, ranges: int, ids: int, hot: list[int], splits: list[int]):
        self.ranges, self.ids = ranges, ids
        self.hot, self.splits = np.array(hot, dtype=np.int64), np.array(splits, dtype=np.int64)

    def spread(self, ids: np.ndarray) -> np.ndarray:
        """How many parts each word is dealt over; 1 for all but the hot ones."""
        if not len(self.hot):
            return np.ones(len(ids), dtype=np.int64)
        i = np.minimum(np.searchsorted(self.hot, ids), len(self.hot) - 1)
        return np.where(self.hot[i] == ids, self.splits[i], 1)

    def heavy(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (self.spread(v) > 1) & (self.spread(w) > 1)

    def of(self, v: np.ndarray, w: np.ndarray, u: np.ndarray | None) -> np.ndarray:
        any_of = lambda x, n: (mix(x.astype(np.uint64)) >> np.uint64(1)).astype(np.int64) % n
        at = (v.astype(np.float64) * (self.ranges / self.ids)).astype(np.int64)
        sv = self.spread(v)
        hot = np.flatnonzero(sv > 1)
        at[hot] += any_of(w[hot], sv[hot])
        if u is not None and len(hot):
            sw = self.spread(w[hot])
            hot, sw = hot[sw > 1], sw[sw > 1]
            at[hot] += any_of(u[hot], sw)
        return at % self.ranges


def _context_key(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(mix(v.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + u.astype(np.uint64)).view(np.int64)


def _least(x: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type."""
    kinds = (np.uint8, np.uint16, np.int32, np.int64)
    return x.astype(next(t for t in kinds if not len(x) or x.max() <= np.iinfo(t).max))


def hot_words(spark: SparkSession, words: str, limit: float) -> list[tuple[int, int]]:
    """(id, count) of the words seen more than ``limit`` times: total / limit of them at most."""
    files = len(json.loads(get_file(f"{words}/meta.json"))["files"])

    def scan(batches):
        store = Store(words)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                c = store.array(i, "c")
                at = np.flatnonzero(c > limit)
                yield pa.RecordBatch.from_arrays([pa.array(at + store.base[i]), pa.array(c[at].astype(np.int64))], names=["id", "c"])

    return sorted((r.id, r.c) for r in spark.range(files).mapInArrow(scan, "id long, c long").collect())


def _count_grams(train: DataFrame, words: str, size: int, order: int, parts: Parts, path: str, wide: bool, turn: int) -> DataFrame:
    """Writes every PASSES-th of the trie's parts, from ``turn`` on, under ``path``; gives partial statistics (``STATS``): of words (a: id), of contexts of two
    words (a: key, b: the first of them) and of pairs of two hot words (a, b: the pair)."""
    start, none, ids = size, size + 1, size + 2
    pair = ["v", "w"] if wide else ["k"]  # k: both in one long
    names = [*pair, "u"] if order == 3 else pair
    sent = names if wide or order == 2 else ["k", "un"]  # un: u and the number in one long

    def make(col):
        h, first = tokens(col)
        uniq, inv = _distinct(h)
        w = Store.open(words).find(uniq)[0][inv]
        v, u = np.empty_like(w), np.empty_like(w)
        v[1:], u[2:] = w[:-1], w[:-2]
        begin = first[:-1]
        second = begin + 1
        u[second[second < first[1:]]] = start
        v[begin], u[begin] = start, none
        part = parts.of(v, w, u if order == 3 else None)
        mine = np.flatnonzero(part % PASSES == turn)
        part, v, w, u = (x[mine] for x in (part, v, w, u))
        return [part, *([v, w] if wide else [v << 32 | w]), *([u] if order == 3 else [])]

    def write(batches):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() * PASSES + turn
        files, counts = [], np.zeros((order + 1, 6), dtype=np.int64)
        held: list[list[np.ndarray]] = []
        waiting = 0

        def stats(kind, a, b, c=None, some=(None, None, None), cont=None):
            fill = lambda x: np.zeros(len(a), np.int64) if x is None else x
            cols = [np.full(len(a), kind), a, fill(b), fill(c), *map(fill, some), fill(cont)]
            for i in range(0, len(a), 250_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 250_000], pa.int64()) for x in cols], names=STATS)

        def sums(cut, x):
            return [np.add.reduceat(y.astype(np.int64), cut) for y in (x, x == 1, x == 2, x >= 3)]

        def flush(cols, n):
            v, w, *u = cols
            name = f"{at:06d}-{len(files):04d}"
            hot = parts.spread(v) > 1
            two = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])))
            one = np.flatnonzero(np.append(True, v[two][1:] != v[two][:-1]))
            files.append((name, len(two), int(v[0]), int(w[0])))
            arrays = {"v": v[two][one], "v.at": np.append(one, len(two)), "w": w[two], "n": n}
            if order == 3:
                after = np.diff(np.append(two, len(n)))
                arrays |= {"w.n": after, "w.at": two[::STRIDE], "u": u[0]}
            counts[order] += np.bincount(np.minimum(n[v != start] if order == 3 else n, 5), minlength=6)
            pv, pw, pn = v[two], w[two], n[two]
            if order == 3:  # how many words stand before the pair; after the start mark, how often it was seen
                pn = np.where(pv == start, pn, after)
                heavy = parts.heavy(pv, pw)
                yield from stats(HEAVY, pv[heavy], pw[heavy], pn[heavy])
                pv, pw, pn = pv[~heavy], pw[~heavy], pn[~heavy]
                counts[2] += np.bincount(np.minimum(pn, 5), minlength=6)
                inner = np.flatnonzero(v != start)
                by = inner[np.lexsort((u[0][inner], v[inner]))]
                cv, cu, cn = v[by], u[0][by], n[by]
                cut = np.flatnonzero(np.append(True, (cv[1:] != cv[:-1]) | (cu[1:] != cu[:-1]))) if len(by) else by
                c, *some = sums(cut, cn) if len(by) else [by] * 4
                cv, cu, part = cv[cut], cu[cut], hot[by][cut]
                yield from stats(CONTEXT, _context_key(cu, cv)[part], cu[part], c[part], [x[part] for x in some])
                own = ~part & (c > 1)
                arrays |= {"c.at": np.searchsorted(cv[own], np.append(arrays["v"], ids)), "c.u": cu[own]}
                arrays["c"] = np.stack([x[own] for x in (c, *some)], axis=1)  # side by side, as they are read
            for k, x in arrays.items():
                put_array(f"{path}/{name}.{k}.npy", _least(x))
            if len(pv):
                cut = np.flatnonzero(np.append(True, pv[1:] != pv[:-1]))
                c, *some = sums(cut, pn)
                yield from stats(WORD, pv[cut], None, c, some)
                uniq, cont = np.unique(pw, return_counts=True)
                yield from stats(WORD, uniq, None, cont=cont)

        def cut_of(cols):
            """Where a file may end: before the last word (v), or, if that is a hot one, before its last pair."""
            v, w = cols[0], cols[1]
            last = int(np.searchsorted(v, v[-1]))
            if parts.spread(v[-1:])[0] > 1:
                last += int(np.searchsorted(w[last:], w[-1]))
            return last

        def some(whole: bool):
            """Files from what is held: rows sorted by pair, so the words before are put in order here."""
            cols = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            if order == 3:
                v, w, u, _ = cols
                group = np.cumsum(np.append(False, (v[1:] != v[:-1]) | (w[1:] != w[:-1])))
                by = np.argsort(group * ids + u)
                cols = [c[by] for c in cols]
            cols, n = _merged(cols[:-1], cols[-1])
            cut = len(n) if whole else cut_of(cols)
            if cut:
                yield from flush([c[:cut] for c in cols], n[:cut])
            if cut < len(n):
                held.append([*(c[cut:] for c in cols), n[cut:]])

        for b in batches:
            if b.num_rows:
                *key, n = (b.column(i).to_numpy() for i in range(1, b.num_columns))
                if sent != names:
                    key, n = [*key, n & 0xFFFFFFFF], n >> 32
                held.append([*(key[:2] if wide else (key[0] >> 32, key[0] & 0xFFFFFFFF)), *key[len(pair) :], n])
                waiting += len(n)
            if waiting > SHARD:
                yield from some(False)
                waiting = sum(len(x[0]) for x in held)
        if held:
            yield from some(True)
        put_file(f"{path}/part-{at:06d}.json", json.dumps({"files": files, "counts": counts[:, 1:5].tolist()}).encode())

    def send(batches):
        for b in _send(batches, make, ["part", *names, "n"], lambda cols: _by_hash(cols, ids, wide)):
            if sent == names:
                yield b
                continue
            part, k, u, n = (c.to_numpy() for c in b.columns)  # n: at most the n-grams added up at a time
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, k, n << 32 | u)], names=["part", *sent])

    rows = train.mapInArrow(send, ", ".join(f"{n} long" for n in ("part", *sent, *(["n"] if sent == names else []))))
    rows = rows.repartitionById(-(-(parts.ranges - turn) // PASSES), F.floor(F.col("part") / PASSES).cast("int")).sortWithinPartitions(*pair)
    return rows.mapInArrow(write, ", ".join(f"{n} long" for n in STATS))


def train_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, wide: bool | None = None) -> str:
    """Counts and writes a model of all rows of ``docs``; returns its folder.  ``wide``: whether ids take a long each
    (by default where the words are too many for two of them to share one; the model is the same)."""
    if order not in (2, 3):
        raise ValueError(f"the order is 2 or 3, not {order}")
    spark = docs.sparkSession
    path = new_path(spark, "lm")
    frame = framed(docs, id_col, text_col, False)
    counted = frame.mapInArrow(lambda batches: _send(batches, lambda col: [tokens(col)[0]], ["h", "n"]), "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))
    size, total = write_store(counted, "h", {"c": "int64"}, f"{path}/words")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_words(spark, f"{path}/words", total / ranges)
    end = Store(f"{path}/words").find(np.array([END]), "c")[1][0]
    if end > total / ranges:
        hot.append((size, int(end)))  # a start mark for every end mark
    parts = Parts(ranges, size + 2, [i for i, _ in hot], [min(ranges, -(-2 * c * ranges // total)) for _, c in hot])
    add = [F.sum(c).alias(c) for c in STATS[3:]]
    grams = lambda turn: _count_grams(frame, f"{path}/words", size, order, parts, f"{path}/grams", size > NARROW if wide is None else wide, turn)
    turns = [durable(grams(turn), "lm-stats") for turn in range(PASSES)]
    sums = durable(reduce(DataFrame.union, turns).groupBy("kind", "a", "b").agg(*add), "lm-stats")
    forget(spark, *turns)

    files, counts = [], np.zeros((order + 1, 4), dtype=np.int64)
    for i in range(ranges):  # every part leaves a line, an empty one too: a missing one is an error
        if not total:  # nothing to learn from, so nothing was run
            files.append([])
            continue
        part = json.loads(get_file(f"{path}/grams/part-{i:06d}.json"))
        files.append(part["files"])
        counts += np.array(part["counts"])
    each = lambda c: [F.count_if(F.col(c) == k) for k in (1, 2, 3, 4)]
    stats = sums.where(F.col("kind") == WORD).select(F.col("a").alias("id"), *STATS[3:])
    heavy = sums.where(F.col("kind") == HEAVY).select("a", "b", "c")
    if order == 3:
        with tidy(spark):
            counts[2] += np.array(heavy.agg(*each("c")).first(), dtype=np.int64)
        flag = lambda x: x.cast("long")
        zero = F.lit(0).cast("long")
        of_v = heavy.select("a", "c", flag(F.col("c") == 1), flag(F.col("c") == 2), flag(F.col("c") >= 3), zero)
        of_w = heavy.select("b", zero, zero, zero, zero, F.lit(1).cast("long"))
        stats = stats.union(of_v).union(of_w).groupBy("id").agg(*add)
    d = [discounts(c.tolist()) for c in counts]
    with tidy(spark):
        r = stats.agg(*each("cont"), F.sum("cont"), F.count_if(F.col("cont") > 2)).first()
    d[1] = discounts([*r[:4]])
    left = (d[1][0] * r[0] + d[1][1] * r[1] + d[1][2] * r[5]) / r[4] if r[4] else 1.0
    lost = lambda d: (F.col("n1") * d[0] + F.col("n2") * d[1] + F.col("n3") * d[2]) / F.col("c")
    cut = F.when(F.col("cont") == 1, d[1][0]).when(F.col("cont") == 2, d[1][1]).otherwise(d[1][2])
    unigram = F.greatest(F.col("cont") - cut, F.lit(0.0)) / F.lit(float(r[4] or 1)) + F.lit(left / (size + 1))
    gamma = F.when(F.col("c") > 0, lost(d[2])).otherwise(F.lit(1.0))
    step = max(1, -(-(size + 2) // ranges))
    write_store(stats.select("id", F.col("c").alias("follow"), unigram.alias("p"), gamma.alias("g")), "id", {"follow": "int64", "p": "float64", "g": "float64"}, f"{path}/ids", F.floor(F.col("id") / step).cast("int"), ranges)
    if order == 3:
        contexts = sums.where((F.col("kind") == CONTEXT) & (F.col("c") > 1))
        write_store(contexts.select("a", "b", "c", "n1", "n2", "n3"), "a", {k: "int64" for k in ("c", "n1", "n2", "n3")}, f"{path}/contexts", low="b")
        write_store(heavy, "a", {"c": "int64"}, f"{path}/heavy", F.floor(F.col("a") / step).cast("int"), ranges, low="b")
    forget(spark, sums)
    model = {"words": size, "tokens": total, "order": order, "d": d, "unknown": left / (size + 1), "files": files}
    put_file(f"{path}/model.json", json.dumps(model | {"hot": parts.hot.tolist(), "splits": parts.splits.tolist()}).encode())
    return path


def _bisect(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each ``want`` stands in x[lo:hi], which is sorted, and whether it does."""
    kind = np.int32 if len(x) < 1 << 30 else np.int64
    at, last = lo.astype(kind), len(x) - 1
    if last < 0:
        return at, np.zeros(len(at), dtype=bool)
    on = np.flatnonzero(lo < hi)
    low, left, w = at[on], (hi[on] - lo[on]).astype(kind), want[on]
    while len(on):
        half = left >> 1
        mid = low + half
        less = x[mid] < w
        low = np.where(less, mid + 1, low)
        left = np.where(less, left - half - 1, half)
        more = left > 0
        if not more.all():
            over = ~more
            at[on[over]] = low[over]
            on, low, left, w = on[more], low[more], left[more], w[more]
    return at, (at < hi) & (x[np.minimum(at, last)] == want)


def _search(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_bisect`` for entries that often share a list with their neighbours: long lists are searched once for all."""
    if not len(lo):
        return _bisect(x, lo, hi, want)
    cut = np.flatnonzero(np.append(True, lo[1:] != lo[:-1]))
    many = np.diff(np.append(cut, len(lo)))
    long = (many >= 24) & (hi[cut] - lo[cut] >= 128)
    at, hit = np.empty(len(lo), dtype=np.int64), np.zeros(len(lo), dtype=bool)
    for a, n, b, e in zip(cut[long].tolist(), many[long].tolist(), lo[cut[long]].tolist(), hi[cut[long]].tolist()):
        own, w = x[b:e], want[a : a + n]
        j = own.searchsorted(w.astype(own.dtype))
        at[a : a + n] = j + b
        j[j == len(own)] = 0
        hit[a : a + n] = own[j] == w
    rest = np.flatnonzero(np.repeat(~long, many))
    at[rest], hit[rest] = _bisect(x, lo[rest], hi[rest], want[rest])
    return at, hit


class Grams:
    """The trie."""

    def __init__(self, path: str, model: dict):
        self.path, self.order, self.files = path, model["order"], model["files"]
        self.parts = Parts(len(self.files), model["words"] + 2, model["hot"], model["splits"])
        self.start = model["words"]
        self.heavy, self.hot = (Store(f"{path}/{x}") if self.order == 3 else None for x in ("heavy", "contexts"))

    def array(self, name: str, kind: str) -> np.ndarray:
        return cached_array(f"{self.path}/grams/{name}.{kind}.npy")

    def find(self, v: np.ndarray, w: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """a(vw); at order 3 c(uvw), both 0 for what was not seen, and of the context uv: c(uv.), n1, n2, n3 (of one that is not
        stored: once, one word once).  v and w are known words, u may be none."""
        a, c, context = np.zeros(len(v), dtype=np.int64), np.zeros(len(v), dtype=np.int64), np.ones((4, len(v)), dtype=np.int64)
        context[2:] = 0
        if not len(v):
            return a, c, context
        part = self.parts.of(v, w, u if self.order == 3 else None)
        ids = self.parts.ids
        near = part * ids + v
        order = np.argsort(near * ids + w) if len(self.files) * ids**2 < 1 << 63 else np.lexsort((w, near))
        part, sv, sw, su = (x[order] for x in (part, v, w, u))
        sa, sc, scontext = a.copy(), c.copy(), context.copy()
        edges = np.searchsorted(part, np.arange(len(self.files) + 1)).tolist()
        for files, lo, hi in zip(self.files, edges, edges[1:]):
            if lo == hi or not files:
                continue
            cuts = [lo]
            for _, _, fv, fw in files[1:]:  # a file begins with the first pair of its word; that of a hot one, with its own first pair
                word = sv.dtype.type(fv)
                cut = lo + int(np.searchsorted(sv[lo:hi], word))
                if self.parts.spread(np.array([fv]))[0] > 1:
                    end = lo + int(np.searchsorted(sv[lo:hi], word, "right"))
                    cut += int(np.searchsorted(sw[cut:end], sw.dtype.type(fw)))
                cuts.append(cut)
            for (name, *_), b, e in zip(files, cuts, [*cuts[1:], hi]):
                if b < e:
                    self._in(name, sv[b:e], sw[b:e], su[b:e], sa[b:e], sc[b:e], scontext[:, b:e])
        a[order], c[order], context[:, order] = sa, sc, scontext
        if self.heavy is not None:
            i = np.flatnonzero(self.parts.heavy(v, w))
            a[i] = self.heavy.find(v[i], "c", low=w[i])[1]
            i = np.flatnonzero(self.parts.spread(v) > 1)
            rank, *cols = self.hot.find(_context_key(u[i], v[i]), "c", "n1", "n2", "n3", low=u[i])
            for row, x in zip(context, cols):
                row[i[rank >= 0]] = x[rank >= 0]
        return a, c, context

    def _in(self, name: str, v, w, u, a, c, context) -> None:
        """``find`` within one file, for rows sorted by v and w; fills a, c and context.  A pair is searched for once."""
        x = lambda k: self.array(name, k)
        first, at, n = x("v"), x("v.at"), x("n")
        new = np.append(True, v[1:] != v[:-1])
        j = np.searchsorted(first, v[new])
        j[j == len(first)] = 0
        nth = np.cumsum(new) - 1
        known = (first[j] == v[new])[nth]
        j = j[nth]
        new[1:] |= w[1:] != w[:-1]
        pair = np.cumsum(new) - 1  # of each row
        two = np.flatnonzero(new)
        live = two[known[two]]
        p = pair[live]
        lo, hi = at[j[live]].astype(np.int64), at[j[live] + 1].astype(np.int64)
        k, hit = _search(x("w"), lo, hi, w[live])
        k, p, live = k[hit], p[hit], live[hit]
        seen = np.zeros(len(two), dtype=np.int64)
        if self.order == 2:
            seen[p] = n[k]
            a[:] = seen[pair]
            return
        rows = np.flatnonzero(known)
        at = x("c.at")
        q, there = _search(x("c.u"), at[j[rows]].astype(np.int64), at[j[rows] + 1].astype(np.int64), u[rows])
        q, rows = q[there], rows[there]
        context[:, rows] = x("c")[q].T
        lengths = x("w.n")
        block = k // STRIDE
        lo = x("w.at")[block].astype(np.int64)
        for i in range(STRIDE - 1):  # the lists of the block that stand before
            before = block * STRIDE + i
            lo += np.where(before < k, lengths[np.minimum(before, len(lengths) - 1)], 0)
        begin, end = np.zeros(len(two), dtype=np.int64), np.zeros(len(two), dtype=np.int64)
        begin[p], end[p] = lo, lo + lengths[k]
        seen[p] = np.where(v[live] == self.start, n[lo], lengths[k])
        a[:] = seen[pair]
        rows = np.flatnonzero(a)
        k, hit = _bisect(x("u"), begin[pair[rows]], end[pair[rows]], u[rows])
        c[rows[hit]] = n[k[hit]]


class Model:
    _last: dict[str, Model] = {}

    def __init__(self, path: str):
        m = json.loads(get_file(f"{path}/model.json"))
        self.size, self.total, self.unknown, self.order = m["words"], m["tokens"], m["unknown"], m["order"]
        self.d = [np.array([0.0, *x]) for x in m["d"]]
        self.words, self.ids, self.grams = Store(f"{path}/words"), Store(f"{path}/ids"), Grams(path, m)

    @classmethod
    def open(cls, path: str) -> Model:
        if path not in cls._last:
            cls._last.clear()
            cls._last[path] = cls(path)
        return cls._last[path]

    def score(self, col: pa.Array) -> dict[str, np.ndarray]:
        h, first = tokens(col)
        uniq, inv = _distinct(h)
        ids, c = self.words.find(uniq, "c")
        _, follow, p, g = self.ids.find(ids, "follow", "p", "g")
        known = ids >= 0
        p, g = np.where(known, p, self.unknown), np.where(known, g, 1.0)
        base = np.log10((c + 0.5) / (self.total + 0.5 * (self.size + 1)))
        _, sf, sg = self.ids.find(np.array([self.size]), "follow", "g")
        if self.size < NARROW:
            ids = ids.astype(np.int32)
        w, begin = ids[inv], first[:-1]

        def before(x, at_start):
            out = np.empty(len(inv), dtype=x.dtype)
            out[1:] = x[inv][:-1]
            out[begin] = at_start
            return out

        v, fv, gv = before(ids, self.size if sf[0] else -1), before(follow, sf[0]), before(g, sg[0] if sf[0] else 1.0)
        u = np.full(len(w), self.size + 1, dtype=w.dtype)
        u[1:] = v[:-1]
        u[begin] = self.size + 1  # none
        both = np.flatnonzero((v >= 0) & (w >= 0))
        a, n, context = np.zeros(len(w), dtype=np.int64), np.zeros(len(w), dtype=np.int64), np.zeros((4, len(w)), dtype=np.int64)
        a[both], n[both], context[:, both] = self.grams.find(v[both], w[both], u[both])
        less = lambda x, d: np.where(x > 0, x - d[np.minimum(x, 3)], 0.0)
        prob = less(a, self.d[2]) / np.maximum(fv, 1) + gv * p[inv]
        if self.order == 3:
            # the pair before this word, looked up as a pair one place earlier, is its context
            seen = np.zeros(len(w), dtype=bool)
            seen[1:] = a[:-1] > 0
            seen[begin] = False
            at = np.flatnonzero(seen & (w < 0))  # an unknown word's context is looked up with a word that is known
            context[:, at] = self.grams.find(v[at], v[at], u[at])[2]
            at = np.flatnonzero(seen)
            prob[at] = (less(n[at], self.d[3]) + sum(d * x for d, x in zip(self.d[3][1:], context[1:, at])) * prob[at]) / context[0, at]
        add = lambda x: np.add.reduceat(x, begin) if len(begin) else np.zeros(0)
        return {"n_tokens": np.diff(first), "n_known": add(known[inv].astype(np.int64)), "base_score": add(base[inv]), "score": add(np.log10(prob))}


def score(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score (both log10), perplexity."""
    frame = framed(docs, id_col, text_col, False)
    kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}

    def run(batches):
        m = Model.open(model)
        for batch in batches:
            for part in slices(batch, "_text", 4 << 20):
                s = m.score(part.column(1))
                said = {k: pa.array(s[k], t) for k, t in kinds.items()}
                perplexity = 10 ** np.minimum(-s["score"] / s["n_tokens"], 300.0)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "train_tokens": pa.array([m.total] * part.num_rows, pa.int64()), **said, "perplexity": pa.array(perplexity, pa.float64())}).select(OUT)

    return frame.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


OUT = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]


def op5_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = train_model(docs.where(remainder != 1))
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), *OUT[1:])
