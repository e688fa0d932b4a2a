"""Embedding near-dedup by collision-counting projections.

Two unit vectors whose cosine is at least ``threshold`` lie within r = sqrt(2 - 2 threshold), so on a random
line they lie within a window of a few r around each other, and far vectors seldom do.  Each of T tables
has one line on which vectors are sorted and compared by a window centred on the query; so that windows stay
short at any size, each table first deals vectors into cells by g coarse lines (g grows with the logarithm of
the number of vectors).  A collision is the same cell and a place in the window.  Pairs with ``need`` collisions
are verified by their cosine in double precision; T is the least number of tables for which a pair at exactly
the threshold collides ``need`` times with probability ``recall``.

Equal vectors (128 bits of hash) are one class and enter once, with their number.  Classes are written once to files of
arrays - vectors, cells and places of all tables - and are known by where they stand there.  Only that number is
dealt out, once a table, so what is shuffled does not depend on the vectors' length; a task looks the cells and
places of its rows up in the mapped files, counts a pair's collisions over all tables itself, reads vectors for the
pairs that pass alone, and judges a pair only in the first table where it collides.  It sends no pairs: only, for
each class, how many vectors it linked to, and a forest of links.  Cells with more than ``cell`` rows are dealt out in
blocks, and each pair of blocks is a task's.

Defined cases: vectors that are null, zero or hold null, NaN or infinite numbers link with nothing; vectors
of different lengths never link; ids may be null or repeat (a component is named by its least id); other columns,
whatever their names, are ignored; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import cached_array, durable, forget, new_path, put_array
from cairn.llm.components import components
from cairn.llm.words import mix

NEED, RECALL, CELL, SMALL, FILE = 2, 0.99, 20_000, 48, 1 << 16


def _phi(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


class Plan:
    """Lines, widths and tables for n vectors."""

    def __init__(self, n: int, threshold: float, need: int = NEED, recall: float = RECALL, seed: int = 11):
        r = math.sqrt(max(1e-6, 2 - 2 * threshold))
        self.width, self.window, self.need, self.seed, self.threshold = 4 * r, 2.5 * r, need, seed, threshold

        def same(d: float) -> float:
            """The probability that two vectors at distance d fall into one cell of a line."""
            return 1 - 2 * _phi(-self.width / d) - 2 * d / (math.sqrt(2 * math.pi) * self.width) * (1 - math.exp(-(self.width**2) / (2 * d * d)))

        near, far = same(r), same(math.sqrt(2))
        self.lines = max(1, math.ceil(math.log(max(2.0, n / 4)) / -math.log(far)))
        p = near**self.lines * (2 * _phi(self.window / r) - 1)
        t = need
        while sum(math.comb(t, i) * p**i * (1 - p) ** (t - i) for i in range(need)) > 1 - recall:
            t += 1
        self.tables = t
        self._drawn: dict[int, tuple] = {}

    def drawn(self, dim: int):
        if dim not in self._drawn:
            rng = np.random.Generator(np.random.PCG64([self.seed, dim]))
            a = rng.standard_normal((dim, self.tables * (self.lines + 1)))
            self._drawn[dim] = a, rng.uniform(0, self.width, self.tables * self.lines)
        return self._drawn[dim]

    def project(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """cells (hash) and places on the sorted line, both vectors x tables."""
        a, shift = self.drawn(unit.shape[1])
        p = unit @ a
        codes = np.floor((p[:, self.tables :] + shift) / self.width).astype(np.int64).view(np.uint64).reshape(len(unit), self.tables, self.lines)
        h = np.broadcast_to(np.arange(self.tables, dtype=np.uint64) + np.uint64(unit.shape[1] << 20), codes.shape[:2]).copy()
        mix(h)
        for i in range(self.lines):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[:, :, i])
        return h.view(np.int64), p[:, : self.tables].astype(np.float32)

    def collide(self, cell: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs x tables: where two vectors share a cell and a window."""
        return (cell[i] == cell[j]) & (np.abs(place[i] - place[j]) <= self.window)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    big = np.abs(x).max(1, keepdims=True)
    x = x / big  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrices(col: pa.Array):
    """(row numbers, matrix) for each length of vector."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(col.offsets.to_numpy())
    begins = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[begins[rows][:, None] + np.arange(d)]


def _gather(path: str, nums: np.ndarray, name: str) -> np.ndarray:
    """Rows of the arrays ``name`` for classes of one length: the file is the number's upper part, the row its lower."""
    file, row = nums >> 24, nums & 0xFFFFFF
    out = None
    for f in np.unique(file).tolist():
        x = cached_array(f"{path}/{f}.{name}.npy")
        own = np.flatnonzero(file == f)
        if out is None:
            out = np.empty((len(nums), *x.shape[1:]), dtype=x.dtype)
        out[own] = x[row[own]]
    return out


def store_vectors(classes: DataFrame, plan: Plan, path: str) -> DataFrame:
    """Writes vectors, cells, places and weights of all classes to files below ``path``; gives num, h1, h2, weight, least, dim."""

    def run(batches):
        from pyspark import TaskContext

        task, files = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def flush(d):
            nonlocal files
            x, *cols = (np.concatenate(c) for c in zip(*held.pop(d)))
            at = f"{path}/{task << 16 | files}"
            parts = [plan.project(_unit(x[k : k + 4096])) for k in range(0, len(x), 4096)]
            for name, data in {"vec": x, "cell": np.concatenate([c for c, _ in parts]), "place": np.concatenate([p for _, p in parts]), "weight": cols[2]}.items():
                put_array(f"{at}.{name}.npy", data)
            num = (task << 16 | files) << 24 | np.arange(len(x))
            files += 1
            names = ["num", "h1", "h2", "weight", "least", "dim"]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (num, *cols[:3])), pa.array(cols[3], pa.int64(), mask=cols[4]), pa.array(np.full(len(x), d), pa.int64())], names=names)

        for batch in batches:
            h1, h2, weight = (batch.column(i).to_numpy() for i in (0, 1, 3))
            none = batch.column(4).is_null().to_numpy(zero_copy_only=False)
            least = batch.column(4).fill_null(0).to_numpy()
            for rows, x in _matrices(batch.column(2)):
                d = x.shape[1]
                held.setdefault(d, []).append((x, h1[rows], h2[rows], weight[rows], least[rows], none[rows]))
                if sum(len(p[0]) for p in held[d]) >= FILE:
                    yield flush(d)
        for d in list(held):
            yield flush(d)

    return classes.select("h1", "h2", "vec", "weight", "least").mapInArrow(run, "num long, h1 long, h2 long, weight long, least long, dim long")


def _postings(path: str, plan: Plan, whole: bool):
    """cell and, with ``whole``, table and num: a row for each class and table."""

    def run(batches):
        for batch in batches:
            num, dim = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for d in np.unique(dim):
                own = num[dim == d]
                for k in range(0, len(own), 512):
                    part = own[k : k + 512]
                    arrays = {"cell": pa.array(_gather(path, part, "cell").reshape(-1))}
                    if whole:
                        arrays |= {"table": pa.array(np.tile(np.arange(plan.tables), len(part)), pa.int32()), "num": pa.array(np.repeat(part, plan.tables))}
                    yield pa.RecordBatch.from_pydict(arrays)

    return run


class _Rows:
    """Some rows of one task, of one length: their numbers, tables and sides, with cells and places as stored."""

    def __init__(self, path: str, plan: Plan, at: np.ndarray, cols: dict[str, np.ndarray]):
        self.path, self.plan = path, plan
        self.num, self.table, self.side, self.cross = (cols[k][at] for k in ("num", "table", "side", "cross"))
        self.cell, self.place = _gather(path, self.num, "cell"), _gather(path, self.num, "place")
        self.weight = _gather(path, self.num, "weight")
        self._vec: np.ndarray | None = None

    def order(self, by: np.ndarray) -> None:
        for k in ("num", "table", "side", "cross", "cell", "place", "weight"):
            setattr(self, k, getattr(self, k)[by])

    def own_line(self) -> np.ndarray:
        return self.place[np.arange(len(self.num)), self.table]

    def verified(self, i: np.ndarray, j: np.ndarray, t: np.ndarray, whole: bool = False):
        """The pairs that collide often enough, for the first time in table t, and whose cosine suffices.  ``whole``: most
        rows will be asked for, so that their vectors are read once."""
        plan, keep_i, keep_j = self.plan, [], []
        for a in range(0, len(i), 50_000):
            x, y, tt = i[a : a + 50_000], j[a : a + 50_000], t[a : a + 50_000]
            hit = plan.collide(self.cell, self.place, x, y)
            ok = np.flatnonzero((hit.sum(1) >= plan.need) & (hit.argmax(1) == tt))
            if not len(ok):
                continue
            x, y = x[ok], y[ok]
            if whole:
                if self._vec is None:
                    self._vec = _unit(_gather(self.path, self.num, "vec"))
                u, v = self._vec[x], self._vec[y]
            else:
                some, back = np.unique(np.concatenate([x, y]), return_inverse=True)
                both = _unit(_gather(self.path, self.num[some], "vec"))
                u, v = both[back[: len(x)]], both[back[len(x) :]]
            good = np.einsum("ij,ij->i", u, v) >= plan.threshold
            keep_i.append(x[good])
            keep_j.append(y[good])
        none = np.zeros(0, dtype=np.int64)
        return (np.concatenate(keep_i), np.concatenate(keep_j)) if keep_i else (none, none)


def _judge(path: str, plan: Plan):
    """Rows sorted by ``own`` -> (a, b, n), see ``links``."""

    def made(a, b, n):
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    def small(at, i, j, cols):
        """All pairs of groups of few rows at once."""
        file, which = np.unique(cols["num"][at] >> 24, return_inverse=True)
        dim = np.array([cached_array(f"{path}/{f}.vec.npy").shape[1] for f in file.tolist()])[which]
        for d in np.unique(dim):  # a group has vectors of one length
            back = np.full(len(at), -1)
            own = np.flatnonzero(dim == d)
            back[own] = np.arange(len(own))
            x, y = back[i], back[j]
            ok = (x >= 0) & (y >= 0)
            x, y = x[ok], y[ok]
            rows = _Rows(path, plan, at[own], cols)
            line, t = rows.own_line(), rows.table[x]
            ok = (np.abs(line[x] - line[y]) <= plan.window) & ~(rows.cross[x] & (rows.side[x] == rows.side[y]))
            x, y = rows.verified(x[ok], y[ok], t[ok])
            if len(x):
                yield made(rows.num[x], None, rows.weight[y])
                yield made(rows.num[y], None, rows.weight[x])
                yield made(rows.num[x], rows.num[y], np.zeros(len(x), np.int64))

    def large(at, cols):
        """One group, by a sliding window over its sorted line."""
        rows = _Rows(path, plan, at, cols)
        rows.order(np.argsort(rows.own_line(), kind="stable"))
        t, line = int(rows.table[0]), rows.own_line()
        end = np.searchsorted(line, line + np.float32(plan.window), "right")  # the half of the window that lies ahead
        label, total = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
        ea, eb = [], []
        for i in range(len(at)):
            j = np.arange(i + 1, end[i])
            if rows.cross[i]:
                j = j[rows.side[j] != rows.side[i]]
            if not len(j):
                continue
            _, y = rows.verified(np.full(len(j), i), j, np.full(len(j), t), whole=True)
            if not len(y):
                continue
            total[i] += rows.weight[y].sum()
            total[y] += rows.weight[i]
            roots, first = np.unique(label[y], return_index=True)
            new = roots != label[i]
            if new.any():
                ea += [i] * int(new.sum())
                eb += y[first[new]].tolist()
                label[np.isin(label, roots)] = label[i]
        i = np.flatnonzero(total)
        yield made(rows.num[i], None, total[i])
        yield made(rows.num[ea], rows.num[eb], np.zeros(len(ea), np.int64))

    def done(batches):
        t = pa.Table.from_batches(batches).combine_chunks()
        own = t.column("own").to_numpy()
        cols = {k: t.column(k).to_numpy() for k in ("table", "num", "side", "cross")}
        cut = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(np.append(cut, len(own)))
        for s in np.unique(size[(size > 1) & (size <= SMALL)]):  # groups of a size together, some thousands of pairs at once
            begins = cut[size == s]
            a, b = np.triu_indices(s, 1)
            step = max(1, 200_000 // (s * s))
            for k in range(0, len(begins), step):
                some = begins[k : k + step]
                at = (some[:, None] + np.arange(s)).reshape(-1)
                base = np.arange(len(some))[:, None] * s
                yield from small(at, (base + a).reshape(-1), (base + b).reshape(-1), cols)
        for lo, s in zip(cut[size > SMALL], size[size > SMALL]):
            yield from large(np.arange(lo, lo + s), cols)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column(0).to_numpy()
            last = int(np.searchsorted(own, own[-1]))  # the last group may go on
            if last or (held and held[-1].column(0)[-1].as_py() != own[0]):
                if last:
                    held.append(b.slice(0, last))
                yield from done(held)
                held = [b.slice(last)]
            else:
                held.append(b)
        if held:
            yield from done(held)

    return run


def links(numbered: DataFrame, path: str, plan: Plan, cell_rows: int = CELL) -> DataFrame:
    """Rows (a, b, n) of class numbers; b null: a links to n vectors of other classes; else a link of the forest."""
    nums = numbered.select("num", "dim")
    bare = nums.mapInArrow(_postings(path, plan, False), "cell long")
    heavy = durable(bare.groupBy("cell").count().where(F.col("count") > cell_rows).select("cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("blocks")), "heavy-cells")
    rows = nums.mapInArrow(_postings(path, plan, True), "cell long, table int, num long")
    dealt = rows.join(heavy, "cell", "left").withColumn("side", F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.hash("num"), F.col("blocks"))))
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = dealt.withColumn("cross", F.col("side") != F.col("other")).withColumn("own", F.xxhash64("cell", F.least("side", "other"), F.greatest("side", "other")))
    n = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("own", "table", "num", "side", "cross").repartition(n, "own").sortWithinPartitions("own")
    return dealt.mapInArrow(_judge(path, plan), "a long, b long, n long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of ``df``."""
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").alias("vec"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    valid = F.coalesce(F.col("vec").isNotNull() & ~F.exists("vec", odd) & F.exists("vec", lambda x: x != 0), F.lit(False))
    plain = F.transform("vec", lambda x: x + 0)  # -0 is 0
    rows = rows.withColumn("h1", F.when(valid, F.xxhash64(plain))).withColumn("h2", F.when(valid, F.xxhash64(F.lit("2"), plain)))
    classes = rows.where("h1 is not null").groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    classes = durable(classes, "vectors")
    plan, path = Plan(classes.count(), threshold), new_path(spark, "vector-arrays")
    numbered = durable(store_vectors(classes, plan, path), "numbered")
    forget(spark, classes)
    found = durable(links(numbered, path, plan), "vector-links")
    forget(spark, path)
    labels = durable(components(found.where("b is not null")), "vector-components")
    least = labels.join(numbered.select("num", "least"), F.col("node") == F.col("num")).groupBy("label").agg(F.min("least").alias("component"))
    labels = labels.join(least, "label").select("node", "component")
    counts = found.where("b is null").groupBy(F.col("a").alias("other")).agg(F.sum("n").alias("others"))
    known = numbered.join(labels, F.col("num") == F.col("node"), "left").join(counts, F.col("num") == F.col("other"), "left")
    n_links = (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    known = known.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), n_links, F.coalesce("component", "least").alias("component"))
    out = rows.drop("vec").join(known, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
