"""N-gram Jaccard join with set-relation skipping: classes of documents whose word shingles overlap.

A document's set is its distinct shingles of ``n`` words (A-Z in lower case); one with fewer words has its whole
sequence as its one element.  Two documents link when ``den * |A & B| >= num * |A | B|`` (exact, in integers).

Equal sets are one class.  Elements are ordered by how common they are (counts of 2**18 hash buckets over all
documents: a table of fixed size; any order is correct, this one keeps lists short), and only the first
|A| - ceil(t |A|) + 1 elements of a set are indexed: sets that link share one of them.

A set is told from others by 128 bits of hash and is then known by a number of its own.

Answer level: a list's sets of one size class (a power of the threshold) are all first compared with one set, the class's
hub: the one found in most lists, so that near copies meet at the same hub nearly everywhere.  A set
that links to the hub takes over its answers: both are one component, and pairs within it need no look.  For the others the
hub's computed distances bound theirs: Jaccard distance is a metric, so a pair whose distances to a common hub differ by
more than 1 - t is skipped.
Index level: one more pass over the lists, a cell (a list's sets of one class, and those of the class below) at a
time, in the order of size.  A cell is cut into blocks of ``BLOCK`` entries, and a pair of blocks is skipped unread
where no two of their sets are near enough in size, where by the positions of the shared element none could overlap enough,
or where all are of one component already.  Only pairs of what is left that no bound decides are verified.

Defined cases: null texts and texts without words have empty sets, which link with nothing; ids may be null or
repeat (rows with equal sets link; a component is named by its least id); columns besides id and text are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import (
    Store,
    by_range,
    cached_array,
    digests,
    durable,
    forget,
    framed,
    get_array,
    new_path,
    put_array,
    slices,
    tidy,
    write_store,
)
from cairn.llm.components import components
from cairn.llm.words import Words, kgrams

BITS, FILE, BLOCK = 18, 4 << 20, 64
NULL_ID = -(1 << 63)


def shingle_sets(col: pa.Array, n: int) -> list[np.ndarray]:
    """Each text's set: sorted distinct hashes."""
    w = Words(col, fold=True)
    h, first, counts = w.hashes, w.first, w.counts()
    grams = kgrams(h, n)
    whole = {k: kgrams(h, k) ^ np.uint64(k) for k in range(1, n) if (counts == k).any()}
    none = np.zeros(0, dtype=np.uint64)
    return [np.unique(grams[a : a + c - n + 1]) if c >= n else whole[c][a : a + 1] if c else none for a, c in zip(first[:-1].tolist(), counts.tolist())]


def bucket_counts(frame: DataFrame, n: int) -> str:
    """How many document elements fall in each of 2**BITS buckets; written to the shared folder (2 MB, whatever the corpus)."""
    spark = frame.sparkSession

    def count(batches):
        total = np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "_text"):
                sets = shingle_sets(part.column(1), n)
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(i, pa.int32()), "n": pa.array(total[i], pa.int64())})

    with tidy(spark):
        got = frame.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    all_counts = np.zeros(1 << BITS, dtype=np.int64)
    all_counts[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    path = f"{new_path(spark, 'buckets')}.npy"
    put_array(path, all_counts)
    return path


def signatures(frame: DataFrame, n: int, num: int, den: int, buckets: str, keys: bool = False) -> DataFrame:
    """doc_id, size, high and low (the set's 128 bits; null if empty), prefix (the indexed elements, in order, 8 bytes
    each) and, with ``keys``, text_high and text_low: the text's 128 bits."""

    def sign(batches):
        counts = get_array(buckets)
        counts = np.minimum(counts, (1 << 23) - 1).astype(np.uint64) << np.uint64(40)
        for batch in batches:
            for part in slices(batch, "_text"):
                sets, prefix = shingle_sets(part.column(1), n), []
                for s in sets:
                    rank = np.argsort(counts[s >> np.uint64(64 - BITS)] | s >> np.uint64(24), kind="stable")
                    prefix.append(s[rank[: len(s) + (-len(s) * num) // den + 1]].tobytes() if len(s) else None)
                high, low = digests([s.tobytes() for s in sets])
                none = np.array([not len(s) for s in sets], dtype=bool)
                arrays = {"doc_id": part.column(0), "size": pa.array(map(len, sets), pa.int64()), "high": pa.array(high, mask=none), "low": pa.array(low, mask=none), "prefix": pa.array(prefix, pa.binary())}
                if keys:
                    of_text = digests([(t.as_py() or "").encode("utf-8") for t in part.column(1)])
                    arrays |= {"text_high": pa.array(of_text[0]), "text_low": pa.array(of_text[1])}
                yield pa.RecordBatch.from_pydict(arrays)

    return frame.mapInArrow(sign, "doc_id long, size long, high long, low long, prefix binary" + ", text_high long, text_low long" * keys)


def index_lists(classes: DataFrame, num: int, den: int) -> DataFrame:
    """token, class, cid, size, pos: the index by list and size class, without the entries that are alone in their own and the
    neighbouring classes."""
    base = np.log(den / num) if den > num else 1.0

    def postings(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                parts = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in part.column(2)]
                n = [len(p) for p in parts]
                pos = np.arange(sum(n)) - np.repeat(np.cumsum(n) - n, n)
                size = part.column(1).to_numpy()
                arrays = {"token": pa.array(np.concatenate(parts)), "class": pa.array(np.repeat(np.floor(np.log(size) / base).astype(np.int32), n))}
                yield pa.RecordBatch.from_pydict(arrays | {"cid": pa.array(np.repeat(part.column(0).to_numpy(), n)), "size": pa.array(np.repeat(size, n), pa.int32()), "pos": pa.array(pos, pa.int32())})

    def shared(batches):
        last, linked = None, False  # the last row waits for what follows it
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*([last] if last is not None else []), batch]).combine_chunks().to_batches()[0]
            t, c = (rows.column(i).to_numpy() for i in range(2))
            joined = (t[1:] == t[:-1]) & (c[1:] - c[:-1] <= 1)
            keep = np.append(False, joined) | np.append(joined, False)
            keep[0] |= linked
            yield rows.filter(pa.array(np.append(keep[:-1], False)))
            last, linked = rows.slice(rows.num_rows - 1), bool(keep[-1])
        if last is not None and linked:
            yield last

    schema = "token long, class int, cid long, size int, pos int"
    rows = classes.select("cid", "size", "prefix").mapInArrow(postings, schema)
    return by_range(rows, "token", "class").mapInArrow(shared, schema)


def with_hubs(lists: DataFrame, spread: str) -> DataFrame:
    """Adds hub: the set of a list's size class that is in most lists, by the store ``spread`` (cid -> number of lists)."""

    def run(batches):
        held, waiting = [], 0
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting < 50_000:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            t, c = (rows.column(i).to_numpy() for i in range(2))
            first = int(np.searchsorted(t, t[-1]))
            cut = first + int(np.searchsorted(c[first:], c[-1]))  # the last class may go on
            if cut:
                yield led(rows.slice(0, cut))
            held, waiting = [rows.slice(cut)], 0
        if held and (rows := pa.Table.from_batches(held).combine_chunks().to_batches()):
            yield led(rows[0])

    def led(rows):
        t, c, cid = (rows.column(i).to_numpy() for i in range(3))
        n = Store.open(spread).find(cid, "n")[1]
        cut = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (c[1:] != c[:-1])))
        size = np.diff(np.append(cut, len(t)))
        most = np.repeat(np.maximum.reduceat(n, cut), size)
        hub = np.maximum.reduceat(np.where(n == most, cid, -1), cut)
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.repeat(hub, size))], names=[*rows.schema.names, "hub"])

    return by_range(lists, "token", "class").mapInArrow(run, "token long, class int, cid long, size int, pos int, hub long")


def by_number(df: DataFrame, key: str, values: dict[str, str], path: str, parts: int, low: str | None = None) -> None:
    """A store of classes' numbers, which count from (part << 33)."""
    write_store(df, key, values, path, F.shiftright(key, 33).cast("int"), parts, low)


def member_sets(frame: DataFrame, n: int, wanted: str, path: str, parts: int) -> None:
    """Writes the sets of the classes in the store ``wanted`` (128 bits -> cid, least id), taken from that document's text:
    each task appends its own to files of its own, and an index (cid -> file, begin, n) tells where.  No set is shuffled."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen: set = set()
        held, at, files = [], 0, 0

        def flush():
            put_array(f"{path}/{task << 16 | files}.npy", np.concatenate(held))

        for batch in batches:
            for part in slices(batch, "_text"):
                sets = shingle_sets(part.column(1), n)
                high, low = digests([s.tobytes() for s in sets])
                rank, cids, least = Store.open(wanted).find(high, "cid", "least", low=low)
                rows = []
                for i, doc in enumerate(part.column(0).to_pylist()):
                    c = int(cids[i])
                    if rank[i] < 0 or not len(sets[i]) or least[i] != (NULL_ID if doc is None else doc) or c in seen:
                        continue
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(c)
                    if at > FILE:
                        flush()
                        held, at, files = [], 0, files + 1
                    held.append(sets[i])
                    rows.append((c, task << 16 | files, at, len(sets[i])))
                    at += len(sets[i])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4, names=["cid", "file", "begin", "n"])
        if held:
            flush()

    where = frame.mapInArrow(run, "cid long, file long, begin long, n long")
    by_number(where, "cid", {"file": "int64", "begin": "int64", "n": "int64"}, f"{path}/index", parts)


def compare(pairs: DataFrame, sets: str, num: int, den: int) -> DataFrame:
    """a, b, distance, linked for the distinct pairs (a, b); the sets are memory-mapped, not joined."""

    def run(batches):
        for batch in batches:
            index = Store.open(f"{sets}/index")
            a, b = (batch.column(i).to_numpy() for i in (0, 1))
            order = np.lexsort((b, a))  # all that meet one set are looked up in it at once
            a, b = a[order], b[order]
            (ra, fa, ba, na), (rb, fb, bb, nb) = (index.find(x, "file", "begin", "n") for x in (a, b))
            if len(a) and min(ra.min(), rb.min()) < 0:
                raise RuntimeError("a set that is to be compared was not written")
            load = lambda f, i, n: cached_array(f"{sets}/{f}.npy")[i : i + n]
            same = np.zeros(len(a), dtype=np.int64)
            cut = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(a)]):
                own = load(int(fa[lo]), int(ba[lo]), int(na[lo]))
                for k in range(lo, hi, 256):
                    some = range(k, min(hi, k + 256))
                    other = np.concatenate([load(int(fb[i]), int(bb[i]), int(nb[i])) for i in some])
                    at = np.searchsorted(own, other)
                    at[at == len(own)] = 0
                    begins = np.cumsum(nb[some.start : some.stop]) - nb[some.start : some.stop]
                    same[some.start : some.stop] = np.add.reduceat(own[at] == other, begins, dtype=np.int64)
            union = na + nb - same
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b), "distance": pa.array(1 - same / np.maximum(union, 1)), "linked": pa.array(same * den >= union * num)})

    return pairs.select("a", "b").distinct().mapInArrow(run, "a long, b long, distance double, linked boolean")


def open_pairs(size: np.ndarray, pos: np.ndarray, label: np.ndarray, num: int, den: int, block: int = BLOCK):
    """(i, j) arrays, i < j, of a list's entries, in the order of size, that sizes, positions and labels leave open; blocks
    are skipped as a whole where their least and largest values allow no pair."""
    begin = np.arange(0, len(size), block)
    reach = size - pos  # elements from the shared one on: no more can be shared, if it is the first shared
    low, high, far = size[begin], size[np.minimum(begin + block, len(size)) - 1], np.maximum.reduceat(reach, begin)
    lo, hi = np.minimum.reduceat(label, begin), np.maximum.reduceat(label, begin)
    for y, b in enumerate(begin.tolist()):
        near = high[: y + 1] * den >= low[y] * num
        near &= np.minimum(far[: y + 1], far[y]) * (num + den) >= (low[: y + 1] + low[y]) * num
        near &= (np.minimum(lo[: y + 1], lo[y]) != np.maximum(hi[: y + 1], hi[y]))
        js = np.arange(b, min(b + block, len(size)))
        for a in begin[: y + 1][near].tolist():
            i, j = (x.reshape(-1) for x in np.meshgrid(np.arange(a, min(a + block, len(size))), js, indexing="ij"))
            ok = (i < j) & (label[i] != label[j]) & (size[i] * den >= size[j] * num)
            ok &= np.minimum(reach[i], reach[j]) * (num + den) >= (size[i] + size[j]) * num
            if ok.any():
                yield i[ok], j[ok]


def undecided(lists: DataFrame, labels: str, asked: str, num: int, den: int) -> DataFrame:
    """a, b: pairs of sets that share a list, that are of two components so far and that no bound decides."""
    cells = lists.withColumn("of", F.explode(F.array(F.col("class"), F.col("class") + 1))).withColumn("cell", F.xxhash64("token", "of"))

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([*([held] if held is not None else []), batch]).combine_chunks().to_batches()
            if not rows:
                continue
            cell = rows[0].column(0).to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            held = rows[0].slice(cut)
            if cut:
                yield from pairs(rows[0].slice(0, cut))
        if held is not None:
            yield from pairs(held)

    def pairs(rows):
        cell, token, of, kind, cid, size, pos, hub = (rows.column(i).to_numpy() for i in range(8))
        rank, label = Store.open(labels).find(cid, "label")
        label = np.where(rank >= 0, label, cid)
        rank, distance = Store.open(asked).find(cid, "distance", low=hub)
        distance = np.where(cid == hub, 0.0, np.where(rank >= 0, distance, np.nan))
        size, pos = size.astype(np.int64), pos.astype(np.int64)
        cut = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1])))
        mixed = np.flatnonzero(np.minimum.reduceat(label, cut) != np.maximum.reduceat(label, cut))
        ends = np.append(cut[1:], len(cell))
        found = []
        for lo, hi in zip(cut[mixed].tolist(), ends[mixed].tolist()):
            own = slice(lo, hi)
            for i, j in open_pairs(size[own], pos[own], label[own], num, den):
                i, j = i + lo, j + lo
                # each pair of classes meets in one cell; two tokens whose cells' hashes are equal share nothing
                ok = (token[i] == token[j]) & (of[i] == of[j]) & ((kind[i] == of[i]) | (kind[j] == of[j]))
                # a distance that is not known (nan) decides nothing
                ok &= (hub[i] != hub[j]) | ~(np.abs(distance[i] - distance[j]) > 1 - num / den + 1e-9)
                found.append((np.minimum(cid[i[ok]], cid[j[ok]]), np.maximum(cid[i[ok]], cid[j[ok]])))
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            store = Store.open(asked)
            new = (store.find(b, low=a)[0] < 0) & (store.find(a, low=b)[0] < 0)
            for k in range(0, int(new.sum()), 250_000):
                yield pa.RecordBatch.from_pydict({"a": pa.array(a[new][k : k + 250_000]), "b": pa.array(b[new][k : k + 250_000])})

    columns = ["cell", "token", "of", "class", "cid", "size", "pos", "hub"]
    return by_range(cells.select(*columns), "cell", "size", "cid").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, keys: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of ``docs``; links at a Jaccard of num / den or more.
    With ``keys`` also text_high and text_low, 128 bits of the text, and group: a number that the rows of a component
    share, whatever their ids (null for empty sets)."""
    spark = docs.sparkSession
    frame = framed(docs, id_col, text_col, False)
    buckets = bucket_counts(frame, n)
    signed = durable(signatures(frame, n, num, den, buckets, keys), "signed")
    forget(spark, buckets)
    own_id = F.coalesce(F.min("doc_id"), F.lit(NULL_ID)).alias("least")
    classes = signed.where("high is not null").groupBy("high", "low").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"), own_id)
    classes = durable(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")  # written once, so a class keeps its number
    parts = ((classes.agg(F.max("cid")).first()[0] or 0) >> 33) + 1
    bare = durable(index_lists(classes, num, den), "bare-lists")
    spread = durable(bare.groupBy("cid").agg(F.count("*").alias("n")), "spread")
    spreads, wanted, sets, labels, answers = (new_path(spark, x) for x in ("spreads", "wanted", "sets", "labels", "answers"))
    by_number(spread, "cid", {"n": "int64"}, spreads, parts)
    lists = durable(with_hubs(bare, spreads), "lists")
    forget(spark, bare, spreads)
    write_store(classes.join(spread, "cid", "left_semi"), "high", {"cid": "int64", "least": "int64"}, wanted, low="low")
    member_sets(frame, n, wanted, sets, parts)
    forget(spark, wanted, spread)

    asked = durable(compare(lists.where("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")), sets, num, den), "hub-answers")
    first = asked.where("linked").select("a", "b")
    found = durable(components(first), "components")
    by_number(found, "node", {"label": "int64"}, labels, parts)
    by_number(asked, "b", {"distance": "float64"}, answers, parts, low="a")
    second = durable(compare(undecided(lists, labels, answers, num, den), sets, num, den).where("linked").select("a", "b"), "last-links")
    forget(spark, lists, labels, answers, sets)
    if not second.isEmpty():
        old, found = found, durable(components(first.union(second)), "components")
        forget(spark, old)

    own = F.when(F.col("least") != NULL_ID, F.col("least"))  # an id that is null names nothing
    least = classes.select("high", "low", "cid", "least").join(found, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cid"))
    names = least.join(found.select("label").distinct(), "label", "left_semi").groupBy("label").agg(F.min(own).alias("component"))
    named = least.join(names, "label", "left").select(F.col("high").alias("_h"), F.col("low").alias("_l"), F.coalesce("component", own).alias("component"), F.col("label").alias("group"))
    named = durable(named, "named")
    forget(spark, classes, asked, second, found)
    more = ["text_high", "text_low"] if keys else []
    out = signed.select("doc_id", "size", "high", "low", *more).join(named, (F.col("high") == F.col("_h")) & (F.col("low") == F.col("_l")), "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").cast("long").alias("component_id"), *more, *(["group"] if keys else []))


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, n=3, num=90, den=100)
