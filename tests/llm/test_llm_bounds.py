"""Crafted inputs, both sides of switches, keys that collide, and recall by simulation."""

import random
import struct
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.llm import common, embed_dups, jaccard, media, packing, spans
from cairn.llm.common import Store, durable, forget, write_store


def peak_of(call):
    tracemalloc.start()
    try:
        return call(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def nested(depth):
    x = b""
    for _ in range(depth):
        x = media.box(b"moov", x)
    return x


def test_boxes_nested_deep_and_claims_that_no_file_can_hold():
    assert media.probe(nested(1500))["status"] == "corrupt"
    assert media.probe(nested(200_000))["status"] == "corrupt"
    stbl = lambda *t: media.box(b"moov", media.box(b"trak", media.box(b"mdia", media.box(b"minf", media.box(b"stbl", *t)))))
    many = 2**32 - 1
    crafted = [
        stbl(media.full(b"stsz", media._u32(8, 300_000_000))),
        stbl(media.full(b"stsz", media._u32(1, many))),
        stbl(media.full(b"stsz", media._u32(0, many))),
        stbl(media.full(b"stsz", media._u32(0, 2, many, many))),
        stbl(media.full(b"stsz", media._u32(1, 1)), media.full(b"stsc", media._u32(2, 1, 1, 1, many, 1, 1)), media.full(b"stco", media._u32(1, 0))),
        stbl(media.full(b"stsz", media._u32(1, 1)), media.full(b"stsc", media._u32(1, 1, many, 1)), media.full(b"stco", media._u32(1, 0))),
        stbl(media.full(b"stts", media._u32(many))),
        stbl(media.box(b"stsz")),
        media.box(b"moov", media.box(b"trak", media.box(b"stsz", b"\0" * 4 + media._u32(1, 90))) * 50),
    ]
    for x in crafted:
        found, peak = peak_of(lambda x=x: media.probe(x))
        assert found["status"] == "corrupt" and peak < 1_000_000


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_no_damage_to_a_file_raises(data):
    whole = bytearray(media.mux(bytes(range(192)) * 20, chunk=7, gop=5))
    head = len(whole) - 192 * 20
    for _ in range(data.draw(st.integers(1, 6))):
        at = data.draw(st.integers(0, 39)) if data.draw(st.booleans()) else len(whole) - 1 - data.draw(st.integers(0, head - 60))
        whole[at] = data.draw(st.integers(0, 255))
    found, peak = peak_of(lambda: media.probe(bytes(whole)))
    assert found["status"] in ("ok", "corrupt") and peak < 2_000_000
    if found["status"] == "ok":
        assert isinstance(media.read_samples(bytes(whole)), bytes)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="aé 日\n\t<|endoftext>'s0١ ", max_size=80))
def test_the_faster_encoder_is_the_library(text):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    assert list(packing.byte_bpe(path)(text)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("dim", [8, 64])
@pytest.mark.parametrize("n", [2_000, 1_000_000])
def test_recall_at_the_threshold(dim, n):
    """Pairs at a cosine just over the threshold collide often enough, in a plan for any number of vectors."""
    rng = np.random.default_rng(dim)
    plan = embed_dups.Plan(n, 0.95)
    a = embed_dups._unit(rng.normal(size=(4000, dim)))
    other = rng.normal(size=a.shape)
    other = embed_dups._unit(other - (other * a).sum(1, keepdims=True) * a)
    b = 0.9501 * a + np.sqrt(1 - 0.9501**2) * other
    (ca, pa_), (cb, pb) = plan.project(a), plan.project(embed_dups._unit(b))
    hits = ((ca == cb) & (np.abs(pa_ - pb) <= plan.window)).sum(1)
    assert (hits >= plan.need).mean() >= 0.98


def test_links_do_not_depend_on_where_vectors_are_stored(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i % 40] + rng.normal(size=16) * 0.03 * (i >= 40)).tolist()) for i in range(160)] + [(200, [1.0, 2.0]), (201, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {tuple(r) for r in embed_dups.near_duplicates(df).collect()}
    monkeypatch.setattr(embed_dups, "FILE", 7)
    assert {tuple(r) for r in embed_dups.near_duplicates(df.repartition(5)).collect()} == want


@pytest.mark.parametrize("block", [2, 3, 1024])
def test_unitigs_grow_whole_over_blocks(spark, block):
    """A path of 200 edges in one source, broken where it branches, whatever the blocks."""
    stops = {50, 51, 120}
    rows = [(1000 + i, 7, i, i not in stops, i + 1 not in stops) for i in range(200)] + [(1, 8, 5, True, True), (2, 8, 7, True, True)]
    edges = durable(spark.createDataFrame(rows, "h long, src long, pos int, one_prev boolean, one_next boolean"), "edges")
    got = {(r.h, r.src, r.pos, r.length) for r in spans.unitigs(edges, block).collect()}
    assert got == {(1000, 7, 0, 50), (1050, 7, 50, 1), (1051, 7, 51, 69), (1120, 7, 120, 80), (1, 8, 5, 1), (2, 8, 7, 1)}


def test_spans_are_compared_word_for_word(spark, monkeypatch):
    """Even if all edges of two passages had the same hash, only the same words would go."""
    real = spans.kgrams
    monkeypatch.setattr(spans, "kgrams", lambda h, k, lane=0: real(h, k, lane) & np.uint64(0))
    texts = ["a b c d e f", "g h i j k l", "a b c d e f", "m n o p"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    words = pa.array(texts)
    w = spans._Windows(words, 3)
    text, lo, hi = w.plain()
    assert [bytes(text[a:b]) for a, b in zip(lo, hi)] == " ".join(texts).encode().split()
    for r in spans.repeated_spans(df, window=3).collect():
        kept = spans.kept_words(texts[r.doc_id], [s.asDict() for s in r.spans])
        assert r.doc_id in (0, 2) or kept == texts[r.doc_id].encode().split()


def test_blocks_of_a_list_are_skipped_and_no_pair_is_lost():
    rng = random.Random(5)
    read = []
    for _ in range(40):
        n = rng.randint(2, 300)
        size = np.sort([rng.randint(10, 60) for _ in range(n)])
        pos = np.array([rng.randint(0, max(0, s // 5)) for s in size])
        label = np.array([rng.choice([1, 1, 1, 2]) if k < n // 2 else 1 for k in range(n)])
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if label[i] != label[j] and size[i] * 100 >= size[j] * 80 and min(size[i] - pos[i], size[j] - pos[j]) * 180 >= (size[i] + size[j]) * 80}
        got = [(a, b) for i, j in jaccard.open_pairs(size, pos, label, 80, 100, block=8) for a, b in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == want
    size = np.repeat([10, 1000], 64)
    monkey = np.meshgrid
    try:
        np.meshgrid = lambda *a, **k: read.append(1) or monkey(*a, **k)
        list(jaccard.open_pairs(size, np.zeros(128, int), np.arange(128), 80, 100))
    finally:
        np.meshgrid = monkey
    assert len(read) == 2  # of three pairs of blocks the one of small with large sets is not read


def test_stores_tell_keys_of_128_bits_apart(spark, monkeypatch):
    monkeypatch.setattr(common, "FILE_ROWS", 5)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "4")
    rows = [(k, low, 10 * k + low) for k in range(-20, 20) for low in range(k % 4)]
    df = spark.createDataFrame(rows, "key long, low long, v long")
    path = common.new_path(spark, "test-store")
    assert write_store(df, "key", {"v": "int64"}, path, F.lit(0), 1, low="low")[0] == len(rows)
    spark.conf.set(key, before)
    store = Store(path)
    assert len(store.files) > 1
    asked = rows + [(k, 9, 0) for k in range(-25, 25)]
    rank, v = store.find(np.array([r[0] for r in asked]), "v", low=np.array([r[1] for r in asked]))
    assert [x for x, r in zip(v, rank) if r >= 0] == [r[2] for r in rows] and (rank[len(rows) :] == -1).all()
    keys, found = np.arange(-25, 25), defaultdict(list)
    for at, values in store.find_all(keys, "v"):
        for a, x in zip(at.tolist(), values.tolist()):
            found[int(keys[a])].append(x)
    assert {k: sorted(x) for k, x in found.items()} == {k: [10 * k + low for low in range(k % 4)] for k in range(-20, 20) if k % 4}
    forget(spark, path)
    with pytest.raises(FileNotFoundError):
        common.get_file(f"{path}/meta.json")


def test_intermediates_go(spark):
    import os
    from urllib.parse import urlparse

    df = spark.createDataFrame([(i, f"text number {i} of some words " * 5) for i in range(20)], "doc_id long, text string")
    folder = urlparse(common.shared_dir(spark)).path
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    jaccard.jaccard_components(df).collect()
    left = Counter(x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before)
    assert set(left) <= {"signed", "named", "links"}


def test_no_folder_of_its_own_on_a_cluster():
    class Conf:
        def get(self, key, default=""):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_a_table_of_media_boxes_is_what_the_format_says():
    whole = media.mux(bytes(range(192)) * 3)
    kinds = [p[-1] for p, _, _ in media.walk(whole)]
    assert kinds[:3] == [b"ftyp", b"mdat", b"moov"] and struct.unpack_from(">I", whole, 0)[0] == 24
