"""Operators against brute force, exact round trips, and the defined cases."""

import math
import random

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairn.llm import embed_dups, jaccard, langid, lines, media, ngram_lm, packing, pieces, spans, url_rules
from cairn.llm.words import Words, kgrams

DIR = "/root/testdata/sf0.001"


def tokenizer(name):
    return pytest.importorskip("public_tokenizers").path(name)


def docs_of(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def as_texts(rows):
    return [(r.doc_id, r.text or "") for r in rows]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \n\t\x0b\x1f\xa0Z", max_size=30), max_size=6))
def test_words_are_those_of_split(texts):
    for fold in (False, True):
        w = Words(pa.array(texts, pa.string()), fold=fold, step=7)
        want = [(t.encode().lower() if fold else t.encode()).split() for t in texts]
        assert w.counts().tolist() == list(map(len, want))
        flat = [x for ws in want for x in ws]
        seen = {}
        for h, x in zip(w.hashes.tolist(), flat):
            assert seen.setdefault(h, x) == x
        assert len(seen) == len(set(flat)) and w.lengths().tolist() == list(map(len, flat))
        h = w.hashes
        for k in (1, 2, 3, 5, 7):
            g = kgrams(h, k).tolist()
            assert len(set(g)) == len({tuple(flat[i : i + k]) for i in range(len(flat) - k + 1)})


def test_packing_covers_every_token_once(spark, odd_docs):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for docs in (odd_docs, docs_of(spark).repartition(40)):
        rows = packing.pack(docs, path, windows=4, fan=3).collect()
        by_doc, by_seq = defaultdict(list), defaultdict(list)
        for r in rows:
            by_seq[r.sequence_id].append(r)
            by_doc[r.doc_id, r.doc_tokens].append(r)
        for s in by_seq.values():
            s.sort(key=lambda r: r.offset)
            assert [r.offset for r in s] == np.cumsum([0, *(r.length for r in s)])[:-1].tolist() and sum(r.length for r in s) <= 1024
        want = Counter()
        for d in docs.collect():
            want[d.doc_id, np.array([*t.encode(d.text or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()] += 1
        got = Counter()
        for (doc, n), parts in by_doc.items():
            parts.sort(key=lambda r: r.start)
            starts = defaultdict(list)
            for p in parts:
                starts[p.start].append(p)
            for _ in range(len(starts[0])):  # repeated rows: one chain each
                at, ids = 0, b""
                while at < n:
                    p = starts[at].pop()
                    assert len(p.ids) == 4 * p.length
                    ids, at = ids + bytes(p.ids), at + p.length
                got[doc, ids] += 1
        assert got == want
        pad = sum(0 if n & (n - 1) == 0 else 1024 - n for n in (sum(r.length for r in s) for s in by_seq.values()))
        assert pad <= 0.02 * sum(r.length for r in rows) + 1024
    assert packing.pack(odd_docs.limit(0), path).count() == 0


def test_components_settle_or_raise(spark):
    from cairn.llm.components import components

    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {(r.node, r.label) for r in components(path).collect()} == {(i, 0) for i in range(41)}
    assert components(path.limit(0)).count() == 0
    with pytest.raises(RuntimeError):
        components(path, rounds=2)


@pytest.mark.parametrize("ranks", [True, False])
def test_packing_takes_added_tokens_as_the_library_does(spark, ranks, tmp_path):
    import shutil

    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    if not ranks:  # a vocabulary without ranks beside it
        path = shutil.copy(path, tmp_path / "alone.json")
    t = Tokenizer.from_file(str(path))
    end = "<|endoftext|>"
    texts = [f"end {end} begin", end, end * 3, f"é{end}\n{end} 日本 ", f"<|endoftext {end[1:]} |>", "one two " * 800 + end + " three" * 800, "none"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(path)).orderBy("doc_id", "start").collect()
    for i, text in enumerate(texts):
        own = [r for r in rows if r.doc_id == i]
        want = [*t.encode(text, add_special_tokens=False).ids, 0]
        assert np.frombuffer(b"".join(bytes(r.ids) for r in own), dtype="<u4").tolist() == want and {r.doc_tokens for r in own} == {len(want)}


def test_packer_places_best_fit_and_sends_the_fullest():
    p = packing.Packer(10, 2, 0)
    ids = lambda n: np.arange(n, dtype="<u4")
    p.add(1, 0, ids(6), 6)
    p.add(2, 0, ids(5), 5)
    p.add(3, 0, ids(4), 4)  # fits the first exactly
    assert [[q[0] for q in w] for w in p.out] == [[1, 3]]
    p.add(4, 0, ids(7), 7)
    p.add(5, 0, ids(8), 8)  # none fits: the fullest (7 of 10) goes, filled with three of its tokens
    assert [(q[0], len(q[2])) for q in p.out[1]] == [(4, 7), (5, 3)]
    closed, left = packing.merge_windows([(1, 0, ids(700), 700), (2, 0, ids(700), 700)], 1024, 16, True)
    assert not left and sorted(sum(len(q[2]) for q in w) for w in closed) == [8, 16, 32, 64, 256, 1024]
    assert packing.powers(13) == [8, 4, 1]


def test_media_round_trip(spark, odd_docs):
    stored = media.store_media(odd_docs)
    rows = media.media_columns(stored, "media", "doc_id", payload=True, carry=True).collect()
    want = Counter((d.doc_id, media.pad((d.text or "").encode())) for d in odd_docs.collect())
    assert Counter((r.id, bytes(r.payload)) for r in rows) == want
    for r in rows:
        assert r.status == "ok" and r.codec == "raw" and r.n_samples * 192 == len(r.payload) and r.seconds == r.n_samples / 25
        for k in r.keyframes:
            assert bytes(r.row.media[k.begin : k.end]) == bytes(r.payload[k.sample * 192 : (k.sample + 1) * 192]) and k.sample % 16 == 0


def test_media_of_any_shape():
    whole = media.mux(bytes(range(192)) * 100, chunk=7, gop=5)
    assert media.read_samples(whole) == bytes(range(192)) * 100
    assert media.probe(whole)["status"] == "ok"
    for n in range(0, len(whole), 97):
        assert media.probe(whole[:n])["status"] == "corrupt"
    spare = media.box(b"free", b"x" * 9)
    assert media.probe(whole + spare)["status"] == "ok"
    random.seed(3)
    for _ in range(200):
        x = bytearray(whole)
        for _ in range(3):
            x[random.randrange(19_200, len(x))] = random.randrange(256)
        assert media.probe(bytes(x))["status"] in ("ok", "corrupt")
    # two sizes of samples, a 64-bit box and a movie before its data
    data = b"a" * 5 + b"b" * 9
    table = media.box(b"stbl", media.full(b"stsz", media._u32(0, 2, 5, 9)), media.full(b"stsc", media._u32(1, 1, 1, 1)), media.full(b"stts", media._u32(1, 2, 3)), media.full(b"stco", media._u32(2, 0, 0)))
    moov = lambda t: media.box(b"moov", media.box(b"trak", media.box(b"mdia", media.box(b"minf", t))))
    at = len(moov(table)) + 16
    table = table[:-8] + media._u32(at, at + 5)
    import struct

    x = moov(table) + struct.pack(">I4sQ", 1, b"mdat", 16 + len(data)) + data
    assert media.read_samples(x) == data and media.probe(x)["duration"] == 6 and len(media.probe(x)["keyframes"][0]) == 2


def test_media_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, b""), (3, b"junk that is no box")], "id long, m binary")
    got = {r.id: r.status for r in media.media_columns(df, "m", "id").collect()}
    assert got == {1: None, 2: "corrupt", 3: "corrupt"}


def _cosines(rows):
    ok = {i: np.array(v, float) for i, v in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    return {(i, j) for i in ok for j in ok if i != j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= 0.95}


def _least(n, pairs):
    label = list(range(n))
    for _ in range(n):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("cell", [embed_dups.CELL, 40])
def test_embeddings_equal_brute_force(spark, cell, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 24))
    rows = [x.tolist() for x in base] + [(base[i % 20] * (1 + i % 3) + rng.normal(size=24) * 0.05).tolist() for i in range(80)] + [base[1].tolist()] * 5
    rows += [(base[0] + rng.normal(size=24) * 0.02).tolist() for _ in range(90)]  # one crowd
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [1.0, 2.0], [2.0, 4.0], [float("inf")] + [1.0] * 23]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    real = embed_dups.links
    monkeypatch.setattr(embed_dups, "links", lambda c, path, plan: real(c, path, plan, cell))
    got = {r.vec_id: r for r in embed_dups.near_duplicates(df).collect()}
    pairs = _cosines(rows)
    deg, label = Counter(i for i, _ in pairs), _least(len(rows), pairs)
    found = sum(got[i].n_links for i in got)
    assert all(got[i].n_links <= deg[i] for i in got) and found >= 0.98 * len(pairs)
    assert sum(got[i].component_id == label[i] for i in got) >= len(rows) - 2
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert embed_dups.near_duplicates(df.limit(0)).count() == 0


def _jaccard(texts, n, num, den):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    return sets, {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and a and b and len(a & b) * den >= len(a | b) * num}


@pytest.mark.parametrize("n,num", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_equals_brute_force(spark, n, num):
    random.seed(n)
    vocab = [f"w{i}" for i in range(400)]
    texts = [" ".join(random.choices(vocab, k=random.randint(1, 80))) for _ in range(25)] + [None, "", " ", "one", "ONE", "one two", "one two"]
    for i in range(120):  # near copies of every degree, some in chains
        words = texts[random.randrange(len(texts))]
        words = (words or "a b").split() or ["z"]
        for _ in range(random.choice([0, 1, 1, 2, 4])):
            words[random.randrange(len(words))] = random.choice(vocab)
        texts.append(" ".join(words))
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, component_id int")
    sets, pairs = _jaccard(texts, n, num, 100)
    label = _least(len(texts), pairs)
    for r in jaccard.jaccard_components(df, n=n, num=num, den=100).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), label[r.doc_id])


def test_jaccard_odd_cases(spark, odd_docs):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd_docs, n=3, num=90).collect()]
    assert len(got) == 13 and {r[2] for r in got if r[0] in (3, 4, 10)} == {3} and {r[1] for r in got if r[0] in (0, 1, 2)} == {0}
    assert jaccard.jaccard_components(odd_docs.limit(0)).count() == 0


def _kneser_ney(train, texts, order):
    words = lambda t: [*(t or "").encode().lower().split(), None]
    tr = [words(t) for t in train]
    c = Counter(w for v in tr for w in v)
    total, size = sum(c.values()), len(c)
    pair = Counter(p for v in tr for p in zip(["<s>", *v], v))
    triple = Counter(p for v in tr for p in zip(["<s>", *v], v, v[1:]))
    adjusted = pair
    if order == 3:
        left_of = Counter((v, w) for _, v, w in triple)
        adjusted = Counter({p: n if p[0] == "<s>" else left_of[p] for p, n in pair.items()})
    cont = Counter(w for _, w in pair)
    d, e, f = ([0, *ngram_lm.discounts([sum(x == k for x in n.values()) for k in (1, 2, 3, 4)])] for n in (adjusted, cont, triple))
    sums = [(Counter(), Counter()), (Counter(), Counter())]
    for (follow, lost), grams, cut in zip(sums, (adjusted, triple), (d, f)):
        for (*h, _), n in grams.items():
            follow[tuple(h)] += n
            lost[tuple(h)] += cut[min(n, 3)]
    left = sum(e[min(x, 3)] for x in cont.values()) / len(pair) if pair else 1.0
    uni = lambda w: ((cont[w] - e[min(cont[w], 3)]) / len(pair) if cont[w] else 0) + left / (size + 1)

    def over(h, n, cut, at, below):
        follow, lost = sums[at]
        return below if not follow[h] else max(n - cut[min(n, 3)], 0) / follow[h] + lost[h] / follow[h] * below

    def prob(h, w):
        p = over(h[-1:], adjusted[h[-1], w], d, 0, uni(w))
        return over(h, triple[(*h, w)], f, 1, p) if order == 3 and len(h) == 2 else p

    out = []
    for t in texts:
        ws = words(t)
        told = ["<s>", *ws]
        score = sum(math.log10(prob(tuple(told[max(0, i - 1) : i + 1]), w)) for i, w in enumerate(ws))
        out.append((len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 0.5) / (total + 0.5 * (size + 1))) for w in ws), score))
    return out


@pytest.mark.parametrize("order,wide", [(2, None), (3, None), (3, True), (2, True)])
def test_model_equals_brute_force(spark, odd_docs, order, wide, monkeypatch):
    hot = spark.createDataFrame([(i, " ".join(random.Random(i).choices(["a", "a", "b", "b c", f"w{i % 9}"], k=60))) for i in range(200)], "doc_id long, text string")
    monkeypatch.setattr(ngram_lm, "SHARD", 300)  # several files a part
    other = spark.createDataFrame([(i, " ".join(random.Random(-i).choices(["a", "b", "c", "new", *(f"w{k}" for k in range(9))], k=60))) for i in range(40)], "doc_id long, text string")
    for train, docs in ((docs_of(spark), docs_of(spark)), (odd_docs, odd_docs), (odd_docs.limit(0), odd_docs), (odd_docs, odd_docs.limit(0)), (hot.repartition(5), hot.union(other))):
        train, docs = train.select("doc_id", "text"), docs.select("doc_id", "text").coalesce(1)
        got = ngram_lm.score(docs, ngram_lm.train_model(train, order=order, wide=wide)).collect()
        want = _kneser_ney([r.text for r in train.collect()], [r.text for r in docs.collect()], order)
        assert len(got) == len(want)
        for r, w in zip(got, want):
            assert tuple(r[1:4]) == w[:3] and r.base_score == pytest.approx(w[3], rel=1e-9, abs=1e-9) and r.score == pytest.approx(w[4], rel=1e-6, abs=1e-6)


def test_model_without_a_part_is_an_error(spark, monkeypatch):
    real = ngram_lm.put_file
    monkeypatch.setattr(ngram_lm, "put_file", lambda p, x: None if "part-000001" in p else real(p, x))
    with pytest.raises(FileNotFoundError):
        ngram_lm.train_model(docs_of(spark).limit(20))
    with pytest.raises(ValueError):
        ngram_lm.train_model(docs_of(spark), order=4)


def test_held_out_texts_score_better_than_the_base(spark):
    docs = docs_of(spark)
    out = ngram_lm.score(docs.where("doc_id % 5 = 1"), ngram_lm.train_model(docs.where("doc_id % 5 <> 1"))).collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_pieces_equal_the_library(spark, odd_docs):
    path = tokenizer("piece_bpe_32k.model")
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for docs in (odd_docs, docs_of(spark)):
        want = Counter((d.doc_id, tuple(sp.encode(d.text or "", add_bos=True, add_eos=True))) for d in docs.collect())
        rows = pieces.encode_pieces(docs, path, decode=True).collect()
        assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want and all(r.decoded == sp.decode(list(r.ids)) for r in rows)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé \n\t▁日 b<s>", max_size=40))
def test_pieces_of_any_text(text):
    p = pieces.Pieces.open(tokenizer("piece_bpe_32k.model"))
    assert p.cuts and p.encode(text).tolist() == p.sp.encode(text, add_bos=True, add_eos=True)


def test_code_lengths_equal_brute_force():
    random.seed(1)
    texts = [(random.choice("ab"), "".join(random.choice("xyzé ") for _ in range(random.randint(0, 60)))) for _ in range(30)]

    def bits(lang, text, order):
        seen = {}
        for name, x in texts:
            b = x.encode() if name == lang else b""
            for k in range(order + 1):
                for i in range(k, len(b)):
                    own = seen.setdefault(b[i - k : i], Counter())
                    own[b[i]] += 1
        b, total = text.encode(), 0.0
        for i in range(len(b)):
            for k in range(min(order, i), -1, -1):
                if (c := seen.get(b[i - k : i])) is None:
                    continue
                n, d = sum(c.values()), len(c)
                if b[i] in c:
                    total -= math.log2(c[b[i]] / (n + d))
                    break
                total -= math.log2(d / (n + d))
            else:
                total += 8
        return total

    queries = [x for _, x in texts] + ["", "q", "xyzq é", "\x00"]
    for order in (0, 1, 3):
        trees = langid.Trees.fit(texts, order, 1)
        got = trees.lengths(pa.array(queries), step=37)
        for i, q in enumerate(queries):
            for j, lang in enumerate(trees.langs):
                assert got[i, j] == pytest.approx(bits(lang, q, order), abs=1e-4)


def test_language_of_held_out_texts(spark, odd_docs):
    docs = docs_of(spark)
    out = langid.identify(docs, langid.train(docs, ~langid.held_out())).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out) > 0
    got = langid.identify(odd_docs, langid.train(docs, ~langid.held_out())).collect()
    assert len(got) == 13 and {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 9)} == {"und"} and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in langid.identify(odd_docs, langid.train(docs.limit(0), ~langid.held_out())).collect()} == {"und"}
    assert len(langid.sample(docs, 3, "doc_id", "text", "lang", docs.doc_id >= 0)) <= 12


def test_urls(spark):
    urls = [None, "", "no scheme/x", "http://", "HTTP://WWW.Example.ORG/es/1?q#f", "https://example.org/en/12", "https://example.org/en/2", "https://anexample.org/es/", "ftp://a.com/fr/", "x://com/de/", "x://b.com/DE/", "x://org?a/b", "x://h.org#/es/", "x://É.org/a b\n?c"] * 2
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    none = spark.createDataFrame([], "rule long, tokens array<string>, confidence double, support double")

    def judged(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, "allow")))

    for r in url_rules.judge(pages, none, url_rules.RULES).collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(urls[r.page_id])
    assert url_rules.judge(pages.limit(0), none, url_rules.RULES).count() == 0 and url_rules.judge(pages, none, []).count() == len(urls)


def test_mined_rules_equal_brute_force(spark):
    random.seed(2)
    rows = [(f"http://{h}.site.com/{p}/{random.randint(1, 9)}?{q}=1", h == "bad" and p == "spam") for h in ("bad", "good", "other") for p in ("spam", "news") for q in ("a", "b") for _ in range(6)]
    labelled = spark.createDataFrame([*rows, (None, True), ("http://x.com", None)], "url string, block boolean")
    rules = url_rules.mine(spark, labelled, 0.05, 0.9, 1).collect()
    tokens = {u: set(r.t) for u, r in ((r.url, r) for r in url_rules.parts(labelled.where("url is not null")).select("url", url_rules.url_tokens().alias("t")).collect())}
    from itertools import combinations

    # one token for all that occur in the same labelled urls
    where = lambda t: tuple(t in tokens[u] for u, _ in rows)
    first = {}
    for t in sorted({t for u, _ in rows for t in tokens[u]}):
        first.setdefault(where(t), t)
    kept = set(first.values())
    tokens = {u: ts & kept for u, ts in tokens.items()}
    suffixes = lambda t: {f"d:{'.'.join(t[2:].split('.')[i:])}" for i in range(t.count(".") + 1)} if t.startswith("d:") else {t}
    closed = lambda c: set().union(*map(suffixes, c))
    good = {}
    for k in (1, 2, 3):
        for c in {c for t in tokens.values() for c in combinations(sorted(t), k)}:
            hit = [b for u, b in rows if tokens[u] >= set(c)]
            if hit and sum(hit) / len(hit) >= 0.9 and sum(hit) / len(rows) >= 0.05:
                good[c] = sum(hit) / len(hit)
    want = {c for c, conf in good.items() if not any(o != c and set(o) <= closed(c) and oc >= conf for o, oc in good.items())}
    assert {tuple(r.tokens) for r in rules} == want
    pages = labelled.select("url").distinct()
    index = spark.createDataFrame(rules, "rule long, tokens array<string>, confidence double, support double")
    fired = {r.url for r in url_rules.fires(url_rules.parts(pages.where("url is not null")), index).collect()}
    assert fired == {u for u, t in tokens.items() if any(set(c) <= t for c in want)}
    assert url_rules.mine(spark, labelled.limit(0)).count() == 0


def test_mined_rules_of_many_tokens(spark):
    """Only five names together tell block: any four of them are as often allowed."""
    names = "abcde"
    rows = [(names, True)] * 12 + [(names.replace(x, ""), False) for x in names for _ in range(4)]
    labelled = spark.createDataFrame([(f"http://h.org/?{'&'.join(f'{x}=1' for x in q)}", b) for q, b in rows], "url string, block boolean")
    assert [r.tokens for r in url_rules.mine(spark, labelled, 0.05, 0.9).collect()] == [[f"q:{x}" for x in names]]


def test_itemsets_are_bounded_before_mining(spark):
    """Forty names that always come together are one item; thirty that do not are too many to list, and that is said."""
    together = "&".join(f"n{i}=1" for i in range(40))
    labelled = spark.createDataFrame([(f"http://h.org/{i}?{together}", True) for i in range(6)] + [(f"http://h.org/{i}", False) for i in range(9)], "url string, block boolean")
    assert [r.tokens for r in url_rules.mine(spark, labelled, 0.05, 0.9).collect()] == [["q:n0"]]
    rng = random.Random(1)
    apart = [(f"http://h.org/{i}?{'&'.join(f'n{k}=1' for k in range(30) if rng.random() < 0.9)}", True) for i in range(40)]
    with pytest.raises(ValueError, match="min_support"):
        url_rules.mine(spark, spark.createDataFrame(apart, "url string, block boolean"), 0.05, 0.9)


def _spans(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append([x for x, g in zip(w, gone) if not g])
    return out


@pytest.mark.parametrize("window", [1, 2, 5, 35])
def test_spans_equal_brute_force(spark, odd_docs, window):
    random.seed(window)
    passage = [[random.choice("abcdefgh") * random.randint(1, 4) for _ in range(60)] for _ in range(5)]
    texts = [r.text for r in odd_docs.collect()]
    for _ in range(60):
        parts = [random.choice(passage)[random.randint(0, 30) : random.randint(20, 60)] if random.random() < 0.5 else [random.choice("ijklmnopqrstuv") * random.randint(1, 9) for _ in range(random.randint(0, 40))] for _ in range(random.randint(0, 5))]
        texts.append(" ".join(w for p in parts for w in p))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(3)
    want = _spans(texts, window)
    for r in spans.repeated_spans(df, window=window).collect():
        kept = spans.kept_words(texts[r.doc_id], [s.asDict() for s in r.spans])
        assert kept == want[r.doc_id] and r.n_words == len((texts[r.doc_id] or "").encode().split()) and r.n_removed == r.n_words - len(kept)
    assert spans.repeated_spans(df.limit(0)).count() == 0 and spans.repeated_spans(odd_docs).count() == 13


def test_lines_equal_brute_force(spark, odd_docs):
    random.seed(9)
    common = [("Line number %d that is é long enough to count as one" % i) for i in range(6)]
    texts = {i: "\n".join(random.choice([f"  {c.upper() if random.random() < 0.5 and c.isascii() else c}\t", "short", "", f"own {i} " + "x" * 40]) for c in random.choices(common, k=random.randint(1, 6))) for i in range(40)}
    texts |= {100: None, 101: "", 102: "\n\n"}
    fold = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\r\x0b\x0c"))
    holders = defaultdict(set)
    for i, t in texts.items():
        for x in (t or "").split("\n"):
            holders[fold(x)].add(i)
    drop = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, n_lines int").repartition(3)
    assert drop
    for r in lines.line_dedup(df).collect():
        ls = (texts[r.doc_id] or "").split("\n")
        kept = [x for x in ls if drop.get(fold(x), r.doc_id) == r.doc_id]
        assert (r.n_lines, r.n_dropped) == (len(ls), len(ls) - len(kept)) and lines.kept_lines(texts[r.doc_id], r.keep_bits) == "\n".join(kept).encode()
    assert lines.line_dedup(df.limit(0)).count() == 0 and lines.line_dedup(odd_docs, carry=True).count() == 13


