"""Every opN_ query itself, on whole small tables: against its SQL where it has one, else against its contract."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cairn.llm import media, url_rules
from cairn.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages labels benchmark conversations".split()
SCHEMAS = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "embeddings": "vec_id long, embedding array<float>, label int", "pages": "page_id long, url string, html string"}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables of nulls, empty and long texts, ties and repeated rows."""
    base = tmp_path_factory.mktemp("odd")
    line = "this line is long enough to be a key of its own here"
    passage = " ".join(f"word{i}" for i in range(60))
    texts = [None, "", " \t\n", "One", "one two", "x" * 30_000, "é ü\x00 日本 ▁ <s> " * 90, f"A {passage} b", f"c d {passage}", passage, passage, passage.upper()]
    texts += [f"{line}\n{i} {line.upper()}\nown text number {i}" for i in range(7)] + [f"{passage} {passage}"]
    docs = [(i, t, None if i % 5 == 0 else "en" if i % 2 else "de", "s", len(t or "")) for i, t in enumerate(texts)]
    vecs = [[1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [2.0, 0.0, 0.0], [0.0, 1.0, 0.0], None, [], [0.0, 0.0, 0.0], [None, 1.0, 0.0], [float("nan"), 1.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 0.0], [-1.0, 0.0, 0.0]]
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?q#f", "https://example.org/en/12", "https://anexample.org/es/", "ftp://a.com/fr/", "x://b.com/DE/", "x://org?a/b", "x://h.org#/es/"]
    urls += [f"http://h{i}.com/de/{i}" for i in range(9)] + [f"http://h{i}.com/fr/{i}" for i in range(9)] + ["http://n.net/de/1"]
    rows = {"documents": docs, "embeddings": [(i, v, 0) for i, v in enumerate(vecs)], "pages": [(i, u, "") for i, u in enumerate(urls * 2)]}
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).repartition(3).write.parquet(str(base / f"{name}.parquet"))
    return str(base)


def rows_of(path, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{path}{'/*.parquet' if not path.startswith(DIR) else ''}'").fetchall()


def texts_of(d):
    return {i: t or "" for i, t in rows_of(f"{d}/documents.parquet", "doc_id, text")}


@pytest.mark.parametrize("where", ["small", "odd"])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, odd, name, where):
    d = DIR if where == "small" else odd
    c = duckdb.connect()
    for t in TABLES if where == "small" else SCHEMAS:
        c.execute(f"create view {t} as select * from '{d}/{t}.parquet{'/*.parquet' * (where == 'odd')}'")
    df = QUERIES[name](spark, d)
    cur = c.execute(ORACLE_SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(map(str, r)) for r in df.select(*names).collect()) == Counter(tuple(map(str, r)) for r in cur.fetchall())


@pytest.mark.parametrize("where", ["small", "odd"])
def test_op1(spark, odd, where):
    t = pytest.importorskip("tokenizers").Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    d = DIR if where == "small" else odd
    want = {i: np.array([*t.encode(x, add_special_tokens=False).ids, 0], dtype="<u4") for i, x in texts_of(d).items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in QUERIES["op1_packing"](spark, d).collect():
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for i, ids in want.items():
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist() and sum(r.length for r in parts) == len(ids) == parts[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in parts)
    for s in by_seq.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0, *(r.length for r in s)])[:-1].tolist() and sum(r.length for r in s) <= 1024


@pytest.mark.parametrize("where", ["small", "odd"])
def test_op2(spark, odd, where):
    d = DIR if where == "small" else odd
    texts = texts_of(d)
    got = {r.doc_id: r for r in QUERIES["op2_media_columns"](spark, d).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        data = t.encode()
        payload = data + b" " * (max(1, -(-len(data) // 192)) * 192 - len(data))
        stored = media.mux(payload)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest()) and r.feature


@pytest.mark.parametrize("where", ["small", "odd"])
def test_op5(spark, odd, where):
    from test_llm_operators import _kneser_ney

    from cairn.llm.ngram_lm import ORDER

    d = DIR if where == "small" else odd
    texts = texts_of(d)
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    want = dict(zip(texts, _kneser_ney([t for i, t in texts.items() if not held[i]], texts.values(), ORDER)))
    got = QUERIES["op5_lm_scoring"](spark, d).collect()
    assert {r.doc_id for r in got} == set(texts) and any(held.values())
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], *w[:3])
        assert r.base_score == pytest.approx(w[3], rel=1e-9) and r.score == pytest.approx(w[4], rel=1e-6)


@pytest.mark.parametrize("where", ["small", "odd"])
def test_op6(spark, odd, where):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model"))
    d = DIR if where == "small" else odd
    want = set()
    for i, t in texts_of(d).items():
        ids = sp.encode(t, add_bos=True, add_eos=True)
        want.add((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op6_sentencepiece"](spark, d).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want


@pytest.mark.parametrize("where", ["small", "odd"])
def test_op7(spark, odd, where):
    d = DIR if where == "small" else odd
    rows = {i: (t, x) for i, t, x in rows_of(f"{d}/documents.parquet", "doc_id, text, lang")}
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, d).collect()}
    learnt = {x for i, (t, x) in rows.items() if x and zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(got) == set(rows)
    for i, (t, _) in rows.items():
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1
        assert (got[i].lang_pred == "und") == (t is None or not any(map(str.isalpha, t))) and got[i].lang_pred in learnt | {"und"}
    held = [i for i in rows if got[i].held_out and rows[i][1] and got[i].lang_pred != "und"]
    assert where == "odd" or sum(got[i].lang_pred == rows[i][1] for i in held) >= 0.97 * len(held) > 0


def test_op8_mines_rules_that_decide(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    mined = url_rules.mine(spark, url_rules.ruled(pages, url_rules.RULES))
    assert mined.count() > 0
    out = QUERIES["op8_url_filter"](spark, "/root/testdata/sf0.01")
    assert out.where("rule is null and verdict = 'block'").count() > 0
    held = url_rules.parts(pages.select("url")).where(url_rules.held_out()).distinct()
    fired = url_rules.fires(held, mined).join(url_rules.explicit(held, url_rules.RULES), "url").select("rule_verdict").collect()
    assert fired and all(r.rule_verdict == "block" for r in fired)


@pytest.mark.parametrize("name", ["op3_embedding_dedup", "op8_url_filter", "op2_media_columns"])
def test_nulls_repeats_and_names_that_clash(spark, tmp_path, name):
    """Ids that are null or repeat, and columns named like those the operators make."""
    if name == "op3_embedding_dedup":
        rows = [(i, [1.0, 0.0, 0.1 * (i or 0)], "n", 1, 2, 3) for i in (None, 1, 1, 2, 2)] + [(None, None, "n", 1, 2, 3)]
        table, schema = "embeddings", "vec_id long, embedding array<double>, num string, cid int, h1 int, vec int"
    elif name == "op8_url_filter":
        rows = [(i, u, "x", "y", "z") for i in (None, 1, 1) for u in (None, "http://a.com/de/", "http://a.com/de/", "x")]
        table, schema = "pages", "page_id long, url string, host string, verdict string, _key string"
    else:
        rows = [(i, t, "m", "p", 5, "r") for i in (None, 1, 1) for t in (None, "a", "a b")]
        table, schema = "documents", "doc_id long, text string, media string, payload string, n_bytes int, row string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    got = QUERIES[name](spark, str(tmp_path)).collect()
    assert Counter(r[0] for r in got) == Counter(r[0] for r in rows)
    if name == "op3_embedding_dedup":
        assert {r.component_id for r in got if r.n_links} == {1} and sum(r.n_links == 0 for r in got) == 1
    if name == "op8_url_filter":
        assert Counter(r.verdict for r in got) == {"allow": 6, "block": 6}
    if name == "op2_media_columns":
        assert len({(r.n_bytes, r.media_sha256) for r in got}) == 3
