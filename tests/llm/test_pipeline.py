"""The pipeline as a whole against a brute-force version of its stages."""

import random
import re
import zlib
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    random.seed(4)
    tongue = {x: [a + b + c for a in s[:5] for b in s[5:] for c in s[:3]] for x, s in (("aa", "kmtrsaeiou"), ("bb", "bdglnáéíóú"), ("cc", "fhjpvwxyzq"))}
    prose = lambda lang, n: "\n".join(" ".join(random.choices(tongue[lang], k=10)) for _ in range(n // 10))
    rows = [(i, prose(x, 80), x) for i, x in enumerate(random.choices(list(tongue), k=30))]
    common = "This line stands in many Documents and is long"
    for i in range(30, 37):
        rows.append((i, prose("aa", 60) + f"\n {common if i % 2 else common.upper()}\t\n" + prose("aa", 20), "aa"))
    rows += [(37, common, None), (38, f"{common}\n", "aa"), (90, f"{common}\nlast", "aa")]
    for i in (40, 41, 42):  # near and exact copies, in other letters and with other white space
        words = rows[i - 40][1].split(" ")
        if i > 40:
            words[20] = "other"
        rows.append((i, " ".join(words).upper() if i == 42 else "  ".join(words), rows[i - 40][2]))
    passage = prose("bb", 60).replace("\n", " ")
    rows += [(i, f"{prose('bb', 30)} {passage}  {prose('bb', 40)}", "bb") for i in (50, 51, 52)] + [(53, passage, "bb")]
    rows += [(60, None, "aa"), (61, "", None), (62, " \t\n", None), (63, "12 34 !?", "aa"), (64, "日本語漢字仮名交文" * 9, None), (65, "one", None)]
    rows += [rows[7]] * 2 + [(8, prose("cc", 90), None), (None, prose("aa", 90), "aa"), (None, prose("cc", 70), None), (None, rows[3][1], "bb"), (70, "mkat " * 9000, None)]
    return [(i, t, x, None if i == 5 else "s", None if i == 6 else len(t or ""), "r") for i, t, x in rows]


def rewritten(row, text):
    return (row[0], text, row[2], row[3], len(text), row[5])


def by_language(rows):
    learnt = [(x, t.encode()) for i, t, x, *_ in rows if i is not None and t is not None and x is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    seen = defaultdict(lambda: defaultdict(Counter))
    for x, t in learnt:
        for k in range(5):
            for i in range(k, len(t)):
                seen[t[i - k : i]][x][t[i]] += 1
    deep = {c: v for c, v in seen.items() if not c or sum(sum(n.values()) for n in v.values()) >= 3}

    def bits(x, t):
        total = 0.0
        for i in range(len(t)):
            for k in range(min(4, i), -1, -1):
                if not (own := deep.get(t[i - k : i], {}).get(x)):
                    continue
                n, kinds = own.total(), len(own)
                if t[i] in own:
                    total -= log2(own[t[i]] / (n + kinds))
                    break
                total -= log2(kinds / (n + kinds))
            else:
                total += 8
        return total

    langs = {x for x, _ in learnt}
    return [r for r in rows if r[1] and any(map(str.isalpha, r[1])) and min(bits(x, r[1].encode()) for x in langs) < 8 * len(r[1].encode())]


def by_line(rows):
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").encode().lower().decode()
    holders = defaultdict(set)
    for r in rows:
        for x in r[1].split("\n"):
            holders[key(x)].add(-1 if r[0] is None else r[0])
    keeper = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    out = [rewritten(r, "\n".join(x for x in r[1].split("\n") if keeper.get(key(x), r[0]) == r[0])) for r in rows]
    return [r for r in out if WORD.search(r[1])]


def by_jaccard(rows):
    words = [[w.encode().lower() for w in WORD.findall(r[1])] for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in words]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and len(a & b) * 100 >= len(a | b) * 80:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for r, g in zip(rows, group):
        if g not in best or (r[0] is None, r[0] or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = r
    return list(best.values())


def by_span(rows):
    words = [WORD.findall(r[1]) for r in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for r, w in zip(rows, words):
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        begins = [m.start() for m in WORD.finditer(r[1])] + [len(r[1])]
        out.append(rewritten(r, r[1][: begins[0]] + "".join(r[1][a:b] for i, (a, b) in enumerate(zip(begins, begins[1:])) if i not in gone)))
    return [r for r in out if WORD.search(r[1])]


def test_every_stage_equals_brute_force(spark, tmp_path, monkeypatch):
    tokenizers, path = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    rows, given = corpus(), []
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))

    def spied(stage):
        def run(spark, docs, sf_dir):
            given.append((docs.columns, Counter(map(tuple, docs.collect()))))
            return stage(spark, docs, sf_dir)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, spied(f)) for name, f in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for (columns, got), brute in zip(given, (None, by_language, by_line, by_jaccard, by_span)):
        before = len(rows)
        rows = brute(rows) if brute else rows
        assert columns == names and got == Counter(rows), brute
        assert not brute or len(rows) < before

    t = tokenizers.Tokenizer.from_file(path)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in packed:
        pieces[p.doc_id, p.doc_tokens].append(p)
        sequences[p.sequence_id].append(p)
    got = Counter((doc, b"".join(bytes(p.ids) for p in sorted(ps, key=lambda p: p.start))) for (doc, _), ps in pieces.items())
    assert got == Counter((r[0], np.array([*t.encode(r[1], add_special_tokens=False).ids, 0], dtype="<u4").tobytes()) for r in rows)
    for ps in sequences.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == np.cumsum([0, *(p.length for p in ps)])[:-1].tolist() and sum(p.length for p in ps) <= 1024


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
