"""Pipeline stages: operators whose decisions take effect on documents.

Every stage but packing returns the columns of its input, in their order; text is replaced by what stays and
n_chars, where there is one, by its length.  A document that a stage leaves without any text goes.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import jaccard, langid, lines, packing, spans
from cairn.llm.common import (
    Store,
    digests,
    durable,
    framed,
    get_file,
    new_path,
    out_schema,
    slices,
    with_row,
    write_store,
)

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FOREIGN = 8.0


def language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language: no text, no letter, or a code of ``FOREIGN`` bits a byte and more under
    every language learnt (8: no shorter than the bytes themselves).  With no language to learn from, only the former go."""
    model = langid.train(docs, ~langid.held_out())
    seen = langid.identify(docs, model, carry=True)
    if json.loads(get_file(f"{model}/meta.json"))["langs"]:
        return seen.where((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < FOREIGN)).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
    return docs.where(F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)))


def _replaced(docs: DataFrame, judged: DataFrame, decision: str, cut) -> DataFrame:
    """Gives every row the text that ``cut(text bytes, decision)`` leaves; None leaves the text as it is."""
    names = docs.columns
    flat = judged.select(*(F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(names)), F.col(decision).alias("_cut"))
    at = names.index("text")

    def run(batches):
        for batch in batches:
            for b in slices(batch, f"c{at}"):
                new = []
                for t, d in zip(b.column(at), b.column(len(names))):
                    left = cut((t.as_py() or "").encode("utf-8"), d.as_py())
                    new.append(t.as_py() if left is None else left.decode("utf-8"))
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == at else b.column(i) for i in range(len(names))], names=[f"c{i}" for i in range(len(names))])

    schema = flat.drop("_cut").schema
    out = flat.mapInArrow(run, schema).toDF(*names)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.where(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).select(*names)


def line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines that many documents hold (``lines``: all but the largest id lose them); documents left without
    a word go.  Null and empty texts have no word, so they go; a null id counts as one document smaller than all others;
    rows that repeat stay or lose lines alike; columns besides id and text pass through; an empty table stays empty."""
    judged = lines.line_dedup(docs, carry=True)

    def cut(text: bytes, bits: bytes):
        left = lines.kept_lines_of(text, bits)
        return None if len(left) == len(text) else left

    return _replaced(docs, judged, "keep_bits", cut)


def near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the least id (null ids last; among texts of one
    id, by their hash).  Rows with one id and text are one document (any one of them stays).  Ids need not tell rows apart.

    The keep list - the text's 128 bits, the id, how many rows have both - goes back to the documents as sorted arrays, so
    no text is shuffled, but for those of rows that repeat in both.  Texts without words are groups of their own;
    columns besides id and text pass through, whatever their names; an empty table stays empty."""
    found = jaccard.jaccard_components(docs, keys=True).where("group is not null")
    same = found.groupBy("group", "doc_id", "text_high", "text_low").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_high", "text_low", "n")
    kept = durable(same.groupBy("group").agg(F.min(order).alias("k")).select("k.*").withColumns({"none": F.col("none").cast("int"), "doc_id": F.coalesce("doc_id", F.lit(0))}), "kept")
    path = new_path(spark, "kept-texts")
    write_store(kept, "text_high", {"n": "int64", "none": "int8", "doc_id": "int64"}, path, low="text_low")
    frame = framed(docs, "doc_id", "text", True)

    def judge(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                ids, texts = part.column(0), [(t.as_py() or "").encode("utf-8") for t in part.column(1)]
                high, low = digests(texts)
                rank, n, none, doc = Store.open(path).find(high, "n", "none", "doc_id", low=low)
                null, own = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                keep = (rank >= 0) & (none == null) & (doc == own)
                bare = np.array([not WORD.search(t) for t in texts], dtype=bool)  # no words, no group
                rows = with_row(part, {"again": pa.array(bare | (n > 1))})
                yield rows.filter(pa.array(keep | bare))

    judged = frame.mapInArrow(judge, out_schema(frame, "again boolean"))
    plain = lambda df: df.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
    bare = F.coalesce(~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(True))
    if kept.where("n > 1").isEmpty() and docs.where(bare).isEmpty():
        return plain(judged)
    return plain(judged.where("not again")).union(plain(judged.where("again")).dropDuplicates(["doc_id", "text"]).select(*docs.columns))


def without_spans(text: bytes, cuts: list[dict]) -> bytes | None:
    """The text without the words of the spans and the white space that follows them."""
    if not cuts:
        return None
    begins = [m.start() for m in WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for c in cuts:
        out.append(text[at : begins[c["begin"]]])
        at = begins[c["end"]]
    return b"".join([*out, text[at:]])


def repeated_spans(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every passage of 35 words or more that occurs twice (``spans``) with the white space after it; documents
    left without a word go, so of rows that repeat none stays.  Null and empty texts have no word, so they go; ids may be
    null or repeat; columns besides text pass through; an empty table stays empty."""
    return _replaced(docs, spans.repeated_spans(docs, carry=True), "spans", without_spans)


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 1024 tokens (``packing``): one row a piece, not a document.  A null
    or empty text is its end id alone; ids may be null or repeat; other columns are ignored; an empty table gives none."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
