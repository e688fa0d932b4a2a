"""SentencePiece encoding and decoding with a distinct-chunk table.

No piece of the vocabulary has a white-space marker after another character, so no piece spans the place
where a marker follows something else.  A text is cut there into marked words, each distinct marked word is
segmented once, and the ids are joined back by position.  The table is a worker's own and is begun
anew at ``TABLE`` entries: it never grows with the corpus, and no word is shuffled.

``Pieces`` checks the vocabulary when it opens a model; where a piece does span such a place it encodes
whole texts instead, so results equal the library's for any model.

Defined cases: a null or empty text has only the begin and end ids; ids may be null or repeat; columns besides
id and text are ignored, or kept in ``row``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairn.llm.common import framed, out_schema, slices, with_row

MARK = "▁"
TABLE = 300_000
LONG = 256
_open: dict[str, Pieces] = {}


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        vocabulary = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        probe = "a  b é\tc\n d  "
        plain = self.sp.decode(self.sp.encode(probe)) == probe  # no normalization, no white space dropped
        self.cuts = plain and not any(MARK in p.lstrip(MARK) for p in vocabulary) and self.sp.encode(" a") != self.sp.encode("a")
        self.table: dict[str, np.ndarray] = {}
        self.ends = np.array([self.sp.bos_id()]), np.array([self.sp.eos_id()])

    @classmethod
    def open(cls, path: str) -> Pieces:
        if path not in _open:
            _open[path] = cls(path)
        return _open[path]

    #: A marked word: markers (spaces), then what follows up to the next marker.
    WORD = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")

    def encode(self, text: str) -> np.ndarray:
        """Ids with begin and end ids, as the library gives them."""
        if not self.cuts:
            return np.array(self.sp.encode(text, add_bos=True, add_eos=True), dtype=np.int64)
        if not text:
            return np.concatenate(self.ends)
        words = self.WORD.findall(" " + text)  # the library's own marker at the front
        table = self.table
        new = [w for w in dict.fromkeys(words) if w not in table]
        if new:
            if len(table) + len(new) > TABLE:
                table.clear()
                new = list(dict.fromkeys(words))
            # the library puts one marker in front itself
            ids = self.sp.encode([w[1:] for w in new], num_threads=1)
            table.update(zip(new, (np.array(x, dtype=np.uint32) for x in ids)))
            for w in (" ", MARK):  # a marker with nothing after it; the library gives an empty text no marker
                if w in table:
                    table[w] = np.array([self.sp.piece_to_id(MARK)], dtype=np.uint32)
        out = np.concatenate([self.ends[0], *map(table.__getitem__, words), self.ends[1]])
        if any(len(w) > LONG for w in new):  # what is long is seldom seen again
            for w in new:
                if len(w) > LONG:
                    table.pop(w, None)
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.sp.decode(ids.tolist())


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, carry: bool = False) -> DataFrame:
    """doc_id, ids (array of int, begin and end included), with ``decode`` the decoded text, with ``carry`` row."""
    frame = framed(docs, id_col, text_col, carry)

    def run(batches):
        pieces = Pieces.open(model)
        for batch in batches:
            for part in slices(batch, "_text"):
                ids = [pieces.encode(t.as_py() or "") for t in part.column(1)]
                offsets = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                arrays = {"doc_id": part.column(0), "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))}
                if decode:
                    arrays["decoded"] = pa.array(map(pieces.decode, ids), pa.string())
                yield with_row(part, arrays, text_col)

    return frame.mapInArrow(run, out_schema(frame, "doc_id long, ids array<int>" + ", decoded string" * decode, text_col))


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), decode=True)

    def digest(batches):
        for b in batches:
            ids = b.column("ids")
            offsets = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().astype("<u4")
            sha = [hashlib.sha256(flat[lo:hi].tobytes()).hexdigest() for lo, hi in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(sha, pa.string()), b.column("decoded")], names=["doc_id", "n_tokens", "ids_sha256", "decoded"])

    out = coded.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded string")
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
