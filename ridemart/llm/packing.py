"""Operator 4, concatenate and cut.

Pass 1 tokenizes every document once, notes where it starts within its partition and writes ids to
shared storage. Prefix sums over the partitions' totals (one small row per partition) turn that into
global offsets. Pass 2 cuts the endless stream into windows of ``length`` ids and emits one boundary
record per piece. Only the very last sequence can need padding.

Defined results: a null or empty text is its end id alone; repeated rows are packed once each; an
empty table gives no pieces; a null id is kept; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm.common import LOWER, chunks, read_table, stored

#: Words remembered per Python worker with their ids; beyond it the memory starts anew (results don't
#: change).
REMEMBERED = 1_000_000
_LATIN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"
_WORD = re.compile(f"{_LATIN}+")
#: Words of Latin letters, each with at most one comma or full stop, between spaces and line ends.
_PLAIN = re.compile(f"[ \\n]*+(?:{_LATIN}++[.,]?[ \\n]++)*+(?:{_LATIN}++[.,]?)?")
_MARKS = b".,!?;:|%$&*#)\"-"


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable bytes stand for themselves, the others for the
    characters from 256 on."""
    out, after = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b] = chr(after)
            after += 1
    return out


class WordTokenizer:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)`` for a lower-casing
    byte-level BPE file with word ends, which never joins characters across ASCII white space.

    A text is split there and each different word is encoded once. Words of Latin letters, less marks
    that follow them (a piece of their own), go to the BPE model directly; other words go through the
    whole tokenizer. Texts that hold the string of a special token are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}

    def _bytes(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _find(self, word: bytes) -> bytes:
        """Ids of a run of characters without ASCII white space."""
        text = word.decode()
        if _WORD.fullmatch(text):
            text = text.lower()
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.letters)
            ids = self._bytes([t.id for t in self.tokenizer.model.tokenize(text)])
        elif len(core := word.rstrip(_MARKS)) < len(word) and _WORD.fullmatch(core.decode()):
            ids = self._ids(core) + self._ids(word[len(core):])
        else:
            ids = self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self.known[word] = ids
        return ids

    def _ids(self, word: bytes) -> bytes:
        ids = self.known.get(word)
        return self._find(word) if ids is None else ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text, ``dtype`` wide."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        get, out = self.known.get, []
        for t in texts:
            if any(s in t for s in self.special):
                out.append(self._bytes(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids))
                continue
            if _PLAIN.fullmatch(t.decode()):  # here letter case and single marks never change a piece
                t = t.translate(LOWER).replace(b",", b" ,").replace(b".", b" .")
            words = t.split()
            ids = list(map(get, words))
            if None in ids:
                ids = [self._ids(w) if i is None else i for i, w in zip(ids, words)]
            out.append(b"".join(ids))
        return out


@cache
def coder(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker, kept between its tasks."""
    return WordTokenizer(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(part, local_start, doc_id, n, ids): ids as little-endian bytes, of ``width`` bytes each."""
    schema = "part int, local_start long, doc_id long, n long, width int, ids binary"

    def run(batches):
        encoder, part, at = coder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        for b in batches:
            done, ids = 0, b.column(0).cast(pa.int64())
            for texts in chunks(b.column(1).cast(pa.string()), 1 << 18):
                codes = [x + end for x in encoder.encode(texts)]
                n = np.array([len(x) // width for x in codes], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(starts), ids.slice(done, len(n)),
                     pa.array(n), pa.array(np.full(len(n), width, np.int32)), pa.array(codes, pa.binary())],
                    names=["part", "local_start", "doc_id", "n", "width", "ids"])
                done += len(n)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, schema))


PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, length: int = 2048, tokenizer: str | None = None, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Boundary records, one per piece: doc_id, start (ids of the document before it), length,
    ids_crc32, doc_tokens, sequence_id, offset (place in its sequence); with_ids adds ``ids``
    (array of int)."""
    rows = stored(tokenized(docs, tokenizer or default_tokenizer(), end_id, id_col, text_col), "pack-ids")
    totals = rows.groupBy("part").agg(F.max(F.col("local_start") + F.col("n")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per input partition of pass 1, 12 bytes each: small whatever the rows hold
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("local_start") + F.col("base")).alias("at"), "width", "ids")
    fields = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long")

    def cut(batches):
        for b in batches:
            out: list[tuple] = []
            pieces: list[np.ndarray] = []
            for doc, at, width, raw in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                n, p = len(ids), 0
                while p < n:
                    seq, off = divmod(at + p, length)
                    k = min(n - p, length - off)
                    piece = ids[p:p + k]
                    out.append((doc, p, k, zlib.crc32(piece.tobytes()), n, seq, off))
                    if with_ids:
                        pieces.append(piece.astype(np.int32))
                    p += k
            cols = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 7
            if with_ids:
                cols.append(pa.array(pieces, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=PIECES + ["ids"] * with_ids)

    return placed.mapInArrow(cut, fields + ", ids array<int>" * with_ids)


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, starts): whole sequences, padded, from pieces with ids. A sequence has at
    most ``length`` pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start")))
    ids = F.flatten(F.col("p.ids"))
    return (pieces.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(length) - F.size(ids)))
                    .alias("ids"), F.col("p.offset").alias("starts")))


def op4_concat_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents")).select(*PIECES)
