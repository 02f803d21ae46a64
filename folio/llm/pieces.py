"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The text gets a space in front and spaces become U+2581. At each end position the automaton gives all pieces that end
there, along its output links, and each relaxes the best score of that position. A character that no piece equals
costs the least score less UNKNOWN and is written as byte pieces; so is a U+2581 of the text itself, which makes the
round trip exact for every text. Ties go to the longest last piece.

The segmentation is the best sum of the model's scores. For a model of type BPE, whose scores are merge ranks, that is
not always the order of merges that other encoders follow; both decode to the same text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = 10.0
_MARK = "▁"
_RUNS = re.compile(r" *[^ ]+| +")
_MEMO = 200_000


class Pieces:
    """A tokenizer from the bytes of a SentencePiece model; picklable, built once in each process."""

    def __init__(self, model: bytes) -> None:
        self.model = model
        self._ready = False

    def __reduce__(self) -> tuple:
        return Pieces, (self.model,)

    def _build(self) -> None:
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.automaton, self.single, self.bytes_at, self.text_of = ahocorasick.Automaton(), set(), {}, []
        crossing = False
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_at[int(p[1:-1], 16)] = i
                self.text_of.append(bytes([int(p[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text_of.append(b"")
            else:
                self.automaton.add_word(p, (len(p), sp.get_score(i), i))
                self.text_of.append(p.replace(_MARK, " ").encode())
                crossing |= _MARK in p.lstrip(_MARK)
                if len(p) == 1:
                    self.single.add(p)
        if len(self.bytes_at) < 256:
            raise ValueError("the model has no byte pieces")
        self.automaton.make_automaton()
        self.unknown = min(sp.get_score(i) for i in range(sp.get_piece_size())) - UNKNOWN
        # Unless a piece has a space behind another character, words can be segmented one by one, and kept.
        self.whole, self.memo, self._ready = crossing, {}, True

    def _segment(self, text: str) -> bytes:
        """Ids, as int32, of a text whose spaces are still spaces."""
        s = text.replace(" ", _MARK)
        n = len(s)
        best, start, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0], at, single, unknown = 0.0, 0, self.single, self.unknown
        for end, (size, score, i) in self.automaton.iter(s):
            while at <= end:
                if s[at] not in single:
                    best[at + 1], start[at + 1] = best[at] + unknown, at
                at += 1
            a, e = end + 1 - size, end + 1
            if best[a] + score > best[e]:
                best[e], start[e], piece[e] = best[a] + score, a, i
        while at < n:
            if s[at] not in single:
                best[at + 1], start[at + 1] = best[at] + unknown, at
            at += 1
        out, e = [], n
        while e:
            if piece[e] >= 0:
                out.append(piece[e])
            else:
                out.extend(self.bytes_at[b] for b in reversed(s[e - 1].encode("utf-8", "surrogatepass")))
            e = start[e]
        out.reverse()
        return array("i", out).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids as int32."""
        if not self._ready:
            self._build()
        if not text:
            return np.zeros(0, np.int32)
        # A U+2581 of the text is no space, so no piece reaches over it.
        mark = array("i", [self.bytes_at[b] for b in _MARK.encode()]).tobytes()
        return np.frombuffer(mark.join(map(self._units, f" {text}".split(_MARK))), np.int32)

    def _units(self, text: str) -> bytes:
        if self.whole:
            return self._segment(text)
        memo, out = self.memo, []
        for unit in _RUNS.findall(text):
            ids = memo.get(unit)
            if ids is None:
                ids = self._segment(unit)
                if len(unit) <= 64:
                    if len(memo) >= _MEMO:
                        memo.clear()
                    memo[unit] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        if not self._ready:
            self._build()
        return b"".join(map(self.text_of.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


def load(path: str = MODEL) -> Pieces:
    """Reads the model (a vocabulary file, some hundred kilobytes) on the driver; tasks get its bytes with their code."""
    return Pieces(Path(path).read_bytes())


def encoded(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of each row: the whole text's ids, and whether they decode to it.

    Null and empty texts have no ids and decode to the empty text. An empty table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [t.as_py() or "" for t in part.column(1)]
                ids = [pieces.encode(t) for t in texts]
                sizes = np.array([len(i) for i in ids], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32)), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
                same = pa.array([pieces.decode(i) == t for i, t in zip(ids, texts, strict=True)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), lists, same], ["doc_id", "n_tokens", "ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decoded(tokens: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if i.as_py() is None else pieces.decode(np.array(i.as_py(), np.int32)) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
