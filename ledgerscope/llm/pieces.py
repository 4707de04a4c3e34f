"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary holds a whitespace marker after another character (checked when the
model is loaded), so merges never cross the place before a marker, and a marked word is
segmented alike wherever it stands. Each task keeps a table of the distinct marked words it has
met, segments a new word once, and joins the ids back by position; no word leaves its task.
The table is emptied when it holds ``TABLE_CHARS`` characters, which costs time, never rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_batches, text_bytes

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")

#: characters a task's table may hold, and the longest chunk that enters it
TABLE_CHARS = 8_000_000
LONG_CHUNK = 256


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, found where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceTable:
    """Encodes and decodes like the library, segmenting each distinct marked word once."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        normal = [not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)) for i in range(n)]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p, ok in zip(pieces, normal, strict=True) if ok):
            raise ValueError("a piece crosses a whitespace marker: chunks are not independent")
        if self.library.encode(" ") != [self.library.piece_to_id(MARK * 2)] or self.library.encode("½ a") == self.library.encode("1/2 a"):
            raise ValueError("the model normalises texts; chunks cannot be cut from the source text")
        self.mark = self.library.piece_to_id(MARK)
        self.end = self.library.eos_id()
        self.opens = np.array([ok and p.startswith(MARK) for p, ok in zip(pieces, normal, strict=True)])
        self.ids: dict[str, np.ndarray] = {}
        self.texts: dict[bytes, str] = {}
        self.held = [0, 0]

    def _segment(self, chunks: list[str]) -> list[np.ndarray]:
        # the library puts one marker before a text itself, but none before an empty one
        found = self.library.encode([c[1:] for c in chunks], num_threads=1)
        return [np.array(ids if c != MARK else [self.mark], dtype=np.int32) for c, ids in zip(chunks, found, strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without begin or end ids."""
        split = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if self.held[0] > TABLE_CHARS:
            self.ids, self.held[0] = {}, 0
        new = list(set().union(*split).difference(self.ids)) if split else []
        known = self.ids
        if new:
            found = dict(zip(new, self._segment(new), strict=True))
            kept = {c: i for c, i in found.items() if len(c) <= LONG_CHUNK}
            self.ids.update(kept)
            self.held[0] += sum(map(len, kept))
            if len(kept) < len(found):
                known = {**self.ids, **found}
        none = np.empty(0, dtype=np.int32)
        return [np.concatenate([known[c] for c in chunks]) if chunks else none for chunks in split]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The library's decode(ids) of each id sequence."""
        if self.held[1] > TABLE_CHARS:
            self.texts, self.held[1] = {}, 0
        out = []
        for seq in ids:
            seq = np.ascontiguousarray(seq, dtype=np.int32)
            starts = np.flatnonzero(self.opens[seq])
            if not len(starts) or starts[0] != 0:
                # no leading marker to count from: leave the whole sequence to the library
                out.append(self.library.decode(seq.tolist()))
                continue
            raw, edges = seq.tobytes(), [*(starts * 4).tolist(), len(seq) * 4]
            chunks = [raw[a:b] for a, b in zip(edges, edges[1:])]
            words = []
            for c in chunks:
                w = self.texts.get(c)
                if w is None:
                    w = self.library.decode(np.frombuffer(c, dtype=np.int32).tolist())
                    if len(c) <= 4 * LONG_CHUNK:
                        self.texts[c] = w
                        self.held[1] += len(w) + len(c)
                words.append(w)
            # decode drops the first marker of what it is given: here the space between chunks
            out.append(" ".join(words))
        return out


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))


def round_trip(docs: DataFrame, model: str = "piece_bpe_32k.model", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string``: ids with an end id, and decode(ids).

    A null text counts as empty: its ids are the end id alone and it decodes to the empty text.
    Every row gives one row, repeated rows and null ids included; other columns are ignored.
    """

    def setup():
        pieces = PieceTable(tokenizer_file(model))
        end = np.array([pieces.end], dtype=np.int32)

        def work(keys, texts):
            ids = [np.concatenate([x, end]) for x in pieces.encode([t.decode() for t in texts])]
            return keys, _lists(ids), pieces.decode(ids)

        return work

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text)), setup, "doc_id long, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``round_trip``'s rows."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
