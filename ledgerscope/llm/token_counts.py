"""Token counts of whole texts, huge ones by overlapping chunks that are spliced.

A huge text is cut into overlapping chunks; each is encoded with token offsets. Two encodings are
spliced at an offset inside the overlap that is (a) a token boundary in both and (b) proven
stable: no piece of the vocabulary contains the two characters around it, so no merge can ever
cross it, whatever stands on either side. If an overlap has no such offset it is widened, at
last to the whole chunk, and then the chunk itself grows: the count is always the library's
count of the whole text.
"""

from __future__ import annotations

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_batches, text_bytes
from ledgerscope.llm.pieces import MARK, tokenizer_file

#: characters of a chunk and of an overlap; a text of at most one chunk is encoded whole
CHUNK, OVERLAP = 16_384, 256


class Resync:
    def __init__(self, model_file: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.chunk, self.overlap = chunk, overlap
        self.width = np.zeros(lib.get_piece_size(), dtype=np.int64)
        self.inside: set[str] = set()
        for i in range(lib.get_piece_size()):
            if lib.is_byte(i):
                # a character outside the vocabulary is its UTF-8 bytes: count the leading one
                self.width[i] = not 0x80 <= int(lib.id_to_piece(i)[3:5], 16) < 0xC0
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                piece = lib.id_to_piece(i)
                self.width[i] = len(piece)
                self.inside.update(a + b for a, b in zip(piece, piece[1:]))

    def _ends(self, text: str) -> np.ndarray:
        """End offset of each token in ``text``."""
        ids = np.array(self.library.encode(text), dtype=np.int64)
        return np.cumsum(self.width[ids]) - 1  # the marker that the library puts first

    def _splice(self, text: str, low: int, high: int, left: np.ndarray, right: np.ndarray) -> int | None:
        """The last common stable boundary strictly between ``low`` and ``high``, or None."""
        common = np.intersect1d(left, right)
        for at in common[(common > low) & (common < high)][::-1].tolist():
            if text[at - 1 : at + 1].replace(" ", MARK) not in self.inside:
                return at
        return None

    def count(self, text: str) -> int:
        n = len(text)
        if n <= self.chunk:
            return len(self.library.encode(text))
        total, start, stop = 0, -1, self.chunk  # tokens that end at ``start`` or before are counted
        begin = 0  # where the chunk in hand begins; at most ``start``
        ends = self._ends(text[:stop])
        while stop < n:
            overlap, at = self.overlap, None
            while at is None and stop - overlap > start:
                next_begin, next_stop = stop - overlap, min(n, stop - overlap + self.chunk)
                if next_stop <= stop:
                    next_stop = min(n, stop + self.chunk)
                right = self._ends(text[next_begin:next_stop]) + next_begin
                at = self._splice(text, max(start, next_begin), stop, ends, right)
                overlap *= 2
            if at is None:
                # no stable place in the whole chunk: encode a longer one from the same begin
                stop = min(n, stop + (stop - begin))
                ends = self._ends(text[begin:stop]) + begin
                continue
            total += int(np.count_nonzero((ends > start) & (ends <= at)))
            start, begin, stop, ends = at, next_begin, next_stop, right
        return total + int(np.count_nonzero(ends > start))


def count_tokens(
    docs: DataFrame,
    model: str = "piece_bpe_32k.model",
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens``: the library's count for every whole text.

    Null and empty texts have 0 bytes and 0 tokens. One row per input row, repeated rows and null
    ids included; other columns are ignored; an empty table gives no rows.
    """

    def setup():
        resync = Resync(tokenizer_file(model), chunk, overlap)
        return lambda keys, texts: (keys, [len(t) for t in texts], [resync.count(t.decode()) for t in texts])

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text)), setup, "doc_id long, n_bytes long, n_tokens long")
