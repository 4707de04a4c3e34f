"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from training texts. A text is encoded
with every dictionary, block by block, and the language that needs the fewest bytes is chosen; when
the runner-up needs nearly as few, the answer is marked rejected.
"""

from __future__ import annotations

import re

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut, fold, map_batches, text_bytes

#: bytes of a dictionary, of one text in it, and distinct texts looked at for it (bounds of the fit of each language)
DICTIONARY, PIECE, SAMPLE_TEXTS = 98_304, 12_288, 600
#: bytes encoded at a time: short, so that the dictionary counts in every block of a long text
BLOCK = 2_048
LEVEL = 3
#: least relative margin between the best and the second language
MARGIN = 0.01
#: how fast the score falls with each byte saved by another language
SHARPNESS = 0.35
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str) -> bytes:
    """The lower-cased letter runs of the text, one blank between them; letters are characters of the categories L."""
    runs = _LETTERS.findall(text.lower())
    # what the pattern takes besides letters: number signs such as superscripts, fractions and Roman numerals
    kept = [r if r.isalpha() else "".join(filter(str.isalpha, r)) for r in runs]
    return " ".join(filter(None, kept)).encode()


def _piece(plain: bytes, place: float) -> bytes:
    """At most ``PIECE`` bytes of the letters, of a long text from an offset that ``place`` (0 to 1) gives, at blanks where there are any."""
    if len(plain) <= PIECE:
        return plain
    at = int(place * (len(plain) - PIECE + 1))
    part = plain[at : at + PIECE]
    return part[part.find(b" ") + 1 :] if at and b" " in part[:-1] else part


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionary of each language from rows whose crc32(id) mod 5 is not 0, commonest language last.

    Every language of these rows is learned. Takes distinct texts in hash order until ``DICTIONARY`` bytes
    are full, from a bounded sample of about ``SAMPLE_TEXTS`` a language: whole texts first, and where these do not
    fill it, a piece of ``PIECE`` bytes of each longer one. Rows with a null text, language or id are not learned from.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        (fold("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    )
    rows = rows.select("lang", "text", F.xxhash64("text").alias("hash"))
    counts = cut(rows.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")))
    sizes = {r["lang"]: r["n"] for r in counts.collect()}
    if not sizes:
        return {}
    # about SAMPLE_TEXTS distinct texts of each language, by a hash threshold of its own
    place = F.pmod(F.xxhash64("hash"), F.lit(1 << 30)) / float(1 << 30)
    shares = F.broadcast(counts.select("lang", (F.lit(float(SAMPLE_TEXTS)) / F.col("texts")).alias("share")))
    sampled = rows.join(shares, "lang").where(place < F.col("share")).groupBy("lang", "hash").agg(F.first("text").alias("text"))

    def setup():
        def work(langs, hashes, places, texts):
            plain = [letters(t) for t in texts]
            return langs, hashes, places, [len(p) > PIECE for p in plain], [_piece(p, x) for p, x in zip(plain, places)]

        return work

    offset = F.pmod(F.xxhash64("hash", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    cleaned = map_batches(sampled.select("lang", "hash", offset.alias("offset"), "text"), setup, "lang string, hash long, offset double, long boolean, letters binary")
    ordered = Window.partitionBy("lang").orderBy("long", place, "hash")
    before = F.sum(F.length("letters") + 1).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    nth = F.row_number().over(ordered)
    found = cleaned.where(F.length("letters") > 0).select("lang", "letters", nth.alias("nth"), F.coalesce(before, F.lit(0)).alias("before"))
    picked: dict[str, list[bytes]] = {k: [] for k in sizes}
    for r in sorted(found.where(F.col("before") < DICTIONARY).collect(), key=lambda r: r["nth"]):
        picked[r["lang"]].append(bytes(r["letters"]))
    # the end of a dictionary is the cheapest to refer to, whatever its order
    return {k: b" ".join(picked[k])[:DICTIONARY] for k in sorted(sizes, key=lambda k: (sizes[k], k)) if picked[k]}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.encoders = []
        for content in dictionaries.values():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def classify(self, text: str) -> tuple[str, float, bool]:
        """Language, score between 0 and 1, and whether the margin is too narrow."""
        plain = letters(text)
        if not plain or not self.names:
            return UNKNOWN, 0.0, True
        blocks = [plain[i : i + BLOCK] for i in range(0, len(plain), BLOCK)]
        sizes = np.array([sum(len(e.compress(b)) for b in blocks) for e in self.encoders], dtype=float)
        best = len(sizes) - 1 - int(np.argmin(sizes[::-1]))  # a tie goes to the commoner language
        score = 1.0 / np.exp(-SHARPNESS * np.minimum(sizes - sizes[best], 200.0)).sum()
        others = np.delete(sizes, best)
        narrow = bool(len(others)) and (others.min() - sizes[best]) / sizes[best] < MARGIN
        return self.names[best], float(score), bool(narrow)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every whole text.

    ``und`` with score 0 when the text is null or has no letter, or nothing was learned. One row per
    input row, repeated rows and null ids included; an empty table gives no rows; texts of any length are
    read whole; no other column is read.
    """

    def setup():
        classifier = Classifier(dictionaries)

        def work(keys, held, texts):
            return keys, held, *zip(*(classifier.classify(t.decode()) for t in texts), strict=True)

        return work

    rows = docs.select(F.col(doc_id).alias("doc_id"), (fold(doc_id, 5) == 0).alias("held_out"), text_bytes(text))
    return map_batches(rows, setup, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
