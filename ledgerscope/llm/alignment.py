"""Cross-tokenizer alignment by pointer jumping.

Tokenizer A (byte-level BPE) and tokenizer B (pieces with byte fallback) cut the same bytes. Every token
points to the token of the other side that reaches farthest to the right among those that overlap it, or
to itself where both sides end together. Doubling the successors (``next = next[next]``) for all tokens at
once takes each to the terminal token of its component, which is the label of its group.

A text is cut before spaces at which neither tokenizer can join what stands on both sides; groups and
links never cross such a place. Each task encodes and aligns a distinct piece of text once.

Counting how many documents hold a linked id pair takes the whole corpus. Tasks write their documents in
segments of bounded size: word numbers of each document, links of each distinct word, and each distinct
id pair of the segment with the number of its documents. Spark sums the pairs over the segments, takes
the highest count of each A id, and gives every segment back the counts of its own pairs, so that what is
shuffled grows with the distinct pairs of segments and not with the links of documents.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import uuid
from itertools import chain

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_batches, text_bytes
from ledgerscope.llm.pieces import MARK, tokenizer_file
from ledgerscope.session import shared_dir

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: words (with repeats) at which a segment ends, and bytes of text; a longer text is a segment of its own
SEGMENT_WORDS, SEGMENT_BYTES = 1 << 17, 2 << 20
#: distinct words and their characters that a task's table may hold; it is emptied beyond them
TABLE_WORDS, TABLE_CHARS = 300_000, 6_000_000

#: places where a text may be cut: before spaces that follow another character, or before one space that
#: stands between other white space and a character
_CUT = re.compile(r"(?<=[^\s\u180e])(?= )|(?<=[\s\u180e])(?<! )(?= [^\s\u180e])")
#: words that are encoded as one text
BLOCK = 1000
#: where splitting at every space would differ from that
_ODD = re.compile(r"[\s\u180e] | [\s\u180e]|^ | $")


def cut_words(text: str) -> list[str]:
    """Space and text, cut so that both tokenizers encode every part alike alone and in place."""
    if _ODD.search(text):
        return _CUT.split(" " + text)
    return [" " + w for w in text.split(" ")]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For all A tokens, then all B tokens, the terminal token of their component (B tokens count on from A's).

    Both arrays hold ascending end offsets over the same bytes and have the same last one.
    """
    n = len(ends_a)
    over = np.searchsorted(ends_a, ends_b)  # the A token that holds a B token's last byte
    here = n + np.arange(len(ends_b))
    follows = np.concatenate([n + np.searchsorted(ends_b, ends_a), np.where(ends_a[over] == ends_b, here, over)])
    while True:
        doubled = follows[follows]
        if np.array_equal(doubled, follows):
            return follows
        follows = doubled


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping (A, B) tokens and the end offset of what they share: one pair for each end of either side."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), ends


#: ids and tokens per word on either side, and whether a word's tokens say its bytes
Coded = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Aligner:
    """Encodes words by both tokenizers and aligns them, each distinct word once."""

    def __init__(self, a_file: str, b_file: str, most_words: int = TABLE_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes_a = [bytes(alphabet[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        whole = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any(MARK in p.lstrip(MARK) for p in whole):
            raise ValueError("a piece crosses a whitespace marker: words are not independent")
        self.mark = [self.b.piece_to_id(MARK)]
        self.widths_a = np.array([len(x) for x in self.bytes_a])
        self.widths_b = np.array([len(x) for x in self.bytes_b])
        # how a token is written: an A id before another or the last of its group, then B ids likewise
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        self.said = [f"{i}{end}" for n, end in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)]
        self.said_at = np.array([0, n_a, 2 * n_a, 2 * n_a + n_b])
        self.said_length = np.array([len(x) for x in self.said])
        self.most_words = most_words
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        #: per word: the groups as text; tokens of A and B, groups, links and where its links begin
        self.groups: list[str] = []
        self.sizes = np.empty((0, 5), dtype=np.int64)
        self.pairs = np.empty(0, dtype=np.int64)
        self.uneven: set[int] = set()
        self._new: list[tuple[np.ndarray, np.ndarray]] = []

    def full(self) -> bool:
        return len(self.index) > self.most_words or self.chars > TABLE_CHARS

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of each word on both sides."""
        in_a = [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]
        # the library puts one marker before a text itself, but none before an empty one
        in_b = self.b.encode([w[1:] for w in words], num_threads=1)
        return in_a, [ids if w != " " else self.mark for w, ids in zip(words, in_b, strict=True)]

    def _together(self, words: list[str]) -> Coded | None:
        """Words that don't end in white space, as one text, which both tokenizers cut between them; None if they don't."""
        text = "".join(words)
        ids_a, ids_b = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])
        raw = text.encode()
        if not b"".join([self.bytes_a[i] for i in ids_a]) == raw == b"".join([self.bytes_b[i] for i in ids_b]):
            return None
        edges = np.cumsum(_sizes([w.encode() for w in words]))
        out = []
        for ids, widths in ((ids_a, self.widths_a), (ids_b, self.widths_b)):
            ids = np.array(ids, dtype=np.int64)
            ends = np.cumsum(widths[ids])
            upto = np.searchsorted(ends, edges, "right")
            if (upto == 0).any() or (ends[upto - 1] != edges).any():
                return None
            out += [ids, np.diff(upto, prepend=0)]
        return out[0], out[1], out[2], out[3], np.ones(len(words), bool)

    def _apart(self, words: list[str]) -> Coded:
        """Words encoded one by one; those that a tokenizer doesn't give back have no tokens."""
        in_a, in_b = self.encode(words)
        good = [
            b"".join([self.bytes_a[i] for i in a]) == w.encode() == b"".join([self.bytes_b[i] for i in b])
            for a, b, w in zip(in_a, in_b, words, strict=True)
        ]
        in_a, in_b = ([x if ok else [] for x, ok in zip(side, good, strict=True)] for side in (in_a, in_b))
        flat = [np.fromiter(chain.from_iterable(x), np.int64) for x in (in_a, in_b)]
        return flat[0], _sizes(in_a), flat[1], _sizes(in_b), np.array(good, dtype=bool)

    def add(self, words: list[str]) -> None:
        """Aligns words that the table doesn't have."""
        joinable = [w for w in words if not (w[-1].isspace() or w[-1] == "\u180e")]
        others = list(set(words).difference(joinable)) if len(joinable) < len(words) else []
        blocks = [joinable[i : i + BLOCK] for i in range(0, len(joinable), BLOCK)]
        coded = [self._together(x) or self._apart(x) for x in blocks] + ([self._apart(others)] if others else [])
        ids_a, n_a, ids_b, n_b, good = (np.concatenate(x) for x in zip(*coded, strict=True))
        words = joinable + others
        at = len(self.groups)
        self.index.update(zip(words, range(at, at + len(words)), strict=True))
        self.chars += sum(map(len, words))
        self.uneven.update((at + np.flatnonzero(~good)).tolist())
        groups, sizes, pairs = self._align(ids_a, n_a, ids_b, n_b)
        self.groups += groups
        self._new.append((sizes, pairs))

    def _align(self, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """All words at once: their groups as text, their sizes (the last column counts links before) and their id pairs."""
        if not len(ids_a):
            return [""] * len(n_a), np.zeros((len(n_a), 5), dtype=np.int64), ids_a
        ends_a, ends_b = np.cumsum(self.widths_a[ids_a]), np.cumsum(self.widths_b[ids_b])
        edges = np.concatenate([[0], ends_a])[np.cumsum(n_a)]
        labels, group = np.unique(terminals(ends_a, ends_b), return_inverse=True)
        left, right, shared = links(ends_a, ends_b)
        pairs = ids_a[left] << 32 | ids_b[right]
        group_ends = np.searchsorted(ends_b[labels - len(ids_a)], edges, "right")
        link_ends = np.searchsorted(shared, edges, "right")
        n_groups, n_links = np.diff(group_ends, prepend=0), np.diff(link_ends, prepend=0)
        # the tokens in the order in which they are written: group by group, A before B
        order = np.argsort(group * 2 + (np.arange(len(group)) >= len(ids_a)), kind="stable")
        sides = [group[: len(ids_a)], group[len(ids_a) :]]
        last = np.concatenate([np.append(g[1:] != g[:-1], True) for g in sides])
        kind = np.repeat([0, 2], [len(ids_a), len(ids_b)]) + last
        codes = (np.concatenate([ids_a, ids_b]) + self.said_at[kind])[order]
        text = "".join(map(self.said.__getitem__, codes.tolist()))
        token_ends = np.cumsum(n_a + n_b)
        chars = np.concatenate([[0], np.cumsum(self.said_length[codes])])[token_ends].tolist()
        groups = [text[a : max(a, b - 1)] for a, b in zip([0, *chars], chars, strict=False)]
        return groups, np.stack([n_a, n_b, n_groups, n_links, link_ends - n_links], axis=1), pairs

    def settle(self) -> None:
        """Puts the sizes and pairs of the words added since the last time into one array each."""
        if self._new:
            shift = np.cumsum([len(self.pairs), *[len(p) for _, p in self._new]])
            moved = [s + np.array([0, 0, 0, 0, at]) for (s, _), at in zip(self._new, shift, strict=False)]
            self.sizes = np.concatenate([self.sizes, *moved])
            self.pairs = np.concatenate([self.pairs, *[p for _, p in self._new]])
            self._new = []

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """Word numbers of each text; none for an empty text or one whose bytes a tokenizer doesn't give back."""
        split = [cut_words(t) if t else [] for t in texts]
        new = set().union(*split).difference(self.index)
        if new:
            self.add(sorted(new))
        get = self.index.__getitem__
        found = [list(map(get, words)) for words in split]
        return [x if not self.uneven or self.uneven.isdisjoint(x) else [] for x in found]


class Segment:
    """Documents of a task until their words or bytes are enough for one row of the segment table."""

    #: ``body`` holds the documents' columns, the word numbers of each and the links of each word
    COLUMNS = "segment long, pairs array<long>, pair_docs array<long>, body binary"

    def __init__(self, aligner: Aligner, most_words: int):
        self.aligner, self.most_words = aligner, most_words
        self.number = 0
        self.clear()

    def clear(self) -> None:
        self.keys: list = []
        self.docs: list[list[int]] = []
        self.words = self.bytes = 0

    def add(self, key, words: list[int], size: int) -> None:
        self.keys.append(key)
        self.docs.append(words)
        self.words += len(words)
        self.bytes += size

    def full(self) -> bool:
        return self.words >= self.most_words or self.bytes >= SEGMENT_BYTES

    def row(self) -> list:
        """The segment as one value per column; the next segment starts empty."""
        table = self.aligner
        table.settle()
        lengths = _sizes(self.docs)
        every = np.fromiter(chain.from_iterable(self.docs), np.int64, self.words)
        used, local = np.unique(every, return_inverse=True)
        sizes = table.sizes[used]
        link_counts = sizes[:, 3]
        pairs, linked = np.unique(table.pairs[_ranges(sizes[:, 4], link_counts)], return_inverse=True)
        doc = np.repeat(np.arange(len(self.docs)), lengths)
        per_doc = [_sums(v, lengths) for v in sizes[local, :4].T]
        get = table.groups.__getitem__
        shas = [hashlib.sha256(";".join(map(get, x)).encode()).hexdigest() if x else "" for x in self.docs]
        # distinct words of documents, then distinct pairs of documents
        words_of = _distinct(doc * max(len(used), 1) + local)
        doc_of, word_of = np.divmod(words_of, max(len(used), 1))
        starts = np.cumsum(link_counts) - link_counts
        pair_of = linked[_ranges(starts[word_of], link_counts[word_of])]
        seen = _distinct(np.repeat(doc_of, link_counts[word_of]) * max(len(pairs), 1) + pair_of)
        pair_docs = np.bincount(seen % max(len(pairs), 1), minlength=len(pairs))[: len(pairs)]
        number = (TaskContext.get().partitionId() << 32) + self.number
        body = (self.keys, per_doc, shas, lengths, local.astype(np.int32), link_counts.astype(np.int32), linked.astype(np.int32))
        out = [number, pairs, pair_docs, zstandard.compress(pickle.dumps(body), 1)]
        self.number += 1
        self.clear()
        return out


def _sizes(values: list) -> np.ndarray:
    return np.fromiter(map(len, values), np.int64, len(values))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths, empty ones included."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ..`` of each length, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def write_segments(
    docs: DataFrame,
    path: str,
    a_file: str = A_FILE,
    b_file: str = B_FILE,
    doc_id: str = "doc_id",
    text: str = "text",
    segment_words: int = SEGMENT_WORDS,
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """Encodes and aligns all texts, writes the segment table as Parquet under ``path`` and returns it."""

    def setup():
        aligner = Aligner(tokenizer_file(a_file), tokenizer_file(b_file), table_words)
        segment = Segment(aligner, segment_words)
        fields = len(Segment.COLUMNS.split(","))

        def rows(closed):
            return [list(c) for c in zip(*closed, strict=True)] if closed else [[] for _ in range(fields)]

        def work(keys, texts):
            closed = []
            for key, raw, words in zip(keys, texts, aligner.numbers([t.decode() for t in texts]), strict=True):
                segment.add(key, words, len(raw))
                if segment.full():
                    closed.append(segment.row())
            if aligner.full():
                if segment.keys:
                    closed.append(segment.row())
                aligner.clear()
            return rows(closed)

        work.finish = lambda: iter([rows([segment.row()])] if segment.keys else [])
        return work

    source = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text))
    map_batches(source, setup, Segment.COLUMNS, rows=64).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def _requests(segments: DataFrame) -> DataFrame:
    """``segment, at, pair, docs``: each segment's distinct pairs and how many of its documents hold them."""
    pairs = segments.select("segment", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("at", "p"))
    return pairs.select("segment", "at", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").alias("docs"))


def pair_counts(segments: DataFrame) -> DataFrame:
    """``pair, a_id, b_id, count, best``: documents that hold the linked id pair; ``best`` if no pair of the A id has more."""
    totals = _requests(segments).groupBy("pair").agg(F.sum("docs").alias("count"))
    ids = totals.select(
        "pair", F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), "count"
    )
    # the pairs of an A id are at most as many as B has ids
    return ids.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a_id")))


def align_corpus(
    docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, doc_id: str = "doc_id", text: str = "text", **sizes: int
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: one row per row of ``docs``.

    A null or empty text, and one whose bytes a tokenizer doesn't give back (U+2581 in the text), has no
    tokens: zeros and an empty digest. Every row is a document of its own, repeated rows and null ids
    included. A text of any length is aligned whole. Other columns are ignored; an empty table gives no
    rows. The segment table stays in the checkpoint folder, as the returned frame reads it. ``sizes`` are those
    of ``write_segments``; they change no row.
    """
    path = shared_dir(docs.sparkSession, f"alignment-{uuid.uuid4().hex}")
    segments = write_segments(docs, path, a_file, b_file, doc_id, text, **sizes)
    answers = (
        _requests(segments)
        .join(pair_counts(segments).select("pair", "count", "best"), "pair")
        .groupBy("segment")
        .agg(F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("answers"))
    )
    joined = segments.select("segment", "body").join(answers, "segment", "left").select(
        "body", F.col("answers.count").alias("counts"), F.col("answers.best").cast("array<int>").alias("best")
    )
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return map_batches(joined, lambda: _totals, schema, rows=1)


def _totals(bodies, counts, best):
    """The documents of one segment with the sums over their links."""
    keys, per_doc, shas, lengths, words, link_counts, linked = pickle.loads(zstandard.decompress(bodies[0]))
    sums = []
    for values in (best[0], counts[0]):
        of_word = _sums(np.array(values or [], dtype=np.int64)[linked], link_counts.astype(np.int64))
        sums.append(_sums(of_word[words], lengths))
    return keys, *per_doc, *sums, shas


def align_tokens(
    docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, groups``: the groups of each text, ``a1,a2|b1;a3|b2,b3``; empty where it has no tokens."""

    def setup():
        aligner = Aligner(tokenizer_file(a_file), tokenizer_file(b_file))

        def work(keys, texts):
            if aligner.full():
                aligner.clear()
            found = aligner.numbers([t.decode() for t in texts])
            return keys, [";".join([aligner.groups[w] for w in x]) for x in found]

        return work

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text)), setup, "doc_id long, groups string")
