"""Alignment against a plain version over whole texts encoded by the libraries; odd texts; parts of segments."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from llm_cases import DOC_SCHEMA, SMALL, documents, no_documents, odd_documents  # noqa: F401
from tokenizers import Tokenizer

from ledgerscope.llm import alignment, queries
from ledgerscope.llm.pieces import tokenizer_file


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(tokenizer_file(alignment.A_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(alignment.B_FILE))


def byte_of():
    """Character to byte of a byte-level vocabulary, by the published rule."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, n = {chr(b): b for b in visible}, 0
    for b in range(256):
        if b not in visible:
            out[chr(256 + n)] = b
            n += 1
    return out


BYTE_OF = byte_of()


def plain_align(text, libraries):
    """(n_a, n_b, groups as lists of ids, links) of one text."""
    a, b = libraries
    none = (0, 0, [], [])
    if not text:
        return none
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    said_a = [bytes(BYTE_OF[c] for c in a.id_to_token(i)) for i in ids_a]
    said_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
        return none
    end_a, end_b = np.cumsum([len(x) for x in said_a]).tolist(), np.cumsum([len(x) for x in said_b]).tolist()
    links, i, j = [], 0, 0
    groups, start = [], (0, 0)
    while i < len(ids_a) and j < len(ids_b):
        links.append((ids_a[i], ids_b[j]))
        x, y = end_a[i], end_b[j]
        i, j = i + (x <= y), j + (y <= x)
        if x == y:
            groups.append((ids_a[start[0] : i], ids_b[start[1] : j]))
            start = (i, j)
    return len(ids_a), len(ids_b), groups, links


def say(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def plain_corpus(rows, libraries):
    found = [(key, plain_align(text, libraries)) for key, text in rows]
    counts = Counter(pair for _, (*_, links) in found for pair in set(links))
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (key, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(say(groups).encode()).hexdigest() if n_a else "")
        for key, (n_a, n_b, groups, links) in found
    ]


ODD_TEXTS = [
    "", " ", "  ", "   a", " a  b ", "▁", "▁▁ x ▁", "fine but ▁ inside", "\n", "\n \n", "a\n b", "a \n b", "a\n  b\t c", "\t x", "日本語の文章 です" * 20,
    "\x00​ é", "x" * 3000, "🙂" * 300 + " 🙂", "<s> </s> <unk> <0x41>", "<|endoftext|> <|endoftext|>", "it's we'll 'S ' s", "a᠎ b᠎c ᠎ d",
    "a\x1c b \x1cc", "a\x85 b\xa0 c", "ab " * 400, " " * 1000, "é è ü ß", "é ö", "1234567 89", "½ ﬁ Å", "﻿bom", "x  y  z", "\r\n a\r\n  b",
]


def test_words_are_encoded_as_in_place(libraries):
    a, b = libraries
    table = alignment.Aligner(tokenizer_file(alignment.A_FILE), tokenizer_file(alignment.B_FILE))
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "'s", "7", "é", "日本", "🙂", "\x1c", "᠎", "\xa0", "\x85", " ", "--", "_", "<s>", "\x00", "​"]
    texts = [t for t in ODD_TEXTS if t] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(4000)]
    for text in texts:
        words = alignment.cut_words(text)
        assert "".join(words) == " " + text
        in_a, in_b = table.encode(words)
        assert sum(in_a, []) == a.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text:
            assert sum(in_b, []) == b.encode(text)


def test_terminals_are_the_ends_of_components():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.append(np.flatnonzero(rng.random(n - 1) < p) + 1, n) for p in rng.random(2)]
        common = np.intersect1d(*ends)
        found = alignment.terminals(*ends)
        expected = [len(ends[0]) + np.searchsorted(ends[1], common[np.searchsorted(common, e)]) for side in ends for e in side]
        assert found.tolist() == [int(x) for x in expected]
        a, b, _ = alignment.links(*ends)
        starts = [np.append(0, e[:-1]) for e in ends]
        pairs = {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]}
        assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(pairs)


def test_query(spark, documents, libraries):
    rows = queries.queries()["op13_alignment"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(plain_corpus([(d, t) for d, t, _ in documents], libraries))


@pytest.mark.parametrize("words, table", [(1 << 18, 200_000), (500, 300), (1, 1)])
def test_segments_of_any_size(spark, documents, libraries, words, table):
    rows = [(d, t) for d, t, _ in documents[:60]] + [(10**6 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, None), (None, "a b"), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = alignment.align_corpus(docs, segment_words=words, table_words=table).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_corpus(rows, libraries), key=str)


def test_groups_of_texts(spark, documents, libraries):
    docs = spark.createDataFrame([(d, t) for d, t, _ in documents[:40]], "doc_id long, text string")
    got = {r["doc_id"]: r["groups"] for r in alignment.align_tokens(docs).collect()}
    assert got == {d: say(plain_align(t, libraries)[2]) for d, t, _ in documents[:40]}


def test_odd_rows(spark, odd_documents, no_documents, libraries):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert sorted(map(tuple, alignment.align_corpus(odd_documents).collect()), key=str) == sorted(plain_corpus(rows, libraries), key=str)
    assert alignment.align_corpus(no_documents).collect() == []
    only_null = odd_documents.where("text is null")
    assert [tuple(r)[1:] for r in alignment.align_corpus(only_null).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
