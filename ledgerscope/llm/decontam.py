"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are word sequences. A document is compared with the items that it
shares a seed (``least`` words in a row) with. For each such pair running Karp-Rabin marks the
longest matches that do not overlap, again and again with shorter search lengths, so that passages
are found whose parts stand in another order. An item leaks into a document when the marked
tiles cover enough of its words.

The benchmark is cut into blocks of bounded size; each block is broadcast and met by every
document where it lies, so no document text is shuffled and a passage that very many documents share
makes no large group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_arrow, map_batches, text_bytes

#: shortest tile in words, share of an item's words that tiles must cover
LEAST, COVERAGE = 5, 0.8
#: expected bytes of benchmark text in one broadcast block
BLOCK_BYTES = 32 << 20

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _powers(n: int) -> np.ndarray:
    out = np.empty(n + 1, dtype=np.uint64)
    out[0] = 1
    if n:
        np.multiply.accumulate(np.full(n, _BASE, dtype=np.uint64), out=out[1:])
    return out


class Rolling:
    """Karp-Rabin hashes (modulo 2^64) of all windows of a word-id sequence, of any length."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        # sum of id[j] * base^-j would need inverses: weigh by rising powers and compare after scaling
        self.power = _powers(self.n)
        self.prefix = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum((ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) * self.power[: self.n], out=self.prefix[1:])

    def windows(self, size: int, scale_to: int) -> np.ndarray:
        """Hash of the window at each place, scaled to power ``scale_to`` (at least every place)."""
        if self.n < size:
            return np.empty(0, dtype=np.uint64)
        found = self.prefix[size:] - self.prefix[: self.n - size + 1]
        lift = _powers(scale_to)[scale_to - np.arange(len(found))]
        return found * lift


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles ``(item_place, doc_place, length)`` that overlap in neither sequence, longest first.

    Word id 0 matches nothing. Of equally long matches the one earliest in the document, then in the
    item, is marked first.
    """
    free_i, free_d = item > 0, doc > 0
    tiles: list[tuple[int, int, int]] = []
    if len(item) < least or len(doc) < least:
        return tiles
    hashed_i, hashed_d = Rolling(item), Rolling(doc)
    scale = max(len(item), len(doc))
    size = len(item)
    while True:
        matches = _matches(item, doc, free_i, free_d, hashed_i, hashed_d, size, scale)
        marked = False
        for length, d, i in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            # marked meanwhile by a longer one: what is left of it comes with a later scan
            if free_i[i : i + length].all() and free_d[d : d + length].all():
                free_i[i : i + length] = False
                free_d[d : d + length] = False
                tiles.append((i, d, length))
                marked = True
        if marked and any(n >= size for n in _free_runs(free_i)):
            continue  # the remains of occluded matches may still be this long
        if size == least:
            return tiles
        size = max(least, size // 2)


def _free_runs(free: np.ndarray) -> list[int]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
    return (edges[1::2] - edges[::2]).tolist()


def _matches(item, doc, free_i, free_d, hashed_i, hashed_d, size, scale) -> list[tuple[int, int, int]]:
    """Maximal free matches of at least ``size`` words: ``(length, doc_place, item_place)``."""

    def open_windows(free):
        taken = np.concatenate([[0], np.cumsum(~free)])
        return np.flatnonzero(taken[size:] == taken[:-size]) if len(free) >= size else np.empty(0, dtype=int)

    at_i, at_d = open_windows(free_i), open_windows(free_d)
    if not len(at_i) or not len(at_d):
        return []
    hi, hd = hashed_i.windows(size, scale)[at_i], hashed_d.windows(size, scale)[at_d]
    hit = np.isin(hd, hi)
    at_d, hd = at_d[hit], hd[hit]
    places: dict[int, list[int]] = {}
    for p, h in zip(at_i.tolist(), hi.tolist()):
        places.setdefault(h, []).append(p)
    found, reach = [], {}
    for d, h in zip(at_d.tolist(), hd.tolist()):
        for i in places[h]:
            if reach.get(d - i, -1) > d:
                continue  # inside a match on the same diagonal
            if not np.array_equal(item[i : i + size], doc[d : d + size]):
                continue
            n = size
            while i + n < len(item) and d + n < len(doc) and free_i[i + n] and free_d[d + n] and item[i + n] == doc[d + n]:
                n += 1
            reach[d - i] = d + n - size + 1
            found.append((n, d, i))
    return found


class Block:
    """Some benchmark items, with a table of their seeds."""

    def __init__(self, items: list[tuple[int, str]], least: int, coverage: float):
        self.least, self.coverage = least, coverage
        self.vocabulary: dict[str, int] = {}
        code = self.vocabulary.setdefault
        self.items, hashes, owners, places = [], [], [], []
        for item_id, text in items:
            ids = np.array([code(w, len(self.vocabulary) + 1) for w in words(text)], dtype=np.int64)
            if len(ids) < least:
                continue
            seeds = self._seeds(ids)
            hashes.append(seeds)
            owners.append(np.full(len(seeds), len(self.items)))
            places.append(np.arange(len(seeds)))
            self.items.append((item_id, ids))
        flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        order = np.argsort(flat, kind="stable")
        self.seeds = flat[order]
        self.owners = np.concatenate(owners)[order] if owners else np.empty(0, dtype=int)
        self.places = np.concatenate(places)[order] if places else np.empty(0, dtype=int)

    def _seeds(self, ids: np.ndarray) -> np.ndarray:
        n = len(ids) - self.least + 1
        out = np.zeros(max(0, n), dtype=np.uint64)
        for k in range(self.least if n > 0 else 0):
            out = out * _BASE + ids[k : k + n].astype(np.uint64)
        return out

    def leaks(self, text: str) -> Iterator[tuple[int, float, list[tuple[int, int, int]]]]:
        """``(item_id, coverage, tiles)`` of each item whose words are covered enough."""
        get = self.vocabulary.get
        doc = np.array([get(w, 0) for w in words(text)], dtype=np.int64)
        if len(doc) < self.least or not len(self.seeds):
            return
        unknown = np.concatenate([[0], np.cumsum(doc == 0)])
        at = np.flatnonzero(unknown[self.least :] == unknown[: -self.least])
        if not len(at):
            return
        seeds = self._seeds(doc)[at]
        low, high = np.searchsorted(self.seeds, seeds, "left"), np.searchsorted(self.seeds, seeds, "right")
        hit = high > low
        if not hit.any():
            return
        spans = [np.arange(a, b) for a, b in zip(low[hit].tolist(), high[hit].tolist())]
        rows = np.unique(np.concatenate(spans))
        near = np.zeros(len(doc), dtype=bool)
        for p in at[hit].tolist():
            near[p : p + self.least] = True
        # words outside every seed can be in no tile: leave one of each gap, as a wall
        kept = near | np.concatenate([[False], near[:-1]])
        seen, place_of = np.where(near, doc, 0)[kept], np.flatnonzero(kept)
        for owner in np.unique(self.owners[rows]).tolist():
            item_id, ids = self.items[owner]
            covered = np.zeros(len(ids), dtype=bool)
            for q in self.places[rows[self.owners[rows] == owner]].tolist():
                covered[q : q + self.least] = True
            if covered.sum() < self.coverage * len(ids):
                continue  # tiles cover no more than the shared seeds do
            tiles = greedy_tiles(ids, seen, self.least)
            share = sum(t[2] for t in tiles) / len(ids)
            if share >= self.coverage:
                yield item_id, share, [(i, int(place_of[d]), n) for i, d, n in tiles]


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks by hash of the id; each is collected only when its turn comes."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).distinct()
        yield sorted(((r["item_id"], r["text"]) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = LEAST,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles, tiles``: a row for each document that holds an item.

    ``tiles`` lists ``item_word:document_word:length`` by document word, comma-joined. Words are
    lower-cased runs of letters, digits and underscores. Null and empty texts hold nothing; items with
    a null text or fewer than ``least`` words are not looked for. Repeated documents and items with
    the same id and text: each document row gives its own rows, an item counts once. Empty tables
    give no rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text))
    schema = "doc_id long, item_id long, coverage double, n_tiles long, tiles string"
    found = None
    for items in _blocks(benchmark, item_id, item_text, block_bytes):
        block = docs.sparkSession.sparkContext.broadcast(items)

        def setup(block=block):
            here = Block(block.value, least, coverage)

            def work(keys, texts):
                out = []
                for k, t in zip(keys, texts):
                    for item, share, tiles in here.leaks(t.decode()):
                        listed = ",".join(f"{i}:{d}:{n}" for i, d, n in sorted(tiles, key=lambda x: x[1]))
                        out.append((k, item, share, len(tiles), listed))
                return list(zip(*out)) if out else [[]] * 5

            return work

        part = map_batches(rows, setup, schema)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = LEAST,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows are filtered where they lie."""
    for items in _blocks(benchmark, item_id, item_text, block_bytes):
        block = docs.sparkSession.sparkContext.broadcast(items)

        def clean(batches, block=block):
            here = Block(block.value, least, coverage)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                yield batch.filter(pa.array([not any(here.leaks(t or "")) for t in texts], type=pa.bool_()))

        docs = map_arrow(docs, clean, docs.schema)
    return docs
