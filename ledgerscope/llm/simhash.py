"""SimHash near-deduplication by the generalised pigeonhole principle.

Documents get 64-bit fingerprints; fingerprints that differ in at most ``distance`` bits are
linked, and linked documents form a component. The 64 bits are grouped into ``m`` partitions, bits
that correlate over the corpus together. For thresholds t_1..t_m with sum(t_i + 1) = distance + 1
two linked fingerprints agree up to t_i bits in some partition i, so it is enough that each
fingerprint probes, in every partition, the values within its t_i. The thresholds are chosen for
each fingerprint by dynamic programming over estimated candidate counts; -1 skips a partition.

Every probe is a row of an equi-join, candidates are verified by their whole distance inside the
join, and only links between different components come out: fingerprints that already hang
together through the smallest or largest member of a bucket are never paired again.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut, keep_rows, map_batches, merged, text_bytes
from ledgerscope.llm.components import connected

SHINGLE, DISTANCE, SEED, BITS = 4, 4, 42, 64
#: bits of a partition that the histogram of values resolves
CELL_BITS = 16
#: cost of sending a probe, in candidates
PROBE_COST = 0.5
_HASH = xxhash.xxh64_intdigest


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half the shingles' XXH64; 0 without words.

    ``bytes.lower`` and ``bytes.split`` touch exactly A-Z and the white space of ASCII.
    """
    words = text.lower().split()
    if len(words) <= shingle:
        return _HASH(b" ".join(words), SEED) if words else 0
    line = b" ".join(words)
    starts = list(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
    hashes = np.array([_HASH(line[a : b - 1], SEED) for a, b in zip(starts, starts[shingle:])], dtype=">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long; null and empty texts have fingerprint 0."""

    def setup():
        return lambda keys, texts: (keys, np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64).tolist())

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text)), setup, "doc_id long, fp long")


def _bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together, over all of them."""

    def setup():
        total, n = np.zeros((BITS, BITS)), [0]

        def work(values):
            bits = _bits(np.array(values, dtype=np.int64)).astype(np.float32)
            total[...] += bits.T @ bits
            n[0] += len(values)
            return [], []

        def finish():
            yield list(range(BITS * BITS + 1)), [*total.ravel().astype(np.int64).tolist(), n[0]]

        work.finish = finish
        return work

    rows = map_batches(fps.select("fp"), setup, "cell int, n long", rows=4096).groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(BITS * BITS + 1)
    cells[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _bits(fps: np.ndarray) -> np.ndarray:
    """Bit j of each fingerprint, the highest first."""
    return np.unpackbits(fps.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)


def partition_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal width; each is grown by the free bit that correlates most with it."""
    p = np.diag(together) / max(1, n)
    cov = together / max(1, n) - np.outer(p, p)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(corr, 0.0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        width = (BITS - sum(map(len, groups))) // (m - i)
        sub = corr[np.ix_(free, free)]
        group = [free[int(np.argmax(sub.max(axis=1)))]]
        while len(group) < width:
            rest = [b for b in free if b not in group]
            group.append(rest[int(np.argmax(corr[np.ix_(rest, group)].mean(axis=1)))])
        # the most even bits first: they are the ones that the histogram resolves
        group.sort(key=lambda b: (-spread[b], b))
        groups.append(group)
        free = [b for b in free if b not in group]
    return groups


def choose_partitions(n: int, distance: int) -> int:
    """The number of partitions with the least expected probes and candidates for ``n`` fingerprints."""

    def cost(m: int) -> float:
        spare, width = distance + 1 - m, BITS // m
        balls = [sum(comb(width, k) for k in range(spare // m + (i < spare % m) + 1)) for i in range(m)]
        return sum(balls) * (PROBE_COST + n / 2.0 ** (0.9 * width))

    return min(range(2, distance + 2), key=cost)


def values_of(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group`` as an integer, its first bit highest."""
    bits = _bits(fps)[:, group].astype(np.int64)
    return bits @ (1 << np.arange(len(group) - 1, -1, -1, dtype=np.int64))


def ball(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` bits."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)], dtype=np.int64)


def allocate(values: list[np.ndarray], widths: list[int], cells: list[np.ndarray], distance: int) -> np.ndarray:
    """Thresholds of each fingerprint, (rows, m): the least sum of estimated candidates and probes.

    ``cells[i]`` counts fingerprints by the leading bits of partition i. A ball of radius 1 is counted
    cell by cell; larger ones grow from it in proportion to their size.
    """
    m, budget = len(values), distance + 1
    n = len(values[0])
    cost = np.zeros((m, budget + 1, n))  # cost[i, c]: of threshold c - 1
    for i, (v, w, cell) in enumerate(zip(values, widths, cells, strict=True)):
        top = min(w, CELL_BITS)
        low = w - top
        at = v >> low
        one = cell[at].astype(float)
        near = one * (1 + low) + sum(cell[at ^ (1 << b)] for b in range(top))
        for c in range(1, budget + 1):
            size = sum(comb(w, k) for k in range(c))
            found = (one if c == 1 else near * (size / (1 + w))) / 2.0**low
            cost[i, c] = found + PROBE_COST * size
    best = np.full((budget + 1, n), np.inf)
    best[0] = 0.0
    picks = []
    for i in range(m):
        options = np.stack([np.stack([best[s - c] + cost[i, c] if c <= s else np.full(n, np.inf) for c in range(budget + 1)]) for s in range(budget + 1)])
        picks.append(options.argmin(axis=1))  # (budget + 1, n)
        best = options.min(axis=1)
    out, left = np.zeros((n, m), dtype=np.int64), np.full(n, budget)
    for i in range(m - 1, -1, -1):
        c = picks[i][left, np.arange(n)]
        out[:, i] = c - 1
        left = left - c
    return out


def _cells(fps: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """Histogram of each partition's leading bits over all fingerprints."""

    def setup():
        total = [np.zeros(1 << min(len(g), CELL_BITS), dtype=np.int64) for g in groups]

        def work(found):
            x = np.array(found, dtype=np.int64)
            for t, g in zip(total, groups, strict=True):
                np.add.at(t, values_of(x, g) >> max(0, len(g) - CELL_BITS), 1)
            return [], [], []

        def finish():
            for i, t in enumerate(total):
                at = np.flatnonzero(t)
                yield [i] * len(at), at.tolist(), t[at].tolist()

        work.finish = finish
        return work

    rows = map_batches(fps.select("fp"), setup, "part int, cell int, n long", rows=4096).groupBy("part", "cell").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # at most partitions x 2^CELL_BITS cells of three numbers
    part, cell, n = (found[c].to_numpy() for c in ("part", "cell", "n"))
    out = [np.zeros(1 << min(len(g), CELL_BITS), dtype=np.int64) for g in groups]
    for i, counts in enumerate(out):
        counts[cell[part == i]] = n[part == i]
    return out


def _index(fps: DataFrame, groups: list[list[int]]) -> DataFrame:
    """``part, value, fp, comp``: a row for each fingerprint and partition."""

    def setup():
        def work(found, comps):
            x = np.array(found, dtype=np.int64)
            parts = np.repeat(np.arange(len(groups), dtype=np.int32), len(x))
            values = np.concatenate([values_of(x, g) for g in groups])
            return pa.array(parts), pa.array(values), pa.array(np.tile(x, len(groups))), pa.array(np.tile(np.array(comps, dtype=np.int64), len(groups)))

        return work

    return map_batches(fps, setup, "part int, value long, fp long, comp long", rows=4096)


def _probes(fps: DataFrame, groups: list[list[int]], cells: list[np.ndarray], distance: int) -> DataFrame:
    """``part, value, fp, comp``: a row for each value that a fingerprint has to look up."""
    widths = [len(g) for g in groups]

    def setup():
        balls = {}

        def work(found, comps):
            x, comp_of = np.array(found, dtype=np.int64), np.array(comps, dtype=np.int64)
            values = [values_of(x, g) for g in groups]
            thresholds = allocate(values, widths, cells, distance)
            out = []
            for i, v in enumerate(values):
                for t in np.unique(thresholds[:, i]):
                    if t < 0:
                        continue
                    rows = np.flatnonzero(thresholds[:, i] == t)
                    key = widths[i], int(t)
                    if key not in balls:
                        balls[key] = ball(*key)
                    masks = balls[key]
                    out.append((np.full(len(rows) * len(masks), i, dtype=np.int32), (v[rows, None] ^ masks).ravel(), np.repeat(x[rows], len(masks)), np.repeat(comp_of[rows], len(masks))))
            return [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]

        return work

    return map_batches(fps, setup, "part int, value long, fp long, comp long", rows=512)


def _labelled(fps: DataFrame, roots: DataFrame) -> DataFrame:
    """``fp, comp`` from ``node, root``; a fingerprint without a root is its own component."""
    return fps.join(merged(roots.withColumnRenamed("node", "fp")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("comp"))


def link_fingerprints(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp, comp`` for the distinct fingerprints ``fps (fp)``: comp is the smallest one reachable."""
    n, together = _bit_counts(fps)
    groups = partition_bits(n, together, choose_partitions(n, distance))
    close = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("q.fp"))) <= distance

    # first links: every member of a bucket with the bucket's smallest and largest, where close
    index = cut(_index(fps.select("fp", F.col("fp").alias("comp")), groups))
    ends = cut(index.groupBy("part", "value").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi"))
    paired = index.join(merged(ends), ["part", "value"])
    first = F.array(*[F.when((F.col("fp") != F.col(e)) & (F.bit_count(F.col("fp").bitwiseXOR(F.col(e))) <= distance), F.col(e)) for e in ("lo", "hi")])
    links = cut(paired.select(F.col("fp").alias("a"), F.explode(F.array_compact(first)).alias("b")).distinct())
    labelled = cut(_labelled(fps, connected(links)))

    # then all links between different components: probe, verify
    index = cut(_index(labelled, groups))
    held = cut(index.groupBy("part", "value", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("fp")))
    probes = _probes(labelled, groups, _cells(fps, groups), distance)
    hits = cut(
        probes.alias("p")
        .join(
            merged(held).alias("q"),
            (F.col("p.part") == F.col("q.part"))
            & (F.col("p.value") == F.col("q.value"))
            & (F.col("p.comp") != F.col("q.comp"))
            & ((F.col("q.n") > 1) | ((F.col("q.fp") < F.col("p.fp")) & close)),
        )
        .select("p.part", "p.value", "p.fp", "p.comp", F.col("q.comp").alias("other"), "q.n")
    )
    single = hits.where("n = 1").select(F.col("comp").alias("a"), F.col("other").alias("b"))
    several = hits.where("n > 1").alias("p").join(
        merged(index).alias("q"),
        (F.col("p.part") == F.col("q.part")) & (F.col("p.value") == F.col("q.value")) & (F.col("p.other") == F.col("q.comp")) & close,
    )
    between = single.unionByName(several.select(F.col("p.comp").alias("a"), F.col("p.other").alias("b"))).distinct()
    roots = connected(between)
    moved = labelled.join(merged(roots).select(F.col("node").alias("comp"), "root"), "comp", "left")
    return moved.select("fp", F.coalesce("root", "comp").alias("comp"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Texts are lower-cased (A-Z) and read as words without white space; ``component_id`` is the
    smallest id reachable over links of at most ``distance`` differing bits, the row's own included.
    Texts without words (null, empty, blank) have fingerprint zero and are linked like any other.
    Repeated rows give repeated rows; null ids belong to their component but name none, so a
    component of null ids alone has a null ``component_id``. An empty table gives no rows.
    """
    rows = cut(fingerprints(docs, doc_id, text, shingle))
    by_fp = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = cut(link_fingerprints(by_fp.select("fp"), distance))
    least = cut(
        linked.join(merged(by_fp), "fp").groupBy("comp").agg(F.min("least").alias("component_id"))
    )
    named = cut(linked.join(merged(least), "comp").select("fp", "component_id"))
    return rows.join(merged(named), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``docs`` with one row of each component: the one with the component's id.

    Of several rows with that id one stays; null ids come last, so a component of null ids alone keeps a row, too.
    """

    def setup():
        return lambda keys, texts, digests: (keys, np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64).tolist(), digests)

    digest = F.sha2(text_bytes(text), 256)
    rows = map_batches(docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text), digest.alias("digest")), setup, "doc_id long, fp long, digest string")
    classes = cut(rows.groupBy("fp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    by_fp = cut(classes.groupBy("fp").agg(F.min(order).alias("least")))
    linked = cut(link_fingerprints(by_fp.select("fp"), distance))
    best = cut(linked.join(merged(by_fp), "fp").groupBy("comp").agg(F.min("least").alias("best")))
    named = cut(linked.join(merged(best), "comp").select("fp", "best"))
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("digest") == F.col("best.digest"))
    return keep_rows(docs, classes.join(merged(named), "fp").select("doc_id", "digest", kept.alias("kept"), "copies"), digest, doc_id)
