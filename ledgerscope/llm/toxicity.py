"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear over hashed traits of a text: which words it has, how words begin
(insults are inflected), and whether two or three different words begin alike. It is trained
in numpy from texts confirmed toxic (P) and from texts whose label is not looked at (U),
minimising

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss l: the toxic texts hidden in U are subtracted by way of the class prior,
and the difference is kept from going below zero, where it would only reward overfitting. P and U
are bounded samples of distinct texts (documented parameters), drawn by the text's hash in proportion to
their copies; a text with more copies than a draw stands for is in once, by its weight. The prior is
counted over all labelled rows, and every text of the table is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut, fold, map_arrow, map_batches, text_bytes

#: about how many texts of P and of U are fitted (whole distinct texts, chosen by their hash)
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 18_000
#: traits are hashed into 2^BITS cells; word beginnings of these lengths; counts of alike beginnings
BITS, PREFIXES, LEVELS = 20, range(4, 9), 3
#: a trait is fitted if it is in this many texts of P at least and this many times commoner than in clean texts
LEAST_TEXTS, LEAST_LIFT = 6, 2.0
MASK = (1 << BITS) - 1
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def bases(word: str) -> list[int]:
    """Cells of the whole word and of its beginnings."""
    hashed = xxhash.xxh32_intdigest
    return [hashed(f"={word}") & MASK, *(hashed(f"^{word[:k]}") & MASK for k in PREFIXES if len(word) >= k)]


def cell(base: int, level: int) -> int:
    """The cell of "``level`` different words share this base"."""
    return (base * (2 * level - 1) + (level - 1) * 0x9E3779B1) & MASK


def traits(text: str) -> list[int]:
    counts = Counter(b for w in words(text) for b in bases(w))
    return sorted({cell(b, level) for b, n in counts.items() for level in range(1, min(n, LEVELS) + 1)})


@dataclass
class Model:
    """Weights by cell and a bias."""

    weights: dict[int, float]
    bias: float
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self):
        every = np.arange(1 << BITS, dtype=np.int64)
        weighted = np.zeros(1 << BITS, dtype=bool)
        weighted[list(self.weights)] = True
        #: whether a weighted cell can come from a base
        self.useful = np.any([weighted[cell(every, level)] for level in range(1, LEVELS + 1)], axis=0).tobytes()

    def margin(self, text: str) -> float:
        """The classifier's g of a text: like the sum over ``traits``, but only weighted cells are built."""
        if len(self.seen) > 300_000:
            self.seen.clear()
        counts: Counter = Counter()
        for w in words(text):
            found = self.seen.get(w)
            if found is None:
                found = self.seen[w] = tuple(b for b in bases(w) if self.useful[b])
            if found:
                counts.update(found)
        cells = {cell(b, level) for b, n in counts.items() for level in range(1, min(n, LEVELS) + 1)}
        return self.bias + sum(self.weights.get(c, 0.0) for c in sorted(cells))

    def score(self, text: str) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.margin(text), -40.0, 40.0))))


def choose(
    in_p: np.ndarray, in_u: np.ndarray, n_p: float, n_u: float, prior: float = 0.0, texts: tuple[np.ndarray, int, int] | None = None
) -> np.ndarray:
    """Which traits are markedly commoner in P than in clean texts; the others say nothing and only add noise.

    U holds toxic texts in the share ``prior``; the rate in clean texts is what they leave of U's. ``texts`` has how
    many distinct texts of P have each trait, and the distinct texts of P and of U, where the counts are weighted.
    """
    support, texts_p, texts_u = texts or (in_p, n_p, n_u)
    rate_p, rate_u = (in_p + 0.5) / (n_p + 1), (in_u + 0.5) / (n_u + 1)
    spread = np.sqrt(rate_u * (1 - rate_u) * (1 / max(1, texts_p) + 1 / max(1, texts_u)))
    clean = np.maximum(rate_u - prior * rate_p, 0.0) / (1 - prior)
    # rate_p - rate_u is 1 - prior of the difference to the clean rate, and so is its spread
    return (support >= LEAST_TEXTS) & (rate_p > LEAST_LIFT * clean) & (rate_p - rate_u > 5.0 * spread)


def fit_nnpu(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    chosen: np.ndarray,
    prior: float,
    rounds: int = 600,
    rate: float = 0.5,
    l2: float = 2e-4,
    weights: tuple[np.ndarray, np.ndarray] | None = None,
) -> Model:
    """Train from the cells of each text, of which only ``chosen`` (sorted) are used; ``weights`` of P's and U's texts.

    Without positives the score is the prior everywhere.
    """
    if not positive or not unlabelled:
        p = min(max(prior, 1e-6), 0.49)
        return Model({}, float(np.log(p / (1 - p))))
    of_p, of_u = (x / x.sum() for x in weights or (np.ones(len(positive)), np.ones(len(unlabelled))))
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))

    def rows(docs):
        kept = [place[d] for d in docs]
        kept = [k[k >= 0] for k in kept]
        doc = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
        return doc, (np.concatenate(kept) if kept else np.empty(0, dtype=int)), len(kept)

    sides = {"p": rows(positive), "u": rows(unlabelled)}
    w, b = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    mean_w, mean_b, seen = np.zeros_like(w), 0.0, 0
    velocity, velocity_b = np.zeros_like(w), 0.0

    def margin(side):
        doc, feature, n = sides[side]
        return b + np.bincount(doc, weights=w[feature], minlength=n)

    def pull(side, per_text):
        doc, feature, _ = sides[side]
        return np.bincount(feature, weights=per_text[doc], minlength=len(w)), float(per_text.sum())

    for step in range(rounds):
        gp, gu = margin("p"), margin("u")
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        negative = np.logaddexp(0, gu) @ of_u - prior * (np.logaddexp(0, gp) @ of_p)
        # derivatives of l(g) on P, of l(-g) on U and on P
        a, a0 = pull("p", prior * (sp - 1) * of_p)
        n, n0 = pull("u", su * of_u)
        c, c0 = pull("p", prior * sp * of_p)
        if negative >= 0:
            grad, grad0 = a + n - c, a0 + n0 - c0
        else:
            grad, grad0 = c - n, c0 - n0
        grad = grad + l2 * w
        velocity, velocity_b = 0.9 * velocity - rate * grad, 0.9 * velocity_b - rate * grad0
        w, b = w + velocity, b + velocity_b
        if step >= rounds // 2:
            mean_w, mean_b, seen = mean_w + w, mean_b + b, seen + 1
    w, b = mean_w / seen, mean_b / seen
    return Model({int(k): float(v) for k, v in zip(chosen, w, strict=True) if abs(v) > 1e-6}, float(b))


def _drawn(copies: str, share: float, salt: int) -> Column:
    """Weight of a distinct text with that many rows in a sample of the ``share`` of all rows; 0 if not drawn.

    Texts are drawn in proportion to their rows; a text of more rows than a draw stands for is always in.
    """
    place = F.pmod(F.xxhash64("hash", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    expected = F.col(copies) * F.lit(share)
    return F.when(place < expected, F.greatest(expected, F.lit(1.0))).otherwise(0.0)


def _trait_counts(samples: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By cell, the weight of the texts of P and of U that have it, and P's distinct texts that have it."""

    def setup():
        total = np.zeros((3, 1 << BITS))

        def work(p, u, texts):
            for in_p, in_u, t in zip(p, u, texts):
                cells = traits(t.decode())
                total[0, cells] += in_p
                total[1, cells] += in_u
                total[2, cells] += in_p > 0
            return [[]] * 4

        def finish():
            at = np.flatnonzero(total.any(axis=0))
            yield at.tolist(), *total[:, at].tolist()

        work.finish = finish
        return work

    parts = map_batches(samples.select("p", "u", "text"), setup, "cell int, p double, u double, texts double")
    # cells that are too rare to be chosen stay behind
    found = parts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("p", "u", "texts")]).where(F.col("texts") >= LEAST_TEXTS).toArrow()
    out = np.zeros((3, 1 << BITS))
    out[:, found["cell"].to_numpy()] = [found[c].to_numpy() for c in ("p", "u", "texts")]
    return out[0], out[1], out[2]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Learn from rows whose crc32(id) mod 5 is not 0.

    P: texts with label 1. U: any texts, whatever their label. Null labels and null ids count as
    unlabelled; an id with several labels is positive if any is 1. The driver fits the chosen traits of
    about ``max_positive + max_unlabelled`` texts; their number does not grow with the tables.
    """
    known = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where((fold("doc_id", 5) != 0) & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == 1).cast("long")).alias("toxic")).first()
    prior = min(1 - 1e-4, max(1e-4, (counts["toxic"] or 0) / max(1, counts["n"])))
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text)).where((fold("doc_id", 5) != 0) & F.col("doc_id").isNotNull())
    texts = texts.withColumn("hash", F.xxhash64("text"))
    toxic = known.where("label = 1").select("doc_id", F.lit(1).alias("toxic"))
    distinct = cut(texts.select("doc_id", "hash").join(toxic, "doc_id", "left").groupBy("hash").agg(F.count("toxic").alias("p"), F.count(F.lit(1)).alias("u")))
    rows = distinct.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).first()
    shares = [min(1.0, n / max(1, found or 0)) for n, found in ((max_positive, rows["p"]), (max_unlabelled, rows["u"]))]
    drawn = distinct.select("hash", _drawn("p", shares[0], 7).alias("p"), _drawn("u", shares[1], 8).alias("u")).where("p > 0 or u > 0")
    samples = cut(texts.select("hash", "text").join(F.broadcast(drawn), "hash").groupBy("hash").agg(*[F.first(c).alias(c) for c in ("p", "u", "text")]))
    in_p, in_u, support = _trait_counts(samples)
    sums = samples.agg(*[f(x).alias(f"{k}{n}") for k in "pu" for n, f, x in (("", F.sum, F.col(k)), ("_texts", F.count, F.when(F.col(k) > 0, 1)))]).first()
    n_p, n_u = sums["p"] or 0.0, sums["u"] or 0.0
    chosen = np.flatnonzero(choose(in_p, in_u, n_p, n_u, prior, (support, sums["p_texts"], sums["u_texts"])))

    def setup():
        return lambda hashes, p, u, found: (hashes, p, u, [np.intersect1d(traits(t.decode()), chosen).astype(np.int32) for t in found])

    fitted = map_batches(samples.select("hash", "p", "u", "text"), setup, "hash long, p double, u double, cells array<int>").collect()
    fitted.sort(key=lambda r: r["hash"])
    sides = [[np.array(r["cells"], dtype=np.int64) for r in fitted if r[side] > 0] for side in "pu"]
    weights = tuple(np.array([r[side] for r in fitted if r[side] > 0]) for side in "pu")
    return fit_nnpu(*sides, chosen, prior, weights=weights)


def score_texts(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score``: one row per input row; null and empty texts get the bias's score."""

    def setup():
        return lambda keys, held, texts: (keys, held, [model.score(t.decode()) for t in texts])

    rows = docs.select(F.col(doc_id).alias("doc_id"), (fold(doc_id, 5) == 0).alias("held_out"), text_bytes(text))
    return map_batches(rows, setup, "doc_id long, held_out boolean, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``; rows are filtered where they lie.

    All columns come back; a null text is scored like an empty one.
    """

    def rows(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield batch.filter(pa.array([model.score(t or "") < threshold for t in texts], type=pa.bool_()))

    return map_arrow(docs, rows, docs.schema)
