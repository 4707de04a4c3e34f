"""Language-model scores of whole texts: a word-unigram base and a causal self-attention model.

Counts are taken over every training text: word counts by a shuffled aggregation, sub-word
counts from the distinct words. The attention model is trained in numpy inside Spark tasks on every
training text, once: the texts are dealt into one block a round; each round the tasks start from the
same weights, learn from their texts of the block, and the weights are averaged by Spark.

The model reads sub-word ids of the lower-cased words, each by an embedding of its own. It predicts in two
steps: the group of the next id, then the id among its group. The commonest ids are members of their own;
the last group's members are classes of the rarer ids, which share a class by their corpus frequency. A text is scored in
overlapping windows: each window sees ``WINDOW`` ids, and only its last ``STRIDE`` are scored, so that
every id is scored once with at least ``WINDOW - STRIDE`` ids before it (or all there are).
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut, fold, map_batches, text_bytes

WINDOW, STRIDE = 64, 32
#: groups and members of each, width of the model, of its hidden layer
GROUPS, MEMBERS, WIDTH, HIDDEN = 40, 32, 16, 32
#: ids that are members of their own
HEAD = (GROUPS - 1) * MEMBERS
#: rounds, of which each learns from a block of its own; rate of the first; windows of a step
ROUNDS, RATE, BATCH = 3, 4e-3, 128
#: sub-word ids that a task learns from at least, where there are as many, whatever the input files are
TRAINER_IDS = 1_000_000
#: words looked up map-side are those with at least one in FREQUENT of all tokens: at most FREQUENT words
FREQUENT = 2_000_000
SMOOTH = 0.1
LN10 = float(np.log(10.0))


class SubWords:
    """Sub-word ids of words, as the byte-level BPE splits " word"; an id of its own ends a text."""

    def __init__(self, name: str = "byte_bpe_50k.tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = len(ranks)
        self.size = self.end + 1
        self._encode = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        #: whether an id opens a word
        self._opens = np.zeros(self.end, dtype=bool)
        self._opens[[i for b, i in ranks.items() if b[:1] == b" "]] = True

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has."""
        if not words:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        # words hold no blank, so a blank opens each word and nothing else
        ids = np.array(self._encode(" " + b" ".join(words).decode()), dtype=np.int64)
        firsts = np.flatnonzero(self._opens[ids])
        return ids, np.diff(np.append(firsts, len(ids)))


def word_codes(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of the texts, the code of every word in order, and the words in each text.

    Words are runs of anything but ASCII white space, A-Z lower-cased.
    """
    lowered = pa.array([t.lower() for t in texts], type=pa.large_binary()).view(pa.large_string())
    split = pc.ascii_split_whitespace(lowered)
    flat = split.flatten()
    coded = flat.dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    counts = np.diff(split.offsets.to_numpy())
    if b"" in words:
        # white space at the ends leaves empty pieces
        none = words.index(b"")
        real = codes != none
        counts = np.bincount(np.repeat(np.arange(len(texts)), counts)[real], minlength=len(texts))
        codes = codes[real]
        codes = codes - (codes > none)
        del words[none]
    return words, codes.astype(np.int64), counts.astype(np.int64)


# ---------------------------------------------------------------- corpus counts


def word_counts(training: DataFrame) -> DataFrame:
    """``word binary, n``: how often each word stands in the training texts; the end is not a row."""

    def setup():
        def work(texts):
            words, codes, _ = word_codes(texts)
            return words, np.bincount(codes, minlength=len(words)).tolist()

        return work

    return map_batches(training.select("text"), setup, "word binary, n long", rows=2048).groupBy("word").agg(F.sum("n").alias("n"))


def sub_word_counts(counts: DataFrame, size: int) -> np.ndarray:
    """Corpus frequency of each sub-word id, from the distinct words."""

    def setup():
        table = SubWords()
        total = np.zeros(table.size, dtype=np.int64)

        def work(words, ns):
            ids, sizes = table.encode(words)
            np.add.at(total, ids, np.repeat(np.array(ns, dtype=np.int64), sizes))
            return [], []

        def finish():
            at = np.flatnonzero(total)
            yield at.tolist(), total[at].tolist()

        work.finish = finish
        return work

    out = np.zeros(size, dtype=np.int64)
    for r in map_batches(counts, setup, "id int, n long", rows=4096).groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


# ---------------------------------------------------------------- the attention model


@dataclass(frozen=True)
class Vocabulary:
    """Output of an id: its own, or a class's output and log10 of its share in the class.

    ``total`` counts the ids of the training texts.
    """

    output: np.ndarray
    within: np.ndarray
    prior: np.ndarray
    end: int
    total: int

    @property
    def start(self) -> int:
        return len(self.prior)

    @property
    def opening(self) -> int:
        """What stands before a text, among the ids that the model reads."""
        return len(self.output)


def build_vocabulary(frequency: np.ndarray, end: int) -> Vocabulary:
    order = np.lexsort((np.arange(len(frequency)), -frequency))
    order = np.concatenate([[end], order[order != end]])
    output, within = np.zeros(len(frequency), dtype=np.int64), np.zeros(len(frequency))
    smooth = frequency + SMOOTH
    # neighbours in frequency go to different groups, so that groups are alike in size
    output[order[:HEAD]] = np.arange(HEAD) % (GROUPS - 1) * MEMBERS + np.arange(HEAD) // (GROUPS - 1)
    tail = order[HEAD:]
    mass = np.cumsum(smooth[tail])
    classes = np.minimum((mass - smooth[tail] / 2) / mass[-1] * MEMBERS, MEMBERS - 1).astype(np.int64)
    output[tail] = HEAD + classes
    totals = np.bincount(classes, weights=smooth[tail], minlength=MEMBERS)
    within[tail] = np.log10(smooth[tail] / totals[classes])
    by_output = np.bincount(output, weights=smooth, minlength=GROUPS * MEMBERS) + 1e-9
    return Vocabulary(output, within, by_output / by_output.sum(), end, int(frequency.sum()))


Weights = dict[str, np.ndarray]


def first_weights(v: Vocabulary, seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    d, h, n = WIDTH, HIDDEN, len(v.prior)
    of_group = v.prior.reshape(GROUPS, MEMBERS).sum(axis=1)

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        # one row an id and one for the opening; ids of a class start alike and then learn apart
        "embed": normal(n + 1, d, scale=0.3)[np.append(v.output, n)],
        "place": normal(WINDOW, d, scale=0.1),
        "q": normal(d, d, scale=d**-0.5),
        "k": normal(d, d, scale=d**-0.5),
        "v": normal(d, d, scale=d**-0.5),
        "o": normal(d, d, scale=0.5 * d**-0.5),
        "up": normal(d, h, scale=d**-0.5),
        "up0": np.zeros(h, dtype=np.float32),
        "down": normal(h, d, scale=0.5 * h**-0.5),
        "group": normal(d, GROUPS, scale=0.1),
        "group0": np.log(of_group).astype(np.float32),
        "member": normal(GROUPS, d, MEMBERS, scale=0.1),
        "member0": np.log(v.prior.reshape(GROUPS, MEMBERS) / of_group[:, None]).astype(np.float32),
    }


#: what a scored place may see: itself and what stands before it in the window
_CAUSAL = np.where(np.arange(WINDOW)[None, :] <= np.arange(WINDOW - STRIDE, WINDOW)[:, None], 60.0, -1e9).astype(np.float32)


def hidden(w: Weights, seen: np.ndarray, pad: np.ndarray):
    """What the last places know (places, WIDTH), and the steps to it.

    The matrices of queries and keys are one product, as are those of values and output, so that nothing is projected
    for the places that are only seen.
    """
    x = w["embed"].take(seen, axis=0)
    x += w["place"]
    y = x[:, WINDOW - STRIDE :].reshape(-1, WIDTH)
    q = (y @ (w["q"] @ w["k"].T * np.float32(WIDTH**-0.5))).reshape(-1, STRIDE, WIDTH)
    s = q @ x.transpose(0, 2, 1)
    np.minimum(s, _CAUSAL, out=s)  # at most 60, and nothing of what comes later
    first = np.flatnonzero(pad[:, 0])
    if len(first):  # the first window of a text has empty places
        s[first] += np.where(pad[first], np.float32(-1e9), np.float32(0))[:, None, :]
    np.exp(s, out=s)
    mass = s.reshape(-1, WINDOW) @ np.ones((WINDOW, 1), dtype=s.dtype) + np.float32(1e-30)
    a = (s @ x).reshape(-1, WIDTH)
    a /= mass
    h = a @ (w["v"] @ w["o"])
    h += y
    u = h @ w["up"]
    u += w["up0"]
    u *= u > 0
    z = u @ w["down"]
    z += h
    return z, (x, y, q, s, mass, a, h, u)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[1], dtype=logits.dtype))[:, None]
    return logits


def _picked(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log softmax of the wanted column of each row."""
    rows = np.arange(len(logits))
    out = logits[rows, wanted]
    total = np.exp(logits) @ np.ones(logits.shape[1], dtype=logits.dtype)
    if not np.isfinite(total).all():
        p = _softmax(logits.astype(np.float64))
        return np.log(np.maximum(p[rows, wanted], 1e-300))
    return out - np.log(np.maximum(total, np.float32(1e-37)))


def _by_group(groups: np.ndarray):
    """Rows of each group that occurs."""
    order = np.argsort(groups.astype(np.int8), kind="stable")
    edges = np.searchsorted(groups[order], np.arange(GROUPS + 1))
    for g in range(GROUPS):
        if edges[g] < edges[g + 1]:
            yield g, order[edges[g] : edges[g + 1]]


def log_probability(w: Weights, seen: np.ndarray, pad: np.ndarray, wanted: np.ndarray, at_once: int = 64) -> np.ndarray:
    """Natural log probability of the wanted output at each scored place."""
    # a last column of ones carries the biases
    z = np.ones((len(seen) * STRIDE, WIDTH + 1), dtype=w["group"].dtype)
    for i in range(0, len(seen), at_once):
        part = hidden(w, seen[i : i + at_once], pad[i : i + at_once])[0]
        z[i * STRIDE : i * STRIDE + len(part), :WIDTH] = part
    group = np.vstack([w["group"], w["group0"]])
    member = np.concatenate([w["member"], w["member0"][:, None, :]], axis=1)
    groups, members = np.divmod(wanted.ravel().astype(np.int32), MEMBERS)
    out = np.empty(len(z))
    for i in range(0, len(z), 2048):
        out[i : i + 2048] = _picked(z[i : i + 2048] @ group, groups[i : i + 2048])
    for g, at in _by_group(groups):
        out[at] += _picked(z[at] @ member[g], members[at])
    return out.reshape(wanted.shape)


def gradients(w: Weights, seen: np.ndarray, pad: np.ndarray, wanted: np.ndarray, real: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over the ``real`` places of windows and its gradient."""
    loss, g, ids = _gradients(w, seen, pad, wanted, real)
    every = np.zeros_like(w["embed"])
    every[ids] = g["embed"]
    return loss, {**g, "embed": every}


def _softmax_gradient(logits: np.ndarray, wanted: np.ndarray, share: np.ndarray, losses: bool) -> float:
    """Logits become the gradient of their softmax's loss at the wanted column, each row with its share; the loss."""
    rows = np.arange(len(logits))
    total = None
    if logits.max(initial=0) < 60 and (at_wanted := logits[rows, wanted]).min(initial=0) > -60:
        np.exp(logits, out=logits)
        total = logits @ np.ones(logits.shape[1], dtype=logits.dtype)
        loss = float(((np.log(total) - at_wanted) * share).sum()) if losses else 0.0
        logits *= (share / total)[:, None]
    else:
        _softmax(logits)
        loss = float(-(np.log(np.maximum(logits[rows, wanted], 1e-30)) * share).sum()) if losses else 0.0
        logits *= share[:, None]
    logits[rows, wanted] -= share
    return loss


def _gradients(w: Weights, seen: np.ndarray, pad: np.ndarray, wanted: np.ndarray, real: np.ndarray, losses: bool = True) -> tuple[float, Weights, np.ndarray]:
    """Mean loss (0 without ``losses``), its gradient, and the ids whose embeddings the gradient's "embed" is of."""
    z, (x, y, q, s, mass, a, h, u) = hidden(w, seen, pad)
    dtype = z.dtype
    groups, members = np.divmod(wanted.ravel().astype(np.int32), MEMBERS)
    share = (real.ravel() / max(1, int(real.sum()))).astype(dtype)
    # a last column of ones carries the biases
    z = np.hstack([z, np.ones((len(z), 1), dtype=dtype)])
    g: Weights = {}

    p = z @ np.vstack([w["group"], w["group0"]])
    loss = _softmax_gradient(p, groups, share, losses)
    t = z.T @ p
    g["group"], g["group0"] = t[:-1], t[-1]
    dz = p @ w["group"].T

    # rows by group, so that only the products are made group by group
    order = np.argsort(groups.astype(np.int8), kind="stable")
    edges = np.searchsorted(groups[order], np.arange(GROUPS + 1)).tolist()
    cuts = [(i, slice(edges[i], edges[i + 1])) for i in range(GROUPS) if edges[i] < edges[i + 1]]
    member = np.concatenate([w["member"], w["member0"][:, None, :]], axis=1)
    zs, p = z.take(order, axis=0), np.empty((len(z), MEMBERS), dtype=dtype)
    for i, at in cuts:
        np.matmul(zs[at], member[i], out=p[at])
    loss += _softmax_gradient(p, members[order], share[order], losses)
    t, back = np.zeros_like(member), np.empty((len(z), WIDTH), dtype=dtype)
    for i, at in cuts:
        np.matmul(zs[at].T, p[at], out=t[i])
        np.matmul(p[at], w["member"][i].T, out=back[at])
    g["member"], g["member0"] = t[:, :-1], t[:, -1]
    places = np.empty_like(order)
    places[order] = np.arange(len(order))
    dz += back.take(places, axis=0)

    g["down"] = u.T @ dz
    du = dz @ w["down"].T
    du *= u > 0
    g["up"], g["up0"] = h.T @ du, np.ones(len(du), dtype=dtype) @ du
    dh = du @ w["up"].T
    dh += dz
    scale = np.float32(WIDTH**-0.5)
    t = a.T @ dh
    g["v"], g["o"] = t @ w["o"].T, w["v"].T @ t
    da = dh @ (w["v"] @ w["o"]).T
    da /= mass
    # what the mean over a place's softmax takes off its scores' gradient is taken off the rows in its place
    mean = np.einsum("ij,ij->i", da, a)[:, None]
    da, rows = da.reshape(q.shape), q.reshape(a.shape)
    ds = da @ x.transpose(0, 2, 1)
    ds *= s
    dx = ds.transpose(0, 2, 1) @ q
    dx += s.transpose(0, 2, 1) @ (da - (mean * rows).reshape(q.shape))
    dq = (ds @ x).reshape(a.shape)
    dq -= mean * mass * a
    t = y.T @ dq * scale
    g["q"], g["k"] = t @ w["k"], t.T @ w["q"]
    dy = dq @ (w["k"] @ w["q"].T * scale)
    dy += dh
    dx[:, WINDOW - STRIDE :] += dy.reshape(-1, STRIDE, WIDTH)
    g["place"] = (np.ones(len(dx), dtype=dtype) @ dx.reshape(len(dx), -1)).reshape(WINDOW, WIDTH)
    flat = seen.ravel()
    order = np.argsort(flat.astype(np.uint16) if len(w["embed"]) <= 1 << 16 else flat, kind="stable")
    ids = flat[order]
    firsts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    g["embed"] = np.add.reduceat(dx.reshape(-1, WIDTH).take(order, axis=0), firsts, axis=0)
    return loss, g, ids[firsts]


class Adam:
    def __init__(self, w: Weights, rate: float):
        self.rate, self.t = rate, 0
        self.dense = [k for k in w if k != "embed"]
        self.edges = np.cumsum([0, *(w[k].size for k in self.dense)]).tolist()
        self.embed = [np.zeros_like(w["embed"]) for _ in range(2)]
        self.rest = [np.zeros(self.edges[-1], dtype=w["embed"].dtype) for _ in range(2)]

    def _move(self, m: np.ndarray, s: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The step by a gradient; ``m`` and ``s`` take it in."""
        m *= 0.9
        m += 0.1 * g
        s *= 0.99
        g *= g
        g *= 0.01
        s += g
        root = np.sqrt(s / (1 - 0.99**self.t))
        root += 1e-6
        np.divide(m, root, out=root)
        root *= self.rate / (1 - 0.9**self.t)
        return root

    def step(self, w: Weights, g: Weights, ids: np.ndarray) -> None:
        """``g["embed"]`` is of the embeddings of ``ids``; the others stay as they are."""
        self.t += 1
        moved = self._move(*self.rest, np.concatenate([g[k].ravel() for k in self.dense]))
        for k, a, b in zip(self.dense, self.edges, self.edges[1:]):
            w[k] -= moved[a:b].reshape(w[k].shape)
        m, s = (x[ids] for x in self.embed)
        w["embed"][ids] -= self._move(m, s, g["embed"].copy())
        self.embed[0][ids], self.embed[1][ids] = m, s


def windows(
    outputs: np.ndarray, lengths: np.ndarray, start: int, inputs: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows over the texts whose outputs (and what is read for each, if that differs) stand one after the other.

    Returns what each window sees (windows, WINDOW), which of it is empty, the wanted outputs
    (windows, STRIDE), which places are real, and the position in ``outputs`` of each wanted one.
    """
    n = -(-lengths // STRIDE)
    first = np.repeat(np.cumsum(lengths) - lengths, n)
    length = np.repeat(lengths, n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    wanted_at = k[:, None] * STRIDE + np.arange(STRIDE)
    real = wanted_at < length[:, None]
    at = np.where(real, first[:, None] + wanted_at, first[:, None])
    # place j of a window sees the id before the one wanted there
    before = k[:, None] * STRIDE + np.arange(STRIDE - WINDOW, STRIDE) - 1
    inside = (before >= 0) & (before < length[:, None])
    seen = np.where(inside, (outputs if inputs is None else inputs)[np.where(inside, first[:, None] + before, 0)], start)
    return seen, before < -1, outputs[at], real, at


def _encoder(v: Vocabulary):
    """A function from texts to words, counts and flat sub-word ids; keeps the ids of words met."""
    table = SubWords()
    known: dict[bytes, bytes] = {}

    def encode(texts):
        words, codes, counts = word_codes(texts)
        if len(known) > 300_000:
            known.clear()
        new = [w for w in words if w not in known]
        ids, sizes = table.encode(new)
        raw, at = ids.astype(np.int32).tobytes(), [0, *(np.cumsum(sizes) * 4).tolist()]
        known.update(zip(new, (raw[a:b] for a, b in zip(at, at[1:]))))
        # the end of a text is one more word
        found = [*map(known.__getitem__, words), np.int32(v.end).tobytes()]
        sizes = np.array(list(map(len, found)), dtype=np.int64) // 4
        flat = np.frombuffer(b"".join(found), dtype=np.int32)
        ends = np.cumsum(counts)
        codes = np.insert(codes, ends, len(words))
        firsts = np.cumsum(sizes) - sizes
        each = sizes[codes]
        before = np.cumsum(each) - each
        places = np.arange(int(each.sum()), dtype=np.int32) + np.repeat((firsts[codes] - before).astype(np.int32), each)
        of_text = np.add.reduceat(each, np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])[:-1]) if len(counts) else counts
        return words, codes, counts, flat[places], of_text

    return encode


def _train_round(texts: DataFrame, v: Vocabulary, start: Weights, rate: float) -> Weights:
    """Every task trains on its texts from ``start``; the mean over the tasks, weighted by their ids.

    The mean of an embedding is over the tasks that met its id.
    """
    names = sorted(k for k in start if k != "embed")
    sent = texts.sparkSession.sparkContext.broadcast((v, start))
    columns = [f"w{i}" for i in range(WIDTH)]

    def in_rows(w):
        """The weights in rows of WIDTH: the embeddings, then all others."""
        flat = np.concatenate([w[k].ravel() for k in names])
        return np.vstack([w["embed"], np.pad(flat, (0, -len(flat) % WIDTH)).reshape(-1, WIDTH)])

    def setup():
        v, start = sent.value
        encode = _encoder(v)
        w = {k: x.copy() for k, x in start.items()}
        adam, rng, kept, total = Adam(w, rate), np.random.default_rng(11), [], [0]
        met = np.zeros(len(w["embed"]))

        def learn(least):
            while kept and sum(len(x[0]) for x in kept) >= least:
                parts = [np.concatenate(x) for x in zip(*kept)]
                kept.clear()
                order = rng.permutation(len(parts[0]))
                for i in range(0, len(order), BATCH):
                    adam.step(w, *_gradients(w, *(p[order[i : i + BATCH]] for p in parts), losses=False)[1:])

        def work(texts):
            _, _, _, ids, lengths = encode(texts)
            seen, pad, wanted, real, _ = windows(v.output[ids], lengths, v.opening, ids)
            kept.append((seen, pad, wanted, real))
            total[0] += len(ids)
            met[:-1] += np.bincount(ids, minlength=len(met) - 1)
            met[-1] += len(lengths)
            learn(64 * BATCH)
            return [[]] * (2 + WIDTH)

        def finish():
            learn(1)
            if total[0]:
                rows = in_rows(w).astype(np.float64)
                # an embedding counts as often as the task met its id
                ids = np.concatenate([met, np.full(len(rows) - len(met), float(total[0]))])
                at = np.flatnonzero(ids)
                rows = rows[at] * ids[at, None]
                yield pa.array(at.astype(np.int32)), pa.array(ids[at]), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)

        work.finish = finish
        return work

    schema = ", ".join(["at int", "ids double", *(f"{c} double" for c in columns)])
    means = map_batches(texts.select("text"), setup, schema).groupBy("at").agg(*[(F.sum(c) / F.sum("ids")).alias(c) for c in columns])
    found = means.toArrow()
    sent.unpersist()
    rows = in_rows(start)
    rows[found["at"].to_numpy()] = np.column_stack([found[c].to_numpy() for c in columns])
    embed, flat = rows[: len(start["embed"])], rows[len(start["embed"]) :].ravel()
    cuts = np.split(flat, np.cumsum([start[k].size for k in names]))
    return {"embed": embed} | {k: c.reshape(start[k].shape) for k, c in zip(names, cuts)}


def blocks(training: DataFrame, total: int) -> list[DataFrame]:
    """The training texts in ``ROUNDS`` parts by id hash, each text in one; ``total`` ids give the number of tasks."""
    tasks = max(1, total // TRAINER_IDS)
    block = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(ROUNDS))
    return [training.where(block == F.lit(r)).coalesce(tasks) for r in range(ROUNDS)]


def train(training: DataFrame, texts: int, v: Vocabulary) -> Weights:
    """The attention model from all training texts, each seen once."""
    w = first_weights(v)
    if texts:
        for r, block in enumerate(blocks(training, v.total)):
            w = _train_round(block, v, w, RATE * 0.5**r)
    return w


# ---------------------------------------------------------------- scores


def _frequent(counts: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the words with at least ``least`` occurrences, by hash."""
    found = counts.where(F.col("n") >= F.lit(least)).select(F.xxhash64("word").alias("h"), "n").toArrow()
    h, n = found["h"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    Learns from rows whose crc32(id) mod 10 is not 0; the others (null ids too) are held out. Null and
    empty texts are one end token. Scores are log10 probabilities. One row per input row, repeated
    rows included; other columns are ignored; an empty table gives no rows. Without training texts
    every token has the same base probability.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text), (fold(doc_id, 10) == 0).alias("held_out"))
    training = rows.where(~F.col("held_out")).select("doc_id", "text")
    counts = cut(word_counts(training))
    texts = training.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total = (sums["n"] or 0) + texts
    distinct = sums["v"] + (texts > 0)
    whole = total + SMOOTH * (distinct + 1)
    table = SubWords()
    frequency = sub_word_counts(counts, table.size)
    frequency[table.end] = texts
    v = build_vocabulary(frequency, table.end)
    weights = train(training, texts, v)
    frequent = spark.sparkContext.broadcast(_frequent(counts, max(1.0, total / FREQUENT)))
    model = spark.sparkContext.broadcast((v, weights))

    def log10_share(n):
        return np.log10((n + SMOOTH) / whole)

    def setup():
        (hashes, numbers), (vocabulary, w) = frequent.value, model.value
        encode = _encoder(vocabulary)
        part, made = TaskContext.get().partitionId(), [0]

        def work(keys, held, batch):
            words, codes, counted, ids, lengths = encode(batch)
            # base: frequent words are looked up here, the others go out by text
            own = np.array([xxhash.xxh64_intdigest(x, 42) for x in words], dtype=np.uint64).view(np.int64)
            at = np.minimum(np.searchsorted(hashes, own), max(0, len(hashes) - 1))
            here = hashes[at] == own if len(hashes) else np.zeros(len(own), dtype=bool)
            number = np.where(here, numbers[at] if len(numbers) else 0, 0)
            base = np.append(np.where(here, log10_share(number), 0.0), log10_share(texts))
            of_text = np.repeat(np.arange(len(keys)), counted + 1)
            known = np.append(here, texts > 0)[codes]
            n_known = np.bincount(of_text, weights=known, minlength=len(keys)).astype(np.int64)
            bases = np.bincount(of_text, weights=base[codes], minlength=len(keys))
            away = np.flatnonzero(~np.append(here, True)[codes])
            pairs, times = np.unique(of_text[away] * (len(words) + 1) + codes[away], return_counts=True)
            owner = pairs // (len(words) + 1)
            rare, repeats = [[] for _ in keys], [[] for _ in keys]
            for t, c, n in zip(owner.tolist(), (pairs % (len(words) + 1)).tolist(), times.tolist()):
                rare[t].append(words[c])
                repeats[t].append(n)
            scores = _score(w, vocabulary, ids, lengths)
            row = [(part << 40) + made[0] + i for i in range(len(keys))]
            made[0] += len(keys)
            return row, keys, held, (counted + 1).tolist(), n_known.tolist(), bases.tolist(), scores.tolist(), pa.array(rare, pa.list_(pa.binary())), repeats

        return work

    # written once, so that the row numbers hold whatever is computed again
    partly = cut(
        map_batches(
            rows.select("doc_id", "held_out", "text"),
            setup,
            "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<binary>, repeats array<long>",
            rows=512,
        )
    )
    pieces = partly.select("row", F.explode(F.arrays_zip("rare", "repeats")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.repeats").alias("times"))
    logs = F.log10((F.coalesce("n", F.lit(0)) + F.lit(SMOOTH)) / F.lit(whole))
    rare = (
        pieces.join(counts, "word", "left")
        .groupBy("row")
        .agg(F.sum(logs * F.col("times")).alias("rare_base"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"))
    )
    return partly.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def _score(w: Weights, v: Vocabulary, ids: np.ndarray, lengths: np.ndarray, at_once: int = 1024) -> np.ndarray:
    """log10 probability of each text: classes by attention, ids within their class by frequency."""
    outputs = v.output[ids]
    seen, pad, wanted, real, at = windows(outputs, lengths, v.opening, ids)
    by_id = v.within[ids]
    for i in range(0, len(seen), at_once):
        cutout = slice(i, i + at_once)
        logs = log_probability(w, seen[cutout], pad[cutout], wanted[cutout])
        by_id[at[cutout][real[cutout]]] += logs[real[cutout]] / LN10
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(owner, weights=by_id, minlength=len(lengths))
