"""Steps of the language model: their products, and their results against the plain formulas."""

import numpy as np
import pytest

from ledgerscope.llm import lm


class Counted(np.ndarray):
    """Counts the multiplications of its matrix products."""

    made = 0

    def __array_ufunc__(self, ufunc, method, *inputs, out=None, **more):
        def plain(x):
            return x.view(np.ndarray) if isinstance(x, Counted) else x

        if out is not None:
            more["out"] = tuple(map(plain, out))
        result = getattr(ufunc, method)(*map(plain, inputs), **more)
        if ufunc is np.matmul:
            Counted.made += np.asarray(result).size * inputs[0].shape[-1]
        if out is not None:
            return out[0]
        return result.view(Counted) if isinstance(result, np.ndarray) else result


def model(windows=12):
    rng = np.random.default_rng(5)
    v = lm.build_vocabulary(rng.integers(0, 30, 3000), 2999)
    w = {k: x.astype(np.float64) for k, x in lm.first_weights(v).items()}
    lengths = np.array([lm.STRIDE * windows - 10, 3, 40])
    ids = rng.integers(0, 3000, lengths.sum())
    return v, w, lm.windows(v.output[ids], lengths, v.opening, ids)[:4]


def plain_logs(w, seen, pad, wanted):
    """Natural log probabilities by the formulas, a window and a place at a time."""
    out = np.zeros(wanted.shape)
    for i in range(len(seen)):
        x = w["embed"][seen[i]] + w["place"]
        for j in range(lm.STRIDE):
            at = lm.WINDOW - lm.STRIDE + j
            sees = ~pad[i] & (np.arange(lm.WINDOW) <= at)
            s = np.exp((x @ w["k"])[sees] @ (x[at] @ w["q"]) * lm.WIDTH**-0.5)
            h = x[at] + (s / s.sum()) @ (x @ w["v"])[sees] @ w["o"]
            z = h + np.maximum(h @ w["up"] + w["up0"], 0) @ w["down"]
            group, member = divmod(wanted[i, j], lm.MEMBERS)
            for logits, which in ((z @ w["group"] + w["group0"], group), (z @ w["member"][group] + w["member0"][group], member)):
                out[i, j] += logits[which] - np.log(np.exp(logits).sum())
    return out


def test_log_probabilities_are_those_of_the_formulas():
    _, w, (seen, pad, wanted, real) = model(3)
    assert np.allclose(lm.log_probability(w, seen, pad, wanted), plain_logs(w, seen, pad, wanted), rtol=1e-10)
    loss, _, _ = lm._gradients(w, seen, pad, wanted, real)
    assert loss == pytest.approx(-plain_logs(w, seen, pad, wanted)[real].mean(), rel=1e-10)


def test_a_step_multiplies_little_for_places_that_are_only_seen():
    _, w, (seen, pad, wanted, real) = model()
    counted = {k: x.view(Counted) for k, x in w.items()}
    Counted.made = 0
    _, g, _ = lm._gradients(counted, seen, pad, wanted, real)
    per_place = Counted.made / wanted.size
    _, expected, _ = lm._gradients(w, seen, pad, wanted, real)
    assert all(np.allclose(g[k], expected[k]) for k in expected)
    # forth and back: attention over what is seen, and eleven matrices for the place itself
    attention = 5 * lm.WINDOW * lm.WIDTH
    matrices = 3 * (lm.WIDTH + 1) * (2 * lm.WIDTH + 2 * lm.HIDDEN + lm.GROUPS + lm.MEMBERS)
    assert per_place <= 1.25 * (attention + matrices)


@pytest.mark.parametrize("by", [1, 300])
def test_softmax_gradient_of_any_logits(by):
    rng = np.random.default_rng(6)
    logits, wanted, share = rng.standard_normal((50, 8)) * by, rng.integers(0, 8, 50), rng.random(50)
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    expected = e / e.sum(axis=1, keepdims=True)
    loss = -(np.log(np.maximum(expected[np.arange(50), wanted], 1e-30)) * share).sum()
    expected[np.arange(50), wanted] -= 1
    assert lm._softmax_gradient(logits, wanted, share, True) == pytest.approx(loss, rel=1e-9)
    assert np.allclose(logits, expected * share[:, None], atol=1e-12)


def test_adam_moves_only_the_embeddings_it_is_given():
    _, w, parts = model(2)
    moved, before = {k: x.copy() for k, x in w.items()}, w["embed"].copy()
    _, g, ids = lm._gradients(w, *parts)
    adam = lm.Adam(moved, 0.1)
    for _ in range(2):
        adam.step(moved, g, ids)
    others = np.setdiff1d(np.arange(len(before)), ids)
    assert (moved["embed"][others] == before[others]).all()
    # of a gradient that stays, a step is of the rate
    for k in w:
        at = ids if k == "embed" else slice(None)
        sure = np.abs(g[k]) > 1e-4
        assert np.allclose((moved[k][at] - w[k][at])[sure], -0.2 * np.sign(g[k])[sure], rtol=0.02)
