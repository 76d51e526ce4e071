"""Linear-chain conditional random field with two states, many chains at a time."""

from __future__ import annotations

import numpy as np


def marginals(node: np.ndarray, first: np.ndarray, step: np.ndarray, pairs: bool = False):
    """Probability of "good" for every line (forward-backward over all chains at once).

    ``step``: scores of the four transitions (bad-bad, bad-good, good-bad, good-good). With
    ``pairs`` also the expected transition counts and the chains' log normalisers.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    t = np.exp(step - step.max()).reshape(2, 2)
    shift = step.max()
    high = np.maximum(node, 0)
    emit = np.stack([np.exp(-high), np.exp(node - high)], 1)
    alpha = np.empty((len(node), 2))
    scale = np.empty(len(node))
    for k in range(longest):
        at = begin[:live[k]] + k
        now = emit[at] if k == 0 else (alpha[at - 1] @ t) * emit[at]
        scale[at] = now.sum(1)
        alpha[at] = now / scale[at, None]
    beta = np.ones((len(node), 2))
    counts = np.zeros((2, 2))
    for k in range(longest - 1, 0, -1):
        at = begin[:live[k]] + k
        down = beta[at] * emit[at] / scale[at, None]
        beta[at - 1] = down @ t.T
        if pairs:
            counts += (alpha[at - 1].T @ down) * t
    good = alpha[:, 1] * beta[:, 1]
    good = good / np.maximum(good + alpha[:, 0] * beta[:, 0], 1e-300)
    if not pairs:
        return good
    lines = len(node) - len(size)
    return good, counts, float(np.log(scale).sum() + high.sum() + shift * lines)


def viterbi(node: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The likeliest states of every chain (``True``: good); ties go to bad."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    t = step.reshape(2, 2)
    score = np.zeros((len(begin), 2))
    came = np.zeros((len(node), 2), np.int8)
    for k in range(longest):
        at, now = begin[:live[k]] + k, score[:live[k]]
        if k:
            both = now[:, :, None] + t[None]
            came[at] = both.argmax(1)
            now = both.max(1)
        score[:live[k]] = now
        score[:live[k], 1] += node[at]
    out = np.zeros(len(node), bool)
    state = score.argmax(1)
    for k in range(longest - 1, -1, -1):
        at = begin[:live[k]] + k
        out[at] = state[:live[k]] == 1
        state[:live[k]] = came[at, state[:live[k]]]
    return out
