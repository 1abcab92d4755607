"""Linear-chain conditional random fields over many short chains at once, in numpy.

A chain's positions have log potentials per state, and neighbouring positions share one table of
transitions. Chains stand one after the other; all of them advance together, longest first, so that
the work of a step is on whole arrays.
"""

from __future__ import annotations

import numpy as np


def _steps(lengths: np.ndarray):
    """Start of each chain, longest first, and how many chains are longer than each step."""
    offsets = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max()) if len(lengths) else 0
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")
    return offsets[order], active


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray):
    """Marginal probabilities of every position, and expected transitions summed over all chains."""
    n, states = scores.shape
    if not n:
        return np.zeros((0, states)), np.zeros((states, states))
    starts, active = _steps(lengths)
    local = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    ahead, behind = np.empty_like(local), np.ones_like(local)
    for t, m in enumerate(active):
        at = starts[:m] + t
        here = local[at] if t == 0 else (ahead[at - 1] @ step) * local[at]
        ahead[at] = here / here.sum(1, keepdims=True)
    for t in range(len(active) - 1, 0, -1):
        at = starts[:active[t]] + t
        back = (local[at] * behind[at]) @ step.T
        behind[at - 1] = back / back.sum(1, keepdims=True)
    marginals = ahead * behind
    marginals /= marginals.sum(1, keepdims=True)
    last = np.zeros(n, bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    from_, to = np.flatnonzero(~last), np.flatnonzero(~last) + 1
    pairs = ahead[from_][:, :, None] * step * (local[to] * behind[to])[:, None, :]
    pairs /= pairs.sum((1, 2), keepdims=True)
    return marginals, pairs.sum(0)


def _gold_pairs(gold: np.ndarray, lengths: np.ndarray, states: int) -> np.ndarray:
    last = np.zeros(len(gold), bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    at = np.flatnonzero(~last)
    return np.bincount(gold[at] * states + gold[at + 1], minlength=states * states).reshape(states, states)


def summed(weights: np.ndarray, features: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Weights of all features of each position; ``owner`` is the position of each feature, in any order."""
    rows = weights[features]
    return np.stack([np.bincount(owner, rows[:, s], n) for s in range(weights.shape[1])], 1)


def fit(features: np.ndarray, owner: np.ndarray, size: int, gold: np.ndarray, lengths: np.ndarray, states: int, rounds: int = 60, rate: float = 0.2, decay: float = 1e-4):
    """Weights (size, states) and transitions that fit the gold states, by Adam on the whole sample.

    ``features`` are numbers below ``size`` and ``owner`` the position that has each; a position may
    have any number of them.
    """
    weights, transitions = np.zeros((size, states)), np.zeros((states, states))
    truth, pairs = np.eye(states)[gold], _gold_pairs(gold, lengths, states)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, transitions)]
    for turn in range(1, rounds + 1):
        marginals, expected = forward_backward(summed(weights, features, owner, len(gold)), lengths, transitions)
        error = (truth - marginals)[owner]
        slope = np.stack([np.bincount(features, error[:, s], size) for s in range(states)], 1) / len(gold) - decay * weights
        slopes = (slope, (pairs - expected) / len(gold) - decay * transitions)
        for x, g, (first, second) in zip((weights, transitions), slopes, moments, strict=True):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            x += rate * (first / (1 - 0.9 ** turn)) / (np.sqrt(second / (1 - 0.99 ** turn)) + 1e-8)
    return weights, transitions


def logistic(x: np.ndarray, y: np.ndarray, prior: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by damped Newton steps, with a small Gaussian prior."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - prior * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + prior * np.eye(len(w))
        w += np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w
