"""Linear-chain conditional random fields on many chains in step, in numpy.

A chain is a run of consecutive rows of an emission matrix (log potentials, rows x
labels).  All chains advance together, longest first, so one numpy call serves
the t-th word of every chain that is long enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np


class Steps:
    """Rows of the t-th place of all chains: ``at(t)`` of the chains that reach it, longest chain first."""

    def __init__(self, lengths: np.ndarray) -> None:
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        self.order = order[lengths[order] > 0]
        self.starts, self.lengths = starts[self.order], lengths[self.order]
        self.longest = int(self.lengths[0]) if len(self.lengths) else 0
        # How many chains are longer than t.
        self.active = np.searchsorted(-self.lengths, -np.arange(self.longest), side="left") if self.longest else np.zeros(0, int)

    def at(self, t: int) -> np.ndarray:
        return self.starts[: self.active[t]] + t

    def forward(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of chains, rows before, rows) of every place after the first."""
        for t in range(1, self.longest):
            rows = self.at(t)
            yield len(rows), rows - 1, rows


def viterbi(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best label of every row; of equal paths the one with smaller labels from the end."""
    n, k = emit.shape
    labels = np.zeros(n, np.int64)
    if not n:
        return labels
    steps = Steps(lengths)
    back = np.zeros((n, k), np.int8)
    score = emit.copy()
    score[steps.at(0)] += start
    for _, before, rows in steps.forward():
        paths = score[before][:, :, None] + trans
        best = paths.argmax(1)
        back[rows] = best
        score[rows] += np.take_along_axis(paths, best[:, None, :], 1)[:, 0, :]
    ends = steps.starts + steps.lengths - 1
    labels[ends] = score[ends].argmax(1)
    for t in range(steps.longest - 1, 0, -1):
        rows = steps.at(t)
        labels[rows - 1] = back[rows, labels[rows]]
    return labels


def marginals(
    emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, float, np.ndarray | None, np.ndarray | None]:
    """Posterior of every row, log partition of all chains; with ``pairs`` also expected transitions and starts.

    Probability domain, each place scaled by its own sum.
    """
    n, k = emit.shape
    if not n:
        return emit, 0.0, np.zeros((k, k)), np.zeros(k)
    steps = Steps(lengths)
    top = emit.max(1, keepdims=True)
    e = np.exp(emit - top)
    t = np.exp(trans)
    alpha, beta, scale = e.copy(), np.ones_like(e), np.empty(n, e.dtype)
    first = steps.at(0)
    alpha[first] *= np.exp(start)
    scale[first] = alpha[first].sum(1)
    alpha[first] /= scale[first][:, None]
    for _, before, rows in steps.forward():
        a = (alpha[before] @ t) * e[rows]
        s = a.sum(1)
        scale[rows] = s
        alpha[rows] = a / s[:, None]
    for i in range(steps.longest - 1, 0, -1):
        rows = steps.at(i)
        beta[rows - 1] = ((beta[rows] * e[rows]) @ t.T) / scale[rows][:, None]
    post = alpha * beta
    post /= post.sum(1, keepdims=True)
    total = float(np.log(scale, dtype=np.float64).sum() + top.sum(dtype=np.float64))
    if not pairs:
        return post, total, None, None
    later = np.ones(n, bool)
    later[first] = False
    rows = np.flatnonzero(later)
    expected = (alpha[rows - 1].T @ ((beta[rows] * e[rows]) / scale[rows][:, None])) * t
    return post, total, expected, post[first].sum(0)


def train(
    emissions: Callable[[np.ndarray], np.ndarray], gradient: Callable[[np.ndarray], np.ndarray],
    n_weights: int, lengths: np.ndarray, labels: np.ndarray, n_labels: int, rounds: int = 60, rate: float = 0.1, penalty: float = 1e-6,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, transitions, starts) by Adam on the mean log likelihood of all labelled rows.

    ``emissions(w)`` gives the rows' log potentials, ``gradient(d)`` turns their
    derivative back into one of the weights.
    """
    n = max(len(labels), 1)
    k = n_labels
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    gold = np.zeros((len(labels), k), np.float32)
    gold[np.arange(len(labels)), labels] = 1
    inner = np.ones(len(labels), bool)
    inner[first] = False
    inner = np.flatnonzero(inner)
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (labels[inner - 1], labels[inner]), 1)
    gold_start = np.bincount(labels[first], minlength=k).astype(float)
    theta = [np.zeros(n_weights, np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32)]
    m = [np.zeros_like(x) for x in theta]
    v = [np.zeros_like(x) for x in theta]
    for i in range(1, rounds + 1):
        post, _, pairs, starts = marginals(emissions(theta[0]), lengths, theta[1], theta[2], True)
        slopes = [gradient((gold - post) / n), (gold_pairs - pairs) / n, (gold_start - starts) / n]
        for j, g in enumerate(slopes):
            g = np.asarray(g - penalty * theta[j], np.float32)
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.99 * v[j] + 0.01 * g * g
            theta[j] = theta[j] + np.float32(rate) * (m[j] / (1 - 0.9**i)) / (np.sqrt(v[j] / (1 - 0.99**i)) + 1e-8)
    return theta[0], theta[1], theta[2]
