"""Linear-chain conditional random field of two states, in numpy, for many short chains or
few long ones: all chains advance together."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def messages(weight: np.ndarray, starts: np.ndarray, lengths: np.ndarray, start: float,
             potential: np.ndarray) -> np.ndarray:
    """Marginal probability of the toxic state for each token of texts that lie one
    after the other. ``weight`` is the toxic state's lead, ``potential[i, j]`` the
    factor of a step from i to j. All texts advance together, longest first."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1 if len(lengths) else 1), side="right")
    (t00, t01), (t10, t11) = potential
    ahead = np.zeros(len(weight))
    lead = None
    for t, many in enumerate(active):
        at = starts[:many] + t
        if t == 0:
            lead = weight[at] + start
        else:
            odds = np.exp(np.clip(lead[:many], -30, 30))
            lead = weight[at] + np.log((t01 + t11 * odds) / (t00 + t10 * odds))
        ahead[at] = lead
    back = np.zeros(len(weight))
    ends = starts + lengths - 1
    lead = None
    for t, many in enumerate(active):
        at = ends[:many] - t
        if t == 0:
            lead = np.zeros(many)
        else:
            odds = np.exp(np.clip(lead[:many] + weight[at + 1], -30, 30))
            lead = np.log((t10 + t11 * odds) / (t00 + t01 * odds))
        back[at] = lead
    return 1 / (1 + np.exp(-np.clip(ahead + back, -60, 60)))


def best_path(weight: np.ndarray, start: float, potential: np.ndarray) -> np.ndarray:
    """Viterbi: the most likely states of one chain."""
    step = np.log(potential)
    clean, other = 0.0, float(weight[0]) + start
    back = []
    for w in weight[1:].tolist():
        stay, rise = clean + step[0, 0], clean + step[0, 1]
        fall, keep = other + step[1, 0], other + step[1, 1]
        back.append((stay < fall, rise < keep))
        clean, other = max(stay, fall), max(rise, keep) + w
    state = int(other > clean)
    path = [state]
    for came in reversed(back):
        state = int(came[state])
        path.append(state)
    return np.array(path[::-1], np.int8)


def _joint(q0: np.ndarray, q1: np.ndarray, odds: float) -> np.ndarray:
    """P(both toxic) of neighbours with these marginals and this odds ratio."""
    if abs(odds - 1) < 1e-6:
        return q0 * q1
    k = 1 + (q0 + q1) * (odds - 1)
    root = np.sqrt(np.maximum(k * k - 4 * odds * (odds - 1) * q0 * q1, 0))
    return (k - root) / (2 * (odds - 1))


def fitted(flat: np.ndarray, first: np.ndarray, items: np.ndarray, starts: np.ndarray,
           lengths: np.ndarray, mark: np.ndarray, hashed: int, epochs: int,
           ridge: float):
    """(feature weights, bias, start weight, log potentials) by maximum likelihood with
    ridge, in full-batch adaptive steps.

    Item i has the features ``flat[first[i]:first[i + 1]]``; ``items`` are the positions
    of all chains one after the other, ``mark`` their states."""
    inner = np.ones(len(items), bool)
    inner[starts] = False
    second = np.flatnonzero(inner)
    theta, bias, start = np.zeros(hashed), -3.0, 0.0
    steps = np.zeros((2, 2))  # (0, 0) stays
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (mark[second - 1].astype(int), mark[second].astype(int)), 1)
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(flat))))
    used = np.bincount(flat, np.bincount(items, minlength=len(first))[owner], hashed) > 0
    mean, var = np.zeros(hashed + 5), np.zeros(hashed + 5)
    for epoch in range(1, epochs + 1):
        lead = bias + np.add.reduceat(theta[flat], first)
        p = messages(lead[items], starts, lengths, start, np.exp(steps))
        off = p - mark
        # Expected steps, from the marginals of neighbours and the odds of their tie.
        q0, q1 = p[second - 1], p[second]
        tie = np.exp(steps)
        both = _joint(q0, q1, tie[1, 1] * tie[0, 0] / (tie[0, 1] * tie[1, 0]))
        grad = np.zeros(hashed + 5)
        grad[:hashed] = np.bincount(flat, np.bincount(items, off, len(first))[owner], hashed)
        grad[:hashed] += ridge * theta
        grad[hashed:] = (
            off.sum(), off[starts].sum(), (q1 - both).sum() - seen_pairs[0, 1],
            (q0 - both).sum() - seen_pairs[1, 0], both.sum() - seen_pairs[1, 1])
        mean = 0.9 * mean + 0.1 * grad
        var = 0.99 * var + 0.01 * grad**2
        step = 0.15 * (mean / (1 - 0.9**epoch)) / (np.sqrt(var / (1 - 0.99**epoch)) + 1.0)
        theta -= np.where(used, step[:hashed], 0)
        bias -= step[hashed]
        start -= step[hashed + 1]
        steps = np.clip(steps - np.array([[0, step[hashed + 2]], [step[hashed + 3], step[hashed + 4]]]), -4, 4)
    return theta, float(bias), float(start), steps
