"""Linear-chain conditional random field with two labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Model:
    """Weights: of features for label 1 against label 0, of label pairs, of the first label."""

    features: dict[str, float]
    pairs: tuple[tuple[float, float], tuple[float, float]]
    first: tuple[float, float]

    def decode(self, sequence: Sequence[Sequence[str]]) -> list[int]:
        """Most likely labels (Viterbi); ties go to label 1."""
        weight = self.features.get
        best, back = (0.0, 0.0), []
        for i, active in enumerate(sequence):
            score = sum(weight(f, 0.0) for f in active)
            if i:
                steps = [[best[a] + self.pairs[a][b] for a in (0, 1)] for b in (0, 1)]
                back.append(tuple(int(s[1] >= s[0]) for s in steps))
                best = (max(steps[0]), max(steps[1]) + score)
            else:
                best = (self.first[0], self.first[1] + score)
        if not sequence:
            return []
        labels = [int(best[1] >= best[0])]
        for pointer in reversed(back):
            labels.append(pointer[labels[-1]])
        return labels[::-1]


def train(sequences: Sequence[Sequence[Sequence[str]]], labels: Sequence[Sequence[int]], rounds: int = 200, l2: float = 0.02, rate: float = 0.2) -> Model:
    """Fit by Adam on the penalised log-likelihood; all sequences advance together."""
    known = {f: i for i, f in enumerate(sorted({f for s in sequences for x in s for f in x}))}
    count, longest = len(sequences), max(len(s) for s in sequences)
    row, column = [], []
    mask, gold = np.zeros((count, longest)), np.zeros((count, longest), dtype=int)
    for s, (sequence, marks) in enumerate(zip(sequences, labels, strict=True)):
        mask[s, : len(sequence)] = 1
        gold[s, : len(sequence)] = marks
        for t, active in enumerate(sequence):
            row += [s * longest + t] * len(active)
            column += [known[f] for f in active]
    row, column = np.array(row), np.array(column)
    size = len(known)
    theta = np.zeros(size + 6)
    both = mask[:, 1:] * mask[:, :-1]
    seen_pairs = np.array([[(both * (gold[:, :-1] == a) * (gold[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    seen_first = np.array([(gold[:, 0] == a).sum() for a in (0, 1)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, pairs, first = theta[:size], theta[size : size + 4].reshape(2, 2), theta[size + 4 :]
        node = np.zeros((count, longest, 2))
        node[:, :, 1] = np.bincount(row, weights=w[column], minlength=count * longest).reshape(count, longest)
        ahead = np.zeros((count, longest, 2))
        ahead[:, 0] = first + node[:, 0]
        for t in range(1, longest):
            moved = np.logaddexp(ahead[:, t - 1, 0, None] + pairs[0], ahead[:, t - 1, 1, None] + pairs[1]) + node[:, t]
            ahead[:, t] = np.where(mask[:, t, None] > 0, moved, ahead[:, t - 1])
        behind = np.zeros((count, longest, 2))
        for t in range(longest - 2, -1, -1):
            then = node[:, t + 1] + behind[:, t + 1]
            moved = np.logaddexp(pairs[:, 0] + then[:, 0, None], pairs[:, 1] + then[:, 1, None])
            behind[:, t] = np.where(mask[:, t + 1, None] > 0, moved, 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        marginal = np.exp(ahead + behind - total[:, None, None])
        gradient = np.zeros_like(theta)
        wrong = ((gold - marginal[:, :, 1]) * mask).ravel()
        gradient[:size] = np.bincount(column, weights=wrong[row], minlength=size)
        for a in (0, 1):
            for b in (0, 1):
                joint = np.exp(ahead[:, :-1, a] + pairs[a, b] + node[:, 1:, b] + behind[:, 1:, b] - total[:, None]) * both
                gradient[size + 2 * a + b] = seen_pairs[a, b] - joint.sum()
            gradient[size + 4 + a] = seen_first[a] - marginal[:, 0, a].sum()
        gradient -= l2 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in known.items()}
    pairs = theta[size : size + 4].reshape(2, 2)
    return Model(weights, tuple(tuple(map(float, p)) for p in pairs), tuple(map(float, theta[size + 4 :])))
