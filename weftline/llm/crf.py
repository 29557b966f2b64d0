"""Linear-chain conditional random fields with two labels: training and Viterbi decoding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class LinearChain:
    """``emit`` weighs features for label 1 against 0; ``step[a, b]`` follows a by b; ``begin`` starts."""

    emit: np.ndarray
    step: np.ndarray
    begin: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.emit

    def decode(self, scores: Sequence[float]) -> list[int]:
        """The most likely labels of one sequence (Viterbi); ties go to label 1."""
        if not len(scores):
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        zero, one = float(self.begin[0]), float(self.begin[1]) + scores[0]
        back = []
        for score in scores[1:]:
            to_zero, to_one = zero + s00 > one + s10, zero + s01 > one + s11
            back.append((0 if to_zero else 1, 0 if to_one else 1))
            zero, one = (
                zero + s00 if to_zero else one + s10,
                (zero + s01 if to_one else one + s11) + score,
            )
        label = 1 if one >= zero else 0
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def fit(
    sequences: Sequence[np.ndarray],
    labels: Sequence[np.ndarray],
    rounds: int = 300,
    rate: float = 0.1,
    penalty: float = 1e-3,
) -> LinearChain:
    """Maximum likelihood with a quadratic penalty, by Adam on the whole training set.

    All sequences are padded to one length and their forward and backward sums run together.
    """
    n, longest, width = len(sequences), max(map(len, sequences)), sequences[0].shape[1]
    x = np.zeros((n, longest, width))
    y = np.zeros((n, longest), int)
    inside = np.zeros((n, longest), bool)
    for i, (s, l) in enumerate(zip(sequences, labels, strict=True)):
        x[i, : len(s)], y[i, : len(s)], inside[i, : len(s)] = s, l, True
    total = inside.sum()
    theta = np.zeros(width + 6)  # emit, step by rows, begin
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    seen_steps = np.zeros((2, 2))
    both = inside[:, 1:] & inside[:, :-1]
    np.add.at(seen_steps, (y[:, :-1][both], y[:, 1:][both]), 1)
    seen_begin = np.bincount(y[:, 0], minlength=2)
    seen_emit = (x * (y * inside)[..., None]).sum(axis=(0, 1))
    for turn in range(1, rounds + 1):
        emit, step, begin = theta[:width], theta[width : width + 4].reshape(2, 2), theta[width + 4 :]
        local = np.stack([np.zeros((n, longest)), x @ emit], axis=-1)
        forward = np.zeros((n, longest, 2))
        backward = np.zeros((n, longest, 2))
        forward[:, 0] = begin + local[:, 0]
        for t in range(1, longest):
            moved = _log_sum(forward[:, t - 1, :, None] + step, 1) + local[:, t]
            forward[:, t] = np.where(inside[:, t, None], moved, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = _log_sum(step + (local[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], moved, 0)
        whole = _log_sum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - whole[:, None, None])
        pair = np.exp(
            forward[:, :-1, :, None]
            + step
            + (local[:, 1:] + backward[:, 1:])[:, :, None, :]
            - whole[:, None, None, None]
        )
        gradient = np.concatenate(
            [
                seen_emit - (x * (marginal[..., 1] * inside)[..., None]).sum(axis=(0, 1)),
                (seen_steps - (pair * both[..., None, None]).sum(axis=(0, 1))).ravel(),
                seen_begin - marginal[:, 0].sum(axis=0),
            ]
        )
        gradient = gradient / total - penalty * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return LinearChain(theta[:width], theta[width : width + 4].reshape(2, 2), theta[width + 4 :])
