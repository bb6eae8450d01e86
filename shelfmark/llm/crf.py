"""A linear-chain conditional random field over words, small enough to travel with a task."""

from __future__ import annotations

import numpy as np

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
N_LABELS = 3


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Crf:
    """Label scores are sums of feature weights; neighbouring labels add a transition weight."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions = weights, transitions
        # What a change of one label to OUTSIDE can lose on the transitions to its neighbours, at most.
        into = transitions - transitions[:, [OUTSIDE]]
        out = transitions - transitions[[OUTSIDE], :]
        self.margin = float(max(0, into.max()) + max(0, out.max()))

    @classmethod
    def fit(cls, features: np.ndarray, labels: np.ndarray, present: np.ndarray,
            rounds: int = 100, rate: float = 0.5, penalty: float = 1e-3) -> Crf:
        """Maximum likelihood with an L2 penalty, by forward-backward and Adagrad.

        features: (sequences, positions, features); labels and present (a position holds a word; the first does): (sequences,
        positions).
        """
        n, length, width = features.shape
        weights, transitions = np.zeros((width, N_LABELS), features.dtype), np.zeros((N_LABELS, N_LABELS), features.dtype)
        seen = [np.full_like(weights, 1e-8), np.full_like(transitions, 1e-8)]
        truth = np.eye(N_LABELS, dtype=features.dtype)[labels] * present[..., None]
        pairs = present[:, 1:] & present[:, :-1]
        true_pairs = np.einsum("nta,ntb->ab", truth[:, :-1] * pairs[..., None], truth[:, 1:])
        flat = features.reshape(-1, width)
        for _ in range(rounds):
            scores = (flat @ weights).reshape(n, length, N_LABELS) * present[..., None]
            forward, backward = np.zeros_like(scores), np.zeros_like(scores)
            forward[:, 0] = scores[:, 0]
            for t in range(1, length):
                step = _log_sum(forward[:, t - 1, :, None] + transitions, 1) + scores[:, t]
                forward[:, t] = np.where(pairs[:, t - 1, None], step, forward[:, t - 1])
            for t in range(length - 2, -1, -1):
                step = _log_sum(transitions + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
                backward[:, t] = np.where(pairs[:, t, None], step, 0)
            whole = _log_sum(forward[:, -1], 1)
            marginal = np.exp(forward + backward - whole[:, None, None]) * present[..., None]
            edge = (forward[:, :-1, :, None] + transitions + (scores + backward)[:, 1:, None, :] - whole[:, None, None, None])
            expected = np.where(pairs[..., None, None], np.exp(np.minimum(edge, 0)), 0).sum(axis=(0, 1))
            slopes = [(flat.T @ (truth - marginal).reshape(-1, N_LABELS)) / n - penalty * weights,
                      (true_pairs - expected) / n - penalty * transitions]
            for value, slope, total in zip((weights, transitions), slopes, seen):
                total += slope ** 2
                value += rate * slope / np.sqrt(total)
        return cls(weights.astype(float), transitions.astype(float))

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best labels of a sequence of words (words, labels), exactly.

        A word whose OUTSIDE score leads by more than transitions can make up for is OUTSIDE on the best path whatever its
        neighbours are; Viterbi runs over what lies between such words.
        """
        labels = np.zeros(len(scores), np.int8)
        lead = scores[:, OUTSIDE] - scores[:, OUTSIDE + 1:].max(axis=1)
        open_ = np.flatnonzero(lead <= self.margin)
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            if len(run):
                first, last = int(run[0]), int(run[-1])
                labels[first:last + 1] = self._viterbi(scores[first:last + 1], first > 0, last + 1 < len(scores))
        return labels

    def _viterbi(self, scores: np.ndarray, after: bool, before: bool) -> list[int]:
        best = scores[0] + (self.transitions[OUTSIDE] if after else 0)
        came = []
        for score in scores[1:]:
            step = best[:, None] + self.transitions
            came.append(step.argmax(axis=0))
            best = step.max(axis=0) + score
        if before:
            best = best + self.transitions[:, OUTSIDE]
        path = [int(best.argmax())]
        for previous in reversed(came):
            path.append(int(previous[path[-1]]))
        return path[::-1]
