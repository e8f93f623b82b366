"""Linear-chain conditional random field in numpy: K states, hashed word features.

All sequences of a batch run in step, longest first, so that a step is one
small matrix product over the sequences that are still going on.
"""

from __future__ import annotations

import numpy as np


class Layout:
    """Time-major order of the words of several sequences (given one after the other)."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.rank = np.argsort(-lengths, kind="stable")  # lane -> sequence
        lane = np.empty(len(lengths), np.int64)
        lane[self.rank] = np.arange(len(lengths))
        steps = int(lengths.max(initial=0))
        self.active = np.searchsorted(np.sort(-lengths), -np.arange(steps), "left")  # lanes longer than t
        self.offset = np.concatenate([[0], np.cumsum(self.active)])
        self.seq = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(self.seq)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.pos = self.offset[step] + lane[self.seq]  # word -> its place in time-major order


def forward_backward(scores: np.ndarray, lay: Layout, trans: np.ndarray, start: np.ndarray,
                     want_pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Marginals of every word (in the order of ``scores``); expected transition and start counts if wanted.

    ``scores``: words x K emission scores; ``trans``, ``start``: log weights.
    """
    k = scores.shape[1]
    e = np.empty_like(scores)
    e[lay.pos] = np.exp(scores - scores.max(1, keepdims=True, initial=-np.inf))
    t_mat = np.exp(trans - trans.max())
    alpha = np.empty_like(e)
    a = None
    for t, n in enumerate(lay.active):
        lo = lay.offset[t]
        a = (np.exp(start - start.max()) if a is None else a[:n] @ t_mat) * e[lo:lo + n]
        a /= a.sum(1, keepdims=True)
        alpha[lo:lo + n] = a
    pairs = np.zeros((k, k)) if want_pairs else None
    b = np.ones((0, k))
    for t in range(len(lay.active) - 1, -1, -1):
        n, lo = lay.active[t], lay.offset[t]
        m = len(b)
        if m:
            y = e[lay.offset[t + 1]:lay.offset[t + 1] + m] * b
            if want_pairs:
                x = alpha[lo:lo + m]
                z = ((x @ t_mat) * y).sum(1, keepdims=True)
                pairs += t_mat * ((x / z).T @ y)
            b = y @ t_mat.T
            b /= b.sum(1, keepdims=True)
        b = np.concatenate([b, np.ones((n - m, k))])
        # alpha is not read again at this step: keep the marginals in its place.
        own = alpha[lo:lo + n] * b
        alpha[lo:lo + n] = own / own.sum(1, keepdims=True)
    first = alpha[:lay.active[0]].sum(0) if want_pairs and len(lay.active) else None
    return alpha[lay.pos], pairs, first


class Weights:
    """Feature weights (buckets x K), transition and start weights, with Adagrad steps."""

    def __init__(self, buckets: int, k: int) -> None:
        self.w, self.trans, self.start = np.zeros((buckets, k)), np.zeros((k, k)), np.zeros(k)
        self._sq = [np.full_like(x, 1e-6) for x in (self.w, self.trans, self.start)]

    def step(self, grads: list[np.ndarray], rate: float) -> None:
        for x, g, sq in zip((self.w, self.trans, self.start), grads, self._sq):
            sq += g * g
            x += rate * g / np.sqrt(sq)


class Features:
    """Sparse word features: ``idx[i]`` is a feature bucket of word ``owner[i]``."""

    def __init__(self, idx: np.ndarray, owner: np.ndarray, words: int) -> None:
        self.idx, self.owner, self.words = idx, owner, words
        self.norm = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=words)))

    def scores(self, w: np.ndarray) -> np.ndarray:
        """words x K: feature weights summed, divided by the root of their number."""
        return np.stack([np.bincount(self.owner, col[self.idx], self.words) for col in w.T], axis=1) * self.norm[:, None]

    def gradient(self, per_word: np.ndarray, buckets: int) -> np.ndarray:
        """Gradient of ``scores`` with respect to the feature weights."""
        return np.stack([np.bincount(self.idx, g[self.owner], buckets) for g in (per_word * self.norm[:, None]).T], axis=1)


def train(word_of: np.ndarray, lengths: np.ndarray, label: np.ndarray, feats: Features,
          k: int, buckets: int, rounds: int = 10) -> Weights:
    """Weights from sequences with one label each that may hold stretches of other states.

    word_of: distinct-word number of every word; label: state of every
    sequence; feats: features of the distinct words. (1) Features are
    fitted to the sequences' labels word by word. (2) Words are relabelled by
    forward-backward with sticky transitions and a bias to the sequence's
    label. (3) The field is trained on these labels: observed less expected
    counts of features, transitions and starts.
    """
    n_words = feats.words
    lay = Layout(lengths)
    of_word = label[lay.seq]
    seen = np.zeros((n_words, k))
    np.add.at(seen, (word_of, of_word), 1)
    # Each state weighs the same, however many documents it has.
    seen *= len(word_of) / (k * np.maximum(1, seen.sum(0)))
    damped = seen / np.sqrt(np.maximum(1e-9, seen.sum(1, keepdims=True)))
    out = Weights(buckets, k)
    none = [np.zeros((k, k)), np.zeros(k)]
    for _ in range(20):
        s = feats.scores(out.w)
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = damped - p * damped.sum(1, keepdims=True)
        out.step([feats.gradient(g, buckets) - 1e-3 * out.w, *none], 0.3)
    sticky = np.log(np.where(np.eye(k) == 1, 0.97, 0.03 / max(1, k - 1)))
    bias = np.zeros((len(word_of), k))
    bias[np.arange(len(word_of)), of_word] = 0.7
    gamma, _, _ = forward_backward(feats.scores(out.w)[word_of] + bias, lay, sticky, np.zeros(k))
    state = gamma.argmax(1)
    observed = np.zeros((n_words, k))
    np.add.at(observed, (word_of, state), 1)
    moves = np.zeros((k, k))
    inner = np.nonzero(lay.seq[1:] == lay.seq[:-1])[0]
    np.add.at(moves, (state[inner], state[inner + 1]), 1)
    starts = np.bincount(state[np.cumsum(lengths)[lengths > 0] - lengths[lengths > 0]], minlength=k).astype(float)
    out.trans[:] = np.log((moves + 1) / (moves + 1).sum(1, keepdims=True))
    for _ in range(rounds):
        gamma, pairs, first = forward_backward(feats.scores(out.w)[word_of], lay, out.trans, out.start, True)
        expected = np.stack([np.bincount(word_of, gamma[:, j], n_words) for j in range(k)], axis=1)
        out.step([feats.gradient(observed - expected, buckets) - 1e-3 * out.w, moves - pairs, starts - first], 0.1)
    return out
