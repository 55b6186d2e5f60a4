"""A tagger of characters: bidirectional LSTM with CRF transitions, written and trained in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
LENGTH = 64
HIDDEN = 16
NEVER = np.float32(-1e4)

# Symbols: 0 nothing, 1 to 95 printable ASCII, 96 white space, 97 letters beyond ASCII, 98 anything else.
SYMBOLS = 99


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    out = np.where((codes >= 0x20) & (codes < 0x7F), codes - 0x1F, np.where(codes < 0x20, 96, np.where((codes >= 0xC0) & (codes < 0x2000), 97, 98)))
    return out.astype(np.int16)


def barred() -> np.ndarray:
    """Transitions that no path takes: into the inside of a kind from anything but its begin or inside."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        begin, inside = 1 + 2 * k, 2 + 2 * k
        out[:, inside] = NEVER
        out[begin, inside] = out[inside, inside] = 0
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def run_lstm(gates_in: np.ndarray, recurrent: np.ndarray):
    """Hidden states of a direction; gates_in is (time, batch, 4 hidden): input, forget, output, candidate."""
    length, batch, _ = gates_in.shape
    h, c = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    states, kept = np.empty((length, batch, HIDDEN), np.float32), []
    for t in range(length):
        gates = gates_in[t] + h @ recurrent
        three = sigmoid(gates[:, : 3 * HIDDEN])
        z = np.tanh(gates[:, 3 * HIDDEN :])
        before_h, before_c = h, c
        c = three[:, HIDDEN : 2 * HIDDEN] * c + three[:, :HIDDEN] * z
        turned = np.tanh(c)
        h = three[:, 2 * HIDDEN :] * turned
        states[t] = h
        kept.append((three, z, before_h, before_c, turned))
    return states, kept


def back_lstm(d_states: np.ndarray, kept, recurrent: np.ndarray):
    """Gradients of the gates' inputs and of the recurrent weights."""
    d_gates = np.empty((*d_states.shape[:2], 4 * HIDDEN), np.float32)
    d_recurrent = np.zeros_like(recurrent)
    dh, dc = np.zeros_like(d_states[0]), np.zeros_like(d_states[0])
    for t in range(len(kept) - 1, -1, -1):
        three, z, before_h, before_c, turned = kept[t]
        i, f, o = three[:, :HIDDEN], three[:, HIDDEN : 2 * HIDDEN], three[:, 2 * HIDDEN :]
        dh = dh + d_states[t]
        dc = dc + dh * o * (1 - turned**2)
        g = np.concatenate((dc * z * i * (1 - i), dc * before_c * f * (1 - f), dh * turned * o * (1 - o), dc * i * (1 - z**2)), axis=1)
        d_gates[t] = g
        d_recurrent += before_h.T @ g
        dh, dc = g @ recurrent.T, dc * f
    return d_gates, d_recurrent


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 5):
        rng = np.random.default_rng(seed)
        if weights is None:
            small = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
            weights = {"table_f": small(SYMBOLS, 4 * HIDDEN), "table_b": small(SYMBOLS, 4 * HIDDEN), "recurrent_f": small(HIDDEN, 4 * HIDDEN), "recurrent_b": small(HIDDEN, 4 * HIDDEN),
                       "out": small(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "moves": small(TAGS, TAGS)}
            weights["table_f"][:, HIDDEN : 2 * HIDDEN] += 1
            weights["table_b"][:, HIDDEN : 2 * HIDDEN] += 1
        self.weights = weights

    def scores(self, ids: np.ndarray):
        """Score of each tag at each place, (time, batch, tags), and what the gradient needs."""
        w = self.weights
        forward, kept_f = run_lstm(w["table_f"][ids.T], w["recurrent_f"])
        backward, kept_b = run_lstm(w["table_b"][ids.T[::-1]], w["recurrent_b"])
        states = np.concatenate((forward, backward[::-1]), axis=2)
        return states @ w["out"] + w["bias"], (states, kept_f, kept_b)

    def _chains(self, scores: np.ndarray):
        """Forward and backward sums of the CRF in logarithms, and the logarithm of the total."""
        moves = self.weights["moves"] + barred()
        first = np.where(np.arange(TAGS) % 2 == 0, NEVER, 0).astype(np.float32)
        first[0] = 0
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0] + first
        for t in range(1, len(scores)):
            alpha[t] = scores[t] + log_sum(alpha[t - 1][:, :, None] + moves, 1)
        for t in range(len(scores) - 2, -1, -1):
            beta[t] = log_sum(moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        return alpha, beta, log_sum(alpha[-1], 1), moves

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window by Viterbi, and the probability of each of them at its place."""
        scores, _ = self.scores(ids)
        alpha, beta, total, moves = self._chains(scores)
        best, back = alpha[0].copy(), []
        for t in range(1, len(scores)):
            paths = best[:, :, None] + moves
            back.append(paths.argmax(axis=1))
            best = scores[t] + np.take_along_axis(paths, back[-1][:, None, :], 1)[:, 0]
        tags = np.empty(ids.shape, np.int64)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(len(scores) - 1, 0, -1):
            tags[:, t - 1] = np.take_along_axis(back[t - 1], tags[:, t : t + 1], 1)[:, 0]
        chance = np.exp(alpha + beta - total[None, :, None]).transpose(1, 0, 2)
        return tags, np.take_along_axis(chance, tags[:, :, None], 2)[:, :, 0]

    def gradient(self, ids: np.ndarray, tags: np.ndarray):
        """Mean negative log likelihood and its gradient."""
        w, (batch, length) = self.weights, ids.shape
        scores, (states, kept_f, kept_b) = self.scores(ids)
        alpha, beta, total, moves = self._chains(scores)
        gold = np.take_along_axis(scores, tags.T[:, :, None], 2).sum() + moves[tags[:, :-1], tags[:, 1:]].sum()
        loss = (total.sum() - gold) / batch
        d_scores = np.exp(alpha + beta - total[None, :, None])
        d_moves = np.zeros((TAGS, TAGS), np.float32)
        for t in range(length - 1):
            d_moves += np.exp(alpha[t][:, :, None] + moves + (scores[t + 1] + beta[t + 1])[:, None, :] - total[:, None, None]).sum(axis=0)
        np.add.at(d_moves, (tags[:, :-1], tags[:, 1:]), -1)
        np.put_along_axis(d_scores, tags.T[:, :, None], np.take_along_axis(d_scores, tags.T[:, :, None], 2) - 1, 2)
        d_scores /= batch
        flat = d_scores.reshape(-1, TAGS)
        grad = {"out": states.reshape(-1, 2 * HIDDEN).T @ flat, "bias": flat.sum(axis=0), "moves": d_moves / batch}
        d_states = d_scores @ w["out"].T
        for name, part, kept, order in (("f", d_states[:, :, :HIDDEN], kept_f, ids.T), ("b", d_states[::-1, :, HIDDEN:], kept_b, ids.T[::-1])):
            d_gates, grad[f"recurrent_{name}"] = back_lstm(part, kept, w[f"recurrent_{name}"])
            hot = np.zeros((order.size, SYMBOLS), np.float32)
            hot[np.arange(order.size), order.ravel()] = 1
            grad[f"table_{name}"] = hot.T @ d_gates.reshape(-1, 4 * HIDDEN)
        return loss, grad

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, losses, steps = 0, [], epochs * -(-len(ids) // batch)
        for _ in range(epochs):
            order, total = rng.permutation(len(ids)), 0.0
            for at in range(0, len(ids), batch):
                own = order[at : at + batch]
                loss, grad = self.gradient(ids[own], tags[own])
                step, total = step + 1, total + loss * len(own)
                norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                for k, g in grad.items():
                    g = g * min(1.0, 5 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g**2
                    pace = rate * (1 - 0.9 * step / steps)
                    self.weights[k] = self.weights[k] - np.float32(pace) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k].astype(np.float32)
            losses.append(total / len(ids))
        return losses
