"""A gated recurrent language model in numpy: class-factored softmax, truncated back-propagation."""

from __future__ import annotations

import ctypes
from functools import cache
from pathlib import Path

import numpy as np


@cache
def one_thread() -> bool:
    """Keeps numpy's matrix products in the calling thread: for small ones the others only wait, at full speed."""
    for library in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(found := ctypes.CDLL(str(library)), name):
                getattr(found, name)(1)
                return True
    return False


class Recurrent:
    """P(token) = P(class) * P(token in class).

    Classes are cut from the tokens in the order of their frequency, each as soon as its share of all tokens
    times its size comes to ``WIDTH`` or its share to ``SHARE``: frequent tokens share a class with few others or none, so
    most targets need a short softmax.  Inside, tokens are numbered in that order.

    ``frequency`` (of every token, over all training texts) sets the output biases, so an untrained model is
    the unigram model of the corpus.

    While texts advance together, each is a column: the slices of the gates are then blocks without gaps.
    """

    NAMES = ("inputs", "carry", "to_class", "class_bias", "to_token", "token_bias")
    WIDTH, SHARE = 1.0, 0.04
    TOGETHER = 512  # texts scored at a time: what a step touches stays in a core's cache

    def __init__(self, frequency: np.ndarray, hidden: int = 32, seed: int = 5):
        size = len(frequency)
        self.hidden = hidden
        draw = np.random.default_rng(seed)
        share = (frequency + 0.5) / (frequency + 0.5).sum()
        order = np.argsort(-share, kind="stable")
        self.number = np.empty(size, np.int32)  # inside, of each token
        self.number[order] = np.arange(size, dtype=np.int32)
        share = share[order]
        starts, mass = [0], 0.0
        for at, own in enumerate(share.tolist()):
            mass += own
            if mass * (at + 1 - starts[-1]) >= self.WIDTH or mass >= self.SHARE:
                starts.append(at + 1)
                mass = 0.0
        if starts[-1] == size:
            starts.pop()
        self.starts = np.array([*starts, size])
        self.classes = len(starts)
        self.class_of = np.repeat(np.arange(self.classes, dtype=np.int16), np.diff(self.starts))
        in_class = np.add.reduceat(share, self.starts[:-1])
        small = lambda *shape: draw.normal(0, 0.1, shape)
        self.inputs = small(size, 3 * hidden)  # update, reset and candidate of a one-hot input
        self.carry = small(hidden, 3 * hidden)
        self.to_class, self.class_bias = small(hidden, self.classes), np.log(in_class)
        self.to_token = small(size, hidden)
        self.token_bias = np.log(share / in_class[self.class_of])
        self._set(np.float32)

    def _set(self, kind) -> None:
        for name in self.NAMES:
            setattr(self, name, np.ascontiguousarray(getattr(self, name), kind))

    def step(self, tokens: np.ndarray, state: np.ndarray):
        """Next state, a row for each token, and the gates."""
        gates = self._gates(tokens)
        return self._step(gates, state.T).T, gates.T

    def _gates(self, tokens: np.ndarray) -> np.ndarray:
        """The tokens' inputs, the last axis of the tokens last."""
        return np.ascontiguousarray(self.inputs.take(tokens, axis=0).swapaxes(-1, -2))

    def _step(self, gates: np.ndarray, state: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """Next state; ``gates`` holds the tokens' inputs, and update, reset and candidate afterwards."""
        h = self.hidden
        both, fresh = gates[:2 * h], gates[2 * h:]
        both += self.carry[:, :2 * h].T @ state
        np.negative(both, out=both)
        np.exp(both, out=both)
        both += 1
        np.reciprocal(both, out=both)
        fresh += self.carry[:, 2 * h:].T @ (both[h:] * state)
        np.tanh(fresh, out=fresh)
        after = np.subtract(fresh, state, out=out)
        after *= both[:h]
        after += state
        return after

    def _by_class(self, classes: np.ndarray) -> tuple[np.ndarray, list]:
        """The order of targets by class; first and last number of every class that occurs and holds several tokens, and
        the span of its targets in that order."""
        ends = np.cumsum(np.bincount(classes, minlength=self.classes)).tolist()
        spans = zip(self.starts[:-1].tolist(), self.starts[1:].tolist(), [0, *ends], ends)
        return np.argsort(classes, kind="stable"), [span for span in spans if span[3] > span[2] and span[1] - span[0] > 1]

    def log_prob(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target (by number) after each state."""
        each, classes = np.arange(len(targets)), self.class_of[targets]

        def logs(weights, bias, some, goal):
            scores = weights @ some.T
            scores += bias[:, None]
            np.minimum(scores, 60, out=scores)
            own = scores[goal, each[:len(goal)]]
            return own - np.log(np.exp(scores, out=scores).sum(axis=0))

        out = logs(self.to_class.T, self.class_bias, states, classes)
        order, spans = self._by_class(classes)
        states, targets, inside = states.take(order, axis=0), targets[order], np.zeros_like(out)
        for low, high, a, b in spans:
            inside[a:b] = logs(self.to_token[low:high], self.token_bias[low:high], states[a:b], targets[a:b] - low)
        out[order] += inside
        return out

    # --- scoring whole texts ---

    def score(self, texts: list[np.ndarray], end: int) -> np.ndarray:
        """Log-probability of every text (ids without the end; the end is scored too).

        ``TOGETHER`` texts of like length advance together, the longest first, so finished ones drop off at the
        back; states are carried from window to window until the text ends.
        """
        one_thread()
        texts, end = [self.number[t] for t in texts], int(self.number[end])
        total = np.zeros(len(texts))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        for at in range(0, len(texts), self.TOGETHER):
            some = order[at:at + self.TOGETHER]
            total[some] = self._scored([texts[i] for i in some.tolist()], end)
        return total

    def _scored(self, texts: list[np.ndarray], end: int) -> np.ndarray:
        """Log-probability of every text, the longest first."""
        steps = np.array([len(t) for t in texts], np.int64) + 1
        flat = np.concatenate([np.append(t, end) for t in texts])
        starts = np.cumsum(steps) - steps
        running = np.searchsorted(-steps, -np.arange(steps[0]), "left").tolist()  # texts longer than t
        state, tokens = np.zeros((self.hidden, len(texts)), np.float32), np.full(len(texts), end)
        sums, t = np.zeros(len(texts)), 0
        while t < len(running):
            states, targets, active, held = [], [], [], 0
            while t < len(running) and held < 8192:
                a = running[t]
                state = self._step(self._gates(tokens[:a]), state[:, :a])
                tokens = flat.take(starts[:a] + t)
                states.append(state.T)
                targets.append(tokens)
                active.append(a)
                held += a
                t += 1
            values, at = self.log_prob(np.concatenate(states), np.concatenate(targets)), 0
            for a in active:
                sums[:a] += values[at:at + a]
                at += a
        return sums

    # --- training ---

    def weights(self) -> np.ndarray:
        """All weights in a row."""
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def set_weights(self, flat: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, np.ascontiguousarray(flat[at:at + old.size].reshape(old.shape), old.dtype))
            at += old.size

    def learner(self, rate: float = 0.004) -> Learner:
        return Learner(self, rate)

    def _slopes(self, inputs: np.ndarray, targets: np.ndarray, state: np.ndarray, end: int):
        h, (streams, window) = self.hidden, inputs.shape
        tokens, goal = inputs.T, targets.T.ravel()
        gates, state = self._gates(tokens), state.T
        goes_on = (tokens != end).astype(gates.dtype)  # a text's first state has no past
        old, states = np.empty((2, window, h, streams), gates.dtype)
        for t in range(window):
            np.multiply(state, goes_on[t], out=old[t])
            state = self._step(gates[t], old[t], states[t])
        flat, slope = states.swapaxes(1, 2).reshape(-1, h), {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        each, classes, scale = np.arange(len(goal)), self.class_of[goal], gates.dtype.type(1 / len(goal))

        def missed(weights, bias, some, goal):
            """Slopes of the scores."""
            p = weights @ some.T
            p += bias[:, None]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p *= scale / p.sum(axis=0)
            p[goal, each[:len(goal)]] -= scale
            return p

        p = missed(self.to_class.T, self.class_bias, flat, classes)
        slope["to_class"], slope["class_bias"] = (p @ flat).T, p.sum(axis=1)
        back = p.T @ self.to_class.T
        order, spans = self._by_class(classes)
        flat, goal, inside = flat.take(order, axis=0), goal[order], np.zeros_like(back)
        for low, high, a, b in spans:
            span = slice(low, high)
            p = missed(self.to_token[span], self.token_bias[span], flat[a:b], goal[a:b] - low)
            slope["to_token"][span], slope["token_bias"][span] = p @ flat[a:b], p.sum(axis=1)
            np.matmul(p.T, self.to_token[span], out=inside[a:b])
        place = np.empty_like(order)
        place[order] = each
        back += inside.take(place, axis=0)
        back = np.ascontiguousarray(back.reshape(window, streams, h).swapaxes(1, 2))

        update, reset, fresh = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:]
        stay, kept = 1 - update, reset * old
        to_update, to_reset, to_fresh = fresh - old, 1 - reset, fresh * fresh
        to_update *= update
        to_update *= stay
        to_reset *= kept
        np.subtract(1, to_fresh, out=to_fresh)
        to_fresh *= update
        down, moved = np.zeros((h, streams), back.dtype), np.empty_like(gates)
        for t in range(window - 1, -1, -1):
            d_gates, d_fresh = moved[t, :2 * h], moved[t, 2 * h:]
            down += back[t]
            np.multiply(down, to_update[t], out=d_gates[:h])
            np.multiply(down, to_fresh[t], out=d_fresh)
            d_kept = self.carry[:, 2 * h:] @ d_fresh
            np.multiply(d_kept, to_reset[t], out=d_gates[h:])
            d_kept *= reset[t]
            down *= stay[t]
            down += d_kept
            down += self.carry[:, :2 * h] @ d_gates
            down *= goes_on[t]
        slope["carry"] = np.concatenate([(past @ moves.swapaxes(1, 2)).sum(axis=0) for past, moves in (
            (old, moved[:, :2 * h]), (kept, moved[:, 2 * h:]))], axis=1)
        tokens = tokens.ravel()
        for i in range(3 * h):
            slope["inputs"][:, i] = np.bincount(tokens, moved[:, i].ravel(), len(self.inputs))
        norm = float(np.sqrt(sum((s * s).sum() for s in slope.values())))
        if norm > 1:
            for s in slope.values():
                s *= 1 / norm
        return slope, state.T


class Learner:
    """Truncated back-propagation, by Adam: texts are laid end to end in ``streams`` rows, states are carried from
    window to window and reset where a text begins, gradients stop at the window's start."""

    def __init__(self, model: Recurrent, rate: float):
        self.model, self.rate, self.count = model, rate, 0
        self.means = {n: [np.zeros_like(getattr(model, n)), np.zeros_like(getattr(model, n))] for n in model.NAMES}

    def learn(self, texts: list[np.ndarray], end: int, streams: int | None = None, window: int = 32) -> int:
        """One pass over all tokens of the texts, their ends included; how many there were.

        Unless given, ``streams`` grows with the tokens, so that a pass makes 128 updates or more.
        """
        one_thread()
        end = int(self.model.number[end])
        flat = np.concatenate([np.append(self.model.number[t], np.int32(end)) for t in texts])
        before = np.append(end, flat[:-1])
        streams = streams or min(256, max(8, len(flat) // (128 * window)))
        width = len(flat) // streams
        if width < 2:
            streams, width = 1, len(flat)
        even = streams * width
        self._rows(before[:even].reshape(streams, width), flat[:even].reshape(streams, width), end, window)
        if even < len(flat):  # fewer than ``streams`` tokens are left
            self._rows(before[None, even:], flat[None, even:], end, window)
        return len(flat)

    def _rows(self, before: np.ndarray, rows: np.ndarray, end: int, window: int) -> None:
        state = np.zeros((len(rows), self.model.hidden), np.float32)
        for low in range(0, rows.shape[1], window):
            slopes, state = self.model._slopes(before[:, low:low + window], rows[:, low:low + window], state, end)
            self.count += 1
            for name, slope in slopes.items():
                first, second = self.means[name]
                value, room = getattr(self.model, name), np.multiply(slope, 0.1)
                first *= 0.9
                first += room
                second *= 0.99
                second += np.multiply(room, room, out=room)  # a hundredth of the square
                np.sqrt(second, out=room)
                room *= 1 / np.sqrt(1 - 0.99**self.count)
                room += 1e-7
                np.divide(first, room, out=room)
                room *= self.rate / (1 - 0.9**self.count)
                value -= room
