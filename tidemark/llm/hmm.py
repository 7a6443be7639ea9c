"""A hidden Markov model over word classes: exact likelihoods by the scaled forward recursion, expected counts by forward and backward.

Many texts lie one after the other in one array of classes; the first token of a text is drawn anew from the start
probabilities, so texts do not touch each other. The array is cut into lanes that advance side by side, a token at a time: several
whole texts, or a part of a long one. What such a part does to the state before it is a matrix, the product of its steps; from these
the state that enters each part follows, and with it the recursion is that of one text from its beginning to its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Tokens of a lane at most; products of steps are scaled each so many.
LANE, _SCALE_EACH = 256, 8
# Tokens that are worked on at once, a multiple of a lane; a longer text is passed on piece by piece.
PIECE = 1 << 17


@dataclass
class Counts:
    """Expected counts: of the first state, of moves, and of each class by state; and the log10 likelihood they come from."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    log10: float = 0.0

    @classmethod
    def none(cls, states: int, classes: int) -> Counts:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((classes, states)))


def _pieces(offsets: np.ndarray, limit: int) -> Iterator[list[tuple[int, int]]]:
    """Ranges of tokens: of several whole texts, or the parts of a long one, which hang together."""
    at, last = 0, len(offsets) - 1
    while at < last:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        a, b = int(offsets[at]), int(offsets[to])
        yield [(x, min(x + limit, b)) for x in range(a, b, limit)]
        at = to


@dataclass
class _Lanes:
    """(step, lane): each token's place in the array and whether there is one; (step, state, lane): what each state gives it;
    (step, lane): whether a text begins; and the lanes that are part of a text only."""

    index: np.ndarray
    real: np.ndarray
    given: np.ndarray
    first: np.ndarray
    parts: np.ndarray


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        """``start[k]``, ``move[k, to]``, ``emit[class, k]``: all of them positive."""
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def guess(cls, share: np.ndarray, states: int, seed: int, stay: float = 0.9) -> Model:
        """Each state prefers other classes a little, and stays."""
        rng = np.random.default_rng(seed)
        emit = share[:, None] * np.exp(rng.normal(size=(len(share), states)))
        move = np.full((states, states), (1 - stay) / states) + np.eye(states) * stay
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def fitted(cls, counts: Counts, share: np.ndarray, mixed: float) -> Model:
        """The counts as probabilities, with a small part of equal ones, and of the classes' overall shares, mixed in."""
        k = len(counts.start)
        of = lambda x, axis: x / np.maximum(x.sum(axis=axis, keepdims=True), 1e-300)
        even = lambda x: (1 - mixed) * x + mixed / k
        start, move = even(of(counts.start, 0)), even(of(counts.move, 1))
        emit = (1 - mixed) * of(counts.emit, 0) + mixed * share[:, None]
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def _laid(self, classes: np.ndarray, firsts: np.ndarray, lane: int, hangs: bool) -> _Lanes:
        """``hangs``: it is one piece of a longer text. What fills the lanes up gives every state the same and changes no result."""
        n = len(classes)
        ends = np.append(np.flatnonzero(firsts[1:]) + 1, n)
        cuts, parts, at = [], [], 0
        while at < n:
            cuts.append(at)
            end = int(ends[np.searchsorted(ends, at, side="right")])
            if end > at + lane or not firsts[at] or hangs:
                parts.append(len(cuts) - 1)
                at = min(end, at + lane)
            else:
                at = int(ends[np.searchsorted(ends, at + lane, side="right") - 1])
        bounds = np.array([*cuts, n])
        index = bounds[:-1][None, :] + np.arange(int(np.diff(bounds).max()))[:, None]
        real = index < bounds[1:][None, :]
        index = np.where(real, index, 0)
        # Sums over states are quick along an axis of their own before the last.
        given = np.ascontiguousarray(self.emit[classes[index]].swapaxes(1, 2))
        given.swapaxes(1, 2)[~real] = 1.0
        return _Lanes(index, real, given, firsts[index] & real, np.array(parts, np.int64))

    def _through(self, lanes: _Lanes) -> np.ndarray:
        """The matrix of each part, up to a factor."""
        given, first, k, n = lanes.given[:, :, lanes.parts], lanes.first[:, lanes.parts], len(self.start), len(lanes.parts)
        out = np.repeat(np.eye(k)[:, :, None], n, axis=2)
        for step in range(len(given) if n else 0):
            was, at = out, np.flatnonzero(first[step])
            out = (self.move.T @ was.reshape(k, -1)).reshape(k, k, n)
            if len(at):
                out[:, :, at] = self.start[:, None, None] * was[:, :, at].sum(axis=0)
            out *= given[step][:, None, :]
            if step % _SCALE_EACH == _SCALE_EACH - 1:
                out /= out.reshape(k * k, n).max(axis=0)
        return out.transpose(2, 1, 0)

    def _enter(self, lanes: _Lanes, through: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states that enter the lanes, and the one that leaves the last part. What enters a lane of whole texts does not matter."""
        entering = np.repeat(self.start[:, None], lanes.given.shape[2], axis=1)
        for lane, matrix in zip(lanes.parts, through):
            entering[:, lane] = state
            state = state @ matrix
            state = state / state.sum()
        return entering, state

    def _forward(self, lanes: _Lanes, entering: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's state given all tokens of its text so far, and its probability given those before it."""
        given, states, state = lanes.given, np.empty(lanes.given.shape), entering
        scales = np.empty(lanes.first.shape)
        resets = [np.flatnonzero(f) for f in lanes.first]
        for step in range(len(given)):
            state = self.move.T @ state
            state[:, resets[step]] = self.start[:, None]
            state *= given[step]
            state.sum(axis=0, out=scales[step])
            state /= scales[step]
            states[step] = state
        return states, scales

    def _backward(self, lanes: _Lanes, through: np.ndarray, leaving: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How likely each state makes the rest of the text, up to a factor; and the same before the first token."""
        given, out = lanes.given, np.empty(lanes.given.shape)
        state = np.ones(given.shape[1:])
        for lane, matrix in zip(lanes.parts[::-1], through[::-1]):
            state[:, lane] = leaving
            leaving = matrix @ leaving
            leaving = leaving / leaving.sum()
        resets = [np.flatnonzero(f) for f in lanes.first]
        for step in range(len(given) - 1, -1, -1):
            out[step] = state
            state = self.move @ (given[step] * state)
            state[:, resets[step]] = 1.0
            state /= state.sum(axis=0)
        return out, leaving

    def log10(self, classes: np.ndarray, offsets: np.ndarray, piece: int = PIECE, lane: int = LANE) -> np.ndarray:
        """The log10 probability of each text; text i has the classes from ``offsets[i]`` to ``offsets[i + 1]``, one at least."""
        firsts = np.zeros(len(classes), bool)
        firsts[offsets[:-1]] = True
        logs = np.empty(len(classes))
        for parts in _pieces(offsets, piece):
            state = self.start
            for a, b in parts:
                lanes = self._laid(classes[a:b], firsts[a:b], lane, len(parts) > 1)
                entering, state = self._enter(lanes, self._through(lanes), state)
                _, scales = self._forward(lanes, entering)
                logs[a + lanes.index[lanes.real]] = np.log10(scales[lanes.real])
        return np.add.reduceat(logs, offsets[:-1]) if len(offsets) > 1 else np.zeros(0)

    def count(self, classes: np.ndarray, offsets: np.ndarray, into: Counts, piece: int = PIECE, lane: int = LANE) -> None:
        """Add the texts' expected counts."""
        firsts = np.zeros(len(classes), bool)
        firsts[offsets[:-1]] = True
        for parts in _pieces(offsets, piece):
            state, entered = self.start, []
            for a, b in parts[:-1]:
                entered.append(state)
                lanes = self._laid(classes[a:b], firsts[a:b], lane, len(parts) > 1)
                state = self._enter(lanes, self._through(lanes), state)[1]
            entered.append(state)
            leaving = np.ones(len(self.start))
            for (a, b), state in zip(reversed(parts), reversed(entered)):
                leaving = self._add(classes[a:b], self._laid(classes[a:b], firsts[a:b], lane, len(parts) > 1), state, leaving, into)

    def _add(self, classes: np.ndarray, lanes: _Lanes, state: np.ndarray, leaving: np.ndarray, into: Counts) -> np.ndarray:
        k, real = len(self.start), lanes.real
        through = self._through(lanes)
        entering, _ = self._enter(lanes, through, state)
        states, scales = self._forward(lanes, entering)
        rest, leaving = self._backward(lanes, through, leaving)
        each = states * rest
        total = each.sum(axis=1)
        each /= total[:, None]
        rest *= lanes.given
        rest *= (~lanes.first & real)[:, None] / (scales * total)[:, None]
        before = np.concatenate([entering[None], states[:-1]])
        side = lambda x: x.swapaxes(0, 1).reshape(k, -1)
        into.move += self.move * (side(before) @ side(rest).T)
        of = classes[lanes.index[real]]
        for s in range(k):
            into.start[s] += each[:, s][lanes.first].sum()
            into.emit[:, s] += np.bincount(of, each[:, s][real], minlength=len(into.emit))
        into.log10 += float(np.log10(scales[real]).sum())
        return leaving
