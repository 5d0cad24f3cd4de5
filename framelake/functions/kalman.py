"""Kalman filter, smoother and EM in numpy, and the trackers' state models.

Observations with any missing component don't update the state, they only let it go on.

Covariances are updated and smoothed as sums of squares and kept symmetric: with the shorter differences rounding errors grow
with each step, and after some hundred steps covariances are no longer positive.
"""

from __future__ import annotations

import math

import numpy as np


def transition(order: int, step: float = 1.0) -> np.ndarray:
    """Position and its derivatives one step on: upper triangular in 1, dt, dt**2 / 2, dt**3 / 6."""
    series = [step**k / math.factorial(k) for k in range(order)]
    return np.array([[series[j - i] if j >= i else 0.0 for j in range(order)] for i in range(order)])


def symmetric(a: np.ndarray) -> np.ndarray:
    return (a + np.swapaxes(a, -1, -2)) / 2


def block(part: np.ndarray, n: int) -> np.ndarray:
    return np.kron(np.eye(n), part)


class Kalman:
    """A linear model of ``n`` observed coordinates, each with ``order`` states."""

    def __init__(self, n: int, order: int = 3, step: float = 1.0):
        self.n, self.order = n, order
        self.a = block(transition(order, step), n)
        self.c = block(np.eye(1, order), n)
        size = n * order
        self.q, self.r = np.eye(size), np.eye(n)
        self.mean, self.cov = np.zeros(size), np.eye(size)

    def start(self, first: np.ndarray) -> None:
        """Positions of the initial state; missing ones are 0."""
        self.mean = np.zeros(self.n * self.order)
        self.mean[:: self.order] = np.where(np.isfinite(first), first, 0.0)

    def predict(self, mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.a @ mean, symmetric(self.a @ cov @ self.a.T + self.q)

    def update(self, mean: np.ndarray, cov: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not np.isfinite(y).all():
            return mean, cov, np.zeros((len(mean), self.n))
        gain = np.linalg.solve(self.c @ cov @ self.c.T + self.r, self.c @ cov).T
        rest = np.eye(len(mean)) - gain @ self.c
        return mean + gain @ (y - self.c @ mean), symmetric(rest @ cov @ rest.T + gain @ self.r @ gain.T), gain

    def filter(self, ys: np.ndarray):
        """Predicted and filtered means and covariances, and the last gain."""
        pm, pc, fm, fc = [], [], [], []
        gain = np.zeros((len(self.mean), self.n))
        for t, y in enumerate(ys):
            m, v = (self.mean, self.cov) if t == 0 else self.predict(fm[-1], fc[-1])
            pm.append(m)
            pc.append(v)
            m, v, gain = self.update(m, v, y)
            fm.append(m)
            fc.append(v)
        return np.array(pm), np.array(pc), np.array(fm), np.array(fc), gain

    def smooth(self, ys: np.ndarray):
        """Smoothed means and covariances, and each step's covariance with the one before."""
        pm, pc, fm, fc, gain = self.filter(ys)
        m, v = fm.copy(), fc.copy()
        back = np.zeros_like(fc)
        for t in range(len(ys) - 2, -1, -1):
            back[t] = np.linalg.solve(pc[t + 1], self.a @ fc[t]).T
            m[t] = fm[t] + back[t] @ (m[t + 1] - pm[t + 1])
            rest = np.eye(len(self.a)) - back[t] @ self.a
            v[t] = symmetric(rest @ fc[t] @ rest.T + back[t] @ (v[t + 1] + self.q) @ back[t].T)
        pairs = np.zeros_like(fc)
        for t in range(1, len(ys)):
            pairs[t] = v[t] @ back[t - 1].T
        return m, v, pairs

    def learn(self, ys: np.ndarray, rounds: int = 10) -> None:
        """Noise covariances and the initial covariance by expectation maximisation."""
        for _ in range(rounds):
            m, v, pairs = self.smooth(ys)
            seen = np.isfinite(ys).all(axis=1)
            if seen.any():
                e = ys[seen] - m[seen] @ self.c.T
                r = (e.T @ e + self.c @ v[seen].sum(axis=0) @ self.c.T) / seen.sum()
            else:
                r = self.r
            q = self.q
            if len(ys) > 1:
                e = m[1:] - m[:-1] @ self.a.T
                cross = pairs[1:].sum(axis=0) @ self.a.T
                q = (e.T @ e + self.a @ v[:-1].sum(axis=0) @ self.a.T + v[1:].sum(axis=0) - cross - cross.T) / (len(ys) - 1)
            d = m[0] - self.mean
            self.cov = v[0] + np.outer(d, d)
            self.q, self.r = symmetric(q), symmetric(r)

    def advance(self, mean: np.ndarray, cov: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of filtering from a filtered state."""
        m, v, _ = self.update(*self.predict(mean, cov), y)
        return m, v

    def positions(self, means: np.ndarray) -> np.ndarray:
        return means[..., :: self.order]


class PointTracker:
    """Smooths points chunk by chunk: parameters from the first chunk, the last state handed on."""

    def __init__(self, n_points: int, order: int = 3, rounds: int = 10):
        self.model, self.rounds, self.ready = Kalman(2 * n_points, order), rounds, False

    def smooth(self, chunk: np.ndarray) -> np.ndarray:
        """Smoothed points of a chunk (frames, points, 2)."""
        ys = chunk.reshape(len(chunk), -1).astype(float)
        if not self.ready:
            self.model.start(ys[0])
            some = ys[np.isfinite(ys).any(axis=1)]
            if len(some):
                self.model.learn(some, self.rounds)
            self.ready = True
        if len(ys) == 1:
            m, v = self.model.advance(self.model.mean, self.model.cov, ys[0])
            means = m[None]
        else:
            means, covs, _ = self.model.smooth(ys)
            m, v = means[-1], covs[-1]
        self.model.mean, self.model.cov = m, v
        return self.model.positions(means).reshape(chunk.shape)


class AngleTracker:
    """Angles as sine and cosine, filtered step by step; corrects what the last state contradicts."""

    def __init__(self, order: int = 3, rounds: int = 10, least_alignment: float = 0.4, half_turn: float = 140.0):
        self.model, self.rounds, self.ready = Kalman(2, order), rounds, False
        self.least_alignment, self.half_turn = least_alignment, half_turn

    @staticmethod
    def _pack(degrees: np.ndarray) -> np.ndarray:
        a = np.deg2rad(degrees)
        return np.column_stack([np.sin(a), np.cos(a)])

    def angle(self) -> float:
        """The angle of the state, in [0, 360)."""
        y, x = self.model.positions(self.model.mean)
        return float(np.rad2deg(np.arctan2(y, x)) % 360)

    def correct(self, angles: np.ndarray, alignment: np.ndarray, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Angles, flips and what was done (0 nothing, 1 taken from the state, 2 turned by 180 degrees)."""
        ys = self._pack(angles)
        if not self.ready:
            self.model.start(ys[0])
            some = ys[np.isfinite(ys).any(axis=1)]
            if len(some):
                self.model.learn(some, self.rounds)
            self.ready = True
        angles, flips, done = angles.copy(), flips.copy(), np.zeros(len(angles), np.int32)
        for i in range(len(angles)):
            expected = self.angle()
            off = (angles[i] - expected) % 360
            off = off - 360 if off > 180 else off
            if alignment[i] < self.least_alignment:
                angles[i], done[i] = expected, 1
            elif abs(off) > self.half_turn:
                angles[i], flips[i], done[i] = (angles[i] + 180) % 360, not flips[i], 2
            self.model.mean, self.model.cov = self.model.advance(self.model.mean, self.model.cov, self._pack(angles[i : i + 1])[0])
        return angles, flips, done


class Stack:
    """Independent models of one shape that advance together: ``Kalman`` for many series at once, padded to the longest.

    Series are in falling order of length, so those that still run are the first ones.
    """

    def __init__(self, count: int, n: int, order: int = 3):
        one = Kalman(n, order)
        self.n, self.order, self.a, self.c = n, order, one.a, one.c
        size = n * order
        self.q, self.r = np.tile(np.eye(size), (count, 1, 1)), np.tile(np.eye(n), (count, 1, 1))
        self.mean, self.cov = np.zeros((count, size)), np.tile(np.eye(size), (count, 1, 1))

    def start(self, first: np.ndarray) -> None:
        self.mean = np.zeros_like(self.mean)
        self.mean[:, :: self.order] = np.where(np.isfinite(first), first, 0.0)

    def _predict(self, mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return mean @ self.a.T, symmetric(self.a @ cov @ self.a.T + self.q[: len(mean)])

    def _update(self, mean: np.ndarray, cov: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = len(mean)
        seen = np.isfinite(y).all(axis=1)
        gain = np.linalg.solve(self.c @ cov @ self.c.T + self.r[:k], self.c @ cov).transpose(0, 2, 1)
        off = np.where(seen[:, None], y, 0.0) - mean @ self.c.T
        rest = np.eye(mean.shape[1]) - gain @ self.c
        less = symmetric(rest @ cov @ rest.transpose(0, 2, 1) + gain @ self.r[:k] @ gain.transpose(0, 2, 1))
        return np.where(seen[:, None], mean + (gain @ off[:, :, None])[:, :, 0], mean), np.where(seen[:, None, None], less, cov)

    def smooth(self, ys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Smoothed means and covariances (steps first), and each step's covariance with the one before; ``ys`` is (series, steps, n)."""
        count, steps, _ = ys.shape
        size = self.mean.shape[1]
        pm, pc = np.zeros((steps, count, size)), np.tile(np.eye(size), (steps, count, 1, 1))
        fm, fc = np.zeros_like(pm), np.zeros_like(pc)
        for t in range(steps):
            k = int((lengths > t).sum())
            m, v = (self.mean[:k], self.cov[:k]) if t == 0 else self._predict(fm[t - 1, :k], fc[t - 1, :k])
            pm[t, :k], pc[t, :k] = m, v
            fm[t, :k], fc[t, :k] = self._update(m, v, ys[:k, t])
        m, v, back = fm.copy(), fc.copy(), np.zeros_like(fc)
        for t in range(steps - 2, -1, -1):
            k = int((lengths > t + 1).sum())
            if not k:
                continue
            b = np.linalg.solve(pc[t + 1, :k], self.a @ fc[t, :k]).transpose(0, 2, 1)
            m[t, :k] = fm[t, :k] + (b @ (m[t + 1, :k] - pm[t + 1, :k])[:, :, None])[:, :, 0]
            rest = np.eye(size) - b @ self.a
            v[t, :k] = symmetric(rest @ fc[t, :k] @ rest.transpose(0, 2, 1) + b @ (v[t + 1, :k] + self.q[:k]) @ b.transpose(0, 2, 1))
            back[t, :k] = b
        pairs = np.zeros_like(fc)
        pairs[1:] = v[1:] @ back[:-1].transpose(0, 1, 3, 2)
        return m, v, pairs

    def learn(self, ys: np.ndarray, lengths: np.ndarray, rounds: int = 10) -> None:
        """Each series' noise covariances and initial covariance; series of length 0 keep theirs."""
        count, steps, _ = ys.shape
        if not steps:
            return
        at = np.arange(steps)
        inside = at[None, :] < lengths[:, None]
        seen = inside & np.isfinite(ys).all(axis=2)
        later = (inside & (at > 0)).T[:, :, None, None]
        n_seen, some = seen.sum(axis=1), lengths > 0
        for _ in range(rounds):
            m, v, pairs = self.smooth(ys, lengths)
            e = np.where(seen[:, :, None], ys, 0.0) - np.where(seen[:, :, None], (m @ self.c.T).transpose(1, 0, 2), 0.0)
            seen_v = np.where(seen.T[:, :, None, None], v, 0.0).sum(axis=0)
            r = (e.transpose(0, 2, 1) @ e + self.c @ seen_v @ self.c.T) / np.maximum(n_seen, 1)[:, None, None]
            r = np.where((n_seen > 0)[:, None, None], r, self.r)
            e = np.where(later[1:, :, :, 0], m[1:] - m[:-1] @ self.a.T, 0.0).transpose(1, 0, 2)
            cross = np.where(later, pairs, 0.0).sum(axis=0) @ self.a.T
            old, new = np.where(later[1:], v[:-1], 0.0).sum(axis=0), np.where(later[1:], v[1:], 0.0).sum(axis=0)
            q = (e.transpose(0, 2, 1) @ e + self.a @ old @ self.a.T + new - cross - cross.transpose(0, 2, 1)) / np.maximum(lengths - 1, 1)[:, None, None]
            q = np.where((lengths > 1)[:, None, None], q, self.q)
            d = m[0] - self.mean
            self.cov = np.where(some[:, None, None], v[0] + d[:, :, None] * d[:, None, :], self.cov)
            self.q, self.r = np.where(some[:, None, None], symmetric(q), self.q), np.where(some[:, None, None], symmetric(r), self.r)


def correct_together(series: list[tuple[np.ndarray, np.ndarray, np.ndarray]], chunk: int, order: int = 3, rounds: int = 10, least_alignment: float = 0.4, half_turn: float = 140.0) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``AngleTracker`` over many series (angles, alignments, flips) at once; each learns from its first ``chunk`` frames."""
    if not series:
        return []
    pack = AngleTracker._pack
    observed = [pack(a) for a, _, _ in series]
    taught = [y[:chunk][np.isfinite(y[:chunk]).any(axis=1)] for y in observed]

    def padded(parts: list[np.ndarray], by: np.ndarray, fill: float) -> np.ndarray:
        out = np.full((len(parts), max((len(p) for p in parts), default=0), *parts[0].shape[1:]), fill)
        for i, k in enumerate(by):
            out[i, : len(parts[k])] = parts[k]
        return out

    n_taught = np.array([len(y) for y in taught])
    by = np.argsort(-n_taught, kind="stable")
    model = Stack(len(series), 2, order)
    model.start(np.array([observed[k][0] for k in by]))
    model.learn(padded(taught, by, np.nan), n_taught[by], rounds)

    lengths = np.array([len(a) for a, _, _ in series])
    to = np.argsort(-lengths, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    for name in ("q", "r", "mean", "cov"):
        setattr(model, name, getattr(model, name)[place[to]])
    angles, alignment = padded([s[0].astype(float) for s in series], to, np.nan), padded([s[1].astype(float) for s in series], to, np.nan)
    flips = padded([s[2].astype(float) for s in series], to, 0.0) > 0
    done = np.zeros(angles.shape, np.int32)
    mean, cov = model.mean, model.cov
    for t in range(angles.shape[1]):
        k = int((lengths > t).sum())
        state = mean[:k, :: model.order]
        expected = np.rad2deg(np.arctan2(state[:, 0], state[:, 1])) % 360
        off = (angles[:k, t] - expected) % 360
        off = np.where(off > 180, off - 360, off)
        weak = alignment[:k, t] < least_alignment
        turn = ~weak & (np.abs(off) > half_turn)
        angles[:k, t] = np.where(weak, expected, np.where(turn, (angles[:k, t] + 180) % 360, angles[:k, t]))
        flips[:k, t] ^= turn
        done[:k, t] = np.where(weak, 1, np.where(turn, 2, 0))
        mean, cov = model._update(*model._predict(mean[:k], cov[:k]), pack(angles[:k, t]))
    out: list = [None] * len(series)
    for i, k in enumerate(to):
        n = lengths[k]
        out[k] = (angles[i, :n], flips[i, :n], done[i, :n])
    return out
