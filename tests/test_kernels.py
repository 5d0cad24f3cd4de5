"""Numpy kernels and trackers: known answers and properties."""

import itertools

import numpy as np
import pytest

from framelake.functions import kalman, kernels
from framelake.operators.tracking import Tracker
from framelake.plans.calibrate import regions


def test_components_by_flood_fill():
    rng = np.random.default_rng(0)
    for _ in range(20):
        mask = rng.random((9, 11)) < 0.55
        labels = kernels.components(mask)
        seen, n = np.zeros(mask.shape, bool), 0
        for start in map(tuple, np.argwhere(mask)):
            if seen[start]:
                continue
            n += 1
            stack, found = [start], []
            seen[start] = True
            while stack:
                r, c = stack.pop()
                found.append((r, c))
                for a, b in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                    if 0 <= a < 9 and 0 <= b < 11 and mask[a, b] and not seen[a, b]:
                        seen[a, b] = True
                        stack.append((a, b))
            assert {labels[p] for p in found} == {n}
        assert labels.max() == n and not labels[~mask].any()


def test_largest_component_of_nothing():
    assert not kernels.largest_component(np.zeros((3, 3), bool)).any()


def test_opening_removes_specks():
    im = np.zeros((9, 9))
    im[1, 1] = 1
    im[4:8, 4:8] = 1
    out = kernels.opening(im, kernels.rectangle(3))
    assert out[1, 1] == 0 and out[5, 5] == 1


def test_outline_and_holes():
    mask = np.zeros((6, 6), bool)
    mask[1:5, 1:5] = True
    path = kernels.outline(mask)
    assert len(path) == 12 and (1, 1) in path and (2, 2) not in path
    mask[2:4, 2:4] = False
    assert kernels.fill_holes(mask)[2:4, 2:4].all()


def test_inpaint_fills_flat():
    im = np.full((5, 5), 7.0)
    im[2, 2] = 0
    assert np.isclose(kernels.inpaint(im, im == 0)[2, 2], 7)


def test_crop_and_back():
    y, x = np.mgrid[:60, :80]
    im = np.exp(-((x - 40) ** 2 + (y - 30) ** 2) / 60.0)
    for angle in (0, 33, 90, 200):
        window = kernels.crop_and_rotate(im, 40, 30, angle, (40, 40))
        back = kernels.uncrop(window, 40, 30, angle, im.shape)
        assert np.abs(back - im)[15:45, 25:55].max() < 0.05
    assert not kernels.crop_and_rotate(im, float("nan"), 1, 0).any()
    assert not kernels.crop_and_rotate(im, -1, 1, 0).any()


def test_runs_of_a_mask():
    mask = np.array([[1, 0], [1, 1]], bool)
    assert kernels.run_lengths(mask) == [0, 2, 1, 1]


def test_suppression():
    a, b, c = np.zeros(10), np.zeros(10), np.zeros(10)
    a[:6], b[1:6], c[7:] = 1, 1, 1
    kept = kernels.suppress(np.stack([a, b, c, np.zeros(10)]).astype(bool), np.array([0.9, 0.8, 0.5, 1.0]))
    assert kept == [0, 2]


def test_floor_plane():
    y, x = np.mgrid[:20, :30]
    im = 700 + 0.5 * x - 0.2 * y
    im[5:9, 5:9] = 660
    plane, away = kernels.plane_ransac(im, (600, 800), 300, 5)
    assert np.isclose(away[0, 0], 0, atol=2) and away[6, 6] > 20
    assert np.allclose(kernels.plane_image(plane, im.shape)[15, 15], im[15, 15], atol=3)
    _, rois = regions(im, (600, 800), 5, 300, 0, (1, 0.1, 1), 0)
    assert rois[0].sum() == im.size  # the hole is filled


def test_kalman_follows_a_line_over_gaps():
    t = np.arange(60.0)
    rng = np.random.default_rng(1)
    truth = np.column_stack([2 * t, 100 - t])
    ys = truth + rng.normal(0, 0.5, truth.shape)
    ys[20:24] = np.nan
    k = kalman.Kalman(2)
    k.start(ys[0])
    k.learn(ys[np.isfinite(ys).any(axis=1)], 10)
    out = k.positions(k.smooth(ys)[0])
    assert np.abs(out - truth)[5:-5].max() < 2.0


def test_em_does_not_lose_likelihood():
    rng = np.random.default_rng(2)
    ys = np.cumsum(rng.normal(0, 1, (50, 1)), axis=0)

    def likelihood(k):
        pm, pc, *_ = k.filter(ys)
        s = pc @ k.c.T
        total = 0.0
        for t in range(len(ys)):
            v = (k.c @ s[t] + k.r)[0, 0]
            total -= 0.5 * (np.log(2 * np.pi * v) + (ys[t, 0] - (k.c @ pm[t])[0]) ** 2 / v)
        return total

    k = kalman.Kalman(1, 2)
    k.start(ys[0])
    before = likelihood(k)
    for _ in range(5):
        k.learn(ys, 1)
        after = likelihood(k)
        assert after >= before - 1e-6
        before = after


def test_transition():
    assert np.allclose(kalman.transition(4, 2.0)[0], [1, 2, 2, 8 / 6])


def test_angle_tracker_undoes_half_turns():
    a = np.full(40, 30.0)
    a[20:22] = 210
    out, flips, done = kalman.AngleTracker().correct(a, np.ones(40), np.zeros(40, bool))
    assert np.allclose(out, 30) and flips[20:22].all() and not flips[:20].any() and (done[20:22] == 2).all()
    low, _, done = kalman.AngleTracker().correct(a, np.r_[np.ones(10), np.zeros(30)], np.zeros(40, bool))
    assert (done[10:] == 1).all() and np.isfinite(low).all()


@pytest.mark.parametrize("kind", ["steady", "random", "two angles"])
def test_long_series_keep_positive_covariances(kind):
    # differences of covariances lose their sign after some hundred steps
    n = 1200
    a = {"steady": np.arange(n) / 2 % 360, "random": np.random.default_rng(4).uniform(0, 360, n), "two angles": np.where(np.arange(n) % 2, 0.0, 180.0)}[kind]
    ys = kalman.AngleTracker._pack(a)
    one, many = kalman.Kalman(2), kalman.Stack(2, 2)
    one.start(ys[0])
    many.start(ys[:2])
    one.learn(ys[:1000])
    many.learn(np.stack([ys[:1000], ys[1:1001]]), np.array([1000, 1000]))
    for part in (one.q, one.r, one.cov, *many.q, *many.r, *many.cov):
        assert np.linalg.eigvalsh(part)[0] > 0
    assert np.allclose(one.r, many.r[0]) and one.r.max() < 2
    for out, flips, done in kalman.correct_together([(a, np.ones(n), np.zeros(n, bool))], 1000):
        assert np.allclose((out - a) % 360, np.where(flips, 180, 0)) and ((done == 2) == flips).all()


def test_long_walks_are_smoothed():
    walk = np.cumsum(np.random.default_rng(5).normal(size=(1000, 8, 2)), axis=0)
    assert np.abs(kalman.PointTracker(8).smooth(walk) - walk).max() < 3


def test_point_tracker_single_rows():
    t = kalman.PointTracker(1)
    first = t.smooth(np.column_stack([np.arange(20.0), np.arange(20.0)])[:, None, :])
    assert first.shape == (20, 1, 2)
    assert t.smooth(np.array([[[20.0, 20.0]]])).shape == (1, 1, 2)


def test_tracker_keeps_identities():
    t, seen = Tracker(), []
    for i in range(10):
        seen.append([track for track, _ in t.step([(i, 0.0), (100 - i, 50.0)])])
    assert all(a == seen[0] for a in seen)
    assert t.step([(500.0, 500.0)])[0][0] not in seen[0]


def test_vote_patterns_have_a_majority():
    # all 2**7 votes: confidence of the call is never under 3 / 7, ties included
    for votes in itertools.product((-1, 1), repeat=7):
        front, rear = np.mean(votes[:4]), np.mean(votes[4:])
        flip = front < rear
        agree = sum(v == (-1 if flip else 1) for v in votes[:4]) + sum(v == (1 if flip else -1) for v in votes[4:])
        assert agree / 7 >= 3 / 7
