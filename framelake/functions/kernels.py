"""Numpy kernels over one image or one series, for what column expressions can't say."""

from __future__ import annotations

import numpy as np


def rectangle(size: int) -> np.ndarray:
    return np.ones((size, size), bool)


def ellipse(size: int) -> np.ndarray:
    """A disc that fills a square."""
    r = size // 2
    y, x = np.mgrid[-r : size - r, -r : size - r]
    return x * x + y * y <= max(r, 0.5) ** 2


def _views(image: np.ndarray, shape: tuple[int, int], mode: str, fill: float = 0.0) -> np.ndarray:
    h, w = shape
    pad = ((h // 2, h - 1 - h // 2), (w // 2, w - 1 - w // 2))
    padded = np.pad(image, pad, mode="edge") if mode == "edge" else np.pad(image, pad, constant_values=fill)
    return np.lib.stride_tricks.sliding_window_view(padded, shape)


def median_blur(image: np.ndarray, size: int) -> np.ndarray:
    return np.median(_views(image, (size, size), "edge"), axis=(2, 3))


def erode(image: np.ndarray, element: np.ndarray) -> np.ndarray:
    return np.where(element, _views(image, element.shape, "fill", np.inf), np.inf).min(axis=(2, 3))


def dilate(image: np.ndarray, element: np.ndarray) -> np.ndarray:
    return np.where(element[::-1, ::-1], _views(image, element.shape, "fill", -np.inf), -np.inf).max(axis=(2, 3))


def opening(image: np.ndarray, element: np.ndarray, rounds: int = 1) -> np.ndarray:
    out = image.astype(float)
    for _ in range(rounds):
        out = erode(out, element)
    for _ in range(rounds):
        out = dilate(out, element)
    return out


def components(mask: np.ndarray) -> np.ndarray:
    """Labels of the 4-connected components from 1 on, in reading order of their first pixel; 0 outside.

    Runs of each row are joined with those of the row above that they touch (union-find over runs).
    """
    parent: list[int] = [0]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    labels = np.zeros(mask.shape, np.int64)
    above: list[tuple[int, int, int]] = []
    for r, row in enumerate(mask):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], row.astype(np.int8), [0]))))
        now = []
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            parent.append(len(parent))
            label = len(parent) - 1
            for c, d, other in above:
                if c < b and a < d:
                    x, y = find(label), find(other)
                    parent[max(x, y)] = min(x, y)
            labels[r, a:b] = label
            now.append((a, b, label))
        above = now
    roots = np.array([find(i) for i in range(len(parent))])
    names = np.zeros(len(parent), np.int64)
    names[np.unique(roots[1:])] = np.arange(1, len(np.unique(roots[1:])) + 1) if len(parent) > 1 else 0
    return names[roots][labels]


def largest_component(mask: np.ndarray) -> np.ndarray:
    labels = components(mask)
    if not labels.any():
        return np.zeros(mask.shape, bool)
    return labels == 1 + np.argmax(np.bincount(labels.ravel())[1:])


def region_properties(mask: np.ndarray) -> list[dict[str, float]]:
    """Label, area, extent (share of its box) and greatest distance from the image's centre of each component."""
    labels, out = components(mask), []
    centre = np.array(mask.shape) / 2
    for label in range(1, labels.max() + 1):
        at = np.argwhere(labels == label)
        box = at.max(axis=0) - at.min(axis=0) + 1
        out.append({"label": label, "area": float(len(at)), "extent": len(at) / float(box.prod()), "distance": float(np.sqrt(((at - centre) ** 2).sum(axis=1)).max())})
    return out


def outline(mask: np.ndarray) -> list[tuple[int, int]]:
    """The outer border of a mask's first component as (x, y), clockwise, by following the border from its first pixel."""
    at = np.argwhere(mask)
    if not len(at):
        return []
    steps = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]
    inside = lambda r, c: 0 <= r < mask.shape[0] and 0 <= c < mask.shape[1] and bool(mask[r, c])
    start = here = (int(at[0][0]), int(at[0][1]))
    back, path, first = 4, [], None
    while True:
        for k in range(1, 9):
            d = (back + k) % 8
            to = (here[0] + steps[d][0], here[1] + steps[d][1])
            if inside(*to):
                break
        else:
            return [(here[1], here[0])]
        if here == start and d == first:
            return path
        first = d if first is None else first
        path.append((here[1], here[0]))
        here, back = to, (d + 4) % 8


def fill_holes(mask: np.ndarray) -> np.ndarray:
    """A mask with the background that doesn't touch the image's edge filled."""
    outside = components(~mask)
    edge = np.unique(np.concatenate([outside[0], outside[-1], outside[:, 0], outside[:, -1]]))
    return mask | ~np.isin(outside, edge[edge > 0])


def inpaint(image: np.ndarray, missing: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Missing pixels by repeated means of their known or filled neighbours."""
    out, known = np.where(missing, 0.0, image.astype(float)), ~missing
    if known.all() or not known.any():
        return image.astype(float)
    for _ in range(rounds):
        padded, weight = np.pad(out * known, 1), np.pad(known.astype(float), 1)
        total = padded[:-2, 1:-1] + padded[2:, 1:-1] + padded[1:-1, :-2] + padded[1:-1, 2:]
        count = weight[:-2, 1:-1] + weight[2:, 1:-1] + weight[1:-1, :-2] + weight[1:-1, 2:]
        new = missing & (count > 0)
        before = out.copy()
        out[new] = total[new] / count[new]
        done = known.all() and np.abs(out - before).max() < 1e-6
        known = known | new
        if done:
            break
    return out


def affine(image: np.ndarray, matrix: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Resampled image: pixel (x, y) of the result comes from ``matrix`` @ (x, y, 1), bilinear, 0 outside."""
    y, x = np.mgrid[: shape[0], : shape[1]].astype(float)
    sx, sy = (matrix[i, 0] * x + matrix[i, 1] * y + matrix[i, 2] for i in (0, 1))
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    fx, fy = sx - x0, sy - y0

    def at(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        ok = (r >= 0) & (r < image.shape[0]) & (c >= 0) & (c < image.shape[1])
        return np.where(ok, image[np.clip(r, 0, image.shape[0] - 1), np.clip(c, 0, image.shape[1] - 1)], 0.0)

    return (1 - fy) * ((1 - fx) * at(y0, x0) + fx * at(y0, x0 + 1)) + fy * ((1 - fx) * at(y0 + 1, x0) + fx * at(y0 + 1, x0 + 1))


def crop_and_rotate(image: np.ndarray, cx: float, cy: float, degrees: float, size: tuple[int, int] = (80, 80)) -> np.ndarray:
    """A window of a size about a centre, turned by an angle; all 0 if the centre or angle is missing or the centre is negative."""
    if not np.isfinite([cx, cy, degrees]).all() or cx < 0 or cy < 0:
        return np.zeros(size)
    a = np.deg2rad(degrees)
    rotation = np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]])
    half = np.array([size[1] // 2, size[0] // 2])
    return affine(image, np.column_stack([rotation, np.array([cx, cy]) - rotation @ half]), size)


def uncrop(window: np.ndarray, cx: float, cy: float, degrees: float, shape: tuple[int, int]) -> np.ndarray:
    """The inverse: a turned window back at its place in an image of a shape."""
    if not np.isfinite([cx, cy, degrees]).all() or cx < 0 or cy < 0:
        return np.zeros(shape)
    a = np.deg2rad(degrees)
    back = np.array([[np.cos(a), np.sin(a)], [-np.sin(a), np.cos(a)]])
    half = np.array([window.shape[1] // 2, window.shape[0] // 2])
    return affine(window, np.column_stack([back, half - back @ np.array([cx, cy])]), shape)


def polygon_mask(vertices: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Pixels whose centre lies in a polygon of (x, y)."""
    y, x = np.mgrid[: shape[0], : shape[1]]
    inside = np.zeros(shape, bool)
    for (x0, y0), (x1, y1) in zip(vertices, np.roll(vertices, -1, axis=0), strict=True):
        if y0 != y1:
            inside ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    return inside


def run_lengths(mask: np.ndarray) -> list[int]:
    """Lengths of the runs of a mask in column order, the first of zeros."""
    flat = mask.T.ravel().astype(np.int8)
    edges = np.flatnonzero(np.diff(flat)) + 1
    lengths = np.diff(np.concatenate(([0], edges, [len(flat)]))).tolist()
    return [0, *lengths] if len(flat) and flat[0] else lengths


def plane_through(points: np.ndarray) -> np.ndarray | None:
    """(a, b, c, d) with unit normal of the plane through three points; None if they are in line."""
    normal = np.cross(points[1] - points[0], points[2] - points[0])
    size = float((normal**2).sum())
    if size < np.spacing(1):
        return None
    normal = normal / np.sqrt(size)
    return np.append(normal, -points[0] @ normal)


def plane_ransac(image: np.ndarray, depth_range: tuple[float, float] = (650, 750), rounds: int = 1000, tolerance: float = 30, least_share: float = 0.1, seed: int = 0) -> tuple[np.ndarray | None, np.ndarray]:
    """The plane that most pixels lie near, and every pixel's distance from it.

    A plane through three random pixels in the depth range replaces the best so far if it has more pixels within the
    tolerance and a lower mean distance. Without one the distances are infinite.
    """
    y, x = np.mgrid[: image.shape[0], : image.shape[1]]
    use = (image > depth_range[0]) & (image < depth_range[1])
    points = np.column_stack([x[use], y[use], image[use]]).astype(float)
    best, best_mean, best_n = None, np.inf, 0
    rng = np.random.default_rng(seed)
    for _ in range(rounds if len(points) else 0):
        plane = plane_through(points[rng.integers(0, len(points), 3)])
        if plane is None:
            continue
        away = np.abs(points @ plane[:3] + plane[3])
        near = int((away < tolerance).sum())
        if near / len(points) > least_share and near > best_n and away.mean() < best_mean:
            best, best_mean, best_n = plane, float(away.mean()), near
    if best is None:
        return None, np.full(image.shape, np.inf)
    return best, np.abs(best[0] * x + best[1] * y + best[2] * image + best[3])


def plane_image(plane: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Depth of a plane at each pixel."""
    y, x = np.mgrid[: shape[0], : shape[1]]
    return (plane[0] * x + plane[1] * y + plane[3]) / -plane[2]


def suppress(masks: np.ndarray, scores: np.ndarray, threshold: float = 0.5, corrected: bool = False) -> list[int]:
    """Instances (n, pixels) that stay, best first.

    Of each pair over the threshold among those left the lower scored goes; ``corrected`` only drops those that
    overlap the one just picked. Empty masks go first.
    """
    left = [i for i in np.argsort(scores, kind="stable") if masks[i].any()]
    kept = []
    while left:
        pick = left.pop()
        kept.append(int(pick))
        if not left:
            break
        m = masks[[*left, pick]].astype(np.int64)
        both = m @ m.T
        area = m.sum(axis=1)
        iou = both / (area[:, None] + area[None, :] - both)
        over = iou[:-1, -1] > threshold if corrected else np.triu(iou, 1)[:-1].max(axis=1) > threshold
        left = [i for i, gone in zip(left, over, strict=True) if not gone]
    return kept
