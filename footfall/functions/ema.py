"""The per-track smoothing step, shared by the batch and the streaming job."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Weight of the new box, overlap below which the track starts anew.
ALPHA = 0.6
MIN_IOU = 0.10

Box = tuple[float, float, float, float]


def overlap(a: Box, b: Box) -> float:
    w = min(a[2], b[2]) - max(a[0], b[0])
    h = min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    inter = w * h
    union = (max(0.0, a[2] - a[0]) * max(0.0, a[3] - a[1])
             + max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1]) - inter)
    return inter / union if union > 0 else 0.0


def smooth(boxes: Iterable[Box], prev: Box | None, alpha: float, min_iou: float) -> Iterator[Box]:
    """Boxes of one track in order, each blended with the result before it."""
    keep = 1 - alpha
    for box in boxes:
        if prev is not None and overlap(box, prev) >= min_iou:
            box = tuple(alpha * new + keep * old for new, old in zip(box, prev))
        prev = box
        yield box


FEW = 24  # tracks below which a step for all of them costs more than a loop over each


def smooth_runs(boxes: np.ndarray, starts: np.ndarray, first: np.ndarray | None, alpha: float, min_iou: float) -> np.ndarray:
    """Rows of ``boxes`` (n x 4) smoothed along runs that begin at ``starts``, the first of which is 0.

    ``first`` is the state before row 0, None for none. Row t of every run is computed in one step for
    all runs, by the arithmetic of ``smooth``; once few runs are left, the rest of each is a loop. The
    result is that of ``smooth`` over each run, bit for bit.
    """
    out = np.array(boxes, np.float64)
    length = np.diff(np.append(starts, len(out)))
    order = np.argsort(-length, kind="stable")
    keep = 1 - alpha
    prev = None  # states of the runs in ``order``, as far as they go on
    for step in range(int(length.max(initial=0))):
        left = int(np.searchsorted(-length[order], -step, "left"))  # runs longer than step
        if left < FEW:
            for run in order[:left]:
                at = int(starts[run]) + step
                state = tuple(out[at - 1]) if step else tuple(first) if run == 0 and first is not None else None
                rest = out[at:starts[run] + length[run]]
                rest[:] = list(smooth(map(tuple, rest.tolist()), state, alpha, min_iou))
            break
        rows = starts[order[:left]] + step
        new = out[rows]
        if step:
            old, blend = prev[:left], None
        else:
            old, blend = np.zeros_like(new), np.zeros(left, bool)
            if first is not None:
                at = int(np.flatnonzero(order[:left] == 0)[0])
                old[at], blend[at] = first, True
        near = _overlaps(new, old) >= min_iou
        near = near if blend is None else near & blend
        new[near] = alpha * new[near] + keep * old[near]
        out[rows] = prev = new
    return out


def _overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``overlap`` of the rows of two arrays of boxes."""
    w = np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0])
    h = np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1])
    inter = w * h
    union = (np.maximum(0.0, a[:, 2] - a[:, 0]) * np.maximum(0.0, a[:, 3] - a[:, 1])
             + np.maximum(0.0, b[:, 2] - b[:, 0]) * np.maximum(0.0, b[:, 3] - b[:, 1]) - inter)
    meet = (w > 0) & (h > 0) & (union > 0)
    return np.divide(inter, union, out=np.zeros(len(a)), where=meet)
