"""Small helpers on boolean link matrices, used inside tasks."""

from __future__ import annotations

import numpy as np


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest, as (row, column) pairs, of the bipartite graph that a boolean matrix describes."""
    out: list[tuple[int, int]] = []
    rows_left, columns_left = links.any(axis=1), links.any(axis=0)
    while rows_left.any():
        front = np.array([int(np.argmax(rows_left))])
        rows_left[front] = False
        while len(front):
            hit = links[front] & columns_left
            reached = np.flatnonzero(hit.any(axis=0))
            out += zip(front[hit[:, reached].argmax(axis=0)].tolist(), reached.tolist(), strict=True)
            if not len(reached):
                break
            columns_left[reached] = False
            back = links[:, reached] & rows_left[:, None]
            front = np.flatnonzero(back.any(axis=1))
            out += zip(front.tolist(), reached[back[front].argmax(axis=1)].tolist(), strict=True)
            rows_left[front] = False
    return out
