"""Matrices of vector columns inside tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd


def matrix(vectors: pd.Series) -> np.ndarray:
    m = np.array(vectors.tolist(), dtype=np.float64)
    return m.reshape(len(vectors), -1)


def unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def best_rows(q_ids, i_ids, scores: np.ndarray, k: int, threshold: float | None, skip_self: bool) -> pd.DataFrame:
    """k best items of every query row, ties by item id."""
    out_q, out_i, out_s = [], [], []
    rounded = np.round(scores, 9)
    for row in range(scores.shape[0]):
        r = rounded[row]
        keep = np.ones(len(r), dtype=bool) if threshold is None else r >= threshold
        if skip_self:
            keep &= i_ids != q_ids[row]
        at = np.flatnonzero(keep)
        if len(at) > k:
            cut = np.partition(r[at], len(at) - k)[len(at) - k]
            at = at[r[at] >= cut]
        at = at[np.lexsort((i_ids[at], -r[at]))][:k]
        out_q.extend([q_ids[row]] * len(at))
        out_i.extend(i_ids[at])
        out_s.extend(scores[row][at])
    return pd.DataFrame({"query_id": np.array(out_q, dtype="int64"), "item_id": np.array(out_i, dtype="int64"),
                         "score": np.array(out_s, dtype="float64")})
