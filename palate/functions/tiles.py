"""Matrix products over one block of users and one block of items."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TILE_CELLS = 1 << 20  # scores held at once inside a tile; small enough to stay in cache

LOWEST = np.finfo(np.float32).min


def _vectors(table: pa.Table, id_column: str, vector_column: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and their vectors as rows; vectors with a NaN cannot be scored."""
    table = table.sort_by(id_column)
    ids = table[id_column].to_numpy()
    flat = table[vector_column].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(len(ids), -1).astype(np.float64)
    scorable = np.isfinite(matrix).all(axis=1)
    return ids[scorable], matrix[scorable]


def _positions(sorted_ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted id sits in ``sorted_ids``, and whether it is there at all."""
    at = np.minimum(np.searchsorted(sorted_ids, wanted), len(sorted_ids) - 1)
    return at, sorted_ids[at] == wanted


def best_in_tile(left: pa.Table, right: pa.Table, n: int) -> pa.Table:
    """Each user's ``n`` best unseen items of one tile; equal scores go to the smaller id."""
    is_user = pc.is_null(left["movieId"])
    history = left.filter(pc.invert(is_user))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    user_ids = item_ids = np.empty(0, np.int32)
    if right.num_rows and history.num_rows < left.num_rows:
        user_ids, users = _vectors(left.filter(is_user), "userId", "u")
        item_ids, items = _vectors(right, "movieId", "v")
    if len(user_ids) and len(item_ids):
        row, user_known = _positions(user_ids, history["userId"].to_numpy())
        col, item_known = _positions(item_ids, history["movieId"].to_numpy())
        known = user_known & item_known
        order = np.argsort(row[known], kind="stable")
        row, col = row[known][order], col[known][order]

        step = min(len(user_ids), max(1, TILE_CELLS // len(item_ids)))
        exact = np.empty((step, len(item_ids)))
        scores, work = (np.empty(exact.shape, np.float32) for _ in range(2))
        for start in range(0, len(user_ids), step):
            ids = user_ids[start:start + step]
            np.matmul(users[start:start + step], items.T, out=exact[:len(ids)])
            scores[:len(ids)] = exact[:len(ids)]
            lo, hi = np.searchsorted(row, [start, start + step])
            scores[row[lo:hi] - start, col[lo:hi]] = -np.inf
            found.append(_best_in_rows(scores[:len(ids)], work[:len(ids)], ids, item_ids, n))
    empty = (np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32))
    columns = [np.concatenate(c) for c in zip(*found)] if found else empty
    return pa.table(dict(zip(("userId", "movieId", "prediction"), columns)))


def _best_in_rows(scores: np.ndarray, work: np.ndarray, user_ids: np.ndarray, item_ids: np.ndarray, n: int):
    """Top ``n`` entries of every row, blanked ones left out; columns are in id order, which settles ties."""
    last = scores.shape[1] - min(n, scores.shape[1])
    work[:] = scores
    work.partition(last, axis=1)
    bar = np.maximum(work[:, last], LOWEST)
    row, col = np.nonzero(scores >= bar[:, None])
    value = scores[row, col]
    order = np.lexsort((col, -value, row))
    row, col, value = row[order], col[order], value[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    best = place < n
    return user_ids[row[best]], item_ids[col[best]], value[best]
