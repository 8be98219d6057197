"""Sparse matrices in compressed rows, multiplied row by row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = 4_000_000


@dataclass
class Csr:
    """``at[i]:at[i + 1]`` are the places of row ``i`` in ``index`` (columns) and ``value``."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.at) - 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows, dtype=np.int64), np.diff(self.at))


def summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of their values."""
    if len(key) == 0:
        return key, value
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(value, first)


def csr(row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> Csr:
    """The matrix that counts the given (row, column) places."""
    key, value = summed(row.astype(np.int64) * max(columns, 1) + column, np.ones(len(row), np.int64))
    row, index = np.divmod(key, max(columns, 1))
    return Csr(np.searchsorted(row, np.arange(rows + 1)), index, value, columns)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.index, kind="stable")
    at = np.searchsorted(m.index[order], np.arange(m.columns + 1))
    return Csr(at, m.row[order], m.value[order], m.rows)


def product(a: Csr, b: Csr, step: int = STEP) -> Csr:
    """``a · b`` by Gustavson's rule: row ``i`` of the product is the sum of the
    rows of ``b`` that the entries of row ``i`` of ``a`` name, times these entries.

    At most ``step`` products (or those of one entry) are open at a time; what
    they add up to is kept, so memory follows the result and not the products.
    """
    width = b.at[a.index + 1] - b.at[a.index]
    upto = np.concatenate([[0], np.cumsum(width)])
    row = a.row
    keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    first = 0
    while first < len(width):
        last = max(int(np.searchsorted(upto, upto[first] + step, "right")) - 1, first + 1)
        n = width[first:last]
        place = np.repeat(b.at[a.index[first:last]] - (upto[first:last] - upto[first]), n)
        place += np.arange(len(place))
        key = np.repeat(row[first:last], n) * max(b.columns, 1) + b.index[place]
        key, value = summed(key, np.repeat(a.value[first:last], n) * b.value[place])
        keys.append(key)
        values.append(value)
        first = last
    key, value = summed(np.concatenate(keys), np.concatenate(values))
    row, index = np.divmod(key, max(b.columns, 1))
    return Csr(np.searchsorted(row, np.arange(a.rows + 1)), index, value, b.columns)
