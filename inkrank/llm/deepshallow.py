"""Deep-shallow sorting of strings that share long prefixes.

Multikey quicksort, eight bytes to a key, orders all strings to a shallow depth;
all parts of one round are split at once. What then still stands together has a
common prefix of that depth, and is ordered by a blind trie, which looks at one
byte per branch on the way down and compares each string with one other only.
"""

from __future__ import annotations

import numpy as np

#: Keys of eight bytes that multikey quicksort looks at.
SHALLOW = 4


def keys_of(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian 64-bit keys."""
    count, width = rows.shape
    wide = -(-width // 8) * 8
    padded = np.zeros((count, wide), np.uint8)
    padded[:, :width] = rows
    return padded.view(">u8").astype(np.uint64)


def multikey_quicksort(keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by their first ``depth`` keys, and in that order the
    number of the part each belongs to; the rows of a part have equal keys."""
    count = len(keys)
    order = np.arange(count)
    part = np.zeros(count, np.int64)
    level = np.zeros(count, np.int64)
    if not count:
        return order, part
    open_ = np.ones(count, bool)
    while True:
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sizes = np.diff(np.append(starts, count))
        size_at = np.repeat(sizes, sizes)
        open_ = (size_at > 1) & (level < depth)
        if not open_.any():
            return order, part
        at = np.flatnonzero(open_)
        rows, own = order[at], part[at]
        key = keys[rows, level[at]]
        # The pivot of a part is the median of its first, middle and last key.
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        lengths = np.diff(np.append(heads, len(own)))
        three = np.stack([key[heads], key[heads + lengths // 2], key[heads + lengths - 1]])
        pivot = np.repeat(np.sort(three, axis=0)[1], lengths)
        side = np.where(key < pivot, 0, np.where(key == pivot, 1, 2))
        number = np.repeat(np.arange(len(heads)), lengths) * 3 + side
        turn = np.argsort(number, kind="stable")
        order[at] = rows[turn]
        level[at] = (level[at] + (side == 1))[turn]
        # Parts are renumbered: three for each that was open.
        fresh = np.zeros(count, bool)
        fresh[starts] = True
        fresh[at[np.flatnonzero(np.diff(number[turn])) + 1]] = True
        part = np.cumsum(fresh) - 1


class BlindTrie:
    """Strings in a trie whose inner nodes hold a depth and one byte per child.

    A node is ``[depth, children]`` or, as a leaf, the list of equal strings.
    """

    def __init__(self, strings: list[bytes]):
        self._strings = strings
        self._root: list | None = None

    def add(self, number: int) -> None:
        if self._root is None:
            self._root = [-1, [number]]
            return
        own = self._strings[number]
        path, node = [], self._root
        while node[0] >= 0:
            path.append(node)
            # Blind: the bytes between branches are not looked at.
            children = node[1]
            node = children.get(own[node[0]]) or next(iter(children.values()))
        other = self._strings[node[1][0]]
        if own == other:
            node[1].append(number)
            return
        depth = _common(own, other)
        above = None
        for step in path:
            if step[0] > depth:
                break
            above = step
        leaf = [-1, [number]]
        if above is not None and above[0] == depth:
            above[1][own[depth]] = leaf
            return
        below = self._root if above is None else above[1][own[above[0]]]
        inner = [depth, {other[depth]: below, own[depth]: leaf}]
        if above is None:
            self._root = inner
        else:
            above[1][own[above[0]]] = inner

    def ordered(self) -> list[int]:
        out, stack = [], [self._root] if self._root else []
        while stack:
            depth, rest = stack.pop()
            if depth < 0:
                out += rest
            else:
                stack += [rest[byte] for byte in sorted(rest, reverse=True)]
        return out


def _common(a: bytes, b: bytes) -> int:
    """Equal leading bytes of two different strings of one length."""
    size = len(a)
    apart = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return size - (apart.bit_length() + 7) // 8


def sort(rows: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, and of each but the first the number of leading
    bytes it has in common with the row before (0 for the first)."""
    keys = keys_of(rows)
    order, part = multikey_quicksort(keys, min(shallow, keys.shape[1]))
    if shallow < keys.shape[1] and len(order):
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(starts[1:], len(order))
        # Parts of wholly equal rows are in order as they are.
        rest = keys[:, shallow:]
        differs = np.zeros(len(order), bool)
        differs[1:] = (rest[order[1:]] != rest[order[:-1]]).any(axis=1) & (part[1:] == part[:-1])
        deep = np.logical_or.reduceat(differs, starts)
        for a, b in zip(starts[deep].tolist(), ends[deep].tolist(), strict=True):
            group = order[a:b]
            trie = BlindTrie([row.tobytes() for row in rows[group, 8 * shallow :]])
            for number in range(b - a):
                trie.add(number)
            order[a:b] = group[trie.ordered()]
    shared = np.zeros(len(order), np.int64)
    step = 1 << 15
    for a in range(1, len(order), step):
        some = order[a : a + step]
        apart = rows[some] != rows[order[a - 1 : a - 1 + len(some)]]
        shared[a : a + len(some)] = np.where(apart.any(axis=1), apart.argmax(axis=1), rows.shape[1])
    return order, shared
