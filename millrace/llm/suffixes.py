"""Sorting suffixes deep-shallow, up to a length at which equal ones count as the same string.

To a shallow depth this is multikey quicksort on 8-byte words: all groups that agree so far are divided at once by their
next word. Groups that still hang together then go through a blind trie each, which looks only at the bytes where its
suffixes part, and reads a suffix in full once, against the one leaf that the blind search ends at.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(WORD):
        out = (out << np.uint64(8)) | data[at + k]
    return out


def _groups(*keys: np.ndarray) -> np.ndarray:
    """For rows in order of the keys: the number of the group of equal ones that each is in."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _shallow(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, groups) of those whose first ``depth`` bytes another one has too."""
    left, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for d in range(0, depth, WORD):
        if not len(left):
            break
        word = _words(data, starts[left] + d)
        order = np.lexsort((word, group))
        left, group = left[order], _groups(group[order], word[order])
        many = np.bincount(group, minlength=1)[group] > 1
        left, group = left[many], group[many]
    return left, group


class BlindTrie:
    """A trie over data[start + done : start + length] whose nodes hold only the depth and the bytes at which they branch."""

    __slots__ = ("data", "done", "length", "root")

    def __init__(self, data: bytes, done: int, length: int):
        self.data, self.done, self.length, self.root = data, done, length, None

    def add(self, start: int) -> int:
        """The first suffix equal to this one that was added, itself if there is none."""
        data = self.data
        if self.root is None:
            self.root = start
            return start
        node = self.root
        while not isinstance(node, int):  # blindly: skipped bytes aren't compared
            depth, branches = node
            branch = branches.get(data[start + depth])
            node = next(iter(branches.values())) if branch is None else branch
        if data[start + self.done : start + self.length] == data[node + self.done : node + self.length]:
            return node
        common = self.done
        while data[start + common] == data[node + common]:
            common += 1
        above, place, node = None, 0, self.root
        while not isinstance(node, int) and node[0] < common:
            above, place = node, data[start + node[0]]
            node = node[1][place]
        if not isinstance(node, int) and node[0] == common:
            node[1][data[start + common]] = start
            return start
        leaf = node
        while not isinstance(leaf, int):
            leaf = next(iter(leaf[1].values()))
        fork = (common, {data[leaf + common]: node, data[start + common]: start})
        if above is None:
            self.root = fork
        else:
            above[1][place] = fork
        return start


def classes(data: bytes, starts: np.ndarray, length: int, shallow: int = 64) -> np.ndarray:
    """For each suffix start, a number that equal first ``length`` bytes share; -1 where no other suffix has them."""
    out = np.full(len(starts), -1, np.int64)
    done = min(shallow, length) // WORD * WORD
    left, group = _shallow(np.frombuffer(data, np.uint8), starts, done)
    if not len(left):
        return out
    at = starts[left].tolist()
    leaves = np.empty(len(at), np.int64)
    bounds = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(at)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        trie = BlindTrie(data, done, length)
        for k in range(a, b):
            leaves[k] = trie.add(at[k])
    number = np.unique(leaves, return_inverse=True)[1]
    out[left] = np.where(np.bincount(number)[number] > 1, number, -1)
    return out
