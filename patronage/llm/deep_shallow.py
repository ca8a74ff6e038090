"""Deep-shallow sorting of byte strings, with longest common prefixes.

Shallow: a multikey sort by 8-byte symbols; each round orders the strings that
are still tied by their next symbol, all tied groups at once, down to a fixed
depth. Deep: each group tied at that depth goes into a blind trie, which holds
only where strings branch. A string is led down by its branching symbols
alone, compared once with the string that it ends at, and put in at the true
common prefix; so a long prefix shared by a group is compared once per
string. Walking the trie in order gives the order and the common prefixes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

SHALLOW = 64  # bytes, a multiple of 8
_END = -1     # the symbol after a string's last byte, before all others


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Node:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int, kids: dict):
        self.depth, self.kids = depth, kids


class BlindTrie:
    """Strings by number. A leaf is the list of numbers of equal strings."""

    def __init__(self, strings: Sequence[bytes]):
        self.strings, self.root = strings, None

    def insert(self, number: int) -> None:
        s = self.strings[number]
        if self.root is None:
            self.root = [number]
            return
        path, node = [], self.root
        while isinstance(node, _Node):
            symbol = s[node.depth] if node.depth < len(s) else _END
            path.append(node)
            node = node.kids.get(symbol)
            if node is None:
                node = next(iter(path[-1].kids.values()))
        other = self.strings[node[0]]
        shared = common_prefix(s, other)
        if shared == len(s) == len(other):
            node.append(number)
            return
        mine = s[shared] if shared < len(s) else _END
        theirs = other[shared] if shared < len(other) else _END
        at = next((i for i, x in enumerate(path) if x.depth >= shared), len(path))
        if at < len(path) and path[at].depth == shared:
            path[at].kids[mine] = [number]
            return
        below = path[at] if at < len(path) else node
        made = _Node(shared, {theirs: below, mine: [number]})
        if at == 0:
            self.root = made
        else:
            up = path[at - 1]
            up.kids[s[up.depth] if up.depth < len(s) else _END] = made

    def walk(self) -> tuple[list[int], list[int]]:
        """Numbers in order, and each one's common prefix with the one before
        (the first has 0)."""
        order, shared, stack = [], [], [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            if isinstance(node, _Node):
                kids = [node.kids[k] for k in sorted(node.kids)]
                stack += [(kid, node.depth) for kid in kids[:0:-1]]
                stack.append((kids[0], depth))
            else:
                whole = len(self.strings[node[0]])
                order += node
                shared += [depth, *[whole] * (len(node) - 1)]
        return order, shared


def deep_shallow(strings: Sequence[bytes], groups: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by (group, bytes), and for each place the common
    prefix with the place before (0 at a group's start)."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.frombuffer(b"".join([s[:shallow].ljust(shallow, b"\0") for s in strings]), np.uint8).reshape(n, shallow)
    symbols = heads.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    tied = np.flatnonzero(_in_runs(groups[order]))
    run = np.cumsum(np.r_[False, groups[order][1:] != groups[order][:-1]])
    for k in range(shallow // 8):
        if not len(tied):
            break
        some = order[tied]
        by = np.lexsort((symbols[some, k], run[tied]))
        order[tied] = some[by]
        word, of = symbols[order[tied], k], run[tied]
        first = np.r_[True, (word[1:] != word[:-1]) | (of[1:] != of[:-1])]
        run[tied] = tied[np.maximum.accumulate(np.where(first, np.arange(len(tied)), 0))]
        tied = tied[_in_runs(run[tied])]
    deep: list[tuple[int, list[int]]] = []
    cuts = np.flatnonzero(np.r_[True, run[tied][1:] != run[tied][:-1]]) if len(tied) else tied
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(tied)], strict=False):
        place, trie = int(tied[lo]), BlindTrie(strings)
        for number in order[place:place + hi - lo].tolist():
            trie.insert(number)
        numbers, shared = trie.walk()
        order[place:place + hi - lo] = numbers
        deep.append((place, shared))
    lengths = np.fromiter(map(len, strings), np.int64, n)
    a, b = order[:-1], order[1:]
    same = heads[a] == heads[b]
    lcp = np.where(same.all(axis=1), shallow, same.argmin(axis=1))
    lcp = np.r_[0, np.where(groups[a] == groups[b], np.minimum(lcp, np.minimum(lengths[a], lengths[b])), 0)]
    for place, shared in deep:
        lcp[place + 1:place + len(shared)] = shared[1:]
    return order, lcp


def _in_runs(x: np.ndarray) -> np.ndarray:
    """Which places have an equal neighbour."""
    if len(x) < 2:
        return np.zeros(len(x), bool)
    same = x[1:] == x[:-1]
    return np.r_[same, False] | np.r_[False, same]
