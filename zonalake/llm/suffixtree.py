"""Suffix trees of number sequences, and the longest common extension of two positions.

The tree is Ukkonen's, built online in linear time. An Euler tour through it, children in order of
their first symbol, meets the leaves in suffix order. The lowest common ancestor of two leaves is the
shallowest node of the tour between them, and that is always one at which the tour turns from a leaf
to the next; so only these nodes are stored, and a sparse table over them answers in constant time.

A sequence of n numbers takes about 500 bytes a number while its tree is built, and 4 * log2(n)
afterwards.
"""

from __future__ import annotations

import numpy as np

END = -1


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Start and end of each node's edge label in `s`, and its children by first symbol (None for a
    leaf). Node 0 is the root; `s` ends with a symbol that stands nowhere else."""
    n = len(s)
    start, stop, link = [0], [0], [0]
    children: list[dict[int, int] | None] = [{}]
    node = edge = length = pending = 0
    for i, symbol in enumerate(s):
        pending += 1
        unlinked = 0
        while pending:
            if not length:
                edge = i
            kids = children[node]
            child = kids.get(s[edge])
            if child is None:
                kids[s[edge]] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                children.append(None)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                begin = start[child]
                size = stop[child] - begin
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                if s[begin + length] == symbol:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                middle = len(start)
                kids[s[edge]] = middle
                start += (begin, i)
                stop += (begin + length, n)
                link += (0, 0)
                children.append({s[begin + length]: child, symbol: middle + 1})
                children.append(None)
                start[child] = begin + length
                if unlinked:
                    link[unlinked] = middle
                unlinked = middle
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return start, stop, children


def euler_tour(s: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order in which the tour meets their leaves, and the string depth of the node at
    which it turns before each leaf."""
    start, stop, children = suffix_tree(s)
    n = len(s)
    suffixes, turns = np.empty(n, np.int64), np.zeros(n, np.int32)
    stack = [(0, 0, True)]  # node, string depth of its parent, whether it is its parent's first child
    at = turn = 0
    while stack:
        node, depth, is_first = stack.pop()
        if not is_first:
            turn = depth
        depth += stop[node] - start[node]
        kids = children[node]
        if kids is None:
            suffixes[at], turns[at] = n - depth, turn
            at += 1
        else:
            inner = [(kids[symbol], depth, False) for symbol in sorted(kids, reverse=True)]
            inner[-1] = (inner[-1][0], depth, True)
            stack += inner
    return suffixes, turns


class Extensions:
    """How far the suffixes at two positions agree; a position may be the sequence's length."""

    def __init__(self, s: list[int]):
        suffixes, turns = euler_tour([*s, END])
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.table = [turns]
        while 2 << (len(self.table) - 1) <= len(turns):
            below, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(below[:-step], below[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For different positions, pairwise."""
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1  # the turns before leaves low..high-1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for at in np.unique(level):
            mine = level == at
            row = self.table[at]
            out[mine] = np.minimum(row[low[mine]], row[high[mine] - (1 << int(at))])
        return out
