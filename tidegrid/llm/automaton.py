"""Minimal acyclic automata over sorted words, as arrays, and their search with one error."""

from __future__ import annotations

import numpy as np

_SHIFT = np.int64(1 << 21)  # labels are code points, or numbers below this


def coded(words: list[str], lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of ``words`` behind the label ``lead`` of each, padded with 0; and lengths with it."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(size.max(initial=0)) + 1), np.uint32)
    out[:, 0] = lead
    row = np.repeat(np.arange(len(words)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + 1] = flat
    return out, size + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Automaton:
    """The minimal automaton of distinct sorted rows of labels, with the number of each row.

    States are classes of equal continuations, found from the leaves upwards by a hash of
    whether a word ends and of all edges; every member of a class is then held against the
    first one. ``skip`` of an edge is how many rows come before those behind it, so the
    sum along a path is the row's number.
    """

    def __init__(self, labels: np.ndarray, size: np.ndarray) -> None:
        n, width = labels.shape
        same = np.full(n, -1, np.int64)  # labels shared with the row before
        if n > 1:
            same[1:] = np.minimum(np.logical_and.accumulate(labels[1:] == labels[:-1], axis=1).sum(axis=1), size[:-1])
        starts, parents = [], [np.zeros(1, np.int64)]
        for depth in range(width + 1):
            starts.append(np.flatnonzero((same < depth) & (size >= depth)))
            if depth:
                parents.append(np.searchsorted(starts[depth - 1], starts[depth], side="right") - 1)
        if n == 0:
            starts[0] = np.zeros(1, np.int64)
        base = np.cumsum([0, *map(len, starts)])
        hashes: list[np.ndarray] = [np.empty(0, np.uint64)] * (width + 1)
        ends: list[np.ndarray] = [np.empty(0, bool)] * (width + 1)
        for depth in range(width, -1, -1):
            at = starts[depth]
            ends[depth] = size[at] == depth if n else np.zeros(1, bool)
            total = np.where(ends[depth], np.uint64(0x9E3779B97F4A7C15), np.uint64(1))
            if depth < width and len(starts[depth + 1]):
                below = _mixed(hashes[depth + 1] + _mixed(labels[starts[depth + 1], depth].astype(np.uint64)))
                np.add.at(total, parents[depth + 1], below)
            hashes[depth] = _mixed(total)
        _, first, state = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        final = np.concatenate(ends)
        # all edges of the trie, in the order of their parents and labels
        of = np.concatenate([base[d] + parents[d + 1] for d in range(width)]) if width else np.empty(0, np.int64)
        to = np.concatenate([base[d + 1] + np.arange(len(starts[d + 1])) for d in range(width)]) if width else np.empty(0, np.int64)
        label = np.concatenate([labels[starts[d + 1], d] for d in range(width)]).astype(np.int64) if width else np.empty(0, np.int64)
        row = np.concatenate(starts)
        skip = row[to] - row[of]
        count = np.bincount(of, minlength=base[-1])
        begin = np.cumsum(count) - count
        twin = first[state[of]]
        place = np.arange(len(of)) - begin[of] + begin[twin]
        equal = (count == count[first[state]]).all() and (final == final[first[state]]).all()
        if not equal or (label != label[place]).any() or (state[to] != state[to[place]]).any() or (skip != skip[place]).any():
            raise ArithmeticError("two states of different continuations have one hash")
        kept = np.flatnonzero(twin == of)
        kept = kept[np.lexsort((label[kept], state[of[kept]]))]
        self.root, self.final = state[0], final[first]
        self.key, self.target, self.skip = state[of[kept]] * _SHIFT + label[kept], state[to[kept]], skip[kept]
        self.end = np.searchsorted(self.key, (np.arange(len(first)) + 1) * _SHIFT)

    def edge(self, state: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The edge that leads on from each state, and whether there is one."""
        wanted = state * _SHIFT + label
        at = np.minimum(np.searchsorted(self.key, wanted), max(len(self.key) - 1, 0))
        return at, self.key[at] == wanted if len(self.key) else np.zeros(len(wanted), bool)

    def one_error(self, labels: np.ndarray, size: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and the number of a row: ``exact`` labels match, and one error completes it.

        The error is a label of the query that is left out, or one that a larger label
        stands for; the other direction of each is found from the other row.
        """
        n, width = labels.shape
        labels = labels.astype(np.int64)
        state, number = np.full(n, self.root), np.zeros(n, np.int64)
        alive = np.arange(n)
        found: list[tuple[np.ndarray, ...]] = []  # query, next place, state, number
        for i in range(width):
            alive = alive[size[alive] > i]
            at, there = self.edge(state[alive], labels[alive, i])
            open_ = alive[exact[alive] <= i]
            found.append((open_, np.full(len(open_), i + 1), state[open_], number[open_]))
            # the edges after the query's own, or after where it would be
            after = at + (self.key[at] <= state[alive] * _SHIFT + labels[alive, i]) if len(self.key) else at
            many = np.where(exact[alive] <= i, np.maximum(self.end[state[alive]] - after, 0), 0)
            q = np.repeat(alive, many)
            e = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - after, many)
            found.append((q, np.full(len(q), i + 1), self.target[e], number[q] + self.skip[e]))
            alive, at = alive[there], at[there]
            number[alive] += self.skip[at]
            state[alive] = self.target[at]
        q, place, state, number = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 4
        out = []
        while len(q):
            over = place == size[q]
            hit = over & self.final[state]
            out.append(q[hit] * _SHIFT * 8 + number[hit])
            q, place, state, number = (x[~over] for x in (q, place, state, number))
            at, there = self.edge(state, labels[q, place])
            q, place, at, number = q[there], place[there] + 1, at[there], number[there]
            state, number = self.target[at], number + self.skip[at]
        pairs = np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)
        return pairs // (_SHIFT * 8), pairs % (_SHIFT * 8)
