"""Lattices of words over a piece table: expected piece counts and best cuts, for many words of one length at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Longest piece in characters.
MAX_PIECE = 16
# Fixed value: how far below the rarest piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
# Cells of the tables that are held at a time.
CELLS = 1 << 21
# More than there are code points.
CODES = 0x110000
# Cells of the plain table of a tree.
DENSE = 1 << 22
# Likelihoods are added as such while no cut can fall below e to the minus this; longer words take logarithms.
RANGE = 600.0


class Keys:
    """Places of whole numbers in a list of different ones, by a table of slots that is a quarter full at most."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)  # the key of each slot
        self.places = np.full(1 << self.bits, -1, np.int64)
        left, at = np.arange(len(keys)), self._first(keys)
        while len(left):
            free = self.places[at] < 0
            self.places[at[free]] = left[free]
            beaten = self.places[at] != left
            won = ~beaten
            self.slots[at[won]] = keys[left[won]]
            left, at = left[beaten], (at[beaten] + 1) & (len(self.slots) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is not listed."""
        at = self._first(keys)
        there = self.slots[at]
        found = np.where(there == keys, self.places[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            there = self.slots[at[left]]
            hit = there == keys[left]
            found[left[hit]] = self.places[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return found


class Tree:
    """Nodes found by the node before and a letter: by a plain table for the first ones, by slots for the others."""

    def __init__(self, keys: np.ndarray):
        low = int(np.searchsorted(keys, DENSE))
        self.near = np.full(min(DENSE, int(keys[-1]) + 1) if len(keys) else 0, -1, np.int32)
        self.near[keys[:low]] = np.arange(low)
        self.first, self.far = low, Keys(keys[low:])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among the sorted keys, -1 where it is not listed."""
        if not len(keys) or keys.max() < len(self.near):
            return self.near[keys]
        found, far = np.full(len(keys), -1, np.int64), keys >= len(self.near)
        near = np.flatnonzero(~far)
        found[near] = self.near[keys[near]]
        if len(self.far.keys):
            far = np.flatnonzero(far)
            places = self.far.find(keys[far])
            found[far] = np.where(places < 0, -1, places + self.first)
        return found


class Pieces:
    """Pieces with their scores, and the edges they make in words."""

    def __init__(self, pieces: Sequence[str], scores: Sequence[float]):
        self.number = {p: i for i, p in enumerate(pieces)}
        known = np.asarray(scores, dtype=float)
        unknown = (known.min() if len(known) else 0.0) - UNKNOWN_PENALTY
        # The last two: a character that is no piece, and a longer part that is none.
        self.scores = np.concatenate([known, [unknown, -np.inf]])
        self.shares, self.widest = np.exp(self.scores), np.abs(self.scores[:-1]).max()
        self._grow([p for p in self.number if 0 < len(p) <= MAX_PIECE])

    def _grow(self, pieces: list[str]) -> None:
        """The tree of the beginnings of the pieces: a node is found by the one before it and a letter; nodes are numbered depth by depth."""
        codes, starts, lengths = _spelled(pieces)
        used = np.unique(codes)
        # Letters are the numbers of the characters that pieces have, 0 is any other.
        self.letter = np.zeros(CODES, np.int32)
        self.letter[used] = np.arange(1, len(used) + 1)
        self.letters = len(used) + 1
        numbers = np.fromiter((self.number[p] for p in pieces), dtype=np.int64, count=len(pieces))
        letters = self.letter[codes]
        node, keys, nodes, ends = np.zeros(len(pieces), np.int64), [np.zeros(0, np.int64)], 1, [np.zeros(0, np.int64)]
        for depth in range(1, MAX_PIECE + 1):
            long = np.flatnonzero(lengths >= depth)
            if not len(long):
                break
            new, place = np.unique(node[long] * self.letters + letters[starts[long] + depth - 1], return_inverse=True)
            node[long] = nodes + place
            piece = np.full(len(new), -1, np.int64)
            whole = lengths == depth
            piece[node[whole] - nodes] = numbers[whole]
            keys.append(new)
            ends.append(piece)
            nodes += len(new)
        self.tree, self.piece = Tree(np.concatenate(keys)), np.concatenate(ends)

    def batches(self, words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``words``, letters by character and word) of words of one length, as many as the tables may hold."""
        codes, starts, lengths = _spelled(words)
        letters = self.letter[codes]
        order = np.argsort(lengths, kind="stable")
        for size in np.unique(lengths[lengths > 0]):
            same = order[np.searchsorted(lengths[order], size) : np.searchsorted(lengths[order], size, side="right")]
            many = max(1, CELLS // (int(size) * MAX_PIECE))
            for at in range(0, len(same), many):
                some = same[at : at + many]
                yield some, letters[starts[some] + np.arange(size)[:, None]]

    def edges(self, words: Sequence[str], size: int, whole: bool = True) -> list[np.ndarray]:
        """For every end from 1 the pieces that stop there, the shortest first: one column each. ``whole`` admits the word itself."""
        return self.columns(self.letter[_spelled(words)[0]].reshape(len(words), size).T, whole)

    def columns(self, letters: np.ndarray, whole: bool = True) -> list[np.ndarray]:
        k, (size, many) = len(self.number), letters.shape
        cells, pieces = self.cells(letters, whole)
        table = filled(size, many, k + 1, k, cells, pieces)
        return [table[end - 1, max(0, table.shape[1] - end) :][::-1].T for end in range(1, size + 1)]

    def cells(self, letters: np.ndarray, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The edges of words of one length: where each lies in a table as ``filled`` makes it, and its piece."""
        size, many = letters.shape
        longest = min(size, MAX_PIECE)
        letters, row = np.ascontiguousarray(letters).ravel(), longest * many
        begin = np.arange(size * many)  # first character and word
        cell, node, found = begin + begin // many * (row - many), 0, []
        for length in range(1, longest + 1):
            place = self.tree.find(node * self.letters + letters[begin + (length - 1) * many])
            live = np.flatnonzero(place >= 0)
            begin, cell, place = begin[live], cell[live], place[live].astype(np.int64)
            piece = self.piece[place]
            if length == size and not whole and size > 1:
                piece[:] = -1
            known = np.flatnonzero(piece >= 0)
            found.append((cell[known] + (length - 1) * row + (longest - length) * many, piece[known]))
            live = np.flatnonzero(begin < (size - length) * many)
            begin, cell, node = begin[live], cell[live], place[live] + 1
            if not len(begin):
                break
        return np.concatenate([c for c, _ in found]), np.concatenate([p for _, p in found])


def filled(size: int, many: int, nothing: float, unknown: float, cells: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A table by end, length (the longest that any end may have first) and word, so that what an end needs lies together."""
    table = np.full((size, min(size, MAX_PIECE), many), nothing, dtype=values.dtype)
    table[:, -1] = unknown
    table.reshape(-1)[cells] = values
    return table


def _spelled(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all words in one row, where each word starts, and how long it is."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4"), np.cumsum(lengths) - lengths, lengths


def _log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(values - safe[:, None]).sum(axis=1))


def _likely(share: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likelihood of every word, and the expected use of every edge of ``share``, the likelihoods of the edges, which it takes for its result."""
    size, longest, many = share.shape
    ahead = np.zeros((size + 1, many))
    ahead[0] = 1
    for end in range(1, size + 1):
        n = min(end, longest)
        ahead[end] = (ahead[end - n : end] * share[end - 1, longest - n :]).sum(axis=0)
    behind = np.zeros((size + 1, many))
    behind[size] = weights / ahead[size]
    for end in range(size, 0, -1):
        n = min(end, longest)
        through = share[end - 1, longest - n :]
        through *= behind[end]
        behind[end - n : end] += through
        through *= ahead[end - n : end]
    return ahead[size], share


def expected_counts(table: Pieces, words: Sequence[str], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Log likelihood of the words over all their cuts, and the expected use of every piece."""
    counts, likelihood = np.zeros(len(table.scores)), 0.0
    for at, letters in table.batches(words):
        size = len(letters)
        if size * table.widest < RANGE:
            cells, pieces = table.cells(letters)
            share = filled(size, len(at), 0.0, table.shares[-2], cells, table.shares[pieces])
            total, used = _likely(share, weights[at])
            counts += np.bincount(pieces, weights=used.reshape(-1)[cells], minlength=len(counts))
            likelihood += float((np.log(total) * weights[at]).sum())
            continue
        edges = table.columns(letters)
        score = [table.scores[e] for e in edges]
        ahead = np.full((len(at), size + 1), -np.inf)
        ahead[:, 0] = 0
        for end in range(1, size + 1):
            back = ahead[:, max(0, end - MAX_PIECE) : end][:, ::-1]
            ahead[:, end] = _log_sum(back + score[end - 1])
        behind = np.full((len(at), size + 1), -np.inf)
        behind[:, size] = 0
        total = ahead[:, size]
        for end in range(size, 0, -1):
            lo = max(0, end - MAX_PIECE)
            through = score[end - 1] + behind[:, end, None]
            behind[:, lo:end] = np.logaddexp(behind[:, lo:end], through[:, ::-1])
            share = np.exp(ahead[:, lo:end][:, ::-1] + through - total[:, None]) * weights[at][:, None]
            counts += np.bincount(edges[end - 1].ravel(), weights=share.ravel(), minlength=len(counts))
        likelihood += float((total * weights[at]).sum())
    return likelihood, counts[:-2]


def best_paths(table: Pieces, words: Sequence[str], whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Most probable cuts of the words, one after the other: all piece numbers (that of no piece for an unknown character), how many each word has, and the scores.

    Of equal cuts the one with the longer last piece is taken. ``whole=False`` bars the word itself.
    """
    sizes, scores, found = np.zeros(len(words), np.int64), np.zeros(len(words)), []
    for at, letters in table.batches(words):
        (size, many), k = letters.shape, len(table.number)
        longest = min(size, MAX_PIECE)
        cells, pieces = table.cells(letters, whole)
        edges = filled(size, many, k + 1, k, cells, pieces)
        score = filled(size, many, -np.inf, table.scores[k], cells, table.scores[pieces])
        reach = np.full((longest + size + 1, many), -np.inf)  # nothing is reached before the first character
        reach[longest] = 0
        for end in range(1, size + 1):
            reach[longest + end] = (reach[end : end + longest] + score[end - 1]).max(axis=0)
        scores[at] = reach[longest + size]
        live, ends, step = np.arange(many), np.full(many, size), 0
        lengths = np.arange(longest)[:, None]
        while len(live):
            value = reach[ends + lengths, live] + score[ends - 1, lengths, live]
            best = value.argmax(axis=0)  # the longest first
            found.append((at[live], np.full(len(live), step), edges[ends - 1, best, live]))
            ends -= longest - best
            step += 1
            sizes[at[live[ends == 0]]] = step
            live, ends = live[ends > 0], ends[ends > 0]
    flat = np.zeros(sizes.sum(), np.int64)
    last = np.cumsum(sizes) - 1
    for word, step, piece in found:
        flat[last[word] - step] = piece
    return flat, sizes, scores


def best_cuts(table: Pieces, words: Sequence[str], whole: bool = True) -> tuple[list[list[int]], np.ndarray]:
    """``best_paths`` as a list of piece numbers a word, and the scores."""
    flat, sizes, scores = best_paths(table, words, whole)
    return [part.tolist() for part in np.split(flat, np.cumsum(sizes)[:-1])] if len(sizes) else [], scores
