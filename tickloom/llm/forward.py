"""The scaled forward and backward recursions of hidden Markov models, over many sequences at once.

Sequences are cut into chunks of CHUNK tokens at most, which step through time
side by side. Where a sequence has several chunks, the products of their step
matrices tell first what enters each chunk at either end; so a sequence may be
of any length, and the recursion stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 2048
#: Tokens that are worked on at once.
AT_ONCE = 1 << 19
#: Steps of a product before it is scaled again; chances of 1e-15 stay far above the least double.
RESCALE = 16


class Chunks:
    """The chunks of sequences that lie one after the other, in order."""

    def __init__(self, lengths: np.ndarray, chunk: int = CHUNK):
        each = -(-lengths // chunk)
        starts = np.cumsum(lengths) - lengths
        self.n = int(each.sum())
        self.doc = np.repeat(np.arange(len(lengths)), each)
        self.nth = np.arange(self.n) - np.repeat(np.cumsum(each) - each, each)
        self.begin = starts[self.doc] + self.nth * chunk
        self.size = np.minimum(lengths[self.doc] - self.nth * chunk, chunk)
        self.last = self.nth == each[self.doc] - 1
        self.many = each[self.doc] > 1

    def groups(self, own: np.ndarray) -> Iterator[np.ndarray]:
        """``own`` chunks in groups of AT_ONCE tokens, about."""
        if len(own):
            ends = np.cumsum(self.size[own])
            yield from (g for g in np.split(own, np.searchsorted(ends, np.arange(AT_ONCE, ends[-1], AT_ONCE))) if len(g))


class Packed:
    """Chunks sorted by falling size, their tokens by time: step t is ``rows(t)``, the first ``wide[t]`` chunks."""

    def __init__(self, chunks: Chunks, own: np.ndarray):
        self.own = own[np.argsort(-chunks.size[own], kind="stable")]
        size = chunks.size[self.own]
        self.wide = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
        self.at = np.append(0, np.cumsum(self.wide))
        when = np.repeat(np.arange(len(self.wide)), self.wide)
        self.places = chunks.begin[self.own][np.arange(self.at[-1]) - self.at[when]] + when

    def rows(self, t: int) -> slice:
        return slice(self.at[t], self.at[t + 1])


def products(packed: Packed, chances: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each chunk's product of step matrices, up to a factor. ``first`` chunks begin with the chances alone, others with a move."""
    k = len(moves)
    start = np.where(first[:, None, None], np.eye(k), moves)
    made = start * chances[packed.rows(0)][:, None, :]
    for t in range(1, len(packed.wide)):
        n = packed.wide[t]
        step = (made[:n].reshape(-1, k) @ moves).reshape(n, k, k) * chances[packed.rows(t)][:, None, :]
        made[:n] = step if t % RESCALE else step / step.max(axis=(1, 2), keepdims=True)
    return made / made.max(axis=(1, 2), keepdims=True)


def forward(packed: Packed, chances: np.ndarray, moves: np.ndarray, enters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(states, scales) of every token: the scaled forward vector, and the factor by which it was divided."""
    states, scales, ones = np.empty_like(chances), np.empty(len(chances)), np.ones(len(moves))
    ahead = enters
    for t in range(len(packed.wide)):
        own = packed.rows(t)
        now = ahead[: packed.wide[t]] * chances[own]
        scale = now @ ones
        now /= scale[:, None]
        states[own], scales[own] = now, scale
        if t + 1 < len(packed.wide):
            ahead = now[: packed.wide[t + 1]] @ moves
    return states, scales


def backward(packed: Packed, chances: np.ndarray, scales: np.ndarray, moves: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(after, through): the scaled backward vector of every token, and chances * after / scale, what the token before multiplies its moves with."""
    after, through = np.empty_like(chances), np.empty_like(chances)
    for t in reversed(range(len(packed.wide))):
        own = packed.rows(t)
        now = after[own]
        on = packed.wide[t + 1] if t + 1 < len(packed.wide) else 0
        now[on:] = leaves[on : packed.wide[t]]
        if on:
            now[:on] = through[packed.rows(t + 1)] @ moves.T
        through[own] = chances[own] * now / scales[own][:, None]
    return after, through


def ends(tokens: np.ndarray, table: np.ndarray, chunks: Chunks, begins: np.ndarray, moves: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(enters, left, leaves) of each chunk: the states' chances before its first token, the forward vector at its end, and the backward one there (up to a factor; only if ``both``)."""
    k = len(moves)
    enters, left, leaves = np.tile(begins, (chunks.n, 1)), np.full((chunks.n, k), np.nan), np.ones((chunks.n, k))
    many = np.flatnonzero(chunks.many)
    made = np.empty((len(many), k, k))
    for group in chunks.groups(many):
        packed = Packed(chunks, group)
        made[np.searchsorted(many, packed.own)] = products(packed, table[tokens[packed.places]], moves, chunks.nth[packed.own] == 0)
    order = np.argsort(chunks.nth[many], kind="stable")
    turns = np.split(order, np.cumsum(np.bincount(chunks.nth[many]))[:-1]) if len(many) else []
    for nth, turn in enumerate(turns):
        own = many[turn]
        before = left[own - 1] if nth else np.tile(begins, (len(own), 1))
        if nth:
            enters[own] = before @ moves
        now = np.einsum("nk,nkj->nj", before, made[turn])
        left[own] = now / now.sum(axis=1, keepdims=True)
    for nth, turn in reversed(list(enumerate(turns))):
        if both and nth:
            own = many[turn]
            now = np.einsum("nkj,nj->nk", made[turn], leaves[own])
            leaves[own - 1] = now / now.sum(axis=1, keepdims=True)
    return enters, left, leaves


def likelihoods(tokens: np.ndarray, lengths: np.ndarray, table: np.ndarray, begins: np.ndarray, moves: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The natural log-likelihood of every sequence. ``table`` has a row of the states' chances for each token."""
    chunks = Chunks(lengths, chunk)
    enters, _, _ = ends(tokens, table, chunks, begins, moves, False)
    found = np.zeros(len(lengths))
    for group in chunks.groups(np.arange(chunks.n)):
        packed = Packed(chunks, group)
        _, scales = forward(packed, table[tokens[packed.places]], moves, enters[packed.own])
        logs = np.log(scales)
        sums = np.zeros(len(group))
        for t in range(len(packed.wide)):
            sums[: packed.wide[t]] += logs[packed.rows(t)]
        np.add.at(found, chunks.doc[packed.own], sums)
    return found


def counts(tokens: np.ndarray, lengths: np.ndarray, table: np.ndarray, begins: np.ndarray, moves: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected (emissions by token, first states, moves) over all sequences."""
    k = len(moves)
    emitted, started, moved = np.zeros_like(table), np.zeros(k), np.zeros((k, k))
    chunks = Chunks(lengths, chunk)
    enters, left, leaves = ends(tokens, table, chunks, begins, moves, True)
    for group in chunks.groups(np.arange(chunks.n)):
        packed = Packed(chunks, group)
        own = tokens[packed.places]
        chances = table[own]
        states, scales = forward(packed, chances, moves, enters[packed.own])
        # At a chunk's end the two vectors' product is one.
        last = states[packed.at[chunks.size[packed.own] - 1] + np.arange(len(packed.own))]
        leave = leaves[packed.own]
        leave = leave / (last * leave).sum(axis=1, keepdims=True)
        after, through = backward(packed, chances, scales, moves, leave)
        here = states * after
        for j in range(k):
            emitted[:, j] += np.bincount(own, weights=here[:, j], minlength=len(table))
        first = chunks.nth[packed.own] == 0
        started += here[packed.rows(0)][first].sum(axis=0)
        for t in range(1, len(packed.wide)):
            moved += states[packed.at[t - 1] : packed.at[t - 1] + packed.wide[t]].T @ through[packed.rows(t)]
        crossing = np.flatnonzero(~first)
        moved += left[packed.own[crossing] - 1].T @ through[packed.rows(0)][crossing]
    return emitted, started, moved * moves
