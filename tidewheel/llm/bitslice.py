"""Hamming links by bit planes: numpy only, no Spark.

Lane i of a plane is bit i % 64 of word i // 64. A plane holds one bit position of many
fingerprints, so an operation on a word advances 64 distances at once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def planes(values: np.ndarray) -> np.ndarray:
    """The 64 bit planes of uint64 values, as words: shape (64, ceil(n / 64))."""
    n = len(values)
    padded = np.zeros(-(-n // 64) * 64, "<u8")
    padded[:n] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def pack(mask: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(mask) // 64) * 64, bool)
    padded[: len(mask)] = mask
    return np.packbits(padded, bitorder="little").view("<u8")


def unpack(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), bitorder="little").view(bool)


def _over(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above radius."""
    more, same = np.zeros_like(counters[0]), np.full_like(counters[0], FULL)
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            same &= counters[j]
        else:
            more |= same & counters[j]
            same &= ~counters[j]
    return more


def near(difference: Callable[[int, np.ndarray], np.ndarray], active: np.ndarray, radius: int) -> np.ndarray:
    """Words of lanes, out of ``active``, whose distance is at most radius.

    difference(bit, words) gives the differing lanes of one plane at those words. Two planes
    and the lowest counter go through a carry-save adder; its carry ripples up. Every eight
    planes the words in which all lanes exceed the radius are abandoned.
    """
    out = np.zeros_like(active)
    at = np.flatnonzero(active)
    dead = ~active[at]
    counters = [np.zeros(len(at), "<u8") for _ in range(max(radius.bit_length(), 1))]
    for bit in range(0, 64, 2):
        a, b = difference(bit, at), difference(bit + 1, at)
        u = counters[0] ^ a
        carry = counters[0] & a | u & b
        counters[0] = u ^ b
        for j in range(1, len(counters)):
            counters[j], carry = counters[j] ^ carry, counters[j] & carry
        dead |= carry
        if bit % 8 == 6:
            dead |= _over(counters, radius)
            keep = dead != FULL
            if not keep.all():
                at, dead, counters = at[keep], dead[keep], [c[keep] for c in counters]
                if not len(at):
                    return out
    out[at] = ~(dead | _over(counters, radius))
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that edges a-b connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_in_short_runs(values: np.ndarray, run: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows inside runs of equal ``run``, each at most 64 rows long: row i against i+1, i+2, ..."""
    n = len(values)
    p, left, right = planes(values), [], []
    after = np.concatenate([p[:, 1:], np.zeros((64, 1), "<u8")], axis=1)
    for s in range(1, min(64, n)):
        together = np.zeros(n, bool)
        together[: n - s] = run[: n - s] == run[s:]
        if not together.any():
            break
        down, up = np.uint64(s), np.uint64(64 - s)
        hit = near(lambda bit, at: p[bit, at] ^ (p[bit, at] >> down | after[bit, at] << up), pack(together), radius)  # noqa: B023
        i = np.flatnonzero(unpack(hit))
        left.append(i)
        right.append(i + s)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the edges a-b (a < b) of a spanning forest: each round every open component takes an edge to one with a lesser label."""
    label, chosen, left = np.arange(n), [np.zeros(0, np.int64)], np.arange(len(a))
    while len(left):
        x, y = label[a[left]], label[b[left]]
        open_ = x != y
        left, high = left[open_], np.maximum(x, y)[open_]
        chosen.append(left[np.unique(high, return_index=True)[1]])
        at = np.concatenate(chosen)
        label = forest(n, a[at], b[at])
    return np.concatenate(chosen)


def block_hits(ask: np.ndarray, p: np.ndarray, active: np.ndarray, radius: int) -> np.ndarray:
    """For each value asked, the words of rows (planes p) out of ``active`` within the radius: shape (asked, words)."""
    words = p.shape[1]
    bits = np.where(ask[:, None] >> np.arange(64, dtype="<u8") & np.uint64(1), FULL, np.uint64(0))
    return near(lambda bit, at: p[bit, at % words] ^ bits[at // words, bit], np.tile(active, len(ask)), radius).reshape(len(ask), words)


def tree_of_block(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(component, parent) of each row of one block, both rows: the least of its component, and a row within the radius on the way there.

    Breadth-first search, 64 rows against the unvisited ones at a time. Least rows are their own parents.
    """
    n = len(values)
    p = planes(values)
    todo, label, parent = np.ones(n, bool), np.full(n, -1), np.arange(n)
    while todo.any():
        root = int(np.argmax(todo))
        todo[root] = False
        label[root] = root
        front = [root]
        while front and todo.any():
            ask, front = np.array(front[:64]), front[64:]
            hit = block_hits(values[ask], p, pack(todo), radius)
            found = np.flatnonzero(unpack(np.bitwise_or.reduce(hit, axis=0))[:n])
            if not len(found):
                continue
            first = (hit[:, found // 64] >> (found % 64).astype("<u8") & np.uint64(1)).argmax(axis=0)
            todo[found] = False
            label[found] = root
            parent[found] = ask[first]
            front += found.tolist()
    return label, parent


def forest_of_block(values: np.ndarray, radius: int) -> np.ndarray:
    """Component (least row) of each row of one block."""
    return tree_of_block(values, radius)[0]
