"""Burrows-Wheeler transforms of sets of strings, and their merge by refining one interleave.

A transform lists, for all suffixes of its strings in order, the byte before each; a string's end is a
symbol of its own below all bytes, ends in the order of their strings, strings in order of their bytes.
"""

from __future__ import annotations

import numpy as np

END = 0  # symbols are bytes + 1


def transform(strings: list[bytes]) -> np.ndarray:
    """Symbols (int16) before each suffix in order; the strings are distinct and sorted."""
    size = np.array([len(s) for s in strings], dtype=np.int64)
    first = np.r_[0, np.cumsum(size + 1)]
    text = np.zeros(first[-1], dtype=np.int64)
    ends = first[1:] - 1
    inside = np.ones(len(text), dtype=bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + len(strings)
    text[ends] = np.arange(len(strings))  # each end is a symbol of its own
    rank, step, left = text, 1, np.arange(len(text))
    # doubled contexts: only suffixes that still share theirs with another are sorted again
    order = np.argsort(rank, kind="stable")
    while True:
        value = rank[order]
        new = np.r_[True, value[1:] != value[:-1]]
        place = np.maximum.accumulate(np.where(new, left, 0))
        named = np.empty_like(rank)
        named[order] = place  # the place of the first of its equals
        rank = named
        single = new & np.r_[new[1:], True]
        if single.all():
            break
        rest = np.flatnonzero(~single)
        own = order[rest]
        # a suffix with an equal is longer than ``step``, so the one ``step`` further on exists
        key = rank[own] * np.int64(len(text)) + rank[own + step]
        order[rest] = own[np.argsort(key, kind="stable")]
        ahead = np.empty_like(rank)
        ahead[own] = key
        done = order[single]
        ahead[done] = rank[done] * np.int64(len(text))
        rank, step = ahead, 2 * step
    before = np.roll(text, 1)
    before[first[:-1]] = 0
    symbol = np.where(before < len(strings), END, before - len(strings) + 1)
    symbol[first[:-1]] = END
    return symbol[order].astype(np.int16)


def following(symbols: np.ndarray) -> np.ndarray:
    """For each suffix the place of the one that starts a byte later, from the transform alone."""
    return np.argsort(symbols, kind="stable").astype(np.int32)


def starts(symbols: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string number, offset) of each suffix; the end of a string has its length as offset."""
    owner = np.empty(len(symbols), dtype=np.int32)
    offset = np.empty(len(symbols), dtype=np.int32)
    ends = int((symbols == END).sum())
    at, alive, step = after[:ends], np.arange(ends, dtype=np.int32), 0
    while len(alive):
        owner[at], offset[at] = alive, step
        inner = at >= ends  # places below ``ends`` are ends of strings
        at, alive, step = after[at[inner]], alive[inner], step + 1
    return owner, offset


def repeated(transforms: list[np.ndarray], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(string numbers, offsets) per transform: suffixes whose first ``length`` bytes start elsewhere too.

    The transforms are merged by an interleave that starts with all suffixes by their first symbol and is
    refined round by round. In a round, suffixes that were equal up to h symbols are told apart by the place
    that the interleave gave to what follows them h symbols on: as each transform's own suffixes are in order
    already, their keys are sorted runs that a round only merges. h doubles, and one symbol is added where
    the length asks for it. What shares its block with no other has found its place and leaves; so does
    whatever is followed by such a suffix. All suffixes of a block have at least h symbols in common: at
    ``length`` the blocks that are left are the repeated intervals.
    """
    base = np.r_[0, np.cumsum([len(t) for t in transforms])]
    after = [following(t) for t in transforms]
    symbol = np.concatenate([t[a] for t, a in zip(transforms, after)])  # the first symbol of each suffix
    step1 = np.concatenate([a.astype(np.int64) + b for a, b in zip(after, base)]).astype(np.int32)
    block = symbol.astype(np.int32)
    shared = (symbol != END) & (np.bincount(symbol) > 1)[symbol]
    step, h = step1, 1

    def refine(head: np.ndarray, head_in: np.ndarray, tail: np.ndarray, tail_in: np.ndarray, jump: np.ndarray):
        spot = np.flatnonzero(head_in & tail_in[jump])
        merged, still = np.zeros(len(head), dtype=np.int32), np.zeros(len(head), dtype=bool)
        if len(spot):
            follow = tail[jump[spot]]
            key = head[spot] * np.int64(int(follow.max()) + 1) + follow
            order = np.argsort(key, kind="stable")  # merges the runs of the transforms
            value = key[order]
            new = np.r_[True, value[1:] != value[:-1]]
            number = np.cumsum(new, dtype=np.int32) - np.int32(1)
            many = ~(new & np.r_[new[1:], True])
            merged[spot[order]] = number
            still[spot[order[many]]] = True
        return merged, still

    first_block, first_shared = block, shared
    for bit in bin(length)[3:]:
        block, shared = refine(block, shared, block, shared, step)
        step, h = step[step], 2 * h
        if bit == "1":
            block, shared = refine(first_block, first_shared, block, shared, step1)
            step, h = step1[step], h + 1
        if not shared.any():
            break
    found = []
    for t, a, low, high in zip(transforms, after, base, base[1:]):
        spot = np.flatnonzero(shared[low:high])
        owner, offset = starts(t, a) if len(spot) else (np.empty(0, np.int32),) * 2
        found.append((owner[spot], offset[spot]))
    return found
