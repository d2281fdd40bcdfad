"""Re-Pair grammars of many token sequences at once.

In each round every pair that occurs twice or more, and is more frequent than the pairs it overlaps, is replaced by a new
symbol, until no pair occurs twice. All sequences of a batch are worked on together in arrays. A symbol is named by a hash
of the tokens it stands for, so equal text has equal rules in whatever file, batch or task it is found.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# The base of the hashes of texts, and a multiplier that mixes the owner into a pair.
BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
BACK = pow(BASE, -1, 1 << 64)


def powers(n: int, base: int = BASE) -> np.ndarray:
    """``base`` to the power of 0 up to ``n``, in 64 bits."""
    out = np.full(n + 1, base, "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


class Grammar(NamedTuple):
    """The symbols left over, as (hash, owner, first token, tokens), and every use of every rule when it was made, as
    (hash, owner, first token, tokens, tokens of its left part)."""

    symbols: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    uses: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def grammars(tokens: np.ndarray, owner: np.ndarray, together: bool = False) -> Grammar:
    """Compress sequences given as token hashes (uint64) with the owner of each token (ascending).

    Each owner has a grammar of its own, or all have one ``together``; no rule reaches over the end of a sequence.
    """
    sym, own = tokens.astype("u8"), owner.astype("i8")
    begin, length = np.arange(len(sym)), np.ones(len(sym), "i8")
    power = powers(len(sym) + 1)
    mixed = np.zeros(1, "u8") if together else own.astype("u8") * _MIX
    h = sym[:-1] * power[1] + sym[1:]
    uses: list[tuple[np.ndarray, ...]] = []
    while len(sym) >= 2:
        key = h if together else h ^ mixed[:-1]
        # Only keys that share a bucket, told by their first bits, can occur twice; the others need not be sorted.
        bucket = (key >> np.uint64(62 - len(key).bit_length())).view("i8")
        maybe = np.flatnonzero((np.bincount(bucket) >= 2)[bucket])
        _, inverse, count = np.unique(key[maybe], return_inverse=True, return_counts=True)
        often = count[inverse]
        pick = (often >= 2) & (own[maybe + 1] == own[maybe])
        at, of = maybe[pick], inverse[pick]
        n = np.zeros(len(key) + 2, "i8")  # n[i + 1] is the count of pair i, if that occurs twice or more
        n[at + 1] = often[pick]
        # Ranks within the sequence: the count, then the hash, so that equal pairs are treated alike everywhere.
        here, before, after = n[at + 1], n[at], n[at + 2]
        hh, hb, ha = h[at], h[np.maximum(at - 1, 0)], h[np.minimum(at + 1, len(h) - 1)]
        pick = ((here > before) | ((here == before) & (hh >= hb))) & ((here > after) | ((here == after) & (hh >= ha)))
        at, of = at[pick], of[pick]
        if len(at):  # of overlapping picks (a run of one symbol) the first, third, ... stay
            gap = np.diff(at) == 1
            if gap.any():
                start = np.r_[True, ~gap]
                head = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
                stay = (np.arange(len(at)) - head) % 2 == 0
                at, of = at[stay], of[stay]
        at = at[np.bincount(of, minlength=len(count))[of] >= 2]
        if not len(at):
            break
        left = length[at].copy()
        sym, length = sym.copy(), length.copy()
        sym[at], length[at] = h[at], left + length[at + 1]
        uses.append((sym[at], own[at], begin[at], length[at], left))
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, own, begin, length = sym[keep], own[keep], begin[keep], length[keep]
        mixed = mixed if together else mixed[keep]
        # Pairs that hold no new symbol stay as they are.
        h = h[keep[:-1]] if keep[-1] else h[keep[:-1]][:-1]
        new = at - np.arange(len(at))
        new = np.concatenate([new, new - 1])
        new = new[(new >= 0) & (new < len(h))]
        h[new] = sym[new] * power[length[new + 1]] + sym[new + 1]
    kinds = ("u8", "i8", "i8", "i8", "i8")
    joined = tuple(np.concatenate(x) for x in zip(*uses)) if uses else tuple(np.empty(0, t) for t in kinds)
    return Grammar((sym, own, begin, length), joined)


def windows(tokens: np.ndarray, owner: np.ndarray, wanted: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the runs of tokens whose hash is in ``wanted``, given as length to sorted hashes."""
    n = len(tokens)
    found_own, found_hash = [np.empty(0, "i8")], [np.empty(0, "u8")]
    forth = powers(n)
    total = np.r_[np.uint64(0), np.cumsum(tokens * powers(n, BACK)[:n], dtype="u8")]
    for size, hashes in wanted.items():
        if size > n:
            continue
        h = (total[size:] - total[:-size]) * forth[size - 1 : n]
        hit = (hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h) & (owner[size - 1 :] == owner[: n - size + 1])
        at = np.flatnonzero(hit)
        found_own.append(owner[at])
        found_hash.append(h[at])
    return np.concatenate(found_own), np.concatenate(found_hash)
