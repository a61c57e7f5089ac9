"""Burrows-Wheeler transforms of shards, and their merge by interleave refinement.

A shard is a run of texts, end to end. Its transform lists, for each of its suffixes in sorted
order, the byte before the suffix; ``ends`` says where in that order the ends of its texts are.
Everything below reads transforms only: a text is gone once its shard has one.

**Merge.** The interleave starts with the rows of all shards one shard behind the other, all in
one interval. A round reads each row's symbol from its shard's transform, deals the rows out by
symbol without changing their order otherwise, and steps each row back by its shard's LF
mapping. After ``h`` rounds the interleave is sorted by ``h`` bytes, and rows still in one
interval share them. Rows of one shard never change their order among each other: the shard's
own sort is reused, and no suffix is sorted again. A row that is alone in its interval is alone
in every later round, so it leaves; the round it leaves in gives its common prefix.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_PACKED = 7


class Transform(NamedTuple):
    """``symbols`` of all sorted suffixes, the empty one first; the symbol at ``whole`` (the
    whole shard, which nothing precedes) means nothing. ``ends``: ranks of the texts' ends."""

    symbols: np.ndarray
    whole: int
    ends: np.ndarray


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``text`` in order, the empty one first."""
    n = len(text)
    wide = np.zeros(n + _PACKED, dtype=np.int64)
    wide[:n] = text
    wide[:n] += 1
    key = np.zeros(n + 1, dtype=np.int64)
    for i in range(_PACKED):
        key = (key << 9) | wide[i : i + n + 1]
    order = np.argsort(key)
    sorted_key = key[order]
    slots = np.arange(n + 1)
    rank = np.empty(n + 1, dtype=np.int64)
    width = _PACKED
    while True:
        # ``order[slots]`` is sorted by ``sorted_key``; a rank is the first slot of its ties.
        new = np.empty(len(slots), dtype=bool)
        new[:1] = True
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        first = np.flatnonzero(new)
        rank[order[slots]] = slots[first][np.cumsum(new) - 1]
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied]
        if not len(slots):
            return order
        at = order[slots]
        # Tied suffixes are at least ``width`` long, but for the shorter ones, which are alone.
        key = rank[at] * (n + 1) + rank[np.minimum(at + width, n)]
        deal = np.argsort(key)
        order[slots] = at[deal]
        sorted_key = key[deal]
        width *= 2


def transform(texts: list[bytes]) -> Transform:
    """The transform of one shard."""
    text = np.frombuffer(b"".join(texts), dtype=np.uint8)
    order = suffix_array(text)
    symbols = np.zeros(len(order), dtype=np.uint8)
    inner = order > 0
    symbols[inner] = text[order[inner] - 1]
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return Transform(symbols, int(rank[0]), rank[np.cumsum(lengths)])


def lf_mapping(symbols: np.ndarray, whole: int) -> np.ndarray:
    """For each rank, the rank of the suffix one byte longer (``whole`` goes to 0)."""
    real = np.delete(np.arange(len(symbols), dtype=np.int32), whole)
    lf = np.zeros(len(symbols), dtype=np.int32)
    lf[real[np.argsort(symbols[real], kind="stable")]] = np.arange(
        1, len(symbols), dtype=np.int32
    )
    return lf


def read_back(t: Transform) -> bytes:
    """The bytes of a shard, out of its transform."""
    lf, rank, out = lf_mapping(t.symbols, t.whole), 0, bytearray()
    while rank != t.whole:
        out.append(t.symbols[rank])
        rank = lf[rank]
    return bytes(out[::-1])


def refine(symbols: np.ndarray, lf: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
    """Interleave refinement of the rows of several shards.

    ``symbols`` and ``lf`` hold the shards' transforms one behind the other, ``rows`` ascending
    ranks in them. Two symbols are dealt out in one round. Returns, for each row, how many of the
    ``depth`` bytes before it (the last one first) it shares with the row that shares most; an
    odd number below ``depth`` is given as the even one under it.
    """
    shared = np.full(len(rows), depth, dtype=np.int32)
    name = np.arange(len(rows), dtype=np.int32)
    rank = rows
    interval = np.zeros(len(rows), dtype=np.int32)
    pairs = (symbols[lf].astype(np.uint16) << np.uint16(8)) | symbols
    twice = lf[lf]
    for done in range(0, depth, 2):
        single = done + 1 == depth
        symbol = symbols[rank] if single else pairs[rank]
        deal = np.argsort(symbol, kind="stable")
        symbol, interval = symbol[deal], interval[deal]
        new = np.empty(len(deal), dtype=bool)
        new[:1] = True
        new[1:] = (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])
        interval = np.cumsum(new, dtype=np.int32)
        alone = new.copy()
        alone[:-1] &= new[1:]
        if alone.any():
            shared[name[deal[alone]]] = done
            stay = ~alone
            deal, interval = deal[stay], interval[stay]
            if not len(deal):
                break
        name, rank = name[deal], twice[rank[deal]]
    return shared


def common_lengths(
    transforms: list[Transform], counts: list[np.ndarray], depth: int
) -> list[np.ndarray]:
    """Merge shards; per shard, the common lengths of its texts' windows of ``depth`` bytes.

    ``counts`` gives each text's number of windows. The result has one value per window, text
    by text, windows in order: the bytes, from its end, that it shares (see ``refine``).
    """
    base = np.cumsum([0, *(len(t.symbols) for t in transforms)])
    symbols = np.concatenate([t.symbols for t in transforms])
    lf = np.concatenate(
        [lf_mapping(t.symbols, t.whole) + np.int32(b) for t, b in zip(transforms, base)]
    )
    n = np.concatenate(counts).astype(np.int64)
    first = np.cumsum(n) - n
    ends = np.concatenate([t.ends + np.int32(b) for t, b in zip(transforms, base)])
    # All texts are walked back from their ends at once, one byte a step.
    rows = np.empty(int(n.sum()), dtype=np.int32)
    text = np.flatnonzero(n > 0)
    rank, back = ends[text], 0
    while len(text):
        rows[first[text] + n[text] - 1 - back] = rank
        back += 1
        stay = n[text] > back
        text, rank = text[stay], lf[rank[stay]]
    deal = np.argsort(rows)
    found = np.empty(len(rows), dtype=np.int32)
    found[deal] = refine(symbols, lf, rows[deal], depth)
    sizes = np.cumsum([int(c.sum()) for c in counts])
    return np.split(found, sizes[:-1])
