"""Suffix order of a byte buffer by the difference-cover method, vectorised.

Characters are eight-byte grams at every byte, the successor of position i is
i + 8. Positions whose index in their chain is 1 or 2 modulo 3 are the sample;
their triples are sorted and named, the names form the next string (successor
i + 24, then i + 72), and so on until the names span ``DEPTH`` bytes. On the
way back the remaining positions of each string are sorted by (character, rank
of the successor) and merged with the sample: the two sides are compared by
(character, rank) or (character, character, rank), whichever puts both
successors into the sample.

Only the order of the first ``DEPTH`` bytes counts; ties are arbitrary but
contiguous. Ranks are needed only near the wanted positions, so each merge
runs over those alone.
"""

from __future__ import annotations

import numpy as np

LEVELS = 3
STEPS = (8, 24, 72)
#: Bytes that the last names span.
DEPTH = 216


def grams(data: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from every position as a number (big-endian, zeros past the end)."""
    x = np.concatenate([data, np.zeros(pad + 8, np.uint8)]).astype(np.uint64)
    x = x[:-1] << np.uint64(8) | x[1:]
    x = x[:-2] << np.uint64(16) | x[2:]
    x = x[:-4] << np.uint64(32) | x[4:]
    return x


def _names(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks (from 1) of tuples of ranks, by sorting."""
    key = keys[0].astype(np.uint64)
    for more in keys[1:]:
        width = int(more.max(initial=0)).bit_length()
        if int(key.max(initial=0)).bit_length() + width > 64:
            key = _dense(key).astype(np.uint64)
        key = key << np.uint64(width) | more.astype(np.uint64)
    return _dense(key)


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    out = np.empty(len(key), np.int32)
    own = key[order]
    out[order] = np.cumsum(np.concatenate([[1], own[1:] != own[:-1]])) if len(key) else own
    return out


def _both(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Common names of the tuples of two sides."""
    n = len(a[0])
    name = _names(*[np.concatenate([x, y]) for x, y in zip(a, b)])
    return name[:n], name[n:]


def _below(own: np.ndarray, others: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """For each of ``own``: the largest rank of the other side that is not above it (0: none)."""
    order = np.argsort(others)
    top = np.concatenate([[0], np.maximum.accumulate(ranks[order])])
    return top[np.searchsorted(others[order], own, side="right")]


def _merge(positions: np.ndarray, step: int, char: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Ranks of ``positions`` of one string, from the ranks of its sample."""
    kind = positions // step % 3
    rest, one, two = (positions[kind == k] for k in range(3))
    a, b = _both([char[rest], rank[rest + step]], [char[one], rank[one + step]])
    below = _below(a, b, rank[one])
    c, d = _both([char[rest], char[rest + step], rank[rest + 2 * step]], [char[two], char[two + step], rank[two + 2 * step]])
    below = np.maximum(below, _below(c, d, rank[two]))
    out = np.zeros(len(positions), np.int64)
    out[kind != 0] = 2 * rank[positions[kind != 0]].astype(np.int64)
    out[kind == 0] = 2 * below.astype(np.int64) + 1
    inner = np.zeros(len(positions), np.int64)
    inner[kind == 0] = a
    return _names(out, inner)


def order(data: np.ndarray, beyond: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(wanted positions in order of their first DEPTH bytes, grams).
    ``beyond``: how far each position lies behind the last wanted start of its
    piece of text; wanted are those at 0 or below."""
    n = len(data)
    pad = 3 * DEPTH
    x = grams(data, pad)
    size = n + pad
    chars = [np.zeros(size + pad, np.int32)]
    chars[0][:n] = _dense(x[:n])
    # Down: names of the samples' triples, level by level.
    own = np.arange(n)
    levels = [own]
    for k in range(LEVELS):
        step = STEPS[k]
        own = own[own // step % 3 != 0]
        if k == LEVELS - 1:
            own = own[beyond[own] <= 208]
        c = chars[-1]
        name = np.zeros(size + pad, np.int32)
        name[own] = _names(c[own], c[own + step], c[own + 2 * step])
        chars.append(name)
        levels.append(own)
    # Up: merge the remaining positions, near the wanted ones only.
    rank = chars[LEVELS]
    for k, reach in ((2, 64), (1, 16), (0, 0)):
        own = levels[k]
        own = own[beyond[own] <= reach]
        new = np.zeros(size + pad, np.int32)
        new[own] = _merge(own, STEPS[k], chars[k], rank)
        rank = new
    return own[np.argsort(rank[own], kind="stable")], x


def same_prefix(x: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` bytes from positions ``a`` and ``b`` are equal."""
    same = np.arange(len(a))
    for at in [*range(0, length - 7, 8), length - 8]:
        same = same[x[a[same] + at] == x[b[same] + at]]
        if not len(same):
            break
    out = np.zeros(len(a), bool)
    out[same] = True
    return out
