"""Links between fingerprints by bit-sliced comparison, inside one group.

Fingerprints are stored vertically: plane j holds bit j of every member, one member per lane of a wide integer. A
query meets a whole block at once. Each plane is compared with the query's bit, and the differing lanes are added to
bitwise counters by carry-save addition, so a block's distances grow together with a few operations per plane. A
block is abandoned once every lane that still matters exceeds the radius.

A lane stops mattering once its member is known to be in the query's component, so a group of near copies costs
about as much as its first row. Links come out as a spanning forest: fewer than the members of the group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

BLOCK = 2048  # lanes of a block
CELLS = 1 << 17  # distances counted at once


class _Block:
    """Vertical planes of up to ``BLOCK`` members."""

    def __init__(self, bits: np.ndarray, first: int):
        self.first, self.size = first, len(bits)
        packed = np.packbits(bits, axis=0, bitorder="little")
        self.planes = [int.from_bytes(packed[:, j].tobytes(), "little") for j in range(bits.shape[1])]
        self.all = (1 << self.size) - 1


def within(planes: list[int], query: list[int], lanes: int, full: int, radius: int) -> int:
    """The lanes of ``lanes`` whose distance to the query is at most ``radius``."""
    # Counters start so that exceeding the radius carries out of the top bit.
    width = (radius + 1).bit_length()
    spare = (1 << width) - 1 - radius
    counters = [full if spare >> i & 1 else 0 for i in range(width)]
    for plane, bit in zip(planes, query):
        carry = (plane ^ full) if bit else plane
        for i in range(width):
            low = counters[i]
            counters[i] = low ^ carry
            carry &= low
            if not carry:
                break
        else:
            # Lanes that carried out are done; their counters may wrap without harm.
            lanes &= ~carry
            if not lanes:
                return 0
    return lanes


def paired(words: np.ndarray, radius: int) -> np.ndarray:
    """Which rows have another row at ``radius`` or less; the others have no link. At most four words and radius 190."""
    n = len(words)
    columns = np.ascontiguousarray(words.T)
    out = np.zeros(n, bool)
    step = max(1, CELLS // n)
    for a in range(0, n, step):
        b = min(n, a + step)
        near = np.bitwise_count(columns[0, a:b, None] ^ columns[0, None, a:])
        for column in columns[1:-1]:
            near += np.bitwise_count(column[a:b, None] ^ column[None, a:])
        hit = near <= radius
        if len(columns) > 1:
            # Without the last word a distance fits in a byte, and with it, if it was within the radius before.
            near += np.bitwise_count(columns[-1, a:b, None] ^ columns[-1, None, a:])
            hit &= near <= radius
        hit[np.arange(b - a), np.arange(b - a)] = False
        out[a:b] |= hit.any(axis=1)
        out[a:] |= hit.any(axis=0)
    return out


def links(
    words: np.ndarray, radius: int, confirm: Callable[[int, int], bool] | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the links at ``radius`` or less; ``words``: one row of unsigned 64-bit integers each.

    With ``confirm``, a pair within the radius is a link only if it says so.
    """
    n = len(words)
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")
    # Planes on which all members agree cannot add to a distance.
    bits = np.ascontiguousarray(bits[:, bits.any(axis=0) & ~bits.all(axis=0)])
    if not bits.shape[1] and confirm is None:
        return [(0, i) for i in range(1, n)]
    blocks = [_Block(bits[a : a + BLOCK], a) for a in range(0, n, BLOCK)]
    root = list(range(n))
    # Members of each component as lanes, block by block.
    members: list[dict[int, int]] = [{i // BLOCK: 1 << (i % BLOCK)} for i in range(n)]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found: list[tuple[int, int]] = []
    for q in range(n):
        query = None
        for k in range(q // BLOCK, len(blocks)):
            block = blocks[k]
            later = block.all
            if k == q // BLOCK:
                later &= ~((2 << (q % BLOCK)) - 1)
            lanes = later & ~members[find(q)].get(k, 0)
            if not lanes:
                continue
            if query is None:
                query = bits[q].tolist()
            lanes = within(block.planes, query, lanes, block.all, radius)
            while lanes:
                other = block.first + (lanes & -lanes).bit_length() - 1
                if confirm is not None and not confirm(q, other):
                    lanes &= lanes - 1
                    continue
                a, b = find(q), find(other)
                found.append((q, other))
                small, large = (a, b) if sum(map(int.bit_count, members[a].values())) < sum(
                    map(int.bit_count, members[b].values())
                ) else (b, a)
                root[small] = large
                for j, mask in members[small].items():
                    members[large][j] = members[large].get(j, 0) | mask
                lanes &= ~members[large].get(k, 0)
    return found
