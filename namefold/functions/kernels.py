"""Array kernels that run inside Python workers, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_WORD = 64
_CELLS_PER_CHUNK = 1 << 21


def _code_points(strings: np.ndarray, width: int, pad: int) -> np.ndarray:
    flat = np.asarray(strings, dtype=f"<U{width}").view(np.uint32).reshape(len(strings), width)
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    return np.where(np.arange(width) < lengths[:, None], flat, np.uint32(pad))


def lcs_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest-common-subsequence length of each pair, all pairs advanced together.

    Bit-vector method (Hyyro, "Bit-parallel LCS-length computation revisited", 2004) with one row of
    64-bit words per pair.
    """
    len_a = np.fromiter(map(len, a), dtype=np.int64, count=len(a))
    width_a = max(_WORD, -(-int(len_a.max(initial=0)) // _WORD) * _WORD)
    width_b = max(1, max(map(len, b), default=0))
    left, right = _code_points(a, width_a, 0xFFFFFFFE), _code_points(b, width_b, 0xFFFFFFFF)
    words = width_a // _WORD
    state = np.full((len(a), words), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(width_b):
        hits = np.packbits(left == right[:, at : at + 1], axis=1, bitorder="little").view("<u8")
        carry = np.zeros(len(a), dtype=np.uint64)
        for w in range(words):
            row = state[:, w]
            common = row & hits[:, w]
            total = row + common
            overflow = total < row
            total = total + carry
            overflow |= total < carry
            state[:, w] = total | (row & ~hits[:, w])
            carry = overflow.astype(np.uint64)
    zeros = np.unpackbits(np.ascontiguousarray(~state).view(np.uint8), axis=1, bitorder="little")
    return np.where(np.arange(width_a) < len_a[:, None], zeros, 0).sum(axis=1)


def lcs_in_chunks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # Pairs of like length share a chunk, so one long text does not widen the matrix of all others.
    longest = np.fromiter((max(len(x), len(y), _WORD) for x, y in zip(a, b)), np.int64, len(a))
    order = np.argsort(longest, kind="stable")
    out = np.zeros(len(a), dtype=np.int32)
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and longest[order[stop]] * (stop + 1 - start) <= _CELLS_PER_CHUNK:
            stop += 1
        pick = order[start:stop]
        out[pick] = lcs_lengths(a[pick], b[pick])
        start = stop
    return out


PLANES, WORDS = 4, 2  # bits per level, 64-bit words per bit plane
_BUCKETS = 64 * WORDS
_TERM = np.dtype([("gram", "<i8"), ("w", "<f8")])


def pack_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turn the lists ``grams`` and ``weights`` into one binary value and a sketch of fixed size.

    The grams fall into 128 buckets. The norm of the vector inside each bucket is rounded up to 0..15
    times ``unit``; ``s0..s7`` hold the bit planes of these levels, two words per plane. Inside a bucket
    the dot product of two vectors is at most the product of their norms (Cauchy-Schwarz), so the dot
    product of the levels bounds that of the vectors, and bit counts are enough to compute it.
    """
    for batch in batches:
        rows, grams, weights = batch.num_rows, batch.column("grams"), batch.column("weights")
        terms = np.empty(len(grams.flatten()), _TERM)
        terms["gram"], terms["w"] = grams.flatten().to_numpy(), weights.flatten().to_numpy()
        counts = grams.value_lengths().to_numpy(False)
        ends = np.concatenate([[0], np.cumsum(counts)]) * _TERM.itemsize
        buffers = [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(terms)]
        bucket = np.repeat(np.arange(rows), counts) * _BUCKETS + terms["gram"] % _BUCKETS
        squares = np.bincount(bucket, weights=terms["w"] ** 2, minlength=rows * _BUCKETS)
        norms = np.sqrt(squares).reshape(rows, _BUCKETS)
        unit = np.maximum(norms.max(axis=1, initial=0), 1e-12) / (2**PLANES - 1)
        levels = np.ceil(norms / unit[:, None] - 1e-9).astype(np.uint8)
        words = []
        for plane in range(PLANES):
            bits = np.packbits((levels >> plane) & 1, axis=1, bitorder="little").view("<i8")
            words += [pa.array(np.ascontiguousarray(bits[:, w])) for w in range(WORDS)]
        columns = {
            "gid": batch.column("gid"),
            "size": batch.column("size"),
            "terms": pa.Array.from_buffers(pa.binary(), rows, buffers),
            "unit": pa.array(unit),
            **{f"s{i}": word for i, word in enumerate(words)},
            "prefix": batch.column("prefix"),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _unpack(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term counts per row and the terms of all rows, without copying."""
    _, ends, data = packed.buffers()
    ends = np.frombuffer(ends, "<i4")[packed.offset : packed.offset + len(packed) + 1]
    terms = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(_TERM) if data else np.empty(0, _TERM)
    return np.diff(ends) // _TERM.itemsize, terms


def _row_dots(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Dot product per row: equal (row, gram) keys of the two sides become neighbours in one merge."""
    rows = len(left[0])
    terms = np.concatenate([left[1], right[1]])
    span = int(terms["gram"].max(initial=0)) + 1
    row = np.concatenate([np.repeat(np.arange(rows), counts) for counts, _ in (left, right)])
    keys = row * span + terms["gram"]
    order = np.argsort(keys, kind="stable")  # two sorted runs: linear
    keys = keys[order]
    hits = np.flatnonzero(keys[1:] == keys[:-1])
    products = terms["w"][order[hits]] * terms["w"][order[hits + 1]]
    return np.bincount(row[order[hits]], weights=products, minlength=rows)


def dot_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dot product per row of two packed vectors."""
    for batch in batches:
        sides = [batch.column("a_terms"), batch.column("b_terms")]
        largest = max(int(_unpack(side)[1]["gram"].max(initial=0)) for side in sides)
        step = max(1, (2**63 - 1) // (largest + 1) - 1)  # (row, gram) keys must fit 64 bits
        parts = [np.zeros(0)]
        for start in range(0, batch.num_rows, step):
            parts.append(_row_dots(*(_unpack(side.slice(start, step)) for side in sides)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(np.concatenate(parts), pa.float64())],
            names=["a", "b", "sim"],
        )


def spanning_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's edges as stars: each node to the smallest node it reaches here (hooking and pointer jumping)."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    u, v = table.column("u").to_numpy(), table.column("v").to_numpy()
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(label, before):
            break
    moved = label != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], ["u", "v"])
