"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A paragraph hashes to a wide vector of ``DIGESTS`` lanes modulo 2**64 and ``SHAPES`` lanes modulo 2**32; a document's
fingerprint is the lane-wise sum over its paragraphs. Sums do not depend on the order, and a paragraph is inserted
or deleted by adding or subtracting its vector, without the rest of the document.

* The digest lanes come from one cryptographic hash (BLAKE2b, 256 bits) of the whole paragraph, all its bytes. They
  decide equality. Strength: the sum is taken lane by lane modulo 2**64, so two different multisets collide when some
  sums of paragraph hashes agree in 256 bits; by chance that is about 2**-256 a pair, but a chosen-text attacker who
  can add many paragraphs faces a k-sum problem (Wagner's tree algorithm), which is far cheaper than 2**128 for
  large k. It is a fingerprint against accidental equality, not a commitment against adversaries.
* The shape lanes are a signed count sketch of the windows of ``WINDOW`` bytes that end at each byte of the
  paragraph. Their inner product estimates that of the window counts, so the cosine of two fingerprints is a
  likeness of the texts, 1 for equal multisets, about the share of common windows otherwise.

Paragraphs are the runs between line breaks; empty ones do not count. All texts of equal paragraphs, in any order,
have equal fingerprints.

``compared`` pairs each document with the next by doc_id. Ranges of doc_id, cut at ids found by one aggregate over the
id column, go to partitions of their own; the rows at a cut go to the range before it too, as the next of its last
row. One exchange, no window over the whole table.

Nulls: a null text is an empty one, with fingerprint zero. Documents without an id come before all others; ties are
ordered by text. Two empty documents have likeness 1, an empty and another one 0. Repeated rows follow each other.
Other columns are not needed. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGESTS, SHAPES, WINDOW = 4, 128, 16
PIECE = 1 << 20  # bytes sketched at once
# Odd multipliers of the window hash. Fixed values.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

Vector = tuple[np.ndarray, np.ndarray]  # digest lanes, shape lanes


def empty() -> Vector:
    return np.zeros(DIGESTS, np.uint64), np.zeros(SHAPES, np.uint32)


def _shape(padded: bytes) -> np.ndarray:
    """Sketch of paragraphs that each follow ``WINDOW`` zero bytes; windows that end in a zero do not count."""
    total = np.zeros(SHAPES, np.int64)
    for start in range(0, max(len(padded) - WINDOW + 1, 0), PIECE):
        part = padded[start : start + PIECE + WINDOW - 1]
        count = len(part) - WINDOW + 1
        if count <= 0:
            continue
        low = np.ndarray((count,), "<u8", part, 0, (1,))
        high = np.ndarray((count,), "<u8", part, 8, (1,))
        h = low * _A
        h ^= h >> np.uint64(32)
        h += high
        h *= _B
        h ^= h >> np.uint64(29)
        h *= _A
        ends = np.frombuffer(part, np.uint8)[WINDOW - 1 :]
        lanes = (h >> np.uint64(56)).astype(np.int64)[ends != 0]
        both = np.bincount(lanes, minlength=2 * SHAPES)
        total += both[0::2] - both[1::2]
    return total.astype(np.uint32)


def fingerprint(text: str) -> Vector:
    """The sum of the vectors of all paragraphs."""
    data = text.encode("utf-8", "surrogatepass")
    digest = np.zeros(DIGESTS, np.uint64)
    paragraphs = [p for p in data.split(b"\n") if p]
    for p in paragraphs:
        digest += np.frombuffer(hashlib.blake2b(p, digest_size=8 * DIGESTS).digest(), "<u8")
    # Zero bytes mark the gaps of the sketch only; the digest above took the true bytes.
    gap = bytes(WINDOW)
    sketched = [p.replace(b"\0", b"\1") for p in paragraphs]
    return digest, _shape(gap + gap.join(sketched) if sketched else b"")


def insert(total: Vector, paragraph: str) -> Vector:
    digest, shape = fingerprint(paragraph)
    return total[0] + digest, total[1] + shape


def delete(total: Vector, paragraph: str) -> Vector:
    digest, shape = fingerprint(paragraph)
    return total[0] - digest, total[1] - shape


def encoded(total: Vector) -> str:
    return base64.b64encode(total[0].astype("<u8").tobytes() + total[1].astype("<u4").tobytes()).decode()


def decoded(text: str) -> Vector:
    data = base64.b64decode(text)
    return np.frombuffer(data, "<u8", DIGESTS), np.frombuffer(data, "<u4", SHAPES, 8 * DIGESTS)


def likeness(a: Vector, b: Vector) -> float:
    """Cosine of the shape lanes as signed numbers, at least 0; 1 for equal fingerprints."""
    if np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    size = np.sqrt((x @ x) * (y @ y))
    return float(min(max(x @ y / size, 0.0), 1.0)) if size else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _cuts(docs: DataFrame, ranges: int) -> tuple[list[int], int | None]:
    """Ids that start a range, all found in the table, and the smallest id; one number per range reaches the driver."""
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    row = docs.agg(
        F.percentile_approx("doc_id", shares, 10_000).alias("cuts"),
        F.min("doc_id").alias("lowest"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    cuts = sorted(set(row["cuts"] or [])) if ranges > 1 else []
    # Rows without an id are before the smallest one, so that id is inside the first range.
    return [c for c in cuts if c > row["lowest"]], None if row["nulls"] else row["lowest"]


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness, by ``SCHEMA``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    cuts, first_id = _cuts(docs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at_cut = set(cuts)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, absent: pd.Series) -> pd.Series:
        """Twice the range of each copy of a row, plus 1 for a guest: a row that follows the range's last one."""
        found = []
        for i, missing in zip(ids, absent):
            own = 0 if missing else bisect_right(cuts, i)
            codes = [2 * own]
            if not missing and i in at_cut:
                codes.append(2 * own - 1)
            if missing if first_id is None else (not missing and i == first_id):
                codes.append(2 * len(cuts) + 1)
            found.append(codes)
        return pd.Series(found, dtype=object)

    code = F.explode(places(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()))
    rows = docs.select("doc_id", "text", code.alias("code"))
    rows = rows.repartitionById(len(cuts) + 1, F.shiftright("code", 1))
    rows = rows.sortWithinPartitions("code", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return rows.mapInArrow(_follow, SCHEMA)


def _row(doc_id: int | None, text: str, total: Vector, following: str, next_total: Vector) -> tuple:
    changed = edited(text, following)
    other = fingerprint(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        encoded(total),
        encoded(other),
        likeness(total, other),
        likeness(total, next_total),
    )


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a range with the row after it; the range's first guest follows its last row."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    waiting: tuple | None = None
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text, code in zip(*(batch.column(k) for k in range(3))):
            guest = code.as_py() % 2
            if guest and waiting is None:
                continue
            value = text.as_py() or ""
            total = fingerprint(value)
            if waiting is not None:
                out.append(_row(*waiting, value, total))
            waiting = None if guest else (doc_id.as_py(), value, total)
        columns = list(zip(*out)) if out else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
