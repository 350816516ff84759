"""Token ids as ORC: stripes, run-length encoded integers, row indexes, Bloom filters on document ids.

Documents are dealt to files by ranges of doc_id and sorted, so the files in order, and the rows in each, ascend by
doc_id; a reader takes stripes in parallel, and a lookup by id skips files and stripes by their statistics, row
groups by the row index, and the rest by Bloom filters. The whole texts are encoded after the one exchange, where
they are written. ORC packs the ids with its own run-length encoding.

The tokenizer drops white space between words, so a word's ids do not depend on its neighbours: Arrow splits some
megabytes of texts and numbers their distinct words, only those are encoded with the tokenizers library, and Arrow puts
their ids back in the order of the words. A worker keeps the ids of earlier words in a table of bounded size (``CACHE_WORDS``).

Nulls: a null text is an empty one, which has the end id only; documents without an id come first. Rows with the
same id are ordered by text. Repeated rows are encoded again. Other columns are not written. An empty table gives no
rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 1
CACHE_WORDS = 400_000
SLICE_BYTES = 16 << 20  # text whose words are numbered at once, and one text more at most
OUT_ROWS = 512  # rows sent back at once: ids are larger than texts
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000

_FILES = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(STRIPE_BYTES),
    "orc.create.index": "true",
    "orc.row.index.stride": str(INDEX_ROWS),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>"


# A run of letters with one form each (a-z and lower-case Latin-1) at the start of a word, if an ASCII character other
# than a letter or apostrophe follows, or nothing. The tokenizer always cuts there. What follows is the rest.
_HEAD = r"^(?P<head>[a-zß-öø-ÿ]+)(?P<rest>(?:[!-&(-@\[-`{-~].*)?)$"
_IDS = pa.list_(pa.int32())


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as they are and number the others from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable)}


def _merges(model: dict, letters: dict[int, str]):
    """The model's merges in a faster BPE engine, and which ids end a word; none if the vocabulary does not allow it.

    The engine takes ranks of tokens where the model has ranks of merges, so ids must ascend in the order of the merges.
    A line break stands for the mark that ends a word, which the model has from the start in its last character: those
    tokens come before all merged ones, so the engine merges them first.
    """
    import tiktoken

    vocabulary, mark = model.get("vocab"), model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not mark or model.get("continuing_subword_prefix") or model.get("dropout"):
        return None, None
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    bytes_of = {chr(b): b for b in range(256)} | {c: b for b, c in letters.items()}
    ranks, last, first = {}, np.zeros(max(vocabulary.values()) + 1, bool), 0
    for token, i in vocabulary.items():
        core = token.removesuffix(mark)
        if not core or any(c not in bytes_of for c in core):
            return None, None
        ranks[bytes(map(bytes_of.__getitem__, core)) + b"\n" * (core != token)] = i
        last[i] = core != token
        first = max(first, i) if len(core) == 1 else first
    if merged != sorted(set(merged)) or merged[0] <= first or len(ranks) != len(vocabulary):
        return None, None
    return tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={}), last


def _cells(words: pa.StringArray) -> list[bytes]:
    """Words without line breaks as a list; much faster than ``to_pylist``."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_buffer().to_pybytes().split(b"\n")


def _lists(rows: list[bytes]) -> pa.ListArray:
    """Rows of little-endian 32-bit integers as lists."""
    offsets = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def _strung(lists: pa.ListArray, picks: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """The lists numbered ``picks``, those between two ``offsets`` strung together to one."""
    taken = lists.take(pa.array(picks))
    return pa.ListArray.from_arrays(pa.array(taken.offsets.to_numpy()[offsets]), taken.values)


class WordEncoder:
    """Ids of texts, by a tokenizer that drops white space between words.

    Ids are kept per word. A leading run of plain letters needs no normalizing and is one unit of the tokenizer, so only
    its merges are run, for all new words at once. Everything else goes through the whole tokenizer, and its ids are
    kept too.
    """

    def __init__(self, vocabulary: str, end_id: int = END_ID, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.end = pa.array([[end_id]], _IDS)
        self.limit = limit
        self.words, self.ids = pa.array([], pa.string()), pa.array([], _IDS)
        self.parts: dict[bytes, bytes] = {}
        self.letters = _byte_letters()
        self.merges, self.last = _merges(json.loads(self.tokenizer.to_str())["model"], self.letters)

    def encode(self, text: bytes | None) -> bytes:
        """Ids of one text as little-endian 32-bit integers."""
        return self.encode_all(pa.array([(text or b"").decode()])).values.to_numpy().astype("<i4").tobytes()

    def encode_all(self, texts: pa.StringArray) -> pa.ListArray:
        """Ids of each text, the end id after them."""
        texts = texts.fill_null("")
        # Special tokens are found as they are written, so a text that may hold one keeps its capitals.
        special, lower = pc.match_substring(texts, "<|"), pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(pc.if_else(special, texts, lower) if special.true_count else lower)
        coded = split.values.dictionary_encode()
        lists, place = self._known(coded.dictionary)
        ends = split.offsets.to_numpy()
        picks = np.insert(place[coded.indices.to_numpy()], ends[1:], len(lists))
        return _strung(pa.concat_arrays([lists, self.end]), picks, ends + np.arange(len(ends)))

    def _known(self, words: pa.StringArray) -> tuple[pa.ListArray, np.ndarray]:
        """Lists of ids, and which of them each of the distinct ``words`` has."""
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(found.is_null())
        lists = pa.concat_arrays([self.ids, self._learn(new)])
        place = found.fill_null(-1).to_numpy().copy()
        place[place < 0] = len(self.ids) + np.arange(len(new))
        if len(lists) <= self.limit:
            self.words, self.ids = pa.concat_arrays([self.words, new]), lists
        else:
            # The table begins again with the words just met.
            self.words, self.ids = words[: self.limit], lists.take(pa.array(place[: self.limit]))
        return lists, place

    def _learn(self, new: pa.StringArray) -> pa.ListArray:
        cut = pc.extract_regex(new, _HEAD)
        heads = pc.struct_field(cut, "head").dictionary_encode()
        rests = pc.if_else(cut.is_null(), new, pc.struct_field(cut, "rest")).dictionary_encode()
        n = len(heads.dictionary)
        if len(self.parts) + len(rests.dictionary) > self.limit:
            self.parts.clear()
        lists = [self._heads(_cells(heads.dictionary)), pa.array([[]], _IDS), _lists([self._rest(r) for r in _cells(rests.dictionary)])]
        # A word without a head has the empty list in its place.
        picks = np.stack([heads.indices.fill_null(n).to_numpy(), n + 1 + rests.indices.to_numpy()], axis=1).ravel()
        return _strung(pa.concat_arrays(lists), picks, np.arange(0, 2 * len(new) + 1, 2))

    def _heads(self, heads: list[bytes]) -> pa.ListArray:
        if self.merges is None or not heads:
            texts = (h.decode("latin-1").translate(self.letters) for h in heads)
            return _lists([np.array([t.id for t in self.tokenizer.model.tokenize(x)], "<i4").tobytes() for x in texts])
        ids = self.merges.encode_to_numpy(b"\n".join((*heads, b"")).decode(), disallowed_special=())
        ends = np.flatnonzero(self.last[ids]) + 1
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32)))

    def _rest(self, part: bytes) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            found = self.tokenizer.encode(part.decode(), add_special_tokens=False).ids
            self.parts[part] = ids = np.array(found, "<i4").tobytes()
        return ids


@lru_cache(maxsize=2)
def encoder(vocabulary: str, end_id: int) -> WordEncoder:
    """One encoder a worker: it is loaded once, and a task knows the words that earlier ones met."""
    return WordEncoder(vocabulary, end_id)


def encode(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of the rows of ``docs``, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(vocabulary, end_id)
        for batch in batches:
            if not batch.num_rows:
                continue
            passed = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64)) // SLICE_BYTES
            starts = np.flatnonzero(np.diff(passed, prepend=-1)).tolist()
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(start, end - start)
                ids = work.encode_all(part.column("text").cast(pa.string()))
                lengths = pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64))
                rows = pa.RecordBatch.from_arrays([part.column("doc_id"), lengths, ids], ["doc_id", "n_tokens", "ids"])
                yield from (rows.slice(a, OUT_ROWS) for a in range(0, rows.num_rows, OUT_ROWS))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents to ORC files below ``path``, ascending by doc_id.

    ``position`` numbers the rows: the file in the upper bits, the row in the lower 33.
    """
    placed = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    placed = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = encode(placed, vocabulary, end_id).withColumn("position", F.monotonically_increasing_id())
    rows.write.options(**_FILES).mode("errorifexists").orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{SCHEMA}, position bigint").orc(path)


def lookup(spark: SparkSession, path: str, condition: Column) -> DataFrame:
    """Rows by a condition on doc_id, which Spark hands to the ORC reader."""
    return read(spark, path).filter(condition).select("doc_id", "ids")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files; ``start`` counts the ids of all rows before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            lengths = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("position"), lengths, pa.array(sums, pa.int64())],
                ["doc_id", "position", "n_tokens", "ids_crc32"],
            )

    stored = read(spark, path).withColumn("file", F.shiftright("position", 33))
    # One row per file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = stored.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = stored.select("doc_id", "position", "ids").mapInArrow(
        run, "doc_id bigint, position bigint, n_tokens bigint, ids_crc32 bigint"
    )
    inside = Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("file", F.shiftright("position", 33)).join(files, "file")
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return rows.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
