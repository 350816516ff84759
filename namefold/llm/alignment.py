"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text, and how often across the corpus.

Tokenizer A (byte-level BPE, ``A_FILE``, tokenizers library) encodes ``" " + text``; tokenizer B (SentencePiece BPE with
byte fallback, ``B_FILE``) encodes ``text`` and adds the space itself. Strings of special tokens inside texts are plain
text. A token's bytes are A's vocabulary entry decoded from the byte-level alphabet, or B's piece in UTF-8 with U+2581
as a space and ``<0xHH>`` as byte HH. A text is aligned only if both token sequences join to exactly ``" " + text``.

Method: divide and conquer at shared cuts. A cut is a byte offset where an A token and a B token both end. For an
interval of A and B tokens covering the same bytes, the A end nearest the middle that B also has is found by bisecting
B's ends (searching outward from the middle); the interval is split there and both halves are worked on. An interval
without an inner cut is a leaf group. Inside a group the overlapping A-B token pairs (the links) are enumerated by one
sweep, ``|A| + |B| - 1`` of them.

Words are where the dividing starts: in a text without runs of blanks or white space other than blanks and line breaks,
neither tokenizer has a token across the start of a word (``_WORD``: a blank or line breaks, then the word), so every
word ends at a shared cut, and its tokens, groups and links do not depend on its neighbours. Each worker aligns such a
word once and keeps the outcome in a table of bounded size (``CACHE_WORDS``); all other texts, and words whose token bytes
do not join to the word, are aligned as whole texts.

Corpus counts: an id pair's count is the number of documents (rows) in which it is linked. Each row sends its distinct
pairs with their multiplicity; counts are aggregated before the exchange and written. For each A id the highest count
is taken; a link is *best* if its count equals it (ties included). Counts are joined back to the rows' pairs: pairs
linked in more than ``hot_at`` rows (at most ``HOT_KEYS``, a proven bound) by broadcast, the rest by exchange.

Output per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (all long), groups_sha256 (lowercase hex of
``a1,a2|b1;a3|b2,b3``: per group A ids, then B ids, groups in order). Edge cases: null, empty, or unaligned texts
(the joined bytes of A or B differ from ``" " + text``) have zeros and groups_sha256 ''; repeated rows are separate
documents; very long texts are one row of work; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namefold.workspace import Workspace

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
HOT_KEYS = 1 << 16
HOT_MIN = 1 << 10
BATCH = 64  # texts encoded at once
CACHE_WORDS = 300_000  # words whose alignment a worker keeps
_WORD = re.compile(r"(?: |\n+)\S+")
_ALIGNED = (
    "rid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pa array<int>, pb array<int>, pk array<int>"
)


def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256 and up, in byte order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, shifted = {}, 0
    for b in range(256):
        if b in printable:
            out[chr(b)] = b
        else:
            out[chr(256 + shifted)] = b
            shifted += 1
    return out


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    if a_path and b_path:
        return a_path, b_path
    import public_tokenizers

    return a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)


class Aligner:
    """Both tokenizers and the bytes of every id of each."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one thread a task; Spark runs the tasks in parallel
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        alphabet = _byte_alphabet()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        ranks = {}
        for token, i in vocab.items():
            if all(c in alphabet for c in token):
                self.a_bytes[i] = bytes(alphabet[c] for c in token)
                ranks[self.a_bytes[i]] = i
            else:
                self.a_bytes[i] = token.encode()
        # The same vocabulary and merges run by a faster BPE engine: a merged token's id is its merge rank in this
        # vocabulary, so both give the same ids (the tests compare them with the tokenizers library).
        import public_tokenizers
        import tiktoken

        self.fast_a = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.b_bytes.append(piece.encode())  # never equal to the text's bytes: the row is not aligned
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
        self.a_sizes = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int64)
        # Words are independent in B if no piece has a blank after another character, or a line break beside one.
        self.blank = self.b.piece_to_id("▁")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.by_words = self.blank != self.b.unk_id() and not any(
            "▁" in x.lstrip("▁") or "\n" in x or " " in x or self.b.is_unused(i) for i, x in enumerate(pieces)
        )
        self.words: dict[str, Word | None] = {}

    def ends(self, ids: np.ndarray, table: list[bytes], sizes: np.ndarray, target: bytes) -> np.ndarray | None:
        """End offsets of the tokens, or None if their bytes do not join to ``target``."""
        lengths = sizes[ids]
        if not len(ids) or lengths.min() == 0 or b"".join(map(table.__getitem__, ids.tolist())) != target:
            return None
        return np.cumsum(lengths)

    def rows(self, texts: list[str | None]) -> list["Word | None"]:
        """The alignment of each text, from its words where they are independent; None if unaligned."""
        split = [_WORD.findall(" " + t) if t and self.by_words else [] for t in texts]
        # What is left out by the split, like a run of blanks, makes a text that is aligned whole.
        split = [w if t and sum(map(len, w)) == len(t) + 1 else None for t, w in zip(texts, split)]
        new = set().union(*(w for w in split if w)).difference(self.words)
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = set().union(*(w for w in split if w))
        self._learn(list(new))
        known = self.words
        out: list = [None] * len(texts)
        whole = []
        for k, words in enumerate(split):
            found = [known[w] for w in words] if words else [None]
            if None in found:
                whole.append(k)
            else:
                out[k] = _joined(found)
        for k, found in zip(whole, self.align([texts[k] for k in whole])):
            out[k] = found and _word(*found)
        return out

    def _learn(self, new: list[str]) -> None:
        """Align words, strung together to one text; where their tokens do not tile them, in halves down to one word."""
        if not new:
            return
        text = "".join(new)
        target = text.encode()
        ia = np.array(self.fast_a.encode_ordinary(text), np.int64)
        ib = self.b.encode(text[1:] if text[0] == " " else text)
        # Before a line break, the blank that B adds is left out.
        ib = np.array(ib if text[0] == " " else ib[1:] if ib[:1] == [self.blank] else [], np.int64)
        ea = self.ends(ia, self.a_bytes, self.a_sizes, target)
        eb = self.ends(ib, self.b_bytes, self.b_sizes, target) if ea is not None else None
        ends = np.cumsum([len(w.encode()) for w in new])
        if eb is None or not (np.isin(ends, ea).all() and np.isin(ends, eb).all()):
            half = len(new) // 2
            if half:
                self._learn(new[:half])
                self._learn(new[half:])
            else:
                self.words[new[0]] = None
            return
        cuts = shared_cuts(ea, eb)
        pieces = np.union1d(ea, eb)
        texts = groups_string(ia, ib, ea, eb, cuts).split(";")
        linked = _codes(ia, ib, ea, eb)
        # The tokens, groups and links up to each word's end.
        upto = [[0, *(np.searchsorted(x, ends) + 1).tolist()] for x in (ea, eb, cuts, pieces)]
        for k, w in enumerate(new):
            (a, a1), (b, b1), (g, g1), (n, n1) = (x[k : k + 2] for x in upto)
            self.words[w] = a1 - a, b1 - b, g1 - g, n1 - n, ";".join(texts[g:g1]), linked[8 * n : 8 * n1]

    def align(self, texts: list[str | None]) -> list[tuple]:
        """Per text: n_a, n_b, groups (A ids, B ids per group) and links as (A id, B id) occurrences; None if unaligned."""
        out: list = [None] * len(texts)
        todo = [k for k, t in enumerate(texts) if t]
        if not todo:
            return out
        a_ids = self.fast_a.encode_ordinary_batch([" " + texts[k] for k in todo], num_threads=1)
        b_ids = self.b.encode([texts[k] for k in todo])
        for k, ia, ib in zip(todo, a_ids, b_ids):
            target = (" " + texts[k]).encode()
            ia, ib = np.array(ia, np.int64), np.array(ib, np.int64)
            ea = self.ends(ia, self.a_bytes, self.a_sizes, target)
            eb = self.ends(ib, self.b_bytes, self.b_sizes, target) if ea is not None else None
            if ea is None or eb is None:
                continue
            cuts = shared_cuts(ea, eb)
            out[k] = (ia, ib, ea, eb, cuts)
        return out


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def shared_cuts(ea: np.ndarray, eb: np.ndarray) -> np.ndarray:
    """Offsets where an A token and a B token both end, found by divide and conquer.

    Every A end is located among B's ends by bisection (``searchsorted``). Each round then takes all open intervals of
    A ends at once and splits each at its shared end nearest the middle (bisection again, in the sorted shared ends);
    an interval without one is a leaf group. Both lists end at the same offset, which is the last cut."""
    j = np.minimum(np.searchsorted(eb, ea), len(eb) - 1)
    inner = np.flatnonzero(eb[j] == ea)
    inner = inner[inner < len(ea) - 1]
    cut = np.zeros(len(ea), bool)
    cut[-1] = True
    lo, hi = np.array([0]), np.array([len(ea) - 1])  # open intervals [lo, hi) of inner A ends
    while len(lo) and len(inner):
        mid = (lo + hi) // 2
        k = np.searchsorted(inner, mid)
        right = inner[np.minimum(k, len(inner) - 1)]
        left = inner[np.maximum(k - 1, 0)]
        has_right = (k < len(inner)) & (right < hi) & (right >= lo)
        has_left = (k > 0) & (left >= lo) & (left < hi)
        pick = np.where(has_left & (~has_right | (mid - left <= right - mid)), left, right)
        split = has_left | has_right
        cut[pick[split]] = True
        lo, hi, pick = lo[split], hi[split], pick[split]
        lo, hi = np.concatenate([lo, pick + 1]), np.concatenate([pick, hi])
        keep = lo < hi
        lo, hi = lo[keep], hi[keep]
    return ea[cut]


def groups(ea, eb) -> list[tuple[int, int, int, int]]:
    """Token index ranges (i0, i1, j0, j1) of the leaf groups, in byte order."""
    ea, eb = np.asarray(ea), np.asarray(eb)
    cuts = shared_cuts(ea, eb)
    i1 = np.searchsorted(ea, cuts) + 1
    j1 = np.searchsorted(eb, cuts) + 1
    i0, j0 = np.concatenate([[0], i1[:-1]]), np.concatenate([[0], j1[:-1]])
    return list(zip(i0.tolist(), i1.tolist(), j0.tolist(), j1.tolist()))


def links(ia: np.ndarray, ib: np.ndarray, ea: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A ids, B ids) of every pair of tokens whose byte ranges overlap.

    Tokens of a group tile the same bytes, so each piece between two consecutive ends of either side lies in exactly
    one A and one B token, and consecutive pieces differ in at least one: one link a piece."""
    ends = np.union1d(ea, eb)
    return ia[np.searchsorted(ea, ends)], ib[np.searchsorted(eb, ends)]


def groups_string(ia: np.ndarray, ib: np.ndarray, ea: np.ndarray, eb: np.ndarray, cuts: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: per group its A ids, then its B ids, groups in order."""
    ga, gb = np.searchsorted(cuts, ea), np.searchsorted(cuts, eb)
    group = np.concatenate([ga, gb])
    side = np.concatenate([np.zeros(len(ga), np.int8), np.ones(len(gb), np.int8)])
    ids = np.concatenate([ia, ib])
    order = np.lexsort((np.arange(len(ids)), side, group))
    group, side, ids = group[order], side[order], ids[order]
    seps = np.where(group[1:] != group[:-1], ";", np.where(side[1:] != side[:-1], "|", ","))
    pieces: list = [None] * (2 * len(ids) - 1)
    pieces[0::2] = map(str, ids.tolist())
    pieces[1::2] = seps.tolist()
    return "".join(pieces)


# n_a, n_b, n_groups, n_links, the groups string, and the links as 64-bit integers, the A id in the upper half.
Word = tuple[int, int, int, int, str, bytes]


def _codes(ia: np.ndarray, ib: np.ndarray, ea: np.ndarray, eb: np.ndarray) -> bytes:
    la, lb = links(ia, ib, ea, eb)
    return ((la << 32) | lb).tobytes()


def _word(ia: np.ndarray, ib: np.ndarray, ea: np.ndarray, eb: np.ndarray, cuts: np.ndarray) -> Word:
    linked = _codes(ia, ib, ea, eb)
    return len(ia), len(ib), len(cuts), len(linked) // 8, groups_string(ia, ib, ea, eb, cuts), linked


def _joined(words: list[Word]) -> Word:
    """The alignment of a text from those of its words in order."""
    n_a, n_b, n_groups, n_links, texts, linked = zip(*words)
    return sum(n_a), sum(n_b), sum(n_groups), sum(n_links), ";".join(texts), b"".join(linked)


def groups_text(found: list[tuple[list[int], list[int]]]) -> str:
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(a_path, b_path)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                found = work.rows(part.column("text").to_pylist())
                cols: dict[str, list] = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "sha", "pa", "pb", "pk")}
                for f in found:
                    if f is None:
                        for k, v in zip(cols, (0, 0, 0, 0, "", [], [], [])):
                            cols[k].append(v)
                        continue
                    n_a, n_b, n_groups, n_links, text, linked = f
                    pairs, times = np.unique(np.frombuffer(linked, np.int64), return_counts=True)
                    for k, v in zip(cols, (n_a, n_b, n_groups, n_links, hashlib.sha256(text.encode()).hexdigest(),
                                           pairs >> 32, pairs & 0xFFFFFFFF, times)):
                        cols[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid"), part.column("doc_id"),
                     *(pa.array(cols[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(cols["sha"], pa.string()),
                     *(pa.array(cols[k], pa.list_(pa.int32())) for k in ("pa", "pb", "pk"))],
                    ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pa", "pb", "pk"],
                )

    return run


def alignment(docs: DataFrame, ws: Workspace, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row; see the module docstring."""
    a_path, b_path = _paths(a_path, b_path)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = read.withColumn("rid", F.monotonically_increasing_id())
    rows, _ = ws.save(read.mapInArrow(_aligned(a_path, b_path), _ALIGNED), "aligned")
    pairs = rows.select("rid", F.explode(F.arrays_zip("pa", "pb", "pk")).alias("x")).select(
        "rid", F.col("x.pa").alias("a"), F.col("x.pb").alias("b"), F.col("x.pk").alias("k")
    )
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    counts, seen = ws.save(
        counts.join(top, "a").select("a", "b", "docs", (F.col("docs") == F.col("top")).alias("best")),
        "counts",
        total=F.sum("docs"),
    )
    hot_at = max(HOT_MIN, (seen["total"] or 0) // HOT_KEYS)
    hot = counts.filter(F.col("docs") > hot_at)  # at most total / hot_at <= HOT_KEYS rows
    cold = counts.filter(F.col("docs") <= hot_at)
    met = pairs.join(F.broadcast(hot), ["a", "b"], "left")
    valued = met.filter(F.col("docs").isNotNull()).unionByName(
        met.filter(F.col("docs").isNull()).drop("docs", "best").join(cold, ["a", "b"])
    )
    sums = valued.groupBy("rid").agg(
        F.sum(F.col("k") * F.col("docs")).alias("count_sum"),
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"),
    )
    return rows.join(sums, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
