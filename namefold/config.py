"""Parameters of the resolution, with the default values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# They decide which text is removed and must stay as they are.
HONORIFICS = ("mr", "mrs", "miss", "ms", "dr", "moham")
# A blank in a word stands for any white space, or none.
JUNK_WORDS = ("bacs", "micl", "postcodeservices", "postcode services", "ltd", "limited")


@dataclass(frozen=True)
class PassParams:
    """One round of grouping: cosine similarity first, fuzzy verification second."""

    threshold: float  # keep pairs with cosine strictly above
    ngram_range: tuple[int, int]
    top_n: int  # neighbours kept per name; the name itself takes one of the slots
    fuzz: int  # a member scoring below this against its anchor leaves the group


@dataclass(frozen=True)
class ResolveConfig:
    # The rounds' thresholds, n-gram ranges, neighbours and fuzzy limits.
    precision: PassParams = field(default_factory=lambda: PassParams(0.85, (3, 5), 5, 75))
    recall: PassParams = field(default_factory=lambda: PassParams(0.60, (2, 4), 10, 65))
    merge: PassParams = field(default_factory=lambda: PassParams(0.60, (2, 4), 10, 60))
    honorifics: tuple[str, ...] = HONORIFICS
    junk_words: tuple[str, ...] = JUNK_WORDS
    max_df: float = 0.95  # grams found in a larger share of the names are ignored

    # A side is broadcast only when its measured size is below this; otherwise it is shuffled.
    broadcast_bytes: int = 64 << 20
    # Index entries of one gram that may meet in one join group before the gram is split into blocks.
    gram_block_rows: int = 4096

    def with_precision(self, threshold=None, ngram_range=None, top_n=None) -> "ResolveConfig":
        """Override the first round. A falsy override means "use the default"."""
        base = self.precision
        first = PassParams(
            threshold or base.threshold,
            tuple(ngram_range or base.ngram_range),
            top_n or base.top_n,
            base.fuzz,
        )
        return replace(self, precision=first)
