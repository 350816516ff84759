"""URL filter: host and path rules first, then a weighted vocabulary counted by Aho-Corasick.

Strict terms reject a URL alone; soft terms reject it when several distinct ones occur. A term counts only between
boundaries, so ``sussex`` or ``analytics`` do not match. One automaton over all terms reads each URL once, in Arrow
batches; there is no shuffle. A longer vocabulary goes in as a parameter and travels to the workers with the task.

Nulls: a null URL, or one without ``://``, has an empty host and path; terms are still looked for in its text. Ties
between rules cannot occur: two rules of one length that fit the same URL are the same rule. Other columns of the
input are not needed. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

# Host suffix, path prefix, verdict. Fixed values.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
STRICT = (
    "porn porno pornhub xxx hentai xvideos xnxx nsfw camgirl camgirls gangbang blowjob incest milf creampie warez "
    "keygen escorts"
).split()
SOFT = (
    "sex sexy adult nude naked erotic fetish escort dating hookup casino poker betting gambling jackpot slots viagra "
    "cialis pharmacy pills torrent crack cracked serial payday loan loans cams webcam lingerie bikini teen"
).split()


@dataclass(frozen=True)
class UrlFilter:
    rules: tuple = RULES
    strict: tuple = tuple(STRICT)
    soft: tuple = tuple(SOFT)
    soft_limit: int = 2  # so many distinct soft terms reject a URL


SCHEMA = (
    "page_id bigint, host string, path string, rule string, verdict string, n_strict int, n_soft int, terms string"
)


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#"]
    end = min((e for e in ends if e >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((e for e in (tail.find("?"), tail.find("#")) if e >= 0), default=len(tail))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, tail[:stop]


def rules_by_host(rules: tuple) -> dict[str, list[tuple[str, str]]]:
    found: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        found.setdefault(host, []).append((path, verdict))
    return found


def fitting_rule(host: str, path: str, by_host: dict) -> tuple[str, str] | None:
    """The longest rule whose host is this one or above it and whose path starts this one."""
    labels = host.split(".")
    best: tuple[int, str, str] | None = None
    for k in range(len(labels)):
        above = ".".join(labels[k:])
        for start, verdict in by_host.get(above, ()):
            if path.startswith(start) and (best is None or len(above) + len(start) > best[0]):
                best = len(above) + len(start), above + start, verdict
    return best[1:] if best else None


def automaton(setting: UrlFilter) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for strict, terms in ((False, setting.soft), (True, setting.strict)):
        for term in terms:
            found.add_word(term.lower(), (term.lower(), strict))
    if len(found):
        found.make_automaton()
    return found


def terms_in(url: str | None, found: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms between boundaries: neither side may be a letter or digit."""
    strict: set[str] = set()
    soft: set[str] = set()
    if not url or not len(found):
        return strict, soft
    low = url.lower()
    for last, (term, is_strict) in found.iter(low):
        first = last - len(term) + 1
        if (first == 0 or not low[first - 1].isalnum()) and (last + 1 == len(low) or not low[last + 1].isalnum()):
            (strict if is_strict else soft).add(term)
    return strict, soft


def judge(pages: DataFrame, setting: UrlFilter = UrlFilter()) -> DataFrame:
    """One row per page with host, path, the rule that decided if one did, and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, by_host = automaton(setting), rules_by_host(setting.rules)
        for batch in batches:
            out: list[tuple] = []
            for url in batch.column("url").to_pylist():
                host, path = host_and_path(url)
                rule = fitting_rule(host, path, by_host)
                strict, soft = terms_in(url, found)
                rejected = bool(strict) or len(soft) >= setting.soft_limit
                verdict = rule[1] if rule else "block" if rejected else "allow"
                terms = ",".join(sorted(strict | soft))
                out.append((host, path, rule[0] if rule else None, verdict, len(strict), len(soft), terms))
            columns = list(zip(*out)) if out else [()] * 7
            kinds = [pa.string()] * 4 + [pa.int32()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "terms"],
            )

    return pages.select("page_id", "url").mapInArrow(run, SCHEMA)
