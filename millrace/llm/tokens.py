"""Exact token counts at every prefix of a text, by dynamic programming over byte-level BPE.

The encoding of a prefix ends in exactly one token ``t`` for which the encoding
of the prefix before it ends in a token ``u`` such that ``u + t`` encodes to
``u, t``. So the count at a prefix is one more than the count ``len(t)`` bytes
before, and a table over all prefixes of a piece takes one pass, without
merging anything but pairs of tokens, whose results are kept. The text's own
table is the pieces' tables, added up; truncation and budget questions are
look-ups in it.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import with_text_columns

#: Pieces whose totals a worker remembers, and token pairs; beyond, it starts anew. Longer pieces are counted each time.
KEPT_PIECES, KEPT_PAIRS, KEPT_LENGTH = 400_000, 1_000_000, 64

#: The byte-level pre-tokenizer's pattern, with white space spelt out.
_BLANK = "".join(
    map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
_WHITE = re.escape(_BLANK)
_PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+"
    rf"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
#: Letters and digits of later Unicode tables than the tokenizers' library has, which takes them for neither.
_LATER = "".join(
    "-".join(chr(int(end, 16)) for end in ends.split("-"))
    for ends in (
        "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd-a7f1 ab6c-ab6d 107bb-107bf 10940-10959 "
        "10ec5-10eee 11b0a 11db0-11df1 1246f-1247f 12550-12686 16ea0-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda "
        "18d09-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1dfff 1e6c0-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-3fc3f"
    ).split()
)
_HAS_LATER = re.compile(f"[{_LATER}]")
#: The first pattern for texts that have some of them.
_LATER_PIECES = regex.compile(
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?[\p{{L}}--[{_LATER}]]+| ?[\p{{N}}--[{_LATER}]]+| ?[[^{_WHITE}\p{{L}}\p{{N}}][{_LATER}]]+"
    rf"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
#: The same for texts of Latin letters, in the faster library; elsewhere classes differ.
_LATIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_OTHER = re.compile(rf"[^\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-{chr(0x24F)}]")
_SPLIT_SHORTER = {"'re", "'ve", "'ll"}


def _pieces(text: str) -> list[str]:
    other = _OTHER.search(text)
    if not other:
        return _LATIN.findall(text)
    return (_LATER_PIECES if _HAS_LATER.search(text, other.start()) else _PIECES).findall(text)


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary file: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts of a byte-level BPE tokenizer file without normalizer."""

    def __init__(self, body: bytes):
        config = json.loads(body)
        model, pre = config["model"], config.get("pre_tokenizer") or {}
        wrong = [
            model.get("type") != "BPE",
            pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True),
            bool(config.get("normalizer")),
            bool(model.get("ignore_merges") or model.get("dropout") or model.get("byte_fallback")),
            any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in config["added_tokens"]),
        ]
        if any(wrong):
            raise ValueError("a byte-level BPE file without normalizer or prefix space is asked for")
        letters = _byte_letters()
        # bytes are written as the characters of the same numbers
        raw = lambda s: "".join(chr(letters[c]) for c in s)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self._ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self._known = [raw(s) for s in model["vocab"] if all(c in letters for c in s)]
        self._endings = ahocorasick.Automaton()
        for number, token in enumerate(self._known, 1):
            self._endings.add_word(token, (number, len(token)))
        self._endings.make_automaton()
        special = [t["content"] for t in config["added_tokens"]]
        longest_first = sorted(special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None
        self._totals: dict[str, int] = {}
        self._adjacent: dict[int, bool] = {}

    def _merged(self, body: str) -> list[str]:
        parts = list(body)
        while len(parts) > 1:
            rank, at = min((self._ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _follows(self, before: int, token: int) -> bool:
        """Whether two tokens, or the second alone where the first is 0, stay as they are."""
        if len(self._adjacent) >= KEPT_PAIRS:
            self._adjacent.clear()
        pair = [self._known[n - 1] for n in (before, token) if n]
        found = self._adjacent[before << 32 | token] = self._merged("".join(pair)) == pair
        return found

    def table(self, piece: str) -> list[int]:
        """Token counts of all prefixes of one piece, by bytes, from 0 on."""
        body = piece.encode().decode("latin-1")
        counts, last = [0] * (len(body) + 1), [0] * (len(body) + 1)
        adjacent = self._adjacent
        for end, (token, length) in self._endings.iter(body):
            if counts[end + 1]:
                continue
            start = end + 1 - length
            fits = adjacent.get(last[start] << 32 | token)
            if fits or fits is None and self._follows(last[start], token):
                counts[end + 1] = counts[start] + 1
                last[end + 1] = token
        return counts

    def _total(self, piece: str) -> int:
        found = self.table(piece)[-1]
        if len(piece) <= KEPT_LENGTH:
            if len(self._totals) >= KEPT_PIECES:
                self._totals.clear()
            self._totals[piece] = found
        return found

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text's stretches, and whether each is a special token."""
        low = 0
        for m in self._special.finditer(text) if self._special else ():
            yield text[low : m.start()], False
            yield m[0], True
            low = m.end()
        yield text[low:], False

    def _totals_of(self, text: str) -> tuple[list[str], list[int], list[bool]]:
        pieces: list[str] = []
        totals: list[int] = []
        special: list[bool] = []
        for part, whole in self._parts(text):
            own = [part] if whole else _pieces(part)
            counts = [1] if whole else list(map(self._totals.get, own))
            if None in counts:
                counts = [self._total(p) if n is None else n for p, n in zip(own, counts)]
            pieces += own
            totals += counts
            special += [whole] * len(own)
        return pieces, totals, special

    def _inside(self, piece: str) -> list[int]:
        """Counts at the prefixes of 1, 2, ... characters of a piece that stands at a text's end."""
        by_byte = self.table(piece)
        sizes = accumulate(len(c.encode()) for c in piece)
        found = [by_byte[n] for n in sizes]
        if piece in _SPLIT_SHORTER:  # cut, it is an apostrophe and a letter
            found[1] = 2
        return found

    def counts(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... characters, as if each were the whole text."""
        pieces, totals, special = self._totals_of(text)
        return self._counts_in(text, pieces, totals, special, 0, len(pieces), 0, 0)

    def _counts_in(
        self, text: str, pieces: list[str], totals: list[int], special: list[bool], low: int, high: int, at: int, done: int
    ) -> np.ndarray:
        """The table's entries from position ``at`` to the end of some pieces, the first of which begins there.

        ``done`` is the entry at ``at``. A run of white space has to begin with the first piece or after it.
        """
        base, some = at, slice(low, high)
        found = np.zeros(sum(map(len, pieces[some])) + 1, np.int64)
        found[0] = done
        run_at, run_done = at, done
        before = (at - len(pieces[low - 1]), done - totals[low - 1]) if low else (at, done)
        for piece, total, whole in zip(pieces[some], totals[some], special[some]):
            own = found[at - base :]
            if whole:
                # cut, a special token is ordinary text that may join the piece before it
                start, start_done = before
                for k in range(1, len(piece)):
                    own[k] = start_done + self.total(text[start : at + k])
                run_at, run_done = at + len(piece), done + total
            else:
                own[1 : 1 + len(piece)] = np.add(self._inside(piece), done)
                blanks = len(piece) - len(piece.lstrip(_BLANK))
                if blanks:  # at a text's end, all white space up to there is one piece
                    run = text[run_at : at + blanks]
                    found[run_at - base + 1 : at - base + blanks + 1] = np.add(self._inside(run), run_done)
                if blanks < len(piece):
                    run_at, run_done = at + len(piece), done + total
            before = (at, done)
            at, done = at + len(piece), done + total
            if whole or piece.strip(_BLANK):
                found[at - base] = done
        return found

    def total(self, text: str) -> int:
        """The last entry of ``counts``."""
        return sum(self._totals_of(text)[1])

    def total_and_fit(self, text: str, limit: int) -> tuple[int, int]:
        """The last entry, and the length of the longest prefix of at most ``limit`` tokens.

        Both are look-ups: the sum of the pieces' last entries says which piece the limit falls
        in, and the table's entries there which prefix fits.
        """
        pieces, totals, special = self._totals_of(text)
        total = sum(totals)
        if total <= limit:
            return total, len(text)
        # A piece that begins with more than the limit used up has no prefix that fits, save
        # that white space at the end is one piece, and that a cut special token joins its neighbour.
        blank = lambda n: not special[n] and not pieces[n].strip(_BLANK)
        after = list(accumulate(totals))
        low = over = bisect_right(after, limit)
        while low and blank(low - 1):
            low -= 1
        high = over + 1
        while high < len(pieces) and (blank(high - 1) or special[high]):
            high += 1
        at = sum(map(len, pieces[:low]))
        entries = self._counts_in(text, pieces, totals, special, low, high, at, after[low - 1] if low else 0)
        return total, at + int(np.flatnonzero(entries <= limit)[-1])


@lru_cache(maxsize=2)
def _counter(body: bytes) -> PrefixCounter:
    return PrefixCounter(body)


def tokenizer_body(path: str) -> bytes:
    """A tokenizer file, read by the driver; workers get it with the task."""
    with open(path, "rb") as file:
        return file.read()


def token_prefixes(frame: DataFrame, tokenizer: str, text: str = "text", name: str = "prefix_tokens") -> DataFrame:
    """The rows with an array of the token counts at 0, 1, ... n code points of the text.

    Null is the empty text, whose only entry is 0. Special tokens in a text count
    as one, as the library has it by default; none are added. A column of the
    same name is replaced; repeated rows and empty tables need no care.
    """
    shared = _shared(frame.sparkSession, tokenizer)

    def work(values):
        counter = _counter(shared.value)
        return ([counter.counts(v or "") for v in values],)

    return with_text_columns(frame, text, [(name, T.ArrayType(T.IntegerType()))], work)


def token_totals(frame: DataFrame, tokenizer: str, limit: int, text: str = "text") -> DataFrame:
    """The rows with ``n_bytes``, ``n_tokens`` (the table's last entry) and ``fit_chars``,
    the code points of the longest prefix of at most ``limit`` tokens. Cases as above."""
    shared = _shared(frame.sparkSession, tokenizer)

    def work(values):
        counter = _counter(shared.value)
        pairs = [counter.total_and_fit(v or "", limit) for v in values]
        return [len((v or "").encode()) for v in values], [p[0] for p in pairs], [p[1] for p in pairs]

    names = ("n_bytes", "n_tokens", "fit_chars")
    return with_text_columns(frame, text, [(n, T.LongType()) for n in names], work)


def _shared(spark: SparkSession, tokenizer: str):
    return spark.sparkContext.broadcast(tokenizer_body(tokenizer))


def tokens_within(prefixes: Column, chars: Column) -> Column:
    """How many tokens the first ``chars`` code points take."""
    return F.element_at(prefixes, (F.least(chars, F.size(prefixes) - 1) + 1).cast("int"))


def longest_within(prefixes: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = F.transform(prefixes, lambda n, i: F.when(n <= budget, i))
    return F.array_max(fits)
