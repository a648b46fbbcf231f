"""Encoding of a corpus with a public byte-level BPE tokenizer, exactly, by dynamic programming over prefixes.

For every prefix of a piece there is one token its encoding can end with. An automaton over the vocabulary gives
all tokens that end at a byte; the longest of them that may follow the last token of the prefix before it is the
one. Two tokens may stand side by side if taking their merges back never meets a merge across their border that
would have come earlier. Back-pointers from the last prefix give the ids. The work is linear in the text, also
for a piece of many megabytes; short pieces are remembered.

Defined cases: a null text and an empty text have an empty list; the spelling of a special token in a text is
ordinary text; every other column is left alone.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annulet.session import spread

TOKENIZERS = os.environ.get("ANNULET_TOKENIZERS", "/opt/tokenizers")

# Fixed value: how this family of tokenizers cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixEncoder:
    """ids of texts by one vocabulary file with merges."""

    def __init__(self, path: str, remember: int = 200_000, longest: int = 64):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocab = byte_letters(), model["vocab"]
        self.merged: dict[tuple[int, int], int] = {}  # pair -> token
        self.halves: dict[int, tuple[int, int]] = {}  # token -> pair
        self.rank: dict[int, int] = {}  # token -> when its merge comes; single bytes have none
        for n, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            token = vocab[a + b]
            self.merged[vocab[a], vocab[b]] = token
            self.halves[token], self.rank[token] = (vocab[a], vocab[b]), n
        self.matcher = ahocorasick.Automaton()
        for token, i in vocab.items():
            if i in self.rank or token in letters:  # special tokens are neither
                self.matcher.add_word("".join(chr(letters[c]) for c in token), (i, len(token)))
        self.matcher.make_automaton()
        self.cut = regex.compile(PIECES)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.remember, self.longest = remember, longest

    def _side_by_side(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` can be neighbours in an encoding of their joint bytes."""
        rank, merged, halves = self.rank, self.merged, self.halves
        # Going back in time: `limit` is the earliest merge already taken back; one across the border that
        # comes before it, would have been made.
        limit, right_first = len(rank), False
        while True:
            across = merged.get((left, right))
            if across is not None and (rank[across] < limit or rank[across] == limit and right_first):
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, right_first, left = a, False, halves[left][1]
            else:  # of two equal tokens the left one is made first, so the right one goes first
                limit, right_first, right = b, True, halves[right][0]

    def _piece(self, data: bytes) -> tuple[int, ...]:
        last: list[tuple[int, int] | None] = [None] * (len(data) + 1)
        pairs, done = self.pairs, -1
        for end, (token, size) in self.matcher.iter(data.decode("latin-1")):
            if end == done:
                continue
            start = end + 1 - size
            if start:
                before = last[start]
                if before is None:
                    continue
                key = (before[0], token)
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) > 4 * self.remember:
                        pairs.clear()
                    fits = pairs[key] = self._side_by_side(*key)
                if not fits:
                    continue
            last[end + 1] = (token, size)
            done = end
        out, at = [], len(data)
        while at:
            token, size = last[at]
            out.append(token)
            at -= size
        return tuple(reversed(out))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known = self.known
        for piece in self.cut.findall(text or ""):
            ids = known.get(piece)
            if ids is None:
                ids = self._piece(piece.encode())
                if len(piece) <= self.longest:
                    if len(known) >= self.remember:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    """One per worker process."""
    return PrefixEncoder(path)


def encode(df: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, count_only: bool = False) -> DataFrame:
    """key and ``ids``, or key and ``n_tokens``."""
    path = os.path.join(folder, f"{name}.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            lists = [enc.encode(t) for t in batch.column(1).to_pylist()]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            if count_only:
                values = pa.array(sizes, pa.int64())
            else:
                flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(sizes.sum()))
                values = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], [key, "n_tokens" if count_only else "ids"])

    kind = df.select(key).schema[0].dataType.simpleString()
    out = f"`{key}` {kind}, " + ("n_tokens bigint" if count_only else "ids array<int>")
    return spread(df.select(key, F.col(text))).mapInArrow(run, out)
