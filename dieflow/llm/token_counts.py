"""Token counts by rank-synchronous merging of ragged numpy arrays."""
from __future__ import annotations

import functools
import json

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.words import Cache, keys, pieces, segments

# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int32).max
# Characters of text whose units are looked up together.
BLOCK = 1 << 21


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    """Merge ranks of a byte-level BPE vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.words = Cache(self.count_units)
        self.tokens: dict[str, int] = {}
        self.pattern = regex.compile(PATTERN)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NONE)

    def merge(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left in each pre-token once no pair can be merged.

        All pre-tokens advance together: a round finds each one's lowest rank and merges
        that pair everywhere in it, left to right. A pair holding a new symbol always
        has a higher rank, so this equals merging one occurrence at a time.
        """
        sizes = np.array([len(t) for t in tokens], np.int64)
        left = sizes.copy()
        row = np.repeat(np.arange(len(tokens)), sizes)
        symbol = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        rank = np.full(len(symbol), NONE, np.int32)
        inner = np.flatnonzero(row[:-1] == row[1:])
        rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        while len(symbol):
            start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            lowest = np.minimum.reduceat(rank, start)
            width = np.diff(np.r_[start, len(row)])
            left[row[start]] = width
            if (done := lowest == NONE).any():
                alive = np.repeat(~done, width)
                symbol, rank, row = symbol[alive], rank[alive], row[alive]
                lowest, width = lowest[~done], width[~done]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, width))
            # In a run such as "aaaa" the chosen pairs overlap; every second one is merged.
            fresh = np.r_[True, np.diff(at) != 1]
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            symbol[at] = self.made[rank[at]]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            at = (np.cumsum(stay) - 1)[at]
            symbol, rank, row = symbol[stay], rank[stay], row[stay]
            rank[at] = NONE
            for side in (at, at[at > 0] - 1):
                side = side[side + 1 < len(row)]
                side = side[row[side] == row[side + 1]]
                rank[side] = self.ranks(symbol[side], symbol[side + 1])
        return left

    def count_units(self, units: list[str]) -> list[int]:
        split = [self.pattern.findall(u) for u in units]
        known = self.tokens
        new = list(set().union(*split).difference(known))
        if len(known) + len(new) > self.words.limit:
            known.clear()
            new = list(set().union(*split))
        if new:
            known.update(zip(new, self.merge([t.encode() for t in new]).tolist()))
        return [sum(map(known.__getitem__, tokens)) for tokens in split]

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of whole texts; blocks of units are looked up together."""
        out = np.zeros(len(texts), np.int64)
        block: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            parts = segments(text or "")
            out[i] += len(parts) - 1
            for part in parts:
                for piece in pieces(part):
                    found, extra = keys(piece)
                    out[i] -= extra
                    block.append((i, found))
                    size += len(piece)
                    if size >= BLOCK:
                        self._add(out, block)
                        block, size = [], 0
        self._add(out, block)
        return out

    def _add(self, out: np.ndarray, block: list[tuple[int, list[str]]]) -> None:
        if block:
            self.words.learn([found for _, found in block])
            get = self.words.__getitem__
            for i, found in block:
                out[i] += sum(map(get, found))


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def token_counts(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 512,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Counts equal the tokenizers library's for byte-level BPE files (its default for special
    strings, no tokens added). NULL and empty texts have 0 bytes and 0 tokens; ids may be
    NULL or repeated, every row gives a row; an empty table gives none; other columns,
    whatever their names, are not read. A map over rows: no shuffle, and long texts are
    handled in pieces. Each worker keeps a bounded cache of unit counts.
    """

    @F.pandas_udf("bigint")
    def counted(text: pd.Series) -> pd.Series:
        return pd.Series(merges(model_path).count(text.tolist()))

    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column), F.octet_length(text).cast("bigint").alias("n_bytes"), counted(text).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
