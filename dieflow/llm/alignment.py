"""Alignment of two tokenizers: groups between shared cuts, and how often token pairs are linked corpus-wide."""
from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch
from dieflow.llm.token_counts import PATTERN, byte_letters
from dieflow.llm.words import Cache, is_plain

# Characters of text aligned together, and characters whose token pairs are named together.
PART, BLOCK = 1 << 20, 1 << 23
CACHE = 300_000
# Units encoded as one text.
TOGETHER = 1 << 12
SPACE_PIECE = "▁"


class Codec:
    """Ids and token bytes of one tokenizer; ``encode`` takes texts that a space stands before."""

    def __init__(self, encode: Callable[[str], list[int]], tokens: list[bytes]):
        if len(tokens) > 1 << 16:
            raise ValueError("token ids over 16 bits")
        self.encode, self.tokens = encode, tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)

    def whole(self, text: str) -> np.ndarray | None:
        """Ids of a text, None if they do not spell it out."""
        ids = self.encode(text)
        return np.array(ids, np.uint16) if b"".join(map(self.tokens.__getitem__, ids)) == b" " + text.encode() else None

    def units(self, units: list[str]) -> list[bytes | None]:
        """Ids of units no token crosses the start of, encoded many at a time and parted by their bytes."""
        out: list[bytes | None] = []
        for lo in range(0, len(units), TOGETHER):
            data = [u.encode() for u in units[lo:lo + TOGETHER]]
            ids = self.whole("x" + b"".join(data).decode())
            if ids is None and len(data) > 1:
                out += [self.units([u])[0] for u in units[lo:lo + TOGETHER]]
            elif ids is None:
                out.append(None)
            else:
                ends = np.cumsum(self.sizes[ids])
                cuts = (np.searchsorted(ends, 2 + np.cumsum([0, *map(len, data)])) * 2 + 2).tolist()
                packed = ids.tobytes()
                out += [packed[a:b] for a, b in zip(cuts, cuts[1:])]
        return out


def byte_level(path: str) -> Codec:
    """A byte-level BPE file; strings of special tokens are plain text."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters = {letter: byte for byte, letter in byte_letters().items()}
    spelled = {token: bytes(letters[x] for x in token) for token in vocab if all(x in letters for x in token)}
    # Ids of the file are its merge ranks but for the single bytes, which come first in another order.
    ranks = {b: vocab[t] for t, b in spelled.items()}
    library = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(vocab.values()) + 1)
    for token, data in spelled.items():
        tokens[vocab[token]] = data
    return Codec(lambda text: library.encode_ordinary(" " + text), tokens)


def sentence_pieces(path: str) -> Codec:
    """A SentencePiece model that sets a space before texts."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    tokens = [bytes([int(n[3:5], 16)]) if library.is_byte(i) else n.replace(SPACE_PIECE, " ").encode() for i, n in enumerate(names)]
    if any("\n" in n or SPACE_PIECE in n.lstrip(SPACE_PIECE) for i, n in enumerate(names) if not library.is_byte(i)):
        raise ValueError("pieces that cross a space or line break: texts cannot be cut there")
    return Codec(library.encode, tokens)


class Pair:
    """Both tokenizers over many texts; frequent words are encoded once per worker."""

    def __init__(self, a: Codec, b: Codec):
        self.codecs = a, b
        self.words = [Cache(c.units, CACHE) for c in self.codecs]
        self.texts = Texts(a, b)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of each text by both; None where it is empty or its tokens do not spell it out.

        Where single spaces and line breaks are the only white space, no token crosses the
        place before one, so a text is cut there. Other texts are encoded whole.
        """
        cut = [t.replace("\n", " \n").split(" ") if t and is_plain(t) else None for t in texts]
        known = [w.learn([c for c in cut if c]) or w for w in self.words] if any(cut) else self.words
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, keys in zip(texts, cut):
            if not text:
                out.append(None)
                continue
            try:
                both = tuple(np.frombuffer(b"".join(map(w.__getitem__, keys)), np.uint16) for w in known) if keys else None
            except TypeError:  # a word without a spelling
                both = None
            both = both or tuple(c.whole(text) for c in self.codecs)
            out.append(both if both[0] is not None and both[1] is not None else None)
        return out


@functools.lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Pair:
    return Pair(byte_level(path_a), sentence_pieces(path_b))


def shared_cuts(a: np.ndarray, b: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which token ends in ``a`` are ends in ``b`` too, by divide and conquer.

    ``a`` and ``b`` rise; tokens ``first`` to ``stop`` of ``a`` are one text, whose last end
    both share. In every interval the shared end nearest to its middle is found by bisecting
    ``b``, in windows that double; both halves are searched on. An interval without one
    is a leaf. All intervals of a level advance together.
    """
    cut = np.zeros(len(a), bool)
    cut[stop[stop > first] - 1] = True
    low, high = first, stop - 1
    while True:
        some = high > low
        low, high = low[some], high[some]
        if not len(low):
            return cut
        middle, found = (low + high) // 2, np.full(len(low), -1)
        left, width = np.arange(len(low)), 0
        while len(left):
            lo, hi = np.maximum(middle[left] - width, low[left]), np.minimum(middle[left] + width + 1, high[left])
            sizes = hi - lo
            begin = np.cumsum(sizes) - sizes
            at = np.arange(sizes.sum()) + np.repeat(lo - begin, sizes)
            meets = b[np.searchsorted(b, a[at])] == a[at]
            far = np.where(meets, np.abs(at - np.repeat(middle[left], sizes)) * 2 + (at > np.repeat(middle[left], sizes)), len(a) * 4)
            near = np.minimum.reduceat(far, begin)
            hit = near < len(a) * 4
            found[left[hit]] = middle[left[hit]] + np.where(near[hit] & 1, near[hit] // 2, -(near[hit] // 2))
            left = left[~hit & ((lo > low[left]) | (hi < high[left]))]
            width = 2 * width + 1
        some = found >= 0
        low, high, found = low[some], high[some], found[some]
        cut[found] = True
        low, high = np.concatenate([low, found + 1]), np.concatenate([found, high])


class Texts:
    """Aligns blocks of encoded texts."""

    def __init__(self, a: Codec, b: Codec):
        self.codecs = a, b
        # Decimal id and what follows it: within a part of a group, or at the part's end.
        shown = [f"{i}{end}".encode() for c, last in zip(self.codecs, "|;") for i in range(len(c.tokens)) for end in ("," + last)]
        self.width = max(map(len, shown))
        self.shown = np.frombuffer(b"".join(s.ljust(self.width, b"\0") for s in shown), np.uint8).reshape(-1, self.width)
        self.digits = np.array([len(s) for s in shown], np.int64)
        self.second = 2 * len(a.tokens)

    def align(self, ids: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links, digest); per text and linked pair of ids its number, the pair and the times it is linked."""
        n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        a, b = (np.concatenate([x[k] for x in ids]).astype(np.int64) for k in (0, 1))
        ends_a, ends_b = np.cumsum(self.codecs[0].sizes[a]), np.cumsum(self.codecs[1].sizes[b])
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        cut = shared_cuts(ends_a, ends_b, stop_a - n_a, stop_a)
        at_b = np.searchsorted(ends_b, ends_a)
        cut_b = np.zeros(len(b), bool)
        cut_b[at_b[cut]] = True

        # Merge both rows of ends: every stretch between neighbouring ends is one link.
        alone = np.cumsum(~cut_b) - ~cut_b
        place_a = np.arange(len(a)) + alone[at_b]
        n = len(a) + len(b) - int(cut.sum())
        is_a = np.zeros(n, bool)
        is_a[place_a] = True
        is_b = ~is_a
        is_b[place_a[cut]] = True
        of_a, of_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
        ended = np.zeros(n, np.int64)
        ended[place_a[stop_a - 1]] = 1
        text = np.cumsum(ended) - ended
        n_links = np.bincount(text, minlength=len(ids))
        links = np.sort(text << 32 | a[of_a] << 16 | b[of_b])
        new = np.flatnonzero(np.r_[True, links[1:] != links[:-1]])
        times, links = np.diff(np.r_[new, n]), links[new]

        # Groups in reading order: the tokens of A, then those of B.
        group_a, group_b = np.cumsum(cut) - cut, np.cumsum(cut_b) - cut_b
        last_a, last_b = np.flatnonzero(cut) + 1, np.flatnonzero(cut_b) + 1
        row = np.empty(len(a) + len(b), np.int64)
        row[np.arange(len(a)) + np.r_[0, last_b][group_a]] = 2 * a + cut
        row[np.arange(len(b)) + last_a[group_b]] = self.second + 2 * b + cut_b
        data = self.shown[row].ravel()
        data = data[data != 0].tobytes()
        stops = np.cumsum(self.digits[row])[stop_a + stop_b - 1].tolist()
        digests = [hashlib.sha256(memoryview(data)[lo:hi - 1]).hexdigest() for lo, hi in zip([0, *stops], stops)]
        n_groups = np.diff(np.r_[0, np.cumsum(cut)[stop_a - 1]])
        rows = list(zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), digests))
        return rows, links >> 32, links & 0xFFFFFFFF, times


_DOC = pa.struct([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string())])
_BLOCK = pa.schema(
    [("block", pa.int64()), ("docs", pa.list_(_DOC)), ("stops", pa.binary()), ("at", pa.binary()), ("times", pa.binary()),
     ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]
)
_BLOCK_SQL = (
    "block bigint, docs array<struct<doc_id: bigint, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string>>, "
    "stops binary, at binary, times binary, a array<int>, b array<int>, n array<int>"
)
NOTHING = (0, 0, 0, 0, "")


def _blocks(batches: Iterator[pa.RecordBatch], pair: Callable[[], Pair]) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive documents: a row per block with its documents and a sparse matrix of documents by distinct linked pairs."""
    both, number = pair(), TaskContext.get().partitionId() << 32
    held = Held()
    for batch in batches:
        sizes = pa.compute.utf8_length(batch.column("text").fill_null("")).to_numpy(zero_copy_only=False)
        lo, names = 0, batch.column("id").to_pylist()
        while lo < len(sizes):
            hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), PART, "right")) + lo)
            texts = both.encode(batch.column("text").slice(lo, hi - lo).to_pylist())
            held.add(both.texts, names[lo:hi], texts, int(sizes[lo:hi].sum()))
            if held.size >= BLOCK:
                yield held.row(number)
                held, number = Held(), number + 1
            lo = hi
    if held.docs:
        yield held.row(number)


class Held:
    """Documents of a block so far."""

    def __init__(self):
        self.docs, self.size, self.parts = [], 0, []

    def add(self, texts: Texts, names: list, ids: list, size: int) -> None:
        good = [i for i, x in enumerate(ids) if x is not None]
        rows = [NOTHING] * len(ids)
        if good:
            found, text, pair, times = texts.align([ids[i] for i in good])
            for i, row in zip(good, found):
                rows[i] = row
            self.parts.append((np.array(good)[text] + len(self.docs), pair, times))
        self.docs += [dict(zip(_DOC.names, (name, *row))) for name, row in zip(names, rows)]
        self.size += size

    def row(self, number: int) -> pa.RecordBatch:
        text, pair, times = (np.concatenate([p[k] for p in self.parts] or [np.zeros(0, np.int64)]) for k in range(3))
        pairs, at, n = np.unique(pair, return_inverse=True, return_counts=True)
        stops = np.searchsorted(text, np.arange(len(self.docs)), "right")
        # Smaller numbers, which pack better: the steps between a text's pairs.
        step = np.diff(at, prepend=0)
        begin = np.r_[0, stops[:-1]]
        begin = begin[begin < stops]
        step[begin] = at[begin]
        values = [number, self.docs, *(x.astype("<u4").tobytes() for x in (stops, step, times)), pairs >> 16, pairs & 0xFFFF, n]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK)], schema=_BLOCK)


_RESULT = [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", "string")]


def _results(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of a block with the sums over their links of the corpus-wide counts."""
    size = len(counts)
    count, best = np.zeros((2, size), np.int64)
    at = counts.column("at").to_numpy()
    count[at], best[at] = counts.column("count").to_numpy(), counts.column("best").to_numpy()
    docs = block.column("docs").combine_chunks().flatten()
    stops, step, times = (np.frombuffer(block.column(c)[0].as_py(), "<u4").astype(np.int64) for c in ("stops", "at", "times"))
    begin = np.r_[0, stops[:-1]]
    # Undo the steps: a running sum that starts anew at every text.
    total = np.r_[0, np.cumsum(step)]
    at = total[1:] - np.repeat(total[begin], stops - begin)
    sums = [np.diff(np.r_[0, np.cumsum(times * x[at])][np.r_[0, stops]]) for x in (best, count)]
    fields = dict(zip(_DOC.names, docs.flatten())) | {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
    return pa.table({name: fields[name] for name, _ in _RESULT})


def token_alignment(
    docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: how the tokens of two tokenizers line up in a space and its text.

    ``path_a`` is a byte-level BPE file, ``path_b`` a SentencePiece model. Byte offsets where
    tokens of both end cut them into groups (``n_groups``, ``groups_sha256``); tokens that
    share a byte are linked (``n_links``). A pair's count is the number of documents that
    link it. ``count_sum`` adds the counts of a document's links, ``n_best`` counts links whose
    count is the highest of their A token.

    Blocks of documents are named by their distinct pairs before anything is shuffled, so a
    pair crosses the network once per block, however many documents hold it; documents keep a sparse
    row over their block's pairs. NULL and empty texts, and texts that tokens do not spell out
    (such as those with the space symbol itself), have zeros and an empty digest. Ids may be NULL or repeated:
    every row gives a row and counts as a document. An empty table gives none. Other
    columns are not read. A text longer than a block is one block.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    blocks = scratch.keep(rows.mapInArrow(lambda it: _blocks(it, lambda: tokenizers(path_a, path_b)), _BLOCK_SQL), "blocks")
    linked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("at", "x")).select("block", "at", "x.a", "x.b", "x.n")
    counts = scratch.keep(linked.groupBy("a", "b").agg(F.sum("n").alias("count")), "counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("most"))
    scored = counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best"))
    found = linked.select("block", "at", "a", "b").join(scored, ["a", "b"]).select(F.col("block").alias("name"), "at", "count", "best")
    texts = blocks.select("block", "docs", "stops", F.col("at"), "times")
    schema = ", ".join(f"{name} {kind}" for name, kind in _RESULT)
    return texts.groupBy("block").cogroup(found.groupBy("name")).applyInArrow(_results, schema)
