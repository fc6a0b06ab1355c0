"""SentencePiece encoding by sampled segmentations without replacement, and decoding.

A text's segmentations form a tree: a node is a prefix of pieces, a leaf a whole
segmentation. Gumbel top-k gives each leaf its log probability plus Gumbel noise and takes
the k largest. The noise is drawn from the top: a subtree's largest perturbed value is a
Gumbel variable at the subtree's log probability, bounded by its parent's value. The
search expands, as A* does, the subtree with the largest value, which is known exactly
because the lattice gives every subtree's probability. All other pieces at a node wait as
one group, so one expansion yields one new segmentation and a group per piece of it.
"""
from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import give_back

# Characters of text whose lattices are built together.
BLOCK = 1 << 17
MARK = "▁"
# Pieces with a score below this are not used, but for single characters.
UNUSED = -1e8


def _mix(x: np.ndarray) -> np.ndarray:
    """In place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _uniform(seed: np.ndarray, counter: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on seed and counter only, not on how rows are batched."""
    bits = _mix(counter.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bits += seed
    u = (_mix(bits) >> np.uint64(12)).astype(np.float64)
    u += 0.5
    u *= 2.0**-52
    return u


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] numbers), then the same for each next entry."""
    if not len(start):
        return np.zeros(0, np.int64)
    out = np.repeat(start - np.cumsum(count) + count, count)
    out += np.arange(len(out))
    return out


class Lexicon:
    """Pieces of a model as a trie in sorted arrays, with a log probability each.

    Models without probabilities (BPE) name pieces by merge rank r; they get Zipf's
    probability, in proportion to 1 / (r + 2). Others keep their scores. ``power`` scales log
    probabilities: below 1 flattens, above 1 sharpens.
    """

    def __init__(self, path: str, power: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        score = np.array([sp.get_score(i) for i in range(n)])
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) and (score[i] > UNUSED or len(sp.id_to_piece(i)) == 1)]
        usual = score[plain][score[plain] > UNUSED]
        ranked = bool((usual == np.round(usual)).all())
        score = np.maximum(score, usual.min())
        self.log = power * (-np.log(2 - score) if ranked else score)
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.byte_log = float(self.log[plain].min())
        self.unknown = sp.unk_id()
        self.bytes_known = all(sp.is_byte(int(i)) for i in self.byte)
        pieces = [sp.id_to_piece(i) for i in plain]
        # Characters by number; 0 are those that no piece has, and the end of a unit.
        letter = {c: k + 1 for k, c in enumerate(sorted(set("".join(pieces))))}
        self.letter = np.zeros(max(map(ord, letter), default=0) + 2, np.int32)
        self.letter[[ord(c) for c in letter]] = list(letter.values())
        self.bits = len(letter).bit_length()
        step, piece = {}, [-1]
        for i, text in zip(plain, pieces):
            node = 0
            for c in text:
                key = node << self.bits | letter[c]
                if key not in step:
                    step[key] = len(piece)
                    piece.append(-1)
                node = step[key]
            piece[node] = i
        self.piece = np.array(piece, np.int32)
        # Half as wide where they fit.
        kind = np.int32 if len(piece) << self.bits < 1 << 31 else np.int64
        key, child = np.fromiter(step, kind, len(step)), np.fromiter(step.values(), kind, len(step))
        self.inner = np.zeros(len(piece), bool)
        self.inner[key >> self.bits] = True
        # Where the root goes to by letter; -1: nowhere.
        self.root = np.full(len(letter) + 1, -1, kind)
        self.root[key[key >> self.bits == 0]] = child[key >> self.bits == 0]
        self._hash(key, child)
        # What decoding puts for each id.
        shown = [b"" if sp.is_control(i) else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        self.shown = np.array(shown, object)

    def _hash(self, key: np.ndarray, child: np.ndarray) -> None:
        """The trie's steps as an open-addressed table."""
        bits = int(len(key)).bit_length() + 2
        self.whole = np.dtype(f"u{key.itemsize}").type
        self.shift, self.mask = self.whole(8 * key.itemsize - bits), (1 << bits) - 1
        self.keys, self.children = np.full(1 << bits, -1, key.dtype), np.zeros(1 << bits, child.dtype)
        left = np.arange(len(key))
        slot = self._slot(key)
        while len(left):
            _, one = np.unique(slot[left], return_index=True)
            one = left[one]
            one = one[self.keys[slot[one]] < 0]
            self.keys[slot[one]], self.children[slot[one]] = key[one], child[one]
            left = left[self.keys[slot[left]] != key[left]]
            slot[left] = slot[left] + 1 & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        slot = key.view(self.whole) * self.whole(0x9E3779B97F4A7C15 >> 64 - 8 * key.itemsize | 1)
        slot >>= self.shift
        return slot.view(key.dtype)

    def step(self, node: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes go on with these characters (by number), and where those go to."""
        key = node << self.bits
        key |= letter
        slot = self._slot(key)
        found = self.keys[slot]
        hit = found == key
        lost = np.flatnonzero(hit < (found >= 0))
        while len(lost):
            slot[lost] = further = slot[lost] + 1 & self.mask
            found = self.keys[further]
            same = found == key[lost]
            hit[lost] = same
            lost = lost[same < (found >= 0)]
        at = np.flatnonzero(hit)
        return at, self.children[slot[at]]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids; the space put before the first word is taken off."""
        text = b"".join(self.shown[ids].tolist())
        return text[1:] if text[:1] == b" " else text


def units(text: str) -> list[str]:
    """Parts of a text that no piece crosses: each word with all spaces before it, and what follows a line break.

    Runs of spaces stay together, as pieces of several spaces exist.
    """
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " ":
        return (MARK + text.replace(" ", " " + MARK)).replace("\n", " \n").split(" ")
    return _UNIT.findall(MARK + text.replace(" ", MARK))


_UNIT = re.compile(f"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*")


class Lattice:
    """All segmentations of a block's distinct units: edges by start position, with conditional probabilities."""

    def __init__(self, lexicon: Lexicon, words: list[str]):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.first = (np.cumsum(self.size) - self.size).astype(np.int32)
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
        n = len(code)
        stop = np.repeat(self.first + self.size.astype(np.int32), self.size)
        letter = lexicon.letter[np.minimum(code, len(lexicon.letter) - 1)]
        node = lexicon.root[letter]
        at = np.flatnonzero(node >= 0).astype(np.int32)
        node, levels, length, many = node[at], [], 1, np.zeros(n, np.int32)
        while True:
            whole = lexicon.piece[node]
            ends = np.flatnonzero(whole >= 0)
            begin = at[ends]
            levels.append((begin, whole[ends]))
            many[begin] += 1
            more = np.flatnonzero(lexicon.inner[node])
            at, node = at[more], node[more]
            more = np.flatnonzero(at + length < stop[at])
            at, node = at[more], node[more]
            if not len(at):
                break
            hit, node = lexicon.step(node, letter[at + length])
            at, length = at[hit], length + 1
        lone = np.ones(n, bool)
        lone[levels[0][0]] = False
        lone = np.flatnonzero(lone).astype(np.int32)
        many[lone] += 1
        # A character that is no piece itself is given byte by byte.
        text = [chr(c).encode() for c in code[lone].tolist()]
        given = [lexicon.byte[list(t)] if lexicon.bytes_known else np.array([lexicon.unknown]) for t in text]
        self.lone_size = np.array([len(g) for g in given], np.int64)
        self.lone = np.concatenate([np.zeros(0, np.int64), *given])
        # Edges by start, longest piece first; starts at one distance from the unit's end together, nearest first.
        distance = stop - np.arange(n, dtype=np.int32)
        most = int(distance.max(initial=0))
        order = np.argsort(distance.astype(np.uint16 if most < 1 << 16 else np.int32), kind="stable").astype(np.int32)
        width = many[order]
        heads = np.r_[0, np.cumsum(width, dtype=np.int64)]
        self.edges_at, self.many = np.empty(n, np.int32), many
        self.edges_at[order] = heads[:-1]
        total, free = int(heads[-1]), self.edges_at.copy()
        self.start, self.end, self.piece = np.repeat(order, width), np.empty(total, np.int32), np.empty(total, np.int32)
        for k in range(len(levels), 0, -1):
            begin, piece = levels[k - 1]
            slot = free[begin]
            self.end[slot], self.piece[slot] = begin + np.int32(k), piece
            free[begin] = slot + 1
        self.end[free[lone]], self.piece[free[lone]] = lone + 1, -1 - np.arange(len(lone), dtype=np.int32)
        log = lexicon.log[np.maximum(self.piece, 0)]
        if len(lone):
            other = np.flatnonzero(self.piece < 0)
            log[other] = lexicon.byte_log * self.lone_size[-1 - self.piece[other]]
        self.last = self.end == stop[self.start]
        self._weigh(log, order, width, heads, np.r_[0, np.cumsum(np.bincount(distance, minlength=most + 1)[1:])])

    def _weigh(self, log: np.ndarray, order: np.ndarray, width: np.ndarray, heads: np.ndarray, bounds: np.ndarray) -> None:
        """Probability of each edge among all ways to go on from its start; positions at one distance from the end together."""
        n = len(order)
        # The place after all of them stands for the end of a unit.
        ahead, follow = np.zeros(n + 1), np.where(self.last, np.int32(n), self.end)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            part = slice(heads[lo], heads[hi])
            group = heads[lo:hi] - heads[lo]
            value = ahead[follow[part]]
            value += log[part]
            top = np.maximum.reduceat(value, group)
            value -= np.repeat(top, width[lo:hi])
            ahead[order[lo:hi]] = top + np.log(np.add.reduceat(np.exp(value, out=value), group))
        self.log = ahead[follow]
        self.log += log
        self.log -= np.repeat(ahead[order], width)
        self.p = np.exp(self.log)
        self.cut = np.cumsum(self.p)
        first = heads[:-1]
        self.cut -= np.repeat(self.cut[first] - self.p[first], width)
        self.cut[heads[1:] - 1] = np.inf
        # What the other edges of a start have together: added up where taking it from 1 would lose it.
        self.left, most = 1 - self.p, self.p > 0.5
        others = np.add.reduceat(np.where(most, 0.0, self.p), first) if n else np.zeros(0)
        self.left[most] = np.repeat(others, width)[most]

    def walk(self, rows: np.ndarray, at: np.ndarray, seed: np.ndarray, counter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sample edges from position ``at`` to the end of the unit, for all (distinct) rows step by step; (rows, edges) in order of rows."""
        steps = np.zeros(int(rows.max(initial=-1)) + 1, np.int64)
        found, step = [], 0
        while len(rows):
            u = _uniform(seed, counter + np.uint64(step))
            edge = self.edges_at[at]
            short = np.flatnonzero(self.cut[edge] < u)
            while len(short):
                edge[short] += 1
                short = short[self.cut[edge[short]] < u[short]]
            found.append((rows, edge))
            last, step = self.last[edge], step + 1
            steps[rows[last]] = step
            on = np.flatnonzero(~last)
            rows, at, seed, counter = rows[on], self.end[edge[on]], seed[on], counter[on]
        slot = np.cumsum(steps) - steps
        out = np.empty(int(steps.sum()), np.int32)
        for step, (rows, edge) in enumerate(found):
            out[slot[rows] + step] = edge
        return np.repeat(np.arange(len(steps)), steps), out

    def ids(self, edges: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive runs of edges, and how many each run has."""
        piece = self.piece[edges]
        other = np.flatnonzero(piece < 0)
        if not len(other):
            return piece, size
        which = -1 - piece[other]
        many = np.ones(len(piece), np.int64)
        many[other] = self.lone_size[which]
        out, place = np.repeat(piece, many), np.cumsum(many)
        at = np.cumsum(self.lone_size) - self.lone_size
        out[_ranges((place - many)[other], many[other])] = self.lone[_ranges(at[which], many[other])]
        return out, np.diff(np.r_[0, place[np.cumsum(size) - 1]])


class Path:
    """One segmentation of one text: its edges, log probability up to each, and the values of the groups left beside them."""

    __slots__ = ("row", "edge", "before", "value", "top", "tried", "split")

    def __init__(self, row, edge, before, value, top, split, tried):
        self.row, self.edge, self.before, self.value, self.top, self.split, self.tried = row, edge, before, value, top, split, tried


# Counters of random numbers: what for, sample, then place.
ROOT, GROUP, CHOICE, WALK = (np.uint64(k) << np.uint64(60) for k in range(4))


def _place(kind: np.uint64, sample: int, place: np.ndarray) -> np.ndarray:
    return np.uint64(kind) + (np.uint64(sample) << np.uint64(52)) + place.astype(np.uint64)


def _bounded(log_mass: np.ndarray, bound, u: np.ndarray) -> np.ndarray:
    """Largest of Gumbel noise on a mass, given that it is at most ``bound``."""
    with np.errstate(over="ignore"):
        return log_mass - np.log(np.exp(log_mass - bound) - np.log(u))


def sample_block(lexicon: Lexicon, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """Of each text up to k distinct segmentations, best perturbed value first: ids, log probability, log inclusion."""
    cut = [units(t) for t in texts]
    words = list(itertools.chain.from_iterable(cut))
    if not words:
        return [[] for _ in texts]
    index = dict.fromkeys(words)
    distinct = list(index)
    index.update(zip(distinct, range(len(distinct))))
    word = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    lattice = Lattice(lexicon, distinct)
    count = np.array([len(found) for found in cut], np.int64)
    first_row = np.cumsum(count) - count
    doc = np.repeat(np.arange(len(texts)), count)
    place = (np.arange(len(word)) - first_row[doc]) << 20
    seeds = seeds.astype(np.uint64)
    everything = np.arange(len(word))
    paths: list[list[Path]] = [[] for _ in texts]

    def finish(docs: list[int], sample: int, made: list[tuple]) -> None:
        """Values of the groups beside each new path's edges from its split on."""
        rows = np.concatenate([m[0][m[3]:] for m in made])
        edges = np.concatenate([m[1][m[3]:] for m in made])
        before = np.concatenate([m[2][m[3]:] for m in made])
        size = np.array([len(m[1]) - m[3] for m in made])
        top = np.repeat([m[4] for m in made], size)
        left = lattice.left[edges]
        head = np.cumsum(size) - size
        left[head] = [m[6] for m in made]
        ok = left > 0
        u = _uniform(np.repeat(seeds[docs], size), _place(GROUP, sample, _ranges(np.array([m[3] for m in made]), size)))
        value = np.where(ok, _bounded(before + np.log(np.where(ok, left, 1.0)), top, u), -np.inf)
        for d, i, n, m in zip(docs, head, size, made):
            whole = np.full(len(m[1]), -np.inf)
            whole[m[3]:] = value[i:i + n]
            paths[d].append(Path(m[0], m[1], m[2], whole, m[4], m[3], m[5]))

    rows, edges = lattice.walk(everything, lattice.first[word], seeds[doc], _place(WALK, 0, place))
    bounds = np.searchsorted(doc[rows], np.arange(len(texts) + 1))
    log = lattice.log[edges]
    before = np.cumsum(log) - log
    some = [d for d in range(len(texts)) if count[d]]
    root = -np.log(-np.log(_uniform(seeds, _place(ROOT, 0, np.zeros(len(texts))))))
    made = []
    for d in some:
        part = slice(bounds[d], bounds[d + 1])
        made.append((rows[part], edges[part], before[part] - before[part.start], 0, root[d], edges[part][:1], lattice.left[edges[part.start]]))
    finish(some, 0, made)

    for sample in range(1, k):
        docs, chosen = [], []
        for d in some:
            best = max(paths[d], key=lambda p: p.value.max())
            t = int(best.value.argmax())
            if best.value[t] > -np.inf:
                docs.append(d)
                chosen.append((best, t))
        if not docs:
            break
        new, first_edges, untried = [], [], []
        u = _uniform(seeds[docs], _place(CHOICE, sample, np.zeros(len(docs))))
        for x, (path, t) in zip(u, chosen):
            at = lattice.start[path.edge[t]]
            tried = path.tried if t == path.split else path.edge[t:t + 1]
            options = np.arange(lattice.edges_at[at], lattice.edges_at[at] + lattice.many[at])
            for e in tried:
                options = options[options != e]
            weight = np.cumsum(lattice.p[options])
            pick = options[min(np.searchsorted(weight, x * weight[-1], side="right"), len(options) - 1)]
            first_edges.append(pick)
            untried.append(lattice.p[options[options != pick]].sum())
            new.append(np.r_[tried, pick])
        first_edges = np.array(first_edges)
        row = np.array([p.row[t] for p, t in chosen])
        inside = ~lattice.last[first_edges]
        # The rest of the unit where the path splits, and all later units.
        later = first_row[docs] + count[docs] - row - 1
        rest = _ranges(row + 1, later)
        start_rows = np.r_[row[inside], rest]
        start_at = np.r_[lattice.end[first_edges[inside]], lattice.first[word[rest]]]
        rows, edges = lattice.walk(start_rows, start_at, seeds[doc[start_rows]], _place(WALK, sample, place[start_rows]))
        lo, hi = np.searchsorted(doc[rows], docs), np.searchsorted(doc[rows], docs, side="right")
        made = []
        for i, (path, t) in enumerate(chosen):
            edge = np.concatenate([path.edge[:t], first_edges[i:i + 1], edges[lo[i]:hi[i]]])
            at_rows = np.concatenate([path.row[:t], row[i:i + 1], rows[lo[i]:hi[i]]])
            log = lattice.log[edge[t:]]
            before = np.concatenate([path.before[:t], path.before[t] + np.cumsum(log) - log])
            made.append((at_rows, edge, before, t, float(path.value[t]), new[i], untried[i]))
            path.value[t] = -np.inf
        finish(docs, sample, made)

    whole = [p for found in paths for p in found]
    ids, size = lattice.ids(np.concatenate([p.edge for p in whole]), np.array([len(p.edge) for p in whole]))
    ids = iter(np.split(ids, np.cumsum(size)[:-1]))
    out: list[list[tuple[np.ndarray, float, float]]] = []
    for found in paths:
        limit = max((p.value.max() for p in found), default=-np.inf)
        rows_out = []
        for p in found:
            log = float(p.before[-1] + lattice.log[p.edge[-1]])
            with np.errstate(over="ignore", divide="ignore"):
                included = float(np.log(-np.expm1(-np.exp(log - limit)))) if limit > -np.inf else 0.0
            rows_out.append((next(ids), log, included))
        out.append(rows_out)
    return out


@functools.lru_cache(maxsize=2)
def lexicon(path: str, power: float = 1.0) -> Lexicon:
    return Lexicon(path, power)


SAMPLED = "id string, sample int, n_tokens long, log_prob double, log_inclusion double, exact boolean, ids binary"


def sampled_segmentations(
    docs: DataFrame, model_path: str, k: int = 2, power: float = 1.0, seed: int = 0, id_column: str = "doc_id", text_column: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """Up to k distinct segmentations per document, drawn without replacement in proportion to their probability.

    A row each: doc_id, sample (1: largest perturbed value), n_tokens, log_prob,
    log_inclusion (log probability that its perturbed value passes the k+1st, 0.0 where all
    segmentations were taken), exact (decoding gives the text back), ids (little-endian unsigned
    32-bit). ``with_text`` adds text, what the ids decode to, by the same worker (``decoded`` does it for stored
    ids). Draws depend on ``seed``, the id and the text's own places, not on partitions.

    NULL and empty texts give one row with sample 1, no ids, log_prob 0.0. Texts with fewer
    than k segmentations give what they have. Rows with a NULL id are seeded alike; repeated
    rows give equal rows. An empty table gives none. Other columns are not read. A
    map over rows; memory follows the longest single text.
    """

    schema = SAMPLED + ", text string" * with_text
    columns = [field.split()[0] for field in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = lexicon(model_path, power)
        for frame in frames:
            lo = size = 0
            lengths = frame["text"].str.len().tolist()
            for i, n in enumerate(lengths):
                size += n
                if size >= BLOCK or i == len(lengths) - 1:
                    yield _sampled(words, frame.iloc[lo:i + 1], k)[columns]
                    lo, size = i + 1, 0
        give_back()

    rows = docs.select(
        F.col(id_column).cast("string").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.xxhash64(F.lit(seed), F.col(id_column).cast("string")).alias("seed"),
    )
    kind = docs.schema[id_column].dataType
    return rows.mapInPandas(run, schema).select(F.col("id").cast(kind).alias("doc_id"), *columns[1:])


def _sampled(words: Lexicon, frame: pd.DataFrame, k: int) -> pd.DataFrame:
    texts = frame["text"].tolist()
    out = []
    for name, text, found in zip(frame["id"], texts, sample_block(words, texts, frame["seed"].to_numpy(np.int64).view(np.uint64), k)):
        if not found:
            out.append((name, 1, 0, 0.0, 0.0, True, b"", ""))
            continue
        want = text.replace(MARK, " ").encode()
        for i, (ids, log, included) in enumerate(found):
            shown = words.decode(ids)
            out.append((name, i + 1, len(ids), log, included, shown == want, ids.astype("<u4").tobytes(), shown.decode("utf-8", "replace")))
    return pd.DataFrame(out, columns=["id", "sample", "n_tokens", "log_prob", "log_inclusion", "exact", "ids", "text"])


def decoded(model_path: str):
    """A function of a column of ids (little-endian unsigned 32-bit) giving the text; NULL gives NULL."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        words = lexicon(model_path)
        return pd.Series([None if x is None else words.decode(np.frombuffer(x, "<u4")).decode("utf-8", "replace") for x in ids], dtype=object)

    return decode
