"""Gated recurrent language model in numpy: truncated backpropagation, class-factored output, whole-document scores.

Word counts cover the whole corpus. The most frequent words have a place of their own in the
network, in classes of equal frequency rank; the others are told apart by the class of
their ending and, inside it, by their counts; words seen once stand for unseen ones. A word's
probability is that of its class times that inside the class, so they add up to one over all
known words and the unseen one.

Training is data-parallel: in each round every task learns from its own share of the
documents, and the parameters are averaged by Spark. Every training document is used once.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch

# Words with a place in the network, classes they fall into, and classes of endings for the others.
WORDS, CLASSES, ENDINGS = 960, 15, 32
HIDDEN = 16
# Streams trained side by side, steps that gradients flow back, steps scored together.
LANES, STEPS, WINDOW = 256, 16, 32
ROUNDS, RATE, CLIP = 8, 0.1, 1.0
# Characters of a block of documents, and numbers of the parameter vector that travel together.
BLOCK, PIECE = 1 << 24, 4096
END = b""
LN10 = np.log(10)


# --- the network -------------------------------------------------------------------------

SIZE = CLASSES * (WORDS // CLASSES)
KINDS = 1 + SIZE + ENDINGS + 1
RARE = KINDS - 1
# Output classes: the end, those of frequent words, endings, rare words.
OUTPUTS = 1 + CLASSES + ENDINGS + 1
WIDE = WORDS // CLASSES
SHAPES = {
    "into": (KINDS, 3 * HIDDEN), "again": (HIDDEN, 3 * HIDDEN), "to_class": (HIDDEN, OUTPUTS), "class_bias": (OUTPUTS,),
    "to_word": (CLASSES, HIDDEN, WIDE), "word_bias": (CLASSES, WIDE),
}
LENGTH = sum(int(np.prod(s)) for s in SHAPES.values())


def class_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids == 0, 0, np.where(ids <= SIZE, 1 + (ids - 1) // WIDE, ids - SIZE + CLASSES))


CLASS_OF = class_of(np.arange(KINDS))


def _begun(h: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """States with those before a document's start set to zero."""
    return np.where(fresh[:, None], np.float32(0), h) if fresh.any() else h


class Net:
    """Parameters as views into one vector."""

    def __init__(self, values: np.ndarray):
        self.values, at = values, 0
        for name, shape in SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, values[at:at + n].reshape(shape))
            at += n

    @classmethod
    def first(cls, counts: np.ndarray) -> Net:
        """Small fixed pseudo-random weights; biases that give every kind its share of the corpus."""
        net = cls(np.zeros(LENGTH, np.float32))
        random = np.random.default_rng(1)
        net.into[:] = random.normal(0, 0.1, net.into.shape)
        net.again[:] = random.normal(0, 0.2, net.again.shape)
        net.to_class[:], net.to_word[:] = random.normal(0, 0.1, net.to_class.shape), random.normal(0, 0.1, net.to_word.shape)
        classes = np.bincount(class_of(np.arange(KINDS)), counts, OUTPUTS)
        net.class_bias[:] = np.log((classes + 0.5) / (counts.sum() + 1))
        net.word_bias[:] = np.log(counts[1:SIZE + 1].reshape(CLASSES, WIDE) + 0.01)
        return net

    def large(self) -> list[bool]:
        """``_large`` of the classes' logits and of those inside each class."""
        return [bool(_large(self.to_class, self.class_bias)), *_large(self.to_word, self.word_bias).tolist()]

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """Next state, with what going back needs."""
        inner = h @ self.again
        gates = x[:, :2 * HIDDEN] + inner[:, :2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        keep, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = reset * inner[:, 2 * HIDDEN:]
        new += x[:, 2 * HIDDEN:]
        np.tanh(new, out=new)
        following = h - new
        following *= keep
        following += new
        return following, keep, reset, new, inner[:, 2 * HIDDEN:]

    def back(self, d: np.ndarray, h: np.ndarray, keep: np.ndarray, reset: np.ndarray, new: np.ndarray, inner: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients for the step's input (into ``out``), for its product with the state, and for the state before."""
        left, part = 1 - keep, new * new
        d_new = d * left
        np.subtract(1, part, out=part)
        d_new *= part
        out[:, 2 * HIDDEN:] = d_new
        np.subtract(h, new, out=part)
        part *= d
        part *= keep
        np.multiply(part, left, out=out[:, :HIDDEN])
        np.multiply(d_new, inner, out=part)
        part *= reset
        np.multiply(part, 1 - reset, out=out[:, HIDDEN:2 * HIDDEN])
        product = out.copy()
        product[:, 2 * HIDDEN:] *= reset
        before = product @ self.again.T
        before += d * keep
        return product, before


def _large(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Whether an exponential of logits can be too large; states lie between -1 and 1, so weights and bias bound the logits."""
    return np.abs(weights).sum(-2).max(-1) + np.abs(bias).max(-1) > 60


def _softmax(own: np.ndarray, weights: np.ndarray, bias: np.ndarray, large: bool, right: np.ndarray, n: int, grad: tuple[np.ndarray, np.ndarray] | None):
    """Log probability of the right column in each row; with ``grad``, adds to weights' and bias' gradients and gives the rows' own."""
    rows = np.arange(len(own))
    logits = own @ weights
    logits += bias
    chosen = logits[rows, right]
    if large:
        top = logits.max(1, keepdims=True)
        logits -= top
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], np.float32)
    log_p = chosen - np.log(total)
    if large:
        log_p -= top[:, 0]
    if grad is None:
        return log_p, None
    logits *= (1 / (n * total))[:, None]
    logits[rows, right] -= np.float32(1 / n)
    grad[0][:] += own.T @ logits
    grad[1][:] += np.ones(len(own), np.float32) @ logits
    return log_p, logits @ weights.T


def output(net: Net, h: np.ndarray, ids: np.ndarray, grad: Net | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each id's kind after state h; with ``grad``, adds gradients of the mean loss and gives the states'."""
    n, kind = len(ids), CLASS_OF[ids]
    large = net.large()
    log_p, d_h = _softmax(h, net.to_class, net.class_bias, large[0], kind, n, grad and (grad.to_class, grad.class_bias))
    order = np.argsort(kind.astype(np.uint8), kind="stable")
    edges = np.searchsorted(kind[order], np.arange(1, CLASSES + 2))
    for c in range(CLASSES):
        at = order[edges[c]:edges[c + 1]]
        if len(at):
            more, d = _softmax(h[at], net.to_word[c], net.word_bias[c], large[1 + c], ids[at] - 1 - c * WIDE, n, grad and (grad.to_word[c], grad.word_bias[c]))
            log_p[at] += more
            if grad:
                d_h[at] += d
    return log_p, d_h


def gradients(net: Net, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, fresh: np.ndarray) -> tuple[float, Net, np.ndarray, np.ndarray]:
    """Of one window (steps by lanes): loss, gradients, input rows whose gradients are set, and the state carried on.

    ``fresh`` marks inputs that start a document: the state before them is zero. No
    gradient flows into the state the window begins with.
    """
    steps, lanes = inputs.shape
    grad, kept, states = Net(np.zeros_like(net.values)), [], np.empty((steps, lanes, HIDDEN), h.dtype)
    x = net.into[inputs]
    for t in range(steps):
        h = _begun(h, fresh[t])
        following, *inside = net.step(x[t], h)
        kept.append((h, *inside))
        h = states[t] = following
    log_p, d_out = output(net, states.reshape(-1, HIDDEN), targets.ravel(), grad)
    d_out = d_out.reshape(states.shape)
    d, d_in, d_product = np.zeros_like(h), *np.empty((2, steps, lanes, 3 * HIDDEN), h.dtype)
    for t in range(steps - 1, -1, -1):
        d_product[t], d = net.back(d + d_out[t], *kept[t], d_in[t])
        d = _begun(d, fresh[t])
    before = np.stack([k[0] for k in kept]).reshape(-1, HIDDEN)
    grad.again[:] = before.T @ d_product.reshape(-1, 3 * HIDDEN)
    order = np.argsort(inputs.ravel().astype(np.uint16), kind="stable")
    sorted_ = inputs.ravel()[order]
    begin = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    rows = sorted_[begin]
    grad.into[rows] = np.add.reduceat(d_in.reshape(-1, 3 * HIDDEN)[order], begin)
    return float(-log_p.mean()), grad, rows, h


def train(net: Net, squares: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
    """One pass over a stream of documents' tokens, cut into lanes; ``ends`` are the places after documents."""
    inputs = np.r_[0, ids[:-1]].astype(np.int64)
    fresh = np.zeros(len(ids), bool)
    fresh[np.r_[0, ends[:-1]]] = True
    steps = -(-len(ids) // LANES)
    lanes = -(-len(ids) // steps)
    cut = len(ids) - (lanes - 1) * steps
    fold = lambda x: np.r_[x, np.repeat(x[-1:], steps - cut)].reshape(lanes, steps).T
    inputs, targets, fresh = fold(inputs), fold(ids.astype(np.int64)), fold(fresh)
    h = np.zeros((lanes, HIDDEN), np.float32)
    into = SHAPES["into"][0] * SHAPES["into"][1]
    sums = Net(squares)
    for t in range(0, steps, STEPS):
        window = slice(t, t + STEPS)
        # The last lane may be shorter.
        n = lanes if t + STEPS <= cut or lanes == 1 else lanes - 1
        _, grad, rows, h[:n] = gradients(net, inputs[window, :n], targets[window, :n], h[:n], fresh[window, :n])
        norm = float(np.sqrt(np.square(grad.values, dtype=np.float64).sum()))
        scale = np.float32(min(1.0, CLIP / max(norm, 1e-12)))
        part = grad.into[rows] * scale
        sums.into[rows] += part * part
        net.into[rows] -= RATE * part / np.sqrt(sums.into[rows] + 1e-8)
        rest = grad.values[into:] * scale
        squares[into:] += rest * rest
        net.values[into:] -= RATE * rest / np.sqrt(squares[into:] + 1e-8)


def score(net: Net, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Natural log probability of each document's kinds.

    Whole documents are dealt to lanes, the longest first; a lane's state is carried from
    window to window and set to zero where a document starts.
    """
    sizes = np.diff(np.r_[0, ends])
    begin = ends - sizes
    heap = [(0, lane) for lane in range(min(LANES, len(sizes)))]
    lists: list[list[int]] = [[] for _ in heap]
    for doc in np.argsort(-sizes, kind="stable").tolist():
        load, lane = heapq.heappop(heap)
        lists[lane].append(doc)
        heapq.heappush(heap, (load + int(sizes[doc]), lane))
    lists.sort(key=lambda docs: -int(sizes[docs].sum()))
    loads = np.array([int(sizes[docs].sum()) for docs in lists])
    place = np.zeros((loads[0], len(lists)), np.uint32)
    for lane, docs in enumerate(lists):
        place[:loads[lane], lane] = np.concatenate([np.arange(begin[d], ends[d]) for d in docs])
    of = np.repeat(np.arange(len(sizes)), sizes)
    fresh = np.zeros(len(ids), bool)
    fresh[begin] = True
    inputs = np.r_[0, ids[:-1]].astype(np.int64)
    total = np.zeros(len(sizes))
    h = np.zeros((len(lists), HIDDEN), np.float32)
    for t in range(0, loads[0], WINDOW):
        states, at = [], []
        for row in range(t, min(t + WINDOW, loads[0])):
            n = int(np.searchsorted(-loads, -row, "left"))
            places = place[row, :n]
            h = net.step(net.into[inputs[places]], _begun(h[:n], fresh[places]))[0]
            states.append(h)
            at.append(places)
        at = np.concatenate(at)
        log_p, _ = output(net, np.concatenate(states), ids[at].astype(np.int64))
        total += np.bincount(of[at], log_p, len(sizes))
    return total


# --- the corpus --------------------------------------------------------------------------

_CUT = pa.schema(
    [("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.binary()), ("numbers", pa.binary()),
     ("once", pa.binary()), ("words", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))]
)
_CUT_SQL = "block bigint, docs array<bigint>, held array<boolean>, sizes binary, numbers binary, once binary, words array<string>, n array<bigint>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive documents as numbers of the block's distinct words, with their counts in training documents."""
    number, held = TaskContext.get().partitionId() << 32, Words()
    for batch in batches:
        for name, learn, text in zip(*(batch.column(c).to_pylist() for c in ("id", "learn", "text"))):
            held.add(name, learn, text or "")
            if held.size >= BLOCK:
                yield held.row(number)
                number, held = number + 1, Words()
    if held.docs:
        yield held.row(number)


class Numbers(dict):
    """Words by number; one that is asked for the first time gets the next."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Words:
    def __init__(self):
        self.numbers, self.docs, self.held, self.at, self.size = Numbers({END: 0}), [], [], [], 0

    def add(self, name: int | None, learn: bool, text: str) -> None:
        words = text.encode().lower().split()
        words.append(END)
        self.at.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.docs.append(name)
        self.held.append(not learn)
        self.size += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        seen = [a for a, held in zip(self.at, self.held) if not held]
        n = np.bincount(np.concatenate(seen or [np.zeros(0, np.uint32)]), minlength=len(self.numbers))
        sizes = np.array([len(a) for a in self.at], "<u4").tobytes()
        # All low bytes first, then the next ones: high bytes are mostly zero and pack well.
        numbers = np.concatenate(self.at).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
        values = [number, self.docs, self.held, sizes, numbers, np.packbits(n == 1).tobytes(), list(self.numbers), n]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _CUT)], schema=_CUT)


class Corpus:
    """What scoring knows of the corpus: totals, the frequent words, and the counts of kinds."""

    def __init__(self, counts: DataFrame):
        seen = counts.filter("c > 0")
        self.n, self.v, n1, n2 = seen.agg(
            F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if((F.col("c") == 1) & (F.col("word") != "")), F.count_if(F.col("c") == 2),
        ).first()
        frequent = seen.filter("c > 1 and word != ''").orderBy(F.desc("c"), "word").limit(SIZE).collect()
        self.top = {w: i + 1 for i, (w, _) in enumerate(frequent)}
        other = seen.filter("c > 1 and word != ''")
        if frequent:
            word, c = frequent[-1]
            other = other.filter((F.col("c") < c) | ((F.col("c") == c) & (F.col("word") > word)))
        endings = other.groupBy((F.crc32(F.right("word", F.lit(2))) % ENDINGS).alias("e")).agg(F.sum("c")).collect()
        self.counts = np.zeros(KINDS)
        self.counts[[i + 1 for i in range(len(frequent))]] = [c for _, c in frequent]
        for e, c in endings:
            self.counts[SIZE + 1 + e] = c
        self.counts[0] = next((c for (c,) in seen.filter("word = ''").select("c").collect()), 0)
        self.counts[RARE] = n1
        # Good-Turing: unseen words against those seen once.
        unseen = n1 / (n1 + 2 * n2 + 1) if n1 else 1.0
        self.once, self.unseen = np.log10((1 - unseen) / n1) if n1 else 0.0, np.log10(unseen)

    def kinds(self, counts: DataFrame) -> DataFrame:
        """Known words with their counts and kinds."""
        top = counts.sparkSession.createDataFrame(list(self.top.items()), "word string, place int")
        ending = SIZE + 1 + F.crc32(F.right("word", F.lit(2))) % ENDINGS
        kind = F.when(F.col("word") == "", 0).when(F.col("place").isNotNull(), F.col("place")).when(F.col("c") > 1, ending).otherwise(RARE)
        # At most SIZE rows.
        return counts.filter("c > 0").join(F.broadcast(top), "word", "left").select("word", "c", kind.cast("int").alias("kind"))

    def logs(self, kind: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words: log10 probability inside the kind, log10 of the add-0.1 estimate."""
        other = (kind > SIZE) & (kind != RARE)
        inside = np.where(kind == RARE, np.where(c == 1, self.once, self.unseen), 0.0)
        inside[other] = np.log10(c[other] / self.counts[kind[other]])
        return inside, np.log10((c + 0.1) / (self.n + 0.1 * (self.v + 1)))


_DOC = pa.struct([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("inside", pa.float64()),
])
_SCORED = "doc_id held_out n_tokens n_known train_tokens base_score score"
# Documents in the order of their rounds, those held out last; per round token counts and kinds.
_CODED = pa.schema([("docs", pa.list_(_DOC)), *[(f"{c}{r}", pa.binary()) for r in range(ROUNDS + 1) for c in ("sizes", "kinds")]])
_CODED_SQL = (
    "docs array<struct<doc_id: bigint, held_out: boolean, n_tokens: bigint, n_known: bigint, base_score: double, inside: double>>, "
    + ", ".join(f"{c}{r} binary" for r in range(ROUNDS + 1) for c in ("sizes", "kinds"))
)


def _coded(block: pa.Table, counts: pa.Table, corpus: Corpus) -> pa.Table:
    sizes = np.frombuffer(block.column("sizes")[0].as_py(), "<u4").astype(np.int64)
    at = np.frombuffer(block.column("numbers")[0].as_py(), np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]
    # A word without a row is known from this block alone, where it stands once, or not at all.
    c = np.unpackbits(np.frombuffer(block.column("once")[0].as_py(), np.uint8)).astype(np.int64)
    kind = np.full(len(c), RARE)
    sent = counts.column("at").to_numpy()
    c[sent], kind[sent] = counts.column("c").to_numpy(), counts.column("kind").to_numpy()
    kind[0] = 0
    inside, base = corpus.logs(kind, c)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    sums = [np.add.reduceat(x[at], begin) for x in (base, inside, (c > 0).astype(np.int64))]
    held = np.array(block.column("held")[0].as_py(), bool)
    part = np.where(held, ROUNDS, np.arange(len(sizes)) % ROUNDS)
    kind = kind.astype("<u2")
    order = np.argsort(part, kind="stable")
    names = block.column("docs")[0].as_py()
    docs = [
        {"doc_id": names[i], "held_out": bool(held[i]), "n_tokens": int(sizes[i]), "n_known": int(sums[2][i]), "base_score": float(sums[0][i]), "inside": float(sums[1][i])}
        for i in order
    ]
    values = [docs]
    for r in range(ROUNDS + 1):
        own = order[part[order] == r]
        values += [sizes[own].astype("<u4").tobytes(), b"".join(kind[at[begin[i]:ends[i]]].tobytes() for i in own)]
    return pa.table([pa.array([v], f.type) for v, f in zip(values, _CODED)], schema=_CODED)


def _streams(frame: pd.DataFrame, r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for sizes, kinds in zip(frame[f"sizes{r}"], frame[f"kinds{r}"]):
        if len(sizes):
            yield np.frombuffer(kinds, "<u2"), np.cumsum(np.frombuffer(sizes, "<u4").astype(np.int64))


def _round(coded: DataFrame, r: int, state: np.ndarray) -> np.ndarray:
    """Parameters and their summed squared gradients after round r: the mean over tasks, by tokens."""
    shared = coded.sparkSession.sparkContext.broadcast(state)

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, n = shared.value.astype(np.float32), 0
        net = Net(own[:LENGTH])
        for frame in frames:
            for ids, ends in _streams(frame, r):
                train(net, own[LENGTH:], ids, ends)
                n += len(ids)
        if n:
            # Rows that each stand for one piece of the vector; the last number is the weight.
            whole = np.append(own.astype(np.float64) * n, n)
            yield pd.DataFrame({"piece": range(0, len(whole), PIECE), "values": [whole[i:i + PIECE].tobytes() for i in range(0, len(whole), PIECE)]})

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for piece, values in zip(frame["piece"], frame["values"]):
                sums[piece] = sums.get(piece, 0) + np.frombuffer(values)
        yield pd.DataFrame({"piece": list(sums), "values": [x.tobytes() for x in sums.values()]})

    pieces = coded.select(f"sizes{r}", f"kinds{r}").mapInPandas(learn, "piece bigint, values binary")
    found = pieces.repartition("piece").mapInPandas(added, "piece bigint, values binary").collect()
    shared.destroy()
    whole = np.concatenate([np.frombuffer(values) for _, values in sorted(map(tuple, found))] or [np.append(state, 1.0)])
    return whole[:-1] / whole[-1]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Blocks scored together, so that a very long document runs beside enough others."""
    held, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            held.append(batch.slice(i, 1))
            size += held[-1].nbytes
            if size >= BLOCK:
                yield held
                held, size = [], 0
    if held:
        yield held


def recurrent_scores(docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Log10 probability of every whole text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words lie between ASCII white space, A-Z in lower case; every text ends with one end token.
    Documents where ``learn`` holds are learned from (NULL counts as false), all are scored. ``base_score`` is the
    add-0.1 estimate of single words, ``score`` that of the network, whose state runs through the
    whole document. NULL and empty texts are one end token. Ids may be NULL or repeated: every row counts
    and gives a row. Nothing to learn from: ``score`` is ``base_score``. An empty table gives no rows.
    Other columns are not read.

    Counts, classes and training cover all training documents. Only the WORDS most frequent words, the totals
    of classes, and parameter vectors (fixed size) reach the driver. A block's distinct words are counted
    before the shuffle, so a frequent word crosses the network once per block.
    """
    scratch = Scratch(docs.sparkSession, "recurrent")
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_column).alias("text"))
    blocks = scratch.keep(rows.mapInArrow(_blocks, _CUT_SQL), "blocks")
    words = blocks.select("block", F.posexplode(F.arrays_zip("words", "n")).alias("at", "x")).select("block", "at", "x.words", "x.n")
    words = words.withColumnRenamed("words", "word")
    counts = scratch.keep(words.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    corpus = Corpus(counts)
    seen = words.join(corpus.kinds(counts), "word").filter("c > 1 or n = 0").select(F.col("block").alias("name"), "at", "c", "kind")
    texts = blocks.drop("words", "n")
    coded = texts.groupBy("block").cogroup(seen.groupBy("name")).applyInArrow(lambda a, b: _coded(a, b, corpus), _CODED_SQL)
    coded = scratch.keep(coded, "coded")
    scratch.drop(blocks, counts)
    learned = None
    if corpus.n:
        state = np.r_[Net.first(corpus.counts).values, np.zeros(LENGTH)].astype(np.float64)
        for r in range(ROUNDS):
            state = _round(coded, r, state)
        learned = docs.sparkSession.sparkContext.broadcast(state[:LENGTH].astype(np.float32))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches):
            docs = pa.concat_arrays([r.column("docs")[0].values for r in rows]).flatten()
            docs = dict(zip(_DOC.names, docs))
            total = docs["base_score"]
            if learned is not None:
                sizes, kinds = (b"".join(r.column(f"{c}{k}")[0].as_py() for r in rows for k in range(ROUNDS + 1)) for c in ("sizes", "kinds"))
                found = score(Net(learned.value), np.frombuffer(kinds, "<u2"), np.cumsum(np.frombuffer(sizes, "<u4").astype(np.int64)))
                total = pa.array(found / LN10 + docs["inside"].to_numpy(zero_copy_only=False))
            trained = pa.repeat(pa.scalar(corpus.n, pa.int64()), len(total))
            values = [*(docs[c] for c in ("doc_id", "held_out", "n_tokens", "n_known")), trained, docs["base_score"], total]
            yield pa.RecordBatch.from_arrays(values, _SCORED.split(" "))

    kinds = dict(zip(_SCORED.split(" "), ("bigint", "boolean", "bigint", "bigint", "bigint", "double", "double")))
    return coded.mapInArrow(scored, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))
