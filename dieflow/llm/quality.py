"""Quality scores by positive-unlabelled learning with a non-negative risk."""
from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch
from dieflow.llm.words import pieces

# Bytes counted together, each a share of the text.
GROUPS = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "space": b" ", "line": b"\n",
    "stop": b".,;:", "shout": b"!?", "bar": b"|/\\", "sign": b"#$%&*@^~+=_<>", "bracket": b"()[]{}\"'`-",
    "control": bytes([*range(10), *range(11, 32), 127]), "wide": bytes(range(128, 256)),
}
# Shares that are telling when small; also given as x / (x + SMALL).
RARE = ["upper", "digit", "shout", "bar", "sign", "bracket", "control", "repeat"]
SMALL = 0.05
NAMES = [*GROUPS, "repeat", "word", "long", *RARE]
WIDTH = len(NAMES) + 1
RIDGE, STEPS, TOLERANCE = 1e-3, 20, 1e-5
BINS = 400
# Upper score tails holding at least this share of the positives are used to estimate the prior. The
# smallest of noisy ratios is a little too small, which only lowers the scores of clear positives; a
# prior that is too large would make clear negatives look good.
LEAST_TAIL = 0.5
LEAST_PRIOR, MOST_PRIOR = 0.02, 0.98

_GROUP = np.zeros((256, len(GROUPS)))
for _k, _bytes in enumerate(GROUPS.values()):
    _GROUP[list(_bytes), _k] = 1


def features(text: str | None) -> np.ndarray:
    """Features of a whole text, 1.0 last; all are zero but the last for an empty one."""
    counts, words, repeats = np.zeros(256), 0, 0
    for piece in pieces(text or ""):
        counts += np.bincount(np.frombuffer(piece.encode(), np.uint8), minlength=256)
        found = piece.split()
        words += len(found)
        repeats += sum(map(eq, found, found[1:]))
    size = counts.sum()
    shares = counts @ _GROUP / max(size, 1)
    x = np.array([*shares, repeats / max(words, 1), min(4.0, size / max(words, 1) / 10), np.log1p(size) / 10])
    rare = x[[NAMES.index(n) for n in RARE]]
    return np.concatenate([x, rare / (rare + SMALL), [1.0]])


def _describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(x=[features(t).astype("<f4").tobytes() for t in frame["text"]]).drop(columns="text")


def _matrix(x: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x), "<f4").reshape(-1, WIDTH).astype(np.float64)


def _summed(rows: DataFrame, partial) -> np.ndarray:
    """Sum of one vector of numbers per task: added up by position, so the driver gets one vector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for frame in frames:
            total = total + partial(_matrix(frame["x"]), frame["trusted"].to_numpy(bool))
        if isinstance(total, np.ndarray):
            yield pd.DataFrame({"values": [total]})

    parts = rows.select("x", "trusted").mapInPandas(run, "values array<double>").select(F.posexplode("values"))
    return np.array([v for _, v in sorted(map(tuple, parts.groupBy("pos").agg(F.sum("col")).collect()))])


def _softplus(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(g / 2))


def _fit(rows: DataFrame, n: int, n_trusted: int, scale: np.ndarray, prior: float, w: np.ndarray) -> np.ndarray:
    """Minimise the non-negative risk by damped Newton steps; each step is one pass over all rows.

    With logistic loss the risk is prior x E_trusted[l(g)] + max(0, E_all[l(-g)] - prior x E_trusted[l(-g)]).
    Where the second part is below zero it is cut off, so only the first one steers the step.
    """
    best, step, move = None, 1.0, np.zeros(WIDTH)
    for _ in range(STEPS):
        at = w + step * move

        def partial(x, trusted, at=at):
            z = x / scale
            g = z @ at
            s = _sigmoid(g)
            p = trusted
            pos, neg, all_ = _softplus(-g[p]).sum(), _softplus(g[p]).sum(), _softplus(g).sum()
            bend = z * (s * (1 - s))[:, None]
            return np.concatenate([[pos, neg, all_], (s[p] - 1) @ z[p], s[p] @ z[p], s @ z, (bend.T @ z).ravel(), (bend[p].T @ z[p]).ravel()])

        v = _summed(rows, partial)
        pos, neg, every = v[:3]
        d_pos, d_neg, d_all = v[3:3 + 3 * WIDTH].reshape(3, WIDTH)
        negative = every / n - prior * neg / n_trusted
        risk = prior * pos / n_trusted + max(0.0, negative) + RIDGE / 2 * at @ at
        if best is not None and risk > best + 1e-9 and step > 1e-3:
            step /= 4
            continue
        done = best is not None and best - risk < TOLERANCE
        w, best, step = at, risk, 1.0
        if done:
            break
        c_all, c_trusted = v[3 + 3 * WIDTH:].reshape(2, WIDTH, WIDTH)
        gradient, curve = prior * d_pos / n_trusted, prior * c_trusted / n_trusted
        if negative >= 0:
            gradient, curve = gradient + d_all / n - prior * d_neg / n_trusted, c_all / n
        gradient, curve = gradient + RIDGE * w, curve + RIDGE * np.eye(WIDTH)
        move = -np.linalg.solve(curve, gradient)
        move *= min(1.0, 10 / max(1e-9, np.abs(move).max()))
    return w


def _prior(rows: DataFrame, n: int, n_trusted: int, scale: np.ndarray, w: np.ndarray) -> float:
    """Share of positives among all rows: the smallest ratio of all rows to trusted ones in an upper tail of the score."""

    def partial(x, trusted):
        bins = np.minimum((_sigmoid(x / scale @ w) * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(bins, minlength=BINS), np.bincount(bins[trusted], minlength=BINS)]).astype(float)

    every, trusted = _summed(rows, partial).reshape(2, BINS)[:, ::-1].cumsum(1)
    enough = trusted >= LEAST_TAIL * n_trusted
    ratio = (every[enough] / n) / (trusted[enough] / n_trusted)
    return float(np.clip(ratio.min(), LEAST_PRIOR, MOST_PRIOR))


def quality_scores(
    docs: DataFrame, trusted_ids: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Score every document: doc_id, learned_from, score (0 to 1, higher: likelier of the trusted kind).

    Positives are the documents named in ``trusted_ids`` (column ``doc_id``) where ``learn`` holds;
    all documents where ``learn`` holds are the unlabelled set. No negative label is used. The
    class prior is estimated from a first fit (prior 0.5) by upper tails of its scores, then the
    risk is minimised again. A score depends on the text alone. Every pass is a distributed
    sum over all rows of a stored table of features; only sums reach the driver.

    NULL and empty texts have zero features and get a score like any text. Rows with a NULL id
    are scored but not learned from as positives; repeated ids give a row each. Without trusted
    documents every score is 0.5. An empty table gives none. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    names = trusted_ids.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(True).alias("trusted")).distinct()
    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.coalesce(learn, F.lit(False)).alias("learned_from"), F.col(text_column).alias("text"))
    described = rows.mapInPandas(_describe, "id string, learned_from boolean, x binary").select(F.col("id").cast("bigint").alias("doc_id"), "learned_from", "x")
    described = scratch.keep(described.join(names, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False))), "features")
    used = described.filter("learned_from")
    n, n_trusted = used.agg(F.count("*"), F.count_if("trusted")).first()
    if not n_trusted:
        return described.select("doc_id", "learned_from", F.lit(0.5).alias("score"))
    squares = _summed(used, lambda x, _: np.square(x).sum(0))
    scale = np.maximum(np.sqrt(squares / n), 1e-6)
    w = _fit(used, n, n_trusted, scale, 0.5, np.zeros(WIDTH))
    prior = _prior(used, n, n_trusted, scale, w)
    w = _fit(used, n, n_trusted, scale, prior, w)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(_sigmoid(_matrix(x) / scale @ w))

    return described.select("doc_id", "learned_from", score("x").alias("score"))
