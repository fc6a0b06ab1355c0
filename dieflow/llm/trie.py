"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

A node is named by its smallest member conversation and its depth. A conversation therefore
owns the deepest part of its own path, and the table of (conversation, depth, node) gives
any ancestor of any node in one equi-join: a node's ancestor at a depth is the node
that its naming conversation passes there.

Removing its centroid cuts a component at least in half. The centroid's subtree total, made of the
totals of the parts below it, is added along the path from the centroid to the component's
top; the parts are cut again. Large components are cut by joins, all of a level together;
those that fit a task are finished there.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch
from dieflow.operators.numbering import number_within

# Nodes of a component that is finished inside one task.
LOCAL = 50_000
# Turns of a conversation summed by one task, and a power of two: conversation ids joined into one piece of text.
TURNS, IDS = 1 << 12, 10
NODE = ["rep", "depth"]
TOP = ["top_rep", "top_depth"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): turns numbered from 0 in each conversation.

    Order: turn, NULL first, then role and text. NULL roles and texts become empty; rows
    without a conversation id take no part.
    """
    least = -(1 << 62)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.coalesce(F.col("turn").cast("bigint"), F.lit(least)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return number_within(rows, ["conv_id"], ["turn", "role", "text"], "pos").select("conv_id", "pos", "role", "text")


def with_shared_heads(turns: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns with the first h of each conversation replaced by those of another, and all conversation ids.

    Conversation c takes the first h turns (all if fewer) of conversation c - c % ``every``, where
    h = crc32(c) % ``heads``, then its own after its first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    convs = sizes.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("model"), (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"),
    )
    models = sizes.select(F.col("conv_id").alias("model"), F.col("size").alias("there"))
    taken = convs.join(models, "model", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    first = turns.filter(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "model")
    head = taken.join(first, "model").filter("pos < h").select("conv_id", "pos", "role", "text")
    own = turns.join(taken.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "role", "text")
    return head.unionByName(own), sizes.select("conv_id")


def _prefix_names(turns: DataFrame) -> DataFrame:
    """(conv, depth, hi, lo, chars): every prefix named by 124 bits, with the code points of its last text.

    A turn's digest holds its depth, so the sum over a prefix stands for the whole sequence.
    """
    depth = (F.col("pos") + 1).cast("bigint")
    digest = F.sha2(F.concat_ws(":", depth.cast("string"), F.length("role").cast("string"), F.concat("role", "text")), 256)
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)")
    rows = turns.select(
        F.col("conv_id").alias("conv"), depth.alias("depth"), part(1).alias("hi"), part(17).alias("lo"), F.length("text").cast("bigint").alias("chars"),
        F.floor(F.col("pos") / TURNS).alias("chunk"),
    )
    upto = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("conv", "chunk").agg(F.sum("hi").alias("hi0"), F.sum("lo").alias("lo0"))
    chunks = chunks.select("conv", "chunk", *[F.sum(c).over(earlier).alias(c) for c in ("hi0", "lo0")]).filter("hi0 is not null")
    sums = rows.withColumns({c: F.sum(c).over(upto) for c in ("hi", "lo")}).join(chunks, ["conv", "chunk"], "left")
    name = lambda c: ((F.col(c) + F.coalesce(f"{c}0", F.lit(0))) % (1 << 62)).cast("bigint").alias(c)
    return sums.select("conv", "depth", name("hi"), name("lo"), "chars")


def _members(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, depth, rep, up, size): the node each conversation passes at each depth, that above it, and the conversation's turns."""
    names = scratch.keep(_prefix_names(turns), "prefixes")
    reps = names.groupBy("depth", "hi", "lo").agg(F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"))
    lowest = convs.agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.lit(0).cast("bigint").alias("chars"))
    root = convs.select(F.col("conv_id").alias("conv"), F.lit(0).cast("bigint").alias("depth")).crossJoin(F.broadcast(lowest))
    path = scratch.keep(names.drop("chars").join(reps, ["depth", "hi", "lo"]).select(root.columns).unionByName(root), "path")
    above = path.select("conv", (F.col("depth") + 1).alias("depth"), F.col("rep").alias("up"))
    # The turns of a conversation and how many nodes at its end bear its name.
    sizes = path.groupBy("conv").agg(F.max("depth").alias("size"), F.count_if(F.col("rep") == F.col("conv")).alias("owned"))
    members = scratch.keep(path.join(above, ["conv", "depth"], "left").join(sizes, "conv"), "members")
    scratch.drop(names, path)
    return members


def _nodes(members: DataFrame) -> DataFrame:
    """Every node with its parent, counts, what it adds to the sums, and the nodes of its subtree."""
    # A member other than the one that names the node has all its own nodes below it.
    below = F.when(F.col("conv") == F.col("rep"), F.col("size") - F.col("depth") + 1).otherwise(F.col("owned"))
    inside = members.groupBy(*NODE).agg(F.sum(below).alias("size"))
    named = members.filter("conv = rep").select(*NODE, "up", "n_convs", (F.col("chars") * (F.col("n_convs") - 1)).alias("saved"))
    children = named.filter("depth > 0").groupBy(F.col("up").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = named.join(inside, NODE).join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    zero = F.lit(0).cast("bigint")
    return nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "n_leaves": zero, "saved_tokens": zero})


def _split(large: DataFrame, members: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """One level: the centroids of all components, finished, and the other nodes in their new components."""
    tops = large.filter("rep = top_rep and depth = top_depth").select(*TOP, F.col("size").alias("total"))
    heavy = large.join(tops, TOP).filter("2 * size >= total")
    centroids = heavy.groupBy(*TOP).agg(F.min_by(F.struct(F.col("rep").alias("c_rep"), F.col("depth").alias("c_depth"), F.col("size").alias("c_size")), "size").alias("c"))
    centroids = scratch.keep(centroids.select(*TOP, "c.*"), "centroids")
    # The ancestor of a node one step below its component's centroid, if there is one.
    step = members.select(F.col("conv").alias("rep"), (F.col("depth") - 1).alias("c_depth"), F.col("rep").alias("x_rep"), F.col("up").alias("x_up"))
    placed = large.join(centroids, TOP).join(step, ["rep", "c_depth"], "left")
    below = F.coalesce((F.col("depth") > F.col("c_depth")) & (F.col("x_up") == F.col("c_rep")), F.lit(False))
    placed = scratch.keep(placed.withColumn("below", below).withColumn("self", (F.col("rep") == F.col("c_rep")) & (F.col("depth") == F.col("c_depth"))), "placed")
    totals = placed.filter("below or self").groupBy(*TOP).agg(F.sum("leaf").alias("t_leaf"), F.sum("saved").alias("t_saved"))
    # From the centroid up to the top.
    path = members.select(F.col("conv").alias("c_rep"), *NODE).join(centroids, "c_rep").filter("depth between top_depth and c_depth").join(totals, TOP)
    path = path.select(*NODE, "t_leaf", "t_saved")
    added = placed.join(path, NODE, "left")
    added = added.withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("t_leaf", F.lit(0)), "saved_tokens": F.col("saved_tokens") + F.coalesce("t_saved", F.lit(0)),
        "size": F.when(F.col("t_leaf").isNotNull(), F.col("size") - F.col("c_size")).otherwise(F.col("size")),
        "top_rep": F.when(F.col("below"), F.col("x_rep")).otherwise(F.col("top_rep")),
        "top_depth": F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")),
    })
    added = scratch.keep(added.select(*large.columns, "self"), "level")
    scratch.drop(centroids, placed)
    return added.filter("self").drop("self"), added.filter("not self").drop("self")


def _finish(frame: pd.DataFrame) -> pd.DataFrame:
    """Cut whole components down to single nodes; all of them advance together."""
    frame = frame.sort_values("depth", kind="stable", ignore_index=True)
    n = len(frame)
    place = pd.Series(np.arange(n), pd.MultiIndex.from_frame(frame[NODE]))
    find = lambda rep, depth: place.reindex(pd.MultiIndex.from_arrays([rep, depth])).fillna(-1).to_numpy(np.int64)
    parent, top = find(frame["up"], frame["depth"] - 1), find(frame["top_rep"], frame["top_depth"])
    size, weight = frame["size"].to_numpy().copy(), frame[["leaf", "saved"]].to_numpy()
    added = np.zeros((n, 2), np.int64)
    live = np.arange(n)
    while len(live):
        centroid = np.full(n, -1)
        # Deeper nodes come later, so the last one that holds half its component is its centroid.
        heavy = live[2 * size[live] >= size[top[live]]]
        np.maximum.at(centroid, top[heavy], heavy)
        tops = np.flatnonzero(centroid >= 0)
        centres = centroid[tops]
        is_centre = np.zeros(n, bool)
        is_centre[centres] = True
        # New tops: the old ones and the children of centroids; everyone else follows the parent up to one.
        stays = live[(live == top[live]) | is_centre[live]]
        up = np.where(parent >= 0, parent, 0)
        child = live[(live != top[live]) & is_centre[up[live]] & ~is_centre[live]]
        leader = up.copy()
        leader[stays], leader[child] = stays, child
        while True:
            further = leader[leader[live]]
            if (further == leader[live]).all():
                break
            leader[live] = further
        below = live[leader[live] != live]
        totals = np.zeros((n, 2), np.int64)
        np.add.at(totals, leader[live], weight[live])
        # A centroid's total: its own and those of the parts whose tops hang on it.
        total = np.zeros((n, 2), np.int64)
        np.add.at(total, up[child], totals[child])
        total = total[centres] + weight[centres]
        lost = size[centres].copy()
        added[centres] += total
        walk, goal = centres, tops
        while True:
            on = walk != goal
            walk, goal, total, lost = parent[walk[on]], goal[on], total[on], lost[on]
            if not len(walk):
                break
            added[walk] += total
            size[walk] -= lost
        top[child], top[below] = child, leader[below]
        live = live[~is_centre[live]]
    return frame.assign(n_leaves=frame["n_leaves"] + added[:, 0], saved_tokens=frame["saved_tokens"] + added[:, 1])


def _ends(members: DataFrame) -> DataFrame:
    """Per node where conversations end: SHA-256 of their ids, rising, with commas; hashed as a stream of bounded pieces."""
    ends = members.filter("depth = size").select(*NODE, F.shiftright("conv", IDS).alias("piece"), "conv")
    pieces = ends.groupBy(*NODE, "piece").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, out = None, None, []
        for frame in frames:
            for rep, depth, ids in zip(frame["rep"], frame["depth"], frame["ids"]):
                if (rep, depth) == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (rep, depth), hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
            out = []
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids")
    return ordered.mapInPandas(digest, "rep bigint, depth bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per distinct prefix of the conversations' turns.

    ``turns`` holds conv_id, pos (dense from 0), role, text, none NULL; ``convs`` every conversation once, those without
    turns included. Gives conv_id (the smallest member), depth (0: the root, which all
    share), parent_conv_id, n_convs, n_children, n_leaves (childless nodes of the subtree), saved_tokens (over the
    subtree, (n_convs - 1) times the code points of a node's last text), ends_sha256 (the ids
    of the conversations that end there). Without conversations there are no rows.

    ``local`` bounds the nodes of a component finished in one task. No step gathers a node's
    members: they are counted before the shuffle, and the ids of those that end at a node
    are hashed piece by piece.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    members = _members(turns, convs, scratch)
    first = members.agg(F.min("conv")).first()[0]
    # The tree's only component: its top is the root.
    rest = scratch.keep(_nodes(members).withColumns({"top_rep": F.lit(first).cast("bigint"), "top_depth": F.lit(0).cast("bigint")}), "nodes")
    small, done = [], []
    while True:
        tops = rest.filter("rep = top_rep and depth = top_depth").select(*TOP, (F.col("size") > local).alias("large"))
        marked = rest.join(tops, TOP)
        small.append(marked.filter("not large").drop("large"))
        if tops.filter("large").isEmpty():
            break
        centroids, rest = _split(marked.filter("large").drop("large"), members, scratch)
        done.append(centroids)
    left = small[0]
    for part in small[1:]:
        left = left.unionByName(part)
    left = scratch.keep(left, "small")
    tasks = left.count() // local + 1
    ended = left.withColumn("task", F.pmod(F.xxhash64(*TOP), F.lit(tasks))).groupBy("task").applyInPandas(
        lambda frame: _finish(frame.drop(columns="task")), left.schema,
    )
    for part in done:
        ended = ended.unionByName(part)
    hashed = ended.join(_ends(members), NODE, "left")
    return hashed.select(
        F.col("rep").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
