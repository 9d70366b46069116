"""Prefix trie of conversations: vertical bitmaps in every shard, one merge of what shards share.

A shard is a run of consecutive conversation ids. It indexes (position, turn) to the bitset of the
conversations that hold it; intersecting a node's bitset with the postings of the next position yields
its children, bit counts and end lists, depth first. Nodes that several shards hold are the only ones
whose subtrees are summed across shards, by pointer doubling.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, saved

#: Consecutive conversation ids of a shard: the width of its bitsets.
WIDTH = 2_000
#: Turns that a task holds at once; a longer conversation goes on in the shard after it.
TURNS = 200_000

ROOT = hashlib.md5(b"").digest()
KEY = ["node_a", "node_b"]
LOCAL = (
    "node_a long, node_b long, up_a long, up_b long, depth long, conv_id long, up_conv long, n long, words long, "
    "n_children long, leaves long, saved long, cut int, ends_from long, ends string"
)


def turns(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, pos, turn_key, n_words, role, text``: every turn at its place, from 0.

    Turns are ordered by number, nulls first; equal numbers by role, then by key. Null roles and texts
    are empty; repeated rows are turns of their own; rows without conversation are left out. The key is
    an MD5 of role and text, so that no text is shuffled unless it is selected.
    """
    rows = inputs(conversations, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumns({
        "turn_key": F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))),
        "n_words": F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"),
    })
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_key")
    place = (F.row_number().over(order) - 1).cast("long")
    return rows.select("conv_id", place.alias("pos"), "turn_key", "n_words", "role", "text")


class _Piece:
    """Consecutive turns of one conversation, and the node that they start from."""

    def __init__(self, conv: int, node: bytes, depth: int):
        self.conv, self.node, self.depth = conv, node, depth
        self.keys: list[bytes] = []
        self.words: list[int] = []


def local_trie(pieces: list[_Piece], cut: bool) -> tuple[dict, bytes]:
    """The columns of ``LOCAL`` for one shard, and the node at which its last conversation stands.

    Pieces come by rising conversation. ``cut``: the last one goes on in the next shard.
    """
    postings: dict[tuple, int] = defaultdict(int)
    ended: dict[int, int] = defaultdict(int)
    starts: dict[tuple, int] = defaultdict(int)
    open_bit = 1 << (len(pieces) - 1) if cut else 0
    for i, p in enumerate(pieces):
        bit = 1 << i
        starts[p.node, p.depth] |= bit
        for d, key in enumerate(p.keys, p.depth):
            postings[d, key] |= bit
        if bit != open_bit:
            ended[p.depth + len(p.keys)] |= bit

    node, up, parent, depth, first, size, word, is_cut, ends = ([] for _ in range(9))
    at_cut = pieces[-1].node
    stack = [(n, None, -1, d, members, 0) for (n, d), members in starts.items()]
    while stack:
        name, above, of, d, members, n_words = stack.pop()
        at = -1
        if above is not None or d == 0:  # a start below the root has its row in the shard before
            at = len(node)
            low = members & -members
            end = members & ended.get(d, 0)
            node.append(name), up.append(above), parent.append(of), depth.append(d)
            first.append(pieces[low.bit_length() - 1].conv), size.append(members.bit_count()), word.append(n_words)
            is_cut.append(int(bool(members & open_bit))), ends.append(end)
        else:
            end = members & ended.get(d, 0)
        rest = members & ~end
        while rest:
            i = (rest & -rest).bit_length() - 1
            k = d - pieces[i].depth
            if k == len(pieces[i].keys):
                at_cut = name
                rest &= rest - 1
                continue
            key = pieces[i].keys[k]
            child = members & postings[d, key]
            rest &= ~child
            stack.append((hashlib.md5(name + key).digest(), name, at, d + 1, child, pieces[i].words[k]))

    children, leaves, spared = [0] * len(node), [0] * len(node), [0] * len(node)
    for at in range(len(node) - 1, -1, -1):
        leaves[at] += not children[at]
        spared[at] += (size[at] - 1) * word[at]
        if parent[at] >= 0:
            children[parent[at]] += 1
            leaves[parent[at]] += leaves[at]
            spared[parent[at]] += spared[at]
    ids, blank = np.frombuffer(b"".join(node), "<i8").reshape(-1, 2), b"\0" * 16
    ups = np.frombuffer(b"".join(u or blank for u in up), "<i8").reshape(-1, 2)
    rootless = np.array([u is None for u in up], bool)
    lists = [[pieces[i].conv for i in _bits(e)] for e in ends]
    columns = {
        "node_a": pa.array(ids[:, 0]), "node_b": pa.array(ids[:, 1]),
        "up_a": pa.array(ups[:, 0], mask=rootless), "up_b": pa.array(ups[:, 1], mask=rootless),
        "depth": depth, "conv_id": first, "up_conv": [first[p] if p >= 0 else None for p in parent],
        "n": size, "words": word, "n_children": children, "leaves": leaves, "saved": spared, "cut": is_cut,
        "ends_from": [x[0] if x else None for x in lists],
        "ends": [",".join(map(str, x)) if x else None for x in lists],
    }
    return columns, at_cut


def _bits(members: int) -> Iterator[int]:
    while members:
        yield (members & -members).bit_length() - 1
        members &= members - 1


_KINDS = {"cut": pa.int32(), "ends": pa.string()}


def _batch(columns: dict) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, _KINDS.get(n, pa.int64())) for n, c in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _shards(most: int):
    """Rows sorted by block, conversation and place, to the nodes of shard after shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[_Piece] = []
        held, block = 0, None
        for batch in batches:
            for of, conv, key, words in zip(*(batch.column(c).to_pylist() for c in ("block", "conv_id", "turn_key", "n_words"))):
                other = not pieces or pieces[-1].conv != conv
                if pieces and other and (of != block or held >= most):
                    yield _batch(local_trie(pieces, False)[0])
                    pieces, held = [], 0
                elif held >= most and key is not None:
                    columns, at = local_trie(pieces, True)
                    yield _batch(columns)
                    pieces, held = [_Piece(conv, at, pieces[-1].depth + len(pieces[-1].keys))], 0
                block = of
                if other:
                    pieces.append(_Piece(conv, ROOT, 0))
                    held += 1
                if key is not None:
                    pieces[-1].keys.append(key)
                    pieces[-1].words.append(words)
                    held += 1
        if pieces:
            yield _batch(local_trie(pieces, False)[0])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for the end lists of each node, which come one after the other by rising id."""
    node, sha = None, None
    for batch in batches:
        out = []
        for a, b, text in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ends"))):
            if (a, b) == node:
                sha.update(b",")
            else:
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = (a, b), hashlib.sha256()
            sha.update(text.encode())
        yield _digest_rows(out)
    if node:
        yield _digest_rows([(*node, sha.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*KEY, "ends_sha256"])


def _subtrees(merged: DataFrame) -> DataFrame:
    """Of every shared node: its key, ``n_children``, and ``leaves`` and ``saved`` summed over its subtree.

    What hangs below a shared node in one shard only is already summed there. The rest is pointer doubling:
    after k rounds a node has the sums of the shared nodes less than 2^k below it and its 2^k-th ancestor.
    """
    shared = merged.where("shared")
    below = merged.groupBy(F.col("up_a").alias("node_a"), F.col("up_b").alias("node_b")).agg(
        F.count("*").alias("kids"),
        F.sum(F.expr("if(shared, 0, leaves)")).alias("own_leaves"),
        F.sum(F.expr("if(shared, 0, saved)")).alias("own_saved"),
    )
    state = shared.join(below, KEY, "left").select(
        *KEY,
        "up_a",
        "up_b",
        "depth",
        F.expr("coalesce(kids, 0)").alias("n_children"),
        F.expr("if(kids is null, 1, own_leaves)").alias("leaves"),
        F.expr("(n - 1) * words + coalesce(own_saved, 0)").alias("saved"),
    )
    state = saved(state, "trie-shared")
    deepest = state.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):
        gain = state.where("up_a is not null").groupBy(F.col("up_a").alias("node_a"), F.col("up_b").alias("node_b"))
        gain = gain.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = state.select(
            F.col("node_a").alias("up_a"), F.col("node_b").alias("up_b"), F.col("up_a").alias("far_a"), F.col("up_b").alias("far_b")
        )
        state = state.join(gain, KEY, "left").join(above, ["up_a", "up_b"], "left").select(
            *KEY,
            F.col("far_a").alias("up_a"),
            F.col("far_b").alias("up_b"),
            "depth",
            "n_children",
            F.expr("leaves + coalesce(more_leaves, 0)").alias("leaves"),
            F.expr("saved + coalesce(more_saved, 0)").alias("saved"),
        )
        state = saved(state, "trie-shared")
    return state.select(*KEY, "n_children", "leaves", "saved")


def prefix_trie(rows: DataFrame, width: int = WIDTH, most: int = TURNS) -> DataFrame:
    """One row for each distinct sequence of first turns, from the textless root down.

    ``rows`` has ``conv_id, pos, turn_key, n_words``, as `turns` gives; only the order of ``pos`` counts. A row
    with null ``turn_key`` names a conversation and adds no turn to it. Returns ``node_a, node_b`` (128 bits that
    name the path), ``depth, conv_id`` (smallest member), ``parent_conv_id, n_convs, n_children, n_leaves``
    (childless nodes of the subtree), ``saved_tokens`` (words of the subtree's turns that a trie stores once
    less) and ``ends_sha256`` (of the ids that end here, ascending, joined by commas). Without
    conversations there is no node.

    Shards hold ``width`` consecutive ids and ``most`` turns at most. A node that many shards hold, such as a
    first turn of a third of all conversations, is one row a shard. One conversation's turns are read as a
    stream by one task, as are the ids that end at one node, since both are hashed in order.
    """
    block = F.expr(f"conv_id div {width}").alias("block")
    dealt = rows.select(block, "conv_id", "pos", "turn_key", "n_words").repartition("block")
    dealt = dealt.sortWithinPartitions("block", "conv_id", F.col("pos").asc_nulls_first())
    local = saved(dealt.select("block", "conv_id", "turn_key", "n_words").mapInArrow(_shards(most), LOCAL), "trie-local")
    merged = local.groupBy(*KEY).agg(
        *[F.min(c).alias(c) for c in ("up_a", "up_b", "depth", "conv_id", "up_conv", "words", "n_children", "leaves", "saved")],
        F.sum("n").alias("n"),
        (F.count("*") + F.max("cut") > 1).alias("shared"),
    )
    merged = saved(merged, "trie-merged")
    sums = _subtrees(merged)
    shared = merged.where("shared").drop("n_children", "leaves", "saved").join(sums, KEY)
    nodes = merged.where("not shared").unionByName(shared)
    owners = merged.where("shared").select(
        F.col("node_a").alias("up_a"), F.col("node_b").alias("up_b"), F.col("conv_id").alias("owner")
    )
    ends = local.where("ends is not null").select(*KEY, "ends_from", "ends").repartition(*KEY)
    ends = ends.sortWithinPartitions(*KEY, "ends_from").mapInArrow(_digests, "node_a long, node_b long, ends_sha256 string")
    return nodes.join(owners, ["up_a", "up_b"], "left").join(ends, KEY, "left").select(
        *KEY,
        "depth",
        "conv_id",
        F.coalesce("owner", "up_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
