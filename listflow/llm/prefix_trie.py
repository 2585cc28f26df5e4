"""Prefix trie of conversations from padded turn-id matrices.

Conversations are range-partitioned by their sequence of turns, so every node's members stand side by
side. A shard sorts its sequences with numpy: turn ids padded to a matrix, ``lexsort``, and column
changes joined by OR from the left, which mark where nodes start. The marks give the length that a row
shares with its neighbour, and from that all counts of all depths by ``reduceat``. Nodes at a shard's
border leave it as parts; their sums, and what the shards' borders share, make the whole node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listflow.session import cut_lineage

#: Turns that a shard holds on average, columns of one padded matrix, ids in one piece of a border node's
#: members, and conversations whose unshared nodes leave a shard together.
SHARD_TURNS = 500_000
WIDTH = 32
PIECE_IDS = 50_000
ALONE_ROWS = 10_000

_DIGEST = 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_PARTS_DDL = ("kind string, shard long, node string, parent string, conv_id long, depth long, parent_conv_id long, "
              "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, piece long, ids binary, "
              "first_path array<string>, last_path array<string>, first_sums array<long>")
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
          "array<long>": pa.list_(pa.int64())}
_PARTS = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _PARTS_DDL.split(", ")])
_ENDS = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) from (conv_id, turn, role, text): per conversation its turns' digests and sizes, in order.

    The digest is 128 bits of SHA-256 over the role's size, the role and the text. Turns are ordered by
    ``turn``, nulls first; those that share one by digest. Rows without a conv_id belong to no
    conversation. A conversation is one row of 24 bytes a turn, as a text is one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * _DIGEST)
    own = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(lists: DataFrame, siblings: int = 5, most_shared: int = 9) -> DataFrame:
    """``lists`` with the first h turns of conversation c - c % ``siblings`` before c's own turns after its first h.

    h is the unsigned CRC-32 of c's decimal digits, modulo ``most_shared``. An absent conversation lends nothing.
    """
    base = F.col("conv_id") - F.col("conv_id") % siblings
    heads = lists.filter(F.col("conv_id") % siblings == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most_shared - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most_shared).cast("int")
    none = F.array().cast(lists.schema["turns"].dataType)
    joined = lists.withColumns({"base": base, "h": h}).join(heads, "base", "left")
    return joined.select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def sorted_prefixes(digests: np.ndarray, offsets: np.ndarray, conv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): rows by their sequences, a shorter before a longer, then by ``conv``, and how many turns each
    row shares with the one before it (-1 for the first).

    ``digests`` (turns, 2) are all rows' turns in a row, high half first. Matrices are ``WIDTH`` columns wide; rows that
    agree in all of them go on to the next columns, so a long sequence widens no other row's matrix.
    """
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    by_digest = np.lexsort([digests[:, 1], digests[:, 0]])
    turn = np.empty(len(digests), np.int64)
    turn[by_digest] = np.cumsum(np.append(False, (digests[by_digest][1:] != digests[by_digest][:-1]).any(axis=1))[:len(digests)])
    order = np.lexsort([conv])
    group = np.zeros(n, np.int64)
    shared = np.zeros(n, np.int64)
    shared[:1] = -1
    at, active = 0, np.arange(n)
    while len(active):
        rows, own = order[active], group[active]
        column = np.arange(at, at + WIDTH)
        inside = column < lengths[rows][:, None]
        ids = np.full((len(rows), WIDTH), -1, np.int64)
        ids[inside] = turn[(offsets[rows][:, None] + column)[inside]]
        # rows of a group keep their places together; the sort is stable, so conv stays the last key
        moved = np.lexsort([*ids.T[::-1], own])
        order[active], ids, rows = rows[moved], ids[moved], rows[moved]
        same_group = own[1:] == own[:-1]
        change = np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1)
        ended = np.minimum(lengths[rows][1:], lengths[rows][:-1])
        prefix = np.minimum((~change).sum(axis=1), np.maximum(ended - at, 0))
        later = active[1:][same_group]
        shared[later] = at + prefix[same_group]
        starts = np.append(True, ~same_group | change[:, -1])
        number = np.cumsum(starts)
        longer = lengths[rows] > at + WIDTH
        crowd = np.bincount(number[longer], minlength=number[-1] + 1)
        stay = longer & (crowd[number] > 1)
        active, at = active[stay], at + WIDTH
        group[active] = number[stay]
    return order, shared


def _rows(kind: str, shard: int, count: int, **columns) -> pa.RecordBatch:
    """``count`` rows of ``_PARTS``; columns that are not given are null."""
    columns |= {"kind": [kind] * count if isinstance(kind, str) else kind, "shard": [shard] * count}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in _PARTS], schema=_PARTS)


def shard_parts(conv: np.ndarray, offsets: np.ndarray, digests: np.ndarray, sizes: np.ndarray,
                shard: int) -> Iterator[pa.RecordBatch]:
    """All nodes of one shard's rows: whole ones, parts of border nodes, pieces of their members' ids, and the border itself."""
    order, shared = sorted_prefixes(digests, offsets, conv)
    n = len(order)
    lengths, begin, conv = np.diff(offsets)[order], offsets[:-1][order], conv[order]
    total = np.append(0, np.cumsum(sizes))
    following = np.append(shared[1:], -1)
    near = np.maximum(shared, following)
    # a row has the least of the shared lengths between them in common with the first row, and with the last
    with_first = np.minimum.accumulate(np.append(lengths[:1], shared[1:]))
    with_last = np.minimum.accumulate(np.append(lengths[-1:], following[:-1][::-1]))[::-1]
    paths = [_path(digests[begin[row]:begin[row] + lengths[row]]) for row in (0, n - 1)]
    copies = np.append((shared[1:] == lengths[1:]) & (lengths[1:] == lengths[:-1]), False)
    last_copy = np.flatnonzero(~copies)
    pieces: list[tuple[str, int, bytes]] = []

    def border(at: int, depth: int) -> str | None:
        """The node's name if it holds the first or the last row, else nothing."""
        return paths[0][depth] if with_first[at] >= depth else paths[1][depth] if with_last[at] >= depth else None

    def ends(at: int, depth: int, name: str | None) -> str | None:
        """SHA-256 of the ids of the rows from ``at`` that end here; those of a border node become pieces."""
        if lengths[at] != depth:
            return None if name else _EMPTY
        ids = conv[at:last_copy[np.searchsorted(last_copy, at)] + 1]
        if name is None:
            return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
        pieces.extend((name, k, ",".join(map(str, ids[k:k + PIECE_IDS].tolist())).encode()) for k in range(0, len(ids), PIECE_IDS))
        return None

    def nodes(at: np.ndarray, depth: np.ndarray, parent: np.ndarray, **counts) -> pa.RecordBatch:
        """Nodes by their first rows and depths; ``parent`` is the parent's least member in this shard."""
        edge = (np.maximum(with_first, with_last)[at] >= depth).tolist()
        above = (np.maximum(with_first, with_last)[at] >= depth - 1).tolist()
        places = list(zip(at.tolist(), depth.tolist()))
        names = [border(a, d) if e else None for (a, d), e in zip(places, edge)]
        return _rows(
            ["edge" if e else "whole" for e in edge], shard, len(at), node=names, depth=depth,
            parent=[border(a, d - 1) if e and d else None for (a, d), e in zip(places, above)],
            parent_conv_id=[None if e else p for e, p in zip(above, parent.tolist())],
            ends_sha256=[ends(a, d, name) for (a, d), name in zip(places, names)], **counts)

    least_above = np.zeros(n, np.int64)
    for d in range(int(near.max(initial=0)) + 1):
        rows = np.flatnonzero(near >= d) if d else np.arange(n)
        starts = np.flatnonzero(shared[rows] < d)
        at, count = rows[starts], np.diff(np.append(starts, len(rows)))
        upto = np.maximum(shared[rows], 0)
        saved = np.where(upto >= d, total[begin[rows] + upto] - total[begin[rows] + np.minimum(max(d - 1, 0), upto)], 0)
        least = np.minimum.reduceat(conv[rows], starts)
        yield nodes(
            at, np.full(len(at), d), least_above[at], conv_id=least, n_convs=count, saved_tokens=np.add.reduceat(saved, starts),
            n_children=np.add.reduceat(((lengths[rows] > d) & (shared[rows] <= d)).astype(np.int64), starts),
            n_leaves=np.add.reduceat((following[rows] < lengths[rows]).astype(np.int64), starts))
        least_above[rows] = np.repeat(least, count)
    # deeper than what it shares with its neighbours a row is alone
    upto = np.maximum(near, 0)
    runs = lengths - upto
    for low in range(0, n, ALONE_ROWS):
        some = np.arange(low, min(n, low + ALONE_ROWS))
        at = np.repeat(some, runs[some])
        depth = np.arange(len(at)) - np.repeat(np.cumsum(runs[some]) - runs[some], runs[some]) + upto[at] + 1
        ones = np.ones(len(at), np.int64)
        yield nodes(at, depth, np.where(depth == upto[at] + 1, least_above[at], conv[at]), conv_id=conv[at], n_convs=ones,
                    n_children=(depth < lengths[at]).astype(np.int64), n_leaves=ones, saved_tokens=ones - 1)
    for name, k, ids in pieces:
        yield _rows("ids", shard, 1, node=[name], piece=[k], ids=[ids])
    sums = np.append(0, np.cumsum(sizes[begin[0]:begin[0] + lengths[0]]))
    yield _rows("border", shard, 1, first_path=[paths[0]], last_path=[paths[1]], first_sums=[sums])


def _path(digests: np.ndarray) -> list[str]:
    """Names of the nodes from the root to the end of a sequence."""
    state = hashlib.sha256()
    out = [state.hexdigest()]
    for turn in digests.astype(">u8"):
        state.update(turn.tobytes())
        out.append(state.hexdigest())
    return out


def _parts(lists: DataFrame, shard_turns: int) -> DataFrame:
    """Rows of ``_PARTS`` for (conv_id, turns), by range shards of about ``shard_turns`` turns."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    turns = lists.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    rows = lists.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = [b for b in batches if b.num_rows]
        if flat:
            keys = b"".join(k for b in flat for k in b["key"].to_pylist())
            lengths = np.concatenate([b["sizes"].value_lengths().to_numpy(zero_copy_only=False) for b in flat])
            yield from shard_parts(
                np.concatenate([b["conv_id"].to_numpy() for b in flat]), np.append(0, np.cumsum(lengths)).astype(np.int64),
                np.frombuffer(keys, ">u8").astype(np.uint64).reshape(-1, 2),
                np.concatenate([b["sizes"].flatten().to_numpy() for b in flat]).astype(np.int64), TaskContext.get().partitionId())

    return rows.repartitionByRange(max(1, -(-turns // shard_turns)), "key", "conv_id").mapInArrow(run, _PARTS_DDL)


def _border_shares(parts: DataFrame) -> DataFrame:
    """What the sums of border nodes change by, since the last row of a shard and the first of the next one share turns.

    One row per shard is ordered here, with the names on two paths.
    """
    before = Window.orderBy("shard")
    shares = parts.filter("kind = 'border'").select(
        "shard", "first_path", "first_sums", F.lag("last_path").over(before).alias("before")).filter("before is not null")
    shares = shares.withColumn("s", F.size(F.array_intersect("first_path", "before")) - 1)
    each = shares.select("*", F.posexplode(F.slice("first_path", F.lit(1), F.col("s") + 1)).alias("d", "node"))
    saved = F.get("first_sums", F.col("s")) - F.get("first_sums", F.greatest(F.col("d") - 1, F.lit(0)))
    return each.select(
        "node", F.lit(0).cast("long").alias("n_convs"), (-(F.col("s") > F.col("d")).cast("long")).alias("n_children"),
        (-(F.size("before") - 1 == F.col("s")).cast("long")).alias("n_leaves"), saved.alias("saved_tokens"))


def _ends(parts: DataFrame) -> DataFrame:
    """(node, ends_sha256) of border nodes at which conversations end: pieces are hashed in order, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch["node"].to_pylist(), batch["ids"]):
                if name != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
            yield pa.RecordBatch.from_pydict({"node": [d[0] for d in done], "ends_sha256": [d[1] for d in done]}, schema=_ENDS)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]}, schema=_ENDS)

    pieces = parts.filter("kind = 'ids'").select("node", "shard", "piece", "ids")
    return pieces.repartition("node").sortWithinPartitions("node", "shard", "piece").select("node", "ids").mapInArrow(
        run, "node string, ends_sha256 string")


def conversation_trie(turns: DataFrame, siblings: int = 5, most_shared: int = 9, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations: conv_id (its least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Conversations are those of ``rebuilt(turn_lists(turns))``. A null role or text is empty; rows without
    a conv_id count nowhere; turns that share a number are ordered by a digest; repeated rows are turns
    of their own; other columns are not read. Without conversations there is no node, not even the root.
    """
    lists = cut_lineage(turn_lists(turns), "turns")
    whole = cut_lineage(rebuilt(lists, siblings, most_shared), "rebuilt")
    parts = cut_lineage(_parts(whole, shard_turns), "nodes")
    edges = parts.filter("kind = 'edge'").select("shard", "node", "parent", "conv_id", "depth", *_COUNTS)
    summed = edges.select("node", "parent", "conv_id", "depth", *_COUNTS).unionByName(
        _border_shares(parts), allowMissingColumns=True)
    met = cut_lineage(summed.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in _COUNTS]).join(_ends(parts), "node", "left"), "borders")
    named = met.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"]
    borders = met.join(named, "parent", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    inner = parts.filter("kind = 'whole'")
    # a hot parent has children in many shards: its name is looked up per shard
    by_shard = edges.select("shard", F.col("node").alias("parent")).join(named, "parent")
    below = inner.filter("parent is not null").drop("parent_conv_id").join(by_shard, ["shard", "parent"])
    return borders.select(*columns).unionByName(below.select(*columns)).unionByName(
        inner.filter("parent is null").select(*columns))
