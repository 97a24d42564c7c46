"""The prefix trie of conversations, counted in node tables of perfect-hash slots.

A node is a distinct sequence of first turns. Its name is a 128-bit digest that is chained turn by turn, so
one pass over the turns of a conversation gives the nodes on its path (``paths``), and equal prefixes of
different conversations meet in one name.

1. Paths are dealt to tasks by hundreds of conversations, which share their first turns. A task takes up to
   ``SHARD_ROWS`` path rows at a time. The distinct names of such a shard get slots of a minimal perfect hash, the
   name that stands in a slot is compared with each row that claims it, and counts, least members and
   depths are scattered into flat arrays by slot.
2. Shards are merged by name, with partial sums first: this gives members and owner, the least conversation, of every
   node. Each node has one owner, so whatever is added once per node goes with the owner's path.
3. The same shards come once more, with what each conversation owns. Savings, leaves and children are put into
   the slots of the owned nodes, and added to the parents through an array of parent slots, deepest nodes first.
   A path that is longer than a shard hands the sums below the cut on to the next shard. Partial sums are
   merged by name.

A task holds the arrays of one shard. Conversations that end in one node are packed into pieces of some
4,096 ids, so that their digest reads few rows however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shared_folder, ship, written
from touchline.llm.line_dedup import build_shard, mixed

# Each hundredth conversation lends its first turns; up to MOST of them.
FAMILY = 100
MOST = 6
SHARD_ROWS = 1 << 18
NAME = 16
ROOT = bytes(NAME)
_NO_ENDS = hashlib.sha256().hexdigest()

_PATHS = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
                    ("n", pa.int64()), ("ends", pa.bool_())])
_COUNTS = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n", pa.int64()),
                     ("n_convs", pa.int64()), ("owner", pa.int64()), ("goes_on", pa.bool_())])
_SUMS = pa.schema([("node", pa.binary()), ("saved", pa.int64()), ("leaves", pa.int64()), ("children", pa.int64())])
_ENDS = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names.get(f.type, 'binary')}" for f in schema)


def borrowed_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST).cast("int")


# -- rebuilt conversations -----------------------------------------------------------------------------------


def rebuilt(conversations: DataFrame, folder: str) -> DataFrame:
    """conv_id, part, pos, digest and n of the turns of rebuilt conversations, in the order of (part, pos).

    Part 0 is what is borrowed, part 1 what is own. Each conversation also has a row of part -1 without a digest,
    so that one without turns is there too. Texts do not leave the first scan: a turn is its digest and its length.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", F.unhex(F.substring(told, 1, 2 * NAME)).alias("digest"),
        F.char_length(text).cast("long").alias("n"))
    turns = written(turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest").mapInArrow(
        _numbered, "conv_id long, pos long, digest binary, n long"), folder, "turns")
    own = turns.filter(F.col("pos") > borrowed_turns(F.col("conv_id"))).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "n")
    convs = turns.filter("pos = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("lender"))
    lent = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < MOST)).withColumnRenamed("conv_id", "lender")
    taken = convs.join(lent, "lender").filter(F.col("pos") <= borrowed_turns(F.col("conv_id"))).select(
        "conv_id", F.lit(0).alias("part"), "pos", "digest", "n")
    there = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("pos"),
                         F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n"))
    return there.union(taken).union(own)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of conversations that come in order; a batch border may cut one."""
    last, at = None, 0
    for batch in batches:
        ids = batch["conv_id"].to_numpy()
        if not len(ids):
            continue
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        pos = np.arange(1, len(ids) + 1) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
        if last == ids[0]:
            first = starts[1] if len(starts) > 1 else len(ids)
            pos[:first] += at
        last, at = ids[-1], pos[-1]
        yield pa.RecordBatch.from_arrays([batch["conv_id"], pa.array(pos), batch["digest"], batch["n"]],
                                         names=["conv_id", "pos", "digest", "n"])


def paths(turns: DataFrame, folder: str) -> DataFrame:
    """The nodes on the path of each conversation, the root included: conv_id, depth, node, parent, n, ends.

    ``n`` is the length of the last text, ``ends`` whether the conversation has no further turn.
    """
    lined = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return written(lined.mapInArrow(_chain, _ddl(_PATHS)), folder, "paths")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the last row of a path is known when the next one begins
    now = ROOT
    depth = 0
    for batch in batches:
        rows = [] if held is None else [held]
        for conv_id, digest, n in zip(*(batch[c].to_pylist() for c in ("conv_id", "digest", "n"))):
            if digest is None:
                now, depth = ROOT, 0
                if rows:
                    rows[-1] = (*rows[-1][:5], True)
                rows.append((conv_id, 0, ROOT, None, 0, False))
            else:
                before, depth = now, depth + 1
                now = hashlib.blake2b(before + digest, digest_size=NAME).digest()
                rows.append((conv_id, depth, now, before, n, False))
        if rows:
            held = rows.pop()
            yield _record(rows, _PATHS)
    if held is not None:
        yield _record([(*held[:5], True)], _PATHS)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# -- node tables ---------------------------------------------------------------------------------------------


class NodeTable:
    """Slots of the distinct names of a shard: a minimal perfect hash, verified against the stored names."""

    def __init__(self, names: np.ndarray):
        """``names``: 16 bytes each, repeats and all."""
        halves = np.ascontiguousarray(names).view("<u8").reshape(-1, 2)
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
        distinct = halves[order[fresh]]
        # Members of the hash are 64-bit; in the unlikely case of equal first halves other bits are taken.
        self.turn = 0
        while len(np.unique(keys := self._keys(distinct))) < len(distinct):
            self.turn += 1
        self.size = len(distinct)
        self.shift, slots = build_shard(keys)
        self.names = np.empty_like(distinct)
        self.names[slots] = distinct

    def _keys(self, halves: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return halves[:, 0] + np.uint64(2 * self.turn) * (halves[:, 1] | np.uint64(1))

    def slots(self, names: np.ndarray) -> np.ndarray:
        """The slot of each name; all must be members."""
        halves = np.ascontiguousarray(names).view("<u8").reshape(-1, 2)
        keys = self._keys(halves)
        bucket = (mixed(keys, 1) % np.uint64(len(self.shift))).astype(np.int64)
        slot = (mixed(keys, self.shift[bucket]) % np.uint64(self.size)).astype(np.int64)
        if (self.names[slot] != halves).any():
            raise ValueError("a name is not in its slot")
        return slot


def _names(column: pa.Array) -> np.ndarray:
    """16 bytes per row; null is the name of the root, which has no parent."""
    column = column.cast(pa.binary()).fill_null(ROOT)
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, NAME)


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Table, bool]]:
    """Path rows in groups of about ``limit``, and whether a group is a piece of one longer path.

    Groups hold whole paths. A path of more than ``limit`` rows is cut, and its pieces hold nothing else.
    """
    whole: list[pa.RecordBatch] = []  # paths that are complete
    last: list[pa.RecordBatch] = []  # rows of the path that may go on
    cut = False  # whether a piece of the last path is already out

    def size(parts: list[pa.RecordBatch]) -> int:
        return sum(p.num_rows for p in parts)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch["conv_id"].to_numpy()
        borders = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        # Take the paths of a batch in strides, not one by one: only its first and its last one may be open.
        first, final = borders[1], borders[-2]
        if last and last[-1]["conv_id"][-1].as_py() == ids[0]:
            last.append(batch.slice(0, first))
            rest = first
        else:
            rest = 0
        if rest < len(ids):
            if last and cut:
                yield pa.Table.from_batches(last), True
            else:
                whole += last
            last, cut = [], False
            if rest < final:
                whole.append(batch.slice(rest, final - rest))
            last.append(batch.slice(final))
        if size(whole) >= limit or (whole and size(whole) + size(last) >= 2 * limit):
            yield pa.Table.from_batches(whole), False
            whole = []
        while size(last) >= limit:
            table = pa.Table.from_batches(last)
            # One row stays back: whether the path goes on is not known yet.
            yield table.slice(0, limit - 1), True
            last, cut = table.slice(limit - 1).to_batches(), True
    if cut:
        yield pa.Table.from_batches(last), True
    elif last:
        whole += last
    if whole:
        yield pa.Table.from_batches(whole), False


def _column(shard: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(shard[name].chunks)


def _count(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Members, least member and place of the nodes of each shard."""
    for shard, _ in _shards(batches, limit):
        names, convs = _names(_column(shard, "node")), shard["conv_id"].to_numpy()
        table = NodeTable(names)
        slot = table.slots(names)
        owner = np.full(table.size, np.iinfo(np.int64).max)
        np.minimum.at(owner, slot, convs)
        depth, n = np.zeros(table.size, np.int64), np.zeros(table.size, np.int64)
        depth[slot], n[slot] = shard["depth"].to_numpy(), shard["n"].to_numpy()
        above = np.zeros((table.size, NAME), np.uint8)
        above[slot] = _names(_column(shard, "parent"))
        goes_on = np.zeros(table.size, bool)
        goes_on[slot[~_column(shard, "ends").to_numpy(zero_copy_only=False)]] = True
        yield pa.RecordBatch.from_arrays([
            _binary(table.names), _binary(above), pa.array(depth), pa.array(n),
            pa.array(np.bincount(slot, minlength=table.size)), pa.array(owner), pa.array(goes_on),
        ], schema=_COUNTS)


def _accumulate(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Sums over subtrees; the paths come one after the other, each from its end to the root."""
    carried = (0, 0, 0)  # sums of a cut path: saved and leaves below the cut, and whether the last node is a child to count
    for shard, piece in _shards(batches, limit):
        names, depth = _names(_column(shard, "node")), shard["depth"].to_numpy()
        owned = _column(shard, "owned").to_numpy(zero_copy_only=False)
        table = NodeTable(names)
        slot = table.slots(names)
        saved, leaves, children = (np.zeros(table.size, np.int64) for _ in range(3))
        saved[slot[owned]] = shard["saved"].to_numpy()[owned]
        leaves[slot[owned]] = shard["leaf"].to_numpy()[owned]
        # The row after a row is its parent, but for the root and for the last row of a piece.
        inner = depth > 0
        inner[-1] = False
        up = np.flatnonzero(inner)
        parent = np.full(table.size, -1)
        parent[slot[up]] = slot[up + 1]
        np.add.at(children, slot[up + 1], owned[up].astype(np.int64))
        if piece:
            for values, more in zip((saved, leaves, children), carried):
                values[slot[0]] += more
        depth_of = np.zeros(table.size, np.int64)
        depth_of[slot] = depth
        by_depth = np.argsort(depth_of, kind="stable")
        cuts = np.flatnonzero(np.diff(depth_of[by_depth])) + 1
        for nodes in reversed(np.split(by_depth, cuts)):
            nodes = nodes[parent[nodes] >= 0]
            np.add.at(saved, parent[nodes], saved[nodes])
            np.add.at(leaves, parent[nodes], leaves[nodes])
        if piece:
            goes_on = depth[-1] > 0
            carried = (saved[slot[-1]], leaves[slot[-1]], int(owned[-1])) if goes_on else (0, 0, 0)
        yield pa.RecordBatch.from_arrays(
            [_binary(table.names), pa.array(saved), pa.array(leaves), pa.array(children)], schema=_SUMS)


def _binary(names: np.ndarray) -> pa.Array:
    """Names as a column, 16 bytes each."""
    ends = np.arange(0, NAME * (len(names) + 1), NAME, dtype=np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(ends), pa.py_buffer(names.tobytes())])


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of each node; pieces come node by node in order."""
    now, sha = None, None
    for batch in batches:
        out = []
        for node, piece in zip(batch["node"].to_pylist(), batch["ids"].to_pylist()):
            if node != now:
                if now is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(piece.encode())
            else:
                sha.update(f",{piece}".encode())
        yield _record(out, _ENDS)
    if now is not None:
        yield _record([(now, sha.hexdigest())], _ENDS)


# -- the trie ------------------------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), those with one turn by the digest of role and text; repeated rows are
    repeated turns. Null roles and texts are empty. Rows without a conv_id belong to no conversation and are left out. For
    negative ids the remainder by 100 has their sign. An empty table gives an empty result, one turnless
    conversation a root alone. Other columns are ignored.

    The turns of one conversation are numbered and chained by one task, as a stream of digests.
    """
    ship(conversations.sparkSession)
    folder = shared_folder(conversations.sparkSession)
    way = paths(rebuilt(conversations.select("conv_id", "turn", "role", "text"), folder), folder)
    nodes = way.mapInArrow(lambda it: _count(it, shard_rows), _ddl(_COUNTS)).groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("n").alias("n"),
        F.sum("n_convs").alias("n_convs"), F.min("owner").alias("conv_id"), F.max("goes_on").alias("goes_on"))
    nodes = written(nodes, folder, "nodes")
    owned = nodes.select("conv_id", "depth", F.lit(True).alias("owned"), ((F.col("n_convs") - 1) * F.col("n")).alias("saved"),
                         (~F.col("goes_on")).cast("long").alias("leaf"))
    marked = way.select("conv_id", "depth", "node").join(owned, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "node", F.coalesce("owned", F.lit(False)).alias("owned"),
        F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    dealt = marked.repartition(F.floor(F.col("conv_id") / FAMILY)).sortWithinPartitions("conv_id", F.desc("depth"))
    sums = dealt.mapInArrow(lambda it: _accumulate(it, shard_rows), _ddl(_SUMS)).groupBy("node").agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.sum("children").alias("n_children"))
    pieces = way.filter("ends").groupBy("node", F.shiftright("conv_id", 12).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ends = pieces.repartition("node").sortWithinPartitions("node", "block").select("node", "ids").mapInArrow(
        _end_hashes, "node binary, ends_sha256 string")
    # The owner of a parent; the many children of a hot parent are split by the adaptive planner.
    owners = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.filter("depth > 0").join(owners, "parent")
    placed = inner.select("node", "conv_id", "depth", "parent_conv_id", "n_convs").union(
        nodes.filter("depth = 0").select("node", "conv_id", "depth", F.lit(None).cast("long"), "n_convs"))
    return placed.join(sums, "node").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))
