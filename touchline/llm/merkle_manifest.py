"""A Merkle manifest of a table, with a proof per row, in SQL expressions over concatenated levels.

The leaves of a source, in order, are cut into aligned blocks of 256. A block is one row: its leaves are one
string of hex digests, 64 characters each. As every run of 16 digests is a piece of fixed width of that string, a
parent is the hash of a substring, and the next level is again one string. The siblings of a node are the two
pieces that flank it in its run. The one digest that a block ends in is a leaf of the next round, until a source
has one block; the roots of the sources go through the same rounds as leaves of one group. Going
back down, a block hands each of its members the sibling pieces above it.

A row thus passes a few equi-joins of unique keys, and no task holds more than a block at a time, however many rows
a source has. Levels are kept as binary columns, in which a substring is found without counting characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shared_folder, ship, written
from touchline.llm.ordering import ranked

FAN = 16
LEVELS = 2
HEX = 64
# A block has FAN ** LEVELS nodes at most.
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<l:binary,r:binary>>"


def leaf_hash(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field is ``-`` if null, else its size in bytes, a colon and its value."""
    parts = []
    for value in fields.values():
        shown = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _nothing() -> Column:
    return F.lit("").cast("binary")


def _folded(nodes: Column) -> Column:
    """The level above: the digest of each run of 16, joined."""
    runs = F.sequence(F.lit(0), ((F.octet_length(nodes) - 1) / (FAN * HEX)).cast("int"))
    digests = F.transform(runs, lambda i: F.sha2(F.substring(nodes, i * (FAN * HEX) + 1, FAN * HEX), 256))
    return F.array_join(digests, "").cast("binary")


def _siblings(nodes: Column, at: Column) -> Column:
    """What stands before and after node ``at`` in its run."""
    start = at - at % FAN
    before = F.substring(nodes, start * HEX + 1, (at % FAN) * HEX)
    after = F.substring(nodes, (at + 1) * HEX + 1, (FAN - 1 - at % FAN) * HEX)
    return F.struct(before.alias("l"), after.alias("r"))


def _blocks(nodes: DataFrame, carried: list[str], folder: str, name: str) -> DataFrame:
    """(grp, block, total, members, low, mid, node) of nodes (grp, rank, total, node and what is carried along)."""
    members = F.sort_array(F.collect_list(F.struct((F.col("rank") % BLOCK).cast("int").alias("i"), "node", *carried)))
    blocks = nodes.groupBy("grp", F.floor(F.col("rank") / BLOCK).alias("block"), "total").agg(members.alias("members"))
    low = F.array_join(F.transform("members", lambda m: m["node"]), "").cast("binary")
    blocks = blocks.withColumn("low", low)
    # Levels that have more than one node, in the whole group: they are hashed in every block.
    blocks = blocks.withColumn("mid", F.when(F.col("total") > 1, _folded(F.col("low"))))
    top = F.when(F.col("total") > FAN, _folded(F.col("mid"))).otherwise(F.coalesce("mid", "low"))
    return written(blocks.withColumn("node", top.cast("string")), folder, name)


def _inner_path(at: Column) -> Column:
    """Sibling pieces of member ``at`` inside its block."""
    low = F.array(_siblings(F.col("low"), at)).cast(_PATH)
    mid = F.array(_siblings(F.col("mid"), F.floor(at / FAN).cast("int"))).cast(_PATH)
    none = F.array().cast(_PATH)
    return F.concat(F.when(F.col("total") > 1, low).otherwise(none), F.when(F.col("total") > FAN, mid).otherwise(none))


def _tower(nodes: DataFrame, carried: list[str], folder: str, name: str) -> list[DataFrame]:
    """The rounds of blocks, until every group has one block."""
    rounds = [_blocks(nodes, carried, folder, f"{name}-0")]
    while True:
        most = rounds[-1].agg(F.max("total")).first()[0] or 0
        if most <= BLOCK:
            return rounds
        # Groups that are done stay out of the next round; their last block is their root.
        upper = rounds[-1].filter(F.col("total") > BLOCK).select(
            "grp", F.col("block").alias("rank"), F.ceil(F.col("total") / BLOCK).alias("total"), "node")
        rounds.append(_blocks(upper, [], folder, f"{name}-{len(rounds)}"))


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """grp, node: the last block of each group."""
    out = None
    for blocks in rounds:
        done = blocks.filter(F.col("total") <= BLOCK).select("grp", "node")
        out = done if out is None else out.union(done)
    return out


def _with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with what is above them: ``above`` has grp, block, path and what all members of a group share."""
    above = above.withColumnRenamed("grp", "_grp").withColumnRenamed("block", "_block")
    same = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block"))
    return blocks.join(above, same).drop("_grp", "_block")


def _paths_down(rounds: list[DataFrame], tops: DataFrame, shared: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of the first round with the sibling pieces above them; ``tops`` has grp, path and ``shared``."""
    above = tops.select("grp", F.lit(0).cast("long").alias("block"), "path", *shared)
    for k in range(len(rounds) - 1, 0, -1):
        inner = F.transform("members", lambda m: F.struct(
            (F.col("block") * BLOCK + m["i"]).alias("block"), F.concat(_inner_path(m["i"]), F.col("path")).alias("path")))
        down = _with_paths(rounds[k], above).select("grp", F.explode(inner).alias("m"), *shared)
        # Groups that ended below have no block here; their path is that of the top.
        ended = rounds[k - 1].filter(F.col("total") <= BLOCK).select(F.col("grp").alias("_grp"))
        kept = above.join(ended, F.col("grp").eqNullSafe(F.col("_grp")), "left_semi")
        above = down.select("grp", "m.block", "m.path", *shared).union(kept)
    return _with_paths(rounds[0], above)


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified.

    Every row is a leaf, repeated rows and rows without an id too. Leaves of a source are in the order of doc_id
    (null first), rows with one doc_id in the order of their digests; a null source is a source of its own and
    comes first. Null fields count as ``-``, empty texts as ``0:``. A table of one row is its own root, with the proof of no
    siblings; an empty table gives an empty result. Other columns are ignored.

    ``folded_root`` is what a reader gets who has the siblings and the row; of one row in five the text is in
    lower case there, and ``verified`` is true only if that changed nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = shared_folder(spark)
    fields = {f: F.col(f) for f in FIELDS}
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select(
        "doc_id", F.col("source").alias("grp"), leaf_hash(fields).alias("node"),
        F.when(is_tampered(F.col("doc_id")), leaf_hash({**fields, "text": lowered})).alias("shown"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Rows that are alike in every column are told apart by their place in this file.
    leaves = written(leaves, folder, "leaves")
    placed = ranked(leaves, "grp", ["doc_id", "node", "row"], folder, "leaves-in-order")
    rounds = _tower(placed.drop("row"), ["doc_id", "shown"], folder, "blocks")
    subroots = written(_roots(rounds), folder, "subroots")
    whole = F.lit(0).alias("one")
    sources = ranked(subroots.select(whole, F.col("grp").alias("source"), "node"), "one", ["source"], folder, "sources-in-order")
    above = _tower(sources.withColumnRenamed("one", "grp"), ["source"], folder, "sources")
    # One row per source: its own root, the root of all, and the sibling pieces between them.
    top = _roots(above).select("grp", F.array().cast(_PATH).alias("path"), F.col("node").alias("root"))
    ends = F.transform("members", lambda m: F.struct(
        m["source"].alias("grp"), m["node"].alias("subroot"), F.concat(_inner_path(m["i"]), F.col("path")).alias("path")))
    of_sources = _paths_down(above, top, ("root",)).select(F.explode(ends).alias("m"), "root").select("m.*", "root")
    blocks = _paths_down(rounds, written(of_sources, folder, "of-sources"), ("subroot", "root"))

    def result(m: Column) -> Column:
        path = F.concat(_inner_path(m["i"]), F.col("path"))
        pieces = F.aggregate(path, _nothing(), lambda a, s: F.concat(a, s["l"], s["r"]))
        shown = F.coalesce(m["shown"], m["node"]).cast("binary")
        folded = F.aggregate(path, shown, lambda a, s: F.sha2(F.concat(s["l"], a, s["r"]), 256).cast("binary"))
        return F.struct(m["doc_id"].alias("doc_id"), m["node"].alias("leaf"), F.sha2(pieces, 256).alias("proof_sha256"),
                        folded.cast("string").alias("folded_root"))

    rows = blocks.select(F.col("grp").alias("source"), "subroot", "root", F.explode(F.transform("members", result)).alias("m"))
    return rows.select("m.doc_id", "source", "m.leaf", "subroot", "root", "m.proof_sha256", "m.folded_root").withColumn(
        "verified", F.col("folded_root") == F.col("root"))
