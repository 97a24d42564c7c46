"""Embedding near-dedup by Euclidean p-stable hashing.

Normalised vectors are projected on random Gaussian directions, shifted and cut into cells of width ``WIDTH``;
``PROJECTIONS`` cells make the bucket of one of ``TABLES`` tables. Vectors of cosine 0.95 are 0.316 apart and
agree in a cell with probability 0.874, so a pair on the limit shares a bucket in at least one table with
probability 1 - (1 - 0.874^14)^40 = 0.9986; closer pairs do so more surely, unrelated ones hardly ever.

Equal vectors are one row with a count, so copies do not meet. A bucket with the same members as one of an earlier
table has no new pair and is left out. Rows of the other buckets are compared exactly (double precision), and a pair
is counted in the first bucket that it shares, which both rows tell from their buckets. What leaves a task is a number of links per vector and its component among the rows, not the pairs.
A bucket of more than ``BLOCK`` rows is cut into blocks whose pairs of blocks go to different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import components, ragged, shared_folder, written

COSINE = 0.95
WIDTH = 2.0
PROJECTIONS = 14
TABLES = 40
BLOCK = 2048
# Groups of up to so many rows are compared pair by pair, all at once.
_SMALL = 64
_PAIRS_AT_ONCE = 200_000
_SEED = 3


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as a matrix, zero where they cannot link, and which ones can; short ones are filled up."""
    rows = column.to_pylist()
    width = max((len(r) for r in rows if r), default=1)
    out = np.zeros((len(rows), width))
    good = np.zeros(len(rows), bool)
    for i, r in enumerate(rows):
        if r and None not in r and np.isfinite(v := np.array(r, np.float64)).all() and (v != 0).any():
            out[i, : len(r)], good[i] = v, True
    return out, good


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_ids(unit: np.ndarray) -> np.ndarray:
    """A 64-bit bucket id per row and table; the last six bits are the number of the table."""
    rng = np.random.default_rng(_SEED)
    # One direction after the other, so that the directions of a shorter vector begin like those of a longer one.
    n = TABLES * PROJECTIONS
    shift = rng.uniform(0, WIDTH, n)
    mult = rng.integers(1, 2**62, n, dtype=np.int64) * 2 + 1
    directions = np.random.default_rng(_SEED + 1).standard_normal((unit.shape[1], n))
    cells = np.floor((unit @ directions + shift) / WIDTH).astype(np.int64)
    with np.errstate(over="ignore"):
        ids = (cells * mult).reshape(len(unit), TABLES, PROJECTIONS).sum(axis=2)
        ids = (ids ^ (ids >> 29)) * np.int64(-0x40A7B892E31B1A47)
        return (ids ^ (ids >> 32)) & np.int64(-64) | np.arange(TABLES)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, _ = _matrix(batch["embedding"])
        ids = bucket_ids(_unit(x)) if len(x) else np.zeros((0, TABLES), np.int64)
        yield pa.RecordBatch.from_arrays([
            batch["rep"],
            pa.FixedSizeListArray.from_arrays(pa.array(ids.ravel()), TABLES).cast(pa.list_(pa.int64())),
        ], names=["rep", "buckets"])


def _near(x: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x[first], x[second]) >= COSINE


def _large(x: np.ndarray, rep: np.ndarray, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs between two lists of rows (equal: within the list), a slab of rows at a time."""
    for lo in range(0, len(first), 256):
        i, j = np.nonzero(x[first[lo : lo + 256]] @ x[second].T >= COSINE)
        p, q = first[lo : lo + 256][i], second[j]
        ok = rep[p] < rep[q] if first is second else rep[p] != rep[q]
        yield p[ok], q[ok]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row of each row's component under links between rows."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links_of(table: pa.Table) -> pa.RecordBatch:
    """What the whole cells (bucket of a table, pair of blocks) of a sorted table are to count."""
    bucket, row, col, rep, weight, block = (
        table[c].to_numpy() for c in ("bucket", "row", "col", "rep", "n", "block")
    )
    n = len(rep)
    x, _ = _matrix(table["embedding"].combine_chunks())
    x = _unit(x) if n else x
    # The buckets of each row by table, and where it has one.
    lists = table["buckets"].combine_chunks()
    held, of_row = lists.flatten().to_numpy(), np.repeat(np.arange(n), lists.value_lengths().to_numpy())
    buckets = np.zeros((n, TABLES), np.int64)
    has = np.zeros((n, TABLES), bool)
    buckets[of_row, held & 63], has[of_row, held & 63] = held, True
    number = bucket & 63
    new = np.ones(n, bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in (bucket, row, col)], axis=0)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    gained = np.zeros(n, np.int64)
    linked: list[tuple[np.ndarray, np.ndarray]] = []

    def take(p: np.ndarray, q: np.ndarray) -> None:
        # A pair is counted in the first bucket that it shares.
        for lo in range(0, len(p), _PAIRS_AT_ONCE):
            a, b = p[lo : lo + _PAIRS_AT_ONCE], q[lo : lo + _PAIRS_AT_ONCE]
            earlier = (buckets[a] == buckets[b]) & has[a] & has[b] & (np.arange(TABLES) < number[a][:, None])
            a, b = a[~earlier.any(axis=1)], b[~earlier.any(axis=1)]
            np.add.at(gained, a, weight[b])
            np.add.at(gained, b, weight[a])
            linked.append((a, b))

    small = (size <= _SMALL) & (row[start] == col[start])
    member = np.repeat(small, size)
    later = np.where(member, np.repeat(start + size, size) - np.arange(n) - 1, 0)
    cuts = np.searchsorted(np.cumsum(later), np.arange(0, int(later.sum()) + 1, _PAIRS_AT_ONCE))
    for lo, hi in zip(cuts, [*cuts[1:], n]):
        p = np.repeat(np.arange(lo, hi), later[lo:hi])
        q = ragged(np.arange(lo, hi) + 1, later[lo:hi])
        near = _near(x, p, q)
        take(p[near], q[near])
    for at in np.flatnonzero(~small):
        rows = np.arange(start[at], start[at] + size[at])
        first = rows[block[rows] == row[start[at]]]
        second = first if row[start[at]] == col[start[at]] else rows[block[rows] == col[start[at]]]
        for p, q in _large(x, rep, first, second):
            take(p, q)
    a = np.concatenate([p for p, _ in linked] or [np.zeros(0, np.int64)])
    b = np.concatenate([q for _, q in linked] or [np.zeros(0, np.int64)])
    root = _roots(n, a, b)
    some, inner = np.flatnonzero(gained), np.flatnonzero(root != np.arange(n))
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([rep[some], rep[inner]])), pa.array(np.concatenate([rep[some], rep[root[inner]]])),
        pa.array(np.concatenate([gained[some], np.zeros(len(inner), np.int64)])),
    ], names=["a", "b", "gained"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell; the last, perhaps open cell of a batch waits for the next one."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        keys = [table[c].to_numpy() for c in ("bucket", "row", "col")]
        other = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0)) if len(table) else []
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield _links_of(table.slice(0, cut).combine_chunks())
        held = table.slice(cut)
    if held is not None and len(held):
        yield _links_of(held.combine_chunks())


def embedding_links(distinct: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Rows (a, b, gained) over distinct vectors (rep, embedding, n): a = b brings a's links, a <> b says that both are connected.

    Only buckets with at least two vectors go on, and of buckets with the same members one: sets are told by their
    size, their least member and two sums of hashes. Vectors meet their buckets after that.
    """
    hashed = written(
        distinct.select("rep", "embedding").mapInArrow(_hash, "rep long, buckets array<long>"), folder, "buckets"
    )
    placed = hashed.select("rep", F.explode("buckets").alias("bucket"))
    member = F.xxhash64("rep")
    sets = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min("rep").alias("least"), F.bit_xor(member).alias("hash"),
        F.sum(F.shiftrightunsigned(member, 20)).alias("sum")).filter("size > 1")
    first = sets.groupBy("size", "least", "hash", "sum").agg(F.min_by("bucket", F.col("bucket").bitwiseAND(63)).alias("bucket"))
    cut = F.ceil(F.col("size") / block).cast("int")
    meets = written(placed.join(first.select("bucket", "size"), "bucket").withColumn("cuts", cut), folder, "meets")
    lists = meets.groupBy("rep").agg(F.collect_list("bucket").alias("buckets"))
    meets = meets.withColumn("block", F.pmod(F.xxhash64("rep", "bucket"), F.col("cuts")).cast("int"))
    cells = meets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).select(
        "rep", "bucket", "block", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"),
    )
    rows = cells.join(distinct.join(lists, "rep"), "rep")
    cell = ["bucket", "row", "col"]
    return rows.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(_cells, "a long, b long, gained long")


def dedup_embeddings(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding).

    Null, empty and zero vectors and those with null or non-finite components link with nothing: no links,
    their own component, kept. A shorter vector counts as filled up with zeros. Repeated vec_ids: the row
    with the greatest embedding counts. Null vec_id: the least id, given back as null. An empty table gives
    an empty result. Other columns are ignored.
    """
    folder = shared_folder(vectors.sparkSession)
    least = F.lit(-(2**63)).cast("long")
    own = vectors.select(F.coalesce(F.col("vec_id").cast("long"), least).alias("id"), "embedding")
    if not own.groupBy("id").count().filter("count > 1").isEmpty():
        own = own.groupBy("id").agg(F.max("embedding").alias("embedding"))
    v = F.col("embedding")
    usable = F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )
    # -0.0 and 0.0 are one number for grouping.
    kind = own.schema["embedding"].dataType.elementType.simpleString()
    own = own.select("id", F.when(usable, F.transform(v, lambda x: x + F.lit(0).cast(kind))).alias("embedding"))
    own = own.withColumn("content", F.sha2(F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))), 256))
    good = own.filter("embedding is not null")
    distinct = written(
        good.groupBy("content").agg(F.min("id").alias("rep"), F.first("embedding").alias("embedding"),
                                    F.count(F.lit(1)).alias("n")),
        folder, "distinct",
    )
    found = written(embedding_links(distinct, folder, block), folder, "found")
    joined = components(found.filter("a <> b").select("a", "b"), folder)
    gained = found.filter("a = b").groupBy("a").agg(F.sum("gained").alias("gained")).withColumnRenamed("a", "rep")
    # A component's least node is a least vec_id: nodes are the least ids of their copies.
    state = (
        distinct.select("content", "rep", "n").join(gained, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select("content", (F.col("n") - 1 + F.coalesce("gained", F.lit(0))).alias("links"),
                F.coalesce("component", "rep").alias("head"))
    )
    state = written(state, folder, "state")
    out = own.select("id", F.when(F.col("embedding").isNotNull(), F.col("content")).alias("content"))
    out = out.join(state, "content", "left").withColumn("head", F.coalesce("head", "id"))
    return out.select(
        F.when(F.col("id") != least, F.col("id")).alias("vec_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("head") != least, F.col("head")).alias("component_id"),
        (F.col("id") == F.col("head")).alias("kept"),
    )
