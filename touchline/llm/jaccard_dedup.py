"""Near-dedup by five-word shingles: documents whose sets of shingles have a Jaccard similarity of 0.8 or more are linked.

Candidates come from two methods, and all of them are compared exactly, on the sets of 64-bit shingle hashes:

* SimHash, by the operator of ``simhash_dedup``: fingerprints of the shingles that share one of its 64 signatures and
  differ in at most ``SIMHASH_BITS`` bits. It takes every pair of up to five bits; pairs on the limit of 0.8 differ in
  eight to eleven as a rule, and many of them share no signature.
* MinHash for these: ``BANDS`` keys of a document each join ``ROWS`` values. A pair on the limit shares a key with
  probability 1 - (1 - 0.8^4)^20 = 0.99997, closer pairs more surely, unrelated ones hardly ever.

Equal sets are one row, so copies do not meet. Rows are first compared with the least row that SimHash links them to and
with the least that they meet in any key; only keys that then still hold several components are compared in full, pair by pair of different components.
A key of more than ``BLOCK`` rows is cut into blocks whose pairs of blocks go to different tasks. What leaves a
task are links that span the components, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import components, shared_folder, written
from touchline.llm.simhash_dedup import fingerprint_links, majority

SHINGLE = 5
ROWS = 4
BANDS = 20
BLOCK = 256
SIMHASH_BITS = 12
_AT_ONCE = 2048
_RANDOM = np.random.default_rng(7)
_SEEDS = _RANDOM.integers(0, 2**64, ROWS * BANDS, dtype=np.uint64)
_MULT = _RANDOM.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CELL = ["key", "row", "col"]


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than a shingle has are one, no words are none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.append(blanks, len(joined))
    n = max(1, len(words) - SHINGLE + 1)
    ends = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    parts = map(joined.__getitem__, map(slice, starts[:n].tolist(), ends.tolist()))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64, n))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key per band; none of an empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, len(hashes), _AT_ONCE):
            np.minimum(least, ((hashes[lo : lo + _AT_ONCE, None] ^ _SEEDS) * _MULT).min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.fromiter((xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)), np.uint64, BANDS).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch["text"].cast(pa.binary()).fill_null(b"")]
        yield pa.RecordBatch.from_arrays([
            batch["id"], pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())),
            pa.array(np.fromiter(map(majority, sets), np.uint64, len(sets)).view(np.int64)),
        ], names=["id", "content", "bands", "fp"])


def near(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the sorted, not empty sets have a Jaccard similarity of 0.8 or more with ``one``; in whole numbers."""
    size = np.array([len(s) for s in others], np.int64)
    shared = np.zeros(len(others), np.int64)
    # A pair of the similarity has sizes of at most 4 to 5.
    fit = np.flatnonzero((5 * size >= 4 * len(one)) & (5 * len(one) >= 4 * size))
    if len(fit):
        all_ = np.concatenate([others[i] for i in fit])
        hit = one[np.minimum(np.searchsorted(one, all_), len(one) - 1)] == all_
        shared[fit] = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(size[fit])[:-1]]))
    return 9 * shared >= 4 * (size + len(one))


def _cell_links(rep: np.ndarray, component: np.ndarray, texts: list[bytes]) -> list[tuple[int, int]]:
    """Links of a cell that join its components as all its pairs would."""
    sets, label = [shingles(t) for t in texts], component.copy()
    out: list[tuple[int, int]] = []
    for i in range(len(rep) - 1):
        rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not len(rest):
            continue
        for j in rest[near(sets[i], [sets[k] for k in rest])].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((int(rep[i]), int(rep[j])))
    return out


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by cell; the last, perhaps open cell of a batch waits for the next one."""
    def out(table: pa.Table) -> pa.RecordBatch:
        links: list[tuple[int, int]] = []
        keys = [table[c].to_numpy() for c in _CELL]
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        rep, component = table["rep"].to_numpy(), table["component"].to_numpy()
        for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(rep)]):
            links += _cell_links(rep[lo:hi], component[lo:hi], table["text"].slice(lo, hi - lo).to_pylist())
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in links], pa.int64()) for i in range(2)], names=["a", "b"]
        )

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = [table[c].to_numpy() for c in _CELL]
        other = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0)) if len(table) else []
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield out(table.slice(0, cut))
        held = table.slice(cut)
    if held is not None and len(held):
        yield out(held)


def _compared(cells: DataFrame, texts: DataFrame) -> DataFrame:
    rows = cells.join(texts, "rep").select(*_CELL, "rep", "component", "text")
    return rows.repartition(*_CELL).sortWithinPartitions(*_CELL, "rep").mapInArrow(_cells, "a long, b long")


def _part(cuts: str) -> "Column":  # noqa: F821
    return F.pmod(F.xxhash64("rep", "key"), F.col(cuts)).cast("int")


def simhash_pairs(distinct: DataFrame, folder: str) -> DataFrame:
    """Each row (rep, fp) that SimHash links to a lesser one, with the least of these as ``key``.

    Rows of one fingerprint are linked to the least of them, which stands for the fingerprint in all other links.
    """
    heads = written(distinct.groupBy("fp").agg(F.min("rep").alias("head")), folder, "heads")
    links = fingerprint_links(heads.select("fp"), SIMHASH_BITS).distinct()
    one, two = (heads.select(F.col("fp").alias(c), F.col("head").alias(f"{c}_rep")) for c in ("a", "b"))
    linked = links.join(one, "a").join(two, "b").select(
        F.least("a_rep", "b_rep").alias("key"), F.greatest("a_rep", "b_rep").alias("rep"))
    alike = distinct.join(heads, "fp").filter("rep <> head").select(F.col("head").alias("key"), "rep")
    return written(linked.union(alike).groupBy("rep").agg(F.min("key").alias("key")).select("key", "rep"), folder, "simhash")


def least_of_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``id`` of the documents (id, text) that are the least of their group, ids being distinct and not null.

    Words are in lower case (A-Z) and without ASCII white space; texts without words, null too, are one group.
    """
    folder = shared_folder(docs.sparkSession)
    own = written(docs.select("id", "text").mapInArrow(
        _signatures, "id long, content binary, bands array<long>, fp long"), folder, "signatures")
    distinct = written(
        own.groupBy("content").agg(
            F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("fp").alias("fp")).drop("content"),
        folder, "distinct",
    )
    texts = docs.select(F.col("id").alias("rep"), F.col("text").cast("binary").alias("text"))
    keyed = distinct.select("rep", F.explode("bands").alias("key"))
    full = keyed.groupBy("key").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    meets = written(keyed.join(full.select("key", "head"), "key"), folder, "meets")

    # Each row with the least one that SimHash links it to, and with the least that it meets in any key. A text without
    # words has no keys and is like no other.
    star = meets.filter("rep <> head").groupBy("rep").agg(F.min("head").alias("key")).select("key", "rep")
    worded = distinct.filter(F.size("bands") > 0)
    star = star.union(simhash_pairs(worded.select("rep", "fp"), folder)).distinct()
    cuts = star.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("cuts"))
    members = star.join(cuts, "key").select("key", "rep", _part("cuts").alias("row"))
    heads = cuts.select("key", F.col("key").alias("rep"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("row"))
    cells = members.union(heads).select("key", "row", F.lit(0).alias("col"), "rep", F.col("rep").alias("component"))
    first = written(_compared(cells, texts), folder, "first")

    # Whatever is not joined by that, in full.
    joined = written(components(first, folder), folder, "joined").withColumnRenamed("node", "rep")
    state = meets.select("key", "rep").join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = state.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("cuts"),
        F.min("component").alias("lo"), F.max("component").alias("hi"),
    ).filter("lo <> hi").select("key", "cuts")
    rest = state.join(open_, "key").withColumn("part", _part("cuts"))
    cells = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).select(
        "key", F.least("part", "other").alias("row"), F.greatest("part", "other").alias("col"), "rep", "component"
    )
    second = written(_compared(cells, texts), folder, "second")
    groups = components(first.union(second), folder)
    below = groups.filter("node <> component").select(F.col("node").alias("rep"))
    return distinct.select("rep").join(below, "rep", "left_anti").withColumnRenamed("rep", "id")
