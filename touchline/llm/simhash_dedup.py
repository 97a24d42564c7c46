"""SimHash near-dedup by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most four bits, cut into three segments, have a segment in which
they differ in at most one bit: three segments with two differences each would make six. Every distinct
fingerprint is therefore indexed under its 64 one-wildcard variants (segment, place of the wildcard, the
other bits of the segment). Fingerprints that share a variant are candidates and are verified on all 64 bits.

Equal fingerprints are first reduced to one row, so copies never meet. Within a variant the verified links
are reduced to a spanning forest, found by visiting: a member is compared with those not reached yet, all at
once. A dense group is used up by its first few members, so neither its pairs are written nor its square is
computed, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import components, one_per_id, shared_folder, written

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = ((0, 21), (21, 21), (42, 22))

_BITS = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes: a bit is set if it is in over half of them; zero of none."""
    n = len(hashes)
    if not n:
        return 0
    lanes = hashes.view(np.uint8).reshape(n, 8)
    # A table spreads the bits of a byte over the bytes of a word; up to 255 words add up without a carry.
    cuts = np.arange(0, n, 255)
    counts = np.add.reduceat(_BITS[lanes], cuts, axis=0).view(np.uint8).reshape(len(cuts), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text: a bit is set if it is in over half of the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.append(blanks, len(joined))
    n = max(1, len(words) - SHINGLE + 1)
    ends = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    parts = map(joined.__getitem__, map(slice, starts[:n].tolist(), ends.tolist()))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64, n))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).fill_null(b"")
        prints = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].cast(pa.int64()), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def variants(fp: str = "fp") -> "Column":  # noqa: F821
    """The 64 signatures of a fingerprint: wildcard place and the rest of its segment."""
    out = []
    for low, width in SEGMENTS:
        segment = F.shiftrightunsigned(fp, low).bitwiseAND((1 << width) - 1)
        out += [
            segment.bitwiseOR(1 << i).bitwiseOR(F.lit((low + i) << 22).cast("long")) for i in range(width)
        ]
    return F.array(*out)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def forest(prints: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Places of linked pairs that span the components of a group of distinct fingerprints."""
    out: list[tuple[int, int]] = []
    left = np.arange(len(prints))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _popcount(prints[left] ^ prints[at]) <= max_bits
            reached = left[near].tolist()
            out += [(at, r) for r in reached]
            queue += reached
            left = left[~near]
    return out


def _linked(keys: np.ndarray, prints: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links of all whole groups of equal, sorted keys."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    two = first[size == 2]
    two = two[_popcount(prints[two] ^ prints[two + 1]) <= max_bits]
    a, b = [two], [two + 1]
    for lo, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
        pairs = np.array(forest(prints[lo : lo + n], max_bits), np.int64).reshape(-1, 2) + lo
        a.append(pairs[:, 0])
        b.append(pairs[:, 1])
    return prints[np.concatenate(a)], prints[np.concatenate(b)]


def _verify(batches: Iterator[pa.RecordBatch], max_bits: int = MAX_BITS) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key; the last, perhaps open group of a batch waits for the next one."""
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def out(k, p):
        x, y = _linked(k, p, max_bits) if len(k) else (p, p)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    for batch in batches:
        keys = np.concatenate([keys, batch["key"].to_numpy()])
        prints = np.concatenate([prints, batch["fp"].to_numpy().view(np.uint64)])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        yield out(keys[:cut], prints[:cut])
        keys, prints = keys[cut:], prints[cut:]
    yield out(keys, prints)


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: at least a spanning forest of all links.

    All pairs of up to five differing bits share a signature. With a greater ``max_bits`` the links are those of the
    pairs that share one, for a caller that has another way to the rest.
    """
    keyed = distinct.select("fp", F.explode(variants()).alias("key"))
    verify = partial(_verify, max_bits=max_bits)
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(verify, "a long, b long")


def dedup_simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id (least doc_id reachable by links).

    Texts in lower case (A-Z), words without ASCII white space, shingles of four words with repeats; fewer
    words are one shingle, null and empty texts have fingerprint zero and link like any other. Repeated
    doc_ids: the row with the greatest text counts. Null doc_id: a document of its own whose id, least of all,
    is null; components that it belongs to have a null id. An empty table gives an empty result. Other
    columns are ignored.
    """
    folder = shared_folder(docs.sparkSession)
    least = F.lit(-(2**63)).cast("long")
    own = written(fingerprints(one_per_id(docs, "doc_id", "text")), folder, "fingerprints")
    distinct = written(own.groupBy("fp").agg(F.min(F.coalesce("doc_id", least)).alias("rep")), folder, "distinct")
    links = written(fingerprint_links(distinct.select("fp")).distinct(), folder, "links")
    joined = components(links, folder)
    reps = joined.join(distinct, F.col("node") == F.col("fp")).select("fp", "component", "rep")
    heads = reps.groupBy("component").agg(F.min("rep").alias("head"))
    linked = reps.join(heads, "component").select("fp", "head")
    heads = written(
        distinct.join(linked, "fp", "left").select("fp", F.coalesce("head", "rep").alias("head")), folder, "heads"
    )
    return own.join(heads, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("head") != least, F.col("head")).alias("component_id"),
    )
