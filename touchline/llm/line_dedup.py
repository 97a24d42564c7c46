"""Line dedup by a sharded minimal perfect hash.

The distinct keys of lines are counted once (an aggregation with map-side combining; a document counts a
key once). The keys that lose lines are the members of the perfect hash: per shard of the key hash a
displacement table sends each member to its own slot of compact arrays that hold a 64-bit fingerprint,
the document count and the largest document id. Documents probe the arrays where they are; neither texts
nor lines are shuffled.

The summed size of the arrays is known before, as the number of members. Up to ``BROADCAST_BYTES`` they are sent to
the executors, and documents probe them where they are. A larger index does not pass through the driver: lines go to it
as hashes and numbers, without texts, to tasks that hold one shard at a time; a shard of very common lines has several
tasks, each with a copy of its arrays. The numbers of the lines that go then meet the documents, which are read once
more. The result is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import id_arrays, new_name, one_per_id, shared_folder, written

MIN_LENGTH = 40
MIN_DOCUMENTS = 5
# Members of one shard at most, on average; a displacement table is built per shard by one task.
SHARD_MEMBERS = 1 << 15
MEMBER_BYTES = 24
BROADCAST_BYTES = 64 << 20
# Lines that one task probes against a shard, on average.
TASK_LINES = 1 << 20
_STRIP = b" \t\n\x0b\x0c\r"


def _line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of the lines whose key is long enough, and the slot hash and fingerprint of these keys."""
    at, keys = [], []
    for i, line in enumerate(text.split(b"\n")):
        if len(line) >= MIN_LENGTH:
            key = line.strip(_STRIP).lower()
            if len(key) >= MIN_LENGTH and (key.isascii() or len(key.decode("utf-8", "replace")) >= MIN_LENGTH):
                at.append(i)
                keys.append(key)
    h1 = np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))
    h2 = np.fromiter((xxhash.xxh64_intdigest(k, 7) for k in keys), np.uint64, len(keys))
    return np.array(at, np.int64), h1, h2


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = id_arrays(batch["doc_id"]), []
        for i, text in enumerate(batch["text"].cast(pa.binary()).fill_null(b"")):
            _, h1, h2 = _line_hashes(text.as_py())
            _, first = np.unique(h1, return_index=True)
            found.append((np.full(len(first), ids[i]), h1[first].view(np.int64), h2[first].view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*found)], names=["doc_id", "h1", "h2"]
        ) if found else pa.RecordBatch.from_pydict(
            {c: pa.array([], pa.int64()) for c in ("doc_id", "h1", "h2")})


def repeated_keys(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """slot hash h1, fingerprint h2, number of documents and largest doc_id of each key in enough documents."""
    hashed = docs.select("doc_id", "text").mapInArrow(_hash_texts, "doc_id long, h1 long, h2 long")
    counted = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
    return counted.filter(F.col("n") >= min_documents)


# -- the perfect hash ----------------------------------------------------------------------------------------


def mixed(x: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def build_shard(h1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements per bucket, and the slot of each member: hash, displace, largest bucket first.

    Members are distinct 64-bit hashes; each gets its own slot of 0..n-1.
    """
    n = len(h1)
    buckets = n // 4 + 1
    home = mixed(h1, 1) % np.uint64(buckets)
    order = np.argsort(home, kind="stable")
    starts = np.searchsorted(home[order], np.arange(buckets + 1))
    shift = np.zeros(buckets, np.uint32)
    slots = np.zeros(n, np.int64)
    used = np.zeros(n, bool)
    for b in np.argsort(-np.diff(starts), kind="stable"):
        members = order[starts[b] : starts[b + 1]]
        if not len(members):
            break
        base = 2
        while True:
            seeds = np.arange(base, base + 64, dtype=np.uint64)
            at = (mixed(h1[members][None, :], seeds[:, None]) % np.uint64(n)).astype(np.int64)
            fits = ~used[at].any(axis=1)
            if len(members) > 1:
                ranked = np.sort(at, axis=1)
                fits &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if fits.any():
                best = int(fits.argmax())
                shift[b], slots[members] = base + best, at[best]
                used[at[best]] = True
                break
            base += 64
    return shift, slots


class LineIndex:
    """Shards of perfect hashes with their arrays; probes are vectorised."""

    def __init__(self, n_shards: int, rows: list[tuple[int, bytes, bytes, bytes, bytes]]):
        self.n_shards = n_shards
        parts = {r[0]: r[1:] for r in rows}
        shift, prints, counts, last = [], [], [], []
        self.buckets, self.sizes = np.zeros(n_shards, np.uint64), np.zeros(n_shards, np.uint64)
        for s in range(n_shards):
            a, b, c, d = parts.get(s, (b"", b"", b"", b""))
            shift.append(np.frombuffer(a, np.uint32))
            prints.append(np.frombuffer(b, np.int64))
            counts.append(np.frombuffer(c, np.int64))
            last.append(np.frombuffer(d, np.int64))
            self.buckets[s], self.sizes[s] = len(shift[-1]), len(prints[-1])
        self.bucket_start = np.concatenate([[0], np.cumsum(self.buckets)])[:-1].astype(np.int64)
        self.slot_start = np.concatenate([[0], np.cumsum(self.sizes)])[:-1].astype(np.int64)
        self.shift, self.prints = np.concatenate(shift), np.concatenate(prints)
        self.counts, self.last = np.concatenate(counts), np.concatenate(last)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1 where it is no member."""
        out = np.full(len(h1), -1, np.int64)
        shard = ((h1 >> np.uint64(1)) % np.uint64(self.n_shards)).astype(np.int64)
        here = np.flatnonzero(self.sizes[shard] > 0)
        h, s = h1[here], shard[here]
        bucket = self.bucket_start[s] + (mixed(h, 1) % self.buckets[s]).astype(np.int64)
        slot = self.slot_start[s] + (mixed(h, self.shift[bucket]) % self.sizes[s]).astype(np.int64)
        hit = self.prints[slot] == h2[here].view(np.int64)
        out[here[hit]] = slot[hit]
        return out


def _build(key: tuple, group: pa.Table) -> pa.Table:
    h1 = group["h1"].to_numpy().view(np.uint64)
    shift, slots = build_shard(h1)
    put = np.argsort(slots)
    arrays = [shift] + [group[c].to_numpy().astype(np.int64)[put] for c in ("h2", "n", "last")]
    return pa.table({
        "shard": pa.array([key[0].as_py()], pa.int64()),
        **{c: pa.array([a.tobytes()], pa.binary()) for c, a in zip(("shift", "prints", "counts", "lasts"), arrays)},
    })


def build_index(members: DataFrame, n_shards: int) -> DataFrame:
    """One row of arrays per shard."""
    sharded = members.withColumn("shard", F.shiftrightunsigned("h1", 1) % F.lit(n_shards).cast("long"))
    return sharded.groupBy("shard").applyInArrow(
        _build, "shard long, shift binary, prints binary, counts binary, lasts binary"
    )


# -- documents -----------------------------------------------------------------------------------------------

Batches = Iterator[pa.RecordBatch]


def _probe_texts(batches: Batches, index: LineIndex, mark: str) -> Batches:
    """Batches with the numbers of the lines that go in column ``mark``."""
    for batch in batches:
        ids = id_arrays(batch["doc_id"])
        texts = batch["text"].cast(pa.binary()).fill_null(b"")
        marked: list[list[int] | None] = [None] * len(ids)
        for i, text in enumerate(texts):
            at, h1, h2 = _line_hashes(text.as_py())
            if len(at) and len(index.last):
                slot = index.probe(h1, h2)
                lose = at[(slot >= 0) & (index.last[np.maximum(slot, 0)] != ids[i])]
                if len(lose):
                    marked[i] = lose.tolist()
        yield batch.append_column(mark, pa.array(marked, pa.list_(pa.int32())))


def _line_rows(batches: Batches) -> Batches:
    """Hashes of the lines with a long key: id, text_md5, line, h1, h2."""
    for batch in batches:
        ids = id_arrays(batch["doc_id"])
        for i, text in enumerate(batch["text"].cast(pa.binary()).fill_null(b"")):
            raw = text.as_py()
            at, h1, h2 = _line_hashes(raw)
            if len(at):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), ids[i])), pa.array([hashlib.md5(raw).digest()] * len(at)),
                    pa.array(at.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                ], names=["id", "text_md5", "line", "h1", "h2"])


def _probe_lines(batches: Batches, n_shards: int) -> Batches:
    """Lines that go; the arrays of a shard come before its lines."""
    shard, index = None, None
    for batch in batches:
        shards = batch["shard"].to_numpy()
        for lo in np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])).tolist() if len(shards) else []:
            part = batch.slice(lo, int(np.searchsorted(shards[lo:] != shards[lo], True)))
            arrays = part["shift"].is_valid().to_numpy(zero_copy_only=False)
            if shard != shards[lo]:
                shard, index = shards[lo], None
            for row in part.filter(pa.array(arrays)).select(["shard", "shift", "prints", "counts", "lasts"]).to_pylist():
                index = LineIndex(n_shards, [tuple(row.values())])
            lines = part.filter(pa.array(~arrays))
            if index is None or not lines.num_rows:
                continue
            slot = index.probe(lines["h1"].to_numpy().view(np.uint64), lines["h2"].to_numpy().view(np.uint64))
            lose = (slot >= 0) & (index.last[np.maximum(slot, 0)] != lines["id"].to_numpy())
            yield lines.filter(pa.array(lose)).select(["id", "text_md5", "line"])


def _lines_that_go(docs: DataFrame, members: DataFrame, shards: DataFrame, n_shards: int, task_lines: int) -> DataFrame:
    """id, text_md5 and the numbers of the lines that go, by tasks that hold one shard at a time."""
    lines = docs.select("doc_id", "text").mapInArrow(_line_rows, "id long, text_md5 binary, line int, h1 long, h2 long")
    shard = F.shiftrightunsigned("h1", 1) % F.lit(n_shards).cast("long")
    # A member's lines are as many as its documents at least; shards with very common lines get several tasks.
    copies = members.groupBy(shard.alias("shard")).agg(F.ceil(F.sum("n") / task_lines).cast("int").alias("copies"))
    arrays = shards.join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    lines = lines.withColumn("shard", shard).join(copies, "shard").withColumn(
        "copy", F.pmod(F.xxhash64("id", "text_md5", "line"), F.col("copies")).cast("int")).drop("copies")
    both = arrays.unionByName(lines, allowMissingColumns=True)
    dealt = both.repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("shift").isNull())
    gone = dealt.select("shard", "shift", "prints", "counts", "lasts", "id", "text_md5", "line", "h1", "h2").mapInArrow(
        lambda it: _probe_lines(it, n_shards), "id long, text_md5 binary, line int")
    return gone.groupBy("id", "text_md5").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def mark_lines(docs: DataFrame, finish: Callable[[Batches, str], Batches], schema, min_documents: int = MIN_DOCUMENTS,
               broadcast_bytes: int = BROADCAST_BYTES, task_lines: int = TASK_LINES) -> DataFrame:
    """``finish`` of the rows of ``docs`` with one more column, the numbers of the lines that go (null: none)."""
    spark = docs.sparkSession
    folder, mark = shared_folder(spark), new_name(docs, "_dropped")
    members = written(repeated_keys(docs, min_documents), folder, "members")
    total = members.count()
    n_shards = total // SHARD_MEMBERS + 1
    shards = written(build_index(members, n_shards), folder, "shards")
    if total * MEMBER_BYTES <= broadcast_bytes:
        index = spark.sparkContext.broadcast(LineIndex(n_shards, [tuple(r) for r in shards.toLocalIterator()]))
        return docs.mapInArrow(lambda it: finish(_probe_texts(it, index.value, mark), mark), schema)
    own = [new_name(docs, c) for c in ("_id", "_text_md5", mark)]
    gone = _lines_that_go(docs, members, shards, n_shards, task_lines).toDF(*own)
    key = F.coalesce("doc_id", F.lit(-(2**63))).cast("long")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    marked = docs.join(gone, (key == F.col(own[0])) & (digest == F.col(own[1])), "left").select(*docs.columns, mark)
    return marked.mapInArrow(lambda it: finish(it, mark), schema)


def kept_text(text: bytes, dropped: list[int] | None) -> bytes:
    if not dropped:
        return text
    gone = set(dropped)
    return b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)


def _clean(batches: Batches, mark: str) -> Batches:
    for batch in batches:
        texts = [t.as_py() for t in batch["text"].cast(pa.binary()).fill_null(b"")]
        dropped = batch[mark].to_pylist()
        kept = [kept_text(t, d) for t, d in zip(texts, dropped)]
        yield pa.RecordBatch.from_arrays([
            batch["doc_id"].cast(pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
            pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()),
            pa.array([len(d or ()) for d in dropped], pa.int64()),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ], names=["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"])


def dedup_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, broadcast_bytes: int = BROADCAST_BYTES,
                task_lines: int = TASK_LINES) -> DataFrame:
    """Documents without their repeated lines: doc_id, text, n_lines, n_dropped, kept_sha256.

    A line's key is the line without white space at its ends, in lower case (A-Z). A key of at least 40 code
    points found in at least ``min_documents`` documents stays only in the largest doc_id that holds it. A
    document that holds it several times counts once, and loses or keeps all of them. Null and empty texts are
    one empty line. Repeated doc_ids: the row with the greatest text counts. Null doc_id: the least id. An
    empty table gives an empty result. Other columns of ``docs`` are ignored.
    """
    docs = one_per_id(docs, "doc_id", "text")
    schema = "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string"
    return mark_lines(docs, _clean, schema, min_documents, broadcast_bytes, task_lines)


def _clean_rows(batches: Batches, mark: str) -> Batches:
    for batch in batches:
        texts = batch["text"].to_pylist()
        for i, dropped in enumerate(batch[mark].to_pylist()):
            if dropped:
                texts[i] = kept_text(texts[i].encode(), dropped).decode()
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type)).drop_columns([mark])


def dedup_rows(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, broadcast_bytes: int = BROADCAST_BYTES,
               task_lines: int = TASK_LINES) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text and more), the texts without their repeated lines.

    As ``dedup_lines``, but a null text stays null and rows of one doc_id stay apart and count one by one. Columns of
    any name come along.
    """
    return mark_lines(docs, _clean_rows, docs.schema, min_documents, broadcast_bytes, task_lines)
