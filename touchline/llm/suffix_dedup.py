"""Suffix-array dedup: every byte covered by a 100-byte string that also starts earlier goes.

All suffixes of a corpus do not fit through a shuffle, and they need not: the array is sparse. Of every 100-byte
string one place is chosen by its content alone, the least of the hashes of its 32-byte grams (``anchors``). Equal
strings choose the same place, so they are found by comparing what surrounds their anchors. A text has an anchor
about every 35 bytes.

1. Anchors are counted by gram. One whose gram is found once cannot be part of a repeated string. Before the shuffle
   each task reduces anchors that agree in all 100-byte strings they stand for (two 64-bit hashes of gram and of
   surroundings) to the first one; the others are repeated for certain. A hot passage thus leaves
   each task once.
2. Repeated anchors get the bytes around them and are range-partitioned by the leading 32 bytes of the suffix, with
   splitters from a sample. Anchors with equal leading bytes are in one bucket.
3. A bucket sorts its suffixes, and the reversed prefixes, by a multikey quicksort on 8-byte keys that goes on only
   among ties, and takes the lengths of common prefixes of neighbours. Suffixes i and j share r bytes if no
   neighbour between them shares fewer, so a running count of the places below r numbers the classes of suffixes
   that agree in r bytes. A 100-byte string that starts o bytes before its anchor is a class of prefixes at
   o and of suffixes at 100 - o; all but the first of equal ones are repeated. A run of leading characters that is
   cut by a batch border is carried over and compared with the next batch.
4. Repeated strings of a document are merged to runs of bytes, which are removed.

Memory of a task is a chunk of texts, the hashes of the anchors of its texts, a bounded number of anchors, or the
anchors of one leading string of 32 bytes that have different surroundings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import byte_chunks, id_arrays, one_per_id, ragged, shared_folder, written

SPAN = 100
GRAM = 32
_WIDTH = SPAN - GRAM + 1
# One text of so many is read for splitters.
SAMPLE = 32
CHUNK_ANCHORS = 1 << 16
_TABLE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
_HIGH = np.uint64(0xFFFFFFFF00000000)

# The leading string of a suffix, by which buckets are cut: the 32 bytes of its gram, as four numbers that sort like them.
_LEAD_WORDS = GRAM // 8
_SIGN = np.int64(-(2**63))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


# Two hashes of surroundings: odd steps, their inverses and a number per byte.
_STEPS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INVERSES = tuple(pow(step, -1, 1 << 64) for step in _STEPS)
_TABLES = (_TABLE, np.random.default_rng(2).integers(1, 2**63, 256, dtype=np.uint64))


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Anchors of the texts of a chunk: (text, place, before, after, gram hash).

    ``before`` and ``after`` are the largest and the least distance from the start of a 100-byte string that
    chose the anchor.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none, none, none, none, none.view(np.uint64)
    with np.errstate(over="ignore"):
        h = _TABLE[data]
        step, size = np.uint64(0x9E3779B97F4A7C15), 1
        while size < GRAM:
            h = h[:-size] * step + h[size:]
            step, size = step * step, 2 * size
        h = _mix(h)
    key = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= _WIDTH:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    rest = _WIDTH - size
    key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
    # key[p] is the choice of the string at p; strings that cross texts are left out.
    starts = np.concatenate([np.arange(a, b - SPAN + 1) for a, b in zip(offsets[:-1], offsets[1:]) if b - a >= SPAN]
                            or [none])
    if not len(starts):
        return none, none, none, none, none.view(np.uint64)
    chosen = (key[starts] & ~_HIGH).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.append(first[1:], len(chosen)) - 1
    place = chosen[first]
    return np.searchsorted(offsets, place, "right") - 1, place, place - starts[first], place - starts[last], h[place]


# -- step 1: which anchors are repeated ----------------------------------------------------------------------

_KIND_REPEATED = 1


def _pack(place: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return (place << 16) | (before << 8) | after


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 16, (at >> 8) & 255, at & 255


def _surroundings(data, place, before, after, which: int) -> np.ndarray:
    """A hash of all strings that an anchor stands for, and of where it lies in them."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(data) + 1, _STEPS[which], np.uint64))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[which][data] * powers[:-1], out=sums[1:])
        lo, hi = place - before, place - after + SPAN
        # Dividing by the power of the start makes equal strings equal: the step is odd and has an inverse.
        inverse = np.cumprod(np.full(len(data) + 1, _INVERSES[which], np.uint64))
        value = (sums[hi] - sums[lo]) * inverse[lo]
        return _mix(value ^ _mix((before * 256 + after).astype(np.uint64) + np.uint64(77)))


class _Seen:
    """The first document and place of the anchors of a task so far, by the hash of their surroundings.

    Sorted runs, each at least twice as long as the next: an anchor is merged a few times only, and looked up in a
    few runs. A second hash tells apart what the first one does not.
    """

    def __init__(self):
        self.runs: list[list[np.ndarray]] = []  # hash, second hash, document, place

    def earlier(self, key: np.ndarray, check: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of anchors with distinct keys: which are known, and which of these are before what is known (it takes their place)."""
        met, less = np.zeros(len(key), bool), np.zeros(len(key), bool)
        for keys, checks, docs, places in self.runs:
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            here = np.flatnonzero((keys[at] == key) & (checks[at] == check))
            to = at[here]
            first = (doc[here] < docs[to]) | ((doc[here] == docs[to]) & (place[here] < places[to]))
            met[here], less[here] = True, first
            docs[to[first]], places[to[first]] = doc[here[first]], place[here[first]]
        return met, less

    def add(self, *columns: np.ndarray) -> None:
        self.runs.append(list(columns))
        while len(self.runs) > 1 and 2 * len(self.runs[-1][0]) > len(self.runs[-2][0]):
            both = [np.concatenate(c) for c in zip(self.runs.pop(-2), self.runs.pop())]
            order = np.argsort(both[0], kind="stable")
            self.runs.append([c[order] for c in both])


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, doc, at, kind): the first of equal anchors of this task with kind 0, later ones with kind 1."""
    seen = _Seen()
    for batch in batches:
        ids = id_arrays(batch["doc_id"])
        for lo, hi, data, offsets in byte_chunks(batch["text"]):
            text, place, before, after, gram = anchors(data, offsets)
            around = _surroundings(data, place, before, after, 0) ^ gram
            check = _surroundings(data, place, before, after, 1)
            doc, inner = ids[lo:hi][text], place - offsets[text]
            # The first of equal ones in the chunk, in order of documents, then against the earlier chunks.
            order = np.lexsort((inner, doc))
            keys, first, group = np.unique(around[order], return_index=True, return_inverse=True)
            first = order[first]
            met, less = seen.earlier(keys, check[first], doc[first], inner[first])
            seen.add(keys[~met], check[first[~met]], doc[first[~met]], inner[first[~met]])
            # Equal in the first hash alone: not known to be repeated, and left to the comparison of bytes.
            later = np.zeros(len(doc), bool)
            later[order] = check[order] == check[first][group]
            later[first[~met | less]] = False
            at = _pack(inner, before, after)
            with np.errstate(over="ignore"):
                spread = _mix(doc.view(np.uint64) * np.uint64(31) + at.view(np.uint64))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(later, spread, gram).view(np.int64)), pa.array(doc), pa.array(at),
                pa.array(later.astype(np.int8)),
            ], names=["gram", "doc", "at", "kind"])


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(doc, at, kind) of all anchors whose gram is found again; kind 1: known to be repeated with all its strings."""
    rows = docs.mapInArrow(_gram_rows, "gram long, doc long, at long, kind byte")
    rows = rows.repartition("gram").sortWithinPartitions("gram")
    return rows.mapInArrow(_again, "doc long, at long, kind byte")


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by gram those that share it with another row, or are of kind 1.

    Between batches one row is held: the last one, which may share its gram with the next, and whether it is out already.
    """
    columns = ("gram", "doc", "at", "kind")
    held, out_already = None, False
    for batch in batches:
        table = {c: batch[c].to_numpy() for c in columns}
        if not len(table["gram"]):
            continue
        if held is not None:
            table = {c: np.concatenate([held[c], table[c]]) for c in columns}
        same = table["gram"][1:] == table["gram"][:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (table["kind"] == _KIND_REPEATED)
        last = bool(keep[-1])
        if held is not None and out_already:
            keep[0] = False
            last = last and len(keep) > 1
        yield pa.RecordBatch.from_arrays([pa.array(table[c][keep]) for c in columns[1:]], names=columns[1:])
        held, out_already = {c: v[-1:] for c, v in table.items()}, last or (out_already and len(keep) == 1)


# Texts go through two shuffles; compressed they are about a third smaller than in Spark's shuffle files.
_CODEC = "zstd"
_PACKED = "doc_id long, size long, packed binary"


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec(_CODEC, compression_level=3)
    for batch in batches:
        texts = [t.as_py() for t in batch["text"].cast(pa.binary()).fill_null(b"")]
        yield pa.RecordBatch.from_arrays([
            batch["doc_id"].cast(pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary()),
        ], names=["doc_id", "size", "packed"])


def _unpack_texts(batch: pa.RecordBatch) -> list[bytes]:
    codec = pa.Codec(_CODEC)
    pairs = zip(batch["packed"], batch["size"].to_pylist())
    return [codec.decompress(p.as_buffer(), n, asbytes=True) if n else b"" for p, n in pairs]


# -- step 2: suffixes ----------------------------------------------------------------------------------------


def _lead(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The leading strings as rows of numbers, in whose order the strings are."""
    words = np.ndarray(len(data) - 7, ">u8", np.ascontiguousarray(data), strides=(1,))
    return np.stack([words[place + 8 * i].astype(np.uint64).view(np.int64) ^ _SIGN for i in range(_LEAD_WORDS)], axis=1)


def _sample_leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in byte_chunks(batch["text"]):
            _, place, *_ = anchors(data, offsets)
            if len(place):
                lead = _lead(data, place)
                yield pa.RecordBatch.from_arrays([pa.array(lead[:, i].copy()) for i in range(_LEAD_WORDS)], names=_LEADS)


_LEADS = [f"w{i}" for i in range(_LEAD_WORDS)]


def splitters(docs: DataFrame, n: int) -> list[tuple[int, ...]]:
    """Leading strings that cut the sampled anchors into even ranges, some n at most.

    Quantiles of the first eight bytes come first. Eight bytes that several quantiles fall on are hot, as in texts of
    few letters or of several bytes a letter: their anchors are cut by the quantiles of the next eight bytes, and so on.
    """
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SAMPLE)) == 0)
    # Distinct leading strings: copies are reduced before they reach a bucket.
    leads = sample.mapInArrow(_sample_leads, ", ".join(f"{w} long" for w in _LEADS)).distinct()
    if n < 2:
        return []
    leads = written(leads, shared_folder(docs.sparkSession), "leads")
    cuts: set[tuple[int, ...]] = set()
    hot: dict[tuple[int, ...], int] = {(): n}  # leading bytes that more than one range begins with, and how many
    for level, word in enumerate(_LEADS):
        names = _LEADS[:level]
        if names:
            # As many rows as there are ranges, at most.
            wanted = [[*map(int, head), parts] for head, parts in hot.items()]
            parts = docs.sparkSession.createDataFrame(wanted, ", ".join(f"{w} long" for w in [*names, "_parts"]))
            held = leads.join(F.broadcast(parts), names)
        else:
            held = leads.withColumn("_parts", F.lit(n))
        quantiles = F.percentile_approx(word, [i / n for i in range(1, n)], F.lit(20 * n))
        found = held.groupBy(*names, "_parts").agg(quantiles.alias("q")).collect()
        hot = {}
        for row in found:
            head = tuple(row[w] for w in names)
            # Every n/parts-th quantile, so that a hot string gets as many ranges as its share asks for.
            values = [row["q"][i * (n - 1) // row["_parts"]] for i in range(1, row["_parts"])] if row["q"] else []
            for v in set(values):
                cuts.add((*head, v))
                if values.count(v) > 1:
                    hot[(*head, v)] = values.count(v) + 1
        if not hot:
            break
    return sorted(cuts)


def _bucket_of(lead: np.ndarray, cuts: list[tuple[int, ...]]) -> np.ndarray:
    """How many cuts are at or before each leading string; a cut of fewer bytes is before all that begin with it."""
    least = np.iinfo(np.int64).min
    borders = np.array([[*c, *[least] * (_LEAD_WORDS - len(c))] for c in cuts], np.int64).reshape(-1, _LEAD_WORDS)
    both = np.concatenate([borders, lead])
    # Cuts go before equal strings: their number comes first among equal rows.
    order = np.lexsort((np.arange(len(both)) >= len(borders), *both.T[::-1]))
    passed = np.cumsum(order < len(borders))
    out = np.empty(len(both), np.int64)
    out[order] = passed
    return out[len(borders) :]


def _suffix_rows(batches: Iterator[pa.RecordBatch], cuts: list[tuple[int, ...]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, lists = id_arrays(batch["doc_id"]), batch["places"]
        for lo, hi, data, offsets in byte_chunks(pa.array(_unpack_texts(batch), pa.binary())):
            part = lists[lo:hi]
            counts = np.diff(part.offsets.to_numpy())
            place, before, after = _unpack(part.flatten().to_numpy())
            at = place + np.repeat(offsets[:-1], counts)
            start, length = at - before, before - after + SPAN
            ends = np.concatenate([[0], np.cumsum(length)])
            for a in range(0, len(at), CHUNK_ANCHORS):
                b = min(len(at), a + CHUNK_ANCHORS)
                body = data[ragged(start[a:b], length[a:b])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(_bucket_of(_lead(data, at[a:b]), cuts), pa.int32()),
                    pa.array(np.repeat(ids[lo:hi], counts)[a:b]), pa.array(part.flatten().to_numpy()[a:b]),
                    pa.Array.from_buffers(pa.binary(), b - a, [
                        None, pa.py_buffer((ends[a : b + 1] - ends[a]).astype(np.int32)), pa.py_buffer(body),
                    ]),
                ], names=["bucket", "doc", "at", "around"])


# -- step 3: the sorted buckets ------------------------------------------------------------------------------


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows, and the length of the common prefix of each row with the one before it in that order.

    Rows are sorted by their first eight bytes; only those that tie go on to the next eight.
    """
    n, width = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    tie = np.concatenate([[False], words[order[1:], 0] == words[order[:-1], 0]])
    for c in range(1, words.shape[1]):
        open_ = tie.copy()
        open_[:-1] |= tie[1:]
        at = np.flatnonzero(open_)
        if not len(at):
            break
        group = np.cumsum(~tie[at])
        inner = np.lexsort((words[order[at], c], group))
        order[at] = order[at[inner]]
        value = words[order[at], c]
        tie[at] = np.concatenate([[False], (value[1:] == value[:-1]) & (group[1:] == group[:-1])])
    common = np.zeros(n, np.int64)
    if n > 1:
        for a in range(1, n, CHUNK_ANCHORS):
            b = min(n, a + CHUNK_ANCHORS)
            differ = rows[order[a:b]] != rows[order[a - 1 : b - 1]]
            common[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def repeated_strings(doc: np.ndarray, at: np.ndarray, around: pa.Array):
    """(doc, start, end) of runs of repeated strings, from anchors that hold all those with equal leading strings."""
    place, before, after = _unpack(at)
    order = np.lexsort((place, doc))
    doc, place, before, after = doc[order], place[order], before[order], after[order]
    offsets = np.frombuffer(around.buffers()[1], np.int32)[around.offset : around.offset + len(around) + 1].astype(np.int64)
    raw = np.frombuffer(around.buffers()[2], np.uint8)
    start = offsets[:-1][order]
    length = (offsets[1:] - offsets[:-1])[order]
    n = len(doc)
    right = np.zeros((n, -(-SPAN // 8) * 8), np.uint8)
    left = np.zeros((n, -(-_WIDTH // 8) * 8), np.uint8)
    for i in range(SPAN):
        some = before + i < length
        right[some, i] = raw[start[some] + before[some] + i]
    for i in range(_WIDTH - 1):
        some = i < before
        left[some, i] = raw[start[some] + before[some] - 1 - i]
    r_order, r_common = multikey_sort(right)
    l_order, l_common = multikey_sort(left)
    repeated = np.zeros((n, _WIDTH + 1), np.int8)
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(_WIDTH):
        active = np.flatnonzero((after <= o) & (o <= before))
        if len(active) < 2:
            continue
        r_class[r_order] = np.cumsum(r_common < SPAN - o)
        l_class[l_order] = np.cumsum(l_common < o) if o else 0
        key = r_class[active] * n + l_class[active]
        by = np.argsort(key, kind="stable")
        ranked = key[by]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        # The first of a class has the least (doc, place); rows at the very same place are the same string.
        head = active[by][np.flatnonzero(new)][np.cumsum(new) - 1]
        mine = active[by]
        later = (doc[mine] != doc[head]) | (place[mine] != place[head])
        repeated[mine[later], o] = 1
    edge = np.diff(repeated, axis=1, prepend=0)
    row_a, from_o = np.nonzero(edge == 1)
    _, to_o = np.nonzero(edge == -1)
    return doc[row_a], place[row_a] - (to_o - 1), place[row_a] - from_o + SPAN


def _leads_of(table: pa.Table) -> np.ndarray:
    around, (_, before, _) = table["around"].combine_chunks(), _unpack(table["at"].to_numpy())
    around = around.chunk(0) if isinstance(around, pa.ChunkedArray) else around
    offsets = np.frombuffer(around.buffers()[1], np.int32)[around.offset : around.offset + len(around)].astype(np.int64)
    return _lead(np.frombuffer(around.buffers()[2], np.uint8), offsets + before)


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by leading string; whole runs of it are compared, in chunks of many anchors."""
    def out(table: pa.Table):
        table = table.combine_chunks()
        around = table["around"].chunk(0) if table["around"].num_chunks else pa.array([], pa.binary())
        found = repeated_strings(table["doc"].to_numpy(), table["at"].to_numpy(), around)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["doc", "start", "end"])

    held: list[pa.RecordBatch] = []
    size, wait = 0, CHUNK_ANCHORS
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size < wait:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        lead = _leads_of(table)
        other = np.flatnonzero((lead != lead[-1]).any(axis=1))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield out(table.slice(0, cut))
        held, size = table.slice(cut).to_batches(), size - cut
        # A long run of one leading string is looked at again when it has doubled, not with every batch.
        wait = max(CHUNK_ANCHORS, 2 * size)
    if size:
        yield out(pa.Table.from_batches(held))


# -- step 4: documents ---------------------------------------------------------------------------------------


def kept_bytes(text: bytes, starts: list[int], ends: list[int]) -> tuple[bytes, int, int]:
    """The bytes outside of the runs, number of bytes removed, number of maximal runs."""
    if not starts:
        return text, 0, 0
    gone = np.zeros(len(text) + 1, np.int64)
    np.add.at(gone, np.array(starts), 1)
    np.add.at(gone, np.array(ends), -1)
    cut = np.cumsum(gone[:-1]) > 0
    runs = int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~cut].tobytes(), int(cut.sum()), runs


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends = batch["starts"].to_pylist(), batch["ends"].to_pylist()
        texts = _unpack_texts(batch)
        done = [kept_bytes(t, a, b) for t, a, b in zip(texts, starts, ends)]
        yield pa.RecordBatch.from_arrays([
            batch["doc_id"].cast(pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
            pa.array([hashlib.sha256(d[0]).hexdigest() for d in done]), pa.array([d[0] for d in done], pa.binary()),
        ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _keyed(docs: DataFrame) -> DataFrame:
    """Packed texts with ``doc``, the id with the least number for null."""
    packed = docs.mapInArrow(_pack_texts, _PACKED)
    return packed.withColumn("doc", F.coalesce("doc_id", F.lit(-(2**63)).cast("long")))


def repeated_runs(docs: DataFrame, folder: str, n_buckets: int) -> DataFrame:
    """(doc, start, end): runs of bytes of repeated strings, which may overlap."""
    again = written(repeated_anchors(docs), folder, "anchors")
    places = again.filter("kind = 0").groupBy("doc").agg(F.collect_list("at").alias("places"))
    cuts = splitters(docs, n_buckets)
    texts = _keyed(docs).join(places, "doc").select(F.col("doc").alias("doc_id"), "size", "packed", "places")
    rows = texts.mapInArrow(
        lambda it: _suffix_rows(it, cuts), "bucket int, doc long, at long, around binary"
    )
    # The leading string stands in the surroundings, at the distance from the earliest string to the anchor.
    lead = F.substring("around", F.shiftright("at", 8).bitwiseAND(255).cast("int") + 1, F.lit(GRAM))
    buckets = rows.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions(lead)
    found = buckets.mapInArrow(_bucket, "doc long, start long, end long")
    whole = again.filter("kind = 1").select(
        "doc",
        (F.shiftright("at", 16) - F.shiftright("at", 8).bitwiseAND(255)).alias("start"),
        (F.shiftright("at", 16) - F.col("at").bitwiseAND(255) + SPAN).alias("end"),
    )
    return found.union(whole)


def dedup_suffixes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (remaining bytes) per document.

    Texts are UTF-8 bytes, null is empty; texts of fewer than 100 bytes keep all. A byte goes if a 100-byte
    string of its document that covers it starts earlier too: in a smaller doc_id, or before in the same one;
    overlaps count. Repeated doc_ids: the row with the greatest text counts. Null doc_id: the least id. An
    empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = one_per_id(docs, "doc_id", "text")
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = repeated_runs(docs, shared_folder(spark), n_buckets)
    runs = runs.groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    none = F.array().cast("array<bigint>")
    joined = _keyed(docs).join(runs, "doc", "left").select(
        "doc_id", "size", "packed", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends")
    )
    return joined.mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
