"""Benchmark decontamination by winnowing.

Both sides become sequences of words. Of every ``WINDOW`` consecutive words the k-gram with the least hash is
selected (k = ``GRAM``), so two texts that share a window share a selected k-gram of it. Selected k-grams are the
fingerprints of both sides; every meeting is extended to the windows around it, and windows meet by a 128-bit digest of
their words. An item of fewer words than a window is one window and its own fingerprint.

Both sides are worked on by tasks, and no benchmark text passes through the driver. One pass over the documents selects
fingerprints and keeps those that may be among the benchmark's: executors get a bitmap of these, of ``FILTER_BITS`` at
most, in which a larger benchmark only leaves more chance hits. The windows around kept fingerprints are then
joined with the distinct windows of the benchmark; the adaptive planner splits a window that very many
documents hold. Hits of a document are added up at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import byte_chunks, new_name, one_per_id, shared_folder, written

WINDOW = 10
GRAM = 6
FILTER_BITS = 1 << 27
# Windows of items that a task gives out at a time.
_BATCH = 1 << 14

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_BYTE = np.random.default_rng(10).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end of every word, and the number of words before each text."""
    data = _LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IN_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~first
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(np.concatenate([[False], inside[:-1]]) & (~inside | first))
    return data, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                inside: np.ndarray | None = _IN_WORD) -> np.ndarray:
    """A 64-bit polynomial hash per run of bytes; only bytes ``inside`` (None: all of the run's) count."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data))
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    top = int((ends - starts).max())
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(top + 1, _STEP, np.uint64))
        value = _BYTE[data] * powers[np.minimum(place, top)]
        if inside is not None:
            value[~inside[data]] = 0
        else:
            value[place >= np.repeat(np.append(0, ends - starts), np.diff(np.concatenate([[0], starts, [len(data)]])))] = 0
        return _finish(np.add.reduceat(value, starts))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; the runs that cross texts are included."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            total = total * _STEP + words[i : i + n]
        return _finish(total)


def window_minima(words: np.ndarray, window: int = WINDOW, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Of every run of ``window`` words, texts apart or not: where its selected k-gram is, and the hashes of all k-grams."""
    grams = gram_hashes(words, k)
    width = window - k + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), grams
    best, where = grams[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, width):
        less = grams[i : i + n] < best
        best[less] = grams[i : i + n][less]
        where[less] = i
    return where + np.arange(n), grams


def winnow(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the selected k-grams of all texts (``bounds``: first word of each text, and the end)."""
    places, grams = window_minima(words, window, k)
    n = len(places)
    text = np.searchsorted(bounds, np.arange(n), "right") - 1
    whole = np.arange(n) + window <= bounds[np.minimum(text + 1, len(bounds) - 1)]
    places = places[whole]
    keep = np.ones(len(places), bool)
    keep[1:] = places[1:] != places[:-1]
    places = places[keep]
    return places, grams[places]


def short_grams(words: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of n words, for items of n words; unlike those of another length."""
    return _finish(gram_hashes(words, n) + np.uint64(n) * _STEP)


class Filter:
    """A bitmap of fingerprints with two places each; what is in it passes, and a little more."""

    def __init__(self, bits: int, rows: list[tuple[int, bytes]]):
        """``rows``: number and bytes of each piece of 32,768 bits; pieces without a bit may lack."""
        self.bits = bits
        self.map = np.zeros(bits // 8, np.uint8)
        for piece, data in rows:
            part = np.frombuffer(data, np.uint8)[: bits // 8]
            self.map[piece * 4096 : piece * 4096 + len(part)] = part

    @staticmethod
    def places(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64(bits - 1)
        return (prints & low).astype(np.int64), (prints >> np.uint64(32) & low).astype(np.int64)

    def passing(self, prints: np.ndarray) -> np.ndarray:
        first, second = self.places(prints, self.bits)
        maybe = np.flatnonzero(self.map[first >> 3] >> (first & 7).astype(np.uint8) & 1)
        at = second[maybe]
        return maybe[(self.map[at >> 3] >> (at & 7).astype(np.uint8) & 1) > 0]


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


# -- the benchmark -------------------------------------------------------------------------------------------


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, size and fingerprint of every window of every item."""
    for batch in batches:
        for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
            raw = np.frombuffer(text.encode(), np.uint8)
            data, starts, ends, _ = words_of(raw, np.array([0, len(raw)]))
            if not len(starts):
                continue
            hashes, joined = word_hashes(data, starts, ends), data.tobytes()
            size = min(WINDOW, len(starts))
            if size < WINDOW:
                prints = short_grams(hashes, size)
            else:
                places, grams = window_minima(hashes)
                prints = grams[places]
            words = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            for lo in range(0, len(prints), _BATCH):
                here = range(lo, min(lo + _BATCH, len(prints)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([item] * len(here)), pa.array([size] * len(here), pa.int32()),
                    pa.array([_digest(words[i : i + size]) for i in here]), pa.array(prints[lo : lo + _BATCH].view(np.int64)),
                ], names=["item", "size", "digest", "print"])


def benchmark_windows(benchmark: DataFrame, folder: str) -> DataFrame:
    """item, size, digest, print of the distinct windows of the items; ids as text, a null one as the empty text."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()
    return written(items.mapInArrow(_item_windows, "item string, size int, digest binary, print long").distinct(), folder, "windows")


def _filter(windows: DataFrame, limit: int) -> Filter:
    """The bitmap of the fingerprints: some 32 bits for each of them, ``limit`` at most."""
    prints = windows.select("print").distinct()
    bits = 1 << 15
    while bits < min(32 * prints.count(), limit):
        bits *= 2
    places = F.array(F.col("print"), F.shiftrightunsigned("print", 32))
    place = prints.select(F.explode(places).alias("p")).select(F.col("p").bitwiseAND(F.lit(bits - 1)).alias("p"))
    pieces = place.groupBy(F.shiftright("p", 15).alias("piece")).agg(
        F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    return Filter(bits, [(r["piece"], bytes(r["bits"])) for r in pieces.collect()])


# -- documents -----------------------------------------------------------------------------------------------


def _near(batches: Iterator[pa.RecordBatch], known: Filter, short: list[int]) -> Iterator[pa.RecordBatch]:
    """Per text the windows around the fingerprints that pass: first word, size and digest."""
    for batch in batches:
        for lo, hi, data, offsets in byte_chunks(batch["text"]):
            data, starts, ends, bounds = words_of(data, offsets)
            hashes = word_hashes(data, starts, ends)
            places, prints = winnow(hashes, bounds)
            tries: dict[tuple[int, int], None] = {}
            for p in places[known.passing(prints)].tolist():
                for first in range(p - WINDOW + GRAM, p + 1):
                    tries[first, WINDOW] = None
            for n in short:
                for p in known.passing(short_grams(hashes, n)).tolist():
                    tries[p, n] = None
            joined = data.tobytes() if tries else b""
            near: list[list[tuple[int, int, bytes]]] = [[] for _ in range(hi - lo)]
            for first, n in tries:
                text = int(np.searchsorted(bounds, first, "right")) - 1
                if first >= 0 and first + n <= bounds[text + 1]:
                    words = [joined[starts[i] : ends[i]] for i in range(first, first + n)]
                    near[text].append((first - int(bounds[text]), n, _digest(words)))
            yield pa.RecordBatch.from_arrays([
                *[batch[c].slice(lo, hi - lo) for c in batch.schema.names if c != "text"], pa.array(np.diff(bounds)),
                pa.array([[dict(zip(("first", "size", "digest"), w)) for w in ws] for ws in near], _NEAR),
            ], names=[*[c for c in batch.schema.names if c != "text"], "n_words", "near"])


_NEAR = pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32()), ("digest", pa.binary())]))
_NEAR_DDL = "n_words long, near array<struct<first: int, size: int, digest: binary>>"


def _found(texts: DataFrame, key: str, benchmark: DataFrame, filter_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``key`` and n_words of all texts; ``key``, first, size, digest of the windows that the benchmark has too;
    and the windows of the benchmark."""
    spark = texts.sparkSession
    folder = shared_folder(spark)
    windows = benchmark_windows(benchmark, folder)
    short = [r["size"] for r in windows.filter(F.col("size") < WINDOW).select("size").distinct().collect()]  # nine at most
    known = spark.sparkContext.broadcast(_filter(windows, filter_bits))
    kind = texts.schema[key].dataType.simpleString()
    near = written(texts.select(key, "text").mapInArrow(
        lambda it: _near(it, known.value, short), f"{key} {kind}, {_NEAR_DDL}"), folder, "near")
    tried = near.filter(F.size("near") > 0).select(key, F.inline("near"))
    return near.select(key, "n_words"), tried.join(windows.select("size", "digest").distinct(), ["size", "digest"]), windows


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_words, ``hit`` (ranges of words, first and size, inside an occurrence of a window, in order) and
    ``items`` per document."""
    counts, hits, windows = _found(docs, "doc_id", benchmark, filter_bits)
    ranges = hits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("first", "size"))).alias("hit"))
    named = hits.select("doc_id", "size", "digest").distinct().join(
        windows.select("item", "size", "digest").distinct(), ["size", "digest"])
    items = named.groupBy("doc_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    both = ranges.join(items, ranges["doc_id"].eqNullSafe(items["doc_id"])).select(ranges["doc_id"].alias("_id"), "hit", "items")
    none = F.array()
    return counts.join(both, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", "n_words", F.coalesce("hit", none.cast("array<struct<first:int,size:int>>")).alias("hit"),
        F.coalesce("items", none.cast("array<string>")).alias("items"))


def _covered(ranges: Column) -> Column:
    """Number of places in sorted ranges, each place once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(done: Column, r: Column) -> Column:
        end = F.greatest(done["end"], (r["first"] + r["size"]).cast("long"))
        return F.struct((done["n"] + end - F.greatest(done["end"], r["first"].cast("long"))).alias("n"), end.alias("end"))

    return F.aggregate(ranges, start, add, lambda done: done["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document.

    Words are runs of letters, digits and bytes beyond ASCII, A-Z in lower case. A window is ten consecutive
    words of an item; an item of fewer words is one window, an item without words (also null or empty) none.
    Words inside any occurrence of a window are hit. Null texts have no words. Items with equal words all
    count. Item ids are compared as text, a null one as the empty text. Repeated doc_ids: the
    row with the greatest text counts. Empty tables give no hits or no rows. Other columns are ignored.
    """
    found = benchmark_hits(one_per_id(docs, "doc_id", "text"), benchmark, filter_bits)
    return found.select(
        "doc_id", "n_words", _covered(F.col("hit")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` (text and more columns) that hold no window of any item.

    Whether a row goes depends on its text alone: repeated rows, null ids and null texts are judged like any
    other, and columns of any name may come along. Empty tables give an empty result, or all rows.
    """
    key = new_name(docs, "_text_md5")
    named = docs.withColumn(key, F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    folder = shared_folder(docs.sparkSession)
    _, hits, _ = _found(named.select(key, "text"), key, benchmark, filter_bits)
    dirty = written(hits.select(key).distinct(), folder, "hit-texts")
    return named.join(dirty, key, "left_anti").select(*docs.columns)
