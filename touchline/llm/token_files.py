"""Token-ID files, compressed by Re-Pair grammars.

A shard holds the ids of consecutive documents in ascending doc_id order. Frequent pairs of neighbouring ids
become nonterminals, round by round: a round counts all pairs of the shard, takes the most frequent ones
and replaces them from left to right, until no pair is frequent. No pair goes over the end of a document, so a document is a whole
number of symbols and is decoded alone: its place is the sum of the expansion lengths before it.

File format: Parquet, which Spark commits as a whole, one row per shard. Arrays are little-endian.

| column | content |
| --- | --- |
| part, block | place of the shard in the global order |
| doc_ids (i8), has_id (u1) | ids of the documents, and whether the id is not null |
| symbols (u4), tokens (u8) | per document: number of symbols and of ids |
| width, body | bytes per symbol (2 or 4), all symbols |
| rounds (u4) | first nonterminal of each round, and the number after the last one |
| rules (u4) | two symbols per nonterminal |
| lengths (u4) | ids that each nonterminal expands to |
| first, n_ids | first nonterminal (all smaller symbols are ids), number of ids of the shard |
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import byte_chunks, one_per_id, ragged, written
from touchline.llm.word_table import WordTable

END_ID = 1
SHARD_IDS = 1 << 20
PAIRS_PER_ROUND = 1 << 14
MIN_COUNT = 32
_BIN_BITS = 18
_SPREAD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77))

FORMAT = ("part int, block int, doc_ids binary, has_id binary, symbols binary, tokens binary, width int, body binary, "
          "rounds binary, rules binary, lengths binary, first long, n_ids long")


# -- ids -----------------------------------------------------------------------------------------------------


# Words of ASCII letters and the letters U+00C0 to U+00FF (without the signs of times and division).
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_ASCII_LETTER = np.array([97 <= b <= 122 for b in range(256)])
_LATIN_TAIL = np.array([128 <= b <= 191 and b not in (0x97, 0xB7) for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = np.isin(np.arange(256), list(b".,;:!?"))
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


@cache
def _tokenizer(path: str) -> WordTable:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    merge, plain, characters = whole.model.tokenize, _PLAIN.fullmatch, _byte_characters()

    def word(part: bytes) -> list[int]:
        """Ids of one word of the tokenizer, by its merges alone."""
        if not part.isascii():
            part = part.decode().lower().encode()
        return [t.id for t in merge(part.decode() if part.isascii() else "".join(map(characters.__getitem__, part)))]

    def encode(units: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = []
        rest: list[int] = []
        for unit in units:
            if plain(unit) is None:
                rest.append(len(out))
                out.append([])
            else:
                out.append(word(unit))
        texts = [units[i].decode("utf-8", "replace") for i in rest]
        for i, e in zip(rest, whole.encode_batch_fast(texts, add_special_tokens=False)):
            out[i] = e.ids
        return out

    return WordTable(encode)


def encode_chunk(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts of a chunk, without end ids, and the number of ids of each text.

    The tokenizer drops white space before it forms words, so a text has the ids of its parts between ASCII blanks.
    """
    inside = ~_BLANK[data]
    # A part begins after a blank or at the start of a text.
    begins = np.ones(len(data) + 1, bool)
    begins[1:-1] = ~inside[:-1]
    begins[offsets] = True
    if b"<|" not in data.tobytes():
        # Neither changes an id, and both make fewer parts: ASCII letters in lower case, and a cut between a
        # letter and a mark, which are separate words anyway. Names of special tokens stay as they are.
        data = _LOWER[data]
        letter = _ASCII_LETTER[data[:-1]]
        letter[1:] |= (data[:-2] == 0xC3) & _LATIN_TAIL[data[1:-1]]
        begins[1:-1] |= letter & _MARK[data[1:]]
    starts = np.flatnonzero(begins[:-1] & inside)
    # It ends before a blank, at the next part or at the end.
    ends = np.flatnonzero(inside & (begins[1:] | ~np.append(inside[1:], False))) + 1
    ids, counts = _tokenizer(path).lookup(data, starts, ends)
    before = np.concatenate([[0], np.cumsum(counts)])
    return ids, np.diff(before[np.searchsorted(starts, offsets)])


# -- grammar -------------------------------------------------------------------------------------------------


def _bin(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left * _SPREAD[0] + right * _SPREAD[1]) >> np.uint32(32 - _BIN_BITS)


def compress(ids: np.ndarray, ends: np.ndarray, pairs: int = PAIRS_PER_ROUND):
    """(symbols, symbols per document, rounds, rules, lengths) of ids with the end of each document.

    Rounds go on until no pair occurs ``MIN_COUNT`` times.
    """
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[ends[ends > 0] - 1] = True
    first = int(symbols.max(initial=0)) + 1
    bounds, rules, lengths = [first], [], np.ones(first, np.int64)
    while True:
        low = bounds[-1]
        left, right = symbols[:-1], symbols[1:]
        # Only pairs in a bin that is hit often enough are counted exactly.
        bins = _bin(left, right)
        heavy = np.bincount(bins, minlength=1 << _BIN_BITS) >= MIN_COUNT
        heavy_at = np.flatnonzero(heavy[bins] & ~last[:-1])
        keys = left[heavy_at].astype(np.int64) * low + right[heavy_at]
        found, counts = np.unique(keys, return_counts=True)
        order = np.lexsort((found, -counts))[:pairs]
        chosen = np.sort(found[order[counts[order] >= MIN_COUNT]])
        if not len(chosen):
            break
        # A bin names one of its chosen pairs; the few others are searched for.
        own = _bin((chosen // low).astype(np.uint32), (chosen % low).astype(np.uint32))
        named = np.full(1 << _BIN_BITS, -1, np.int32)
        named[own] = np.arange(len(chosen))
        where = named[bins[heavy_at]]
        may = where >= 0
        heavy_at, keys, where = heavy_at[may], keys[may], where[may]
        hit = chosen[where] == keys
        if (named[own] != np.arange(len(chosen))).any():
            other = np.flatnonzero(~hit)
            where[other] = np.minimum(np.searchsorted(chosen, keys[other]), len(chosen) - 1)
            hit[other] = chosen[where[other]] == keys[other]
        at, rule = heavy_at[hit], where[hit]
        # Of occurrences that overlap, every other one from the left is replaced.
        run = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
        even = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0
        at, rule = at[even], rule[even]
        symbols[at] = low + rule
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        last[at] = last[at + 1]
        symbols, last = symbols[keep], last[keep]
        pair = np.stack([chosen // low, chosen % low], axis=1)
        lengths = np.concatenate([lengths, lengths[pair].sum(axis=1)])
        rules.append(pair)
        bounds.append(low + len(chosen))
    per_doc = np.diff(np.concatenate([[0], np.flatnonzero(last) + 1]))
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return symbols, per_doc, np.array(bounds), table, lengths[first:]


def expansions(bounds: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, starts, lengths): what each symbol stands for, ids being themselves."""
    ids, lengths = np.arange(bounds[0]), np.ones(bounds[0], np.int64)
    starts = ids
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        pairs = rules[low - bounds[0] : high - bounds[0]]
        size = lengths[pairs].sum(axis=1)
        more = ids[ragged(starts[pairs].ravel(), lengths[pairs].ravel())]
        starts = np.concatenate([starts, len(ids) + np.cumsum(size) - size])
        ids, lengths = np.concatenate([ids, more]), np.concatenate([lengths, size])
    return ids, starts, lengths


def expand(symbols: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of symbols."""
    ids, starts, lengths = table
    return ids[ragged(starts[symbols], lengths[symbols])]


class Shard:
    """A stored shard; documents are decoded one by one or all at once."""

    def __init__(self, row: dict):
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        self.has_id = np.frombuffer(row["has_id"], np.bool_)
        self.counts = np.frombuffer(row["symbols"], "<u4").astype(np.int64)
        self.tokens = np.frombuffer(row["tokens"], "<u8").astype(np.int64)
        self.body = np.frombuffer(row["body"], f"<u{row['width']}")
        self.bounds = np.frombuffer(row["rounds"], "<u4").astype(np.int64)
        self.rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return expansions(self.bounds, self.rules)

    def all_ids(self) -> np.ndarray:
        return expand(self.body, self.table)

    def document(self, i: int) -> np.ndarray:
        """The ids of document i, without decoding the others."""
        start = int(self.counts[:i].sum())
        return expand(self.body[start : start + self.counts[i]], self.table)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from place start to stop of the shard; only symbols that touch these are expanded."""
        first = int(self.bounds[0])
        nested = self.body >= first
        size = np.ones(len(self.body), np.int64)
        size[nested] = self.lengths[self.body[nested].astype(np.int64) - first]
        ends = np.cumsum(size)
        lo, hi = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        offset = int(ends[lo] - size[lo]) if lo < len(ends) else start
        return expand(self.body[lo:hi], self.table)[start - offset : stop - offset]


def _row(part: int, block: int, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> dict:
    symbols, per_doc, bounds, rules, lengths = compress(ids, np.cumsum(counts))
    width = 2 if bounds[-1] <= 1 << 16 else 4
    return {
        "part": part, "block": block,
        "doc_ids": doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
        "has_id": doc_ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
        "symbols": per_doc.astype("<u4").tobytes(), "tokens": counts.astype("<u8").tobytes(),
        "width": width, "body": symbols.astype(f"<u{width}").tobytes(),
        "rounds": bounds.astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(),
        "lengths": lengths.astype("<u4").tobytes(), "first": int(bounds[0]), "n_ids": int(counts.sum()),
    }


_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.binary()), ("has_id", pa.binary()),
    ("symbols", pa.binary()), ("tokens", pa.binary()), ("width", pa.int32()), ("body", pa.binary()),
    ("rounds", pa.binary()), ("rules", pa.binary()), ("lengths", pa.binary()), ("first", pa.int64()), ("n_ids", pa.int64()),
])


def _shards(batches: Iterator[pa.RecordBatch], path: str, shard_ids: int, end_id: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    block, held, size = 0, [], 0

    def flush():
        docs = pa.concat_arrays([h[0] for h in held])
        row = _row(part, block, docs, np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))
        return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

    for batch in batches:
        doc_ids = batch["doc_id"].cast(pa.int64())
        for lo, hi, data, offsets in byte_chunks(batch["text"]):
            ids, counts = encode_chunk(path, data, offsets)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            held.append((doc_ids[lo:hi], ids, counts + 1))
            size += len(ids)
            if size >= shard_ids:
                yield flush()
                block, held, size = block + 1, [], 0
    if held:
        yield flush()
    _tokenizer(path).rest()


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID,
                      shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of all documents as shards in ``folder`` and give the shards as read back.

    Range partitioning gives each task consecutive doc_ids; a shard is closed after ``shard_ids`` ids (whole
    documents). Null and empty texts are the end id alone. Repeated doc_ids: the row with the greatest text
    counts. A null doc_id is kept and comes first. An empty table gives no shard. Other columns are ignored.
    """
    ordered = one_per_id(docs, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    shards = ordered.mapInArrow(lambda it: _shards(it, tokenizer_path, shard_ids, end_id), FORMAT)
    return written(shards, folder, "token_files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row)
            raw = shard.all_ids().astype("<u4").tobytes()
            ends = np.cumsum(shard.tokens)
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), shard.tokens.tolist())]
            n = len(ends)
            yield pa.RecordBatch.from_arrays([
                pa.array(shard.doc_ids, mask=~shard.has_id), pa.array(np.full(n, row["part"]), pa.int32()),
                pa.array(np.full(n, row["block"]), pa.int32()), pa.array(ends - shard.tokens), pa.array(shard.tokens),
                pa.array(crc, pa.int64()),
            ], names=["doc_id", "part", "block", "inner", "n_tokens", "ids_crc32"])


def read_token_files(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the documents in shards.

    Ids before a document are added up in three steps: in the shard, over the shards of a part, over the parts.
    Only the last, with one row per part, is a single ordered pass.
    """
    sizes = shards.select("part", "block", F.col("n_ids").alias("n"))
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    places = within.join(parts, "part").select("part", "block", (F.col("base") + F.col("before")).alias("base"))
    found = shards.mapInArrow(
        _read, "doc_id long, part int, block int, inner long, n_tokens long, ids_crc32 long"
    )
    return found.join(places, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )
