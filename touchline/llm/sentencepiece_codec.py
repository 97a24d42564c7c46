"""SentencePiece encoding and decoding by a streaming Viterbi search.

The ids of a text are the segmentation with the greatest sum of piece scores; of equal ones the search keeps the
path whose pieces start first, as the library's lattice search does. A character that is no piece costs the least
score less ten and is written as byte pieces. White space is escaped and a blank is put in front, as the model says.

The search keeps, besides the open ends, only what is not yet settled: as soon as the back pointers of all open
ends meet in one boundary, the ids before it are committed and forgotten. No piece of the model goes from a
word to a blank or over a line break, so all paths meet there; units between these places are searched once
and remembered by the worker.

The public SentencePiece model at hand was trained as a BPE model. The search is over its pieces and scores and gives
the best segmentation; the merge order of BPE may choose another one. Decoding is the same for both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.common import byte_chunks, one_per_id, ragged
from touchline.llm.unit_cache import UnitCache

BLANK = "▁"
UNKNOWN_PENALTY = 10
_MARKS = frozenset(b".,;:!?|#$%&*")
_ASCII_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_LATIN_TAIL = np.array([128 <= b <= 191 and b not in (0x97, 0xB7) for b in range(256)])


class PieceModel:
    """Pieces and scores of a SentencePiece model file, and the search over them."""

    def __init__(self, path: str | None = None, pieces: dict[str, tuple[int, float]] | None = None,
                 byte_ids: list[int] | None = None):
        """From a model file, or from pieces (id, score) with the ids of the 256 byte pieces."""
        if path is not None:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces, byte_ids = {}, [0] * 256
            for i in range(model.get_piece_size()):
                if model.is_byte(i):
                    byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
                elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                    pieces[model.id_to_piece(i)] = (i, model.get_score(i))
        self.pieces, self.byte_ids = pieces, byte_ids
        self.longest = max(map(len, pieces), default=1)
        # A trie by prefixes: pieces by their text, () for what only begins a piece.
        self.trie: dict[str, tuple] = {p[:n]: () for p in pieces for n in range(1, len(p))} | pieces
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        # Units begin with a run of blanks or a line break if no piece goes over such a place.
        self.splits = all(BLANK not in p.lstrip(BLANK) and "\n" not in p for p in pieces)
        # Marks that no piece holds right after a letter: units begin there too.
        self.marks = np.array([
            b in _MARKS and not any(c == chr(b) and q.isalpha() for p in pieces for q, c in zip(p, p[1:])) for b in range(256)
        ])
        size = 1 + max([i for i, _ in pieces.values()] + byte_ids)
        parts: list[bytes] = [b""] * size
        for p, (i, _) in pieces.items():
            parts[i] = p.replace(BLANK, " ").encode()
        for b, i in enumerate(byte_ids):
            parts[i] = bytes([b])
        self.part_bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.part_sizes = np.fromiter(map(len, parts), np.int64, size)
        self.part_starts = np.cumsum(self.part_sizes) - self.part_sizes

    def search(self, text: str) -> list[int]:
        """Ids of the best segmentation of an escaped text."""
        trie, longest = self.trie.get, self.longest
        out: list[int] = []
        # Boundaries not yet committed: best score, where the last piece began, its id (-1: unknown character).
        score: dict[int, float] = {0: 0.0}
        back: dict[int, tuple[int, int]] = {}
        base, reach = 0, 0

        def commit(end: int) -> None:
            path, at = [], end
            while at != base:
                start, piece = back[at]
                path.append((start, at, piece))
                at = start
            for start, at, piece in reversed(path):
                out.extend([piece] if piece >= 0 else [self.byte_ids[b] for b in text[start:at].encode()])

        for i in range(len(text)):
            here = score[i]
            if reach == i and i > base:  # no piece goes over this boundary
                commit(i)
                score, back, base = {i: here}, {}, i
            elif i - base >= 4 * longest:
                ends = {*range(i, reach + 1)} & back.keys()
                while len(ends) > 1:
                    ends.add(back[last := max(ends)][0])
                    ends.remove(last)
                meet = ends.pop()
                if meet > base:
                    commit(meet)
                    score = {k: v for k, v in score.items() if k >= meet}
                    back = {k: v for k, v in back.items() if k > meet}
                    base = meet
            single = False
            for end in range(i + 1, min(len(text), i + longest) + 1):
                piece = trie(text[i:end])
                if piece is None:
                    break
                if piece:
                    single = single or end == i + 1
                    total = here + piece[1]
                    if end not in score or total > score[end]:
                        score[end], back[end] = total, (i, piece[0])
                    reach = max(reach, end)
            if not single:
                total = here + self.unknown
                if i + 1 not in score or total > score[i + 1]:
                    score[i + 1], back[i + 1] = total, (i, -1)
                reach = max(reach, i + 1)
        commit(len(text))
        return out

    def unit(self, unit: bytes) -> list[int]:
        if unit[:1] == b"\xff":
            return self.search(unit[1:].decode("utf-8", "replace"))
        text = unit.decode("utf-8", "replace")
        return self.search(text if text[:1] == "\n" else BLANK + text.replace(" ", BLANK))

    def units(self, text: bytes) -> list[bytes]:
        """The units of a text, each without its first blank; one that begins with a line break or the byte FF
        (which no text holds) has none."""
        if not text:
            return []
        parts = text.replace(BLANK.encode(), b" ").replace(b"\n", b" \n").split(b" ")
        if b"" not in parts:
            return parts
        out, blanks = [], 0
        for part in parts:
            if not part:
                blanks += 1
            elif part[:1] in (b"\n", b"\xff"):
                if blanks:
                    out.append(b" " * (blanks - 1))
                out.append(part)
                blanks = 0
            else:
                out.append(b" " * blanks + part)
                blanks = 0
        if blanks:
            out.append(b" " * (blanks - 1))
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the empty text has none."""
        return self.search(BLANK + text.replace(" ", BLANK)) if text else []

    def decode_many(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, one after the other, and their lengths; the blank in front is taken off."""
        sizes = self.part_sizes[ids]
        data = self.part_bytes[ragged(self.part_starts[ids], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = total[np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
        lengths = np.diff(np.concatenate([[0], ends]))
        starts = ends - lengths
        some = lengths > 0
        front = starts[some][data[starts[some]] == 32]
        keep = np.ones(len(data), bool)
        keep[front] = False
        lengths[some] -= data[starts[some]] == 32
        return data[keep], lengths

    def decode(self, ids: list[int]) -> str:
        data, _ = self.decode_many(np.array(ids, np.int64), np.array([len(ids)]))
        return data.tobytes().decode("utf-8", "replace")


@cache
def _model(path: str) -> tuple[PieceModel, UnitCache]:
    """One model and one memory per worker process."""
    model = PieceModel(path)
    return model, UnitCache(lambda units: [model.unit(u) for u in units])


def encode_texts(model: PieceModel, memory: UnitCache, data: np.ndarray, offsets: np.ndarray):
    if model.splits:
        letter = _ASCII_LETTER[data[:-1]]
        letter[1:] |= (data[:-2] == 0xC3) & _LATIN_TAIL[data[1:-1]]
        cuts = np.flatnonzero(letter & model.marks[data[1:]]) + 1
        cuts = cuts[~np.isin(cuts, offsets)]
        data = np.insert(data, np.repeat(cuts, 2), np.tile(np.array([32, 255], np.uint8), len(cuts)))
        offsets = offsets + 2 * np.searchsorted(cuts, offsets)
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    if model.splits:
        return memory.texts([model.units(t) for t in texts])
    ids = [model.encode(t.decode("utf-8", "replace")) for t in texts]
    return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids])


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model, memory = _model(path)
    for batch in batches:
        doc_ids = batch["doc_id"].cast(pa.int64())
        for lo, hi, data, offsets in byte_chunks(batch["text"]):
            ids, counts = encode_texts(model, memory, data, offsets)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [doc_ids[lo:hi], pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], names=["doc_id", "ids"]
            )
    memory.rest()


def _decode(batches: Iterator[pa.RecordBatch], path: str, with_text: bool = True) -> Iterator[pa.RecordBatch]:
    model, _ = _model(path)
    for batch in batches:
        column = batch["ids"]
        counts = np.diff(column.offsets.to_numpy())
        data, lengths = model.decode_many(column.flatten().to_numpy().astype(np.int64), counts)
        raw, ends = data.tobytes(), np.cumsum(lengths)
        texts = [raw[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]
        out = {
            "doc_id": batch["doc_id"], "ids": column, "n_tokens": pa.array(counts, pa.int64()),
            "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
        }
        if with_text:
            out["text"] = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
        yield pa.RecordBatch.from_pydict(out)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of the whole text of each document.

    Null and empty texts have no ids. Repeated doc_ids: the row with the greatest text counts; a null doc_id is
    kept. An empty table gives an empty result. Other columns are ignored. ``path``: model file on all executors.
    """
    docs = one_per_id(docs, "doc_id", "text")
    return docs.mapInArrow(lambda it: _encode(it, path), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_sha256 and text of encoded documents (doc_id, ids).

    A text without the character U+2581, which stands for a blank, comes back as it was.
    """
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda it: _decode(it, path),
        "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string, text string",
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_sha256: both directions in one pass, with one worker for both.

    Nulls, repeated doc_ids, empty tables and other columns as in ``encode_documents``.
    """
    docs = one_per_id(docs, "doc_id", "text")
    return docs.mapInArrow(
        lambda it: _decode(_encode(it, path), path, False),
        "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string",
    )
