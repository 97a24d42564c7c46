"""Embedding dedup, SentencePiece and token files beside plain versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import empty_like, with_oddities

from touchline.llm import embedding_dedup, sentencepiece_codec, token_files
from touchline.llm.common import shared_folder
from touchline.llm.queries import PIECE_MODEL, WORD_TOKENIZER


def plain_embeddings(rows):
    ids, vectors = [], []
    for i, v in rows:
        ids.append(i)
        ok = v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
        vectors.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = {i: set() for i in ids}
    for a, x in zip(ids, vectors):
        for b, y in zip(ids, vectors):
            if a != b and x is not None and y is not None and x @ y >= 0.95:
                links[a].add(b)
    head = {}
    for i in sorted(ids):
        if i not in head:
            stack = [i]
            while stack:
                j = stack.pop()
                if j not in head:
                    head[j] = i
                    stack += links[j]
    return {i: (len(links[i]), head[i], head[i] == i) for i in ids}


@pytest.mark.parametrize("block", [embedding_dedup.BLOCK, 3])
def test_embeddings(spark, block):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(25):
        base = rng.standard_normal(16)
        for _ in range(rng.integers(1, 9)):
            rows.append([float(x) for x in np.float32(base + rng.standard_normal(16) * 0.18)])
    rows += [rows[3]] * 12 + [[x * 2 for x in rows[3]], None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16,
                              [None] * 16, [-0.0] * 15 + [1.0], [0.0] * 15 + [1.0]]
    rows = list(enumerate(rows))
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, n int, rep string").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.dedup_embeddings(df, block).collect()}
    assert got == plain_embeddings(rows)
    assert embedding_dedup.dedup_embeddings(empty_like(df)).count() == 0
    again = df.union(df).union(spark.createDataFrame([(None, [1.0] * 16, 1, "")], df.schema))
    odd = {r.vec_id: r.n_links for r in embedding_dedup.dedup_embeddings(again, block).collect()}
    assert odd == {i: v[0] for i, v in got.items()} | {None: 0}


def test_embeddings_recall_on_the_limit():
    """Pairs of cosine 0.95 to 0.97 share a bucket."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.standard_normal((4000, 64))
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    c = rng.uniform(0.95, 0.97, (4000, 1))
    met = (embedding_dedup.bucket_ids(x) == embedding_dedup.bucket_ids(c * x + np.sqrt(1 - c * c) * away)).any(1)
    assert met.mean() > 0.99


def test_embeddings_recall_at_the_limit_itself():
    """Of pairs of cosine 0.95, 0.9986 share a bucket by the formula."""
    assert 1 - (1 - 0.874**embedding_dedup.PROJECTIONS) ** embedding_dedup.TABLES > 0.998
    rng = np.random.default_rng(6)
    x = rng.standard_normal((20000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.standard_normal((20000, 64))
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    other = 0.95 * x + np.sqrt(1 - 0.95**2) * away
    assert (embedding_dedup.bucket_ids(x) == embedding_dedup.bucket_ids(other)).any(1).mean() > 0.99


@pytest.fixture(scope="module")
def model():
    return sentencepiece_codec.PieceModel(public_tokenizers.path(PIECE_MODEL))


def test_pieces_are_the_best_segmentation(model, texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(public_tokenizers.path(PIECE_MODEL), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1  # the library's lattice search over the same pieces
    lattice = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    score = {i: s for i, s in model.pieces.values()}

    def total(ids):
        return sum(int(score.get(i, 0)) for i in ids)

    for text in texts:
        ours, theirs = model.encode(text or ""), lattice.encode(text or "")
        # Single characters score -1e9 here, so the library's 32-bit sums of long texts are not exact; ours are.
        assert total(ours) >= total(theirs)
        for word in (text or "").split()[:20]:
            if len(word) < 6:
                assert model.encode(word) == lattice.encode(word)


def test_search_against_all_segmentations():
    """A tiny model, with pieces over blanks, byte pieces and ties; every segmentation is tried."""
    pieces = {"a": -2.0, "b": -2.0, "ab": -4.0, "ba": -3.5, "▁": -1.0, "▁a": -3.0, "b▁": -2.5, "aab": -5.0, "bb▁a": -5.0}
    tiny = sentencepiece_codec.PieceModel(
        pieces={p: (300 + i, s) for i, (p, s) in enumerate(pieces.items())}, byte_ids=list(range(256)))
    assert not tiny.splits
    rng = np.random.default_rng(3)

    def best(text):
        if not text:
            return 0.0
        tries = [pieces[text[:n]] + best(text[n:]) for n in range(1, 5) if text[:n] in pieces]
        if text[0] not in pieces:
            tries.append(tiny.unknown + best(text[1:]))
        return max(tries)

    score = {300 + i: s for i, s in enumerate(pieces.values())}
    for _ in range(200):
        text = "".join(rng.choice(list("ab▁c"), rng.integers(1, 12)))
        ids = tiny.search(text)
        assert sum(score.get(i, tiny.unknown) for i in ids) == pytest.approx(best(text))
    long = "abaab" * 500
    assert sum(score[i] for i in tiny.search(long)) == pytest.approx(sum(score[i] for i in tiny.search("abaab" * 4)) * 125, rel=0.01)


def test_pieces_of_documents(spark, documents, model, texts):
    path = public_tokenizers.path(PIECE_MODEL)
    odd = with_oddities(spark, documents)
    rows = sentencepiece_codec.decode_documents(sentencepiece_codec.encode_documents(odd, path), path).collect()
    assert len(rows) == len(texts) + 1
    known = {i * 3: t for i, t in enumerate(texts)}
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert list(r.ids) == model.encode(r.text) and model.decode(r.ids) == r.text
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        if r.doc_id not in (None, 3, 6):
            assert r.text == (known[r.doc_id] or "")
    assert sentencepiece_codec.encode_documents(empty_like(documents), path).count() == 0


def test_token_files(spark, documents, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_TOKENIZER)
    whole = Tokenizer.from_file(path)
    special = spark.createDataFrame([
        (1000, "ΣΑΣ ǅ İ don't we'll\x85x\x1cy a\u0301 <|endoftext|>1234 a_b A.B"), (None, "no id")], "doc_id long, text string")
    docs = documents.select("doc_id", "text").union(special)
    pairs = [(None, "no id"), *((i * 3, t) for i, t in enumerate(texts)), (1000, special.first().text)]
    for size in (token_files.SHARD_IDS, 50):
        shards = token_files.write_token_files(docs, path, shared_folder(spark), shard_ids=size)
        got = {r.doc_id: r for r in token_files.read_token_files(shards).collect()}
        start = 0
        for doc_id, text in pairs:
            ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
            crc = zlib.crc32(np.array(ids, "<u4").tobytes())
            assert tuple(got[doc_id]) == (doc_id, start, len(ids), crc)
            start += len(ids)
        assert len(got) == len(pairs)
    assert token_files.read_token_files(
        token_files.write_token_files(empty_like(documents), path, shared_folder(spark))).count() == 0


def test_word_table_beside_a_dictionary():
    """Words of all lengths, long ones and NUL bytes too, with and without forgetting, and many in one slot."""
    from touchline.llm.word_table import WordTable

    rng = np.random.default_rng(2)
    coded = []

    def encode(units):
        coded.extend(units)
        return [list(u) + [len(u)] for u in units]

    for limit in (1 << 20, 64 * 40):
        table = WordTable(encode, limit)
        for turn in range(12):
            words = [bytes(rng.integers(0, 3, rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 30])).astype(np.uint8)) for _ in range(400)]
            ends = np.cumsum([len(w) for w in words])
            data = np.frombuffer(b"".join(words), np.uint8)
            ids, counts = table.lookup(data, ends - np.array([len(w) for w in words]), ends)
            assert counts.tolist() == [len(w) + 1 for w in words]
            assert ids.tolist() == [i for w in words for i in (*w, len(w))]
            if turn % 4 == 3:
                table.rest()
        if limit == 1 << 20:
            assert len(coded) == len(set(coded))


def test_grammar_goes_on_until_no_pair_is_frequent():
    """Long copies: a passage of 500 ids, 40 times, becomes a few symbols each time."""
    passage = np.random.default_rng(1).integers(0, 40000, 500)
    ids = np.tile(passage, 40)
    symbols, _, bounds, rules, lengths = token_files.compress(ids, np.arange(500, 20001, 500))
    assert len(symbols) <= 80 and lengths.max() > 250
    assert (token_files.expand(symbols, token_files.expansions(bounds, rules)) == ids).all()
    pairs = {}
    for i in range(len(symbols) - 1):
        pairs[symbols[i], symbols[i + 1]] = pairs.get((symbols[i], symbols[i + 1]), 0) + 1
    per_doc = len(symbols) // 40
    inside = [n for (a, b), n in pairs.items() if per_doc > 1]
    assert per_doc == 1 or max(inside) <= 40


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(8)
    for ids in (np.zeros(5000, np.int64), rng.integers(0, 5, 20000), rng.zipf(1.3, 20000) % 70000, np.zeros(0, np.int64)):
        ends = np.unique(np.append(rng.integers(0, len(ids) + 1, 40), len(ids)))
        counts = np.diff(np.concatenate([[0], ends]))
        row = token_files._row(0, 0, token_files.pa.array(np.arange(len(ends))), ids, counts)
        shard = token_files.Shard(row)
        assert (shard.all_ids() == ids).all()
        assert len(shard.body) <= len(ids)
        for i, (e, n) in enumerate(zip(ends, counts)):
            if n:
                doc = int((counts[:i] > 0).sum())
                assert (shard.document(doc) == ids[e - n : e]).all()
        for a, b in rng.integers(0, len(ids) + 1, (20, 2)):
            assert (shard.slice(min(a, b), max(a, b)) == ids[min(a, b) : max(a, b)]).all()
