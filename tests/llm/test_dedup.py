"""Suffix, line and SimHash dedup beside plain versions."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash
from conftest import empty_like, with_oddities

from touchline.llm import jaccard_dedup, line_dedup, simhash_dedup, suffix_dedup
from touchline.llm.suffix_dedup import multikey_sort

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def plain_suffixes(pairs):
    seen, out = set(), {}
    for doc_id, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = True
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(data), int(gone.sum()), runs, sha(np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return out


def by_id(df, *columns):
    rows = df.select("doc_id", *columns).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def one_text_per_id(df):
    best = {}
    for r in df.select("doc_id", "text").collect():
        old = best.get(r.doc_id, None)
        best[r.doc_id] = r.text if r.doc_id not in best or (old or "") <= (r.text or "") and r.text is not None else old
    return list(best.items())


SUFFIX = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_suffixes(spark, documents):
    got = by_id(suffix_dedup.dedup_suffixes(documents), *SUFFIX)
    assert got == plain_suffixes(one_text_per_id(documents))
    assert sum(v[1] for v in got.values()) > 5000


def test_suffixes_odd_rows(spark, documents):
    odd = with_oddities(spark, documents)
    assert by_id(suffix_dedup.dedup_suffixes(odd), *SUFFIX) == plain_suffixes(one_text_per_id(odd))
    assert suffix_dedup.dedup_suffixes(empty_like(documents)).count() == 0


def test_suffixes_one_by_one_and_with_copies_of_everything(spark, texts):
    rows = [(i, texts[20]) for i in range(40)] + [(100 + i, texts[20][:150] + str(i) * 60) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert by_id(suffix_dedup.dedup_suffixes(df), *SUFFIX) == plain_suffixes(rows)


def test_multikey_sort():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 2, (500, 16), dtype=np.uint8)
    rows[250:] = rows[:250]
    order, common = multikey_sort(rows)
    ranked = [rows[i].tobytes() for i in order]
    assert ranked == sorted(ranked)
    for a, b, c in zip(ranked, ranked[1:], common[1:]):
        assert c == next((i for i in range(16) if a[i] != b[i]), 16)


def plain_lines(pairs, least=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    where = defaultdict(set)
    for doc_id, text in pairs:
        for line in (text or "").split("\n"):
            where[key(line)].add(-(2**63) if doc_id is None else doc_id)
    out = {}
    for doc_id, text in pairs:
        lines = (text or "").split("\n")
        own = -(2**63) if doc_id is None else doc_id
        kept = [x for x in lines if len(key(x)) < 40 or len(where[key(x)]) < least or own == max(where[key(x)])]
        out[doc_id] = (len(lines), len(lines) - len(kept), sha("\n".join(kept).encode()))
    return out


ALPHABETS = {"Cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя ", "Chinese": "".join(map(chr, range(0x4E00, 0x4E00 + 300))),
             "digits": "0123456789 ", "Latin": "abcdefghijklmnopqrstuvwxyz "}


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_no_bucket_holds_most_suffixes_of_an_alphabet(spark, monkeypatch, alphabet):
    """Suffixes of texts in letters of several bytes, or of few letters, are dealt evenly, and the result is exact."""
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    rng = np.random.default_rng(5)
    letters = ALPHABETS[alphabet]

    def prose(n):
        return "".join(letters[i] for i in rng.integers(0, len(letters), n))

    shared = [prose(200) for _ in range(40)]
    rows = [(i, prose(int(rng.integers(0, 300))) + shared[rng.integers(0, 40)] + prose(100)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = by_id(suffix_dedup.dedup_suffixes(df), *SUFFIX)
    assert got == plain_suffixes(rows) and sum(v[1] > 0 for v in got.values()) > 60
    cuts = suffix_dedup.splitters(df, 16)
    assert len(cuts) >= 12
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    place = rng.integers(0, len(data) - 40, 4000)
    place = place[(data[place] & 0xC0) != 0x80]  # at the first byte of a letter
    shares = np.bincount(suffix_dedup._bucket_of(suffix_dedup._lead(data, place), cuts), minlength=len(cuts) + 1) / len(place)
    assert shares.max() < 0.25


def test_buckets_follow_the_order_of_leading_strings():
    rng = np.random.default_rng(7)
    data = rng.integers(250, 256, 3000).astype(np.uint8)
    lead = suffix_dedup._lead(data, np.arange(2900))
    texts = [data[i : i + 32].tobytes() for i in range(2900)]
    assert sorted(range(2900), key=lambda i: texts[i]) == sorted(range(2900), key=lambda i: lead[i].tolist())
    cuts = sorted([tuple(lead[5, :1].tolist()), tuple(lead[5, :3].tolist()), tuple(lead[70].tolist()), tuple(lead[900, :2].tolist())])
    buckets = suffix_dedup._bucket_of(lead, cuts)
    assert buckets.tolist() == [sum(c <= tuple(row[: len(c)]) for c in cuts) for row in lead.tolist()]


def test_runs_of_a_gram_over_many_batches():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    for _ in range(60):
        gram = np.sort(rng.integers(0, 12, rng.integers(0, 40)))
        kind = (rng.random(len(gram)) < 0.2).astype(np.int8)
        table = pa.table({"gram": gram, "doc": np.arange(len(gram)), "at": np.arange(len(gram)), "kind": kind})
        batches = [b for i in range(0, len(gram), 3) for b in table.slice(i, 3).to_batches()]
        got = sorted(x for b in suffix_dedup._again(iter(batches)) for x in b["doc"].to_pylist())
        assert got == [i for i, g in enumerate(gram) if kind[i] or (gram == g).sum() > 1]


LINES = ["n_lines", "n_dropped", "kept_sha256"]


@pytest.mark.parametrize("limits", [(line_dedup.BROADCAST_BYTES, line_dedup.TASK_LINES), (0, line_dedup.TASK_LINES), (0, 3)])
def test_lines(spark, documents, limits, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_MEMBERS", 2)
    odd = with_oddities(spark, documents)
    got = by_id(line_dedup.dedup_lines(odd, 5, *limits), *LINES)
    assert got == plain_lines(one_text_per_id(odd))
    assert sum(v[1] for v in got.values()) > 10


@pytest.mark.parametrize("limits", [(), (0, 3)])
def test_lines_keep_rows_and_columns(spark, documents, limits):
    documents = documents.withColumn("_dropped", F.lit("x")).withColumn("line", F.lit(1)).withColumn("id", F.lit(2))
    kept = line_dedup.dedup_rows(documents, 5, *limits)
    assert kept.schema == documents.schema
    got = {r.doc_id: sha((r.text or "").encode()) for r in kept.collect()}
    assert got == {k: v[2] for k, v in plain_lines(one_text_per_id(documents)).items()}
    assert line_dedup.dedup_lines(empty_like(documents)).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    _, slots = line_dedup.build_shard(keys)
    assert sorted(slots.tolist()) == list(range(3000))


def plain_simhash(pairs):
    prints = {}
    for doc_id, text in pairs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints, key=lambda d: -(2**63) if d is None else d)
    head = {d: d for d in ids}

    def top(d):
        while head[d] != d:
            d = head[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4 and top(a) != top(b):
                x, y = sorted((top(a), top(b)), key=ids.index)
                head[y] = x
    return {d: (f"{prints[d]:016x}", top(d)) for d in ids}


def test_simhash(spark, documents):
    odd = with_oddities(spark, documents)
    got = by_id(simhash_dedup.dedup_simhash(odd), "fingerprint", "component_id")
    assert got == plain_simhash(one_text_per_id(odd))
    assert len({v[1] for v in got.values()}) < len(got) - 5
    assert simhash_dedup.dedup_simhash(empty_like(documents)).count() == 0


def test_simhash_links_of_a_dense_group_and_of_random_fingerprints(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (40, 30, 3), dtype=np.uint64), axis=2)
    prints = np.unique(np.concatenate([base, (base[:, None] ^ flips).ravel()]))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    at = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    links = [(at[r.a], at[r.b]) for r in simhash_dedup.fingerprint_links(df).distinct().collect()]
    assert all(near[a, b] for a, b in links)

    def components(pairs):
        head = list(range(len(prints)))

        def top(v):
            while head[v] != v:
                v = head[v]
            return v

        for a, b in pairs:
            head[max(top(a), top(b))] = min(top(a), top(b))
        return [top(v) for v in range(len(prints))]

    assert components(links) == components(np.argwhere(near).tolist())


def word_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_least(pairs):
    """The least id of each group of texts whose sets of five words have a Jaccard similarity of 0.8 or more."""
    sets = {d: word_sets(t) for d, t in pairs}
    head = {d: d for d in sets}

    def top(d):
        while head[d] != d:
            d = head[d]
        return d

    for a in sorted(sets):
        for b in sorted(d for d in sets if d > a):
            x, y = sets[a], sets[b]
            if (x == y or 5 * len(x & y) >= 4 * len(x | y)) and top(a) != top(b):
                low, high = sorted((top(a), top(b)))
                head[high] = low
    return {d for d in sets if top(d) == d}


@pytest.mark.parametrize("block", [3, jaccard_dedup.BLOCK])
def test_edited_copies_are_one_group(spark, texts, block):
    rng = np.random.default_rng(8)
    rows = list(texts)
    for size, edits, copies in ((150, 1, 30), (95, 1, 20), (90, 1, 20), (300, 2, 15), (150, 12, 10), (4, 1, 5)):
        base = [f"w{w}" for w in rng.integers(0, 5000, size)]
        for _ in range(copies):
            words = list(base)
            for at in rng.integers(0, size, edits):
                words[at] = f"v{rng.integers(0, 5000)}"
            rows.append(" ".join(words))
    pairs = [(int(i) * 2 - 40, t) for i, t in zip(rng.permutation(len(rows)), rows)]
    df = spark.createDataFrame(pairs, "id long, text string").repartition(5)
    got = [r.id for r in jaccard_dedup.least_of_groups(df, block).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_least(pairs)
    assert len(got) < len(pairs) - 60
    assert jaccard_dedup.least_of_groups(df.limit(0), block).count() == 0


def test_near_copies_candidates_by_simhash(spark, tmp_path):
    """The stage's SimHash links rows of one fingerprint and of up to five other bits; past that those of a common signature."""
    rng = np.random.default_rng(11)
    prints = [int(x) for x in rng.integers(0, 2**64, 30, dtype=np.uint64)]
    rows = [(i, p) for i, p in enumerate(prints)]
    for i, p in enumerate(prints):
        bits = [int(b) for b in rng.permutation(64)[: i % 6]]
        rows.append((100 + i, p ^ sum(1 << b for b in bits)))
    rows.append((200, prints[0] ^ 0xFFF))  # twelve bits of one segment, the others are the same
    rows.append((201, prints[1] ^ 0x1FFF))  # thirteen
    df = spark.createDataFrame([(d, p - 2**64 if p >= 2**63 else p) for d, p in rows], "rep long, fp long").repartition(3)
    got = {r.rep: r.key for r in jaccard_dedup.simhash_pairs(df, str(tmp_path)).collect()}
    assert got == {100 + i: i for i in range(30)} | {200: 0}


def test_simhash_joins_a_group_without_minhash_keys(spark):
    """Fingerprints of the shingles come with the keys, and what SimHash links is compared like the rest."""
    words = [f"w{w}" for w in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(reversed(words)), "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = {r.id: r for r in df.mapInArrow(
        jaccard_dedup._signatures, "id long, content binary, bands array<long>, fp long").collect()}
    for i, t in enumerate(texts):
        assert rows[i].fp % 2**64 == simhash_dedup.majority(jaccard_dedup.shingles((t or "").encode()))
    assert ((rows[0].fp ^ rows[1].fp) % 2**64).bit_count() <= jaccard_dedup.SIMHASH_BITS
    assert {r.id for r in jaccard_dedup.least_of_groups(df).collect()} == {0, 2, 3}


def test_near_copies_stage_takes_edited_copies(spark):
    """Two words of 150 are others: a similarity of 0.87 in five words, yet mostly more than four bits of a fingerprint."""
    import corpus_pipeline

    rng = np.random.default_rng(9)
    rows = []
    for _ in range(20):
        words = [f"w{w}" for w in rng.integers(0, 5000, 150)]
        rows.append(" ".join(words))
        words[40] = words[100] = "other"
        rows.append(" ".join(words))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(rows)] + [(None, rows[0], "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert kept == {None} | set(range(2, 40, 2))
