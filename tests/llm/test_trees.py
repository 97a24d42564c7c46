"""Merkle manifest, document fingerprints and the prefix trie beside plain versions."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from conftest import empty_like

from touchline.llm import document_fingerprint, merkle_manifest, prefix_trie
from touchline.llm.ordering import ranked
from touchline.llm.common import shared_folder


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- manifest ------------------------------------------------------------------------------------------------


def plain_leaf(row, text):
    out = ""
    for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text):
        shown = None if v is None else str(v)
        out += "-" if shown is None else f"{len(shown.encode())}:{shown}"
    return sha(out)


def plain_tree(nodes):
    """(root, per leaf the list of (left, right) siblings)."""
    paths = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for path, at in zip(paths, place):
            run = runs[at // 16]
            path.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        nodes, place = [sha("".join(r)) for r in runs], [p // 16 for p in place]
    return nodes[0], paths


def plain_manifest(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    trees, out = [], []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(by_source[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        trees.append((source, own, *plain_tree([plain_leaf(r, r["text"]) for r in own])))
    if not trees:
        return []
    root, tops = plain_tree([t[2] for t in trees])
    for (source, own, subroot, paths), top in zip(trees, tops):
        for r, path in zip(own, paths):
            path = path + top
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            folded = plain_leaf(r, r["text"].translate(LOWER) if tampered and r["text"] is not None else r["text"])
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((r["doc_id"], source, plain_leaf(r, r["text"]), subroot, root,
                        sha("".join(a + b for a, b in path)), folded, folded == root))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, grp int, path string"


@pytest.mark.parametrize("sizes", [{"a": 1}, {None: 1, "a": 16, "b": 17}, {"hot": 700, "é": 257, "z": 3, "": 256, None: 20}])
def test_manifest(spark, sizes):
    rng = random.Random(4)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "x", f"Some TEXT ñ {rng.random()}", "Ä" * 40])
            rows.append((rng.choice([None, *range(3000), -7]) if n > 3 else rng.randrange(99), text, rng.choice([None, "en", "fr"]),
                         source, rng.choice([None, 0, 55]), "n", 1, "p"))
    rows += rows[-3:]  # repeated rows, leaves of their own
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = [tuple(r) for r in merkle_manifest.manifest(df).collect()]
    assert order(got) == order(plain_manifest([r.asDict() for r in df.collect()]))


def test_manifest_of_many_sources_and_of_nothing(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 300:03d}" if i % 7 else None, 6, "n", 1, "p") for i in range(700)]
    df = spark.createDataFrame(rows, DOCS)
    got = [tuple(r) for r in merkle_manifest.manifest(df).collect()]
    assert order(got) == order(plain_manifest([r.asDict() for r in df.collect()]))
    assert merkle_manifest.manifest(empty_like(df)).count() == 0


def test_manifest_of_the_fixture(spark, documents):
    got = [tuple(r) for r in merkle_manifest.manifest(documents).collect()]
    assert order(got) == order(plain_manifest([r.asDict() for r in documents.collect()]))


def test_ranks_go_over_all_tasks(spark):
    rows = [(i % 3 or None, i // 2, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, v long, row long").repartition(7)
    out = ranked(df, "g", ["v", "row"], shared_folder(spark), "lined").collect()
    for g in (None, 1, 2):
        own = sorted((r.v, r.row) for r in out if r.g == g)
        assert [(r.v, r.row) for r in sorted((r for r in out if r.g == g), key=lambda r: r.rank)] == own
        assert sorted(r.rank for r in out if r.g == g) == list(range(len(own)))
        assert {r.total for r in out if r.g == g} == {len(own)}


# -- fingerprints --------------------------------------------------------------------------------------------


def plain_phrases(text):
    """Distinct phrases, cut by hand: at a line break, or at blanks with 12 to 80 other characters before them."""
    out, start, at = [], 0, 0  # ``at``: where the search for the next end begins
    while at < len(text):
        if text[at] == "\n":
            out.append(text[start : at + 1])
            start = at = at + 1
            continue
        line = text.find("\n", at)
        line = len(text) if line < 0 else line
        end = next((i for i in range(at + 12, min(at + 80, line - 1) + 1) if i < len(text) and text[i] == " "), None)
        if end is None:
            at += 1
            continue
        while end < len(text) and text[end] == " ":
            end += 1
        out.append(text[start:end])
        start = at = end
    return {hashlib.md5(p.encode()).hexdigest()[:6] for p in [*out, text[start:]]}


def plain_print(text):
    sections, now = [], []
    for p in text.split("\n"):
        now.append(sha(p))
        if now[-1] < "4":
            sections.append(now)
            now = []
    sections += [now] if now else []
    # The digest of a section is over its paragraphs with points between and, unless the text ends in it, no sign after.
    joined = [".".join(s) + ("." if s is now and now else "") for s in sections]
    names = [sha("".join(j)) for j in joined]
    return "|".join([sha("".join(names)), ".".join(n[:16] for n in names),
                     "/".join(".".join(d[:16] for d in s) for s in sections), "".join(sorted(plain_phrases(text)))])


def plain_likeness(a, b):
    x, y = (set(re.findall(".{6}", p.split("|")[3])) for p in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def test_fingerprints(spark, documents, texts):
    known = {i * 3: t or "" for i, t in enumerate(texts)}
    ids = sorted(known)
    got = {r.doc_id: r for r in document_fingerprint.compare_edits(documents).collect()}
    assert set(got) == set(ids)
    for i, doc_id in enumerate(ids):
        text, after = known[doc_id], known[ids[(i + 1) % len(ids)]]
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        assert (r.fingerprint, r.edited_fingerprint) == (plain_print(text), plain_print(edited))
        assert r.near_edited == plain_likeness(plain_print(text), plain_print(edited))
        assert r.near_next == plain_likeness(plain_print(text), plain_print(after))
    prints = {r.doc_id: r.fingerprint for r in document_fingerprint.fingerprints(documents).collect()}
    assert prints == {i: r.fingerprint for i, r in got.items()}
    assert len({p.split("|")[0] for p in prints.values()}) == len(set(known.values()))


def test_fingerprints_of_odd_tables(spark, documents):
    assert document_fingerprint.compare_edits(empty_like(documents)).count() == 0
    one = spark.createDataFrame([(None, "a single text without an id", 1, "k")], "doc_id long, text string, k int, key string")
    (r,) = document_fingerprint.compare_edits(one).collect()
    assert (r.doc_id, r.edited_sha256, r.near_next) == (None, sha("a single text withouta sing"), 1.0)
    rows = [(None, "no id"), (5, "abcd"), (5, "zzzz"), (5, None), (9, None), (9, None), (-3, "\n\n")]
    got = {r.doc_id: r for r in document_fingerprint.compare_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # In order: null, -3, 5 (greatest text), 9 (empty).
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == {
        None: (5, sha("no i\n")), -3: (2, sha("\n\n")), 5: (4, sha("zzz")), 9: (0, sha(""))}


def test_differing_paragraphs(spark):
    rng = random.Random(3)
    lines = [f"Paragraph {i} {rng.random()}" for i in range(200)]
    other = list(lines)
    other[57] = "another paragraph"
    del other[120]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string")
    a, b = (document_fingerprint.fingerprint(df[c]) for c in ("a", "b"))
    row = df.select(document_fingerprint.differing_paragraphs(a, b).alias("d"), document_fingerprint.differing_paragraphs(b, a).alias("e"),
                    document_fingerprint.differing_paragraphs(a, a).alias("same"), a.alias("p")).first()
    assert {x.digest for x in row.d} == {sha(lines[57])[:16], sha(lines[120])[:16]}
    assert {x.digest for x in row.e} == {sha("another paragraph")[:16]}
    assert row.same == []
    groups = [g.split(".") for g in row.p.split("|")[2].split("/")]
    for x in row.d:
        assert groups[x.section - 1][x.paragraph - 1] == x.digest


def test_fingerprint_of_a_long_line_is_linear(spark):
    text = "x" * 3_000_000 + "\n" + "word " * 400_000
    got = document_fingerprint.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_chars == 5_000_001 and len(got.fingerprint) < 500


# -- trie ----------------------------------------------------------------------------------------------------


def plain_trie(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            turns.setdefault(c, []).append(((turn is not None, turn or 0, told), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        lender = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = turns.get(lender, [])[:h] + own[h:]
    members = {}
    for c, b in built.items():
        for d in range(len(b) + 1):
            members.setdefault(tuple(b[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in below)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves),
                    saved, sha(",".join(map(str, ends)))))
    return out


CONVS = "conv_id long, turn long, role string, text string, depth int, node string, part string"


@pytest.mark.parametrize("shard_rows", [2, 7, 60, prefix_trie.SHARD_ROWS])
def test_trie(spark, shard_rows):
    rng = random.Random(6)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 250, 260, -150, -100, -103, 300]:
        hot = rng.random() < 0.5
        for t in range(rng.choice([1, 2, 5, 9])):
            text = "hello" if hot and t < 2 else rng.choice([None, "", "a", "b", "ñandú", f"t{rng.randrange(4)}"])
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "user", None]), text))
    rows += [(300, t, "user", f"turn {t % 5}") for t in range(80)]  # longer than some shards
    rows += [(301, t, "user", f"turn {t % 5}") for t in range(80)]
    rows += [(None, 0, "user", "of no conversation"), rows[0], rows[0], (77, 3, None, None)]
    df = spark.createDataFrame([(*r, 1, "n", "p") for r in rows], CONVS).repartition(4)
    got = [tuple(r) for r in prefix_trie.prefix_trie(df, shard_rows).collect()]
    assert order(got) == order(plain_trie(rows))


def test_trie_of_odd_tables(spark):
    empty = spark.createDataFrame([], CONVS)
    assert prefix_trie.prefix_trie(empty).count() == 0
    # crc32("1") % 6 is not 0 and there is no conversation 0: the only turn is one of the first h and goes.
    assert zlib.crc32(b"1") % 6 > 0
    one = spark.createDataFrame([(1, 0, "user", "hi", 1, "n", "p")], CONVS)
    assert [tuple(r) for r in prefix_trie.prefix_trie(one).collect()] == [(1, 0, None, 1, 0, 1, 0, sha("1"))]


def test_trie_of_many_copies(spark):
    """Some 9,000 copies of one conversation end in one node; their ids come in several pieces."""
    df = spark.range(9000).selectExpr("id conv_id", "explode(sequence(0, 6)) t").selectExpr(
        "conv_id", "cast(t as long) turn", "'user' role", "concat('turn ', t) text", "1 depth", "'' node", "'' part")
    got = {r.depth: r for r in prefix_trie.prefix_trie(df, 5000).collect()}
    assert len(got) == 8 and {r.n_convs for r in got.values()} == {9000}
    assert got[7].ends_sha256 == sha(",".join(map(str, range(9000)))) and got[6].ends_sha256 == sha("")
    assert [got[d].saved_tokens for d in range(8)] == [8999 * 6 * min(7, 8 - d) for d in range(8)]


def test_node_table():
    rng = random.Random(1)
    names = [rng.randbytes(16) for _ in range(500)]
    names += [names[0][:8] + rng.randbytes(8) for _ in range(5)] + [bytes(16)] + names[:50]  # equal first halves, repeats
    column = prefix_trie._names(pa.array(names))
    table = prefix_trie.NodeTable(column)
    slots = table.slots(column)
    assert table.size == 506 and sorted(set(slots.tolist())) == list(range(506))
    assert all(table.names[s].tobytes() == n for s, n in zip(slots, names))
    with pytest.raises(ValueError):
        table.slots(prefix_trie._names(pa.array([b"x" * 16])))
