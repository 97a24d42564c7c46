"""Merkle fingerprints of documents, in SQL expressions alone.

A paragraph is a line of the text, its digest the SHA-256 of the line. A section is a run of paragraphs that ends
with one whose digest begins with 0 to 3, some four paragraphs: the borders come from the content, so an edit
moves none but its own. A section's digest is taken over the digests of its paragraphs, the root over the sections.
Equal texts have equal roots; where roots differ, only the sections that the other document does not have are
opened (``differing_paragraphs``).

For a likeness below the paragraph, in texts of one line too, the fingerprint also names the phrases of the document:
runs of some 12 characters or more that end at a blank or a line break. The likeness of two fingerprints is twice the
number of distinct phrases in both, over the sum of their distinct phrases.

A fingerprint is a string of four fields, divided by ``|``: the root; the first 16 digits of the sections, divided
by points; those of the paragraphs, divided by points and by ``/`` between sections; the first 6 digits of the MD5 of
the distinct phrases, in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import one_per_id, shared_folder, ship, written
from touchline.llm.ordering import ranked

SHORT = 16
PHRASE_DIGITS = 6
PHRASE = r"([^\n]{12,80}? +|\n)"
# Stands for the end of a phrase; where a text holds it, a phrase ends there too.
_CUT = "\x1f"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null is the empty text, which is one empty paragraph."""
    text = F.coalesce(text, F.lit(""))

    def tree(runs: Column) -> Column:
        shown = F.transform(runs, lambda s: F.array_join(
            F.transform(F.filter(F.split(s, r"\."), lambda d: d != ""), lambda d: F.substring(d, 1, SHORT)), "."))
        return _once(F.transform(runs, lambda s: F.sha2(s, 256)), lambda sections: F.concat_ws(
            "|", F.sha2(F.array_join(sections, ""), 256),
            F.array_join(F.transform(sections, lambda d: F.substring(d, 1, SHORT)), "."), F.array_join(shown, "/")))

    # The digests of the paragraphs, each with the sign that ends a section or goes on with it.
    marked = F.transform(F.split(text, "\n"), lambda p: _once(
        F.sha2(p, 256), lambda d: F.concat(d, F.when(d < "4", F.lit("/")).otherwise(F.lit(".")))))
    runs = F.filter(F.split(F.array_join(marked, ""), "/"), lambda s: s != "")
    phrases = F.split(F.regexp_replace(text, PHRASE, f"$1{_CUT}"), _CUT)
    names = F.sort_array(F.array_distinct(F.transform(phrases, lambda p: F.substring(F.md5(p.cast("binary")), 1, PHRASE_DIGITS))))
    return F.concat_ws("|", _once(runs, tree), F.array_join(names, ""))


def _field(print_: Column, n: int) -> Column:
    return F.split_part(print_, F.lit("|"), F.lit(n))


def _shared(left: Column, right: Column) -> Column:
    """Likeness by the phrase fields of two fingerprints."""
    cut = lambda c: F.regexp_extract_all(c, F.lit(f".{{{PHRASE_DIGITS}}}"), F.lit(0))
    both = F.struct(cut(left).alias("l"), cut(right).alias("r"))
    return _once(both, lambda s: F.size(F.array_intersect(s["l"], s["r"])) * F.lit(2.0) / (F.size(s["l"]) + F.size(s["r"])))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints, 0 to 1; 1 if they are equal."""
    return _shared(_field(a, 4), _field(b, 4))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """section, paragraph (places from 1, the second in its section) and digest of what ``a`` has and ``b`` has not.

    Equal roots are not opened, nor sections that the other one has.
    """
    sections, others = F.split(_field(a, 2), r"\."), F.split(_field(b, 2), r"\.")
    known = F.split(_field(b, 3), r"[./]")
    groups = F.split(_field(a, 3), "/")
    opened = F.filter(
        F.transform(groups, lambda g, i: F.struct((i + 1).alias("section"), F.get(sections, i).alias("name"), g.alias("group"))),
        lambda s: ~F.array_contains(others, s["name"]))
    found = F.flatten(F.transform(opened, lambda s: F.filter(
        F.transform(F.split(s["group"], r"\."), lambda d, j: F.struct(
            s["section"].alias("section"), (j + 1).alias("paragraph"), d.alias("digest"))),
        lambda p: ~F.array_contains(known, p["digest"]))))
    return F.when(_field(a, 1) == _field(b, 1), F.slice(found, 1, 0)).otherwise(found)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint of each document.

    Null and empty texts have the fingerprint of the empty text. Repeated doc_ids: the row with the greatest text
    counts; a null doc_id is kept. An empty table gives an empty result. Other columns are ignored.
    """
    docs = one_per_id(docs, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.char_length(text).cast("long").alias("n_chars"), fingerprint(text).alias("fingerprint"))


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, of_id, k: the document before each one (of_id, in ascending order with null first; the last one
    for the first), and how many code points a quarter of that one has."""
    folder = shared_folder(docs.sparkSession)
    sizes = docs.select(F.lit(0).alias("one"), "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("n"))
    placed = ranked(sizes, "one", ["doc_id"], folder, "documents-in-order")
    before = placed.select(((F.col("rank") + 1) % F.col("total")).alias("rank"), F.col("doc_id").alias("of_id"),
                           F.floor(F.col("n") / 4).cast("int").alias("k"))
    return written(placed.select("doc_id", "rank").join(before, "rank").select("doc_id", "of_id", "k"), folder, "neighbours")


def edited_copies(docs: DataFrame) -> DataFrame:
    """Each document beside an edited copy, whose last quarter is the beginning of the next document.

    doc_id, n_chars, fingerprint, edited (the text), next_phrases (of the next document's fingerprint),
    edited_fingerprint. The next document is the one with the next greater doc_id, null first; that of the last is
    the first, and a single document is its own. Of a text of n code points the last floor(n/4) give way to as many
    of the next, or to all it has. Nulls, empty texts, repeated rows and empty tables are as in ``fingerprints``.

    Texts are shuffled once, by id: both sides of the join have the same columns and share one exchange. What goes to
    the neighbour is the beginning that it takes and the phrases, three bytes each.
    """
    ship(docs.sparkSession)
    docs = one_per_id(docs, "doc_id", "text")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("key")  # noqa: E731  joins on ids, null too
    texts = docs.select(name("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    near = neighbours(docs).select(name("doc_id"), "of_id", "k")
    given = texts.join(near, "key").select(
        name("of_id"), F.col("of_id").alias("doc_id"), F.substring("text", F.lit(1), F.col("k")).alias("begin"),
        F.unhex(_field(fingerprint(F.col("text")), 4)).alias("phrases"))
    n = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("begin"))
    return texts.join(given, "key").select(
        "doc_id", n.cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint"),
        edited.alias("edited"), F.lower(F.hex("phrases")).alias("next_phrases"),
    ).withColumn("edited_fingerprint", fingerprint(F.col("edited")))


def compare_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of ``edited_copies``."""
    own = F.col("fingerprint")
    return edited_copies(docs).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        _shared(_field(own, 4), F.col("next_phrases")).alias("near_next"))
