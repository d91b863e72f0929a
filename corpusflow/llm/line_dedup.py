"""Near-duplicate lines by a join of deletion neighbourhoods.

Two lines of five words or more are alike if one edit of a word (replaced, put in or left out)
makes them equal, shorter ones if they are equal. Every line emits a hash of itself without
each one of its words; lines with equal variants meet, the edit is verified on the words, and
all but the earliest go. Members of a group of equal variants are compared with its earliest
member, never in pairs. Only DataFrame functions are used.

A line that has no partner need not emit its variants: one edit leaves the first or the last
half of the words alone, so only lines that share a half with another line go on.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.session import stored

#: One edit in five words is a similarity of 0.8.
MIN_WORDS = 5

_LINE = ["k1", "k2"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _plain(line: Column) -> Column:
    """The words of a line joined by one space, A-Z in lower case."""
    # Only characters that are neither ASCII nor lower case keep lower() from changing just A-Z.
    other = (F.octet_length(line) != F.char_length(line)) & line.rlike(r"[^\x00-\x7F\p{Ll}]")
    words = F.trim(F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line))
    return F.when(other, F.translate(words, _UPPER, _LOWER)).otherwise(F.lower(words))


def _lines(docs: DataFrame) -> DataFrame:
    """A row per line: its document, its number and its words, joined and as an array. Empty texts have one empty line.

    The text's hash is made before the rows, so that the text is not carried along with each of its lines. Keys are
    made of the joined words: arrays of them are only made where ``words`` is asked for.
    """
    text = F.coalesce("text", F.lit(""))
    blank = reduce(or_, [F.contains(text, F.lit(c)) for c in "\t\x0B\f\r"])
    text = F.when(blank, F.regexp_replace(text, r"[\t\x0B-\r]", " ")).otherwise(text)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), text.alias("text"))
    # Split here: for an array that is a column, Spark adds a filter that splits the text a second time.
    rows = texts.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("no", "part"))
    rows = rows.select("doc_id", "text_key", "no", _plain(F.col("part")).alias("line"))
    return rows.select("*", F.array_remove(F.split("line", " "), "").alias("words"), _first_key())


def _first_key() -> Column:
    return F.xxhash64("line").alias("k1")


def _second_key() -> Column:
    return F.xxhash64(F.lit("line"), "line").alias("k2")


def _size(line: Column) -> Column:
    """Number of words of a line that has a word."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _halves(line: Column, n: Column) -> Column:
    """Keys of the first and the last half, and for even numbers of words of the shorter half:
    a line and the same line with one more word have halves of one length in common."""

    def keys(length: Column) -> Column:
        return F.array(
            F.xxhash64(F.lit("first"), F.call_function("substring_index", line, F.lit(" "), length)),
            F.xxhash64(F.lit("last"), F.call_function("substring_index", line, F.lit(" "), -length)),
        )

    half, less = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.when(n >= MIN_WORDS, F.when(half == less, keys(half)).otherwise(F.concat(keys(half), keys(less))))


def _keyed(docs: DataFrame) -> DataFrame:
    """A row per line: its document, its number, its keys, whether it has a word, and the keys of its halves."""
    line = F.col("line")
    lines = _lines(docs).select("*", _size(line).alias("n"))
    return lines.select("doc_id", "text_key", "no", "k1", _second_key(), (line != "").alias("any"), _halves(line, F.col("n")).alias("halves"))


def _members(known: DataFrame) -> DataFrame:
    """``rank, key, cut``: keys of a line's words without the one at each place (``cut``), and split at each place.

    A line without its word at ``cut`` has the key of a line that is split there, if it is what
    remains. So the members of a group, by key and place, are one edit from each other.
    """

    def running(words: Column) -> Column:
        # Appending copies an array: blocks of about the root of the length keep the copies short.
        n = F.size(words)
        size = F.ceil(F.sqrt(n)).cast("int")

        def block(done: Column, start: Column) -> Column:
            carry = F.array(F.element_at(F.element_at(done, -1), -1))
            part = F.slice(words, start + 1, size)
            hashes = F.aggregate(part, carry, lambda a, w: F.concat(a, F.array(F.xxhash64(F.element_at(a, -1), w))))
            return F.concat(done, F.array(F.slice(hashes, 2, size)))

        start = F.array(F.array(F.lit(0).cast("long")))
        return F.flatten(F.aggregate(F.sequence(F.lit(0), n - 1, size), start, block))

    hashed = known.select("rank", running(F.col("words")).alias("before"), F.reverse(running(F.reverse("words"))).alias("after"))
    # A place has the hash of the words before it, of those from it on, and of those behind its word (none at the end).
    behind = F.slice("after", 2, F.size("after"))
    places = hashed.select("rank", F.posexplode(F.arrays_zip("before", "after", behind.alias("behind"))).alias("cut", "at"))
    places = places.select("rank", "cut", "at.*")
    keys = F.array(F.xxhash64("before", "after"), F.when(F.col("behind").isNotNull(), F.xxhash64("before", "behind")))
    return places.select("rank", "cut", F.explode(keys).alias("key")).filter("key IS NOT NULL")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether the words before and after one place are all the same, for distinct lines."""

    def common(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda v, w: ~v.eqNullSafe(w)), True)
        return F.when(differs > 0, differs - 1).otherwise(F.size(x))

    longest = F.greatest(F.size(a), F.size(b))
    same = common(a, b) + common(F.reverse(a), F.reverse(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (same >= longest - 1)


def _words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(k1, k2, rank)`` with the words of each line, from where it is first: no other line is cut into words."""
    doc = F.struct("rank.doc_id", "rank.text_key").alias("doc")
    places = wanted.groupBy(doc).agg(F.collect_list(F.struct("rank", *_LINE)).alias("places"))
    own = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_key")).alias("own")
    found = docs.select(own, "text").join(places, F.col("own").eqNullSafe(F.col("doc")))

    def lines(parts: Column) -> Column:
        def line(at: Column) -> Column:
            return _plain(F.regexp_replace(F.get(parts, at["rank"]["no"]), r"[\t\x0B-\r]", " "))

        return F.transform("places", lambda at: F.struct(at["rank"].alias("rank"), *[at[k].alias(k) for k in _LINE], line(at).alias("line")))

    parts = F.split(F.coalesce("text", F.lit("")), "\n")
    rows = found.select(F.explode(F.transform(F.array(parts), lines)[0]).alias("line")).select("line.*")
    # Equal rows are one document.
    rows = rows.filter((F.col("k1") == _first_key()) & (F.col("k2") == _second_key())).dropDuplicates(_LINE)
    return rows.select("rank", *_LINE, F.split("line", " ").alias("words"))


def _near_earlier(docs: DataFrame, lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """Keys of the distinct lines that are one edit away from an earlier line."""
    halves = lines.select(*_LINE, F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a <> b").select("half")
    wanted = halves.join(shared, "half", "left_semi").select(*_LINE).distinct()
    wanted = stored(wanted.join(distinct.select(*_LINE, "rank"), _LINE), "wanted")
    known = stored(_words_of(docs, wanted), "words")

    members = stored(_members(known), "members")
    met = members.groupBy("key", "cut").agg(F.count("*").alias("n")).filter("n > 1").select("key", "cut")
    met = stored(members.join(met, ["key", "cut"]), "met")
    groups = met.groupBy("key", "cut").agg(F.min("rank").alias("least"))
    # Lines of repeated words meet at many places: a pair is verified once.
    candidates = (
        met.join(groups, ["key", "cut"])
        .filter(F.col("least") < F.col("rank"))
        .select("rank", F.col("least").alias("other"))
        .distinct()
    )
    own = known.select(*_LINE, "rank", "words")
    other = known.select(F.col("rank").alias("other"), F.col("words").alias("other_words"))
    joined = candidates.join(own, "rank").join(other, "other")
    return joined.filter(_one_edit(F.col("words"), F.col("other_words"))).select(*_LINE).distinct()


def dropped_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_lines, dropped`` per document: the numbers, from 0, of lines to drop.

    Lines are compared over all documents, by their words with A-Z in lower case; a line goes
    if an earlier one, by id and number, equals it or is one edit away. Lines without a word
    stay. ``text_key`` is the hash of the text.

    Rows with equal id and text are one document, with one row; NULL ids come first in the
    order, ids that are equal in the order of the hashes of their texts; a NULL or empty text
    has one line, without a word. An empty table gives no rows; other columns are ignored.
    """
    lines = stored(_keyed(docs), "lines")

    rank = F.struct("doc_id", "text_key", "no")
    full = lines.filter("any").select(rank.alias("at"), *_LINE)
    distinct = stored(full.groupBy(*_LINE).agg(F.min("at").alias("rank"), F.count("*").alias("n")), "distinct")
    near = _near_earlier(docs, lines.filter("halves IS NOT NULL"), distinct).withColumn("near", F.lit(True))
    concerned = distinct.join(near, _LINE, "left").filter("n > 1 OR near")
    gone = full.join(concerned, _LINE).filter(F.col("near") | ~F.expr("at <=> rank")).select("at.*")
    gone = gone.select("doc_id", "text_key", "no", F.lit(True).alias("gone"))
    rows = lines.select("doc_id", "text_key", "no", F.lit(False).alias("gone")).unionByName(gone)
    return rows.groupBy("doc_id", "text_key").agg(
        F.max("no").cast("long").alias("last"),
        F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("no")))).alias("dropped"),
    ).select("doc_id", "text_key", (F.col("last") + 1).alias("n_lines"), "dropped")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped`` with the numbers of the lines joined by commas."""
    return dropped_lines(docs).select(
        "doc_id",
        "n_lines",
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"),
    )


def without_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, texts without the lines to drop.

    ``n_chars``, if there, follows the text. Other columns may have any name.
    """
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_key"))
    gone = dropped_lines(docs).filter(F.size("dropped") > 0)
    gone = gone.select(F.struct("doc_id", "text_key").alias("_gone"), "dropped")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"))
    text = F.col("_row.text")
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("dropped", i)), "\n")
    joined = rows.join(gone, F.col("_key").eqNullSafe(F.col("_gone")), "left").select(
        "_row", F.when(F.col("dropped").isNotNull(), rest).otherwise(text).alias("_text")
    )
    new = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("long")}
    return joined.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


#: The same rows in SQL, with the words themselves instead of hashes. Equal rows are one document.
ORACLE = f"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents),
lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM docs)
), words AS (
  SELECT doc_id, no, list_filter(regexp_split_to_array(
    translate(line, '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM lines
), firsts AS (
  SELECT w, min((doc_id, no)) AS first, row_number() OVER () AS id FROM words WHERE len(w) > 0 GROUP BY w
), cut AS (
  SELECT id, first, len(w) AS n, unnest(range(len(w))) AS i, w FROM firsts WHERE len(w) >= {MIN_WORDS}
), variants AS (
  SELECT id, first, n, i, list_concat(w[1:i], w[i + 2:]) AS v FROM cut
), least AS (
  SELECT v, i, min(first) AS first FROM variants GROUP BY v, i
), near AS (
  SELECT id FROM variants JOIN least USING (v, i) WHERE least.first < variants.first
  UNION SELECT variants.id FROM variants JOIN firsts ON v = w WHERE len(w) >= {MIN_WORDS} AND firsts.first < variants.first
  UNION SELECT firsts.id FROM variants JOIN firsts ON v = w WHERE len(w) >= {MIN_WORDS} AND variants.first < firsts.first
), gone AS (
  SELECT words.doc_id, words.no FROM words JOIN firsts USING (w)
  WHERE (words.doc_id, words.no) <> firsts.first OR firsts.id IN (SELECT id FROM near)
)
SELECT l.doc_id, count(*) AS n_lines, count(g.no) AS n_dropped,
  coalesce(string_agg(g.no::VARCHAR, ',' ORDER BY g.no), '') AS dropped
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no GROUP BY l.doc_id
"""
