"""Benchmark decontamination over a positional inverted index; DataFrame functions only.

The index holds postings ``(term, document, position, around)`` of training tokens, for the terms
that some benchmark window has as its rarest. ``around`` carries the words next to the position, so
that the lists of the other terms of a window are intersected at their adjusted offsets without a
shuffle of their own: first the second rarest term, then the whole phrase.

Beside exact phrases there are proximity matches: ``seg`` words in a row (the window's length and ``slop`` more) that
hold at least ``NEAR`` of the window's different words, in any order. A window of d words of which m must be there is
looked for from its d - m + 1 rarest, one of which every match holds, so no changed words can hide one. Of the
d - m + 2 rarest every match holds two, so a posting next to which no other of them stands is not written (:func:`companions`).

Words are maximal runs of letters, digits and non-ASCII characters after A-Z is lower-cased. A window
is ``width`` consecutive words of an item; a shorter item is one window.

Defined cases: null or empty texts have no words and hit nothing; items without words have no
window; a null item id still marks words but is not listed among the items; items or documents that
repeat an id are judged by their own text (a document's key is its id and its text); an empty
benchmark or table gives counts of zero or no rows. Further input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidedesk.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms and windows up to this many rows are broadcast (some 100 MB at most); beyond it Spark joins them by shuffle.
BROADCAST_ROWS = 500_000
#: Of a window's different words, the share a proximity match holds; words that may stand between them.
NEAR, SLOP = 0.8, 5
#: A term with more companions than this keeps all its postings; to look for them would cost more than it spares.
COMPANIONS = 64
#: The term of a text's end in an index with ``ends``; no word is empty.
END = ""


def words(text: Column) -> Column:
    """Lower-cased words; the texts are split on everything else in ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _checked(df: DataFrame) -> DataFrame:
    """Broadcast behind a check of its size; ``df`` is a written table."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def window_items(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``window, item``: the word sequences of each item; a null item id is a null item."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return w.select("item", "w", F.explode(starts).alias("i")).select(F.slice("w", F.col("i"), width).alias("window"), "item").distinct()


def document_frequency(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, df`` of those ``terms`` that occur; each document counts once, before any shuffle."""
    tokens = docs.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return tokens.join(_checked(terms), "term").groupBy("term").agg(F.count("*").alias("df"))


def anchored(win: DataFrame, df: DataFrame) -> DataFrame:
    """``window, term, offset, term2, offset2``: the two rarest terms of each window that can occur.

    A window with a term that no document holds is dropped: its rarest list is empty.
    """
    spread = win.select("window", F.posexplode("window").alias("offset", "term")).join(df, "term", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "term")))
    ranked = spread.groupBy("window").agg(order.alias("o")).filter(F.col("o")[0]["df"] > 0)
    second = F.coalesce(F.get("o", F.lit(1)), F.col("o")[0])
    return ranked.select(
        "window", F.col("o")[0]["term"].alias("term"), F.col("o")[0]["offset"].alias("offset"),
        second["term"].alias("term2"), second["offset"].alias("offset2"))


def near_anchors(win: DataFrame, df: DataFrame, near: float = NEAR) -> DataFrame:
    """``window, terms, needed, term, others``: the different words of each window, how many a proximity match needs, and a row for
    each of the rarest of them, of which one at least must be there. Terms that no document holds come first and match nothing.
    ``others`` are the rest of those rarest and the next one: where two words are needed, one of them stands beside ``term``."""
    spread = win.select("window", F.explode(F.array_distinct("window")).alias("term")).join(df, "term", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")))
    ranked = spread.groupBy("window").agg(order.alias("o")).withColumn("needed", F.ceil(F.size("o") * F.lit(near)).cast("int"))
    terms = F.transform("o", lambda x: x["term"])
    return ranked.select("window", terms.alias("terms"), "needed",
                         F.explode(F.slice("o", 1, F.size("o") - F.col("needed") + 1)).alias("a")).filter("a.df > 0").select(
        "window", "terms", "needed", F.col("a.term").alias("term"),
        F.array_remove(F.slice("terms", 1, F.size("terms") - F.col("needed") + 2), F.col("a.term")).alias("others"))


def companions(anchors: DataFrame, near: DataFrame) -> DataFrame:
    """``term, beside``: the terms to index, and the words of which one must stand around a posting that is in a match.

    ``beside`` is null, and every posting needed, where a window needs no second word or there are more than ``COMPANIONS``.
    """
    exact = F.when(F.col("term") != F.col("term2"), F.array("term2"))
    pairs = anchors.select("term", F.explode_outer(exact).alias("word")).union(
        near.select("term", F.explode_outer(F.when(F.col("needed") > 1, F.col("others"))).alias("word"))).distinct()
    # no more words of a term are gathered than can be used; a null comes first
    n = F.row_number().over(Window.partitionBy("term").orderBy("word"))
    few = pairs.withColumn("n", n).filter(F.col("n") <= COMPANIONS + 1).groupBy("term").agg(
        F.collect_list("word").alias("words"), F.count("*").alias("n"), F.count("word").alias("given"))
    return few.select("term", F.when((F.col("n") == F.col("given")) & (F.col("n") <= COMPANIONS), F.col("words")).alias("beside"))


def postings(docs: DataFrame, terms: DataFrame, reach: int, ends: bool = False) -> DataFrame:
    """The index rows of ``terms``: ``term, doc_id, text_hash, pos, first, around``.

    Positions count from 0; ``around`` begins at position ``first`` and reaches ``reach`` words to
    either side. With broadcast terms, tokens are filtered in the scan stage before a row is built; beyond that
    each token crosses the shuffle with the words around it and not with its whole text. With ``ends`` each
    row of ``docs`` has a posting of ``END`` too, at the position after its last word (:func:`text_lengths`).
    Of terms with a ``beside``, postings around which none of its words stands are left out (:func:`companions`).
    """
    if "beside" not in terms.columns:
        terms = terms.withColumn("beside", F.lit(None).cast("array<string>"))
    useful = F.col("beside").isNull() | F.arrays_overlap("beside", "around")
    listed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    # the outer forms: for the others Spark adds a filter on the size of ``w``, which splits each text a second time
    if terms.count() <= BROADCAST_ROWS:
        closed = F.concat("w", F.array(F.lit(END))) if ends else F.col("w")
        wanted = terms.union(terms.sparkSession.range(1).select(F.lit(END), F.lit(None))) if ends else terms
        tokens = listed.select("doc_id", "text_hash", "w", F.posexplode_outer(closed).alias("pos", "term"))
        first = F.greatest(F.col("pos") - reach, F.lit(0))
        return tokens.join(F.broadcast(wanted), "term").select(
            "term", "doc_id", "text_hash", "pos", first.alias("first"),
            F.slice("w", first + 1, F.col("pos") - first + reach + 1).alias("around"), "beside").filter(useful).drop("beside")

    def token(term: Column, pos: Column) -> Column:
        first = F.greatest(pos - reach, F.lit(0))
        return F.struct(term.alias("term"), pos.alias("pos"), first.alias("first"), F.slice("w", first + 1, pos - first + reach + 1).alias("around"))

    tokens = listed.select("doc_id", "text_hash", F.explode_outer(F.transform("w", token)).alias("t"))
    found = tokens.select("doc_id", "text_hash", "t.*").join(terms, "term").filter(useful).select("term", "doc_id", "text_hash", "pos", "first", "around")
    if not ends:  # ends have one term in common, so they stay out of that shuffle
        return found
    return found.unionByName(listed.select(
        F.lit(END).alias("term"), "doc_id", "text_hash", F.size("w").alias("pos"), F.size("w").alias("first"),
        F.array().cast("array<string>").alias("around")))


def text_lengths(index: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_words`` of each row of the documents of an index with ``ends``."""
    return index.filter(F.col("term") == END).select("doc_id", "text_hash", F.col("pos").cast("long").alias("n_words"))


def phrase_matches(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, length, window`` of every occurrence of a window."""
    start = F.col("pos") - F.col("offset")
    place = start - F.col("first")
    found = index.join(_checked(anchors), "term").filter(place >= 0)
    both = found.filter(F.get("around", place + F.col("offset2")) == F.col("term2"))
    # Spark may test this before the filters above; ``greatest`` keeps the start valid then
    exact = both.filter(F.slice("around", F.greatest(place, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    return exact.select("doc_id", "text_hash", start.alias("start"), F.size("window").alias("length"), "window")


def near_matches(index: DataFrame, near: DataFrame, slop: int = SLOP) -> DataFrame:
    """``doc_id, text_hash, window`` where ``needed`` of its words stand within its length and ``slop`` more; exact phrases are
    among them. The index must reach as far as that, less one word."""
    beside = (F.col("needed") < 2) | F.arrays_overlap("others", "around")
    found = index.join(_checked(near), "term").filter(beside).filter(F.size(F.array_intersect("terms", "around")) >= F.col("needed"))
    seg = F.size("window") + slop
    # stretches that hold the posting itself; the first starts at the beginning of what is around it
    place = F.col("pos") - F.col("first")
    starts = F.sequence(F.greatest(place - seg + 1, F.lit(0)), place)
    held = F.exists(starts, lambda i: F.size(F.array_intersect(F.slice("around", i + 1, seg), F.col("terms"))) >= F.col("needed"))
    return found.filter(held).select("doc_id", "text_hash", "window").distinct()


def proximity_matches(index: DataFrame, anchors: DataFrame, slop: int = 5) -> DataFrame:
    """``doc_id, text_hash, pos, pos2, window``: the two rarest terms of a window within ``slop`` words
    of their distance in it; exact phrases are among them. ``slop`` plus the distance must lie within the reach of the index.
    """
    found = index.join(_checked(anchors.filter("offset <> offset2")), "term")
    spread = found.select("doc_id", "text_hash", "pos", "first", "window", "term2",
                          (F.col("offset2") - F.col("offset")).alias("gap"), F.posexplode("around").alias("at", "other"))
    pos2 = F.col("first") + F.col("at")
    near = spread.filter((F.col("other") == F.col("term2")) & (F.abs(pos2 - F.col("pos") - F.col("gap")) <= slop))
    return near.select("doc_id", "text_hash", "pos", pos2.alias("pos2"), "window")


def build(docs: DataFrame, benchmark: DataFrame, width: int = 10, reach: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(index, anchors)`` for phrases, both written tables."""
    index, anchors, _, _ = _built(docs, benchmark, width, reach or width, False)
    return index, anchors


def _built(docs: DataFrame, benchmark: DataFrame, width: int, reach: int, proximity: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The written tables ``index, anchors, near, items``; ``near`` has rows and the index ends only for ``proximity``."""
    items = materialize(window_items(benchmark, width), "benchmark-windows")
    win = items.select("window").distinct()
    terms = materialize(win.select(F.explode("window").alias("term")).distinct(), "benchmark-terms")
    df = materialize(document_frequency(docs, terms), "benchmark-df")
    anchors = materialize(anchored(win, df), "benchmark-anchors")
    near = materialize(near_anchors(win if proximity else win.limit(0), df), "benchmark-near")
    rarest = materialize(companions(anchors, near), "benchmark-rarest")
    return materialize(postings(docs, rarest, reach, ends=proximity), "postings"), anchors, near, items


_KEY = ["doc_id", "text_hash"]


def report(lengths: DataFrame, matches: DataFrame, items: DataFrame, near: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near``.

    ``lengths`` are the documents as in :func:`text_lengths`, ``matches`` are phrase matches, ``near`` proximity matches (with or without the exact ones), ``items`` the items of windows,
    which join once per document and window. ``n_near`` counts windows that a document holds nearly and not exactly.
    """
    covered = matches.select(*_KEY, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("p"))
    hits = covered.groupBy(*_KEY, "p").agg(F.lit(1).alias("one")).groupBy(*_KEY).agg(F.count("*").alias("n_hit"))
    exact = matches.select(*_KEY, "window").distinct()
    listed = exact.join(_checked(items), "window").groupBy(*_KEY).agg(F.array_sort(F.collect_set("item")).alias("listed"))
    # a window counts when only the proximity side has it
    sides = near.select(*_KEY, "window", F.lit(0).alias("exact")).unionByName(exact.withColumn("exact", F.lit(1)))
    only = sides.groupBy(*_KEY, "window").agg(F.max("exact").alias("exact")).filter("exact = 0").groupBy(*_KEY).agg(F.count("*").alias("n_near"))
    # one row per document with any match, whatever of the three it has
    none = {"n_hit": F.lit(None).cast("long"), "listed": F.lit(None).cast("array<string>"), "n_near": F.lit(None).cast("long")}

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*_KEY, *[F.col(n) if n == name else c.alias(n) for n, c in none.items()])

    found = side(hits, "n_hit").unionByName(side(listed, "listed")).unionByName(side(only, "n_near")).groupBy(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(
        F.max("n_hit").alias("n_hit"), F.max("listed").alias("listed"), F.max("n_near").alias("n_near"))
    joined = lengths.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    every = F.coalesce("listed", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(every).cast("long").alias("n_items"),
        F.sha2(F.array_join(every, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def scan(docs: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = SLOP) -> DataFrame:
    """Index, search and report in one call."""
    index, anchors, near, items = _built(docs, benchmark, width, width + slop - 1, True)
    exact = materialize(phrase_matches(index, anchors), "phrase-matches")
    return report(text_lengths(index), exact, items, near_matches(index, near, slop))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents that hold no window of the benchmark, all columns as they were."""
    index, anchors = build(docs, benchmark, width)
    hit = materialize(phrase_matches(index, anchors), "phrase-matches").select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("hash") == F.col("hit_hash"))
    return packed.join(hit, same, "left_anti").select("row.*")
