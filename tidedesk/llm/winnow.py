"""Document fingerprints by winnowing word k-grams; DataFrame functions only.

Every run of ``k`` words has a rolling hash: the cyclic polynomial of its words' hashes, in which a step to the next run
turns all bits and takes one word out and one in, here for all runs of a text at once. In every window of ``w`` such hashes the smallest is kept, the
rightmost one if several are equal. Two texts that share ``w + k - 1`` words in a row share a kept
hash. A fingerprint lists the kept hashes with their word positions: ``hash:position``, in hex and
decimal, comma-joined in order of position. Hashes have 43 bits and positions are those of the whole text, however long.

A hash and the low 20 bits of its position share a long, so that a plain minimum settles ties; the rest of the position
follows from the window's own place. Windows over a step of 2**20 words, where the low bits begin anew, are compared in full.

Defined cases: a null or empty text has no words and an empty fingerprint; a text of fewer than ``k``
words is one gram, one of fewer than ``w`` grams is one window. Two empty fingerprints are alike (1),
an empty and another are not (0). Rows without an id are neighbours in the order of a hash of their text and dealt by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidedesk.session import materialize

K, W = 5, 8
_STEP = 1 << 20


def _turned(h: Column) -> Column:
    """The bits of a long turned left by one."""
    return F.shiftleft(h, 1).bitwiseOR(F.shiftrightunsigned(h, 63))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """Adds ``out``: the kept ``(h, p)`` of the column ``text``, hash and position, in order of position.

    Window minima come from ``log2(w)`` steps over the array, each twice as wide; ``w`` is a power of two.
    """
    if w < 1 or w & (w - 1):
        raise ValueError("w must be a power of two")
    t, g = f"_{out}_words", f"_{out}_grams"
    df = df.withColumn(t, F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), ""))
    n = F.size(t)
    df = df.withColumn(t, F.transform(t, lambda word: F.xxhash64(word))).withColumn(g, F.col(t))

    def gram(h: Column, i: Column) -> Column:
        # a cyclic polynomial leaves its bits unevenly mixed, and minima need them even
        return F.shiftleft(F.shiftrightunsigned(F.xxhash64(h), 21), 20).bitwiseOR(F.lit(_STEP - 1) - i.cast("long") % F.lit(_STEP))

    for j in range(1, k):
        size = F.greatest(n - j, F.lit(0))
        df = df.withColumn(g, F.zip_with(F.slice(g, 1, size), F.slice(t, j + 1, size), lambda a, b: _turned(a).bitwiseXOR(b)))
    whole = F.aggregate(t, F.lit(0).cast("long"), lambda a, b: _turned(a).bitwiseXOR(b))
    few_words = F.when(n > 0, F.array(whole)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(g, F.transform(F.when(n >= k, F.col(g)).otherwise(few_words), gram)).drop(t)
    m = f"_{out}_minima"
    df = df.withColumn(m, F.col(g))
    step = 1
    while step < w:
        size = F.greatest(F.size(m) - step, F.lit(0))
        df = df.withColumn(m, F.zip_with(F.slice(m, 1, size), F.slice(m, step + 1, size), lambda a, b: F.least(a, b)))
        step *= 2
    # too short arrays have run dry
    df = df.withColumn(m, F.when((F.size(g) > 0) & (F.size(g) < w), F.array(F.array_min(g))).otherwise(F.col(m)))

    def place(v: Column, i: Column) -> Column:
        low = F.lit(_STEP - 1) - v.bitwiseAND(F.lit(_STEP - 1))
        return F.struct(F.shiftright(v, 20).alias("h"), (i + F.pmod(low - i, F.lit(_STEP))).cast("int").alias("p"))

    def over_step(i: Column) -> Column:
        least = F.array_min(F.transform(F.slice(g, i + 1, w), lambda x, j: F.struct(F.shiftright(x, 20).alias("h"), (-(i + j)).alias("p"))))
        return F.struct(least["h"].alias("h"), (-least["p"]).cast("int").alias("p"))

    # windows that follow each other keep the same place or a later one
    changed = F.transform(m, lambda v, i: F.when(i % _STEP > _STEP - w, over_step(i)).when((i == 0) | (v != F.get(m, i - 1)), place(v, i)))
    # columns of their own, since a lambda that held the expression would evaluate it for every element
    df = df.withColumn(m, changed).withColumn(m, F.filter(m, lambda x: x.isNotNull()))
    # over a step equal neighbours are left; only texts that long have them
    once = F.when(F.size(g) > _STEP - w, F.filter(m, lambda x, i: (i == 0) | (x["p"] != F.get(m, i - 1)["p"]))).otherwise(F.col(m))
    return df.withColumn(out, once).drop(g, m)


def as_string(kept: Column) -> Column:
    """``hash:position`` list of a fingerprint."""
    one = F.transform(kept, lambda v: F.concat(F.lower(F.hex(v["h"])), F.lit(":"), v["p"].cast("string")))
    return F.array_join(one, ",")


def kept_hashes(kept: Column) -> Column:
    return F.array_distinct(F.transform(kept, lambda v: v["h"]))


def likeness(a: Column, b: Column) -> Column:
    """Shared among all kept hashes of two (distinct) hash lists."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def with_next(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """``doc_id, text, bucket, guest``: rows dealt by ranges of the id, ready for a window per bucket.

    Ranges come from approximate quantiles, four per shuffle partition. The row with the largest id
    of a range also stands as a guest at the end of the range above (that of the highest range at the
    end of the lowest), so that a row's successor in descending order is always in its own bucket and
    the texts cross one shuffle. Null ids come last, dealt by a hash of their text.
    """
    spark = docs.sparkSession
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    cuts = base.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n).alias("c")).first()["c"] or []
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]).cast("array<bigint>")
    # rows without an id follow in the order of their text's hash, cut into as many even ranges of it
    code = F.xxhash64("text")
    lot = F.least(F.floor((code / F.lit(2.0 ** 64) + 0.5) * n), F.lit(n - 1)).cast("int")
    bucket = F.when(F.col("doc_id").isNull(), -1 - lot).otherwise(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))))
    tops = base.select("doc_id", F.when(F.col("doc_id").isNull(), code).alias("code"), bucket.alias("bucket")).groupBy("bucket").agg(
        F.max("doc_id").alias("top"), F.min("code").alias("code"))
    rows = sorted(materialize(tops, "winnow-tops").collect(), key=lambda r: r["bucket"])  # one per bucket
    hosts = [(r["top"], r["code"], rows[(i + 1) % len(rows)]["bucket"]) for i, r in enumerate(rows)]

    def looked_up(pairs: list[tuple[int, int]], c: Column) -> Column:
        return F.create_map(*[F.lit(x) for pair in pairs for x in pair])[c] if pairs else F.lit(None).cast("int")

    host = F.when(F.col("doc_id").isNull(), looked_up([(h, b) for t, h, b in hosts if t is None], code)).otherwise(
        looked_up([(t, b) for t, h, b in hosts if t is not None], F.col("doc_id")))
    seats = F.array_compact(F.array(
        F.struct(bucket.cast("int").alias("bucket"), F.lit(False).alias("guest")),
        F.when(host.isNotNull(), F.struct(host.alias("bucket"), F.lit(True).alias("guest")))))
    return base.select("doc_id", "text", F.explode(seats).alias("s")).select("doc_id", "text", "s.bucket", "s.guest")


def compare_with_edits(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text ends, in place of its last third, with the beginning of the next document in
    descending order of the id (rows that repeat an id: by a hash of the text).
    """
    dealt = with_next(docs)
    order = Window.partitionBy("bucket").orderBy(F.col("guest"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    printed = with_fingerprint(dealt.repartition("bucket"), "text", "own", k, w)
    paired = printed.select(
        "doc_id", "text", "own", "guest", F.lead("text").over(order).alias("next_text"), F.lead("own").over(order).alias("next"),
    ).filter(~F.col("guest"))
    n, cut = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.left("text", n - cut), F.left("next_text", cut))
    both = with_fingerprint(paired.withColumn("edited", edited), "edited", "other", k, w)
    hashes = both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "own", "other",
        kept_hashes(F.col("own")).alias("h_own"), kept_hashes(F.col("other")).alias("h_other"), kept_hashes(F.col("next")).alias("h_next"))
    return hashes.select(
        "doc_id", "n_chars", "edited_sha256", as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("h_own"), F.col("h_other")).alias("near_edited"), likeness(F.col("h_own"), F.col("h_next")).alias("near_next"))
