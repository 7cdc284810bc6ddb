"""Document fingerprints from closed syncmers of words.

A run of ``K`` words is chosen if the least hash among its inner runs of ``S`` words is that of
the first or the last of them. The choice depends on these words alone, so equal passages choose
equal anchors wherever they stand, and each passage of some words has one. A sketch holds all
anchors of a text, each with its word position; the printed fingerprint shows the ``SIZE`` with the
least hashes. Two sketches are compared by all their anchors: those in both are paired, pairs that
lie off the line of their neighbours are dropped, the rest falls into runs whose order is the same
in both texts, and the longest chain of runs counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import bind, text_of
from tallyhouse.llm.line_rules import words_of

K = 5
S = 2
SIZE = 64  # anchors that are printed
HASH_BITS = 39
PLACE_BITS = 23  # of a word position; words beyond share the last one
PLACES = (1 << PLACE_BITS) - 1
DRIFT = 128  # words by which neighbours may lie off each other's line
BUCKET_ROWS = 1000
MAX_BUCKETS = 1 << 16
LOWEST = -(1 << 63)


def _anchors(words: Column) -> Column:
    """Chosen runs as whole numbers: ``HASH_BITS`` bits of hash above the bits of position, one per hash, in order."""
    inner = K - S  # inner runs besides the first

    def packed(value: Column, place: Column) -> Column:
        return F.shiftleft(value.bitwiseAND(F.lit((1 << HASH_BITS) - 1).cast("long")), PLACE_BITS).bitwiseOR(F.least(place.cast("long"), F.lit(PLACES).cast("long")))

    def chosen(g: Column) -> Column:
        def mark(x: Column, i: Column) -> Column:
            others = [F.get(g, i + j) for j in range(1, inner + 1)]
            edge = F.least(x, *others)
            return F.when(others[-1].isNotNull() & ((edge == x) | (edge == others[-1])), packed(F.xxhash64(x, *others[S - 1 :: S], others[-1]), i))

        return F.sort_array(F.array_compact(F.transform(g, mark)))

    def once(sorted_: Column) -> Column:
        return F.filter(sorted_, lambda x, j: F.coalesce(F.shiftright(x, PLACE_BITS) != F.shiftright(F.get(sorted_, j - 1), PLACE_BITS), F.lit(True)))

    def of(w: Column) -> Column:
        runs = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, S)])), F.lit(1), F.greatest(F.size(w) - (S - 1), F.lit(0)))
        whole = F.array(packed(F.xxhash64(w), F.lit(0)))
        some = bind(bind(runs, chosen), once)
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(bind(some, lambda a: F.when(F.size(a) > 0, a).otherwise(whole)))

    return bind(words, of)


def sketch(text: Column) -> Column:
    """All anchors of a whole text as an array of long, in the order of their hashes.

    A text in which no run is chosen, such as one of fewer than ``K`` words, has one anchor, the
    hash of all its words; a text without words has none.
    """
    return _anchors(words_of(text))


def printed(sketch_: Column) -> Column:
    """The ``SIZE`` least anchors as text, 16 hexadecimal digits each."""
    return F.array_join(F.transform(F.slice(sketch_, 1, SIZE), lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def common_anchors(a: Column, b: Column) -> Column:
    """Pairs of places (``here``, ``there``) of the hashes that both sketches have, in the order of ``here``."""
    both = F.sort_array(F.concat(F.transform(a, lambda v: v * 2), F.transform(b, lambda v: v * 2 + 1)))

    def pairs(u: Column) -> Column:
        def place(x: Column) -> Column:
            return F.shiftright(x, 1).bitwiseAND(F.lit(PLACES).cast("long")).cast("int")

        def pair(x: Column, j: Column) -> Column:
            y = F.get(u, j + 1)
            turned = x.bitwiseAND(F.lit(1).cast("long")) == 1  # of equal hashes the lesser place comes first, whichever text it is of
            here, there = F.when(turned, place(y)).otherwise(place(x)), F.when(turned, place(x)).otherwise(place(y))
            return F.when(F.shiftright(x, PLACE_BITS + 1) == F.shiftright(y, PLACE_BITS + 1), F.struct(here.alias("here"), there.alias("there")))

        return F.sort_array(F.array_compact(F.transform(u, pair)))

    return bind(both, pairs)


def chained(pairs: Column) -> Column:
    """Pairs on the longest chain of runs that have the same order in both texts."""

    def shift(x: Column) -> Column:
        return x["there"] - x["here"]

    def in_line(p: Column) -> Column:
        def near(x: Column, y: Column) -> Column:
            return F.coalesce(F.abs(shift(x) - shift(y)) <= DRIFT, F.lit(False))

        alone = F.size(p) == 1
        return F.filter(p, lambda x, j: alone | near(x, F.get(p, j - 1)) | near(x, F.get(p, j + 1)))

    def runs(p: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda j: (j == 0) | F.coalesce(F.get(p, j)["there"] <= F.get(p, j - 1)["there"] - DRIFT, F.lit(False)))

        def run(s: Column) -> Column:
            def of(x: Column, k: Column) -> Column:
                end = F.coalesce(F.get(s, k + 1), F.size(p))
                return F.struct(F.get(p, x)["there"].alias("first"), F.get(p, end - 1)["there"].alias("last"), (end - x).alias("n"))

            return F.transform(s, of)

        return F.when(F.size(p) > 0, bind(starts, run)).otherwise(F.array().cast("array<struct<first:int,last:int,n:int>>"))

    def longer(ends: Column, x: Column) -> Column:
        before = F.transform(F.filter(ends, lambda e: e["last"] - DRIFT < x["first"]), lambda e: e["n"])
        return F.concat(ends, F.array(F.struct(x["last"].alias("last"), (F.coalesce(F.array_max(before), F.lit(0)) + x["n"]).alias("n"))))

    def longest(r: Column) -> Column:
        ends = F.aggregate(r, F.array().cast("array<struct<last:int,n:int>>"), longer)
        return F.coalesce(F.array_max(F.transform(ends, lambda e: e["n"])), F.lit(0))

    return bind(bind(bind(pairs, in_line), runs), longest)


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two sketches' common anchors on one chain, 0 to 1; 1 if both are empty."""

    def share(x: Column, y: Column) -> Column:
        met = chained(common_anchors(x, y))
        return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(2.0 * met / (F.size(x) + F.size(y)))

    return bind(a, lambda x: bind(b, lambda y: share(x, y)))


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All anchors as rows, for positional matching by join: ``doc_id``, ``hash``, ``place``; none for texts without words."""
    each = docs.select(F.col(id_col).alias("doc_id"), F.explode(sketch(text_of(text_col))).alias("anchor"))
    return each.select("doc_id", F.shiftright("anchor", PLACE_BITS).alias("hash"), F.col("anchor").bitwiseAND(F.lit(PLACES).cast("long")).cast("int").alias("place"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text; null counts as empty and gives an empty one.

    Repeated ids and rows give a row each, texts of any length are read whole; an empty table gives none.
    """
    return docs.select(F.col(id_col).alias("doc_id"), printed(sketch(text_of(text_col))).alias("fingerprint"))


def with_next(rows: DataFrame, key: str, carried: list[str], bucket_rows: int = BUCKET_ROWS, max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """``rows`` with ``next_<column>`` of the row that follows in ascending ``key``; after the last, the first.

    ``key`` is a long without nulls; equal keys follow each other in the order of ``carried``. The
    keys are cut into buckets at values that occur among them, so that each bucket's first row is
    known, and goes along into the bucket before as a guest. Each bucket is one window group; the
    cuts, at most ``max_buckets`` numbers, are all that reaches the driver.
    """
    n, low = rows.agg(F.count("*"), F.min(key)).first()
    cuts = [low if low is not None else 0]
    buckets = min(max_buckets, -(-n // bucket_rows))
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted({*cuts, *rows.agg(F.percentile_approx(key, shares, 20 * buckets)).first()[0]})
    steps = (len(cuts) - 1).bit_length()
    table = F.array(*[F.lit(c).cast("long") for c in cuts]) if len(cuts) < 2 else F.lit(cuts).cast("array<bigint>")
    bucket = F.aggregate(
        F.array(*[F.lit(1 << s) for s in reversed(range(steps))]) if steps else F.array().cast("array<int>"), F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(table, at + step) <= F.col(key), F.lit(False)), at + step).otherwise(at))
    placed = rows.withColumn("_bucket", bucket)
    first = F.get(table, F.col("_bucket")) == F.col(key)
    home = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("guest"))
    away = F.struct(F.when(F.col("_bucket") == 0, F.lit(len(cuts) - 1)).otherwise(F.col("_bucket") - 1).alias("bucket"), F.lit(1).alias("guest"))
    seated = placed.select(*rows.columns, F.explode(F.when(first, F.array(home, away)).otherwise(F.array(home))).alias("_seat"))
    order = Window.partitionBy("_seat.bucket").orderBy("_seat.guest", key, *[F.hash(c) for c in carried])
    led = seated.select(*rows.columns, "_seat", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried])
    return led.filter("_seat.guest = 0").drop("_seat")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    Edited: the last quarter of the code points, rounded down, is replaced by the first as many
    of the document next in ascending id (after the last: the first). Columns: ``doc_id``,
    ``n_chars``, ``edited``, ``sketch``, ``edited_sketch``, ``near_edited``, ``near_next``.

    Null texts count as empty. A null id comes before all others; equal ids follow each other in
    an order that depends on the texts alone. One row alone is its own next; an empty table gives
    no row. Texts are shuffled once, without their sketches, which are longer than the texts.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    pairs = with_next(rows, "key", ["text"]).withColumns({"sketch": sketch(F.col("text")), "next_sketch": sketch(F.col("next_text"))})
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = pairs.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter)))
    made = edited.withColumn("edited_sketch", sketch(F.col("edited")))
    return made.select(
        "doc_id", n.cast("long").alias("n_chars"), "edited", "sketch", "edited_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
