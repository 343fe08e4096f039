"""Document fingerprints by winnowing (operator 1), in DataFrame functions only.

Every k-gram of a text's code points is hashed; of each window of w
consecutive k-gram hashes the smallest is chosen, the rightmost one among
equals, and kept with its position.  Any shared passage of at least w + k - 1
code points leaves a shared fingerprint, and nothing shorter than k does.

* The text is held as UTF-32, so a k-gram is a fixed-size slice found by its
  offset, whatever the text's length.
* Hash and position share one long, the position subtracted from the shifted
  hash: a plain minimum takes the smallest hash and, among equals, the
  rightmost one.
* The sliding minimum doubles its reach LEVELS times: w = 2 ** LEVELS.

Texts shorter than k have one k-gram, the whole text; those with fewer than
w k-grams have one window.  Null or empty texts have no fingerprint and are
alike to each other only.

``fingerprints_with_next`` also compares each document with its edited text
and its follower in descending doc_id order.  Followers are found without a
global sort: rows are dealt by doc_id ranges whose borders are approximate
quantiles (a fixed number of longs), each range is ordered by itself, and the
last row of a range takes the first row of the next one.  Rows that repeat a
doc_id follow each other in descending text order; a null doc_id comes last.
The windows that an edited text shares with its original are not computed
again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_parts

K = 12
LEVELS = 4
W = 1 << LEVELS
MAX_RANGES = 4096

_POSITION_BITS = 31
_HASH_MASK = ((1 << 32) - 1) << _POSITION_BITS  # 32 hash bits above the position, sign bit clear


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def gram_keys(text: Column, k: int = K, base: Column | None = None) -> Column:
    """Per k-gram of a non-empty text: its hash, shifted, less its byte offset
    in UTF-32 (from 1).  ``base``: code points before ``text`` in the whole."""
    def all_grams(wide):
        last = F.greatest(F.lit(1), F.length(wide) - (4 * k - 1)).cast("int")

        def key(at):
            place = at if base is None else at + base * 4
            return F.xxhash64(F.substring(wide, at, F.lit(4 * k))).bitwiseAND(F.lit(_HASH_MASK)) - place

        return F.transform(F.sequence(F.lit(1), last, F.lit(4)), key)

    return _let(F.encode(text, "UTF-32"), all_grams)


def _window_minima(keys: Column) -> Column:
    """Minimum of each window of W keys (``keys`` has W at least)."""
    def doubled(reach):
        if reach == W:
            return lambda a: F.slice(a, F.lit(1), F.size(a) - (W - 1))
        return lambda a: _let(F.zip_with(a, F.slice(a, F.lit(1 + reach), F.size(a)), lambda x, y: F.least(x, y)), doubled(2 * reach))

    return doubled(1)(keys)


def window_keys(text: Column, k: int = K, base: Column | None = None) -> Column:
    """The chosen key of every window of a text, in order.  A text of fewer
    than W k-grams has one window, unless it only continues another (base > 0)."""
    few = F.array_min if base is None else (lambda a: F.when(base == 0, F.array_min(a)))

    def winnow(keys):
        return F.when(F.size(keys) >= W, _window_minima(keys)).otherwise(F.filter(F.array(few(keys)), lambda x: x.isNotNull()))

    return F.when(F.char_length(text) > 0, _let(gram_keys(text, k, base), winnow)).otherwise(F.array().cast("array<bigint>"))


def _hash_of(key: Column) -> Column:
    """The key's hash: offsets are positive and below 2 ** 31, so the next multiple of 2 ** 31."""
    return F.shiftright(key + ((1 << _POSITION_BITS) - 1), _POSITION_BITS)


def hashes(keys: Column) -> Column:
    return F.array_distinct(F.transform(keys, _hash_of))


def printed(keys: Column) -> Column:
    """``hash@position`` of each chosen k-gram, the hash in hex, the position in code points, joined by one space."""
    def one(key):
        offset = F.shiftleft(_hash_of(key), _POSITION_BITS) - key
        return F.concat(F.hex(_hash_of(key)), F.lit("@"), F.shiftright(offset, 2).cast("string"))

    return F.array_join(F.transform(keys, one), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two hash sets; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def fingerprint(docs: DataFrame, column: str = "text", out: str = "fingerprint_keys", k: int = K) -> DataFrame:
    """Add the chosen keys of a text column (see :func:`printed`, :func:`hashes`)."""
    return docs.withColumn(out, F.array_distinct(window_keys(F.coalesce(F.col(column), F.lit("")), k)))


_NO_ID = -(1 << 63)


def _range_of(docs: DataFrame) -> Column:
    """Number of a doc_id's range, counted from the largest ids; the borders are constants of the plan."""
    parts = min(MAX_RANGES, 2 * shuffle_parts(docs.sparkSession))
    found = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] if parts > 1 else None
    borders = sorted(set(found or []))
    if not borders:
        return F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    above = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in borders]), lambda b: b >= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), len(borders) + 1).otherwise(above)


def in_ranges(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text without nulls) dealt by doc_id range, one shuffle: doc_id, text, part, guest.

    Each range also gets, as a guest, the first row of the range after it (the
    last range: of the first), so that a row's follower is in its own range."""
    rows = docs.withColumn("part", _range_of(docs).cast("int"))
    key = F.coalesce("doc_id", F.lit(_NO_ID)).alias("i")
    heads = rows.select("part", key).groupBy("part").agg(F.max("i").alias("i"))
    whole = Window.orderBy("part")  # one row per range, longs only
    last = F.last("part").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", "i", F.coalesce(F.lag("part").over(whole), last).alias("target"))
    first = rows.select("part", key, "doc_id", "text").join(F.broadcast(heads), ["part", "i"])  # at most MAX_RANGES + 1 rows
    guests = first.groupBy("target").agg(F.max("text").alias("text"))
    guests = guests.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("target").alias("part"), F.lit(True).alias("guest"))
    return rows.withColumn("guest", F.lit(False)).unionByName(guests).repartition("part")


def fingerprints_with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by
    the first as many (or all) of the next document's."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    rows = in_ranges(rows).withColumn("following", F.lead("text").over(order))
    rows = rows.withColumn("n", F.char_length("text")).withColumn("cut", F.floor(F.col("n") / 3).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("cut")), F.substring("following", F.lit(1), F.col("cut")))
    rows = rows.withColumn("edited", F.coalesce(edited, F.lit("")))
    # windows that lie in the kept part are the original's; the others start at code point `kept`
    kept = F.greatest(F.lit(0), F.col("n") - F.col("cut") - (k - 1) - (W - 1))
    rows = rows.withColumn("kept", kept).withColumn("windows", window_keys(F.col("text"), k))
    rest = window_keys(F.substring("edited", F.col("kept") + 1, F.char_length("edited")), k, F.col("kept"))
    rows = rows.withColumn("edited_windows", F.concat(F.slice("windows", F.lit(1), F.col("kept")), rest))
    rows = rows.select("doc_id", "guest", "part", "text", "n", F.sha2("edited", 256).alias("edited_sha256"),
                       F.array_distinct("windows").alias("keys"), F.array_distinct("edited_windows").alias("edited_keys"))
    rows = rows.withColumn("own", hashes(F.col("keys")))
    rows = rows.withColumn("next_own", F.lead("own").over(order)).where(~F.col("guest"))
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", printed(F.col("keys")).alias("fingerprint"),
        printed(F.col("edited_keys")).alias("edited_fingerprint"),
        likeness(F.col("own"), hashes(F.col("edited_keys"))).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
