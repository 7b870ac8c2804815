"""Document fingerprints by winnowing, in native Spark expressions.

A text is read as units: words, longer ones cut every ``UNIT`` characters, so a text
without spaces has units too.  Every run of ``k`` units is hashed; of every ``window``
consecutive hashes the smallest is kept, of equal ones the rightmost, with its position.
Two texts that share a run of ``k + window - 1`` units, cut alike, therefore share a kept
hash, and the positions tell where.  ``window`` is a power of two: minima
over windows are found by doubling, in one pass over the array per doubling.

A text with fewer than ``k`` units is one run; with fewer runs than a window, one window.
A text without units, empty or null, has the hash of nothing at position 0.  Equal texts
have equal fingerprints.  Each text is worked on in its own row, so ties, repeated rows,
hot sources and empty tables need no care; no column but id and text is read.

A hash and its position share one long: 32 bits of hash over 31 bits of position counted
down, so the smallest long is the smallest hash, rightmost first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygraph.llm.common import BLANKS

K = 4
WINDOW = 8
UNIT = 32
BLOCK_LOG2 = 16             # ids of one block of the successor search: 65 536 at most
_LAST = (1 << 31) - 1


def packed(value: Column, i: Column) -> Column:
    """Hash and position in one long."""
    return F.shiftleft(F.shiftrightunsigned(value, 32), 31) + (F.lit(_LAST) - i)


def _smaller(values: Column, step: int) -> Column:
    """Smaller of each value and the one ``step`` further on, for those that have one."""
    n = F.greatest(F.size(values) - F.lit(step), F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(step + 1), n), lambda x, y: F.least(x, y))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """``out``: array of kept (hash, position) longs in order of position."""
    if k < 1 or window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    words = F.split(F.coalesce(F.col(text), F.lit("")), BLANKS)
    df = df.withColumn("_w", words).withColumn("_w", F.when(
        F.exists("_w", lambda w: F.octet_length(w) > UNIT), F.regexp_extract_all(
            F.array_join("_w", " "), F.lit(rf"[^\x20\x09-\x0D]{{1,{UNIT}}}"), F.lit(0)))
        .otherwise(F.array_remove("_w", "")))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    short = F.array(F.aggregate(F.col("_h"), F.lit(0).cast("bigint"), lambda acc, x: F.xxhash64(acc, x)))
    runs = F.transform(F.slice("_h", F.lit(1), F.greatest(F.size("_h") - F.lit(k - 1), F.lit(0))), lambda h, i: packed(
        F.xxhash64(h, *[F.get(F.col("_h"), i + F.lit(j)) for j in range(1, k)]), i))
    df = df.withColumn("_p", F.when(F.size("_h") < k, F.transform(short, packed)).otherwise(runs)).withColumn("_m", F.col("_p"))
    step = 1
    while step < window:        # one projection per doubling: an expression used twice would be computed twice
        df = df.withColumn("_m", _smaller(F.col("_m"), step))
        step *= 2
    kept = F.when(F.size("_p") <= window, F.array(F.array_min("_p"))).otherwise(F.array_distinct("_m"))
    return df.withColumn(out, kept).drop("_w", "_h", "_p", "_m")


def hashes_of(fingerprint: Column) -> Column:
    """Distinct kept hashes, as signed 32-bit numbers."""
    return F.array_distinct(F.transform(fingerprint, lambda x: (F.shiftright(x, 31) - F.lit(1 << 31)).cast("int")))


def position_of(kept: Column) -> Column:
    """Unit at which the run of a kept long begins."""
    return F.lit(_LAST) - kept.bitwiseAND(F.lit(_LAST))


def rendered(fingerprint: Column) -> Column:
    """``hash:position`` of each kept run, in order."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, 31))), F.lit(":"), position_of(x).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared over all distinct hashes of two sets from ``hashes_of``, 0 to 1."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def successors(ids: DataFrame) -> DataFrame:
    """``next_id`` of each distinct id in ascending order, the first after the last; other columns stay.

    Blocks of neighbouring ids are ordered by themselves; only one row per block (its first
    id, one for up to 65 536 ids) is ordered in one place.  Rows without an id are left out.
    """
    rows = ids.filter(F.col("id").isNotNull()).withColumn("block", F.shiftright("id", BLOCK_LOG2))
    inside = rows.withColumn("next_id", F.lead("id").over(Window.partitionBy("block").orderBy("id")))
    firsts = rows.groupBy("block").agg(F.min("id").alias("first"))
    order = Window.orderBy("block")
    following = firsts.select("block", F.coalesce(F.lead("first").over(order), F.min("first").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("first_after"))
    return (inside.join(following, "block")
            .withColumn("next_id", F.coalesce("next_id", "first_after")).drop("block", "first_after"))


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Each text, its fingerprint, the text with its last quarter replaced by the head of the next one, and the likenesses.

    ``doc_id, n_chars, text, fingerprint, edited, edited_fingerprint, near_edited, near_next``.
    The text moves once, by id; only heads and the hashes of their texts move again.  Of rows that
    share an id, the next document is the one with the smallest head.  A row without an id
    has no next: its last quarter is cut off, and its likeness to the next is 0.
    """
    # Both joins below move these two columns of these rows.  They are left as they are read,
    # names and all, for only then are the two moves one.
    base = docs.select(docs[key], docs[text])
    known = base.filter(docs[key].isNotNull())
    take = F.floor(F.char_length(F.coalesce(F.col(text), F.lit(""))) / 4).cast("int")
    ids = known.groupBy(F.col(key).cast("bigint").alias("id")).agg(F.max(take).alias("take"))
    links = successors(ids).select(F.col("id").alias("prev_id"), "take", F.col("next_id").alias(key))
    after = with_fingerprint(known.join(links, key).withColumnRenamed(text, "_text"), "_text", "fp", k, window)
    heads = (after.select("prev_id", F.expr("substring(coalesce(_text, ''), 1, take)").alias("head"),
                          hashes_of(F.col("fp")).alias("after"))
             .groupBy(F.col("prev_id").alias(key)).agg(F.min(F.struct("head", "after")).alias("next")))
    alone = (base.filter(docs[key].isNull())
             .withColumn("next", F.lit(None).cast(heads.schema["next"].dataType)))
    out = known.join(heads, key, "left").unionByName(alone)
    out = out.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), "next")
    out = out.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("n", F.char_length("text"))
    changed = F.concat(F.expr("substring(text, 1, cast(n - n div 4 as int))"),
                       F.coalesce(F.expr("substring(next.head, 1, cast(n div 4 as int))"), F.lit("")))
    out = with_fingerprint(out, "text", "fp", k, window)
    out = with_fingerprint(out.withColumn("edited", changed), "edited", "edited_fp", k, window)
    out = out.withColumns({"own": hashes_of(F.col("fp")), "other": hashes_of(F.col("edited_fp"))})
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_chars"), "text", F.col("fp").alias("fingerprint"), "edited",
                      F.col("edited_fp").alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
                      F.coalesce(likeness(F.col("own"), F.col("next.after")), F.lit(0.0)).alias("near_next"))
