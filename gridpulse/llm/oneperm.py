"""Document fingerprints by one-permutation MinHash, in DataFrame expressions alone.

Every shingle of five words is hashed once. The upper bits of a hash choose its bin, each bin keeps its
smallest hash, and an empty bin takes that of a full bin which it draws for itself (optimal
densification). The low byte of each bin is kept. Two fingerprints agree on a byte where the sets'
minima agree, or by chance on one byte in 256, for which the likeness is corrected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.divergence import let, total, words_of

SHINGLE = 5  # words
BIN_BITS = 7
BINS = 1 << BIN_BITS
CHANCE = 1 / 256  # that unequal minima agree on their low byte
GROUP_ROWS = 5_000  # of neighbouring documents that one window holds, about
MOST_GROUPS = 20_000  # bounds what the driver learns of the order of ids


def shingle_hashes(text: Column) -> Column:
    """A hash per five words, of all words if fewer; none for a text without words."""

    def hashes(words: Column) -> Column:
        last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE))))
        return F.when(F.size(words) == 0, F.array().cast("array<long>")).otherwise(each)

    return let(F.transform(words_of(F.lower(text)), lambda w: F.xxhash64(w)), hashes)


def bin_of(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS)


def empty_marks() -> Column:
    """The largest value of every bin: it stands for the bin where no shingle falls."""
    marks = [(b << (64 - BIN_BITS) | (1 << (64 - BIN_BITS)) - 1) for b in range(BINS)]
    return F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in marks))


def is_mark(value: Column) -> Column:
    ones = (1 << (64 - BIN_BITS)) - 1
    return value.bitwiseAND(F.lit(ones).cast("long")) == F.lit(ones).cast("long")


def dense_bins(hashes: Column) -> Column:
    """The smallest hash of each bin, in one order of bins; an empty bin's from a full one."""

    def lowest(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.coalesce(F.get(s, i - 1), x))))

    def filled(m: Column) -> Column:
        full = F.filter(m, lambda x: ~is_mark(x))

        def borrowed(f: Column) -> Column:
            draw = lambda x: F.array_min(F.transform(f, lambda y: F.struct(F.xxhash64(bin_of(x), bin_of(y)), y.alias("v"))))["v"]
            return F.when(F.size(f) == BINS, m).otherwise(F.transform(m, lambda x: F.when(is_mark(x), draw(x)).otherwise(x)))

        return let(full, borrowed)

    return let(let(F.sort_array(F.concat(hashes, empty_marks())), lowest), filled)


def low_bytes(text: Column) -> Column:
    """The fingerprint as an array of bytes; empty for a text without words."""

    def packed(h: Column) -> Column:
        low = F.transform(dense_bins(h), lambda x: x.bitwiseAND(F.lit(255)).cast("int"))
        return F.when(F.size(h) == 0, F.array().cast("array<int>")).otherwise(low)

    return let(shingle_hashes(text), packed)


def as_hex(low: Column) -> Column:
    """Two hexadecimal digits a byte; an empty text for an empty fingerprint."""
    return F.lower(F.array_join(F.transform(low, lambda x: F.lpad(F.hex(x), 2, "0")), ""))


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1, corrected for agreement by chance.

    Of two empty fingerprints 1, of one empty one 0.
    """

    def between(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        agree = total(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0)) / BINS
        real = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (agree - CHANCE) / (1 - CHANCE)))
        empty = (F.size(a) == 0) | (F.size(b) == 0)
        return F.when(empty, F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(real)

    return let(F.struct(one.alias("a"), other.alias("b")), between)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and fingerprint. A null text counts as empty; equal texts have equal fingerprints."""
    return docs.select("doc_id", as_hex(low_bytes(F.coalesce("text", F.lit("")))).alias("fingerprint"))


def ends_below(value: Column, ends: list[int]) -> Column:
    """How many of the sorted ends are smaller; found among blocks first, then within one."""
    block = max(1, round(len(ends) ** 0.5))
    blocks = [ends[i : i + block] for i in range(0, len(ends), block)]
    longs = lambda x: F.array(*(F.lit(e).cast("long") for e in x)) if x else F.array().cast("array<long>")
    below = lambda many: F.aggregate(many, F.lit(0), lambda n, e: n + F.when(value > e, 1).otherwise(0))
    whole = below(longs([b[-1] for b in blocks]))
    if not blocks:
        return F.lit(0)
    inside = lambda i: i * block + F.coalesce(below(F.get(F.array(*map(longs, blocks)), i)), F.lit(0))
    return let(whole, inside)


def grouped_in_order(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rows with ``group``, a range of neighbouring ids, and ``guest``: each group also gets, as a guest, a copy of the row
    that follows its last one. The last group's guest is the first row of all.

    The ranges come from quantiles of the ids; a null id comes before all others. Only the ranges' ends, MOST_GROUPS at
    most, reach the driver.
    """
    n = docs.count()
    pieces = max(1, min(MOST_GROUPS, n // group_rows))
    at = [i / pieces for i in range(1, pieces)]
    found = docs.agg(F.percentile_approx("doc_id", at, 100 * pieces)).first()[0] if at else []
    placed = docs.withColumn("group", ends_below(F.col("doc_id"), sorted(set(found or []))))
    first = placed.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")).alias("first"))
    groups = Window.orderBy("group")  # of one row a group, MOST_GROUPS at most
    before = F.coalesce(F.lag("group").over(groups), F.max("group").over(Window.partitionBy()))
    guests = first.select(before.alias("to"), F.col("first.doc_id").alias("first_id"), F.col("first.tie").alias("first_tie"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    copies = docs.join(F.broadcast(guests), same).dropDuplicates(["to"])
    copies = copies.select(*docs.columns, F.col("to").alias("group"), F.lit(True).alias("guest"))
    return placed.withColumn("guest", F.lit(False)).unionByName(copies)


def compare_edits(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Fingerprint each text and its edited text: the last half of it replaced by as much from the start of the next.

    Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The next document is that of the next doc_id, after the last the first; rows of one doc_id follow in the
    order of a hash of their texts, a null id comes first. A null text counts as empty. A table of one row follows
    itself. Other columns play no part.
    """
    text = F.coalesce("text", F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    placed = grouped_in_order(plain, group_rows).withColumn("low", low_bytes(F.col("text")))
    order = Window.partitionBy("group").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie")
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    beside = placed.select(
        "doc_id",
        "guest",
        "text",
        "low",
        F.lead("text").over(order).alias("next_text"),
        F.lead("low").over(order).alias("next_low"),
    ).where(~F.col("guest"))
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    beside = beside.select("doc_id", size.cast("long").alias("n_chars"), "low", "next_low", edited.alias("edited"))
    made = beside.withColumn("edited_low", low_bytes(F.col("edited")))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_hex(F.col("low")).alias("fingerprint"),
        as_hex(F.col("edited_low")).alias("edited_fingerprint"),
        likeness(F.col("low"), F.col("edited_low")).alias("near_edited"),
        likeness(F.col("low"), F.col("next_low")).alias("near_next"),
    )
