"""Quality rules by distribution divergence, in DataFrame expressions alone.

A document's histogram of character classes and its histogram of common words are compared with
those of its language, counted over the whole corpus, by Jensen-Shannon distance. Short texts,
whose histograms say little, get wider limits, and below a least length they pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import stored

COMMON_WORDS = 24  # of a language's histogram; all other words are one more bin
COMMON_BYTES = 5  # longest common word of the SQL of op4; ``judge`` counts words of every length
LEAST_REFERENCE_WORDS = 5_000  # of a language that has a reference of its own
MOST_BROADCAST = 10_000  # references of a kilobyte or so that are sent to every task; more are joined by a shuffle
LEAST_CHARS = 300  # shorter texts pass the character rule
LEAST_WORDS = 30  # shorter texts pass the word rule
CHAR_LIMIT = 0.25
WORD_SPREAD = 2.2  # times the median distance of a language's own texts
WORD_LEAST = 0.12  # at least: texts much alike have a median near 0
WORD_SHARE = 0.75  # at most, of the distance of a text without any common word
STEPS = 1000  # of the distances among which the median is found
NOISE = 0.6  # limits widen by NOISE * sqrt(bins / (8 * counted things))
WINDOW = 5  # words
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CLASSES = ("space", "upper", "mark", "symbol", "rest")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def total(values: Column, zero: Column) -> Column:
    return F.aggregate(values, zero, lambda a, x: a + x)


def without(text: Column, pattern: str) -> Column:
    """Characters left when the pattern's are taken out."""
    return F.length(F.regexp_replace(text, pattern, ""))


def words_of(text: Column) -> Column:
    """Words cut at ASCII white space."""
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of WINDOW words met twice or more, the first time included.

    Windows are compared by 64-bit hashes. Sorted with their places, equal ones are neighbours;
    only a text that has a repeated window is sorted.
    """

    def covered(places: Column) -> Column:
        step = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
        return total(step, F.lit(0))

    def marked(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(p: Column) -> Column:
            alike = lambda e, other: F.coalesce(e["h"] == other["h"], F.lit(False))
            same = F.filter(p, lambda e, j: alike(e, F.get(p, j - 1)) | alike(e, F.get(p, j + 1)))
            return let(F.sort_array(F.transform(same, lambda e: e["i"])), covered)

        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0)).otherwise(let(pairs, twice))

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - WINDOW)
        hashes = F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))
        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(let(hashes, marked))

    return let(F.transform(words, lambda w: F.xxhash64(w)), windows)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.ltrim(x, F.lit(SPACE)) != "")  # reads no further than the first word
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two arrays of shares."""

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), total(parts, F.lit(0.0))))


def shares(counts: Column) -> Column:
    return let(
        total(F.transform(counts, lambda x: x.cast("double")), F.lit(0.0)),
        lambda n: F.transform(counts, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))),
    )


def counted(docs: DataFrame) -> DataFrame:
    """What the rules need of each row's text, found in one pass: doc_id, lang, the counts, classes (characters of each class)
    and words, all its words in lower case. A null text is empty."""
    text = F.col("text")
    size = F.length(text)
    symbols, upper = size - without(text, r"[#*$%&|<>]+"), size - without(text, "[A-Z]+")
    marks = size - without(text, "[0-9.,;:!?'\"()-]+")

    def facts(words: Column) -> Column:
        lower = F.transform(words, F.lower)
        spaceless = F.length(F.array_join(words, ""))
        return F.struct(F.size(words), spaceless.cast("long"), repeated_words(words), lower)

    plain = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    long = lambda c: c.cast("long")
    return plain.select(
        "doc_id",
        "lang",
        F.inline(F.array(let(words_of(text), facts))).alias("n_words", "word_chars", "n_repeat_words", "words"),
        long(size).alias("n_chars"),
        long(symbols).alias("n_symbols"),
        long(upper).alias("n_upper"),
        long(marks).alias("n_marks"),
        long(repeated_lines(text)).alias("n_dup_lines"),
    ).withColumn(
        "classes",
        F.array(
            F.col("n_chars") - F.col("word_chars"),
            "n_upper",
            "n_marks",
            "n_symbols",
            F.col("word_chars") - F.col("n_upper") - F.col("n_marks") - F.col("n_symbols"),
        ),
    )


def spoken(docs: DataFrame) -> DataFrame:
    """(lang, words): the words of each row alone, in lower case; white space at an end leaves an empty one."""
    lower = F.lower(F.coalesce("text", F.lit("")))
    return docs.select(F.col("lang").cast("string").alias("lang"), F.split(lower, r"[ \t-\r]+").alias("words"))


def word_counts(found: DataFrame) -> DataFrame:
    """(lang, word, n) of all words, whatever their length."""
    words = found.select("lang", F.explode("words").alias("word")).where("word != ''")
    return words.groupBy("lang", "word").agg(F.count("*").alias("n"))


def common_words(counts: DataFrame) -> DataFrame:
    """Per language of LEAST_REFERENCE_WORDS words, and for all documents together under null: words, a map from its common words to
    letters; longest, the bytes of the longest of them; common, the words' shares, the last for all other words; and bare, the
    distance of a text that has none of them. No row under null where there are no words.
    """
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "n")
    each = counts.where("lang is not null").unionAll(pooled)
    sums = each.groupBy("lang").agg(F.sum("n").alias("n_all")).where((F.col("n_all") >= LEAST_REFERENCE_WORDS) | F.col("lang").isNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = each.withColumn("rank", rank).where(F.col("rank") <= COMMON_WORDS)
    top = top.groupBy(F.col("lang").alias("of")).agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    both = sums.join(top, F.col("of").eqNullSafe(F.col("lang")))
    head = F.transform("top", lambda x: x["n"] / F.col("n_all"))
    letter = F.transform("top", lambda x: F.char(x["rank"] + 96))
    made = both.select(
        "lang",
        F.map_from_arrays(F.transform("top", lambda x: x["word"]), letter).alias("words"),
        F.array_max(F.transform("top", lambda x: F.octet_length(x["word"]))).alias("longest"),
        let(head, lambda h: F.concat(h, F.array(F.lit(1.0) - total(h, F.lit(0.0))))).alias("common"),
    )
    last = F.size("common") - 1
    none = F.transform("common", lambda _, i: F.when(i == last, F.lit(1.0)).otherwise(F.lit(0.0)))
    return made.withColumn("bare", distance(none, F.col("common")))


def references(found: DataFrame, common: DataFrame | None = None) -> DataFrame:
    """Per language of LEAST_REFERENCE_WORDS words, and for all documents together under null: chars, the shares of character
    classes, and what ``common_words`` says, of the words of ``found`` if it is not given.
    """
    common = common_words(word_counts(found)) if common is None else common
    sums = found.groupBy("lang").agg(
        F.sum("n_words").alias("n_all"), *(F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES)))
    )
    whole = sums.agg(F.lit(None).cast("string").alias("lang"), *(F.sum(c).alias(c) for c in sums.columns[1:]))
    large = sums.where("lang is not null").where(F.col("n_all") >= LEAST_REFERENCE_WORDS).unionAll(whole)
    chars = shares(F.array(*(f"c{i}" for i in range(len(CLASSES)))))
    both = large.select("lang", chars.alias("chars")).join(common.withColumnRenamed("lang", "of"), F.col("of").eqNullSafe(F.col("lang")), "left")
    return both.drop("of")


def compared(found: DataFrame, reference: DataFrame, *names: str) -> DataFrame:
    """Rows with key, the language they are compared with (null for all documents together), and columns ref_<name> of its reference."""
    own = reference.where("lang is not null").select(F.col("lang").alias("key"), *(F.col(c).alias(f"own_{c}") for c in names))
    rest = reference.where("lang is null").select(*(F.col(c).alias(f"all_{c}") for c in names))
    joined = found.join(small(own), F.col("lang") == F.col("key"), "left").join(F.broadcast(rest), F.lit(True), "left")
    pick = (F.when(F.col("key").isNull(), F.col(f"all_{c}")).otherwise(F.col(f"own_{c}")).alias(f"ref_{c}") for c in names)
    return joined.select(*found.columns, "key", *pick)


def histograms(found: DataFrame, common: DataFrame) -> DataFrame:
    """Rows of ``counted`` with bins, how often each common word of their reference stands in them and how often any other, for words.

    A word is looked up in one text of all common words, which is several times faster than the keys of a map. Commas part them there;
    a comma within a word gives way to a space, which no word has.
    """
    plain = lambda w: F.replace(w, F.lit(","), F.lit(" "))
    listed = F.array_join(F.transform(F.map_keys("words"), plain), ",")
    common = common.select("lang", "longest", listed.alias("listed"), F.map_values("words").alias("letters"))

    def histogram(letters: Column) -> Column:
        """Counts of the common words, of which each stands as a letter, and of the rest."""
        at = F.sequence(F.lit(1), F.size("ref_letters"))
        count = F.transform(at, lambda i: F.length(letters) - F.length(F.replace(letters, F.char(i + 96), F.lit(""))))
        return F.concat(count, F.array(F.col("n_words") - F.length(letters)))

    able = F.filter("words", lambda w: F.octet_length(w) <= F.col("ref_longest"))  # a longer word is none of them: it need not be looked up
    place = lambda w: F.call_function("find_in_set", plain(w), F.col("ref_listed"))
    letters = F.array_join(F.transform(able, lambda w: F.get("ref_letters", place(w) - 1)), "")
    bins = F.when(F.col("ref_letters").isNotNull(), let(letters, histogram))
    return compared(found, common, "letters", "longest", "listed").withColumn("bins", bins).select(*(c for c in found.columns if c != "words"), "bins")


def word_limits(judged: DataFrame) -> DataFrame:
    """(of, limit) per reference: WORD_SPREAD times the median word distance of the texts that are compared with it, beyond what their
    lengths explain, WORD_LEAST at least, but no more than WORD_SHARE of the distance of a text without common words.

    The median, which junk in less than half of the texts cannot move far, is found among STEPS distances, so few rows are sorted.
    """
    usable = judged.where(F.col("word_distance").isNotNull() & (F.col("n_words") >= LEAST_WORDS))
    step = F.ceil(F.greatest(F.lit(0.0), F.col("word_distance") - wider(COMMON_WORDS + 1, F.col("n_words"))) * STEPS).cast("int")
    counts = usable.groupBy(F.col("key").alias("of"), step.alias("step")).agg(F.count("*").alias("n"), F.max("bare").alias("bare"))
    of = Window.partitionBy("of")
    below = F.sum("n").over(of.orderBy("step"))
    ranked = counts.withColumns({"below": below, "all": F.sum("n").over(of)}).where(2 * F.col("below") >= F.col("all"))
    limit = F.least(F.greatest(F.min("step") / STEPS * WORD_SPREAD, F.lit(WORD_LEAST)), F.max("bare") * WORD_SHARE)
    return ranked.groupBy("of").agg(limit.alias("limit"))


def small(table: DataFrame) -> DataFrame:
    """For broadcast, if it has few rows."""
    return F.broadcast(table) if table.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else table


def wider(bins: int, of: Column) -> Column:
    """How far chance moves a histogram of so many bins, by how many things were counted."""
    return NOISE * F.sqrt(F.lit(float(bins)) / (8 * of))


def judge(docs: DataFrame, char_limit: float = CHAR_LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, char_distance, word_distance and word_limit.

    A null text has no words and fails. A language that is null or has few words is compared with all documents
    together. Equal rows get equal results, null ids stay null, other columns play no part. An empty table gives an empty result.
    """
    common = stored(common_words(stored(word_counts(spoken(docs)), "words")), "common")
    found = stored(histograms(counted(docs), common), "counted")
    reference = stored(references(found, common), "references")
    found = compared(found, reference, "chars", "common", "bare").withColumns(
        {
            "char_distance": F.when(F.col("n_chars") > 0, distance(shares(F.col("classes")), F.col("ref_chars"))),
            "word_distance": F.when(
                (F.col("n_words") > 0) & F.col("ref_common").isNotNull(),
                distance(shares(F.col("bins")), F.col("ref_common")),
            ),
        }
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")
    far = found.select("doc_id", *counts, "key", F.col("ref_bare").alias("bare"), "char_distance", "word_distance")
    far = stored(far, "distances")
    limits = stored(word_limits(far), "limits")
    far = far.join(small(limits), F.col("key").eqNullSafe(F.col("of")), "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    char_ok = (F.col("n_chars") < LEAST_CHARS) | (F.col("char_distance") <= char_limit + wider(len(CLASSES), F.col("n_chars")))
    word_ok = (F.col("n_words") < LEAST_WORDS) | (F.col("word_distance") <= F.col("limit") + wider(COMMON_WORDS + 1, F.col("n_words")))
    passed = ~failed & F.coalesce(char_ok, F.lit(True)) & F.coalesce(word_ok, F.lit(True))
    whole = (F.col(c).cast("long").alias(c) for c in counts[:-1])
    return far.select(
        "doc_id", *whole, failed.alias("base_failed"), passed.alias("kept"), "char_distance", "word_distance", F.col("limit").alias("word_limit")
    )
