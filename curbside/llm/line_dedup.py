"""Lines that are near copies of earlier lines, by an exact similarity join.

A line is the set of its words, its tokens. Tokens are ordered by rarity; two
sets can only reach the similarity if their prefixes, the rarest few tokens,
have one in common. Length and position of that token, and parities of the words
by hash, leave few pairs. Only for these the lines themselves are fetched and the
Jaccard similarity of their words is computed.

All of it are DataFrame operations. What every task gets are arrays of fixed
size: how frequent tokens are, by hash, how crowded prefix tokens are, and which
documents have a candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm.tables import same, stored

MIN_JACCARD = 0.8
# Entries of the array of how frequent words are, and of the other arrays.
WORD_SLOTS = 1 << 18
SLOTS = 1 << 16
# Sets of one prefix token that a task compares with each other.
CROWD = 2048
# Sets of more words have 128 parities, as 64 tell them apart badly.
MANY_WORDS = 40
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _kept(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored`, with the shuffle files of the job gone when it has ended."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def _words(line: Column) -> Column:
    """Words of a line of :func:`_lines`, in order."""
    return F.array_remove(F.split(line, " "), "")


def _plain(line: Column) -> Column:
    """The words with one blank between them; most lines are written so."""
    spaced = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    return F.when(spaced, F.array_join(_words(line), " ")).otherwise(line)


def _low(text_col: str) -> Column:
    """Lower-case texts whose words are apart by blanks and line ends alone."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    # Few texts have other white space, and to replace it costs more than to look.
    return F.when(
        F.rlike(low, F.lit(r"[\t\x0B\f\r]")), F.translate(low, "\t\x0b\x0c\r", "    ")
    ).otherwise(low)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lower-case lines whose words are apart by blanks alone."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("sign"),
        F.posexplode(F.split(_low(text_col), "\n")).alias("line_no", "line"),
    )


def _array_of(counts: DataFrame, slots: int = SLOTS) -> Column:
    """One array of ``slots`` numbers from rows ``(slot, value)``."""
    every = counts.sparkSession.range(slots).select(F.col("id").alias("slot"))
    filled = every.join(counts, "slot", "left").select(
        F.struct("slot", F.coalesce("value", F.lit(0)).alias("value")).alias("s")
    )
    # A fixed number of rows.
    return filled.agg(F.array_sort(F.collect_list("s"))["value"].alias("a")).scalar()


def _word_slot(word: Column) -> Column:
    return F.hash(word).bitwiseAND(WORD_SLOTS - 1)


def _classes(docs: DataFrame, text_col: str) -> bytes:
    """How frequent the words of each slot are: one byte for each slot.

    Classes are half a doubling wide. A lambda cannot hold a subquery, so the
    driver fetches the bytes, a fixed number of them.
    """
    text = F.replace(_low(text_col), F.lit("\n"), F.lit(" "))
    words = docs.select(F.explode(F.split(text, " ")).alias("w")).where("w <> ''")
    counts = words.groupBy(_word_slot(F.col("w")).cast("long").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    value = F.floor(2 * F.log2(F.col("n") + 1)).cast("long").alias("value")
    counts = _kept(counts.select("slot", value), "word-classes")
    found = counts.sparkSession.range(1)
    return bytes(found.select(_array_of(counts, WORD_SLOTS).alias("a")).first()[0])


def _least_overlap(n_x: Column, n_y: Column, jaccard: float) -> Column:
    return F.ceil((n_x + n_y) * (jaccard / (1 + jaccard)) - 1e-9)


def _prefix(n: Column, jaccard: float) -> Column:
    """Tokens among which two similar sets must have one in common."""
    return (n - F.ceil(n * jaccard - 1e-9) + 1).cast("int")


def _sets(docs: DataFrame, id_col: str, text_col: str, jaccard: float):
    """Lines with the key of their words, and the different lines as sets.

    Lines are the same if their words are, in order. The key is a SHA-256 of them.
    """
    lines = _lines(docs, id_col, text_col)
    classes = F.lit(_classes(docs, text_col))

    def key(word):
        # Class first, then the word: one order of tokens for all sets. Classes are below
        # 128, so that the byte is a letter; numbers are sorted faster than bytes.
        frequent = F.ascii(F.substring(classes, _word_slot(word) + 1, F.lit(1)).cast("string"))
        return F.shiftleft(frequent.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64(word), 8))

    def parities(keys, one):
        # A shift takes the last six bits of the hash.
        def turned(bits, k):
            return bits.bitwiseXOR(F.call_function("shiftleft", one(F.hash(k)).cast("long"), F.hash(k)))

        return F.aggregate(keys, F.lit(0).cast("long"), turned)

    # Parities of all words, and of those with the seventh bit: together 128.
    every = parities("keys", lambda h: F.lit(1))
    half = parities("keys", lambda h: F.shiftright(h, 6).bitwiseAND(1))
    line = F.col("line")
    rows = lines.where(F.trim(line) != "")
    # A set may have a key twice, if two of its words have one.
    keys = F.transform(F.array_distinct(_words(line)), key)
    rows = rows.withColumn("keys", F.sort_array(keys))
    n = F.size("keys")
    rows = _kept(
        rows.select(
            "row", "id", "sign", "line_no", n.alias("n"),
            F.unhex(F.sha2(_plain(line), 256)).alias("key"),
            F.transform(F.slice("keys", 1, _prefix(n, jaccard)), lambda k: F.hash(k)).alias("prefix"),
            every.alias("bits"),
            F.when(n > MANY_WORDS, half).otherwise(0).alias("more"),
        ),
        "lines",
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "sign", "line_no", "row")
    sets = _kept(
        rows.select("key", order.alias("order"), "n", "prefix", "bits", "more")
        .groupBy("key")
        .agg(
            F.min("order").alias("first"),
            F.count(F.lit(1)).alias("lines"),
            *[F.first(c).alias(c) for c in ("n", "prefix", "bits", "more")],
        )
        .withColumn("set", F.monotonically_increasing_id()),
        "line-sets",
    )
    return rows.drop("prefix", "bits", "more", "n"), sets


def _among(keys: DataFrame, key: Column) -> Column:
    """Whether a hash may be among ``keys``: a bit for each of 64 * ``SLOTS``."""
    bits = keys.select(F.pmod("key", F.lit(64 * SLOTS)).alias("bit")).distinct()
    bits = bits.groupBy(F.shiftright("bit", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("value")
    )
    array = _array_of(_kept(bits, "wanted-bits"))
    bit = F.pmod(key, F.lit(64 * SLOTS))
    word = F.element_at(array, (F.shiftright(bit, 6) + 1).cast("int"))
    return F.getbit(word, bit.bitwiseAND(63).cast("int")) == 1


def _met(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
    """Every two different sets that have the columns ``on`` in common, once.

    Where both sides are the same rows they go through one shuffle.
    """
    met = left.alias("a").join(right.alias("b"), list(on))
    return met.where("a.set < b.set").selectExpr(
        "a.set AS x", "b.set AS y",
        *[f"{t}.{c} AS {c}_{s}" for t, s in zip("ab", "xy") for c in ("bits", "more", "packed")],
    )


def _candidates(sets: DataFrame, jaccard: float, crowd: int) -> DataFrame:
    """Pairs ``(x, y)`` of sets with a common prefix token that may be similar.

    The rarest common token of similar sets has as many tokens behind it, on
    both sides, as the sets must have in common; and a bit in which parities differ
    is a word that one of the sets lacks. Where prefix tokens are crowded the sets of
    a token are dealt into parts, and each part meets each.
    """
    rows = sets.select(
        "set", F.col("n").cast("long").alias("n"), "bits", "more", F.posexplode("prefix").alias("pos", "token")
    ).select(
        "token", "set", "bits", "more",
        # Size and position travel as one number.
        (F.shiftleft("n", 32) + F.col("pos")).alias("packed"),
    )
    slot = F.pmod(F.col("token").cast("long"), F.lit(SLOTS))
    counts = _kept(
        sets.select(F.explode("prefix").alias("token"))
        .groupBy(slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("value")),
        "prefix-counts",
    )
    mean = (counts.agg(F.sum("value")).first()[0] or 0) // SLOTS
    # What is more than the usual number of tokens that share a slot.
    over = F.greatest(F.lit(0), F.col("value") - 3 * mean)
    parts = counts.select("slot", (F.floor(over / crowd) + 1).cast("long").alias("value"))
    rows = rows.withColumn(
        "parts", F.element_at(_array_of(parts.where("value > 1")), (slot + 1).cast("int"))
    )
    usual = rows.where(F.coalesce("parts", F.lit(0)) <= 1).drop("parts")
    crowded = rows.where("parts > 1")
    part = F.pmod(F.xxhash64("set"), "parts")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    columns = ("token", "set", "bits", "more", "packed")
    both = _met(usual, usual, "token").unionByName(
        _met(
            crowded.select(*columns, part.alias("px"), others.alias("py")),
            crowded.select(*columns, others.alias("px"), part.alias("py")),
            "token", "px", "py",
        )
    )
    n_x, n_y = (F.shiftright(f"packed_{side}", 32) for side in "xy")
    at_x, at_y = (F.col(f"packed_{side}").bitwiseAND(0xFFFFFFFF) for side in "xy")
    overlap = _least_overlap(n_x, n_y, jaccard)
    bits, more = (F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y")) for c in ("bits", "more"))
    apart = F.when(
        F.least(n_x, n_y) > MANY_WORDS, F.bit_count(bits.bitwiseXOR(more)) + F.bit_count(more)
    ).otherwise(F.bit_count(bits))
    return (
        both.where(n_x + n_y - apart >= 2 * overlap)
        .where(F.least(n_x - at_x, n_y - at_y) >= overlap)
        .select("x", "y")
        .distinct()
    )


def _verified(pairs, sets, docs, id_col, text_col, jaccard):
    """Of pairs of sets those that are similar, from both sides: ``(set, other)``."""
    pairs = _kept(pairs, "line-pairs")
    both = pairs.select(F.col("x").alias("set")).union(pairs.select("y")).distinct()
    wanted = _kept(
        both.join(sets, "set").select("set", "n", "first.id", "first.sign", "first.line_no"),
        "wanted",
    )
    # Texts and lines that are not wanted stay where they are.
    sign = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.where(_among(wanted.select(F.col("sign").alias("key")), sign))
    at = F.xxhash64("sign", "line_no")
    lines = _lines(texts, id_col, text_col).drop("row")
    lines = lines.where(_among(wanted.select(at.alias("key")), at))
    # A line takes fewer bytes than its words as an array.
    found = (
        lines.join(wanted, same(lines, wanted, "id", "sign", "line_no"))
        .select(wanted["set"], "n", "line")
        .dropDuplicates(["set"])
    )
    found = _kept(found, "wanted-lines")
    for side in "xy":
        named = found.select(*[F.col(c).alias(f"{c}_{side}") for c in found.columns])
        pairs = pairs.join(named, F.col(side) == F.col(f"set_{side}"))
    # What both have counts once, as the result is a set, and is named once, as a
    # condition that names it twice works it out twice.
    common = F.size(F.array_intersect(_words(F.col("line_x")), _words(F.col("line_y"))))
    similar = pairs.where((1 + jaccard) * common >= jaccard * (F.col("n_x") + F.col("n_y")) - 1e-9)
    sides = F.array(
        F.struct(F.col("x").alias("set"), F.col("y").alias("other")),
        F.struct(F.col("y").alias("set"), F.col("x").alias("other")),
    )
    return similar.select(F.inline(sides))


def match_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    jaccard: float = MIN_JACCARD,
    crowd: int = CROWD,
) -> DataFrame:
    """``(row, id, line_no, kept, match_id, match_line, n_lines, n_links)`` of every line.

    A line is kept unless an earlier line, by id and then line number, has the
    same lower-case words, or a set of words with a Jaccard similarity of
    ``jaccard`` or more. The match is the earliest such line, and null if the
    line is kept. ``n_lines`` counts the lines with the same words in the same
    order, the line included, and ``n_links`` the other lines that are similar,
    of which such copies are one. ``row`` numbers the rows of ``docs``; lines are
    numbered from 0. ``crowd`` is how many sets are compared by one task, and
    does not show in the result.

    Null and empty texts and lines of white space have no words: they are not
    listed, and always stay. Null ids come last. Rows that repeat an id are
    ordered by their text's hash; of rows equal in both one has its lines kept.
    An empty table gives no rows, and other columns are not looked at.
    """
    rows, sets = _sets(docs, id_col, text_col, jaccard)
    pairs = _candidates(sets, jaccard, crowd)
    similar = _verified(pairs, sets, docs, id_col, text_col, jaccard)
    firsts = sets.select(F.col("set").alias("other"), F.col("first").alias("earlier"))
    linked = _kept(
        similar.join(firsts, "other")
        .groupBy("set")
        .agg(F.min("earlier").alias("earlier"), F.count(F.lit(1)).alias("n_links")),
        "links",
    )
    decided = sets.select("key", "set", "first", "lines").join(linked, "set", "left")
    joined = rows.join(decided.drop("set"), "key")
    original = (F.col("row") == F.col("first.row")) & (
        F.col("line_no") == F.col("first.line_no")
    )
    match = F.when(F.col("earlier") < F.col("first"), F.col("earlier"))
    match = F.coalesce(match, F.when(~original, F.col("first")))
    return joined.select(
        "row",
        F.col("id").alias(id_col),
        "line_no",
        match.isNull().alias("kept"),
        match["id"].alias("match_id"),
        match["line_no"].alias("match_line"),
        F.col("lines").alias("n_lines"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    jaccard: float = MIN_JACCARD,
    crowd: int = CROWD,
) -> DataFrame:
    """:func:`match_lines` without the row numbers."""
    return match_lines(docs, id_col, text_col, jaccard, crowd).drop("row")
