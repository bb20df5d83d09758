"""Addresses as people type them: a lookup that forgives misspellings.

Every three neighbouring letters of a gazetteer's address are a key to it. An
edit changes three of them at most, so an address within ``e`` edits has one of
any ``3 e + 1`` keys of the text; the rarest are looked up. Only what they find
is compared letter by letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.operators.joins import lookup_join
from curbside.scratch import stored

GRAM = 3
# One edit for so many letters.
LETTERS_PER_EDIT = 4
MOST_EDITS = 3


def plain_address(address: Column) -> Column:
    """Lower case letters and digits, with one blank between words."""
    return F.trim(F.regexp_replace(F.lower(address), r"[^\p{L}\p{N}]+", " "))


def allowed_edits(plain: Column, most: int = MOST_EDITS) -> Column:
    """How many edits a text of this length may differ by."""
    return F.least(F.lit(most), F.floor(F.length(plain) / LETTERS_PER_EDIT).cast("int"))


def _grams(plain: str) -> Column:
    """Runs of three letters, with a sign in front and behind, each with its number.

    A run that occurs twice is two keys, so that an edit always costs three.
    """
    text = f"concat('^', {plain}, '$')"
    runs = f"transform(sequence(1, length({text}) - {GRAM - 1}), i -> substring({text}, i, {GRAM}))"
    numbered = f"""transform({runs}, (g, i) ->
      concat(g, size(filter(slice({runs}, 1, i), h -> h = g))))"""
    return F.expr(f"CASE WHEN length({plain}) > 0 THEN {numbered} ELSE array() END")


def _closest(texts: DataFrame, places: DataFrame, most: int) -> DataFrame:
    """``(plain, __at, edits)`` of the closest place of each text that has any."""
    keys = stored(
        places.select("plain", F.explode(_grams("plain")).alias("gram")), "address-grams"
    )
    frequency = keys.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    asked = texts.withColumn("edits", allowed_edits(F.col("plain"), most)).where("edits > 0")
    asked = asked.select("plain", "edits", F.explode(_grams("plain")).alias("gram"))
    known = asked.join(frequency, "gram", "left")
    # Keys that no address has are the rarest of all.
    rarest = F.array_sort(
        F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))
    )
    chosen = known.groupBy("plain", "edits").agg(rarest.alias("keys"))
    chosen = chosen.select(
        F.col("plain").alias("text"), "edits",
        F.explode(F.slice("keys", 1, (GRAM * F.col("edits") + 1).cast("int"))["gram"]).alias("gram"),
    )
    pairs = chosen.join(keys, "gram").select("text", "edits", "plain").distinct()
    near = pairs.where(F.abs(F.length("text") - F.length("plain")) <= F.col("edits"))
    near = near.withColumn("distance", F.levenshtein("text", "plain")).where("distance <= edits")
    best = near.groupBy("text").agg(F.min(F.struct("distance", "plain")).alias("best"))
    return best.select(F.col("text").alias("plain"), "best.distance", F.col("best.plain").alias("found"))


def locate_text(
    requests: DataFrame, gazetteer: DataFrame, most_edits: int = MOST_EDITS
) -> DataFrame:
    """Add ``lat``, ``lon``, ``found_address`` and ``edits`` by each ``address`` as typed.

    Case, signs and repeated blanks do not count. A text that no address equals
    takes the closest one within one edit for every four of its letters, and
    ``most_edits`` at most; of equally close ones the alphabetically first, and
    of the positions of one address the smallest. ``edits`` is 0 for equal
    texts. Without an address close enough the four columns are NULL, and every
    request keeps its row. Equal texts are looked up once.
    """
    places = (
        gazetteer.withColumn("plain", plain_address(F.col("address")))
        .where("plain <> ''")
        .groupBy("plain")
        .agg(F.min(F.struct("lat", "lon", "address")).alias("at"))
    )
    places = stored(places, "addresses")
    asked = requests.withColumn("__plain", plain_address(F.col("address")))
    texts = asked.select(F.col("__plain").alias("plain")).where("plain <> ''").distinct()
    exact = texts.join(places.select("plain"), "plain", "left_semi")
    other = stored(texts.join(places.select("plain"), "plain", "left_anti"), "texts")
    close = _closest(other, places, most_edits)
    both = exact.select("plain", F.lit(0).alias("distance"), F.col("plain").alias("found"))
    both = both.unionByName(close)
    answers = both.join(places.withColumnRenamed("plain", "found"), "found").select(
        F.col("plain").alias("__plain"),
        F.col("at.lat").alias("lat"),
        F.col("at.lon").alias("lon"),
        F.col("at.address").alias("found_address"),
        F.col("distance").alias("edits"),
    )
    return lookup_join(asked, answers, "__plain", "left").drop("__plain")
