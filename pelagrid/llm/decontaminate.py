"""Benchmark decontamination by canonical templates, in SQL functions only.

Texts and benchmark items become lower-cased word sequences in which numbers (digits or words) and
units are typed placeholders. In a second form names are placeholders too: runs of words with a
capital, wherever they stand, so also at the beginning of a sentence, after a quote, a bracket or a line
break. Windows of ``WIDTH`` such words are hashed and joined with those of
the benchmark. An item counts as found in a text if enough of its different windows are
there with the item's own values, or with values that agree: each value of the item stands for one
value of the text and the other way round. Values are compared place by place: windows with slots that
stand as far from each other as in the item are one occurrence, and from each occurrence
on those that agree with it are added, nearest first. So exact copies, copies in other letter case and
re-parameterised questions are found, also beside variants of the same question, while a
chance likeness of templates with clashing values is not.

A sequence shorter than a window is one window of its own, found in texts that are no longer.
It has placeholders only if ``LITERALS`` of its words are literal.

The join works on 8-byte hashes, each made from hashes of the words. A first pass over all texts
brings nothing but hashes and places; the words of windows are made in a second pass over the texts that share
enough windows with an item. The benchmark's windows and the identities of those texts are broadcast while
their counted number is bounded and shuffled beyond. Verdicts are
kept by text identity, so copies of a text are matched once in each task.

Defined results: null and empty texts, and texts without words, are clean; items without words or
without a window of two literal words (and longer than a window) cannot be
found; repeated item ids are one item with the windows of all its rows. Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import matched, written

WIDTH = 5  # words of a window
LITERALS = 2  # words of a window that must not be placeholders
COVERAGE = 0.8  # share of an item's windows that makes it found
PASSAGE_WINDOWS = 46  # or this many of them, 50 words: a long passage of a longer item

# Placeholders are control characters; values are kept beside them.
NUMBER, NAME, UNIT, END = "\x01", "\x02", "\x03", "\x04"
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "billion dozen"
).split()
# Units wherever they stand, and those that are units after a number only.
UNITS = (
    "percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres centimeter "
    "centimeters centimetre centimetres millimeter millimeters millimetre millimetres mile miles yard yards foot "
    "feet inch inches gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds liter liters "
    "litre litres milliliter milliliters millilitre millilitres gallon gallons second seconds minute minutes hour "
    "hours day days week weeks month months year years cent cents dollar dollars euro euros mph watt watts volt "
    "volts hertz $ € £ % ° °c °f"
).split()
SHORT_UNITS = (
    "m km cm mm g kg mg t l ml lb lbs oz ft yd s sec secs ms min mins h hr hrs w kw mw wh kwh mwh v kv hz khz mhz "
    "ghz kb mb gb tb k c f"
).split()


def _prefix_tree(words: list[str]) -> str:
    """A pattern of the words in which common beginnings are read once."""
    by_first: dict[str, list[str]] = {}
    for w in filter(None, words):
        by_first.setdefault(w[0], []).append(w[1:])
    tree = "|".join(c + _prefix_tree(rest) for c, rest in sorted(by_first.items()))
    return tree and f"(?:{tree})" + "?" * ("" in words)


_LETTER = r"[\p{L}\p{M}\p{N}]"
_NUMBER_WORD = rf"{_prefix_tree(NUMBER_WORDS)}(?!{_LETTER})"
_NUMBER_BEGINS = "".join(sorted({w[0] for w in NUMBER_WORDS}))
_NAME = rf"\p{{Lu}}{_LETTER}*+"


def _token(names: bool) -> str:
    """Pattern of a token; without ``names`` of a lower-cased text.

    Repeated groups are possessive: they run in a loop, however long a run is. Looking at the first
    character spares most places the slower alternatives.
    """
    begins = _NUMBER_BEGINS + _NUMBER_BEGINS.upper() * names
    numbers = rf"(?{'i' * names}:{_NUMBER_WORD}(?:[ -]{_NUMBER_WORD})++)"
    return (
        rf"[a-z&&[^{_NUMBER_BEGINS}]]{_LETTER}*+"
        rf"|(?=[\p{{L}}\p{{M}}\p{{N}}$€£%°])(?:\d++(?:[.,:/]\d++)*+|[$€£](?=\d)|(?=[%°])(?<=\d ?)(?:%|°[CFcf]?)"
        rf"|(?=[{begins}]){numbers}|{_NAME}(?: {_NAME})*+|{_LETTER}++)"
    )


def tokens(text: Column, names: bool) -> Column:
    """Words of a text; numbers in several words and, with ``names``, runs of names are one."""
    return F.regexp_extract_all(text if names else F.lower(text), F.lit(_token(names)), F.lit(0))


def _is_digits(word: Column) -> Column:
    return (word >= "0") & (word < ":")


def typed(words: Column, names: bool) -> Column:
    """The words lower-cased, with placeholders instead of numbers, units and words with a capital.

    Without ``names`` the words are lower-cased already.
    """

    def of(word, i):
        low = F.lower(word) if names else word
        last = F.substring_index(F.substring_index(low, " ", -1), "-", -1)
        after_number = _is_digits(F.coalesce(F.get(words, i - 1), F.lit("")))
        other = F.when(low != word, NAME).otherwise(word) if names else word
        listed = (
            F.when(last.isin(NUMBER_WORDS), NUMBER)
            .when(low.isin(UNITS) | (low.isin(SHORT_UNITS) & after_number), UNIT)
            .otherwise(other)
        )
        # Most words are in no list.
        several = word.contains(" ") | word.contains("-")
        return (
            F.when(_is_digits(word), NUMBER)
            .when(low.isin(NUMBER_WORDS + UNITS + SHORT_UNITS) | several, listed)
            .otherwise(other)
        )

    made = F.transform(words, of)
    literal = F.size(F.filter(made, lambda x: x >= END))
    short = (F.size(words) < WIDTH) & (literal < LITERALS)
    return F.when(short, F.transform(words, F.lower)).otherwise(made)


def _listed(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, form, words and types of column ``text`` in both forms.

    Form 0 has names as words, form 1 as placeholders; a text without capitals has form 0 only.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = texts.select(*keys, text.alias("text"))
    forms = F.when(F.col("text") != F.lower("text"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    of_form = lambda make: F.when(F.col("form") == 0, make(False)).otherwise(make(True))
    return (
        plain.select(*keys, "text", F.explode(forms).alias("form"))
        .withColumn("words", of_form(lambda names: tokens(F.col("text"), names)))
        .select(*keys, "form", "words", of_form(lambda names: typed(F.col("words"), names)).alias("types"))
    )


def _each_window(make) -> Column:
    """``make(h, place)`` for each window, from column ``word_hashes``; one that is shorter has nulls at its end."""
    begins = F.slice("word_hashes", 1, F.greatest(F.size("word_hashes") - WIDTH + 1, F.lit(1)))
    more = lambda i: (F.get("word_hashes", i + k) for k in range(1, WIDTH))
    return F.transform(begins, lambda first, i: make(F.xxhash64(first, *more(i)), i + 1))


def window_hashes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """One row (keys, form, h) for every window of column ``text`` in both forms; h is null for one without words."""
    word_hashes = F.transform("types", lambda x: F.xxhash64(x))
    hashed = _listed(texts, keys).select(*keys, "form", word_hashes.alias("word_hashes"))
    # The outer form: the other one evaluates the hashes twice, once to filter empty lists.
    some = F.explode_outer(F.when(F.size("word_hashes") > 0, _each_window(lambda h, _: h))).alias("h")
    return hashed.select(*keys, "form", some)


def windows(texts: DataFrame, keys: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """``window_hashes`` with place, words and types of each window, or of those whose ``h`` is in ``wanted``.

    Words are written first and cut at the places that are asked for: a plan must neither make them again for
    each window nor carry those of the whole text along.
    """
    word_hashes = F.transform("types", lambda x: F.xxhash64(x)).alias("word_hashes")
    row = F.monotonically_increasing_id().alias("row")
    listed = written(_listed(texts, keys).select("*", word_hashes, row), "words")
    each = _each_window(lambda h, place: F.struct(h.alias("h"), place.alias("place")))
    found = listed.select("row", F.explode_outer(each).alias("at")).select("row", "at.*").where("h is not null")
    if wanted is not None:
        found = matched(found, wanted, ["h"])
    places = found.groupBy("row").agg(F.collect_list(F.struct("h", "place")).alias("places"))
    cut = lambda c, at: F.slice(c, at["place"], WIDTH).alias(c)
    window = F.transform(
        "places",
        lambda at: F.struct(at["h"].alias("h"), at["place"].cast("long").alias("place"), cut("words", at), cut("types", at)),
    )
    joined = listed.drop("word_hashes").join(places, "row")
    return joined.select(*keys, "form", F.explode_outer(window).alias("window")).select(*keys, "form", "window.*")


def _slots() -> Column:
    """The values of a window's placeholders, null if it has none."""
    both = F.filter(F.arrays_zip("words", "types"), lambda w: w["types"] < END)
    return F.when(F.size(both) > 0, F.transform(both, lambda w: F.lower(w["words"])))


def _identity(text: str = "text") -> list[Column]:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(whole).alias("text_a"), F.xxhash64(F.lit(7), whole).alias("text_b")]


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, form, h, slots, place and n, the item's different windows.

    Places of different texts with the same item id are far apart. Windows of too few literal words are left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.shiftleft(F.xxhash64(text).bitwiseAND((1 << 31) - 1), 31)
    made = windows(benchmark.where("item_id is not null").select("item_id", "text", own.alias("own")), ["item_id", "own"])
    literal = F.size(F.filter("types", lambda x: x >= END))
    each = (
        made.where((literal >= LITERALS) | (F.size("types") < WIDTH))
        .withColumn("slots", _slots())
        .select("item_id", "form", "h", "slots", F.when(F.col("slots").isNotNull(), F.col("own") + F.col("place")).alias("place"))
        .distinct()
    )
    sizes = each.groupBy("item_id", "form").agg(F.countDistinct("h").alias("n"))
    return written(each.join(sizes, ["item_id", "form"]), "item-windows")


def _most_agreeing(groups: str) -> Column:
    """The most different windows of occurrences (offset, hs, values) that agree with one of them."""
    clash = lambda s, g: F.exists(
        g["values"],
        lambda v: F.exists(s["values"], lambda m: (v["item"] == m["item"]) != (v["own"] == m["own"])),
    )

    def grown(seed):
        by_distance = F.array_sort(
            F.transform(
                groups,
                lambda g: F.struct(
                    F.abs(g["offset"] - seed["offset"]).alias("far"), g["offset"], g["hs"].alias("hs"), g["values"].alias("values")
                ),
            )
        )
        return F.aggregate(
            by_distance,
            F.struct(seed["values"].alias("values"), seed["hs"].alias("hs")),
            lambda s, g: F.when(clash(s, g), s).otherwise(
                F.struct(
                    F.array_union(s["values"], g["values"]).alias("values"), F.array_union(s["hs"], g["hs"]).alias("hs")
                )
            ),
            lambda s: F.size(s["hs"]),
        )

    return F.coalesce(F.array_max(F.transform(groups, grown)), F.lit(0))


def _enough(shared: Column) -> Column:
    return (shared >= COVERAGE * F.col("n")) | (shared >= PASSAGE_WINDOWS)


def sharing(texts: DataFrame, items: DataFrame) -> DataFrame:
    """text_a, text_b of the texts that share enough different windows with an item, whatever the values."""
    own = window_hashes(texts, ["text_a", "text_b"])
    # A single number as the key is found much faster than two columns; the forms are told apart afterwards.
    shared = matched(own, items.select("h").distinct(), ["h"]).distinct()
    return written(
        shared.join(items.select("item_id", "form", "h", "n").distinct(), ["form", "h"])
        .groupBy("text_a", "text_b", "item_id", "form")
        .agg(F.count("*").alias("shared"), F.max("n").alias("n"))
        .where(_enough(F.col("shared")))
        .select("text_a", "text_b")
        .distinct(),
        "sharing",
    )


def found_items(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """text_a, text_b, item_id, coverage, changed: the items found in each different text."""
    items = item_windows(benchmark)
    texts = documents.select(*_identity(), "text")
    identity = ["text_a", "text_b"]
    own = windows(matched(texts, sharing(texts, items), identity), identity, items.select("h").distinct())
    shared = own.withColumn("own_slots", _slots())
    # One row for each text and window without slots, and for each place of one with slots,
    # whatever the number of copies.
    place = F.when(F.col("own_slots").isNotNull(), F.col("place"))
    first = written(
        shared.select("text_a", "text_b", "form", "h", "own_slots", place.alias("own_place")).distinct(), "shared-windows"
    )
    same = F.coalesce(F.col("slots") == F.col("own_slots"), F.lit(True))
    pairs = first.join(items, ["form", "h"]).select(
        "text_a", "text_b", "item_id", "form", "n", "h", same.alias("same"),
        (F.col("own_place") - F.col("place")).alias("offset"),
        F.arrays_zip(F.col("slots").alias("item"), F.col("own_slots").alias("own")).alias("values"),
    )
    # Windows without slots have no offset and agree with everything.
    occurrences = pairs.groupBy("text_a", "text_b", "item_id", "form", "offset").agg(
        F.max("n").alias("n"),
        F.collect_set("h").alias("hs"),
        F.collect_set(F.when(F.col("same"), F.col("h"))).alias("same"),
        F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"),
    )
    different = lambda side: F.size(F.array_distinct(F.transform("values", lambda v: v[side])))
    agrees = (F.size("values") == different("item")) & (F.size("values") == different("own"))
    slotted = F.col("offset").isNotNull()
    grouped = occurrences.groupBy("text_a", "text_b", "item_id", "form").agg(
        F.max("n").alias("n"),
        F.size(F.array_distinct(F.flatten(F.collect_list("hs")))).alias("shared"),
        F.size(F.array_distinct(F.flatten(F.collect_list("same")))).alias("same"),
        F.coalesce(F.max(F.when(~slotted, F.size("hs"))), F.lit(0)).alias("literal"),
        F.collect_list(F.when(slotted & agrees, F.struct("offset", "hs", "values"))).alias("groups"),
    )
    # One occurrence that is enough by itself ends the search.
    alone = lambda g: _enough(F.col("literal") + F.size(g["hs"]))
    return (
        grouped.where(_enough(F.col("shared")))
        .where(
            F.when(_enough(F.col("same")) | F.exists("groups", alone), True).otherwise(
                _enough(F.col("literal") + _most_agreeing("groups"))
            )
        )
        .withColumn("changed", F.col("shared") > F.col("same"))
        .groupBy("text_a", "text_b", "item_id")
        .agg(F.max(F.col("shared") / F.col("n")).alias("coverage"), F.max("changed").alias("changed"))
    )


def mark(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids, coverage, changed for every row."""
    verdicts = found_items(documents, benchmark).groupBy("text_a", "text_b").agg(
        F.count("*").alias("n_items"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.max("coverage").alias("coverage"),
        F.max("changed").alias("changed"),
    )
    rows = documents.select("doc_id", *_identity())
    return rows.join(verdicts, ["text_a", "text_b"], "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("changed", F.lit(False)).alias("changed"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` in which no item is found, with all their columns."""
    guilty = written(found_items(documents, benchmark).select("text_a", "text_b").distinct(), "guilty")
    # Names that no column of the caller has.
    a, b = (f"_decontaminate_{x}" for x in ("a", "b"))
    keyed = documents.withColumns(dict(zip((a, b), _identity(), strict=True)))
    return matched(keyed, guilty.toDF(a, b), [a, b], "left_anti").drop(a, b)
