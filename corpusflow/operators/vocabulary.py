"""Domain vocabularies: building them (A12), the best match of a phrase in one (M7)
and correcting texts with them (T19).

Matching is a similarity join.  With similarity ``200 * LCS / (len + len)`` of at
least ``t``, the lengths of a phrase and its match differ by a bounded factor and at
most ``D`` insertions and deletions part them, each of which touches two bigrams and
three trigrams.  Hence they share one of their ``3 * D + 1`` rarest trigrams or, where one
of them is too short for that promise, of their ``2 * D + 1`` rarest bigrams; only pairs that
do are compared.  Still shorter strings meet by their lengths.  Nothing is compared all
with all, and only distinct phrases take part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.metrics import similarity_py
from corpusflow.functions.text import words

# Fragments that mark a likely misspelling of a menu item.
MISSPELT = ("tubul", "tabul", "tabool", "tabboul", "falaf", "fellaf", "felaf", "humm", "homm", "hum", "colslaw", "colesla")
# Words that a direct correction leaves as they are.
PRESERVED = ("a", "an", "the", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
# Words that are never taken for a misspelling.
COMMON = ("the", "and", "with", "for", "can", "want", "need", "have", "one", "two", "three", "a", "an", "no", "yes", "is", "it")
PUNCTUATION = r"[.,!?;:]+$"
PHRASE_SCORE, WORD_SCORE = 90.0, 85.0


# --- M7: best match in a list ------------------------------------------------

def _grams(name: str, q: int) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.length(name) - (q - 1), F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(F.col(name), i, F.lit(q))))


def _keys(strings: DataFrame, name: str, threshold: float, frequency: DataFrame, asks: bool) -> DataFrame:
    """Keys by which a string can meet a partner: its rarest trigrams, if it is ``long``
    enough for them to tell; its rarest bigrams; and lengths, if it is short."""
    size = F.length(name)
    low, high = F.ceil(size * threshold / (200.0 - threshold)), F.floor(size * (200.0 - threshold) / threshold)
    apart = F.floor((100.0 - threshold) / 100.0 * (size + high) + 1e-9)
    rows = strings.select(name, apart.alias("apart"), low.alias("low"), high.alias("high"), _grams(name, 2).alias("g2"), _grams(name, 3).alias("g3"))
    rows = rows.withColumn("long", (F.size("g3") > 3 * F.col("apart")) & (F.length(name) > 2))
    each = F.array(F.struct(F.lit(2).alias("q"), F.col("g2").alias("grams")),
                   F.struct(F.lit(3).alias("q"), F.when(F.col("long"), F.col("g3")).otherwise(F.array().cast("array<string>")).alias("grams")))
    rarest = (rows.select(name, "apart", "long", F.inline(each)).select(name, "apart", "long", "q", F.explode("grams").alias("gram")).join(frequency, "gram", "left")
                  .withColumn("place", F.row_number().over(Window.partitionBy(name, "q").orderBy(F.coalesce("often", F.lit(0)), "gram")))
                  .filter(F.col("place") <= F.col("q") * F.col("apart") + 1).select(name, "long", F.concat(F.col("q").cast("string"), F.lit(":"), F.col("gram")).alias("key")))
    short = rows.filter(F.size("g2") <= 2 * F.col("apart"))
    lengths = F.explode(F.sequence("low", "high")) if asks else F.length(name)
    return rarest.unionByName(short.select(name, "long", lengths.alias("n")).select(name, "long", F.concat(F.lit("n"), F.col("n").cast("string")).alias("key")))


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity_py(x, y) for x, y in zip(a, b)], dtype="float64")


def candidate_pairs(phrases: DataFrame, choices: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (``phrase``, ``choice``) among which are all with a similarity of
    ``threshold`` or more; empty strings meet nothing."""
    if not 0 < threshold <= 100:
        raise ValueError(f"threshold {threshold}")
    p = phrases.select("phrase").filter("phrase <> ''").distinct()
    c = choices.select("choice").filter("choice <> ''").distinct()
    often = c.select(F.explode(F.concat(_grams("choice", 2), _grams("choice", 3))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    ask, have = _keys(p, "phrase", threshold, often, True), _keys(c, "choice", threshold, often, False)
    told = ask["key"].startswith("3") | ~(ask["long"] & have["long"])           # two long strings meet by trigrams only
    met = ask.join(have, (ask["key"] == have["key"]) & told).select("phrase", "choice")
    shorter, longer = F.least(F.length("phrase"), F.length("choice")), F.greatest(F.length("phrase"), F.length("choice"))
    return met.filter(200.0 * shorter >= threshold * (shorter + longer)).select("phrase", "choice").distinct()


def best_matches(phrases: DataFrame, choices: DataFrame, threshold: float) -> DataFrame:
    """M7: for each distinct ``phrase`` that has one, the most similar of ``choices``
    (``choice``, ``rank``; of equals the lowest rank) with ``threshold`` or more:
    ``phrase``, ``choice``, ``score``."""
    scored = candidate_pairs(phrases, choices, threshold).withColumn("score", _ratio.asNondeterministic()("phrase", "choice"))
    ranked = scored.filter(F.col("score") >= threshold).join(choices.groupBy("choice").agg(F.min("rank").alias("rank")), "choice")
    return (ranked.groupBy("phrase").agg(F.max_by(F.struct("choice", "score"), F.struct("score", -F.col("rank"))).alias("m"))
                  .select("phrase", "m.choice", "m.score"))


# --- T19: correction ---------------------------------------------------------

def _plural(a: Column, b: Column) -> Column:
    """The one is the other with or without an s."""
    return (F.abs(F.length(a) - F.length(b)) == 1) & (a.endswith("s") | b.endswith("s"))


def _like_original(text: Column, corrected: Column) -> Column:
    capital = F.concat(F.upper(F.substring(corrected, 1, 1)), F.lower(F.expr("substring(_new, 2)")))
    first = F.substring(text, 1, 1)
    return (F.when((F.upper(text) == text) & (F.lower(text) != text), F.upper(corrected))
             .when((F.upper(first) == first) & (F.lower(first) != first), capital).otherwise(corrected))


def correct_vocabulary(df: DataFrame, key: str, items: DataFrame, corrections: Mapping[str, str], text: str = "text",
                       out: str = "text_corrected", context_window: int = 3, misspelt: Sequence[str] = MISSPELT) -> DataFrame:
    """``df`` (with a unique ``key``) with ``out``, ``menu_corrections`` (array of
    ``original``, ``corrected``, ``type``, ``score``) and ``num_corrections`` (both null
    without one).  ``items``: ``item`` and ``rank``, the vocabulary; ``corrections``: a
    small configured map of misspellings.

    What can happen at a word depends on the words from there on alone: a direct
    correction; else, of the windows of ``context_window`` words down to one, the first
    that is a known misspelling or is close to an item of several words; else a close
    item of one word.  So all places are looked at together, the distinct phrases are
    matched by a similarity join, and a short pass over the few places where something
    happens drops those inside an earlier one.  As in the rule, the word behind a
    corrected window is passed over and lost.  Null and empty texts stay as they are."""
    known = list(corrections)
    if known:
        table = F.create_map(*[F.lit(x) for kv in corrections.items() for x in kv])
    likely_list = "|".join(f"\\Q{m}\\E" for m in misspelt)

    def direct(phrase: Column) -> Column:
        return phrase.isin(known) if known else F.lit(False)

    def fixed(phrase: Column) -> Column:
        return F.try_element_at(table, phrase) if known else F.lit(None).cast("string")

    def likely(phrase: Column) -> Column:
        return (phrase.rlike(likely_list) if likely_list else F.lit(False)) | direct(phrase)

    placed = df.select(F.col(key).alias("_k"), words(F.lower(F.col(text))).alias("x")).select("_k", "x", F.posexplode_outer("x").alias("i", "word"))
    windows = F.array(*[F.struct(F.lit(n).alias("n"), F.regexp_replace(F.concat_ws(" ", *[F.get("x", F.col("i") + j) for j in range(n)]), PUNCTUATION, "").alias("phrase"))
                        for n in range(1, context_window + 1)])
    found = (placed.select("_k", "i", "word", F.size("x").alias("size"), F.inline(windows))
                   .filter((F.col("i") + F.col("n") <= F.col("size")) & likely(F.col("phrase"))))
    several = F.size(words(F.col("item"))) > 1
    one = F.size(words(F.col("item"))) == 1
    choice = items.select(F.col("item").alias("choice"), "rank", several.alias("several"), one.alias("one"))
    phrases = found.select("phrase", "n")
    by_phrase = best_matches(phrases, choice.filter("several"), PHRASE_SCORE).toDF("phrase", "near", "near_score")
    by_word = best_matches(phrases.filter("n = 1 AND length(phrase) > 3"), choice.filter("one"), WORD_SCORE).toDF("phrase", "word_near", "word_score")
    asked = found.join(by_phrase, "phrase", "left").join(by_word, "phrase", "left")
    phrase, fix = F.col("phrase"), fixed(F.col("phrase"))
    mark = F.regexp_extract("word", PUNCTUATION, 0)
    single = (F.col("n") == 1) & direct(phrase) & ~phrase.isin(list(PRESERVED)) & ~_plural(phrase, fix)
    inner = F.col("i") < F.col("size") - 1
    plural = F.when(F.abs(F.length(phrase) - F.length("word_near")) == 1,
                    (phrase == F.concat(F.col("word_near"), F.lit("s"))) | (F.col("word_near") == F.concat(phrase, F.lit("s")))).otherwise(F.lit(False))
    word_ok = (F.col("n") == 1) & F.col("word_near").isNotNull() & ~plural & ~phrase.isin(list(COMMON))
    step = F.col("n") + 1                              # the window, and the word that is passed over

    def action(order, advance: Column, new: Column, corrected: Column, kind: str, score: Column) -> Column:
        return F.struct(order.cast("int").alias("order"), F.col("i"), advance.cast("int").alias("advance"), new.alias("new"), phrase.alias("original"),
                        corrected.alias("corrected"), F.lit(kind).alias("type"), score.cast("double").alias("score"))

    window = F.lit(context_window + 1) - F.col("n")    # larger windows first, after a direct word
    hundred = F.lit(100.0)
    chosen = (F.when(single, action(F.lit(0), F.lit(1), F.concat(fix, mark), fix, "direct", hundred))
               .when(inner & direct(phrase), action(window, step, fix, fix, "direct_phrase", hundred))
               .when(inner & F.col("near").isNotNull(), action(window, step, F.col("near"), F.col("near"), "fuzzy_phrase", F.col("near_score")))
               .when(word_ok, action(F.lit(context_window + 1), F.lit(1), F.concat(F.col("word_near"), mark), F.col("word_near"), "fuzzy_word", F.col("word_score"))))
    acts = (asked.select("_k", chosen.alias("a")).filter("a IS NOT NULL")
                 .groupBy("_k", F.col("a.i").alias("i")).agg(F.min_by("a", "a.order").alias("a"))
                 .groupBy("_k").agg(F.array_sort(F.collect_list(F.struct("i", "a"))).alias("acts")))
    kind = acts.schema["acts"].dataType.simpleString()

    def keep(acc: Column, x: Column) -> Column:
        free = x["i"] >= acc["free"]
        return F.struct(F.when(free, x["i"] + x["a"]["advance"]).otherwise(acc["free"]).alias("free"),
                        F.when(free, F.concat(acc["kept"], F.array(x))).otherwise(acc["kept"]).alias("kept"))

    start = F.struct(F.lit(0).alias("free"), F.array().cast(kind).alias("kept"))
    acts = acts.select("_k", F.aggregate("acts", start, keep)["kept"].alias("_acts"))
    rows = df.drop(out, "menu_corrections", "num_corrections").join(acts, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
    rows = rows.withColumn("_words", words(F.lower(F.col(text))))

    def stretch(k: Column) -> Column:
        """Words up to the k-th place where something happens, and what comes in there."""
        begin = F.when(k == 0, F.lit(0)).otherwise(F.get("_acts", k - 1)["i"] + F.get("_acts", k - 1)["a"]["advance"])
        stop = F.when(k == F.size("_acts"), F.size("_words")).otherwise(F.get("_acts", k)["i"])
        kept = F.slice("_words", begin + 1, F.greatest(stop - begin, F.lit(0)))
        return F.when(k == F.size("_acts"), kept).otherwise(F.concat(kept, F.array(F.get("_acts", k)["a"]["new"])))

    joined = F.when(F.col("_acts").isNull(), F.array_join("_words", " ")).otherwise(
        F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("_acts")), stretch)), " "))
    rows = rows.withColumn("_new", joined)
    result = F.when(F.coalesce(F.length(text) == 0, F.lit(True)), F.col(text)).otherwise(_like_original(F.col(text), F.col("_new")))
    return (rows.withColumn(out, result)
                .withColumn("menu_corrections", F.transform("_acts", lambda x: F.struct(*[x["a"][c].alias(c) for c in ("original", "corrected", "type", "score")])))
                .withColumn("num_corrections", F.when(F.col("_acts").isNotNull(), F.size("_acts")))
                .drop("_acts", "_words", "_new"))


# --- A12: vocabulary from nested menus ---------------------------------------

# Categories in the order in which their keywords are tried.
CATEGORIES = {
    "chicken_items": ("chicken", "breast", "leg", "wings"),
    "sauces": ("sauce", "garlic", "chilli", "mayo", "tahini", "bbq"),
    "sides": ("chips", "tabouli", "coleslaw", "pickles", "bread", "fattoush", "salad"),
    "drinks": ("pepsi", "water", "lipton", "sunkist", "mountain dew", "7 up", "juice", "red bull"),
    "rolls_burgers": ("roll", "burger", "falafel"),
}
SIZES = ("small", "medium", "large", "jumbo")


def menu_vocabulary(menu: DataFrame, categories: Mapping[str, Sequence[str]] = CATEGORIES, sizes: Sequence[str] = SIZES,
                    option_category: tuple[str, str] = ("sauces", "sauce")) -> DataFrame:
    """From menu items (``name``, ``option_groups``: array of struct with ``options``,
    array of struct with ``name``) one row for each entry of the vocabulary:
    ``category`` and ``term``, lower case, distinct.  An item is of the first category one of
    whose keywords it contains; all names, names without their size and names of options
    are in ``all_items``; options with the second part of ``option_category`` are in its
    first.  A missing name counts as an empty one."""
    def holds(name: Column, keywords: Sequence[str]) -> Column:
        return name.rlike("|".join(f"\\Q{k}\\E" for k in keywords))

    name = F.lower(F.coalesce("name", F.lit("")))
    rows = menu.select(name.alias("name"), "option_groups")
    kind = F.lit(None).cast("string")
    for category, keywords in reversed(list(categories.items())):
        kind = F.when(holds(F.col("name"), keywords), F.lit(category)).otherwise(kind)
    base = F.col("name")
    for size in sizes:
        base = F.replace(base, F.lit(size + " "), F.lit(""))
    whole = rows.select(F.explode(F.array(F.struct(kind.alias("category"), F.col("name").alias("term")),
                                          F.struct(F.lit("all_items").alias("category"), F.col("name").alias("term")))).alias("e"))
    sized = rows.filter(holds(F.col("name"), sizes)).select(F.struct(F.lit("all_items").alias("category"), F.trim(base).alias("term")).alias("e")).filter("e.term <> ''")
    options = F.flatten(F.transform("option_groups", lambda g: F.coalesce(g["options"]["name"], F.array().cast("array<string>"))))
    named = rows.select(F.explode(options).alias("o")).select(F.lower("o").alias("o")).filter("o <> ''")
    listed = named.select(F.explode(F.array(F.struct(F.lit("all_items").alias("category"), F.col("o").alias("term")),
                                            F.struct(F.when(F.contains("o", F.lit(option_category[1])), F.lit(option_category[0])).alias("category"),
                                                     F.col("o").alias("term")))).alias("e"))
    return whole.unionByName(sized).unionByName(listed).select("e.category", "e.term").filter("category IS NOT NULL").distinct()
