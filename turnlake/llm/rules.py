"""Quality rules by distribution divergence, in DataFrame functions alone.

A document's character-class shares and the shares of its language's most common words are two histograms. Each is compared with the
language's reference by Jensen-Shannon distance (base 2, between 0 and 1). Symbol-laden, upper-cased and tabular texts are far from any
prose in the first; texts without function words, or with little else, in the second. Small histograms are noisy, so each has a minimum
length below which it gives no verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.llm.common import SPACE

#: Shares of upper case, digits, symbols, other ASCII punctuation, white space and the rest, in prose.
CHAR_REFERENCE = {
    "en": (0.025, 0.010, 0.001, 0.030, 0.165, 0.769),
    "fr": (0.025, 0.010, 0.001, 0.032, 0.162, 0.770),
    "de": (0.035, 0.010, 0.001, 0.028, 0.145, 0.781),
    "es": (0.025, 0.010, 0.001, 0.028, 0.162, 0.774),
}
#: The most common words of each language, in falling order.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "las", "del", "un", "por"),
}
#: Zipf's rule for their reference shares: the k-th word has this share divided by k.
TOP_SHARE = 0.06
#: Largest distances of prose, and the words below which a histogram gives no verdict.
MAX_CHAR_DISTANCE, MIN_CHAR_WORDS = 0.2, 50
MAX_WORD_DISTANCE, MIN_WORD_WORDS = 0.27, 100
#: The base rule's bounds.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: A sort key holds a window's hash above its position; longer texts compare their windows in full.
_POSITION_BITS = 24


def js_distance(shares: list[Column], reference: list[Column]) -> Column:
    """Jensen-Shannon distance of two histograms of non-negative shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(F.lit(2.0) * a / (a + b))).otherwise(F.lit(0.0))

    terms = [part(p, q) + part(q, p) for p, q in zip(shares, reference, strict=True)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _covered(positions: Column) -> Column:
    """How many words the 3-word windows at these sorted positions cover."""
    steps = F.transform(positions, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _repeated(rows: Column, key) -> Column:
    """The elements of a sorted array whose key equals a neighbour's."""
    return F.filter(
        rows, lambda x, i: F.coalesce(key(x) == key(F.get(rows, i - 1)), F.lit(False)) | F.coalesce(key(x) == key(F.get(rows, i + 1)), F.lit(False))
    )


def _settled(c: Column) -> Column:
    """The same column, but filters on it stay above it: the optimizer would copy its whole derivation into a filter that it pushes down."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long) and the helper columns ``_norm`` and ``_text``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.withColumn("_text", text)
    df = df.withColumn("_norm", F.trim(F.regexp_replace("_text", f"[{SPACE}]+", " ")))
    df = df.withColumn("_words", F.when(F.col("_norm") == "", F.array().cast("array<string>")).otherwise(F.split("_norm", " ", -1)))
    n = F.size("_words").cast("long")
    df = df.withColumn("n_words", n)
    df = df.withColumn("word_chars", F.length("_norm") - F.greatest(F.col("n_words") - 1, F.lit(0)))
    df = df.withColumn("n_symbols", F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long"))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))

    word = lambda i: F.get("_words", i)
    last = F.size("_words") - 3
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    keyed = F.transform(
        starts, lambda i: F.shiftleft(F.xxhash64(word(i), word(i + 1), word(i + 2)), _POSITION_BITS).bitwiseOR(i.cast("long"))
    )
    df = df.withColumn("_keys", F.when(last < (1 << _POSITION_BITS), F.sort_array(keyed)))
    same = _repeated(F.col("_keys"), lambda x: F.shiftright(x, _POSITION_BITS))
    positions = F.transform(same, lambda x: x.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int"))
    df = df.withColumn("_maybe", F.when(F.col("_keys").isNull(), starts).otherwise(positions))
    # Windows whose shortened hashes met are compared as texts: the count is exact.
    grams = F.sort_array(F.transform("_maybe", lambda i: F.struct(F.concat_ws(" ", word(i), word(i + 1), word(i + 2)).alias("g"), i.alias("i"))))
    df = df.withColumn("_grams", grams)
    found = F.sort_array(F.transform(_repeated(F.col("_grams"), lambda x: x["g"]), lambda x: x["i"]))
    df = df.withColumn("_found", found)
    df = df.withColumn("n_repeat_words", _covered(F.col("_found")))
    return df.drop("_words", "_lines", "_keys", "_maybe", "_grams", "_found")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that :func:`quality_rules` keeps, with their own columns and nothing else."""
    rows = docs.select(F.struct("*").alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    return quality_rules(rows, "id").where("kept").select("id.*")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Judge every document: ``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance,
    word_distance, kept)``, one row per input row.

    ``base_failed`` is the length and repetition rule; ``kept`` is false then, and otherwise when a distance exceeds its bound. Distances
    are null below their minimum length and for languages without a reference (null among them): such documents are kept unless the base
    rule fails. Null and empty texts have no words and fail the base rule. Repeated rows and null ids stay, other columns are ignored
    whatever their names, and an empty table gives an empty result.
    """
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    df = measure(source)
    long = lambda x: F.col(x).cast("double")
    chars = F.greatest(F.length("_text"), F.lit(1)).cast("double")
    upper = F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("double")
    digits = F.regexp_count("_text", F.lit("[0-9]")).cast("double")
    marks = F.regexp_count("_text", F.lit(r"[!-/:-@\[-`{-~]")).cast("double") - long("n_symbols")
    space = F.length("_text").cast("double") - long("word_chars")
    counts = [upper, digits, long("n_symbols"), marks, space]
    df = df.withColumns({f"_c{i}": c / chars for i, c in enumerate(counts)})
    shares = [F.col(f"_c{i}") for i in range(5)]
    rest = F.greatest(F.lit(1.0) - sum(shares[1:], shares[0]), F.lit(0.0))

    def by_language(values: dict[str, tuple], kind: str) -> Column:
        pairs = [(F.col("lang") == k, F.array(*[F.lit(x) for x in v]).cast(f"array<{kind}>")) for k, v in values.items()]
        out = F.when(*pairs[0])
        for p in pairs[1:]:
            out = out.when(*p)
        return out

    df = df.withColumn("_ref", by_language(CHAR_REFERENCE, "double"))
    char_distance = js_distance([*shares, rest], [F.get("_ref", i) for i in range(6)])
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    spaced = F.concat(F.lit(" "), F.replace(F.lower("_norm"), F.lit(" "), F.lit("  ")), F.lit(" "))
    df = df.withColumn("_spaced", F.when(F.col("n_words") >= MIN_WORD_WORDS, spaced))
    times = F.transform(
        by_language(COMMON_WORDS, "string"),
        lambda w: (F.length("_spaced") - F.length(F.replace(F.col("_spaced"), F.concat(F.lit(" "), w, F.lit(" "))))) / (F.length(w) + 2),
    )
    df = df.withColumn("_times", times)
    k = len(next(iter(COMMON_WORDS.values())))
    found = [F.get("_times", i) / n for i in range(k)]
    expected = [TOP_SHARE / (i + 1) for i in range(k)]
    others = F.greatest(F.lit(1.0) - sum(found[1:], found[0]), F.lit(0.0))
    word_distance = js_distance([*found, others], [F.lit(x) for x in (*expected, 1 - sum(expected))])
    df = df.withColumn("char_distance", F.when((F.col("n_words") >= MIN_CHAR_WORDS) & F.col("_ref").isNotNull(), char_distance))
    df = df.withColumn("word_distance", F.when(F.col("_spaced").isNotNull() & F.col("_times").isNotNull(), word_distance))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    far = F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False)) | F.coalesce(
        F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)
    )
    df = df.withColumns({"base_failed": failed, "kept": ~failed & ~far})
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = [*counts, "base_failed", "char_distance", "word_distance", "kept"]
    return df.select(F.col("id").alias(id_col), *[_settled(F.col(c)).alias(c) for c in out])
