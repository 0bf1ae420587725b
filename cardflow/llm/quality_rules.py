"""Quality rules: a table of thresholds compiled into native projections.

`measures` adds the measured columns, `RULES` is the table, `verdict` compiles it into one boolean
column. Nothing is evaluated outside the JVM and nothing is shuffled.

Defined results: a null or empty text has no words and fails `n_words`; a ratio over no words is 0;
extra columns are kept, and a measured column replaces an input column of its name; a very long text is
measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that for with as was on be by from it are this an or "
    "de la que el en y los se del las un por con no una su para es al lo "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "le les et des en un du une est pour qui dans par sur pas au plus ce il sont"
).split()


@dataclass(frozen=True)
class Rule:
    """`low <= value <= high`, for texts of at least `from_words` words."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: Bounds sit well outside what ordinary prose shows, since a rejected document is lost.
RULES = (
    Rule("length", "n_words", low=MIN_WORDS),
    Rule("repeated windows", "repeat_percent", high=MAX_REPEAT_PERCENT),
    Rule("word length", "mean_word_chars", low=2, high=25),
    Rule("symbols", "symbols_per_word", high=0.5),
    Rule("repeated lines", "dup_line_ratio", high=0.5),
    Rule("upper case", "upper_ratio", high=0.6, from_words=30),
    Rule("stop words", "stop_words_seen", low=1, from_words=80),
)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def _shifted(name: str, by: int) -> Column:
    return F.slice(F.col(name), by + 1, F.greatest(F.size(name) - by, F.lit(0)))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the ratios of the
    rules.

    Each step that is used more than once is a column of its own, so that it is computed once.
    Windows of five words are hashed by pairs: (1,2), then (1-2, 3-4), then (1-4, 5). Only a text
    with a repeated window sorts its windows to find which words they cover.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_w", _words(t)).withColumn(
        "_lines", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    )
    pair = lambda a, b: F.xxhash64(a, b)
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("_h2", F.zip_with("_h", _shifted("_h", 1), pair))
    df = df.withColumn("_h4", F.zip_with("_h2", _shifted("_h2", 2), pair))
    df = df.withColumn(
        "_g",
        F.slice(
            F.zip_with("_h4", _shifted("_h", 4), pair),
            1,
            F.greatest(F.size("_h") - (WINDOW - 1), F.lit(0)),
        ),
    )
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    numbered = F.zip_with(
        "_g", F.sequence(F.lit(1), F.size("_g")), lambda h, i: F.struct(h.alias("h"), i.alias("i"))
    )
    df = df.withColumn("_s", F.when(repeats, F.sort_array(numbered)))
    df = df.withColumn(
        "_same", F.zip_with("_s", _shifted("_s", 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    )
    before = F.concat(F.array(F.lit(False)), F.col("_same"))
    marked = F.filter(
        F.zip_with(
            F.zip_with("_s", "_same", lambda a, b: F.struct(a["i"].alias("i"), b.alias("b"))),
            before,
            lambda a, b: F.when(a["b"] | b, a["i"]),
        ),
        lambda i: i.isNotNull(),
    )
    df = df.withColumn("_at", F.when(F.col("_s").isNotNull(), F.sort_array(marked)))
    covered = F.aggregate(
        F.zip_with(
            "_at", _shifted("_at", 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    symbols = F.size(F.split(t, SYMBOL, -1)) - 1
    joined = F.array_join("_w", "")
    upper = F.size(F.split(t, r"\p{Lu}", -1)) - 1
    return (
        df.withColumns(
            {
                "n_words": F.size("_w").cast("long"),
                "word_chars": F.length(joined).cast("long"),
                "n_symbols": symbols.cast("long"),
                "_n_lines": F.size("_lines"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
                "stop_words_seen": F.size(
                    F.array_intersect("_w", F.array(*map(F.lit, sorted(set(STOP_WORDS)))))
                ),
                "_upper": upper,
            }
        )
        .withColumns(
            {
                "repeat_percent": _ratio(100 * F.col("n_repeat_words"), F.col("n_words")),
                "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
                "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
                "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("_n_lines")),
                "upper_ratio": _ratio(F.col("_upper"), F.col("word_chars")),
            }
        )
        .drop("_w", "_lines", "_h", "_h2", "_h4", "_g", "_s", "_same", "_at", "_n_lines", "_upper")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule holds."""

    def holds(rule: Rule) -> Column:
        value = F.col(rule.value)
        bounds = [value >= rule.low] if rule.low is not None else []
        bounds += [value <= rule.high] if rule.high is not None else []
        ok = reduce(lambda a, b: a & b, bounds, F.lit(True))
        return ok | (F.col("n_words") < rule.from_words) if rule.from_words else ok

    return reduce(lambda a, b: a & b, map(holds, rules), F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with the measures, base_failed and kept."""
    return (
        measures(docs, text)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` that pass, with their own columns.

    A filter on `kept` alone would be pushed below the projections and so compute every measure
    again for each use; a row number in the filter keeps it above them.
    """
    return (
        judge(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_d"), F.col(text).alias("_t")), "_t", rules)
        .select("_d", "kept", F.monotonically_increasing_id().alias("_row"))
        .where(F.col("kept") & (F.col("_row") >= 0))
        .select("_d.*")
    )
