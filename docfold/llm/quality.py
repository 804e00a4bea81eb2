"""Quality rules: a threshold table compiled into one projection, without user functions.

Definitions.  Words are runs of characters other than space and 0x09-0x0D; lines are split at ``\\n``.  A null or empty
text has no words and no lines; it fails the base rule.  Repeated rows are judged one by one and alike.  Other columns
of the input, whatever their names, are neither read nor touched.  Texts of any length are measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm.columns import BLANK, WORD, let, words

# Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "the be to of and that have with a in is it for was on as are this by not from or an at "
    "le la les de des du et un une en est que qui dans pour par sur au avec ce il "
    "der die das und von zu den mit ist im für auf ein eine nicht des dem als auch "
    "el los las y en del que se por con para una su al lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a document if ``low * of <= 100 * measure <= high * of``; a missing bound does not bind."""

    name: str
    measure: str
    of: str
    low: float | None = None
    high: float | None = None


#: Percentages of one count against another; the production table.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 200, 1400),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 2, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("words_with_letters", "n_letter_words", "n_words", 80, None),
)
MIN_WORDS, MAX_REPEAT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_ellipsis_lines", "n_bullet_lines", "n_letter_words")


def _repeat_words(w: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more in the text, the first included."""

    def marked(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(p, lambda e, j: F.coalesce(F.get(p, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(p, j + 1)["h"] == e["h"], F.lit(False))),
                    lambda e: e["i"],
                )
            ),
        )
        # A window adds the words that the one before it does not cover.
        return F.aggregate(
            twice,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))

    def counted(h: Column) -> Column:
        return let(windows(h), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(marked(g)))

    return F.when(F.size(w) < 3, 0).otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), counted))


def measures(text: Column) -> Column:
    """A struct of all counts of a text."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column, lines: Column) -> Column:
        long = lambda c: c.cast("long")
        return F.struct(
            long(F.size(w)).alias("n_words"),
            long(F.length(F.array_join(w, ""))).alias("word_chars"),
            long(F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))).alias("n_symbols"),
            long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            long(_repeat_words(w)).alias("n_repeat_words"),
            long(F.size(lines)).alias("n_lines"),
            long(F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS)))).alias("n_stop_words"),
            long(F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))).alias("n_ellipsis_lines"),
            long(F.size(F.filter(lines, lambda x: x.rlike(rf"^{BLANK}*[-*•]")))).alias("n_bullet_lines"),
            long(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))).alias("n_letter_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(words(text), lambda w: let(lines, lambda x: of(w, x)))


def base_failed(m: Column, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT) -> Column:
    return (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat * m["n_words"])


def passes(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one condition on the counts."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (100 * m[r.measure] >= r.low * m[r.of])
        if r.high is not None:
            out = out & (100 * m[r.measure] <= r.high * m[r.of])
    return out


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and verdict of every row."""
    m = F.col("m")
    return docs.select(F.col(id_col), measures(F.col(text_col)).alias("m")).select(
        id_col, *(m[c].alias(c) for c in COUNTS), base_failed(m).alias("base_failed"), (~base_failed(m) & passes(m, rules)).alias("kept")
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, as they are."""
    return docs.where(let(measures(docs[text_col]), lambda m: ~base_failed(m) & passes(m, rules)))
