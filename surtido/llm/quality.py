"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.llm.common import SPACES, let

WINDOW = 8

# The most frequent function words of the languages the rules serve.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as",
    "be", "by", "this", "are", "at", "from",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für",
    "nicht", "ist", "im", "dem", "ein", "eine", "als",
    "de", "la", "le", "et", "les", "en", "un", "du", "que", "une", "pour", "est", "qui",
    "dans", "sur", "par", "pas", "au", "avec",
    "el", "y", "los", "las", "se", "del", "por", "con", "no", "su", "una", "para", "es",
    "al", "lo",
)


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures that must lie within bounds; ``None`` leaves a side open."""

    name: str
    top: str
    bottom: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=12.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("shouted", "n_exclaimed", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.05),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.4),
)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words_of(text: Column) -> Column:
    """The runs of characters other than space and 09 to 0D."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _lines_with_a_word(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: _without(line, SPACES) != "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window of ``width`` words found twice or more in the text.

    Windows are compared by a 64-bit hash. Texts whose windows all differ, most texts, end
    after one look; otherwise equal hashes are brought together by a sort, and every found
    window adds the words up to the next found one, at most its width.
    """
    last = F.size(words) - width

    def covered(starts: Column) -> Column:
        steps = F.zip_with(starts, F.slice(starts, F.lit(2), F.size(starts)),
                           lambda a, b: F.least(b - a, F.lit(width)))
        return F.aggregate(steps, F.lit(0), lambda n, s: n + F.coalesce(s, F.lit(width)))

    def found(order: Column) -> Column:
        same = F.filter(order, lambda x, i: (
            (i > 0) & (F.get(order, i - 1)["h"] == x["h"])) | F.coalesce(
                F.get(order, i + 1)["h"] == x["h"], F.lit(False)))
        return covered(F.array_sort(F.transform(same, lambda x: x["i"])))

    def count(hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(
            h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(order, found))

    hashes = F.transform(F.sequence(F.lit(1), last + 1),
                         lambda i: F.xxhash64(F.slice(words, i, F.lit(width))))
    return F.when(last < 1, F.lit(0)).otherwise(let(hashes, count))


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The counts the rules compare. ``text`` is not null."""
    lines = _lines_with_a_word(text)
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(_without(text, SPACES)),
        "n_symbols": F.length(text) - F.length(_without(text, "#*$%&|<>")),
        "n_exclaimed": F.length(text) - F.length(_without(text, "!")),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
    }
    return {name: value.cast("long") for name, value in counts.items()}


def passes(rule: Rule) -> Column:
    """True where the ratio lies within the bounds; a text without the bottom fails none."""
    ratio = F.col(rule.top) / F.nullif(F.col(rule.bottom), F.lit(0))
    low = F.lit(True) if rule.least is None else ratio >= rule.least
    high = F.lit(True) if rule.most is None else ratio <= rule.most
    return F.coalesce(low & high, F.lit(True))


def score(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: the measures, one column ``ok_<rule>`` per rule, the verdict.

    ``base_failed`` is true below 20 words or with more than 30 % repeated words; ``kept``
    is false if it is, else all rules must hold. A null text counts as empty, so it has
    zero measures and fails the base; repeated rows are judged alike; an empty table gives
    no rows; other columns are left out.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    rows = rows.select("doc_id", *[c.alias(n) for n, c in measures(
        F.col("text"), F.col("words")).items()])
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumns({"base_failed": base} | {f"ok_{r.name}": passes(r) for r in rules})
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & F.col(f"ok_{rule.name}")
    return rows.withColumn("kept", kept)
