"""Quality rules: a threshold table compiled into one projection.

Every measure is a column of built-in functions over one row, so the scan is
one stage without a shuffle, however the rows are distributed.

Results at the edges: a null text counts as empty (0 words, rejected by the
base rule). Texts of any length are measured whole. Repeated rows are judged
one by one, an empty table gives an empty table, and columns of the input
named like a measure are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, let, words

WINDOW = 5
#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is it for on with as that this by are was be at from "
    "der die das und ist von zu den mit sich auf für im nicht ein eine dem "
    "le la les de des et un une du en que est pour dans qui sur par au pas "
    "el los las y se del con una por su al lo es no más para"
).split()


@dataclass(frozen=True)
class Rule:
    """``low * per - slack <= measure <= high * per``; a bound of None is open."""

    name: str
    measure: str
    per: str
    low: float | None = None
    high: float | None = None
    slack: float = 0.0

    def passes(self) -> Column:
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (F.col(self.measure) >= F.lit(self.low) * F.col(self.per) - self.slack)
        if self.high is not None:
            ok = ok & (F.col(self.measure) <= F.lit(self.high) * F.col(self.per))
        return ok


#: The method's verdict. Ratios are written as products: no division by zero.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("exclamation", "n_exclaim", "n_words", high=0.25),
    Rule("stop_words", "n_stop", "n_words", low=0.02, slack=1.0),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.4),
)


def _removed(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    entries = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def starts(s: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        hit = F.transform(s, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"]))
        return F.sort_array(F.array_compact(hit))

    def union(p: Column) -> Column:
        steps = F.transform(
            p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(let(F.sort_array(entries), starts), union)


def repeated_words(w: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the array."""

    def windows(a: Column) -> Column:
        n = F.size(a) - (WINDOW - 1)
        shifted = [F.slice(a, F.lit(k + 1), n).alias(f"w{k}") for k in range(WINDOW)]
        return F.transform(F.arrays_zip(*shifted), lambda x: F.xxhash64(x))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_covered(h))

    return let(w, lambda a: F.when(F.size(a) <= WINDOW, 0).otherwise(let(windows(a), count)))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures as columns ``n_words`` ... ``n_lines`` (all long).

    A column of ``docs`` with a measure's name is replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    staged = docs.withColumns({"_t": t, "_w": words(F.col(text)), "_lines": lines})
    stop = F.filter(F.col("_w"), lambda x: F.lower(x).isin(STOP_WORDS))
    found = {
        "n_words": F.size("_w"),
        "word_chars": F.char_length(F.array_join("_w", "")),
        "n_symbols": _removed(F.col("_t"), r"[#*$%&|<>]"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_w")),
        "n_exclaim": F.char_length("_t") - F.char_length(F.replace(F.col("_t"), F.lit("!"), F.lit(""))),
        "n_stop": F.size(stop),
        "n_lines": F.size("_lines"),
    }
    return staged.withColumns({k: v.cast("long") for k, v in found.items()}).drop("_t", "_w", "_lines")


def base_failed() -> Column:
    """Too short, or more than a fifth of the words repeated."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``failed_rules`` (names) and ``kept``."""
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))
    out = measures(docs, text).withColumns({"base_failed": base_failed(), "failed_rules": failed})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
