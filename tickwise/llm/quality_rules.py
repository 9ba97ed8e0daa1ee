"""Quality rules: a threshold table compiled into one Spark projection.

Every rule bounds one ratio of a text (length, symbol, stop-word and line ratios).  The
table is compiled into a single Boolean expression over the text's counts; the counts are
built-in functions and higher-order functions, so no Python runs and nothing is shuffled.

Defined cases.  Null, empty and blank texts have no words, all counts are 0, and they fail
the base rule (under 20 words).  Repeated rows are judged one by one, alike.  A very long
text costs n log n in its own length at most.  An empty table gives an empty result.  Extra
input columns never clash: the operator reads only the columns it is given.
Window equality is judged on a 64-bit hash of the eight words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import SPACE_RE, words

#: Words in a window whose repetition counts.
WINDOW = 8
#: The symbol characters.
SYMBOLS_RE = "[#*$%&|<>]"
#: Very frequent words of the four languages of the corpus.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with",
    "als auch auf das dem den der des die ein eine für ist mit nicht sich und von zu im",
    "au aux avec ce dans de des du elle en est et il la le les par pas pour que qui un une",
    "al como con de del el en es la las lo los no para por que se su un una y",
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Threshold:
    """Keep a text while ``lowest <= numerator / denominator <= highest`` (None: unbounded)."""

    name: str
    numerator: str
    denominator: str
    lowest: float | None = None
    highest: float | None = None

    def holds(self) -> Column:
        # multiplied out: no division, so a zero denominator needs no case of its own
        value, base = F.col(self.numerator), F.col(self.denominator)
        ok = F.lit(True)
        if self.lowest is not None:
            ok = ok & (value >= F.lit(self.lowest) * base)
        if self.highest is not None:
            ok = ok & (value <= F.lit(self.highest) * base)
        return ok


#: The production table.
THRESHOLDS = (
    Threshold("mean word length", "word_chars", "n_words", 2.0, 14.0),
    Threshold("symbols per word", "n_symbols", "n_words", None, 0.2),
    Threshold("stop words per word", "n_stop_words", "n_words", 0.02, None),
    Threshold("repeated lines", "n_dup_lines", "n_lines", None, 0.4),
    Threshold("words in repeated windows", "n_repeat_words", "n_words", None, 0.3),
)


def compile_rules(thresholds: tuple[Threshold, ...]) -> Column:
    """The whole table as one expression."""
    verdict = F.lit(True)
    for rule in thresholds:
        verdict = verdict & rule.holds()
    return verdict


def _stop_list() -> list[str]:
    plain = {w for line in STOP_WORDS for w in line.split()}
    return sorted(plain | {w.capitalize() for w in plain})


def _repeated_words(hashes: str, ordered: str) -> Column:
    """Words inside windows that occur twice or more.

    ``ordered`` holds (window hash, start) sorted, or null where all windows differ.  A
    window is repeated if a neighbour in that order has its hash; the union of the repeated
    windows is summed in one pass over their starts.
    """
    rows = F.col(ordered)
    repeated = F.filter(rows, lambda x, k: (
        (k > 0) & (F.get(rows, k - 1)["h"] == x["h"]))
        | F.coalesce(F.get(rows, k + 1)["h"] == x["h"], F.lit(False)))
    starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    total = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct(
            (acc["n"] + WINDOW - F.greatest(F.lit(0), acc["end"] - p)).alias("n"),
            (p + WINDOW).alias("end")),
        lambda acc: acc["n"])
    return F.coalesce(total, F.lit(0)).cast("long")


def quality_counts(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus the counts the rules use."""
    base = df.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # Generators are barriers: filters above them are not pushed below, so the words are
    # split and hashed once however many expressions use them.
    base = base.select("*", F.explode(F.array(words(F.col("_text")))).alias("_words"))
    one = base.select(
        "*", F.inline(F.array(F.struct(
            F.size("_words").cast("long").alias("n_words"),
            F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
            F.filter(F.split(F.col("_text"), "\n"),
                     lambda s: s.rlike("[^ \\t-\\r]")).alias("_lines")))))
    hashes = F.col("_hashes")
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW),
                    lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    two = one.select("*", F.explode(F.array(windows)).alias("_windows"))
    ordered = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    three = two.select("*", F.explode(F.array(ordered)).alias("_ordered"))
    stop = _stop_list()
    return three.select(
        *[F.col(c) for c in keep], "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS_RE, ""))
         ).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.inline(F.array(F.struct(
            _repeated_words("_windows", "_ordered").alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.size(F.filter("_words", lambda w: w.isin(*stop))).cast("long")
            .alias("n_stop_words")))))


def judge(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """``keep`` columns, the counts, ``base_failed`` and ``kept`` for every row of ``df``."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (quality_counts(df, text, keep)
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & compile_rules(thresholds)))


def keep_good(df: DataFrame, text: str = "text",
              thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """The rows of ``df`` the rules keep, with all their columns and nothing else."""
    names = df.columns
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                    F.col(text).alias("_body"))
    judged = judge(row, "_body", ("_row",), thresholds)
    return judged.filter("kept").select("_row.*")
