"""Quality rules: a table of thresholds compiled into one projection.

Each rule bounds a metric of the whole text; all metrics are built-in
expressions over the text, its words and its lines, so a document is judged
where it is read, without a shuffle or a user function.

Words are runs of characters other than space and \\t-\\r. ``n_repeat_words``
counts the words inside 8-word windows that occur twice or more in the text;
windows are compared by a 64-bit hash of the hashes of their words.

Defined cases: a null text counts as empty; an empty or blank text has no
words and fails the base rule (fewer than 20 words); ratios without words or
lines are 0; repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import let

SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8

#: Frequent words of English, French, German and Spanish.
STOP_WORDS = ("the of and to in is that for it with as was on are by be an this from at or not "
              "le la les de des du et un une en que qui dans pour est sur au par ne pas "
              "der die das und ist von den ein eine mit zu auf nicht dem des sich "
              "el los las y del se por con una su para al lo como más").split()

#: Fixed values: (rule, metric, least, most); None leaves a side open.
RULES = [
    ("word_length", "mean_word_chars", 2.0, 15.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("exclamations", "exclaim_ratio", None, 0.1),
    ("capitals", "capital_ratio", None, 0.5),
    ("letters", "letter_word_ratio", 0.7, None),
    ("stop_words", "stop_word_ratio", 0.01, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.3),
    ("bullets", "bullet_line_ratio", None, 0.9),
    ("ellipses", "ellipsis_line_ratio", None, 0.3),
]


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; windows are hashes by position."""
    def covered(at: Column) -> Column:
        gains = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gains, F.lit(0).cast("long"), lambda a, x: a + x)

    def places(sorted_: Column) -> Column:
        twice = F.transform(sorted_, lambda p, k: F.when(
            (F.get(sorted_, k - 1)["h"] == p["h"]) | (F.get(sorted_, k + 1)["h"] == p["h"]), p["i"]))
        return let(F.sort_array(F.filter(twice, lambda x: x.isNotNull())), covered)

    return let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)


def measure(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the metrics of every row of docs."""
    body = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(doc_id).alias("doc_id"), body.alias("t"), F.btrim(body, F.lit(SPACES)).alias("inner"))
    d = d.select("doc_id", "t", F.when(F.col("inner") == "", F.array().cast("array<string>")).otherwise(
        F.split("inner", SPACE + "+")).alias("words"), F.filter(
        F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"))
    h = F.transform("words", lambda w: F.xxhash64(w))
    d = d.select("*", F.size("words").cast("long").alias("n_words"), h.alias("h"),
                 F.array_join("words", "").alias("letters"), F.size("lines").cast("long").alias("n_lines"))
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(
        F.slice("h", F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")),
        lambda x, i: F.xxhash64(x, *[F.get(F.col("h"), i + k) for k in range(1, WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.select("*", windows.alias("windows"))
    n = F.col("n_words")
    length = F.char_length("letters").cast("long")
    symbols = F.char_length(F.regexp_replace("letters", "[^#*$%&|<>]+", "")).cast("long")
    return d.select(
        "doc_id", "n_words", length.alias("word_chars"), symbols.alias("n_symbols"),
        (F.col("n_lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0).cast("long"))
        .otherwise(_repeat_words(F.col("windows"))).alias("n_repeat_words"),
        _ratio(length, n).alias("mean_word_chars"), _ratio(symbols, n).alias("symbol_ratio"),
        _ratio(F.char_length("letters") - F.char_length(F.replace(F.col("letters"), F.lit("!"))), n).alias("exclaim_ratio"),
        _ratio(F.char_length(F.regexp_replace("letters", r"[^\p{Lu}]+", "")), length).alias("capital_ratio"),
        _ratio(n - F.size(F.filter("words", lambda w: w.rlike(r"^[^\p{L}]*$"))), n).alias("letter_word_ratio"),
        _ratio(F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))), n).alias("stop_word_ratio"),
        _ratio(F.col("n_lines") - F.size(F.array_distinct("lines")), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.size(F.filter("lines", lambda x: x.rlike(r"^\s*[-*•]"))), F.col("n_lines")).alias("bullet_line_ratio"),
        _ratio(F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))), F.col("n_lines")).alias(
            "ellipsis_line_ratio"))


def compiled(rules=RULES) -> Column:
    """Array of the names of the rules that a row of metrics breaks."""
    def broken(metric, least, most):
        low = F.col(metric) < least if least is not None else F.lit(False)
        return low | (F.col(metric) > most) if most is not None else low
    return F.filter(F.array(*[F.when(broken(*r[1:]), F.lit(r[0])) for r in rules]), lambda x: x.isNotNull())


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """doc_id, base metrics, base_failed, kept and the names of the broken rules of every row."""
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (measure(docs, doc_id=doc_id, text=text)
            .select("*", base.alias("base_failed"), compiled(rules).alias("broken"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"),
                    F.array_join("broken", ",").alias("broken_rules")))
