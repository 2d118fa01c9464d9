"""Quality rules: a table of thresholds compiled into one projection.

Every rule bounds a ratio of two measures of a text. ``measures`` computes the measures with built-in
functions, ``compile_rules`` turns the table into one boolean column per rule, and ``apply_rules``
returns both. Nothing is shuffled and no Python runs on the executors.

Null text counts as empty: all measures are 0 and the base rule rejects it. Texts are measured whole, however long. Ties and
repeated rows do not interact, since each row is judged by itself. An empty table gives no rows. Other columns of the input are not read and cannot
clash: the result has only the columns named below.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import SPACES, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = """
a and are as at be by for from in is it of on that the this to was with
au avec dans de des du en est et la le les par pas pour que qui sur un une
auf das dem den der des die ein eine für im in ist mit nicht sich und von zu
al con de del el en es la las lo los no para por que se su un una y
""".split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a text whose denominator is 0 passes.

    An open bound is None. Both sides are compared as products of whole numbers: the bounds are
    given in thousandths.
    """

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None

    def passes(self) -> Column:
        value, unit = F.col(self.numerator) * 1000, F.col(self.denominator)
        tests = [] if self.low is None else [value >= unit * self.low]
        tests += [] if self.high is None else [value <= unit * self.high]
        return reduce(and_, tests, F.lit(True))


RULES = [
    Rule("word_length", "word_chars", "n_words", low=2500, high=12000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=400),
    Rule("stop_words", "n_stop_words", "n_words", low=20),
]


def _neighbours(pairs: Column, n: Column) -> Column:
    """Positions of (value, position) pairs, sorted by value, that share their value with a neighbour."""
    left, right = F.slice(pairs, 1, F.greatest(n - 1, F.lit(0))), F.slice(pairs, 2, F.greatest(n - 1, F.lit(0)))
    both = F.zip_with(
        left, right, lambda a, b: F.when(a["v"] == b["v"], F.array(a["p"], b["p"])).otherwise(F.array().cast("array<int>"))
    )
    return F.array_sort(F.array_distinct(F.flatten(both)))


def _chain(hashes: Column, n: Column, step: int) -> Column:
    """Hashes of twice as many words: each joined to the one ``step`` words on."""
    rest = F.greatest(n - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, rest), F.slice(hashes, step + 1, rest), lambda a, b: F.xxhash64(a, b))


def measures(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """The columns in ``carry`` as _0, _1, ... and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words.

    Windows that occur twice are found by hash and then compared as text, so hashes that collide do
    not count. Texts without equal hashes, nearly all, skip the sorting.
    """
    text, n = F.col("_t"), F.col("n_words").cast("int")
    blank = F.translate(text, SPACES, "")
    own = [f"_{i}" for i in range(len(carry))]
    df = docs.select(*[docs[c].alias(o) for c, o in zip(carry, own)], F.coalesce(docs[text_col], F.lit("")).alias("_t"))
    df = df.withColumn("_w", words(text)).withColumn(
        "_l", F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    )
    df = df.select(
        *own,
        "_w",
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(blank).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).cast("bigint").alias("n_stop_words"),
        F.when(F.size("_w") > WINDOW, F.transform("_w", lambda w: F.xxhash64(w))).alias("_h"),
    )
    for step in (1, 2, 4):
        df = df.withColumn("_h", _chain(F.col("_h"), n - (step - 1), step))
    same = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn(
        "_s", F.when(same, F.array_sort(F.arrays_zip(F.col("_h").alias("v"), F.sequence(F.lit(0), n - WINDOW).alias("p"))))
    ).drop("_h")
    df = df.withColumn("_c", F.when(F.col("_s").isNotNull(), _neighbours(F.col("_s"), F.size("_s")))).drop("_s")
    df = df.withColumn(
        "_s",
        F.when(
            F.size("_c") > 0,
            F.array_sort(
                F.transform(
                    "_c", lambda i: F.struct(F.array_join(F.slice("_w", i + 1, WINDOW), " ").alias("v"), i.alias("p"))
                )
            ),
        ),
    ).drop("_c", "_w")
    df = df.withColumn("_p", F.when(F.col("_s").isNotNull(), _neighbours(F.col("_s"), F.size("_s")))).drop("_s")
    m = F.size("_p")
    gaps = F.zip_with(
        F.slice("_p", 1, F.greatest(m - 1, F.lit(0))), F.slice("_p", 2, F.greatest(m - 1, F.lit(0))),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    repeat = F.when(m > 0, F.aggregate(gaps, F.lit(WINDOW), lambda acc, x: acc + x)).otherwise(0)
    return df.withColumn("n_repeat_words", repeat.cast("bigint")).drop("_p")


def compile_rules(rules: list[Rule]) -> dict[str, Column]:
    """One boolean column per rule, true where the text passes."""
    return {f"passes_{r.name}": r.passes() for r in rules}


def _judged(docs: DataFrame, rules: list[Rule], carry: list[str], text_col: str) -> DataFrame:
    compiled = compile_rules(rules)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measures(docs, carry, text_col).select(
        "*",
        *[c.alias(name) for name, c in compiled.items()],
        base.alias("base_failed"),
        reduce(and_, compiled.values(), ~base).alias("kept"),
    )


def apply_rules(
    docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, the measures, ``passes_*`` per rule, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated windows.
    """
    return _judged(docs, rules, [id_col], text_col).withColumnRenamed("_0", id_col)


def kept_documents(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are. They ride along, so no join is needed."""
    judged = _judged(docs, rules, docs.columns, text_col)
    own = [f"_{i}" for i in range(len(docs.columns))]
    # The row number, always >= 0, keeps the filter above the measures; below them, each would be worked out many times.
    judged = judged.select(*own, "kept", F.monotonically_increasing_id().alias("_number"))
    kept = judged.where(F.col("kept") & (F.col("_number") >= 0))
    return kept.select(*[F.col(o).alias(c) for o, c in zip(own, docs.columns)])
