"""Quality rules as a short-circuit cascade (operator 7).

Each rule is a boolean expression over a document's text.  On a sample
the cost of a rule (its run time per row) and its selectivity (the share
of rows it rejects) are estimated; the rules then run in the order of
rejection per cost, as one CASE expression, which stops at the first
rule that rejects.  The order changes the cost only, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoscope.llm._common import BLANKS, let, long_sum, words

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOL_PCT = 10
MAX_DUP_LINE_PCT = 30
MIN_DUP_LINES = 3
MIN_MEAN_WORD = 2
MAX_MEAN_WORD = 15
MIN_MEAN_OVER = 10  # words that a mean word length needs
SAMPLE_ROWS = 2000
SYMBOLS = "[#*$%&|<>]"


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more.

    Windows are hashed to 64 bits and sorted as long values with their
    position in the low bits, so equal windows are neighbours; neighbours
    are confirmed on the whole hash.  O(n log n) for a text of n words.
    """
    def over_windows(win):
        bits = F.length(F.bin(F.size(win)))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def high(x):
            return F.call_function("shiftright", x, bits)

        packed = F.sort_array(F.transform(
            win, lambda h, i: F.call_function("shiftleft", high(h), bits) + i.cast("long")))

        def place(x):
            return x.bitwiseAND(mask).cast("int")

        def repeated(s):
            def twin(x, other):
                return ((high(x) == high(other))
                        & (F.get(win, place(x)) == F.get(win, place(other))))

            hits = F.filter(s, lambda x, k: F.coalesce(twin(x, F.get(s, k - 1)), F.lit(False))
                            | F.coalesce(twin(x, F.get(s, k + 1)), F.lit(False)))
            return F.sort_array(F.transform(hits, place))

        def covered(starts):
            return long_sum(F.transform(starts, lambda p, k: F.when(
                k == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(starts, k - 1)))
                .cast("long")))

        return let(packed, lambda s: let(repeated(s), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(windows, over_windows))


def _filled_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1),
                    lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def text_metrics(text: Column) -> dict[str, Column]:
    """The metrics the rules use, as expressions over one text column.

    Null, empty and blank texts have 0 everywhere.
    """
    w = words(text)
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long"),
        "n_lines": F.size(_filled_lines(text)).cast("long"),
        "n_dup_lines": let(_filled_lines(text), lambda x: (
            F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": let(w, _repeat_words),
    }


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one long column per metric, each computed once.

    Existing columns of those names are replaced.
    """
    first = docs.withColumn("__words", words(F.col(text)))
    m = text_metrics(F.col(text))
    m |= {
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_repeat_words": let(F.col("__words"), _repeat_words),
    }
    return first.withColumns(m).drop("__words")


@dataclass(frozen=True)
class Rule:
    """``reject`` maps the metrics (name to Column) to a boolean Column."""

    name: str
    reject: Callable[[dict[str, Column]], Column]


def rules(min_words: int = MIN_WORDS, min_repeat_words: int = 0) -> tuple[Rule, ...]:
    """The rules in no special order: the cascade orders them by estimate.

    The repetition rule leaves texts under ``min_repeat_words`` alone.
    """
    return (
        Rule("few_words", lambda m: m["n_words"] < min_words),
        Rule("repeated_words", lambda m: (m["n_words"] >= min_repeat_words)
             & (100 * m["n_repeat_words"] > MAX_REPEAT_PCT * m["n_words"])),
        Rule("symbols", lambda m: 100 * m["n_symbols"] > MAX_SYMBOL_PCT * m["n_words"]),
        Rule("repeated_lines", lambda m: (m["n_dup_lines"] >= MIN_DUP_LINES)
             & (100 * m["n_dup_lines"] > MAX_DUP_LINE_PCT * m["n_lines"])),
        Rule("word_length", lambda m: (m["n_words"] >= MIN_MEAN_OVER)
             & ((m["word_chars"] < MIN_MEAN_WORD * m["n_words"])
                | (m["word_chars"] > MAX_MEAN_WORD * m["n_words"]))),
    )


RULES = rules()


def base_failed(m: dict[str, Column]) -> Column:
    return RULES[0].reject(m) | RULES[1].reject(m)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float  # seconds per sampled row
    selectivity: float  # share of sampled rows rejected

    @property
    def rank(self) -> float:
        return self.selectivity / max(self.cost, 1e-9)


def order_rules(docs: DataFrame, rules=RULES, text: str = "text",
                sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Estimate]:
    """Rules by falling rejection per cost, estimated on a sample.

    The sample holds about ``sample_rows`` rows whatever the table's
    size.  An empty table leaves the rules in their given order.
    """
    total = docs.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    sample = docs.select(F.col(text).alias("text")).sample(share, seed).persist()
    try:
        rows = sample.count()
        if not rows:
            return [Estimate(r, 1.0, 0.0) for r in rules]
        m = text_metrics(F.col("text"))

        def timed(expr: Column) -> tuple[float, int]:
            t0 = time.perf_counter()
            n = sample.select(F.sum(expr.cast("int")).alias("n")).first()["n"]
            return time.perf_counter() - t0, n or 0

        timed(F.lit(False))
        idle, _ = timed(F.lit(False))
        out = []
        for r in rules:
            spent, n = timed(r.reject(m))
            out.append(Estimate(r, max(spent - idle, 1e-4) / rows, n / rows))
    finally:
        sample.unpersist()
    return sorted(out, key=lambda e: (-e.rank, e.cost, e.rule.name))


def verdict(rules, metrics: dict[str, Column]) -> Column:
    """Name of the first rule that rejects, null where none does."""
    out = F.lit(None).cast("string")
    for r in reversed(list(rules)):
        out = F.when(r.reject(metrics), F.lit(r.name)).otherwise(out)
    return out


def cascade(docs: DataFrame, rules=RULES, text: str = "text",
            metrics: dict[str, Column] | None = None) -> DataFrame:
    """``docs`` with ``rejected_by`` (null: kept), replaced if present.

    Without ``metrics`` each rule computes its own from the text, only
    where the rules before it did not reject.  Null and empty texts are
    rejected as too short; equal rows get equal verdicts; an empty table
    gives an empty table.
    """
    ordered = [e.rule for e in order_rules(docs, rules, text)]
    return docs.withColumn("rejected_by",
                           verdict(ordered, metrics or text_metrics(F.col(text))))


def accepted(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns."""
    ordered = [e.rule for e in order_rules(docs, rules, text)]
    return docs.where(verdict(ordered, text_metrics(F.col(text))).isNull())
