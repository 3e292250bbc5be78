"""Quality rules as a short-circuit cascade.

Each rule is a boolean column that rejects a document.  Cost and rejection rate of every rule are
estimated on a sample; the cascade then asks the rules in order of rejections per second, and a
document rejected by one rule never evaluates the later ones.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN, SPACE, cut_lineage, n_words, once, words_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: Rows on which rules are measured; only the order of evaluation depends on it, never a verdict.
SAMPLE_ROWS = 4_000


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines holding a word that are equal to an earlier line."""
    return once(lines_with_words(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that the text holds at least twice, the first included.

    Windows are compared by 64-bit hash within their own text.  A text without any repeat, by far
    the usual case, is settled by one distinct count; else the sorted (hash, position) list gives
    the repeated positions, and each adds the words up to the next repeated one, eight at most.
    """
    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
    )

    def covered(hashed: Column) -> Column:
        pairs = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def alike(a: Column, other: Column) -> Column:
            return F.coalesce(a["h"] == other["h"], F.lit(False))

        starts = once(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(p, lambda x, k: alike(x, F.get(p, k - 1)) | alike(x, F.get(p, k + 1))), lambda x: x["i"]
                )
            ),
        )
        return once(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    counted = once(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    return F.when(F.size(words) < WINDOW, 0).otherwise(counted).cast("long")


@dataclass(frozen=True)
class Rule:
    """``reject(text, words)`` is true for a document to be thrown away."""

    name: str
    reject: Callable[[Column, Column], Column]


def _doubled(words: Column) -> Column:
    return F.size(F.filter(words, lambda x, i: F.coalesce(x == F.get(words, i - 1), F.lit(False))))


def _many(text: Column, pattern: str, share: float) -> Column:
    found = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern))
    return found > share * F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\p{L}"))


#: Rules of production: too few words, repeated windows, symbols, shouting, repeated lines,
#: words said twice in a row, word length beyond that of prose.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda text, words: F.size(words) < 20),
    Rule("symbols", lambda text, words: 100 * n_symbols(text) > 20 * F.size(words)),
    Rule("capitals", lambda text, words: _many(text, r"\p{Lu}", 0.5)),
    Rule("dup_lines", lambda text, words: 10 * n_dup_lines(text) > 4 * F.size(lines_with_words(text))),
    Rule("doubled_words", lambda text, words: 100 * _doubled(words) > 30 * F.size(words)),
    Rule(
        "word_length",
        lambda text, words: (word_chars(text) < 2 * F.size(words)) | (word_chars(text) > 14 * F.size(words)),
    ),
    Rule("repeats", lambda text, words: 100 * n_repeat_words(words) > 30 * F.size(words)),
)


@dataclass(frozen=True)
class Estimate:
    """What the sample says of a rule."""

    name: str
    seconds: float
    rejected: float

    @property
    def rate(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS, text: str = "text") -> list[Estimate]:
    """Seconds and rejected share of each rule on about ``rows`` sampled documents.

    The sample is written once; each rule is then timed alone, less the time of a run with no rule.
    An empty table gives zero for both.
    """
    total = docs.count()
    share = min(1.0, rows / total) if total else 1.0
    sample = cut_lineage(docs.select(F.col(text).alias(f"{OWN}t")).sample(share, seed=7))
    sample = sample.withColumn(f"{OWN}w", words_of(F.col(f"{OWN}t")))
    t, w = F.col(f"{OWN}t"), F.col(f"{OWN}w")
    shares = sample.agg(*[F.avg(r.reject(t, w).cast("double")).alias(r.name) for r in rules]).first()

    def timed(*asked: Column) -> float:
        start = time.perf_counter()
        sample.agg(F.sum(F.size(w)), *[F.count_if(a) for a in asked]).collect()
        return time.perf_counter() - start

    timed()
    base = timed()
    return [Estimate(r.name, max(timed(r.reject(t, w)) - base, 1e-3), float(shares[r.name] or 0.0)) for r in rules]


def cascade(estimates: Sequence[Estimate], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """Rules by falling rejections per second; ties keep the given order."""
    by_name = {e.name: e.rate for e in estimates}
    return sorted(rules, key=lambda r: -by_name[r.name])


def first_rejection(ordered: Sequence[Rule], text: Column, words: Column) -> Column:
    """Name of the first rule that rejects the document, null if none does."""
    out = F.when(ordered[0].reject(text, words), ordered[0].name)
    for rule in ordered[1:]:
        out = out.when(rule.reject(text, words), rule.name)
    return out


def apply_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", verdict: str = "rejected_by", rows: int = SAMPLE_ROWS
) -> DataFrame:
    """All input rows and columns, plus ``verdict``: the rule that rejects the row, null if kept.

    Null and empty texts have no words and are rejected by ``few_words``; texts of any length are
    read whole; repeated rows get the same verdict; an empty table stays empty.  A column already
    named like ``verdict`` is replaced.  Which of several rejecting rules is named depends on the
    order chosen; whether a row is rejected does not.
    """
    ordered = cascade(estimate(docs, rules, rows, text), rules)
    # Words are bound inside the expression: a filter on the verdict may be moved below a column of
    # words, which would then be computed again at every mention.
    return docs.withColumn(verdict, once(words_of(F.col(text)), lambda w: first_rejection(ordered, F.col(text), w)))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with the input's columns."""
    judged = apply_rules(docs, rules, text, f"{OWN}verdict", rows)
    return judged.filter(F.col(f"{OWN}verdict").isNull()).drop(f"{OWN}verdict")


def measure(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: counts of the base rules and the verdict of the cascade.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    kept.  A document failing the base rules is not asked any further.
    """
    ordered = cascade(estimate(docs, RULES, rows, text), RULES)
    t, w = F.col(f"{OWN}t"), F.col(f"{OWN}w")
    out = docs.select(F.col(id_column), F.col(text).alias(f"{OWN}t")).withColumn(f"{OWN}w", words_of(t))
    out = out.select(
        id_column,
        f"{OWN}t",
        f"{OWN}w",
        F.size(w).cast("long").alias("n_words"),
        word_chars(t).alias("word_chars"),
        n_symbols(t).alias("n_symbols"),
        n_dup_lines(t).alias("n_dup_lines"),
        n_repeat_words(w).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    others = [r for r in ordered if r.name not in ("few_words", "repeats")]
    kept = F.when(F.col("base_failed"), False).otherwise(first_rejection(others, t, w).isNull())
    return out.withColumn("kept", kept).drop(f"{OWN}t", f"{OWN}w")
