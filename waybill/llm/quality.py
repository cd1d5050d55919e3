"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import BLANKS, free_name, let, words, written

WINDOW = 8
SAMPLE_ROWS = 2000


Measures = Callable[[str], Column]


class Rule(NamedTuple):
    """``rejects`` turns measures, asked for by name, into a condition."""

    name: str
    rejects: Callable[[Measures], Column]


def count_of(text: Column, chars: str) -> Column:
    """How many characters of ``chars``, a regex class, the text has."""
    return (F.size(F.split(text, f"[{chars}]")) - 1).cast("long")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    filled = lambda x: F.filter(x, lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    again = lambda x: F.size(x) - F.size(F.array_distinct(x))
    return let(F.split(text, "\n"), lambda x: F.when(again(x) == 0, 0).otherwise(let(filled(x), again))).cast("long")


def _joined(marks: Column, by: int) -> Column:
    """Marks of windows twice as wide: each with the one ``by`` words later. The last ``by`` are cut short."""
    return F.zip_with(marks, F.slice(marks, by + 1, F.size(marks)), lambda a, b: F.xxhash64(a, b))


def _whole(marks: Column, width: int) -> Column:
    return F.slice(marks, 1, F.greatest(F.size(marks) - (width - 1), F.lit(0)))


def _covered(marks: Column) -> Column:
    """Words inside windows whose mark occurs twice; positions are sorted by mark."""
    pairs = F.sort_array(F.transform(marks, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(p: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(p, i)["h"] == F.get(p, j)["h"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.sort_array(F.transform(twice, lambda i: F.get(p, i)["i"]))

    gaps = lambda s: F.zip_with(
        s, F.slice(s, 2, F.size(s)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    total = lambda s: F.aggregate(gaps(s), F.lit(0).cast("long"), lambda n, g: n + g)
    return let(pairs, lambda p: let(starts(p), total))


def repeat_words(found: Column) -> Column:
    """Words in eight-word windows that occur twice or more in the text.

    Windows are told apart by 64-bit marks built from those of two and four
    words. A text whose four-word windows all differ needs nothing more.
    """
    none = F.lit(0).cast("long")
    alike = lambda m: F.size(F.array_distinct(m)) < F.size(m)
    wide = lambda four: let(
        _whole(_joined(four, 4), WINDOW), lambda m: F.when(alike(m), _covered(m)).otherwise(none))
    return let(found, lambda w: let(_joined(w, 1), lambda two: let(
        _joined(two, 2), lambda four: F.when(let(_whole(four, 4), alike), wide(four)).otherwise(none))))


def stutters(found: Column) -> Column:
    """Words equal to the word before them."""
    pairs = F.zip_with(found, F.slice(found, 2, F.size(found)), lambda a, b: a == b)
    return F.size(F.filter(pairs, lambda x: F.coalesce(x, F.lit(False)))).cast("long")


# Fixed value: the symbols that junk is full of.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20

#: From (text, words).
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda t, w: F.size(w).cast("long"),
    "word_chars": lambda t, w: F.length(F.array_join(w, "")).cast("long"),
    "n_symbols": lambda t, w: count_of(t, SYMBOLS),
    "n_capitals": lambda t, w: count_of(t, "A-Z"),
    "n_shouts": lambda t, w: count_of(t, "!"),
    "n_dup_lines": lambda t, w: dup_lines(t),
    "n_lines": lambda t, w: F.size(F.split(t, "\n")).cast("long"),
    "n_stutters": lambda t, w: stutters(w),
    "n_repeat_words": lambda t, w: repeat_words(w),
}
REPORTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

RULES = [
    Rule("few_words", lambda m: m("n_words") < LEAST_WORDS),
    Rule("repeats", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("capitals", lambda m: 10 * m("n_capitals") > 5 * m("word_chars")),
    Rule("shouts", lambda m: 10 * m("n_shouts") > 3 * m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words"))),
    Rule("same_lines", lambda m: (m("n_dup_lines") > 3) & (10 * m("n_dup_lines") > 3 * m("n_lines"))),
    Rule("stutters", lambda m: 10 * m("n_stutters") > 3 * m("n_words")),
]
BASE = {"few_words", "repeats"}


def measures(text: Column, found: Column, ready: frozenset[str] = frozenset()) -> Measures:
    """Measures by name; those named in ``ready`` are columns already."""
    return lambda name: F.col(name) if name in ready else MEASURES[name](text, found)


def drawn(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` texts (``t``), each row of the table with the same chance, by a hash of its place."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    chance = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 40))
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"), chance.alias("chance"))
    return written(rows.where(F.col("chance") < int(share * (1 << 40)) + 1).select("t"), "drawn")


def _seconds(sample: DataFrame, work: Column) -> float:
    """How long some work on the sample takes, once its code is compiled."""
    job = sample.select(words(F.col("t")).alias("w"), "t").agg(F.count(F.when(work, 1)))
    job.collect()
    began = time.perf_counter()
    job.collect()
    return time.perf_counter() - began


def rule_order(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Order the rules by rejections per cost, each on what those before it leave of a sample.

    The sample is drawn by hash from the whole table, in one pass over its texts.
    A rule's cost is the time it takes on the sample beyond splitting it into
    words; its rejections are counted there. The driver gets flags of the sample
    alone. Times differ from run to run, and the order with them; it decides what is
    computed, never what is kept. An empty table keeps the given order.
    """
    sample = drawn(docs, text, sample_rows)
    t, w = F.col("t"), F.col("w")
    m = measures(t, w)
    rows = sample.select("t", words(t).alias("w")).select(*[r.rejects(m).alias(f"r{i}") for i, r in enumerate(rules)]).collect()
    if not rows:
        return list(rules)
    split = _seconds(sample, F.size(w) >= 0)
    cost = [max(0.001, _seconds(sample, r.rejects(m)) - split) for r in rules]
    left, todo, order = rows, set(range(len(rules))), []
    while todo:
        gain = {i: sum(bool(r[f"r{i}"]) for r in left) / cost[i] for i in todo}
        best = max(todo, key=lambda i: (gain[i], -cost[i], -i))
        todo.remove(best)
        order.append(rules[best])
        left = [r for r in left if not r[f"r{best}"]]
    return order


def rejected_by(rules: list[Rule], m: Measures) -> Column:
    """The first rule, in the given order, that rejects; later rules are not computed then. Null: kept."""
    out = F.when(F.lit(False), "")
    for rule in rules:
        out = out.when(F.coalesce(rule.rejects(m), F.lit(False)), rule.name)
    return out


def judged(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", out: str = "rejected_by") -> DataFrame:
    """Documents with the name of the rule that rejects them (null: kept), every row and column kept.

    A null text counts as empty, and an empty one has no words. Equal rows get
    equal verdicts. A column already named ``out`` is replaced. Only SQL
    functions: one pass over the rows, no shuffle.
    """
    order = rule_order(docs, rules, text)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # The words are bound inside the one expression: a filter above that Spark moves down computes them once.
    return docs.withColumn(out, let(words(F.col(f"`{text}`")), lambda w: rejected_by(order, measures(t, w))))


def quality_kept(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    out = free_name(docs, "rejected_by")
    return judged(docs, rules, text, out).where(F.col(out).isNull()).drop(out)


def quality_report(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Measures and verdict per document, for all rows of ``docs`` (``doc_id``, ``text``)."""
    order = [r for r in rule_order(docs.select("doc_id", "text"), rules) if r.name not in BASE]
    t, w = F.col("t"), F.col("w")
    measured = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("w", words(t))
        .select("doc_id", "t", "w", *[MEASURES[name](t, w).alias(name) for name in REPORTED])
        .withColumn("base_failed", F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > 30 * n_words"))
    )
    kept = F.when(F.col("base_failed"), False).otherwise(rejected_by(order, measures(t, w, frozenset(REPORTED))).isNull())
    return measured.select("doc_id", *REPORTED, "base_failed", kept.alias("kept"))
