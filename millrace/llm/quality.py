"""Quality rules: a threshold table compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import GAP_PATTERN, WORD_PATTERN, bind, free_name, words

WINDOW = 5
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for on with as be by are this from or an at "
    "der die und das ist zu den ein eine nicht von mit auf für im sich des dem auch "
    "le la les de et que un une du en est pour dans qui par sur pas avec au "
    "el los las y del por con para no se su al lo como más una").split()


@dataclass(frozen=True)
class Rule:
    """A metric must lie within its bounds in documents of ``from_words`` words or more."""
    metric: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


# Documents that fail one of these are rejected; the figures keep terse but clean text.
BASE = (
    Rule("n_words", least=10),
    Rule("repeat_ratio", most=0.20),
)
RULES = (
    Rule("mean_word_chars", least=1.5, most=25),
    Rule("symbol_ratio", most=0.10),
    Rule("shout_ratio", most=0.50),
    Rule("stop_ratio", least=0.01, from_words=100),
    Rule("dup_line_ratio", most=0.50),
)


def _covered(hashes: Column) -> Column:
    """Words within windows whose hash is found more than once."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s):
        same = lambda j, k: F.get(s, j)["h"].eqNullSafe(F.get(s, k)["h"])
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        return F.sort_array(F.transform(twice, lambda j: F.get(s, j)["i"]))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(
        bind(ordered, positions), start,
        lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total")),
        lambda acc: acc["total"])


def _counts(text: Column, word: Column, lines: Column, hashes: Column) -> list[Column]:
    n = F.size(word)
    distinct = F.size(F.array_distinct(hashes))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.regexp_replace(text, GAP_PATTERN, "")),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.when(distinct == F.size(hashes), 0).otherwise(_covered(hashes)),
        "n_lines": F.size(lines),
        "n_shouts": F.regexp_count(text, F.lit("!")),
        "n_stop_words": F.size(F.filter(
            word, lambda x: x.isin(*STOP_WORDS, *[s.capitalize() for s in STOP_WORDS]))),
    }
    return [c.cast("long").alias(name) for name, c in counts.items()]


# What a rule may name: ratios of the counts, 0 where a text has no word or line.
METRICS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "shout_ratio": ("n_shouts", "n_words"),
    "stop_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
}


def _failed(counts: str, rule: Rule) -> Column:
    """Bounds are compared by multiplying out, so that 20 % is exactly 20 %."""
    col = lambda name: F.col(f"`{counts}`.`{name}`")
    if rule.metric in METRICS:
        top, below = map(col, METRICS[rule.metric])
    else:
        top, below = col(rule.metric), F.lit(1)
    parts = lambda bound: F.lit(round(bound * 1000)) * below
    checks = []
    if rule.least is not None:
        checks.append(top * 1000 < parts(rule.least))
    if rule.most is not None:
        checks.append(top * 1000 > parts(rule.most))
    broken = checks[0] if len(checks) == 1 else checks[0] | checks[1]
    return broken & (col("n_words") >= rule.from_words)


def with_quality(docs: DataFrame, text: str = "text", into: str = "quality_report",
                 base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds a struct of counts and verdicts to each row.

    Fields: the counts, ``base_failed``, ``kept`` and ``broken``, the metrics of the
    rules that the text fails. Repeated words are those within windows of five words
    that occur twice or more in the text (compared by a 64-bit hash within one text);
    a duplicate line has a word and equals an earlier line. A null text counts as an
    empty one and fails the base. Rows are never added or lost, so repeated ids stay;
    a column named like ``into`` is replaced. Bounds have three decimals.
    """
    if not (base or rules):
        raise ValueError("no rules")
    kept = [c for c in docs.columns if c.lower() != into.lower()]
    body, word, lines, hashes, counts = (
        free_name(docs, n) for n in ("body__", "word__", "lines__", "hashes__", "counts__"))
    col = lambda name: F.col(f"`{name}`")
    base_failed = F.lit(False)
    for rule in base:
        base_failed |= _failed(counts, rule)
    broken = F.filter(F.array(*[F.when(_failed(counts, r), F.lit(r.metric)) for r in (*base, *rules)]),
                      lambda m: m.isNotNull())
    return (docs
            .withColumn(body, F.coalesce(col(text), F.lit("")))
            .withColumn(word, words(col(body)))
            .withColumns({
                lines: F.filter(F.split(col(body), "\n", -1), lambda x: x.rlike(WORD_PATTERN)),
                hashes: F.when(F.size(col(word)) < WINDOW, F.array().cast("array<bigint>")).otherwise(
                    F.transform(F.sequence(F.lit(0), F.size(col(word)) - WINDOW), lambda i: F.xxhash64(
                        *[F.get(col(word), i + k) for k in range(WINDOW)])))})
            .withColumn(counts, F.struct(*_counts(col(body), col(word), col(lines), col(hashes))))
            .select(*[col(c) for c in kept], F.struct(
                f"`{counts}`.*", base_failed.alias("base_failed"), (F.size(broken) == 0).alias("kept"),
                broken.alias("broken")).alias(into)))


def keep_good(docs: DataFrame, text: str = "text", **tables) -> DataFrame:
    """The rows that pass all rules, with the columns they came with."""
    report, row = free_name(docs, "quality_report"), free_name(docs, "row__")
    # an explode in place of a filter: a filter would be pushed below the counts, and
    # would repeat each count's expression in every rule that uses it
    kept = F.explode(F.when(F.col(f"`{report}`.kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    return with_quality(docs, text, report, **tables).select(
        *[F.col(f"`{c}`") for c in docs.columns], kept.alias(row)).drop(row)
