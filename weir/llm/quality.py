"""Quality rules: a learned decision list over statistics of the text.

Sequential covering grows one rule at a time, a conjunction of thresholds, on two thirds of a labelled sample, prunes it on
the last third, takes away what it covers and goes on. The list becomes one conditional expression, in order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.shared import small, staged

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
#: Labelled rows that rules are learned from at most, about; thresholds tried for a statistic; conditions of a rule; rules;
#: and the share of bad rows among those that a rule covers in its pruning part.
SAMPLE, THRESHOLDS, CONDITIONS, RULES, PRECISION = 10_000, 24, 4, 12, 0.9
#: Least number of bad rows that a rule covers while it grows.
COVER = 4
FEATURES = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share"]


#: What statistics() adds.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the shares in FEATURES, of each whole text.
    Columns of these names are replaced; others stay, whatever their names.

    n_repeat_words counts the words in windows of three that the text has more than once. Windows are compared by their
    64-bit hashes: sorted with their places, equal neighbours give the places that repeat, and the words they cover are
    counted from gap to gap. Nothing leaves the row. A null text is like an empty one: all numbers are 0. Repeated rows have
    equal numbers, and an empty table gives an empty one.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rest = [c for c in df.columns if c not in COUNTS and c not in FEATURES]
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__all"), text.alias("__text"))
    out = out.withColumn("__words", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)))
    words = F.col("__words")
    out = out.withColumn("n_words", F.size(words).cast("long"))
    hashes = F.transform(F.slice(words, F.lit(1), F.greatest(F.lit(0), F.size(words) - 2)), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    out = out.withColumn("__h", hashes)
    h = F.col("__h")
    places = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    out = out.withColumn("__p", F.when(F.size(F.array_distinct(h)) < F.size(h), places))
    p = F.col("__p")
    again = F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"]))
    covered = F.aggregate(
        F.array_sort(F.transform(again, lambda x: x["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))
    out = out.withColumn("__lines", lines)
    out = out.withColumns(
        {
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.char_length(F.regexp_replace("__text", SYMBOLS, "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            # the words from each place that repeats up to the next; the last place has all three
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "__upper": F.char_length(F.regexp_replace("__text", "[^A-Z]+", "")),
            "__digit": F.char_length(F.regexp_replace("__text", "[^0-9]+", "")),
            "__n_lines": F.size("__lines"),
        }
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    out = out.withColumns(
        {
            "mean_word": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "__n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share("__upper", "word_chars"),
            "digit_share": share("__digit", "word_chars"),
        }
    )
    return out.select("__all.*", *dict.fromkeys([*COUNTS, *FEATURES]))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_most: bool
    value: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] <= self.value if self.at_most else row[self.feature] > self.value

    def column(self) -> Column:
        return F.col(self.feature) <= self.value if self.at_most else F.col(self.feature) > self.value

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.at_most else '>'} {self.value:g}"


Rule = tuple[Condition, ...]


def _counts(rows: list[dict], rule: Rule) -> tuple[int, int]:
    """(bad, good) rows that a rule covers."""
    covered = [r["bad"] for r in rows if all(c.holds(r) for c in rule)]
    return sum(covered), len(covered) - sum(covered)


def _grow(rows: list[dict]) -> Rule:
    """Adds the condition of the greatest information gain until no good row is covered or nothing gains."""
    rule: Rule = ()
    left = rows
    while len(rule) < CONDITIONS:
        bad = sum(r["bad"] for r in left)
        if not bad or bad == len(left):
            break
        base, best = math.log2(bad / len(left)), (0.0, None)
        for f in FEATURES:
            values = sorted({r[f] for r in left})
            cuts = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
            step = max(1, len(cuts) / THRESHOLDS)
            picked = [cuts[int(i * step)] for i in range(min(len(cuts), THRESHOLDS))]
            ordered = sorted((r[f], r["bad"]) for r in left)
            at, n, b = 0, 0, 0
            for cut in picked:
                while at < len(ordered) and ordered[at][0] <= cut:
                    n, b, at = n + 1, b + ordered[at][1], at + 1
                for at_most, nn, bb in ((True, n, b), (False, len(left) - n, bad - b)):
                    if bb >= COVER and (gain := bb * (math.log2(bb / nn) - base)) > best[0] + 1e-9:
                        best = (gain, Condition(f, at_most, cut))
        if best[1] is None:
            break
        rule += (best[1],)
        left = [r for r in left if best[1].holds(r)]
    return rule


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """The beginning of a rule that is worth most on rows it didn't grow on; the shortest of equal ones."""
    worth = lambda r: (lambda b, g: (b - g) / (b + g) if b + g else -1.0)(*_counts(rows, r))
    return max((rule[:n] for n in range(1, len(rule) + 1)), key=worth) if rule else rule


def learn(rows: list[dict]) -> list[Rule]:
    """An ordered list of rules that call a row bad. rows: FEATURES, bad (0 or 1) and grow, whether a row is in the part that
    rules grow on. A rule that isn't precise enough on the other part ends the list."""
    rules: list[Rule] = []
    while len(rules) < RULES:
        grow, test = ([r for r in rows if r["grow"] == g] for g in (True, False))
        rule = _prune(_grow(grow), test)
        if not rule:
            break
        bad, good = _counts(test, rule)
        if not bad or bad < PRECISION * (bad + good):
            break
        rules.append(rule)
        rows = [r for r in rows if not all(c.holds(r) for c in rule)]
    return rules


def decide(rules: list[Rule]) -> Column:
    """Whether the list keeps a row: the first rule that holds says no, none yes."""
    out = F.lit(True)
    for rule in reversed(rules):
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, F.lit(False)).otherwise(out)
    return out


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """Rules learned from about `sample` labelled rows, chosen by a hash of the id; label 0 is bad."""
    n = labels.count()
    plain = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).where("id is not null and label is not null")
    place = F.pmod(F.xxhash64("id", F.lit("quality sample")), F.lit(1 << 30))
    chosen = plain.where(place < min(1 << 30, -(-(sample << 30) // max(1, n)))).groupBy("id").agg(F.min("label").alias("label")).limit(2 * sample)
    chosen = staged(chosen, "labelled")
    known = statistics(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(small(chosen), "id"))
    cols = [*[F.col(f).cast("double").alias(f) for f in FEATURES], (F.col("label") == 0).cast("int").alias("bad"), (F.pmod(F.xxhash64("id", F.lit("grow")), F.lit(3)) != 0).alias("grow"), "id"]
    rows = sorted((r.asDict() for r in known.select(*cols).limit(4 * sample).collect()), key=lambda r: tuple(r.values()))
    return learn(rows)


def judge(df: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """statistics(df) with base_failed and kept: kept if the fixed limits hold and the learned list keeps the row. Each row
    stands alone; repeated rows are judged alike, and an empty table gives an empty one. Columns named like a result go."""
    named = statistics(df.drop("base_failed", "kept"), text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return named.withColumn("base_failed", failed).withColumn("kept", ~failed & decide(rules))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
