"""Quality rules: statistics of texts, and decision lists learned from labelled statistics.

Statistics are DataFrame functions over arrays of one row; no text is exploded or shuffled. A decision list is learned by
sequential covering: a rule is a conjunction of thresholds on statistics, grown on two thirds of the labelled rows by
information gain while it covers good rows, pruned on the other third by the worth of its last conditions, and kept if
it is precise enough there; the rows that it covers leave and the next rule is learned. The list becomes one nested
conditional expression.

Learning takes at most ``max_rows`` labelled rows (their few numbers come to the driver), drawn by a hash of the id;
statistics and decisions cover all rows and whole texts. Null texts have no words. Without labels of both kinds the list is
empty and keeps everything. Labels that repeat an id count once (the smallest); null labels do not count.
An empty table gives no rows; columns of ``carry`` named like a statistic are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpour.llm.store import written

MAX_ROWS = 20_000
_SPACE = r"[\x20\x09-\x0D]+"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks"]

#: What rules look at, from the statistics of a row.
MEASURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
}


def statistics(docs: DataFrame, text_column: str, carry: list[str]) -> DataFrame:
    """The columns of ``carry`` with STATISTICS (long)."""
    names = [F.col(f"`{name}`") for name in carry if name not in STATISTICS]
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    first = docs.select(
        *names,
        F.array_remove(F.split(text, _SPACE), "").alias("__words"),
        lines.alias("__lines"),
        (F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.char_length(text) - F.char_length(F.translate(text, " \t\n\x0b\x0c\r", ""))).alias("__spaces"),
        F.char_length(text).alias("__chars"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        (F.char_length(text) - F.char_length(F.translate(text, "!?", ""))).cast("long").alias("n_marks"),
    )
    size = F.size("__words")
    word = lambda i: F.get("__words", i)
    windows = F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    second = first.select(
        *names,
        size.cast("long").alias("n_words"),
        (F.col("__chars") - F.col("__spaces")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__lines").cast("long").alias("n_lines"),
        "n_capitals",
        "n_marks",
        F.when(size >= 3, windows).otherwise(F.lit([]).cast("array<bigint>")).alias("__windows"),
    )
    # Windows in order of hash; those that a neighbour equals are repeated, and their places are where words repeat.
    placed = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size("__windows") > F.size(F.array_distinct("__windows"))
    rest = [name for name in STATISTICS if name != "n_repeat_words"]
    third = second.select(*names, *rest, F.when(repeats, F.array_sort(placed)).alias("__sorted"))
    near = lambda k: F.get("__sorted", k)["h"]
    same = F.filter("__sorted", lambda x, k: x["h"].eqNullSafe(near(k - 1)) | x["h"].eqNullSafe(near(k + 1)))
    fourth = third.select(*names, *rest, F.array_sort(F.transform(same, lambda x: x["i"])).alias("__places"))
    covered = F.aggregate(
        "__places",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total")),
        lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(3), p - acc["last"])).alias("total")),
        lambda acc: acc["total"],
    )
    return fourth.select(*names, *rest, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(MEASURES[self.measure])
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def holds(self, row: dict) -> bool:
        return row[self.measure] >= self.threshold if self.above else row[self.measure] < self.threshold


Rule = tuple[Condition, ...]


def verdict(rules: list[Rule]) -> Column:
    """True for rows that no rule rejects, as one conditional expression in the order of the rules."""
    kept = F.lit(True)
    for rule in reversed(rules):
        condition = F.lit(True)
        for part in rule:
            condition = condition & part.column()
        kept = F.when(condition, F.lit(False)).otherwise(kept)
    return kept


def learn(stats: DataFrame, labels: DataFrame, id_column: str, label_column: str, max_rows: int = MAX_ROWS) -> list[Rule]:
    """A decision list that rejects rows of label 0."""
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("__id")).agg(F.min(label_column).alias("label"))
    total = known.count()
    share = min(1.0, max_rows / max(total, 1))
    drawn = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    measures = [F.expr(sql).cast("double").alias(name) for name, sql in MEASURES.items()]
    found = stats.join(drawn, stats[id_column] == drawn["__id"]).select("__id", "label", *measures).limit(2 * max_rows)
    rows = sorted((row.asDict() for row in found.collect()), key=lambda row: tuple(map(str, row.values())))
    return cover(rows)


def cover(rows: list[dict], precision: float = 0.95, most_rules: int = 20, most_conditions: int = 3) -> list[Rule]:
    """Rules in the order in which they were learned."""
    grow = [row for k, row in enumerate(rows) if k % 3]
    prune = rows[::3]
    rules: list[Rule] = []
    for _ in range(most_rules):
        rule = _pruned(_grown(grow, most_conditions), prune)
        if not rule:
            break
        hit = [row for row in prune if all(part.holds(row) for part in rule)]
        if hit and sum(row["label"] == 0 for row in hit) >= precision * len(hit):
            rules.append(rule)
        # A rule that does not hold up is not used, but what it covered does not hide other rules.
        grow = [row for row in grow if not all(part.holds(row) for part in rule)]
        prune = [row for row in prune if not all(part.holds(row) for part in rule)]
    return rules


def _grown(rows: list[dict], most: int) -> Rule:
    rule: list[Condition] = []
    while len(rule) < most:
        bad = sum(row["label"] == 0 for row in rows)
        if not bad or bad == len(rows):
            break
        before, best = math.log2(bad / len(rows)), (1e-9, None)
        for measure in MEASURES:
            values = sorted((row[measure], row["label"] == 0) for row in rows)
            below = bad_below = 0
            for k, (value, is_bad) in enumerate(values):
                if k and value > values[k - 1][0]:
                    for above, n, p in ((False, below, bad_below), (True, len(rows) - below, bad - bad_below)):
                        gain = p * (math.log2(p / n) - before) if p else 0.0
                        if gain > best[0]:
                            best = (gain, Condition(measure, above, (value + values[k - 1][0]) / 2))
                below += 1
                bad_below += is_bad
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [row for row in rows if best[1].holds(row)]
    return tuple(rule)


def _pruned(rule: Rule, rows: list[dict]) -> Rule:
    """The rule without the last conditions, if it is worth more so on rows that it was not grown on."""

    def worth(short: Rule) -> float:
        hit = [row["label"] == 0 for row in rows if all(part.holds(row) for part in short)]
        return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def judge(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """id, STATISTICS, base_failed (too short or too repetitive) and kept of each row."""
    stats = written(statistics(docs, text_column, [id_column]), "quality-statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = stats.withColumn("base_failed", failed)
    rules = learn(judged.where("not base_failed"), labels, id_column, label_column)
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules))
