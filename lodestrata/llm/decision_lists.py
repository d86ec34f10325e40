"""Quality rules as learned decision lists, by DataFrame functions only.

Statistics of whole texts are Column expressions. From labelled rows, sequential covering grows one conjunction of thresholds
at a time on one part of the rows, prunes it on another and takes what it covers out, until no rule is better than chance. The
result is an ordered list of conditions that becomes one conditional expression. Learning looks at all labelled rows, but only
through histograms of the statistics, so what reaches the driver is as large as cuts times statistics.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import stored

# White space between words, signs that count as symbols, and when a text fails outright.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
#: Quantiles per statistic and label between which cuts are looked for, conditions of a rule, rules of a list.
QUANTILES = 32
MOST_CONDITIONS = 4
MOST_RULES = 16


def _repeated_words(found: Column) -> Column:
    """How many words lie in three-word windows that are found again: from (window, place) in sorted order, the places of
    windows that have an equal neighbour, and of each place the words up to the next."""
    same = lambda e, i: (e["w"] == F.get(found, i - 1)["w"]) | (e["w"] == F.get(found, i + 1)["w"])
    return F.sort_array(F.transform(F.filter(found, lambda e, i: F.coalesce(same(e, i), F.lit(False))), lambda e: e["i"]))


def counted(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and COUNTS, all long, of each row's whole text; a null text is an empty one.

    Words are runs of what is not ASCII white space; `word_chars` are code points in words; `n_lines` are lines with a word and
    `n_dup_lines` those that equal an earlier one; windows of three words are compared by their 64-bit hashes.
    """
    plain = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    parts = plain.select(
        "doc_id",
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "").alias("_lines"),
    )
    # Steps are columns of their own, and each is used more than once, so that none is computed again per element.
    hashed = parts.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    last = F.size("_hashes") - 2
    window = lambda i: F.xxhash64(F.get("_hashes", i), F.get("_hashes", i + 1), F.get("_hashes", i + 2))
    windows = F.when(last > 0, F.transform(F.sequence(F.lit(0), last - 1), window)).otherwise(F.array().cast("array<long>"))
    windowed = hashed.withColumn("_windows", windows)
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    sorted_ = windowed.withColumn("_sorted", F.when(again, placed))
    places = sorted_.withColumn("_places", _repeated_words(F.col("_sorted")))
    steps = F.transform("_places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_places", i + 1) - p, F.lit(3))))
    return places.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s), F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """What rules may speak about; shares are of at least one word or line, so none is null."""
    words, lines = (F.greatest(F.col(c), F.lit(1).cast("long")) for c in ("n_words", "n_lines"))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "words_per_line": F.col("n_words") / lines,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut!r}"

    def column(self, features: Mapping[str, Column]) -> Column:
        return features[self.feature] > self.cut if self.above else features[self.feature] <= self.cut


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the verdict is `keep`."""

    conditions: tuple[Condition, ...]
    keep: bool

    def column(self, features: Mapping[str, Column]) -> Column:
        both = F.lit(True)
        for c in self.conditions:
            both = both & c.column(features)
        return both


@dataclass(frozen=True)
class DecisionList:
    """The first rule that holds decides; where none does, `default`."""

    rules: tuple[Rule, ...] = ()
    default: bool = True

    def column(self, features: Mapping[str, Column]) -> Column:
        verdict = None
        for r in self.rules:
            holds = r.column(features)
            verdict = F.when(holds, F.lit(r.keep)) if verdict is None else verdict.when(holds, F.lit(r.keep))
        return F.lit(self.default) if verdict is None else verdict.otherwise(F.lit(self.default))

    def __str__(self) -> str:
        lines = [f"WHEN {' AND '.join(map(str, r.conditions))} THEN {str(r.keep).lower()}" for r in self.rules]
        return "\n".join(["CASE", *lines, f"ELSE {str(self.default).lower()} END"]) if lines else str(self.default).lower()


@dataclass
class _Counts:
    """Kept and rejected rows per place among the cuts of each statistic."""

    of: dict[str, list[tuple[int, int]]] = field(default_factory=dict)

    @property
    def total(self) -> tuple[int, int]:
        some = next(iter(self.of.values()), [])
        return sum(k for k, _ in some), sum(r for _, r in some)


def cuts_of(rows: DataFrame, names: Sequence[str]) -> dict[str, list[float]]:
    """Cuts per statistic: the middles between neighbours among the quantiles of either label."""
    shares = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)])
    wanted = [F.percentile_approx(F.when(F.col("label") == y, F.col(n)), shares).alias(f"{n}_{y}") for n in names for y in (0, 1)]
    found = rows.agg(*wanted).first()
    cuts = {}
    for n in names:
        values = sorted({v for y in (0, 1) for v in found[f"{n}_{y}"] or ()})
        cuts[n] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return cuts


def binned(rows: DataFrame, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """One row per combination of places among the cuts (columns named like the statistics) and `prune`, with the number of kept
    and rejected rows. A place is the number of cuts below the value."""

    def place(name: str) -> Column:
        below = F.filter(F.array(*map(F.lit, cuts[name])).cast("array<double>"), lambda cut: cut < F.col(name))
        return F.size(below).alias(name)

    return (
        rows.select("label", "prune", *map(place, cuts))
        .groupBy("prune", *cuts)
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
    )


def _holds(conditions: Sequence[Condition], cuts: Mapping[str, Sequence[float]]) -> Column:
    """Conditions over places among the cuts."""
    both = F.lit(True)
    for c in conditions:
        at = list(cuts[c.feature]).index(c.cut)
        both = both & (F.col(c.feature) > at if c.above else F.col(c.feature) <= at)
    return both


def _histograms(bins: DataFrame, cuts: Mapping[str, Sequence[float]]) -> _Counts:
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("place")) for n in cuts]))
    found = bins.select(each.alias("_e"), "good", "bad").groupBy("_e.name", "_e.place").agg(F.sum("good"), F.sum("bad")).collect()
    counts = _Counts({n: [(0, 0)] * (len(c) + 1) for n, c in cuts.items()})
    for name, place, good, bad in found:
        counts.of[name][place] = (good, bad)
    return counts


def _information(hit: int, miss: int) -> float:
    return math.log2(hit / (hit + miss)) if hit else -math.inf


def best_condition(counts: _Counts, cuts: Mapping[str, Sequence[float]], keep: bool) -> tuple[float, Condition] | None:
    """The condition of the largest information gain for the label `keep`; ties go to the first statistic and the least cut."""
    hits, misses = counts.total if keep else counts.total[::-1]
    best = None
    for name in cuts:
        below = [0, 0]
        for cut, (good, bad) in zip(cuts[name], counts.of[name]):
            below = [b + x for b, x in zip(below, (good, bad) if keep else (bad, good))]
            for above in (False, True):
                hit, miss = (hits - below[0], misses - below[1]) if above else below
                if hit and (hit, miss) != (hits, misses):
                    gain = hit * (_information(hit, miss) - _information(hits, misses))
                    if gain > 0 and (best is None or gain > best[0]):
                        best = gain, Condition(name, above, cut)
    return best


def _grown(bins: DataFrame, cuts: Mapping[str, Sequence[float]], keep: bool, counts: _Counts) -> list[Condition]:
    """Conditions are added while they make the rule purer."""
    conditions: list[Condition] = []
    while len(conditions) < MOST_CONDITIONS:
        found = best_condition(counts, cuts, keep)
        if found is None:
            break
        conditions.append(found[1])
        if len(conditions) < MOST_CONDITIONS:
            counts = _histograms(bins.filter(_holds(conditions, cuts)), cuts)
            if not counts.total[0 if not keep else 1]:
                break
    return conditions


def _pruned(bins: DataFrame, cuts: Mapping[str, Sequence[float]], keep: bool, conditions: list[Condition]) -> tuple[list[Condition], float]:
    """The shortest beginning of the conditions with the largest share of hits, and that share (0 if nothing is covered)."""
    lengths = range(1, len(conditions) + 1)
    sums = [
        F.sum(F.when(_holds(conditions[:n], cuts), F.col(c))).alias(f"{c}{n}")
        for n in lengths
        for c in ("good", "bad")
    ]
    row = bins.agg(*sums).first()
    best = (conditions, 0.0)
    for n in lengths:
        hit, miss = (row[f"{c}{n}"] or 0 for c in (("good", "bad") if keep else ("bad", "good")))
        share = hit / (hit + miss) if hit else 0.0
        if share > best[1]:
            best = conditions[:n], share
    return best


def learn(rows: DataFrame, folder: str) -> DecisionList:
    """The list that `rows` teach: `features()` as columns, `label` (1 good, 0 bad) and `prune` (whether the row prunes or grows).

    Each round speaks for the label that fewer of the rows left have; the other is the verdict where no rule holds. A rule must
    be right on more than half of the rows that prune it (of those that grew it, where none prunes). Without rows all is kept.
    The rows' places among the cuts are stored in `folder`.
    """
    names = list(features())
    cuts = cuts_of(rows, names)
    bins = stored(binned(rows, cuts), f"{folder}/places")
    rules: list[Rule] = []
    default = True
    while True:
        growing = bins.filter(~F.col("prune"))
        counts = _histograms(growing, cuts)
        good, bad = counts.total
        if not good or not bad or len(rules) == MOST_RULES:
            default = good >= bad if good or bad or not rules else default
            return DecisionList(tuple(rules), default)
        default = good >= bad
        conditions = _grown(growing, cuts, not default, counts)
        shorter, share = _pruned(bins.filter("prune"), cuts, not default, conditions) if conditions else ([], 0.0)
        if conditions and not share:
            shorter, share = _pruned(growing, cuts, not default, conditions)
        if share <= 0.5:
            return DecisionList(tuple(rules), default)
        rules.append(Rule(tuple(shorter), not default))
        bins = bins.filter(~_holds(shorter, cuts))


def training_rows(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows to learn from: those of `counts` (doc_id, COUNTS) that do not fail outright and whose id has a quality label.

    Ids whose crc32 modulo 4 is 2 are left out, so that they can be judged with; those of remainder 3 prune. Labels other
    than 0 and 1 teach nothing; of repeated labels each teaches.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("_doc"), F.col("quality").cast("long").alias("label"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    admitted = counts.filter(~base_failed() & (fold != 2)).select("doc_id", (fold == 3).alias("prune"), *(f.alias(n) for n, f in features().items()))
    return admitted.join(known, F.col("doc_id") == F.col("_doc")).drop("_doc", "doc_id")


def quality_rules(docs: DataFrame, labels: DataFrame, folder: str) -> tuple[DataFrame, DecisionList]:
    """Per row of `docs` (doc_id, text): doc_id, COUNTS, `base_failed` and `kept`; and the list that was learned.

    Null and empty texts have no words and fail; rows of one id are judged each; other columns are not looked at. Without
    labels all rows that do not fail are kept. Statistics are stored in `folder` once and learned from there.
    """
    counts = stored(counted(docs), f"{folder}/counts")
    rules = learn(training_rows(counts, labels), folder)
    failed = base_failed()
    verdict = F.when(failed, F.lit(False)).otherwise(rules.column(features()))
    return counts.select("*", failed.alias("base_failed"), verdict.alias("kept")), rules
