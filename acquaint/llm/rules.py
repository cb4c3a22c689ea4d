"""Quality rules: base limits, and a decision list learned from labelled statistics.

Counts of every text (words, symbols, repeated lines and windows) give measures on
fixed whole-number scales. Rules are conjunctions of thresholds on measures, learned
by sequential covering:

1. Grow: from the labelled rows that no rule covers yet, take the threshold with
   the largest gain of information about the sought label, then the next one among
   the rows it leaves, until only sought rows are left.
2. Prune: the end of the conjunction that does not help on rows kept aside for
   this is cut off. A rule that is then too often wrong ends the list.
3. Cover: rows that meet the rule are set aside, and the next rule is grown.

The list is an ordered Spark conditional expression. Everything here is built from
Spark's own functions: each step is one aggregation of the labelled rows into a
histogram of bounded size, by which the driver chooses the next threshold.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acquaint.llm.shared import written

#: Characters that end words, as Spark SQL text.
_SPACES = " \t\n\x0b\x0c\r"

SYMBOLS = "#*$%&|<>"

#: Marks that prose holds few of, besides the symbols.
MARKS = "!?;:/\\@^_~`+=(){}[]\""

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"

#: Bins of a measure are 0 to this.
LAST_BIN = 1000


@dataclass(frozen=True)
class Learning:
    """Bounds of the list, and the precision a rule needs on rows it was not grown on."""

    rules: int = 16
    conditions: int = 4
    precision: float = 0.8
    #: Sought rows that a rule covers at least when it is grown.
    support: int = 2


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    bin: int

    def column(self) -> Column:
        return F.col(self.measure) > self.bin if self.above else F.col(self.measure) <= self.bin

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.bin}"


Rule = tuple[Condition, ...]


def meets(rule: Rule) -> Column:
    return reduce(and_, (c.column() for c in rule), F.lit(True))


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row that meets one has the label sought, others have the other."""

    sought: int
    rules: tuple[Rule, ...]

    def number(self) -> Column:
        """The number, from 1, of the first rule that a row of measures meets, or null."""
        found = F.lit(None).cast("int")
        for n, rule in reversed(list(enumerate(self.rules, 1))):
            found = F.when(meets(rule), F.lit(n)).otherwise(found)
        return found

    def label(self) -> Column:
        return F.when(self.number().isNotNull(), self.sought).otherwise(1 - self.sought)

    def __str__(self) -> str:
        lines = [f"if {' and '.join(map(str, r))} then {self.sought}" for r in self.rules]
        return "\n".join([*lines, f"else {1 - self.sought}"])


#: Keeps everything: what is learned without rows of both labels.
NO_RULES = DecisionList(0, ())


def _class(characters: str) -> str:
    """What a regular expression's brackets hold for these characters."""
    return "".join(c if c.isalnum() else f"\\{c}" for c in characters)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def counts(documents: DataFrame) -> DataFrame:
    """doc_id and counts of every text; a null text is empty.

    Words are runs of characters other than ASCII white space. n_repeat_words are
    the words in three-word windows that occur twice or more in the text, compared
    as text; n_dup_lines the lines with a word that equal an earlier one. A text's
    words are held together with a hash of each window, a few hundred bytes a word.

    Each step names what the next uses more than once, so that Spark keeps them
    apart, makes each list once and compiles all but the lambdas.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = SYMBOLS + MARKS + _CAPITALS + _DIGITS
    lists = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.array_remove(F.split(text, f"[{_class(_SPACES)}]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(_SPACES)) != "").alias("lines"),
        # Few characters of prose: one pass leaves them, the others read no more.
        F.regexp_replace(text, f"[^{_class(counted)}]+", "").alias("counted"),
    )
    hashed = lists.withColumn("hashes", _window_hashes(F.col("words")))
    sorted_ = hashed.withColumn("keys", _sorted_keys(F.col("hashes")))
    shared = sorted_.withColumn("shared", _shared(F.col("keys")))
    read = shared.withColumn("windows", _window_texts(F.col("words"), F.col("shared")))
    values = {
        "n_words": F.size("words"),
        "n_distinct": F.size(F.array_distinct("words")),
        "n_repeat_words": _covered(_equal_places(F.col("windows"), F.col("shared"))),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": _count(F.col("counted"), SYMBOLS),
        "n_marks": _count(F.col("counted"), MARKS),
        "n_capitals": _count(F.col("counted"), _CAPITALS),
        "n_digits": _count(F.col("counted"), _DIGITS),
    }
    return read.select("doc_id", *[c.cast("long").alias(name) for name, c in values.items()])


#: Low bits of a key that hold a window's place; a Java array has no more elements.
_PLACE_BITS = 31


def _window_hashes(words: Column) -> Column:
    """A hash of each three-word window, in order."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def _sorted_keys(hashes: Column) -> Column:
    """The last 33 bits of each hash with its place, sorted; nothing if no hash repeats."""
    keys = F.transform(hashes, lambda h, i: F.shiftleft(h, _PLACE_BITS).bitwiseOR(i.cast("long")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(keys)).otherwise(
        F.array().cast("array<long>")
    )


def _hash(key: Column) -> Column:
    return F.shiftright(key, _PLACE_BITS)


def _place(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1).cast("long")).cast("int")


def _shared(keys: Column) -> Column:
    """Of sorted keys, those whose part of a hash another one has too."""

    def beside(key: Column, i: Column) -> Column:
        return (_hash(key) == _hash(F.get(keys, i - 1))) | (_hash(key) == _hash(F.get(keys, i + 1)))

    return F.filter(keys, beside)


def _window_texts(words: Column, keys: Column) -> Column:
    return F.transform(
        keys, lambda key: F.concat_ws(" ", *[F.get(words, _place(key) + k) for k in range(3)])
    )


def _equal_places(texts: Column, keys: Column) -> Column:
    """Places of the windows whose text another window of these has too.

    Where there are as many texts as hashes, those with one hash are equal. Else
    the texts are sorted.
    """

    windows = F.transform(keys, lambda key, i: F.struct(F.get(texts, i).alias("text"), _place(key).alias("at")))
    # Bound to a name, so that the list is sorted once.
    found = F.transform(F.array(F.sort_array(windows)), _beside_equal)[0]
    hashes = F.transform(keys, _hash)
    return F.when(
        F.size(F.array_distinct(texts)) == F.size(F.array_distinct(hashes)), F.transform(keys, _place)
    ).otherwise(found)


def _beside_equal(windows: Column) -> Column:
    """Places of windows that stand beside an equal one in sorted order."""

    def equal(w: Column, i: Column) -> Column:
        before, after = F.get(windows, i - 1), F.get(windows, i + 1)
        return (w["text"] == before["text"]) | (w["text"] == after["text"])

    return F.transform(F.filter(windows, equal), lambda w: w["at"])


def _covered(places: Column) -> Column:
    """Words in the windows at these places."""
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda at: F.array(at, at + 1, at + 2)))))


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _share(n: str, of: str) -> Column:
    return F.coalesce(F.try_divide(F.col(n), F.col(of)), F.lit(0.0))


MEASURES = (
    "symbols", "marks", "capitals", "digits", "repeated_lines", "repeated_windows", "variety",
    "word_length", "line_length", "length",
)


def measures() -> dict[str, Column]:
    """Bins of the measures of a row of counts; shares in thousandths."""
    values = [
        1000 * _share("n_symbols", "word_chars"),
        1000 * _share("n_marks", "word_chars"),
        1000 * _share("n_capitals", "word_chars"),
        1000 * _share("n_digits", "word_chars"),
        1000 * _share("n_dup_lines", "n_lines"),
        1000 * _share("n_repeat_words", "n_words"),
        1000 * _share("n_distinct", "n_words"),
        20 * _share("word_chars", "n_words"),
        50 * F.log2(1 + _share("n_words", "n_lines")),
        50 * F.log2(1 + F.col("n_words")),
    ]
    return {
        name: F.least(F.floor(value), F.lit(LAST_BIN)).cast("int")
        for name, value in zip(MEASURES, values, strict=True)
    }


def learn(rows: DataFrame, label: str = "label", learning: Learning = Learning()) -> DecisionList:
    """The list learned from rows with a label of 0 or 1, their measures and doc_id.

    The rarer label is the one sought, 0 if both are as frequent. A third of the
    rows, by a hash of their doc_id, is kept aside to prune. Rows without a label
    are left out; without rows of both labels there are no rules and label 1 is
    the one that all rows get.
    """
    rows = written(
        rows.where(F.col(label).isNotNull()).select(
            F.col(label).cast("int").alias("label"),
            (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0).alias("aside"),
            *MEASURES,
        ),
        "labelled",
    )
    there = dict(rows.groupBy("label").count().collect())
    if set(there) != {0, 1}:
        return NO_RULES
    sought = 0 if there[0] <= there[1] else 1
    rows = rows.withColumn("sought", F.col("label") == sought)
    rules: list[Rule] = []
    while len(rules) < learning.rules:
        left = rows.where(~reduce(lambda a, r: a | meets(r), rules, F.lit(False)))
        rule = _pruned(_grown(left.where(~F.col("aside")), learning), left.where("aside"), learning)
        if not rule:
            break
        rules.append(rule)
    return DecisionList(sought, tuple(rules))


def _grown(rows: DataFrame, learning: Learning) -> Rule:
    rule: Rule = ()
    while len(rule) < learning.conditions:
        condition = best_condition(histogram(rows.where(meets(rule))), learning.support)
        if condition is None:
            break
        rule += (condition,)
    return rule


def histogram(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    """Sought and other rows in each bin of each measure: at most
    ``LAST_BIN + 1`` bins for each of the measures."""
    bins = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("bin")) for m in MEASURES])
    counted = (
        rows.select(F.inline(bins), "sought")
        .groupBy("measure", "bin")
        .agg(F.count_if("sought").alias("p"), F.count_if(~F.col("sought")).alias("n"))
    )
    found: dict[str, dict[int, tuple[int, int]]] = defaultdict(dict)
    for measure, bin_, p, n in counted.collect():
        found[measure][bin_] = (p, n)
    return found


def best_condition(bins: dict[str, dict[int, tuple[int, int]]], support: int) -> Condition | None:
    """The threshold with the largest gain; of equal ones that on the first measure,
    with the lowest bin. It lies halfway to the next bin that holds rows. None if
    only sought rows are left, or nothing is gained."""
    best, most = None, 0.0
    for measure in MEASURES:
        here = sorted(bins.get(measure, {}).items())
        whole_p, whole_n = (sum(x[k] for _, x in here) for k in (0, 1))
        if not whole_p or not whole_n:
            return None
        p = n = 0
        for (bin_, (more_p, more_n)), (next_, _) in zip(here, here[1:]):
            p, n = p + more_p, n + more_n
            for above, (a, b) in ((False, (p, n)), (True, (whole_p - p, whole_n - n))):
                if a < support:
                    continue
                gain = a * (math.log2(a / (a + b)) - math.log2(whole_p / (whole_p + whole_n)))
                if gain > most + 1e-9:
                    best, most = Condition(measure, above, (bin_ + next_) // 2), gain
    return best


def _pruned(rule: Rule, aside: DataFrame, learning: Learning) -> Rule:
    """The beginning of the rule that does best on rows kept aside, of equal ones the
    shortest; nothing if even that is too often wrong."""
    if not rule:
        return ()
    heads = [rule[:n] for n in range(1, len(rule) + 1)]
    sums = aside.agg(
        *[F.count_if(meets(h) & F.col("sought")) for h in heads],
        *[F.count_if(meets(h) & ~F.col("sought")) for h in heads],
    ).first()
    right, wrong = sums[: len(heads)], sums[len(heads) :]
    worth = [(p - n) / (p + n) if p + n else 0.0 for p, n in zip(right, wrong)]
    at = worth.index(max(worth))
    if right[at] + wrong[at] and right[at] / (right[at] + wrong[at]) < learning.precision:
        return ()
    return heads[at]


def labelled_measures(counted: DataFrame, labels: DataFrame, learned_from: Column) -> DataFrame:
    """Measures with a label, of rows that the base limits pass and the condition names.

    A doc_id with two different labels, or none, teaches nothing. Labels are joined
    by doc_id, one row each.
    """
    one = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .where("label = most")
        .drop("most")
    )
    rows = counted.where(~base_failed() & learned_from).join(one, "doc_id")
    return rows.select("doc_id", "label", *[c.alias(m) for m, c in measures().items()])


def judge(counted: DataFrame, rules: DecisionList) -> DataFrame:
    """doc_id, the counts of the base, base_failed, kept and rule of every row.

    ``kept`` is false where the base limits fail or the list gives label 0;
    ``rule`` numbers the rule that decided, null if none did.
    """
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = counted.select(
        "doc_id", *base, base_failed().alias("base_failed"), *[c.alias(m) for m, c in measures().items()]
    )
    kept = ~F.col("base_failed") & (rules.label() == 1)
    rule = F.when(~F.col("base_failed"), rules.number())
    return rows.select("doc_id", *base, "base_failed", kept.alias("kept"), rule.alias("rule"))


def judge_documents(
    documents: DataFrame, labels: DataFrame, learned_from: Column, learning: Learning = Learning()
) -> tuple[DataFrame, DecisionList]:
    """The verdict on every document, and the list learned from those with labels.

    A null or empty text has no words and fails the base. Equal rows get equal
    verdicts; a null doc_id is never learned from. An empty table gives no rows.
    Other columns are ignored.
    """
    counted = written(counts(documents), "counts")
    rules = learn(labelled_measures(counted, labels, learned_from), learning=learning)
    return judge(counted, rules), rules
