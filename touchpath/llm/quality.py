"""Quality of documents by weak supervision.

Each rule looks at a few counts of a text and votes: good, bad, or nothing. No rule is taken at its word: expectation
maximisation estimates, without labels, how often each rule votes each way on good and on bad documents, and from
that the probability that a document with given votes is good. The data for the estimate are the numbers of documents
with equal votes, a table of at most 3^rules rows whatever the corpus. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import SPACE, bound, words_of, written

WINDOW = 8  # words that must come again in the same order to count as repeated
SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 20
MOST_REPEATED = 30  # percent of the words

# fixed values: frequent words of the languages met
COMMON = (
    "the of and to in a is that for it as was with be by on not he this are or from at which but have an had they you "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es "
    "de la le et les des en un du une est que dans qui par pour au "
    "el los las y por con una su para del se"
).split()


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated_words(words: Column) -> Column:
    """Words that lie in a run of ``WINDOW`` words met at least twice."""

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)]))

    def places(hashes: Column) -> Column:
        """Starts of the runs met again, in order."""
        numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def met(items: Column) -> Column:
            def again(item: Column, k: Column) -> Column:
                before = (k > 0) & (F.get(items, k - 1)["h"] == item["h"])
                after = (k + 1 < F.size(items)) & (F.get(items, k + 1)["h"] == item["h"])
                return F.when(before | after, item["i"])

            return F.sort_array(F.filter(F.transform(items, again), lambda i: i.isNotNull()))

        return bound(numbered, met)

    def covered(starts: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            end = i + WINDOW
            return F.struct(end.alias("end"), (state["n"] + end - F.greatest(i, state["end"])).alias("n"))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(starts, start, add, lambda state: state["n"])

    def count(hashes: Column) -> Column:
        plain = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(plain, F.lit(0)).otherwise(covered(places(hashes)))

    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(bound(runs(words), count)).cast("bigint")


def measure(documents: DataFrame) -> DataFrame:
    """``documents`` with a struct ``m`` of counts of each text (null: an empty one) after its columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cased = documents.select("*", text.alias("_text"), words_of(text).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")

    def line_counts(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("again"))

    counted = cased.withColumn("_lines", bound(lines, line_counts))
    letters = F.length(_without(F.col("_text"), SPACE))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    counts = {
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": letters.cast("bigint"),
        "n_symbols": (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("bigint"),
        "n_dup_lines": F.col("_lines.again").cast("bigint"),
        "n_repeat_words": _repeated_words(F.col("_words")),
        "n_lines": F.col("_lines.n").cast("bigint"),
        "n_upper": (F.length("_text") - F.length(_without(F.col("_text"), upper))).cast("bigint"),
        "n_marks": (F.length("_text") - F.length(_without(F.col("_text"), "!?"))).cast("bigint"),
        "n_common": F.size(F.array_intersect("_words", F.array(*map(F.lit, COMMON)))).cast("bigint"),
    }
    measured = counted.withColumn("m", F.struct(*[value.alias(name) for name, value in counts.items()]))
    return measured.drop("_text", "_words", "_lines")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def votes(m: str = "m") -> dict[str, Column]:
    """A vote of each rule from the counts: 1 good, -1 bad, 0 none."""
    n, chars = F.col(f"{m}.n_words"), F.col(f"{m}.word_chars")
    symbols, lines = F.col(f"{m}.n_symbols"), F.col(f"{m}.n_lines")
    again, repeated = F.col(f"{m}.n_dup_lines"), F.col(f"{m}.n_repeat_words")
    upper, marks, common = F.col(f"{m}.n_upper"), F.col(f"{m}.n_marks"), F.col(f"{m}.n_common")
    return {
        "length": _vote(n >= FEWEST_WORDS, n < FEWEST_WORDS),
        "word_length": _vote((chars >= 3 * n) & (chars <= 9 * n), (chars < 2 * n) | (chars > 15 * n)),
        "symbols": _vote(100 * symbols <= 2 * n, 100 * symbols > 15 * n),
        "lines": _vote(again == 0, 10 * again > 3 * lines),
        "repeats": _vote(100 * repeated <= 5 * n, 100 * repeated > 25 * n),
        "capitals": _vote(100 * upper <= 10 * chars, 100 * upper > 40 * chars),
        "marks": _vote(100 * marks <= 2 * n, 100 * marks > 15 * n),
        "common": _vote(common >= 3, (common == 0) & (n >= 30)),
    }


def _log_odds(prior: float, tables: dict[str, dict[int, tuple[float, float]]], columns: dict[str, Column]) -> Column:
    """Log odds that a document is good, given its votes."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for rule, table in tables.items():
        vote = columns[rule]
        weight = {v: math.log(good / bad) for v, (good, bad) in table.items()}
        odds = odds + F.when(vote > 0, F.lit(weight[1])).when(vote < 0, F.lit(weight[-1])).otherwise(F.lit(weight[0]))
    return odds


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, rules: list[str], rounds: int = 40, change: float = 1e-4):
    """Prior and, for each rule and vote, its probability on good and on bad documents.

    ``patterns`` has a column per rule and ``n``, the documents with these votes. The start takes a vote against
    a good document to be rare, as the rules are meant; each round is one aggregate over the patterns. Stops when no probability moves by more than
    ``change``, after ``rounds`` rounds at the latest.
    """
    prior = 0.85
    tables = {rule: {1: (0.9, 0.7), 0: (0.099, 0.1), -1: (0.001, 0.2)} for rule in rules}
    columns = {rule: F.col(rule) for rule in rules}
    for _ in range(rounds):
        weighed = patterns.select("*", (F.col("n") * _probability(_log_odds(prior, tables, columns))).alias("_good"))
        sums = [F.sum("n"), F.sum("_good")]
        for rule in rules:
            for vote in (1, 0, -1):
                here = F.col(rule) == vote
                sums += [F.sum(F.when(here, F.col("_good")).otherwise(0.0)), F.sum(F.when(here, F.col("n") - F.col("_good")).otherwise(0.0))]
        total, good, *found = weighed.agg(*sums).first()
        if not total:
            break
        bad, moved = total - good, 0.0
        new_prior = (good + 1) / (total + 2)
        new = {}
        for i, rule in enumerate(rules):
            new[rule] = {}
            for j, vote in enumerate((1, 0, -1)):
                of_good, of_bad = found[6 * i + 2 * j : 6 * i + 2 * j + 2]
                new[rule][vote] = ((of_good + 1) / (good + 3), (of_bad + 1) / (bad + 3))
                moved = max(moved, *[abs(a - b) for a, b in zip(new[rule][vote], tables[rule][vote])])
        moved = max(moved, abs(new_prior - prior))
        prior, tables = new_prior, new
        if moved < change:
            break
    return prior, tables


def judge(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality, kept`` of each row.

    ``quality`` is the probability that the document is good given all rules' votes; it is kept if that is at least
    0.5 and the base rules hold. A null text is an empty one and fails. Repeated rows are judged alike, null ids stay,
    other columns are not looked at; an empty table gives an empty table.
    """
    counted = measure(documents.select("doc_id", "text")).select("doc_id", "m.*")
    counted = written(counted, "counts")
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < FEWEST_WORDS) | (100 * repeated > MOST_REPEATED * n)
    packed = counted.select("*", F.struct(*[c for c in counted.columns if c != "doc_id"]).alias("m"))
    voted = packed.select("*", *[vote.alias(f"v_{rule}") for rule, vote in votes().items()])
    rules = [f"v_{rule}" for rule in votes()]
    patterns = written(voted.groupBy(*rules).agg(F.count("*").alias("n")), "votes")
    prior, tables = estimate(patterns, rules)
    quality = _probability(_log_odds(prior, tables, {rule: F.col(rule) for rule in rules}))
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), quality.alias("quality"), (~failed & (quality >= 0.5)).alias("kept"),
    )
