"""Quality rules by weak supervision (operator 1, native).

Each rule looks at counts of a whole text and votes good (1), bad (-1) or abstains (0).
The rules' votes are grouped: at most 3^rules vote patterns exist, whatever the number
of documents, and only their counts come to the driver. Expectation-maximisation over
the patterns estimates for each rule how often it votes good and bad among good and
among bad documents (its accuracies) and the share of good documents. A document is
kept when its posterior probability of being good is at least 0.5 and it doesn't fail
the base rules.

Defined results: a null or empty text has no words, fails the base and is not kept;
repeated rows are judged alike; an empty table gives an empty result; columns of the
input whose names clash are not read (``judge``) or kept as they are (``keep_good``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm._common import WORD, cut

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SHIFT = 24  # bits of a word position in a packed key
ROUNDS = 15

# Each rule: (name, bad if, good if) over the counts of ``features``; neither: abstain.
# Ratios are whole-number comparisons, so both SQL dialects agree on every row.
RULES = (
    ("symbols", "10 * n_symbols > 3 * n_words", "100 * n_symbols <= n_words"),
    ("repetition", "4 * n_repeat_words > n_words", "20 * n_repeat_words <= n_words"),
    ("capitals", "3 * n_capitals > word_chars", "8 * n_capitals <= word_chars"),
    ("exclamations", "4 * n_exclaims > n_words", "50 * n_exclaims <= n_words"),
    ("repeated lines", "3 * n_dup_lines > n_lines", "n_dup_lines = 0"),
    ("word length", "word_chars > 12 * n_words OR word_chars < 2 * n_words", "FALSE"),
    ("sentences", "100 * n_stops < n_words", "30 * n_stops >= n_words"),
    ("symbol share", "20 * n_symbols > word_chars", "500 * n_symbols <= word_chars"),
)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words from ``_words``: words inside 3-word windows that occur twice or more.

    A window's hash (40 bits) and place (24 bits) are packed into one long, so the
    windows of a text sort as plain longs and equal windows become neighbours. The words
    of equal neighbours are compared; a text where two different windows share a
    hash, or with more words than 24 bits count, takes the exact path over the strings.
    """
    n = F.size("_words")
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    w = F.col("_words")
    window = lambda i: [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]
    df = df.withColumn("_packed", F.sort_array(F.transform(
        starts, lambda i: F.shiftleft(F.xxhash64(*window(i)), _SHIFT).bitwiseOR(i.cast("long")))))
    key = lambda e: F.shiftright(e, _SHIFT)
    place = lambda e: e.bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int")
    s = F.col("_packed")
    same = lambda i, e: F.coalesce(key(F.get(s, i)) == key(e), F.lit(False))
    df = df.withColumn("_equal", F.filter(s, lambda e, i: same(i - 1, e) | same(i + 1, e)))
    q = F.col("_equal")
    differs = lambda a, b: F.struct(*window(place(a))) != F.struct(*window(place(b)))
    clash = F.exists(
        F.sequence(F.lit(1), F.size(q) - 1),
        lambda i: (key(F.get(q, i)) == key(F.get(q, i - 1))) & differs(F.get(q, i), F.get(q, i - 1)),
    )
    df = df.withColumn("_clash", (n >= (1 << _SHIFT)) | ((F.size(q) > 1) & clash))
    # The exact path: windows as structs of words and place.
    full = F.when(F.col("_clash"), F.array_sort(F.transform(
        starts, lambda i: F.struct(*[x.alias(f"w{k}") for k, x in enumerate(window(i))], i.alias("at")))))
    df = df.withColumn("_full", full)
    f = F.col("_full")
    text = lambda e: F.struct(e["w0"], e["w1"], e["w2"])
    alike = lambda i, e: F.coalesce(text(F.get(f, i)) == text(e), F.lit(False))
    exact = F.transform(F.filter(f, lambda e, i: alike(i - 1, e) | alike(i + 1, e)), lambda e: e["at"])
    df = df.withColumn("_places", F.sort_array(F.when(F.col("_clash"), exact).otherwise(F.transform(q, place))))
    p = F.col("_places")
    covered = F.transform(p, lambda e, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - e, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", total).drop("_packed", "_equal", "_clash", "_full", "_places")


def features(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the counts that the rules read; ``df`` must not hold columns of their names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    length = F.char_length(text)
    without = lambda t, chars: F.char_length(F.translate(t, chars, ""))
    df = df.withColumn("_words", words(text))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    df = df.withColumn("_lines", lines)
    return _repeat_words(df.select(
        *df.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (length - without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        (length - without(text, CAPITALS)).cast("long").alias("n_capitals"),
        (length - F.char_length(F.replace(text, F.lit("!"), F.lit("")))).cast("long").alias("n_exclaims"),
        (length - F.char_length(F.replace(text, F.lit("."), F.lit("")))).cast("long").alias("n_stops"),
    )).drop("_words", "_lines")


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def votes() -> list[Column]:
    return [F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END").alias(f"v{k}")
            for k, (_, bad, good) in enumerate(RULES)]


@dataclass
class LabelModel:
    """P(vote | class) of each rule and the share of good documents."""

    prior: float
    good: list[dict[int, float]]
    bad: list[dict[int, float]]

    def log_odds(self, pattern: tuple[int, ...]) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(
            math.log(self.good[k][v] / self.bad[k][v]) for k, v in enumerate(pattern))

    def column(self) -> Column:
        """The posterior probability as a column over v0, v1, ...: literals only."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for k in range(len(self.good)):
            weight = lambda v, k=k: F.lit(math.log(self.good[k][v] / self.bad[k][v]))
            total = total + F.when(F.col(f"v{k}") == 1, weight(1)).when(F.col(f"v{k}") == -1, weight(-1)).otherwise(weight(0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


# What is believed of a rule before any vote is seen: it seldom votes bad on a good document,
# and finds about a third of the bad ones (each rule knows one kind of junk). The belief
# counts as much as votes of a tenth of all documents, at every size, which keeps the two classes from
# settling on another division of the corpus (say, long and short).
BELIEF_GOOD = {-1: 0.002, 0: 0.148, 1: 0.850}
BELIEF_BAD = {-1: 0.350, 0: 0.200, 1: 0.450}
BELIEF_SHARE = 0.1
BELIEF_PRIOR = 0.85


def fit(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns (at most 3^rules of them).

    Each step adds the belief above as votes to the expected counts, so no probability is 0 or 1.
    """
    n = len(RULES)
    model = LabelModel(BELIEF_PRIOR, [dict(BELIEF_GOOD) for _ in range(n)], [dict(BELIEF_BAD) for _ in range(n)])
    items = sorted(patterns.items())
    total = sum(c for _, c in items)
    more = BELIEF_SHARE * total
    for _ in range(rounds if total else 0):
        p = [1 / (1 + math.exp(-model.log_odds(x))) for x, _ in items]
        g = sum(c * q for (_, c), q in zip(items, p))
        new = LabelModel((g + more * BELIEF_PRIOR) / (total + more), [], [])
        for k in range(n):
            at = {v: sum(c * q for (x, c), q in zip(items, p) if x[k] == v) for v in (-1, 0, 1)}
            of = {v: sum(c for x, c in items if x[k] == v) for v in (-1, 0, 1)}
            new.good.append({v: (at[v] + more * BELIEF_GOOD[v]) / (g + more) for v in at})
            new.bad.append({v: (of[v] - at[v] + more * BELIEF_BAD[v]) / (total - g + more) for v in at})
        model = new
    return model


def learn(voted: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    names = [f"v{k}" for k in range(len(RULES))]
    rows = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3^rules rows
    return fit({tuple(r[x] for x in names): r["n"] for r in rows}, rounds)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "quality") -> DataFrame:
    """One row for each document: its id, the counts, base_failed, quality (posterior) and kept."""
    counted = features(docs.select(F.col(id_col), F.col(text_col).alias("_text")), "_text").drop("_text")
    voted = cut(counted.select("*", F.expr(BASE_FAILED).alias("base_failed"), *votes()), name)
    model = learn(voted)
    return (
        voted.withColumn("quality", model.column())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Two passes over the texts (learn, then judge) instead of a join by id: nothing but
    the vote counts is shuffled, and rows that share an id are judged each by itself.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("_text"))
    # The row number keeps the filter above the counts: pushed below, it would repeat their expressions many times over.
    voted = features(whole, "_text").select(
        "row", F.expr(BASE_FAILED).alias("base_failed"), *votes(), F.monotonically_increasing_id().alias("_at"))
    model = learn(voted.drop("row"))
    return voted.where((F.col("_at") >= 0) & ~F.col("base_failed") & (model.column() >= 0.5)).select("row.*")
