"""Document quality by weak supervision, in DataFrame operations only.

Rules vote good (1), bad (-1) or abstain (0) on each document. Documents are counted by
their votes, at most 3^(number of rules) combinations. On those counts expectation-maximisation
estimates how each rule votes on good and on bad documents, and the share of good ones, over
those that pass the base rule; a document is kept when its posterior probability of being good is at least 0.5.

Words are runs of characters other than space and \\t..\\r. Windows of three words are
compared by 64-bit hashes within one document. Defined results: a null text has no words and
fails the base rule, like an empty one; repeated rows count each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stash, text_key

WHITE, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
ITERATIONS = 12
GOOD, NONE, BAD = 1, 0, -1
# Rules are better than chance: how often a rule rejects a good and a bad document, as expected
# beforehand, and what share of all rows these expectations weigh.
REJECTS_GOOD, REJECTS_BAD = (0.01, 2.0), (0.4, 0.01)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_stops", "n_shouts"]


def _count(text: Column, characters: str) -> Column:
    """How many of these ASCII characters there are; replacing one character is a byte search."""
    size = F.octet_length(text)
    return sum((size - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in characters), F.lit(0)).cast("long")


def measure(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key and the counts that rules look at, one row per row of `df`."""
    raw = F.col("_text")
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("text_key", text_key("_text"))
    rows = rows.withColumns({
        "_words": F.split(F.btrim(raw, F.lit(WHITE)), "[\\x20\\x09-\\x0D]+"),
        "_lines": F.filter(F.split(raw, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != ""),
        "word_chars": F.length(raw) - _count(raw, WHITE),
        "n_symbols": _count(raw, SYMBOLS),
        "n_capitals": F.regexp_count(raw, F.lit("[A-Z]")).cast("long"),
        "n_stops": _count(raw, ".?!"),
        "n_shouts": _count(raw, "!"),
    })
    words = F.col("_words")
    windows = F.transform(words, lambda w, k: F.xxhash64(w, F.get(words, k + 1), F.get(words, k + 2)))
    rows = rows.select(
        "doc_id", "text_key", *[c for c in MEASURES if c in rows.columns],
        F.when(F.col("word_chars") == 0, 0).otherwise(F.size(words)).cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.slice(windows, 1, F.greatest(F.size(words) - 2, F.lit(0))).alias("_windows"),
    )
    found = F.col("_windows")
    numbered = F.transform(found, lambda h, k: F.struct(h.alias("h"), k.alias("k")))
    repeats = F.size(F.array_distinct(found)) < F.size(found)
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(numbered)))
    order = F.col("_sorted")
    twice = F.filter(
        order,
        lambda w, k: F.coalesce(w["h"] == F.get(order, k - 1)["h"], F.lit(False))
        | F.coalesce(w["h"] == F.get(order, k + 1)["h"], F.lit(False)),
    )
    rows = rows.withColumn("_at", F.sort_array(F.transform(twice, lambda w: w["k"])))
    at = F.col("_at")
    # A window covers three words, or those up to the next repeated window.
    covered = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0), lambda s, x: s + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).select("doc_id", "text_key", *MEASURES)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def rules() -> dict[str, Column]:
    """The rules over the measures."""
    c = {name: F.col(name) for name in MEASURES}
    words, chars = c["n_words"], c["word_chars"]
    return {
        "symbols": _vote(c["n_symbols"] * 50 <= words, c["n_symbols"] * 8 > words),
        "repeats": _vote(c["n_repeat_words"] * 100 <= words * 15, c["n_repeat_words"] * 100 > words * 40),
        "lines": _vote(c["n_dup_lines"] == 0, c["n_dup_lines"] * 10 > c["n_lines"] * 3),
        "word_size": _vote(chars.between(words * 3, words * 9), (chars < words * 2) | (chars > words * 14)),
        "capitals": _vote(c["n_capitals"] * 100 <= chars * 12, c["n_capitals"] * 100 > chars * 40),
        "stops": _vote(c["n_stops"] * 60 >= words, c["n_stops"] * 200 < words),
        "shouts": _vote(c["n_shouts"] * 50 <= words, c["n_shouts"] * 8 > words),
        "length": _vote(words >= 80, words < 30),
    }


@dataclass
class Model:
    """Share of good documents, and for each rule the chance of each vote on good and on bad ones."""

    good: float
    votes: dict[str, dict[int, tuple[float, float]]]

    def posterior(self) -> Column:
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule, chances in self.votes.items():
            term = F.lit(0.0)
            for vote, (on_good, on_bad) in chances.items():
                term = F.when(F.col(rule) == vote, math.log(on_good / on_bad)).otherwise(term)
            odds = odds + term
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, names: list[str], iterations: int = ITERATIONS) -> Model | None:
    """Expectation-maximisation over counted vote patterns (columns: the rules, and n)."""
    bad_votes = sum((F.when(F.col(r) == BAD, 1).otherwise(0) for r in names), F.lit(0))
    belief: Column = F.when(bad_votes == 0, 0.95).when(bad_votes == 1, 0.1).otherwise(0.01)
    model = None
    for _ in range(iterations):
        weight = F.col("n") * F.col("_q")
        sums = [F.sum("n").alias("n"), F.sum(weight).alias("good")]
        for k, rule in enumerate(names):
            for vote in (GOOD, NONE, BAD):
                mine = F.col(rule) == vote
                sums.append(F.sum(F.when(mine, F.col("n")).otherwise(0)).alias(f"n{k}_{vote}"))
                sums.append(F.sum(F.when(mine, weight).otherwise(0.0)).alias(f"g{k}_{vote}"))
        row = patterns.withColumn("_q", belief).agg(*sums).first()
        if not row["n"]:
            return None
        n, good = float(row["n"]), float(row["good"])
        votes = {}
        for k, rule in enumerate(names):
            chances = []
            for side, (expected, share), size in (("g", REJECTS_GOOD, good), ("b", REJECTS_BAD, n - good)):
                seen = {
                    v: float(row[f"g{k}_{v}"] if side == "g" else max(row[f"n{k}_{v}"] - row[f"g{k}_{v}"], 0.0))
                    for v in (GOOD, NONE, BAD)
                }
                weight = 1 + share * n
                bad = (seen[BAD] + weight * expected) / (max(size, 0.0) + weight)
                rest = (1 - bad) / (seen[GOOD] + seen[NONE] + 1)
                chances.append({BAD: bad, GOOD: rest * (seen[GOOD] + 0.5), NONE: rest * (seen[NONE] + 0.5)})
            votes[rule] = {v: (chances[0][v], chances[1][v]) for v in (GOOD, NONE, BAD)}
        model = Model((good + 1) / (n + 2), votes)
        belief = model.posterior()
    return model


def judge(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The measures, base_failed, the votes, the posterior and kept, one row per row of `df`."""
    voting = rules()
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = stash(measure(df, doc_id, text).withColumns({**voting, "base_failed": failed}), "measures")
    patterns = stash(measured.where("not base_failed").groupBy(*voting).agg(F.count("*").alias("n")).coalesce(1), "votes")
    model = estimate(patterns, list(voting))
    posterior = model.posterior() if model else F.lit(0.0)
    judged = measured.withColumn("posterior", posterior)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


DIGEST = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"]


def keep_good(df: DataFrame) -> DataFrame:
    """The rows of `df` that are kept."""
    rejected = judge(df).where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = df["doc_id"].eqNullSafe(rejected["_id"]) & (text_key("text") == rejected["_key"])
    return df.join(rejected, same, "left_anti")
