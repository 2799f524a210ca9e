"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a column expression over the whole text; no user function, no
shuffle.  A repeated three-word window is found by sorting the document's own
windows and comparing neighbours, so the work in a row is n log n in its words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES

# Common function words of the four languages.
STOP_WORDS = tuple(
    "the of and to in a is that for it as was with be on by at this are or an from not which have has had but they his her we you "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se avec son "
    "el los del se las por con no una su para al lo como más o pero sus y".split()
)


@dataclass(frozen=True)
class Rule:
    """``least <= top / bottom <= most``; a zero bottom passes."""

    name: str
    top: str
    bottom: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 1.5, 20.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.3),
    Rule("shouts_per_word", "n_shouts", "n_words", None, 0.5),
    Rule("letters", "n_letters", "word_chars", 0.5, None),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def rule_holds(rule: Rule) -> Column:
    ratio = F.col(rule.top).cast("double") / F.when(F.col(rule.bottom) > 0, F.col(rule.bottom).cast("double"))
    holds = F.lit(True)
    if rule.least is not None:
        holds = holds & (ratio >= rule.least)
    if rule.most is not None:
        holds = holds & (ratio <= rule.most)
    return F.coalesce(holds, F.lit(True))


def quality_rules(docs: DataFrame, ids: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES,
                  min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """Measures, failed rules and verdict of every document, one row per input row.

    Words are runs of characters other than blank and tab to carriage return.
    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat``
    percent of the words lie in three-word windows found twice or more.
    ``failed`` names the broken rules in table order; ``kept`` is true when the
    base and all rules hold.

    A null or empty text has no words, fails the base and breaks no ratio rule.
    Repeated rows each get their row; columns other than ``ids`` and ``text``
    are ignored, so their names cannot clash.  An empty table gives no rows.
    """
    spaces = F.lit(SPACES)
    base = docs.select(*[F.col(c) for c in ids], F.coalesce(F.col(text), F.lit("")).alias("__t"))
    cut = base.withColumn("__b", F.btrim(F.col("__t"), spaces))
    cut = cut.withColumn("__w", F.when(F.col("__b") == "", F.array().cast("array<string>")).otherwise(F.split("__b", f"{SPACE_CLASS}+")))
    cut = cut.withColumn("__l", F.filter(F.split("__t", "\n"), lambda line: F.btrim(line, spaces) != ""))
    count = cut.withColumn("n_words", F.size("__w").cast("long"))
    # "w1 w2 w3\nposition": equal windows stand side by side after sorting.  Neighbours are zipped, not
    # looked up, so that no lambda holds an array that an optimised plan would compute for each element.
    n = F.greatest(F.size("__w") - 2, F.lit(0))
    three = F.arrays_zip(*[F.slice("__w", F.lit(k), n).alias(f"w{k}") for k in (1, 2, 3)])
    window = F.transform(three, lambda z, i: F.concat(z["w1"], F.lit(" "), z["w2"], F.lit(" "), z["w3"], F.lit("\n"), i.cast("string")))
    ordered = count.withColumn("__s", F.sort_array(window))
    ordered = ordered.withColumn("__k", F.transform("__s", lambda s: F.substring_index(s, "\n", 1)))
    ahead, behind = F.concat(F.array(F.lit(None).cast("string")), F.col("__k")), F.slice("__k", F.lit(2), F.size("__k"))
    sides = F.arrays_zip(F.col("__s").alias("s"), F.col("__k").alias("k"), ahead.alias("p"), behind.alias("q"))
    twice = F.transform(F.filter(sides, lambda z: (z["k"] == z["p"]) | (z["k"] == z["q"])), lambda z: z["s"])
    at = F.transform(twice, lambda s: F.substring_index(s, "\n", -1).cast("int"))
    covered = F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(p, p + 1, p + 2))))
    stop = list(dict.fromkeys(STOP_WORDS))

    def without(chars: str) -> Column:
        return F.length(F.translate("__t", chars, ""))

    measured = ordered.select(
        *ids, "n_words",
        without(SPACES).cast("long").alias("word_chars"),
        (F.length("__t") - without("#*$%&|<>")).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        (F.length("__t") - without("!?")).cast("long").alias("n_shouts"),
        F.length(F.regexp_replace("__t", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.size(F.filter("__w", lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        F.size("__l").cast("long").alias("n_lines"),
    )
    failed = F.array_compact(F.array(*[F.when(~rule_holds(r), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    judged = measured.withColumn(
        "base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    ).withColumn("failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


RULES_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM cut),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS tri FROM (
    SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY r),
measured AS (
  SELECT s.r, doc_id, CAST(len(words) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^!?]+', '', 'g')) AS n_shouts, length(regexp_replace(t, '\P{L}+', '', 'g')) AS n_letters,
         len(list_filter(words, lambda w: list_contains([STOP], lower(w)))) AS n_stop_words, len(lines) AS n_lines
  FROM split s LEFT JOIN covered c ON s.r = c.r),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 1.5 * n_words AND word_chars <= 20 * n_words AND n_symbols <= CAST(0.3 AS DOUBLE) * n_words
       AND n_shouts <= CAST(0.5 AS DOUBLE) * n_words AND n_letters >= CAST(0.5 AS DOUBLE) * word_chars
       AND n_stop_words >= CAST(0.02 AS DOUBLE) * n_words AND n_dup_lines <= CAST(0.5 AS DOUBLE) * n_lines AS kept
FROM based
""".replace("STOP", ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS)))
