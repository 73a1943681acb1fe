"""Quality rules: a threshold table compiled into one projection of text measures.

Every measure is a built-in expression over the whole text, so a row is judged where it is read: no function written
in Python, no shuffle, no join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import SPACES, fresh, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Symbols that mark markup and leftovers rather than prose.
SYMBOLS = "#*$%&|<>"
# Frequent function words of the corpus languages, in lower case.
STOP_WORDS = (
    "a al an and are as at auf be but by con da das de del den der des die dans du ein eine el en est et for from für"
    " has have he il in is ist it la las le les lo los mit nicht of on or para por pour que se sich sie sur that the"
    " this to un una une und von was with y zu"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure divided by another, with the bounds a good text keeps; texts below ``from_words`` words are let pass."""

    name: str
    measure: str
    per: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=20.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.01, from_words=50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.3),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though the body's own lambdas read it again and again."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeat_words(hashes: Column) -> Column:
    """Words that lie in a window found twice or more. ``hashes`` has a window's hash at each place where one begins."""

    def twice(placed: Column) -> Column:
        """The places of sorted windows that equal a neighbour; ``F.get`` gives NULL beyond the ends."""
        return F.filter(
            F.transform(
                placed,
                lambda x, k: F.when(
                    F.coalesce(F.get(placed, k - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(placed, k + 1)["h"] == x["h"], F.lit(False)),
                    x["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )

    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    covered = _covered(F.sort_array(_let(placed, twice)))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def _covered(starts: Column) -> Column:
    """Places covered by windows that begin at the sorted ``starts``: each adds what the one before it left free."""
    added = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n")),
    )
    return added["n"]


def measures(df: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with one more column, a struct of all measures, and that column's name."""
    found, hashes, out = fresh(df, "_words", "_windows", "_measures")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = df.withColumn(found, words(whole))
    w = F.col(found)
    # A window's hash chains its five words; the last places, where no whole window begins, are left out.
    windows = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    df = df.withColumn(hashes, F.slice(windows, 1, F.greatest(F.lit(0), F.size(w) - (WINDOW - 1))))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    length = F.length(whole)
    struct = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col(hashes)).cast("long").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    # A list of one, exploded: a filter on the measures would else be moved below the words and compute them in its lambdas.
    return df.withColumn(out, F.explode(F.array(struct))).drop(found, hashes), out


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True if every rule of the table holds; a measure per nothing passes."""
    good = F.lit(True)
    for rule in rules:
        value = m[rule.measure] / F.nullif(m[rule.per], F.lit(0))
        holds = F.lit(True)
        if rule.least is not None:
            holds = holds & (value >= rule.least)
        if rule.most is not None:
            holds = holds & (value <= rule.most)
        good = good & F.coalesce(holds | (m["n_words"] < rule.from_words), F.lit(True))
    return good


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each row's ``doc_id``, measures, ``base_failed`` and ``kept``.

    NULL and blank texts have no word and fail. Repeated rows and NULL ids are judged like any other; an empty table
    gives no row; columns other than ``doc_id`` and ``text`` are not looked at.
    """
    measured, m = measures(docs.select("doc_id", "text"))
    judged = measured.select("doc_id", f"{m}.*", base_failed(F.col(m)).alias("base_failed"), verdict(F.col(m), rules).alias("_good"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("_good")).drop("_good")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, all columns unchanged."""
    measured, m = measures(docs)
    return measured.filter(~base_failed(F.col(m)) & verdict(F.col(m), rules)).select(*[f"`{c}`" for c in docs.columns])
