"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Eight rules read one ratio of a document each and vote that it is poor, or abstain; one rule reads several ratios and
votes that it is good prose, or abstains. A model of two classes, poor and good, is estimated without labels by
expectation-maximisation over the counts of vote patterns (at most 2^9 rows, whatever the corpus): how many documents
are poor, and how often each rule votes in either class, so that an abstention counts as well. A rule that votes among
otherwise clean documents loses its weight. A document goes if it is probably poor given all votes and abstentions.
Everything is DataFrame operations; the driver holds the rates only.

Two rules read layout, which says nothing about some clean texts, and abstain there: ``open_lines`` where sentences end
as often as in prose (hard-wrapped lines) or lines are as short as those of a list or verse, ``odd_length`` where most
letters are of a script that puts no spaces between words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import SPACE, written

# Name of the ratio, poor above.
DEFECTS = (
    ("symbols", 0.05),
    ("repeats", 0.4),
    ("line_repeats", 0.4),
    ("exclamations", 0.05),
    ("capitals", 0.3),
    ("echoes", 0.2),
    ("open_lines", 0.5),
    ("odd_length", 3.0),
)
CUTS = dict(DEFECTS)
# Good prose has all of these below.
PROSE = (("symbols", 0.01), ("exclamations", 0.01), ("capitals", 0.1), ("odd_length", 1.5))
RULES = (*(name for name, _ in DEFECTS), "prose")
USUAL_LENGTH = 5.5  # mean word length in code points, from which odd_length measures
# First guesses: the share of poor documents, and how often a rule votes where it should and where it should not. They
# count as WEIGHT documents of each class. Rates are held between LEAST and MOST: no vote or abstention is certain.
SHARE, RIGHTLY, WRONGLY, PROSE_WRONGLY, WEIGHT = 0.1, 0.3, 0.02, 0.1, 10
LEAST, MOST = 0.001, 0.95
ROUNDS, SETTLED = 30, 1e-3
MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
CLOSING = ".!?:;,|。！？：；，、…।॥؟؛،۔።"  # what a line ends with that is not open
ENDED = r"""[。！？]|[.!?…।॥؟۔።]["'”’»)\]]*(?=[\x20\x09-\x0D]|\z)"""  # the end of a sentence
#: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = r"[\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"
SENTENCE, ROW, ROWS = 30, 12, 5  # most words a sentence of prose and a row of a list have, least rows of a list


def last_of(line: Column) -> Column:
    """The last code point that is no white space; ``line`` has one."""
    return F.substring(F.rtrim(line, F.lit(SPACE)), -1, 1)


def _count(text: Column, pattern: str) -> Column:
    """Code points of ``text`` that a one-character pattern matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measures(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the measures of every whole text, without a shuffle; null texts count as empty.

    Repeated windows are found inside the row: window hashes are sorted; only if two are equal are they sorted again
    with their positions, and the words that repeated windows cover are added up along the positions.
    """
    t, w, h = F.col("__text"), F.col("__words"), F.col("__hashes")
    kept = [F.col(f"`{c}`") for c in keep]
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(*kept, F.coalesce("text", F.lit("")).alias("__text")).select(
        *kept,
        F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)).alias("__words"),
        lines.alias("__lines"),
        F.length(F.regexp_replace(t, SPACES, "")).cast("bigint").alias("word_chars"),
        _count(t, "[#*$%&|<>]").cast("bigint").alias("n_symbols"),
        _count(t, "!").alias("exclaimed"),
        _count(t, r"\p{Lu}").alias("capital"),
        t,
    )
    so_far = [*kept, "word_chars", "n_symbols", "exclaimed", "capital"]
    second = first.select(
        *so_far,
        t,
        F.size(w).cast("bigint").alias("n_words"),
        F.size("__lines").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("__lines", lambda x: ~F.contains(F.lit(CLOSING), last_of(x)))).alias("open_line"),
        F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))).alias("echoed"),
        F.when(
            F.size(w) >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("__hashes"),
    )
    so_far += ["n_words", "n_lines", "n_dup_lines", "open_line", "echoed"]
    s = F.col("__sorted")
    # What only an abstention reads is counted only where its rule may vote.
    open_lines = F.col("open_line") > CUTS["open_lines"] * F.col("n_lines")
    off = F.abs(F.col("word_chars") - USUAL_LENGTH * F.col("n_words"))
    odd_length = off >= dict(PROSE)["odd_length"] * F.col("n_words")
    asian = (open_lines | odd_length) & (F.octet_length(t) > F.length(t))
    third = second.select(
        *so_far,
        F.when(open_lines, F.regexp_count(t, F.lit(ENDED))).otherwise(0).alias("ended"),
        F.when(asian, _count(t, UNSPACED)).otherwise(0).alias("unspaced"),
        "__hashes",
        F.sort_array("__hashes").alias("__sorted"),
    )
    so_far += ["ended", "unspaced"]
    third = third.select(
        *so_far,
        F.when(
            F.size(F.array_distinct(s)) < F.size(s),
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
        ).alias("__placed"),
    )
    z = F.col("__placed")
    fourth = third.select(
        *so_far,
        F.sort_array(
            F.transform(
                F.filter(
                    z,
                    lambda e, i: ((i > 0) & (F.get(z, i - 1)["h"] == e["h"]))
                    | F.coalesce(F.get(z, i + 1)["h"] == e["h"], F.lit(False)),
                ),
                lambda e: e["p"],
            )
        ).alias("__at"),
    )
    at = F.col("__at")
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return fourth.select(*so_far, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def votes(measured: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and for each rule whether it votes. A text without words has no ratios and gets no vote.

    Two letters of a script without spaces count as a word of a sentence or row.
    """

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.when(F.col(whole) > 0, F.col(whole))

    ratios = {
        "symbols": share("n_symbols", "word_chars"),
        "repeats": share("n_repeat_words", "n_words"),
        "line_repeats": share("n_dup_lines", "n_lines"),
        "exclamations": share("exclaimed", "word_chars"),
        "capitals": share("capital", "word_chars"),
        "echoes": share("echoed", "n_words"),
        "open_lines": share("open_line", "n_lines"),
        "odd_length": F.abs(share("word_chars", "n_words") - USUAL_LENGTH),
    }
    units = F.greatest(F.col("n_words"), F.col("unspaced") / 2)
    wrapped = F.col("ended") * SENTENCE >= units
    listed = (F.col("n_lines") >= ROWS) & (units <= ROW * F.col("n_lines"))
    abstains = {"open_lines": wrapped | listed, "odd_length": 2 * F.col("unspaced") > F.col("word_chars")}
    prose = F.lit(True)
    for name, below in PROSE:
        prose = prose & ((ratios[name] < below) | abstains.get(name, F.lit(False)))
    voting = {n: (ratios[n] > above) & ~abstains.get(n, F.lit(False)) for n, above in DEFECTS} | {"prose": prose}
    return measured.select(*keep, *(F.coalesce(v, F.lit(False)).alias(f"v_{name}") for name, v in voting.items()))


Rates = dict[str, tuple[float, float]]


def first_rates() -> Rates:
    """How often each rule votes in poor and in good documents, before anything is seen."""
    return {name: (PROSE_WRONGLY, 1 - PROSE_WRONGLY) if name == "prose" else (RIGHTLY, WRONGLY) for name in RULES}


def posterior(share: float, rates: Rates) -> Column:
    """Probability that a document with these votes and abstentions is poor."""
    odds = F.lit(share / (1 - share))
    for name, (poor, good) in rates.items():
        odds = odds * F.when(F.col(f"v_{name}"), poor / good).otherwise((1 - poor) / (1 - good))
    return odds / (1 + odds)


def ordered(name: str, poor: float, good: float, all_of_them: float) -> tuple[float, float]:
    """Rates held in their range, and equal where they would say that a defect is good or that prose is poor."""
    if (poor > good) if name == "prose" else (poor < good):
        poor = good = all_of_them
    return min(MOST, max(LEAST, poor)), min(MOST, max(LEAST, good))


def estimate(voted: DataFrame) -> tuple[float, Rates]:
    """The share of poor documents and the rules' rates, by expectation-maximisation over all vote patterns.

    A rate is the expected share of a class in which the rule votes, with ``WEIGHT`` documents at the first guess. Which
    class is which is fixed by the rules: prose votes no less in good documents, defects no less in poor ones. Ends when
    no figure moves by ``SETTLED``. Without any document the first guesses stay.
    """
    columns = [f"v_{name}" for name in RULES]
    patterns = written(
        voted.groupBy(*columns).agg(F.count("*").alias("n")).coalesce(1).sortWithinPartitions(*columns), "vote-patterns"
    )
    share, rates, start = SHARE, first_rates(), first_rates()
    for _ in range(ROUNDS):
        weighed = patterns.withColumn("poor", posterior(share, rates) * F.col("n"))
        row = weighed.agg(
            F.sum("n").alias("n"),
            F.sum("poor").alias("poor"),
            *(F.sum(F.when(F.col(f"v_{n}"), F.col("n"))).alias(f"all_{n}") for n in RULES),
            *(F.sum(F.when(F.col(f"v_{n}"), F.col("poor"))).alias(f"poor_{n}") for n in RULES),
        ).first()
        found = {name: value or 0 for name, value in row.asDict().items()}
        before, n, poor = {"share": (share, share)} | rates, found["n"], found["poor"]
        share = (poor + WEIGHT * SHARE) / (n + WEIGHT)
        for name, (in_poor, in_good) in start.items():
            votes_all, votes_poor = found[f"all_{name}"], found[f"poor_{name}"]
            rates[name] = ordered(
                name,
                (votes_poor + WEIGHT * in_poor) / (poor + WEIGHT),
                (votes_all - votes_poor + WEIGHT * in_good) / (n - poor + WEIGHT),
                (votes_all + WEIGHT * (in_poor + in_good)) / (n + 2 * WEIGHT),
            )
        now = {"share": (share, share)} | rates
        if max(abs(a - b) for name in now for a, b in zip(now[name], before[name], strict=True)) < SETTLED:
            break
    return share, rates


def base_failed(words: str = "n_words", repeats: str = "n_repeat_words") -> Column:
    return (F.col(words) < MIN_WORDS) | (100 * F.col(repeats) > 50 * F.col(words))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base measures, base_failed, kept, and poor (probability) of every row of ``docs`` (doc_id, text).

    kept is false where base_failed, else where the probability of poor is above a half. Null and empty texts have no
    words, so they fail the base. Rows without doc_id and repeated rows are judged like others; an empty table gives no
    rows; other columns are not read.
    """
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    measured = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    voted = written(votes(measures(measured), base), "votes")
    poor = posterior(*estimate(voted))
    return voted.select(
        *base, base_failed().alias("base_failed"), (~base_failed() & (poor <= 0.5)).alias("kept"), poor.alias("poor")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    The rows are written with their votes, so that texts are measured once and the filter reads plain columns: Catalyst
    would push it below the measures and evaluate them once for each time it names them.
    """
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), F.col("text"))
    voted = written(votes(measures(held, ("__row",)), ("__row", "n_words", "n_repeat_words")), "voted")
    return voted.where(~base_failed() & (posterior(*estimate(voted)) <= 0.5)).select("__row.*")
