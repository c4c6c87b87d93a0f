"""URL filter: rules first, then a ratio of two character language models.

Two variable-order Markov models (contexts of zero to two characters, each order smoothed by the next shorter one
with a Witten-Bell weight) are counted from the accepted and the rejected URLs that rules decide. The log of their ratio for every
character in every context is one array of fixed size (ALPHABET^3 cells), so scoring is a lookup inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.common import ascii_lower, written

# Fixed values: (host, path, verdict). A host stands for itself and its subdomains.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
LETTERS = "abcdefghijklmnopqrstuvwxyz0./-_?=&#:%"
SIZE = len(LETTERS) + 2  # and a start mark (0) and one code for all other characters
CELLS = SIZE**3
FOLDS = 5  # every fifth URL by hash calibrates, the others train
BIN = 0.01


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host and path; both empty for a null url or one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    plain = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(plain, pattern, 1)), F.regexp_extract(plain, pattern, 2)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def with_cells(pages: DataFrame) -> DataFrame:
    """Add ``cells``: for each character of the url the number of its (two characters before, character) cell.

    A character's code is its place in the alphabet (all digits are one), or the last code.
    """
    plain = F.regexp_replace(ascii_lower(F.coalesce("url", F.lit(""))), "[0-9]", "0")
    place = lambda i: F.instr(F.lit(LETTERS), F.substring("__plain", i, F.lit(1)))
    codes = F.when(
        F.length("__plain") > 0,
        F.transform(
            F.sequence(F.lit(1), F.length("__plain")), lambda i: F.when(place(i) > 0, place(i)).otherwise(SIZE - 1)
        ),
    ).otherwise(F.array().cast("array<int>"))
    before = lambda i, n: F.when(i >= n, F.get("__codes", i - n)).otherwise(0)
    cells = F.transform("__codes", lambda x, i: (before(i, 2) * SIZE + before(i, 1)) * SIZE + x)
    coded = pages.withColumn("__plain", plain).withColumn("__codes", codes)
    return coded.withColumn("cells", cells).drop("__plain", "__codes")


def _probabilities(counts: DataFrame) -> DataFrame:
    """log P(character | two before) of every cell for one model; ``counts`` has cell and n."""
    spark = counts.sparkSession
    n3 = counts.select(F.floor(F.col("cell") / SIZE).alias("two"), F.col("cell") % SIZE, "n").toDF("two", "c", "n")
    n3 = n3.select("two", (F.col("two") % SIZE).alias("one"), "c", "n")
    n2 = n3.groupBy("one", "c").agg(F.sum("n").alias("n"))
    n1 = n2.groupBy("c").agg(F.sum("n").alias("n"))
    total = n1.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    grid = spark.range(CELLS).select(
        F.col("id").alias("cell"),
        F.floor(F.col("id") / SIZE).alias("two"),
        (F.floor(F.col("id") / SIZE) % SIZE).alias("one"),
        (F.col("id") % SIZE).alias("c"),
    )
    sums2 = n2.groupBy("one").agg(F.sum("n").alias("s2"), F.count("*").alias("t2"))
    sums3 = n3.groupBy("two").agg(F.sum("n").alias("s3"), F.count("*").alias("t3"))
    p0 = (F.coalesce("k1", F.lit(0)) + 1) / (F.col("all") + SIZE)
    mixed = lambda k, s, t, p: F.coalesce((F.coalesce(k, F.lit(0)) + F.col(t) * p) / (F.col(s) + F.col(t)), p)
    return (
        grid.join(n1.select("c", F.col("n").alias("k1")), "c", "left")
        .join(n2.select("one", "c", F.col("n").alias("k2")), ["one", "c"], "left")
        .join(n3.select("two", "c", F.col("n").alias("k3")), ["two", "c"], "left")
        .join(sums2, "one", "left")
        .join(sums3, "two", "left")
        .withColumn("all", total.scalar())
        .withColumn("p0", p0)
        .withColumn("p1", mixed("k2", "s2", "t2", F.col("p0")))
        .select("cell", F.log(mixed("k3", "s3", "t3", F.col("p1"))).alias("logp"))
    )


def ratio_model(decided: DataFrame) -> DataFrame:
    """One row: the log ratio of both models for all cells, in order. ``decided`` has verdict and cells."""
    counted = written(
        decided.select("verdict", F.explode("cells").alias("cell")).groupBy("verdict", "cell").agg(F.count("*").alias("n")),
        "url-counts",
    )
    allow, block = (_probabilities(counted.where(F.col("verdict") == v).drop("verdict")) for v in ("allow", "block"))
    ratios = allow.join(block.select("cell", F.col("logp").alias("other")), "cell").select(
        "cell", (F.col("logp") - F.col("other")).alias("r")
    )
    made = ratios.agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "r"))), lambda x: x["r"]).alias("ratios"))
    return written(made, "url-model")


def with_score(pages: DataFrame, model: DataFrame) -> DataFrame:
    """Add ``score``: the log-likelihood difference per character; zero for a url without characters."""
    total = F.aggregate("cells", F.lit(0.0), lambda sum_, cell: sum_ + F.get("__ratios", cell))
    mean = F.when(F.size("cells") > 0, total / F.size("cells")).otherwise(F.lit(0.0))
    return pages.withColumn("__ratios", model.scalar()).withColumn("score", mean).drop("__ratios")


def threshold(scored: DataFrame) -> float:
    """Where the two error rates on the calibration URLs add up to least; zero if a class has none.

    ``scored`` has verdict and score. Works on a histogram of bins of ``BIN``.
    """
    clipped = F.least(F.greatest(F.floor(F.col("score") / BIN), F.lit(-1000)), F.lit(1000))
    bins = scored.groupBy(clipped.alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad")
    )
    below, everywhere = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    error = F.coalesce(F.sum("good").over(below), F.lit(0)) / F.sum("good").over(everywhere) + (
        1 - F.coalesce(F.sum("bad").over(below), F.lit(0)) / F.sum("bad").over(everywhere)
    )
    best = bins.withColumn("error", error).where("error IS NOT NULL").orderBy("error", F.abs("bin"), "bin").first()
    return float(best["bin"] * BIN) if best else 0.0


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages`` (page_id, url).

    The longest fitting rule decides. All others are allowed if their score reaches the calibrated threshold. A null
    or empty url has host and path empty, no rule and the score zero. Repeated rows and null ids are judged like
    others; an empty table gives no rows; without URLs of both verdicts the threshold is zero. Other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    ruled = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, says = matched_rule(F.col("host"), F.col("path"), rules)
    base = with_cells(ruled.withColumn("rule", rule).withColumn("verdict", says))
    base = written(base, "url-cells")
    decided = base.where("verdict IS NOT NULL")
    held = F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0
    model = ratio_model(decided.where(~held))
    limit = threshold(with_score(decided.where(held), model))
    scored = with_score(base, model)
    method = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "score")
