"""URL filters: allow and block rules, and logistic regression on hashed character n-grams for all other URLs."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, internal, materialize, with_added

#: (rule, verdict); a rule is a host with a path's beginning.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]

#: What the labelled table is made of: names that sites of either kind carry, host patterns and paths.
SPAM = ["casino", "poker", "bets", "jackpot", "lottery", "pills", "pharma", "loans", "cheap", "free", "win", "spam", "farm", "ads", "track", "clicks", "deals", "replica", "adult", "hack"]
PLAIN = ["news", "library", "school", "garden", "museum", "science", "history", "weather", "recipes", "music", "travel", "sports", "archive", "health", "books", "forum", "wiki", "city", "river", "maps", "theatre", "nation", "mountain", "letters", "weekend", "kitchen", "university", "journal", "orchard", "painting", "bridge", "harbour", "lantern", "meadow", "studio", "village", "teacher", "railway", "island", "winter"]
HOSTS = ["{0}-{1}.example.com", "www.{0}-{1}.example.net", "{0}{1}.example.org", "m.{0}.example.com"]
PATHS = ["/en/{0}", "/fr/{0}.html", "/es/{0}/", "/de/{0}?page=2"]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): the small labelled table; 1 is to be blocked. Names meet pairwise, languages and endings evenly."""
    rows = []
    for label, names in ((1.0, SPAM), (0.0, PLAIN)):
        for i, name in enumerate(names):
            for k, (host, path) in enumerate(zip(HOSTS, PATHS, strict=True)):
                rows.append((f"https://{host.format(name, names[(i + k + 1) % len(names)])}{path.format(37 * i + k)}", label))
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, lower-cased A-Z; without `://`, or null: empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule for the host, or a domain over it, and the path's beginning; else null.

    A handful of rules is a chain of cases in the plan; of rules of one length the one with the longer host wins.
    """
    order = sorted(rules, key=lambda r: (-len(r[0]), -r[0].index("/"), r[0]))
    found = F.lit(None)
    for rule, verdict in reversed(order):
        domain, start = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def ngrams(host: Column, path: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Character n-grams of ^host$ and of the path without digits, marked by where they come from."""
    def grams(mark: str, text: Column, n: int) -> Column:
        places = F.when(F.char_length(text) >= n, F.sequence(F.lit(1), F.greatest(F.char_length(text) - n + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))

    around, stem = F.concat(F.lit("^"), host, F.lit("$")), F.regexp_replace(path, "[0-9]+", "0")
    return F.concat(*[grams("h", around, n) for n in sizes], *[grams("p", stem, n) for n in sizes])


class UrlModel:
    """Logistic regression over `features` hash buckets."""

    def __init__(self, labelled: DataFrame, features: int = 1 << 18, ridge: float = 0.01, steps: int = 40) -> None:
        self.hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=features, binary=True)
        rows = labelled.select(F.col("label"), ngrams(host_of(F.col("url")), path_of(F.col("url"))).alias("_grams"))
        learner = LogisticRegression(featuresCol="_features", labelCol="label", regParam=ridge, maxIter=steps, predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob")
        rows = materialize(self.hashing.transform(rows).select("label", "_features"), "urls-labelled")  # read once for each step
        self.model = learner.fit(rows)

    def scored(self, frame: DataFrame, host: str, path: str, name: str) -> DataFrame:
        """frame with the probability that a URL is to be blocked."""
        kept = frame.columns
        found = self.model.transform(self.hashing.transform(frame.withColumn("_grams", ngrams(F.col(host), F.col(path)))))
        return found.select(*kept, vector_to_array("_prob")[1].alias(name))


def held_out(url: Column) -> Column:
    """Whether a labelled URL is for measuring: a fifth of them."""
    return F.pmod(F.crc32(url), F.lit(5)) == 0


def measured(labelled: DataFrame, threshold: float = 0.5) -> dict[str, int]:
    """How a model of four fifths of a labelled table judges the last fifth: right and wrong verdicts of either kind."""
    model = UrlModel(labelled.where(~held_out(F.col("url"))))
    parsed = labelled.where(held_out(F.col("url"))).select("label", host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path"))
    found = model.scored(parsed, "_host", "_path", "_score").select((F.col("label") == 1).alias("bad"), (F.col("_score") >= threshold).alias("blocked"))
    count = {(r["bad"], r["blocked"]): r["count"] for r in found.groupBy("bad", "blocked").count().collect()}
    return {"caught": count.get((True, True), 0), "missed": count.get((True, False), 0), "false": count.get((False, True), 0), "passed": count.get((False, False), 0)}


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, labelled: DataFrame | None = None, threshold: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """Every row of pages with host, path, rule, score and verdict (allow or block).

    The verdict is that of the longest rule that fits (rule is its text), else (rule null) block where the regression,
    trained on `labelled` (url, label; the table above by default), gives `threshold` or more. Null URLs and those
    without `://` have empty host and path, and the regression's verdict on those. A column of pages with the name of an
    added one gives way; repeated rows come out repeated; an empty table gives an empty one.
    """
    frame, back = internal(pages, url="url")
    kept = [(n, b) for n, b in zip(pages.columns, back, strict=True) if carry is None or n in carry]
    model = UrlModel(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    parsed = frame.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    judged = model.scored(parsed, "_host", "_path", "_score").withColumn("_rule", matching_rule(F.col("_host"), F.col("_path"), rules))
    own = F.when(F.col("_score") >= threshold, "block").otherwise("allow")
    return judged.select(*with_added([b for _, b in kept], [n for n, _ in kept], host=F.col("_host"), path=F.col("_path"), rule=F.col("_rule.rule"), score=F.col("_score"), verdict=F.coalesce("_rule.verdict", own)))
