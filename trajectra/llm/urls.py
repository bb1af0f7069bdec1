"""URL filter: host rules, and for other URLs the ratio of two character language models.  DataFrame expressions only.

The models are variable-order Markov models of accepted and of rejected URLs,
smoothed by Witten-Bell interpolation down to the uniform distribution:
``P(c | h) = (n(hc) + t(h) * P(c | h without its first)) / (n(h) + t(h))`` with
``t(h)`` the number of different characters seen after ``h``.  For each gram
(history and next character) that either model has seen, the log ratio of the two
probabilities is kept.  A character of a URL takes the ratio of the longest such gram
that ends at it; the score is their mean, so it doesn't depend on the length.  A
URL is blocked if its score is below a threshold calibrated on the training
URLs: the midpoint of the two classes' mean scores.

The models learn from all different URLs on which the rules decide, at full length.  A
URL gives one window for each character, the longest gram that ends at it; windows are
counted before they are shuffled, and the counts of shorter grams are sums over
windows.  For scoring, each different window gets its ratio by joins with the model; these
ratios are broadcast if they are at most BROADCAST_ROWS, else joined by shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: Begins and ends a URL in the models.
_BEGIN, _END = "\u0002", "\u0003"
#: Rows of up to 4 characters and a ratio that are broadcast, about 20 MB; more are shuffled, with the same result.
BROADCAST_ROWS = 1 << 18


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The default rules; of those that fit, the longest decides.
RULES = (Rule(ALLOW, "com", "/"), Rule(BLOCK, "example.com", "/en/"), Rule(ALLOW, "www.example.com", "/en/"), Rule(BLOCK, "net", "/es/"), Rule(BLOCK, "net", "/fr/"))


@dataclass(frozen=True)
class Bounds:
    """Longest gram, and number of characters over which the models are uniform without counts."""

    order: int = 4
    alphabet: int = 256


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where there is no `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return host, path


def rule_column(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null; a rule fits its host and all subdomains."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _padded(url: Column) -> Column:
    return F.concat(F.lit(_BEGIN), F.lower(url), F.lit(_END))


def _windows(url: Column, order: int) -> Column:
    """The last ``order`` characters, or as many as there are, up to each character but the first; in linear time."""
    at = lambda chars, i: F.concat(*(F.when(i >= k, F.get(chars, i - k)).otherwise(F.lit("")) for k in range(order - 1, -1, -1)))
    ends = F.transform(F.array(F.split(_padded(url), "")), lambda chars: F.transform(chars, lambda _, i: at(chars, i)))
    return F.slice(F.get(ends, F.lit(0)), 2, F.length(url) + 1)


def _suffixes(window: str) -> Column:
    """The grams that end where the window does."""
    return F.transform(F.sequence(F.lit(1), F.length(window)), lambda k: F.right(F.col(window), k))


def train(judged: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """gram and its log ratio (accepted over rejected), from rows (url, verdict); no rows give an empty model."""
    seen = judged.distinct().select("verdict", F.explode(_windows(F.col("url"), bounds.order)).alias("window"))
    in_class = lambda verdict: F.count_if(F.col("verdict") == verdict).cast("double")
    windows = seen.groupBy("window").agg(in_class(ALLOW).alias("n_a"), in_class(BLOCK).alias("n_b"))
    counts = windows.select(F.explode(_suffixes("window")).alias("gram"), "n_a", "n_b").groupBy("gram").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    counts = counts.withColumn("k", F.length("gram")).withColumn("history", F.substring("gram", 1, F.col("k") - 1)).withColumn("shorter", F.substring("gram", 2, bounds.order))
    sums = [f(c).alias(f"{m}_{c[-1]}") for c in ("n_a", "n_b") for f, m in ((F.sum, "n"), (lambda c: F.count_if(F.col(c) > 0).cast("double"), "t"))]
    totals = counts.groupBy("history").agg(*sums).select("history", *(F.col(f"{m}_{c}").alias(f"h{m}_{c}") for m in "nt" for c in "ab"))
    counts = counts.join(totals, "history")
    below = None
    out = None
    for k in range(1, bounds.order + 1):
        level = counts.filter(F.col("k") == k)
        if below is None:
            level = level.withColumns({f"q_{c}": F.lit(1.0 / bounds.alphabet) for c in "ab"})
        else:
            level = level.join(below, "shorter")
        p = {f"p_{c}": F.when(F.col(f"hn_{c}") > 0, (F.col(f"n_{c}") + F.col(f"ht_{c}") * F.col(f"q_{c}")) / (F.col(f"hn_{c}") + F.col(f"ht_{c}"))).otherwise(F.col(f"q_{c}")) for c in "ab"}
        level = level.withColumns(p).select("gram", "k", "p_a", "p_b")
        below = level.select(F.col("gram").alias("shorter"), F.col("p_a").alias("q_a"), F.col("p_b").alias("q_b"))
        out = level if out is None else out.unionByName(level)
    return out.select("gram", F.log(F.col("p_a") / F.col("p_b")).alias("ratio"))


def score(rows: DataFrame, model: DataFrame, bounds: Bounds = Bounds(), cut=lambda df: df, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """url and score of each different url of rows (column url); a character that no gram fits counts 0."""
    # a long URL isn't repeated at each of its characters, but its name, 128 bits of its digest
    rows = rows.select("url").distinct().withColumn("name", F.substring(F.unhex(F.sha2("url", 256)), 1, 16))
    at = rows.select("name", F.explode(_windows(F.col("url"), bounds.order)).alias("window"))
    grams = at.select("window").distinct().select("window", F.explode(_suffixes("window")).alias("gram"))
    longest = F.max_by("ratio", F.when(F.col("ratio").isNotNull(), F.length("gram")))
    ratios = cut(grams.join(model, "gram", "left").groupBy("window").agg(F.coalesce(longest, F.lit(0.0)).alias("ratio")))
    if ratios.count() <= broadcast_rows:
        ratios = F.broadcast(ratios)
    means = at.join(ratios, "window").groupBy("name").agg(F.avg("ratio").alias("score"))
    return rows.join(means, "name").select("url", "score")


def url_verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES, bounds: Bounds = Bounds(), page_id: str = "page_id", url: str = "url", cut=lambda df: df) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row.

    The rule decides where one fits, else the models.  With no training URLs of one
    class, or for a null or empty url, the score is 0 and the verdict allow; so is a rule's row's score.  Repeated
    rows and null ids are all returned; an empty table gives no rows; a score equal to the threshold allows; urls of any
    length are read whole, in time in proportion to it; other columns aren't read, whatever their names.  ``cut``
    may save the model and the windows' ratios, which are far fewer than characters, instead of computing them for each use.
    """
    host, path = host_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    name, verdict = rule_column(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "ruled": verdict})
    judged = rows.filter(F.col("ruled").isNotNull()).select("url", F.col("ruled").alias("verdict"))
    model = cut(train(judged, bounds))
    means = score(judged, model, bounds, cut).join(judged.distinct(), "url").groupBy("verdict").agg(F.avg("score").alias("mean")).collect()  # two rows at most
    by_model = F.lit(ALLOW)
    if len(means) == 2:
        by_model = F.when(F.col("score") < sum(m["mean"] for m in means) / 2, BLOCK).otherwise(ALLOW)
    # rows on which a rule decides, and null urls, are neither scored nor shuffled
    is_open = F.col("ruled").isNull() & F.col("url").isNotNull()
    left = rows.filter(is_open)
    scored = left.join(score(left, model, bounds, cut), "url", "left").withColumn("verdict", by_model)
    decided = rows.filter(~is_open).withColumns({"score": F.lit(0.0), "verdict": F.coalesce("ruled", F.lit(ALLOW))})
    columns = ("page_id", "host", "path", "rule", "verdict", "score")
    return decided.select(*columns).unionByName(scored.withColumn("score", F.coalesce("score", F.lit(0.0))).select(*columns))
