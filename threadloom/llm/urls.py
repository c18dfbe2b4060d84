"""Judging URLs: rules first, else two character models and a calibrated threshold.

The URLs that rules accept and reject train two Markov models over characters. An order's estimate
mixes in the next shorter order by the number of different characters seen after its context, and
an unseen context leaves the shorter order alone, so the order in force varies with the evidence.
A URL's score is the difference of the two log-likelihoods per character. The threshold is the one
that separates held-out accepted and rejected URLs best. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.llm.shared import cut

# The rules of the contract, as verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Printable ASCII stays, anything else becomes "~": at most 94 symbols and the blank before the
# start, hence at most 95**3 grams of three, a proven bound of the model's size.
SYMBOLS = 94
BINS = 64  # histogram bins per unit of score


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))


def rule_of(rules=RULES) -> Column:
    """The longest fitting rule (verdict, rule) over columns host and path, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    fits = [
        F.when(
            ((F.col("host") == host) | F.col("host").endswith(f".{host}"))
            & F.col("path").startswith(path),
            F.struct(F.lit(verdict).alias("verdict"), F.lit(host + path).alias("rule")))
        for verdict, host, path in ordered
    ]
    return F.coalesce(*fits)


def grams(url: Column) -> Column:
    """Per character: it and the two before it, two blanks before the first."""
    symbols = F.filter(F.split(F.regexp_replace(url, "[^!-~]", "~"), ""), lambda c: c != "")
    # the array is bound once, so a long text is read once and not for each of its characters
    return F.get(F.transform(F.array(symbols), lambda chars: F.transform(
        chars, lambda c, i: F.concat(
            F.coalesce(F.get(chars, i - 2), F.lit(" ")),
            F.coalesce(F.get(chars, i - 1), F.lit(" ")), c))), F.lit(0))


def _sums(df: DataFrame, key: Column, **extra: Column) -> DataFrame:
    return df.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ("acc", "rej")], *[v.alias(k) for k, v in extra.items()])


def _contexts(df: DataFrame, key: Column, order: int) -> DataFrame:
    """Per context: how often it was seen and how many characters came after it, by class."""
    return df.groupBy(key).agg(*[
        f.alias(f"{name}{order}_{c}") for c in ("acc", "rej")
        for name, f in (("seen", F.sum(c)), ("kinds", F.sum((F.col(c) > 0).cast("int"))))])


def model(urls: DataFrame) -> DataFrame:
    """Log-likelihood ratio of every gram that occurs in `urls` (url, n, acc, rej).

    `acc` and `rej` say how often the URL trains a class; both are 0 for a URL only to be scored.
    """
    three = cut(_sums(
        urls.select("acc", "rej", F.explode(grams(F.col("url"))).alias("gram")), F.col("gram")))
    two = _sums(three, F.substring("gram", 2, 2).alias("g2"))
    one = _sums(two, F.substring("g2", 2, 1).alias("g1"))
    parts = [
        (_contexts(three, F.substring("gram", 1, 2).alias("c3"), 3), "c3"),
        (two.select("g2", F.col("acc").alias("acc2"), F.col("rej").alias("rej2")), "g2"),
        (_contexts(two, F.substring("g2", 1, 1).alias("c2"), 2), "c2"),
        (one.select("g1", F.col("acc").alias("acc1"), F.col("rej").alias("rej1")), "g1"),
        (_contexts(one, F.lit(0).alias("c1"), 1), "c1"),
    ]
    out = three.withColumns({
        "c3": F.substring("gram", 1, 2), "g2": F.substring("gram", 2, 2),
        "c2": F.substring("gram", 2, 1), "g1": F.substring("gram", 3, 1), "c1": F.lit(0)})
    for part, key in parts:  # at most 95**2 rows each
        out = out.join(F.broadcast(part), key)
    logs = []
    for c in ("acc", "rej"):
        p = F.lit(1.0 / SYMBOLS)
        for order, count in ((1, f"{c}1"), (2, f"{c}2"), (3, c)):
            seen, kinds = F.col(f"seen{order}_{c}"), F.col(f"kinds{order}_{c}")
            p = F.when(seen > 0, (F.col(count) + kinds * p) / (seen + kinds)).otherwise(p)
        logs.append(F.log(p))
    return out.select("gram", (logs[0] - logs[1]).alias("ratio"))


def scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """`urls` by url with `score`, the mean ratio of its grams; urls are distinct."""
    per_gram = urls.select("url", F.explode(grams(F.col("url"))).alias("gram"))
    return per_gram.join(F.broadcast(ratios), "gram").groupBy("url").agg(
        F.avg("ratio").alias("score"))


def threshold(held_out: DataFrame) -> float:
    """Score from which a URL is accepted: best balanced accuracy on (score, accepted, n).

    Without held-out URLs of both classes it is 0. Scores meet in a histogram of at most a few
    thousand bins. Ties go to the edge nearest to 0, then to the lower one.
    """
    bins = held_out.groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("acc"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))).alias("rej"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = bins.select(
        "bin",
        F.coalesce(F.sum("acc").over(below), F.lit(0)).alias("acc_below"),
        F.coalesce(F.sum("rej").over(below), F.lit(0)).alias("rej_below"),
        F.sum("acc").over(everything).alias("all_acc"),
        F.sum("rej").over(everything).alias("all_rej"),
    ).where("all_acc > 0 and all_rej > 0").withColumn(
        # a whole number, so that equal edges tie exactly
        "gain", F.col("rej_below") * F.col("all_acc") - F.col("acc_below") * F.col("all_rej"))
    best = edges.orderBy(F.desc("gain"), F.abs("bin"), "bin").first()
    return best["bin"] / BINS if best else 0.0


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """`pages` with host, path, rule, verdict and score (null where a rule decided).

    A URL without "://", or null, has an empty host and path, so no rule fits it; it is scored
    whole, and an empty or null one scores 0. URLs repeated in any number of rows are judged once;
    a quarter of the ruled URLs, by digest, is held out for the threshold. Columns of `pages` with
    these names are replaced.
    """
    made = ["host", "path", "rule", "verdict", "score"]
    pages = pages.drop(*made).withColumn("url_", F.coalesce("url", F.lit("")))
    urls = (
        pages.groupBy(F.col("url_").alias("url")).agg(F.count("*").alias("n"))
        .withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
        .withColumn("hit", rule_of(rules))
        .withColumn("held", F.substring(F.md5("url"), 1, 1).isin("0", "1", "2", "3")))
    trains = F.col("hit").isNotNull() & ~F.col("held")
    urls = cut(urls.withColumns({
        "acc": F.when(trains & (F.col("hit.verdict") == "allow"), F.col("n")).otherwise(0),
        "rej": F.when(trains & (F.col("hit.verdict") == "block"), F.col("n")).otherwise(0)}))
    ratios = cut(model(urls))
    scored = cut(scores(urls.where("hit is null or held"), ratios))
    held = urls.where("hit is not null and held").join(scored, "url").select(
        "score", "n", (F.col("hit.verdict") == "allow").alias("accepted"))
    edge = threshold(held)
    score = F.coalesce("score", F.lit(0.0))
    judged = urls.join(scored, "url", "left").select(
        F.col("url").alias("url_"), "host", "path", F.col("hit.rule").alias("rule"),
        F.when(F.col("hit").isNotNull(), F.col("hit.verdict"))
        .when(score >= edge, "allow").otherwise("block").alias("verdict"),
        F.when(F.col("hit").isNull(), score).alias("score"))
    return pages.join(judged, "url_").drop("url_")
