"""URL rules, and a character language-model ratio for the URLs that no rule fits.

Only host and path are modelled: scheme, query and fragment of a URL are no evidence, so URLs that
differ only there get one verdict. Below, a URL stands for its host and path.

Two variable-order Markov models, one of accepted and one of rejected URLs, are learnt from the
URLs that the rules decide. A character is predicted from up to ``ORDER - 1`` characters before
it; each order is smoothed by the next shorter one,

    p(c | h) = (n(h c) + WEIGHT * p(c | h without its first character)) / (n(h) + WEIGHT),

down to a uniform distribution over ``ALPHABET`` characters, so a context that was never seen falls
back by itself. The score of a URL is the mean over its characters of log p_rejected - log
p_accepted. URLs of a held-out quarter of the rules' texts calibrate it: with the means and the
pooled variance of their scores, and their numbers, it becomes the log odds of rejection, and a
URL is blocked where they are positive.

Everything is a DataFrame expression. Counts are taken over all URLs, once per distinct text; the
shorter orders are summed from the distinct longest n-grams, so the only large joins are on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stallkeeper.llm.common import new_stage

ORDER = 5
WEIGHT = 2.0
ALPHABET = 256.0
# Characters before the first and after the last one of a text.
BEFORE, AFTER = "\x02", "\x03"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case."""
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits the host or a domain above it and the beginning of the path.

    The rules are few and given by the caller, so they become one CASE, longest first.
    """
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        found = F.when(fits, rule) if found is None else found.when(fits, rule)
    return found.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def _smoothed(grams: DataFrame, stage) -> DataFrame:
    """``gram, ratio``: log p_rejected - log p_accepted of the last character of each n-gram."""
    both = ("accepted", "rejected")
    prior = None
    for order in range(1, ORDER + 1):
        gram = F.substring("gram", ORDER - order + 1, order)
        counts = grams.groupBy(gram.alias("gram")).agg(*(F.sum(c).alias(c) for c in both))
        contexts = counts.groupBy(F.substring("gram", 1, order - 1).alias("context")).agg(
            *(F.sum(c).alias(f"all_{c}") for c in both)
        )
        level = counts.withColumn("context", F.substring("gram", 1, order - 1))
        level = level.join(contexts, "context")
        if prior is None:
            level = level.select("*", *(F.lit(1.0 / ALPHABET).alias(f"shorter_{c}") for c in both))
        else:
            shorter = prior.select(
                F.col("gram").alias("ending"), *(F.col(f"p_{c}").alias(f"shorter_{c}") for c in both)
            )
            level = level.withColumn("ending", F.substring("gram", 2, order - 1))
            level = level.join(shorter, "ending")
        level = level.select(
            "gram",
            *(
                (
                    (F.col(c) + F.lit(WEIGHT) * F.col(f"shorter_{c}"))
                    / (F.col(f"all_{c}") + F.lit(WEIGHT))
                ).alias(f"p_{c}")
                for c in both
            ),
        )
        prior = stage(level, f"order_{order}")
    return prior.select("gram", (F.log("p_rejected") - F.log("p_accepted")).alias("ratio"))


def judge_urls(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url"):
    """One row per page: key, ``host``, ``path``, ``rule``, ``verdict``, ``score``, ``log_odds``.

    ``rules`` maps rules like ``example.org/docs/`` to ``allow`` or ``block``; a rule decides where
    it fits, the calibrated model elsewhere. Null URLs and URLs without ``://`` have an empty host
    and path; no character speaks against them, so they are allowed, with null ``score``. While the
    rules have decided no URL of one kind, or no held-out one, the log odds are null and all other
    URLs are allowed. Repeated rows are judged alike. Other columns are not read.
    """
    stage = new_stage(pages.sparkSession)
    host, path = url_host(F.col(f"`{url}`")), url_path(F.col(f"`{url}`"))
    judged = pages.select(F.col(f"`{key}`").alias("page"), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    blocking = [r for r, verdict in rules.items() if verdict == "block"]
    judged = judged.withColumn("address", F.concat("host", "path"))
    blocked = F.col("rule").isin(blocking)

    # One row per distinct text; a text always has the same rule.
    texts = judged.where(F.col("address") != "").groupBy("address").agg(
        F.count(F.when(~blocked, 1)).alias("accepted"),
        F.count(F.when(blocked, 1)).alias("rejected"),
    )
    quarter = F.substring(F.md5("address"), 1, 1).isin("0", "1", "2", "3")
    ruled = F.col("accepted") + F.col("rejected") > 0
    texts = stage(texts.withColumn("held_out", quarter & ruled), "texts")
    padded = F.concat(F.lit(BEFORE * (ORDER - 1)), F.col("address"), F.lit(AFTER))
    places = F.sequence(F.lit(1), F.length("address") + 1)
    grams = F.transform(places, lambda i: F.substring(padded, i, F.lit(ORDER)))
    learnt = [
        F.sum(F.when(~F.col("held_out"), F.col(c)).otherwise(0)).alias(c)
        for c in ("accepted", "rejected")
    ]
    counts = texts.select(
        "accepted", "rejected", "held_out", F.explode(grams).alias("gram")
    ).groupBy("gram").agg(*learnt)
    ratios = _smoothed(stage(counts, "grams"), stage)

    scored = texts.where(F.col("held_out") | ~ruled)
    scored = scored.select("address", "rejected", "held_out", F.explode(grams).alias("gram"))
    scored = scored.join(ratios, "gram").groupBy("address", "rejected", "held_out").agg(
        F.avg("ratio").alias("score")
    )
    scored = stage(scored, "scores")
    kinds = {"a": F.col("rejected") == 0, "r": F.col("rejected") > 0}
    facts = [
        f(F.when(kind, x)).alias(f"{name}_{k}")
        for k, kind in kinds.items()
        for name, f, x in (
            ("n", F.count, F.lit(1)),
            ("mean", F.avg, F.col("score")),
            ("squares", F.sum, F.col("score") * F.col("score")),
        )
    ]
    line = scored.where("held_out").agg(*facts)  # one row
    # Without one kind of URL there are no figures, and the line is null.
    line = line.where("n_a > 0 and n_r > 0")
    variance = (
        F.col("squares_a") - F.col("n_a") * F.col("mean_a") * F.col("mean_a")
        + F.col("squares_r") - F.col("n_r") * F.col("mean_r") * F.col("mean_r")
    ) / (F.col("n_a") + F.col("n_r"))
    slope = (F.col("mean_r") - F.col("mean_a")) / F.greatest(variance, F.lit(1e-6))
    line = line.select(
        slope.alias("slope"),
        (F.log(F.col("n_r") / F.col("n_a")) - slope * (F.col("mean_a") + F.col("mean_r")) / 2)
        .alias("intercept"),
    )
    slope, intercept = line.first() or (None, None)
    number = [F.lit(x).cast("double") for x in (slope, intercept)]
    known = scored.where(~F.col("held_out")).select("address", "score")
    log_odds = F.col("score") * number[0] + number[1]
    by_rule = F.when(blocked, "block").when(F.col("rule").isNotNull(), "allow")
    by_model = F.when(log_odds > 0, "block").otherwise("allow")
    return judged.join(known, "address", "left").select(
        F.col("page").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce(by_rule, by_model).alias("verdict"),
        "score",
        log_odds.alias("log_odds"),
    )
