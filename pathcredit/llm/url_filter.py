"""URL filter: host and path rules, and a character language-model ratio where no rule fits.

URLs that a rule accepts and those that one rejects train two smoothed
variable-order Markov models over characters: the probability of a character
after its context of ``ORDER`` characters interpolates the counts of that
context with those of ever shorter contexts down to the uniform distribution,
each weighted by how many different characters followed it (Witten-Bell). URLs
are written in an alphabet of at most 32 symbols, and one that stands before the
first, so there are at most 33**ORDER * 32 different (context, character) pairs:
that proven bound lets the table of log ratios be broadcast at any input size.

A URL's score is the mean over its characters of ln p(accepted) - ln p(rejected).
The cut between the two is calibrated on a fifth of the ruled URLs that the
models have not seen: where two normal densities with those scores' means, their
common variance and the classes' shares cross.

Everything is DataFrame expressions: characters are exploded and summed in the
map stage, so one narrow row per URL is shuffled and no key is hot.

Defined results: null URLs and those without ``://`` have empty host and path,
no rule, and the method's verdict on the empty text; repeated rows are judged
one by one; with only one class of ruled URLs the method allows everything if
none is rejected, else blocks if none is accepted; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import ascii_lower, materialize

ORDER = 3
SYMBOLS = 32  # 26 letters, one for digits, "/", ".", "-", one for all others, and the end mark
START, DIGIT, OTHER, END = "^", "0", "~", "$"

#: Production rules: (verdict, host/path prefix).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits a host or its subdomains and begins the path; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def symbols_of(url: Column) -> Column:
    """The URL in the models' alphabet."""
    lower = ascii_lower(F.coalesce(url, F.lit("")))
    digits = F.regexp_replace(lower, "[0-9]", DIGIT)
    return F.regexp_replace(digits, "[^a-z0/.\\-]", OTHER)


def grams_of(symbols: Column) -> Column:
    """Every character with its context, as strings of ORDER + 1 symbols."""
    padded = F.concat(F.lit(START * ORDER), symbols, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(symbols) + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, ratio): ln p(last character | the rest) of the accepted less that of the rejected.

    ``counts`` has every gram with its numbers in ``allow`` and ``block`` training
    URLs. All tables here are bounded by the alphabet.
    """
    classes = ("allow", "block")
    p = {c: F.lit(1.0 / SYMBOLS) for c in classes}
    out = counts.select("gram")
    for k in range(ORDER + 1):
        pair = F.substring("gram", ORDER + 1 - k, k + 1)
        seen = counts.groupBy(pair.alias(f"g{k}")).agg(*[F.sum(c).alias(f"{c}_n{k}") for c in classes])
        after = seen.groupBy(F.substring(f"g{k}", 1, k).alias(f"c{k}")).agg(
            *[F.sum(f"{c}_n{k}").alias(f"{c}_all{k}") for c in classes],
            *[F.count_if(F.col(f"{c}_n{k}") > 0).alias(f"{c}_kinds{k}") for c in classes])
        out = (out.withColumn(f"g{k}", pair).withColumn(f"c{k}", F.substring("gram", ORDER + 1 - k, k))
               .join(seen, f"g{k}").join(after, f"c{k}"))
        for c in classes:
            n, total, kinds = (F.col(f"{c}_{x}{k}") for x in ("n", "all", "kinds"))
            p[c] = F.when(total > 0, (n + kinds * p[c]) / (total + kinds)).otherwise(p[c])
    return out.select("gram", (F.log(p["allow"]) - F.log(p["block"])).cast("float").alias("ratio"))


def _cut(held: DataFrame) -> float:
    """Where the two classes' normal densities cross, from one row of moments."""
    m = held.groupBy().agg(*[f(F.when(F.col("accepted") == a, F.col("ratio"))).alias(f"{n}{int(a)}")
                             for a in (True, False) for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_pop))]
                           ).first()
    if not m["n1"] or not m["n0"] or m["mean1"] <= m["mean0"]:
        return 0.0
    variance = (m["n1"] * m["var1"] + m["n0"] * m["var0"]) / (m["n1"] + m["n0"])
    middle = (m["mean1"] + m["mean0"]) / 2
    return middle + variance / (m["mean1"] - m["mean0"]) * math.log(m["n0"] / m["n1"])


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, ratio) for every row of ``pages``; ``ratio`` is the calibrated score."""
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        symbols_of(url).alias("symbols"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = materialize(base.select(
        F.monotonically_increasing_id().alias("row"), "*", rule.alias("rule"), verdict.alias("says"),
        (F.conv(F.substring(F.md5("symbols"), 1, 8), 16, 10).cast("long") % 5 == 0).alias("held")))
    exploded = rows.select("row", "says", "held", F.explode(grams_of(F.col("symbols"))).alias("gram"))

    counted = materialize(exploded.groupBy("gram").agg(*[
        F.count_if((F.col("says") == s) & ~F.col("held")).alias(s) for s in ("allow", "block")]))
    trained = counted.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in ("allow", "block")]).first()
    if not trained["allow"] or not trained["block"]:
        default = "block" if trained["block"] else "allow"
        return rows.select(F.col("id").alias(id_col), "host", "path", "rule",
                           F.coalesce("says", F.lit(default)).alias("verdict"), F.lit(None).cast("double").alias("ratio"))
    ratios = materialize(log_ratios(counted))

    scored = materialize(
        exploded.select("row", "gram").join(F.broadcast(ratios), "gram")  # at most 33**ORDER * 32 rows
        .groupBy("row").agg(F.avg("ratio").alias("ratio")).join(rows, "row")
        .select("id", "host", "path", "rule", "says", "held", "ratio"))
    held = scored.where("held and says is not null").select((F.col("says") == "allow").alias("accepted"), "ratio")
    ratio = F.col("ratio") - F.lit(_cut(held))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("says", F.when(ratio >= 0, "allow").otherwise("block")).alias("verdict"),
                         ratio.alias("ratio"))
