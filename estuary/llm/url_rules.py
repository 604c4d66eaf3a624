"""URL filters: explicit host/path rules, and association rules mined for the rest.

Explicit rules decide first: a rule names a host (with all its subdomains) and a
path prefix; the longest rule that fits wins. The URLs that a rule decides are the
labelled set. FP-growth mines frequent combinations of URL tokens with a verdict;
rules of low support or confidence are dropped, and so are rules that a shorter
rule of the same verdict covers with at least their confidence. Other URLs take
the verdict of their most confident matching rule, found by an inverted index: a
rule is filed under the token that the fewest URLs have, looked up by the tokens of a URL, and then
checked against the whole token set. URLs with equal token sets are looked up once.

All steps are DataFrame operations; FP-growth is the distributed one of Spark ML.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import materialize

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"


def url_parts(url: Column) -> dict[str, Column]:
    """host (A-Z lower-cased), path, query and fragment; all '' for a NULL url or
    one without ``://``. The host ends at the first of / ? # after the first ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return {"host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
            "path": F.regexp_extract(tail, r"(?s)^[^?#]*", 0),
            "query": F.regexp_extract(tail, r"(?s)^[^?#]*\?([^#]*)", 1),
            "fragment": F.regexp_extract(tail, r"(?s)#(.*)$", 1)}


def explicit_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(verdict, rule) of the longest fitting rule, NULL if none fits. The
    rule list is an argument of bounded length: one branch for each rule."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the last branch wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def url_tokens(host: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Sorted distinct tokens: host labels (h:) and their words (w:), every directory of the path (d:), the
    last segment without its extension (p:), the extension (x:), the names of query parameters (q:) and
    their values (v:name=value), and whether there is a fragment (f:). Numbers are one
    class, written #. How many tokens a URL has is not limited; minimum support decides what is mined."""
    none = F.array().cast("array<string>")
    tag = lambda c, kind: F.transform(c, lambda x: F.concat(F.lit(kind), x))
    kind_of = lambda x: F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(x)
    some = lambda c: F.filter(c, lambda x: x != "")
    labels = some(F.split(host, r"\."))
    words = some(F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-"))))
    file = F.regexp_extract(path, "([^/]*)$", 1)
    folders = F.transform(some(F.split(F.left(path, F.length(path) - F.length(file)), "/")), kind_of)
    name = kind_of(F.regexp_replace(file, r"\.[A-Za-z][A-Za-z0-9]*$", ""))
    extension = F.lower(F.regexp_extract(file, r"\.([A-Za-z][A-Za-z0-9]*)$", 1))
    names = some(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1)))
    valued = F.filter(F.split(query, "&"), lambda x: x.rlike("^[^=]+=."))
    values = F.transform(valued, lambda x: F.concat(F.regexp_extract(x, "^([^=]*=)", 1), kind_of(F.regexp_extract(x, "(?s)^[^=]*=(.*)", 1))))
    one = lambda c, kind: F.when(c != "", F.array(F.concat(F.lit(kind), c))).otherwise(none)
    parts = F.concat(tag(labels, "h:"), tag(words, "w:"), tag(folders, "d:"), one(name, "p:"), one(extension, "x:"),
                     tag(names, "q:"), tag(values, "v:"), F.when(fragment != "", F.array(F.lit("f:"))).otherwise(none))
    return F.array_sort(F.array_distinct(parts))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (antecedent, verdict, confidence, support) from rows (tokens, verdict).

    An empty labelled set gives no rules. Kept are rules that no rule with a
    proper part of their tokens and the same verdict matches in confidence.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "antecedent array<string>, verdict string, confidence double, support double")
    if labelled.isEmpty():
        return empty
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("=")
                                         & ~F.exists("antecedent", lambda t: t.startswith("=")))
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"),
                         F.substring(F.col("consequent")[0], 2, 100).alias("verdict"), "confidence", "support")
    # every frequent token set of a verdict, with the confidence of its rule where it is one
    sets = model.freqItemsets.select(
        F.array_sort(F.filter("items", lambda t: ~t.startswith("="))).alias("antecedent"),
        F.substring(F.get(F.filter("items", lambda t: t.startswith("=")), F.lit(0)), 2, 100).alias("verdict"))
    sets = materialize(sets.where(F.col("verdict").isNotNull() & (F.size("antecedent") > 0))
                       .join(rules, ["antecedent", "verdict"], "left"), "itemsets")
    return materialize(_uncovered(sets), "url-rules")


def _uncovered(sets: DataFrame) -> DataFrame:
    """The rules among ``sets`` that no rule with a part of their tokens matches in confidence.

    All parts of a frequent set are frequent, so the best confidence below a set is the best of those of
    its parts with one token less: one equi-join for each size, from the smallest on."""
    longest = sets.agg(F.max(F.size("antecedent"))).first()[0] or 0
    own = F.coalesce("confidence", F.lit(0.0))
    level = sets.where(F.size("antecedent") == 1).withColumn("below", F.lit(0.0))
    kept = level
    for n in range(2, longest + 1):
        best = level.select(F.col("antecedent").alias("_part"), F.col("verdict").alias("_v"), F.greatest(own, "below").alias("_best"))
        cur = sets.where(F.size("antecedent") == n)
        parts = cur.select("antecedent", "verdict", F.explode("antecedent").alias("_t")).select(
            "antecedent", "verdict", F.array_remove("antecedent", F.col("_t")).alias("_part"))
        below = (parts.join(best, (parts["_part"] == best["_part"]) & (parts["verdict"] == best["_v"]))
                 .groupBy("antecedent", "verdict").agg(F.max("_best").alias("below")))
        level = materialize(cur.join(below, ["antecedent", "verdict"]), f"itemsets{n}")
        kept = kept.unionByName(level)
    return kept.where(F.col("confidence") > F.col("below")).select("antecedent", "verdict", "confidence", "support")


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, verdict) of every distinct token set that a rule matches: the most
    confident rule, then the best supported, then allow before block."""
    # of the token sets: a rule with a token that none of them has matches nothing and needs no place
    frequency = token_sets.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    filed = (rules.select("antecedent", "verdict", "confidence", "support", F.explode("antecedent").alias("t"))
             .join(frequency, "t").groupBy("antecedent", "verdict", "confidence", "support")
             .agg(F.min(F.struct("n", "t"))["t"].alias("t")))
    best = F.max(F.struct("confidence", "support", (F.col("verdict") == "allow").alias("a"), "verdict"))
    return (token_sets.select("tokens", F.explode("tokens").alias("t")).join(filed, "t")
            .where(F.size(F.array_except("antecedent", "tokens")) == 0)
            .groupBy("tokens").agg(best["verdict"].alias("verdict")))


def judge_urls(pages: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (NULL where none fits) and verdict of every page. Of explicit rules of
    equal length the one that sorts last wins. URLs are read whole, however long.

    NULL and malformed urls have an empty host and path and no tokens: they fit no
    rule and get the default verdict, allow. Repeated rows give repeated rows.
    """
    parts = url_parts(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), *[c.alias(k) for k, c in parts.items()])
    rows = (rows.withColumn("_r", explicit_rule(F.col("host"), F.col("path"), rules))
            .withColumn("tokens", url_tokens(*[F.col(k) for k in parts])))
    rows = materialize(rows.select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                                   F.col("_r.verdict").alias("_given"), "tokens"), "urls")
    learned = mine(rows.where(F.col("_given").isNotNull()).select("tokens", F.col("_given").alias("verdict")),
                   min_support, min_confidence)
    open_sets = rows.where(F.col("_given").isNull()).select("tokens").distinct()
    found = match(open_sets, learned).withColumnRenamed("verdict", "_found")
    return rows.join(found, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("_given", "_found", F.lit(DEFAULT)).alias("verdict"))
