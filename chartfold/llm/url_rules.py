"""URL filters from given rules and from association rules mined by FP-growth.

Labelled urls become sets of tokens (host parts, path parts, file ending, query names) with
their label as one more item. FP-growth finds frequent sets; those that give a label with
enough confidence are rules. A rule is looked up by its rarest token, so each url meets only
rules of which it holds that token, and then tested for all tokens.

Labels here are the verdicts of the given rules on the urls that these cover, since `labels`
speaks of documents, which `pages` does not name; mined rules judge the other urls.

Skew: work is done on distinct urls, so a host with a third of all pages costs its distinct
urls, and common tokens are seldom a rule's rarest. Tokens that occur in the same labelled
rows are a class and mined as one item, which keeps long, often repeated urls from making
exponentially many sets. Matching takes any token of a class for the class, as FP-growth over
single tokens would give a rule of equal confidence and support for each choice of them.

Defined cases: null urls and urls without `://` have an empty host and path, fit no rule and
are allowed; equal urls get equal verdicts; repeated page ids stay rows of their own; other
columns are ignored; without labelled urls no rule is mined and uncovered urls are allowed.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.llm.text import lower_ascii, table
from chartfold.session import fresh_folder
from chartfold.storage import write_work_table

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
LABEL = "verdict="


def host(url: str | Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path(url: str | Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def fitting_rule(rules=RULES) -> Column:
    """The longest given rule that fits `host` and `path`, or null."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        own = (F.col("host") == name) | F.endswith("host", F.lit("." + name))
        fits.append(F.when(own & F.startswith("path", F.lit(slash + rest)), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def tokens(url: str = "url") -> Column:
    """The distinct tokens of a url. Numbers in paths are one token."""
    parts = F.reverse(F.split("host", r"\."))
    top = F.transform(F.slice(parts, 1, 1), lambda p: F.concat(F.lit("top="), p))
    names = F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit("host="), p))
    steps = F.filter(F.split("path", "/"), lambda p: p != "")
    steps = F.transform(steps, lambda p: F.concat(F.lit("path="), F.regexp_replace(p, r"\d+", "0")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    asked = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""),
                        lambda q: F.concat(F.lit("query="), F.regexp_extract(q, r"^[^=]*", 0)))
    return F.array_distinct(F.concat(top, names, steps, asked))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Rules (antecedent, verdict, confidence, support) from (tokens, label) rows, and classes.

    An antecedent holds items. Classes (token, item) give the item of each token in it: the
    least of the tokens that occur in the same rows.
    """
    spark = labelled.sparkSession
    rows = labelled.withColumn("row", F.monotonically_increasing_id())
    rows = write_work_table(rows, fresh_folder(spark, "url-rows"))
    each = rows.select("row", "label", F.explode("tokens").alias("token"))
    seen = each.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("rows"))
    seen = write_work_table(seen, fresh_folder(spark, "url-tokens"))
    kept = seen.groupBy("n", "rows").agg(F.min("token").alias("item"))
    items = each.join(kept, F.col("token") == F.col("item")).groupBy("row", "label").agg(F.collect_set("item").alias("items"))
    items = items.select(F.array_append("items", F.concat(F.lit(LABEL), "label")).alias("items"))
    model = FPGrowth(minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(LABEL)))
    found = found.select(
        F.sort_array("antecedent").alias("antecedent"),
        F.substring(F.col("consequent")[0], len(LABEL) + 1, 100).alias("verdict"), "confidence", "support")
    found = write_work_table(found, fresh_folder(spark, "url-rules"))
    used = found.select(F.explode("antecedent").alias("item")).distinct()
    classes = seen.join(kept.join(used, "item"), ["n", "rows"]).select("token", "item")
    return found, write_work_table(classes, fresh_folder(spark, "url-classes"))


def match(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """(url, mined_rule, mined_verdict): the best rule of whose items a url holds a token each.

    The best has the highest confidence, then support, then the most tokens of the url, which
    name it. A rule of both labels cannot be: its confidence is above a half.
    """
    named = urls.select("url", F.explode("tokens").alias("token")).join(classes, "token")
    held = named.groupBy("url").agg(F.sort_array(F.collect_set(F.struct("token", "item"))).alias("held"))
    each = held.select("url", "held", F.explode(F.array_distinct("held.item")).alias("item"))
    rare = each.groupBy("item").agg(F.count("*").alias("n"))
    posted = rules.select("*", F.explode("antecedent").alias("item")).join(rare, "item")
    posted = posted.groupBy("antecedent", "verdict", "confidence", "support").agg(
        F.min(F.struct("n", "item"))["item"].alias("item"))
    met = each.join(posted, "item").where(F.size(F.array_except("antecedent", "held.item")) == 0)
    own = F.filter("held", lambda h: F.array_contains("antecedent", h["item"]))["token"]
    best = F.max(F.struct("confidence", "support", F.size(own).alias("size"),
                          F.array_join(own, " ").alias("rule_id"), "verdict"))
    return met.groupBy("url").agg(best.alias("best")).select(
        "url", F.col("best.rule_id").alias("mined_rule"), F.col("best.verdict").alias("mined_verdict"))


def filter_urls(pages: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, and the mined rule where no given one fits."""
    spark = pages.sparkSession
    urls = pages.select("url").distinct().select("url", host("url").alias("host"), path("url").alias("path"))
    urls = urls.select("*", fitting_rule(rules).alias("rule"), tokens().alias("tokens"))
    urls = write_work_table(urls, fresh_folder(spark, "urls"))
    given = F.create_map(*(F.lit(x) for pair in rules.items() for x in pair))[F.col("rule")]
    counted = pages.select("url").join(urls, "url")
    labelled = counted.where("rule IS NOT NULL").select("tokens", given.alias("label"))
    mined, classes = mine(labelled, min_support, min_confidence)
    free = urls.where("rule IS NULL AND size(tokens) > 0")
    judged = urls.join(match(free, mined, classes).withColumnRenamed("url", "met"), F.col("url").eqNullSafe(F.col("met")), "left")
    judged = judged.select("url", "host", "path", "rule", "mined_rule",
                           F.coalesce(given, "mined_verdict", F.lit("allow")).alias("verdict"))
    named = pages.select("page_id", F.col("url").alias("own"))
    return named.join(judged, F.col("own").eqNullSafe(F.col("url"))).select(
        "page_id", "host", "path", "rule", "verdict", "mined_rule")


def op2_url_rules(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))
