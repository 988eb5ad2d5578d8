"""URL filters: explicit host and path rules, and association rules mined by FP-growth.

A URL becomes a set of tokens (scheme, host suffixes, host words, path segments, query keys). Spark's
FP-growth mines the labelled URLs' token sets, each with its label as one more item; rules whose
consequent is `block` stay if support, confidence and lift over the share of blocked URLs reach the
given bounds (allow is what a URL without a rule gets). The rules form an inverted index keyed by their
rarest token: a URL looks up only the rules posted under its own tokens and then must hold the whole
antecedent. The rule of highest confidence, then support, then smallest text decides.

Labels are what the explicit rules say of the URLs that they fit; a table of labels by page can be given
instead. Of tokens that only one explicit rule blocks no more is known than that rule says, so a mined
rule may only name tokens which at least `min_rules` of them block: what blocked URLs of several rules
have in common carries over to other hosts. A rule needs `min_count` labelled URLs, and `min_support` of them all, which bounds how many token sets
FP-growth can find frequent.

DataFrame operations only. Distinct URLs are matched. A URL that more than 1/200 of the looked-up rows
have is one of fewer than 200, whose verdicts are broadcast; the rows of the others are dealt by URL.
Rows without a URL, or with an explicit rule, are not dealt at all.

Defined cases: a null URL or one without `://` has an empty host and path, no tokens, and gets
`allow`; so does an empty one; a URL of any length is one row; without labels no rule is mined; labels
that are null are not used, of several for a page one `block` suffices; repeated rows get the same verdict
each; of rules alike in confidence, support and text there is one; an empty table gives an empty result;
columns with a result's name are replaced, others of any name pass through.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fresh, join_hot, written

#: The rules of the contract, (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL that has ://, else none."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    tagged = lambda tag, items: F.transform(items, lambda x: F.concat(F.lit(tag), x))
    suffixes = F.transform(F.when(n > 0, F.sequence(F.lit(1), F.least(n, F.lit(2)))).otherwise(F.array().cast("array<int>")), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    words = F.filter(F.split(F.array_join(F.slice(labels, 1, F.greatest(n - 2, F.lit(0))), "-"), "-"), lambda x: x != "")
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    keys = F.transform(F.filter(F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"), lambda x: x != ""), lambda x: F.substring_index(x, "=", 1))
    scheme = F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1)))
    every = F.array_distinct(F.concat(scheme, tagged("host:", suffixes), tagged("word:", words), tagged("path:", segments), tagged("key:", keys)))
    return F.when(F.instr(url, "://") > 0, every).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, *, min_support: float = 0.001, min_count: int = 10, min_confidence: float = 0.8, min_lift: float = 1.2, min_rules: int = 2) -> DataFrame:
    """labelled: tokens, block (boolean) and, if known, by (the explicit rule that says so). Rules: antecedent, rarest, confidence, support (rows with antecedent and label)."""
    schema = "antecedent array<string>, rarest string, confidence double, support double"
    n, blocked = labelled.agg(F.count("*"), F.count_if("block")).first()
    # where not even the label is frequent, no rule can be; that count costs less than mining
    if not n or blocked < max(min_support * n, min_count):
        return labelled.sparkSession.createDataFrame([], schema)
    items = labelled.select(F.when(F.col("block"), F.array_append("tokens", F.lit("=block"))).otherwise(F.col("tokens")).alias("items")).where(F.size("items") > 0)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_count / n)), minConfidence=min_confidence).fit(items)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rules = model.associationRules.where((F.col("consequent")[0] == "=block") & (F.col("lift") >= min_lift)).select(F.sort_array("antecedent").alias("antecedent"), "confidence", "support")
    each = rules.select("*", F.explode("antecedent").alias("token")).join(single, "token")
    if "by" in labelled.columns:
        general = labelled.where("block").select(F.explode("tokens").alias("token"), "by").distinct().groupBy("token").count().where(F.col("count") >= min_rules).select("token")
        whole = each.join(general, "token").groupBy("antecedent").count().where(F.col("count") == F.size("antecedent")).select("antecedent")
        each = each.join(whole, "antecedent")
    return each.groupBy("antecedent", "confidence", "support").agg(F.min(F.struct("freq", "token"))["token"].alias("rarest")).select("antecedent", "rarest", "confidence", "support")


def match(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Distinct urls that some rule matches, with the best rule: url, n (rows that have it), mined (antecedent as text)."""
    posted = urls.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("url")).agg(F.count("*").alias("n")).withColumn("tokens", tokens_of(F.col("url")))
    looked = posted.select("url", "n", "tokens", F.explode("tokens").alias("rarest")).join(rules, "rarest")
    full = looked.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.array_join("antecedent", " ").alias("mined")))["mined"]
    return full.groupBy("url", "n").agg(best.alias("mined"))


def judge(pages: DataFrame, labels: DataFrame | None = None, *, rules=RULES, url: str = "url", page_id: str = "page_id", label_id: str = "doc_id", **options) -> DataFrame:
    """pages with host, path, rule, verdict and mined (the antecedent that blocked, if any). labels: label_id, block; if not given, the explicit rules' verdicts."""
    result = ["host", "path", "rule", "verdict", "mined"]
    rest = pages.drop(*result)
    explicitly, key = fresh(rest, "explicitly"), fresh(rest, "key")
    rule, verdict = explicit(F.col("host"), F.col("path"), rules)
    judged = rest.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).withColumns({"rule": rule, explicitly: verdict})
    if labels is None:
        known = judged.where(F.col(explicitly).isNotNull()).select(tokens_of(F.col(url)).alias("tokens"), (F.col(explicitly) == "block").alias("block"), F.col("rule").alias("by"))
    else:
        said = labels.where("block is not null").groupBy(F.col(label_id).alias("i")).agg(F.bool_or("block").alias("block"))
        known = pages.select(F.col(page_id).alias("i"), tokens_of(F.col(url)).alias("tokens")).join(said, "i").select("tokens", "block")
    found = written(mine(written(known, "url-labelled"), **options), "url-rules")
    asked = judged["rule"].isNull() & (F.instr(url, "://") > 0)
    open_ = judged.where(asked).withColumn(key, F.col(url))
    best = written(match(open_, found, url).withColumnRenamed("url", key), "url-verdicts")
    by_rule = join_hot(open_, best, [key], open_.count(), how="left").drop("n")
    decided = judged.where(F.coalesce(~asked, F.lit(True))).withColumn("mined", F.lit(None).cast("string"))
    both = decided.unionByName(by_rule.drop(key))
    return both.withColumn("verdict", F.coalesce(F.col(explicitly), F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))).drop(explicitly)


#: The rules by counting every subset of the labelled URLs' tokens.
SQL = r"""
WITH p AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
e AS (
  SELECT *, CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
         list_filter(string_split(host, '.'), lambda x: x <> '') AS l FROM p),
t AS (
  SELECT *, CASE WHEN contains(url, '://') THEN list_distinct(
      ['scheme:' || string_split(url, '://')[1]]
      || list_transform(range(1, least(len(l), 2) + 1), lambda k: 'host:' || array_to_string(l[len(l) - k + 1:len(l)], '.'))
      || list_transform(list_filter(string_split(array_to_string(l[1:greatest(len(l) - 2, 0)], '-'), '-'), lambda x: x <> ''), lambda x: 'word:' || x)
      || list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path:' || regexp_replace(x, '[0-9]+', '#', 'g'))
      || list_transform(list_filter(string_split(regexp_extract(url, '(?s)\?([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: 'key:' || string_split(x, '=')[1])) ELSE [] END AS tokens FROM e),
g AS (SELECT list_sort(tokens) AS tokens, rule IN ('net/', 'example.com/de/') AS block FROM t WHERE rule IS NOT NULL),
o AS (SELECT token FROM (SELECT unnest(tokens) AS token, rule FROM t WHERE rule IN ('net/', 'example.com/de/')) GROUP BY token HAVING count(DISTINCT rule) >= 2),
n AS (SELECT count(*) AS n, count(*) FILTER (block) AS blocked FROM g),
m AS (SELECT list_filter(tokens, lambda x, i: (b >> (i - 1)) % 2 = 1) AS items, block FROM g, unnest(range(1, CAST(pow(2, len(tokens)) AS BIGINT))) AS u(b)),
r AS (SELECT items, count(*) FILTER (block) / count(*) AS confidence, count(*) FILTER (block) AS support FROM m GROUP BY items
      HAVING count(*) FILTER (block) >= ceil((SELECT least(1.0, greatest(0.001, 10 / n)) * n FROM n)) AND count(*) FILTER (block) / count(*) >= 0.8
      AND count(*) FILTER (block) / count(*) / (SELECT blocked / n FROM n) >= 1.2
      AND list_has_all((SELECT list(token) FROM o), items))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN EXISTS (SELECT 1 FROM r WHERE list_has_all(t.tokens, r.items)) THEN 'block' ELSE 'allow' END AS verdict
FROM t
"""
