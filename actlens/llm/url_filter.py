"""URL filter: fixed host and path rules, and association rules mined from labels by FP-growth.

A URL is a set of tokens: host labels, path segments with their digits masked, file endings and query keys.
FP-growth over labelled URLs finds token combinations that imply a block; rules are pruned by support, by a floor of
rows that bear them out, by confidence and lift, by significance (the lower bound of the confidence has to lie over
the share of blocked rows), and by shorter rules that say the same. Rules are matched through an inverted index on
their rarest token, then by containment, over the distinct token sets of all URLs.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no tokens and no mined rule; of several
fitting rules the longest wins; of several mined rules the most confident, then the first in order; repeated rows
are judged each; without labels nothing is mined; other columns pass by; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import Scratch

#: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.2
#: blocked rows that bear a rule out, at least; and how many standard errors its confidence may lie too high
MIN_ROWS = 8
ERRORS = 3.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The sorted token set of a URL. All tokens enter matching and mining."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(F.split(F.regexp_replace(path, r"[0-9]+", "#"), r"[/.]"), lambda x: F.concat(F.lit("p:"), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    return F.array_sort(F.array_distinct(F.filter(F.concat(labels, parts, keys), lambda x: F.length(x) > 2)))


def written_out(rules: DataFrame, same: DataFrame) -> DataFrame:
    """The rules with each token (``first``) replaced in turn by all tokens of the same rows (``all``)."""
    plain = same.where("size(all) > 1")
    width = rules.agg(F.max(F.size("tokens"))).first()[0] or 0
    if plain.isEmpty():
        return rules
    out = rules
    for k in range(1, width + 1):
        one = F.get("tokens", F.lit(k - 1))
        out = out.withColumn("first", one).join(plain, "first", "left")
        choices = F.when(F.col("all").isNotNull(), F.col("all")).otherwise(F.array("first"))
        out = out.withColumn("other", F.explode(choices)).withColumn("tokens", F.expr(f"transform(tokens, (x, i) -> if(i = {k - 1}, other, x))")).select(*rules.columns)
    return out.withColumn("tokens", F.array_sort("tokens"))


def mine(urls: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_rows: int = MIN_ROWS, errors: float = ERRORS) -> DataFrame:
    """Rules (tokens, confidence, lift, support) that imply a block.

    ``urls`` has (page_id, tokens), ``labels`` (page_id, blocked boolean). Rarer tokens than the support can bear
    are taken out first; a row left without any still counts. Tokens of the same rows are mined as one, and each
    rule is written for all of them: rules that hold two of them say the same as a shorter rule. The lower bound of a
    confidence is Wilson's, ``errors`` standard errors down.
    """
    from pyspark.ml.fpm import FPGrowth

    scratch = Scratch(urls.sparkSession, "urls")
    known = scratch.put(urls.join(labels.where("blocked is not null and page_id is not null").groupBy("page_id").agg(F.bool_or("blocked").alias("blocked")), "page_id").select("tokens", "blocked"))
    n, blocked = known.agg(F.count("*"), F.count_if("blocked")).first()
    if not blocked:
        return urls.sparkSession.createDataFrame([], "tokens array<string>, confidence double, lift double, support double")
    min_support = max(min_support, min(1.0, min_rows / n))
    seen = scratch.put(known.withColumn("__k", F.monotonically_increasing_id()))
    held = seen.select("__k", F.explode("tokens").alias("t"))
    marks = [F.sum(F.xxhash64("__k", F.lit(salt)).cast("decimal(38,0)")).alias(f"m{salt}") for salt in (1, 2)]
    frequent = held.groupBy("t").agg(F.count("*").alias("count"), *marks).where(F.col("count") >= F.lit(min_support * n))
    same = scratch.put(frequent.groupBy("count", "m1", "m2").agg(F.min("t").alias("first"), F.collect_set("t").alias("all")).select("first", "all"))
    slim = held.join(same.select(F.col("first").alias("t")), "t").groupBy("__k").agg(F.collect_set("t").alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    rows = scratch.put(seen.join(slim, "__k", "left").select(F.when(F.col("blocked"), F.array_append(items, F.lit("y:block"))).otherwise(items).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(rows)
    rows_of = F.col("support") * n / F.col("confidence")
    z, c = errors**2, F.col("confidence")
    lower = (c + z / (2 * rows_of) - errors * F.sqrt(c * (1 - c) / rows_of + z / (4 * rows_of * rows_of))) / (1 + z / rows_of)
    found = model.associationRules.where((F.col("consequent")[0] == "y:block") & (F.col("lift") >= min_lift) & (lower > blocked / n))
    found = scratch.put(found.select(F.array_sort("antecedent").alias("tokens"), "confidence", "lift", "support"))
    found = scratch.put(written_out(found, same))
    other = found.select(F.col("tokens").alias("t2"), F.col("confidence").alias("c2"))
    wider = other.select(F.col("t2"), F.col("c2"), F.element_at("t2", 1).alias("one"))
    inside = found.select("tokens", "confidence", F.explode("tokens").alias("one")).join(wider, "one").where("size(t2) < size(tokens) and c2 >= confidence and size(array_except(t2, tokens)) = 0")
    return found.join(inside.select("tokens").distinct(), "tokens", "left_anti")


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined_rule, confidence): for each distinct token set the best rule that it contains."""
    written = F.array_join("rule_tokens", " ")
    ruled = rules.select(F.col("tokens").alias("rule_tokens"), "confidence")
    sets = token_sets.select("tokens").distinct()
    use = ruled.select(F.explode("rule_tokens").alias("t")).groupBy("t").count()
    rarest = ruled.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("t")).join(use, "t").groupBy("rule_tokens", "confidence").agg(F.min(F.struct("count", "t"))["t"].alias("t"))
    hits = sets.select("tokens", F.explode("tokens").alias("t")).join(rarest, "t").where("size(array_except(rule_tokens, tokens)) = 0")
    best = hits.groupBy("tokens").agg(F.max_by(F.struct(written.alias("mined_rule"), "confidence"), F.struct("confidence", written)).alias("b"))
    return best.select("tokens", "b.mined_rule", "b.confidence")


def judge(pages: DataFrame, labels: DataFrame, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, mined_rule, confidence) of every row.

    ``labels`` has (page_id, blocked). The fixed rule decides where one fits; else a mined rule blocks, and
    what no rule finds is allowed.
    """
    scratch = Scratch(pages.sparkSession, "judged")
    url = F.col("url")
    split = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).withColumn("host", host_of(url)).withColumn("path", path_of(url))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = split.withColumn("rule", rule).withColumn("fixed", verdict).withColumn("tokens", tokens_of(url, F.col("host"), F.col("path")))
    mined = scratch.put(mine(rows.select("page_id", "tokens"), labels))
    found = scratch.put(matched(rows, mined))
    # rows without a token, all of one key, need no join
    bare = rows.where(F.size("tokens") == 0).select("*", F.lit(None).cast("string").alias("mined_rule"), F.lit(None).cast("double").alias("confidence"))
    out = rows.where(F.size("tokens") > 0).join(found, "tokens", "left").unionByName(bare)
    final = F.coalesce("fixed", F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("page_id").alias(id_col), "host", "path", "rule", final.alias("verdict"), "mined_rule", "confidence")


def held_out_precision(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", parts: int = 4) -> tuple[int, float]:
    """Of the labelled pages kept out of mining: those that a mined rule blocks, and the share of them that is labelled so.

    Every ``parts``-th page by a hash of its id is kept out.
    """
    aside = F.pmod(F.xxhash64("page_id", F.lit(5)), F.lit(parts)) == 0
    judged = judge(pages, labels.where(~aside), rules=(), id_col=id_col, url_col=url_col)
    known = labels.where(aside & F.col("blocked").isNotNull()).groupBy("page_id").agg(F.bool_or("blocked").alias("blocked"))
    both = judged.where("mined_rule is not null").select(F.col(id_col).alias("page_id")).join(known, "page_id")
    n, share = both.agg(F.count("*"), F.avg(F.col("blocked").cast("double"))).first()
    return n, share if n else 1.0
