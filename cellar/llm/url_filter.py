"""URL filtering by mined association rules.

Fixed rules come first: a rule fits its host and all subdomains when the path starts with the
rule's; the longest rule wins. Every other URL is judged by association rules: Spark's FP-growth
mines combinations of URL tokens and a label from labelled URLs, and combinations that imply a
label with enough support and confidence are kept, unless a part of them does as well. URLs find
their rules by an inverted index: every rule is filed under its rarest token, the tokens of a URL
look it up, and the rule fires if all its tokens are there. The rule with the highest confidence
(then support, then fewer tokens, then block) decides; without any the URL is allowed.

Labelled URLs are those that a fixed rule fits (the rule's verdict), or any table of
(url, label) given by the caller. Fixed rules only look at hosts and path starts, so what is mined
from their verdicts must say more than the rules do: their own tokens and all first path parts are
left out, and a combination needs several hosts whose mean share of the label is surer than that of all hosts
beyond chance. Without such a combination a URL is allowed. Mining depends on relative support alone, at every size and for
combinations of any length, so the number of rules doesn't grow with the input; the index join is
an equi-join on tokens of distinct token sets. FP-growth gets one token of each set that always
occurs together, and none whose combinations can be no surer than the token alone.

A null URL, or one without ``://``, has an empty host and path, no tokens and no rule: allowed.
Repeated rows give repeated results.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import cut

#: (host, path, verdict): the fixed rules of the query contract.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
#: Where the labels are the fixed rules' verdicts, a combination counts if the labels of so many
#: hosts with it are farther from all hosts' than chance explains (standard deviations).
MIN_HOSTS = 3
MIN_DEVIATIONS = 2.0
_LABEL = "label="


def _ascii_lower(text: Column) -> Column:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path) of a URL that is not null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2147483647))).otherwise(F.lit(""))
    return (_ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(host_: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host_ == h) | host_.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(host_: Column, path: Column, rest: Column) -> Column:
    """Distinct tokens of a URL: host labels and words, path parts, query names, fragment."""
    labels = F.filter(F.split(host_, r"\."), lambda x: x != "")
    words = F.filter(F.split(host_, r"[.\-_]"), lambda x: x != "")
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    names = F.filter(F.split(F.regexp_extract(rest, r"\?([^#]*)", 1), "&"), lambda x: x != "")

    def tag(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(kind), v))

    return F.array_distinct(F.concat(
        tag("host:", F.when(host_ != "", F.array(host_)).otherwise(F.array().cast("array<string>"))),
        tag("domain:", labels), tag("word:", words), tag("path:", parts),
        tag("ending:", F.filter(F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)), lambda x: x != "")),
        tag("query:", F.transform(names, lambda n: F.substring_index(n, "=", 1)))))


def _classes(sets: DataFrame, least: int, total: int) -> DataFrame:
    """(token, rep, counts, alone) of the tokens with ``least`` rows or more.

    ``sets`` has a row per token set, with its rows and a map of rows by label. Tokens of equal
    rows share a ``rep``. ``alone``: combinations with the token are no surer than without it, as
    all its rows have one label, or as it is in every row.
    """
    seen = sets.select(F.xxhash64("items").alias("a"), F.xxhash64(F.lit(1), "items").alias("b"), "label", "n",
                       F.explode("items").alias("token"))
    by_label = seen.groupBy("token", "label").agg(
        F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    tokens_ = (by_label.groupBy("token").agg(
        F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("label", "n", "a", "b"))).alias("rows"))
        .where(F.col("n") >= least))
    return (tokens_.groupBy("rows", "n").agg(F.min("token").alias("rep"), F.collect_list("token").alias("members"))
            .select("rep", "members", "n", F.transform("rows", lambda r: F.struct(r["label"], r["n"])).alias("counts"),
                    ((F.size("rows") == 1) | (F.col("n") == total)).alias("alone")))


def rule_tokens(rules=RULES) -> list[str]:
    """The tokens that fixed rules consist of: their hosts, host labels and words, path parts."""
    out = set()
    for h, p, _ in rules:
        out |= {f"host:{h}", *(f"domain:{x}" for x in h.split(".") if x), *(f"path:{x}" for x in p.split("/") if x)}
        out |= {f"word:{x}" for x in h.replace("-", ".").replace("_", ".").split(".") if x}
    return sorted(out)


def beyond_chance(found: DataFrame, hosts: DataFrame) -> DataFrame:
    """(items, label) of ``found`` that hold over several hosts, beyond the labels of all hosts.

    ``hosts`` has rows of (host, label, reps, n). Every host counts once, by its share of the label.
    """
    every = hosts.groupBy("host").agg(F.sum("n").alias("all"))
    base = (hosts.groupBy("host", "label").agg(F.sum("n").alias("n")).join(every, "host")
            .groupBy("label").agg(F.sum(F.col("n") / F.col("all")).alias("shares"))
            .crossJoin(F.broadcast(every.agg(F.count("*").alias("hosts"))))
            .select("label", (F.col("shares") / F.col("hosts")).alias("base")))
    # look the combinations up by their rarest token
    sets = hosts.groupBy("host", "label", "reps").agg(F.sum("n").alias("n"))
    token = sets.select(F.explode("reps").alias("token")).groupBy("token").count()
    filed = (found.select("items").distinct().select("items", F.explode("items").alias("token")).join(token, "token")
             .groupBy("items").agg(F.min_by("token", F.struct("count", "token")).alias("token")))
    hits = (sets.withColumn("token", F.explode("reps")).join(filed, "token")
            .where(F.size(F.array_except("items", "reps")) == 0).groupBy("items", "host", "label").agg(F.sum("n").alias("n")))
    all_of = hits.groupBy("items", "host").agg(F.sum("n").alias("all"))
    held = all_of.groupBy("items").agg(F.count("*").alias("hosts"))
    shares = (hits.join(all_of, ["items", "host"]).groupBy("items", "label")
              .agg(F.sum(F.col("n") / F.col("all")).alias("shares")))
    chance = F.sqrt(F.col("base") * (1 - F.col("base")) / F.col("hosts"))
    return (shares.join(held, "items").join(F.broadcast(base), "label")
            .where((F.col("hosts") >= MIN_HOSTS)
                   & (F.col("shares") / F.col("hosts") - F.col("base") > MIN_DEVIATIONS * chance)).select("items", "label"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         by_host: bool = False) -> DataFrame:
    """(rule, items, label, confidence, support): association rules from (items, label) rows.

    Tokens that always occur together are mined as one and told apart again at the end.
    ``by_host``: the rows have a ``host``, and rules must hold over several (``beyond_chance``).
    """
    hosted, labelled = labelled, labelled.select("items", "label")
    total = labelled.count()
    least = max(1, math.ceil(min_support * total))
    sets = cut(labelled.groupBy("items", "label").agg(F.count("*").alias("n")))
    classes = cut(_classes(sets, least, total))
    mates = classes.where("NOT alone").select("rep", F.explode("members").alias("token"))
    reps = (sets.select("items").distinct().select("items", F.explode("items").alias("token")).join(mates, "token")
            .groupBy("items").agg(F.array_sort(F.collect_set("rep")).alias("reps")))
    none = F.array().cast("array<string>")
    baskets = labelled.join(reps, "items", "left").select(F.concat(
        F.coalesce("reps", none), F.array(F.concat(F.lit(_LABEL), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    frequent = model.freqItemsets.select(
        F.array_sort(F.filter("items", lambda i: ~i.startswith(_LABEL))).alias("items"),
        F.filter("items", lambda i: i.startswith(_LABEL)).alias("label"), "freq").where(F.size("items") > 0)
    whole = frequent.where(F.size("label") == 0).select("items", F.col("freq").alias("all"))
    implied = (frequent.where(F.size("label") == 1).join(whole, "items")
               .select("items", F.substring(F.col("label")[0], len(_LABEL) + 1, F.lit(2147483647)).alias("label"),
                       "freq", "all"))
    single = (classes.where("alone").select(F.array("rep").alias("items"), F.col("n").alias("all"), F.explode("counts").alias("c"))
              .select("items", F.col("c.label").alias("label"), F.col("c.n").alias("freq"), "all").where(F.col("freq") >= least))
    found = cut(implied.unionByName(single).select(
        "items", "label", (F.col("freq") / F.col("all")).alias("confidence"), (F.col("freq") / total).alias("support")))
    found = found.withColumn("valid", F.col("confidence") >= min_confidence)
    if by_host:
        # tokens that FP-growth did without stand alone in their combinations
        alone = classes.where("alone").select("rep", F.explode("members").alias("token"))
        named = (sets.select("items").distinct().select("items", F.explode("items").alias("token"))
                 .join(mates.unionByName(alone), "token").groupBy("items").agg(F.collect_set("rep").alias("reps")))
        hosts = (hosted.groupBy("items", "host", "label").agg(F.count("*").alias("n")).join(named, "items", "left")
                 .select("host", "label", F.array_sort(F.coalesce("reps", none)).alias("reps"), "n"))
        sure = beyond_chance(found.where("valid"), hosts).withColumn("sure", F.lit(True))
        found = cut(found.join(sure, ["items", "label"], "left")
                    .withColumn("valid", F.col("valid") & F.coalesce("sure", F.lit(False))).drop("sure"))
    longest = found.where("valid").agg(F.max(F.size("items"))).first()[0]
    if longest is None:
        return found.limit(0).select(F.lit("").alias("rule"), "items", "label", "confidence", "support")
    kept = _surer_than_parts(found, longest)
    # one rule for every choice of one token of each class
    members = classes.select(F.col("rep").alias("item"), "members")
    chosen = (kept.withColumn("item", F.explode("items")).join(members, "item")
              .groupBy("items", "label", "confidence", "support").agg(F.collect_list("members").alias("of"))
              .select("label", "confidence", "support", F.explode(F.aggregate(
                  "of", F.array(none), lambda acc, more: F.flatten(F.transform(acc, lambda got: F.transform(
                      more, lambda x: F.concat(got, F.array(x))))))).alias("items")))
    items = F.array_sort("items")
    return chosen.select(F.array_join(items, " ").alias("rule"), items.alias("items"), "label", "confidence", "support")


def _surer_than_parts(found: DataFrame, longest: int) -> DataFrame:
    """The valid rows of ``found``, of ``longest`` items at most, without those that a valid part
    implies as surely.

    Size by size, a combination takes over the best confidence of its parts from those that
    lack one item; these are all in ``found``, as they are as frequent.
    """
    out, before = [], None
    for size in range(1, longest + 1):
        level = found.where(F.size("items") == size)
        if before is None:
            level = level.withColumn("parts", F.lit(0.0))
        else:
            less = level.select("items", "label", F.explode("items").alias("gone")).withColumn(
                "part", F.array_remove("items", F.col("gone")))
            best = (less.join(before, (less["part"] == before["p"]) & (less["label"] == before["l"]))
                    .groupBy("items", "label").agg(F.max("best").alias("parts")))
            level = level.join(best, ["items", "label"], "left").withColumn("parts", F.coalesce("parts", F.lit(0.0)))
        level = cut(level)
        out.append(level.where(F.col("valid") & (F.col("confidence") > F.col("parts"))))
        before = level.select(F.col("items").alias("p"), F.col("label").alias("l"), F.greatest(
            "parts", F.when(F.col("valid"), F.col("confidence")).otherwise(0.0)).alias("best"))
    kept = out[0]
    for level in out[1:]:
        kept = kept.unionByName(level, allowMissingColumns=True)
    return kept.select("items", "label", "confidence", "support")


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(items, verdict) for every distinct token set of ``urls`` (``items``) that a rule fires on."""
    sets = urls.select("items").distinct().withColumn("key", F.xxhash64("items"))
    token = sets.select(F.explode("items").alias("token")).groupBy("token").count()
    # file every rule under its rarest token
    filed = (rules.select("rule", "label", "confidence", "support", F.col("items").alias("need"),
                          F.explode("items").alias("token"))
             .join(token, "token").groupBy("rule", "label", "confidence", "support", "need")
             .agg(F.min_by("token", F.struct("count", "token")).alias("token")))
    hits = (sets.withColumn("token", F.explode("items")).join(filed, "token")
            .where(F.size(F.array_except("need", "items")) == 0))
    rank = F.struct("confidence", "support", (-F.size("need")).alias("few"), F.col("label"), F.col("rule"))
    return hits.groupBy("items").agg(F.max(rank).alias("best")).select("items", F.col("best.label").alias("said"))


def classify(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """(page_id, url, host, path, rule, verdict) of every row.

    ``labelled``: (url, label) rows to mine from; by default the URLs that a fixed rule fits.
    """
    def parsed(df: DataFrame) -> DataFrame:
        df = df.withColumn("__url", F.coalesce(F.col("url"), F.lit("")))
        h, p = split_url(F.col("__url"))
        df = df.withColumn("host", h).withColumn("path", p)
        return df.withColumn("items", tokens(F.col("host"), F.col("path"), F.col("__url"))).drop("__url")

    got = parsed(pages.select("page_id", "url")).withColumn("fixed", fitting_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        # nor the path start, as far as rules look
        depth = max([sum(x != "" for x in p.split("/")) for _, p, _ in rules], default=0)
        start = F.slice(F.filter(F.split("path", "/"), lambda x: x != ""), 1, depth)
        own = F.concat(F.array(*[F.lit(x) for x in rule_tokens(rules)]).cast("array<string>"),
                       F.transform(start, lambda x: F.concat(F.lit("path:"), x)))
        mined = mine(got.where("fixed IS NOT NULL").select(
            F.array_except("items", own).alias("items"), "host", F.col("fixed.verdict").alias("label")), by_host=True)
    else:
        mined = mine(parsed(labelled.where("label IS NOT NULL").select("url", "label")).select("items", "label"))
    said = judge(got.where("fixed IS NULL"), mined)
    return (got.join(said, "items", "left")
            .select("page_id", "url", "host", "path", F.col("fixed.rule").alias("rule"),
                    F.coalesce("fixed.verdict", "said", F.lit("allow")).alias("verdict")))


def digest(pages: DataFrame) -> DataFrame:
    return classify(pages).select("page_id", "host", "path", "rule", "verdict")
