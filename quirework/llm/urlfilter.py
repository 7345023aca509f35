"""URL filter: rules first, then a tree of path templates for each host.  DataFrame functions only.

Templates.  A path is cut into segments; segments that vary by nature (digits, hexadecimal runs, long tokens; an
extension is kept) become a wildcard.  Then, level by level, a node's rare children (less than ``share`` of the node)
whose label rate doesn't differ from the node's become one wildcard, and of the others those siblings are merged that
lead to the same shapes and, in order of their rates, don't differ from their neighbour.  Two rates differ if a
two-proportion test says so at ``Z`` standard errors, so one observation never counts like a thousand.  A branch is
followed as long as two shapes share it.

Labels.  The rules' verdicts label the urls that they fit.  A template's purity is smoothed upward: (block + strength *
prior) / (labelled + strength), where its prior is that of its shapes among related hosts (those of the same last two
host labels), whose prior is that of the shape on any host, whose prior is one half.  So labelled branches speak for
equal paths of hosts that no rule covers.  Templates of which the purity exceeds ``reject`` are blocked, and with them
the urls that no rule fits.

Skew: url rows are reduced to counts by (host, shape) with map-side sums before anything meets; a node keeps at most
1 / ``share`` children and those that the labels set apart; the join back is on (host, shape) against one row each.

Edge cases: a null url, or one without "://", has an empty host and path and takes no rule; repeated urls are judged
alike; columns that clash with the result's names are replaced; a path of any depth or length is one branch of its own
from where no other shares it; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.sources.scratch import Scratch

#: (host, path, verdict): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
SHARE, Z, STRENGTH, REJECT = 0.05, 1.96, 2.0, 0.7


def parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path)."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    host = F.when(at > 0, F.regexp_extract(rest, r"^([^/?#]*)", 1)).otherwise("")
    path = F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    host = F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))
    return host, F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host/path, its verdict) of the longest rule that fits, else nulls."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return rule, verdict


def shape(path: Column) -> Column:
    """Segments, those that vary by nature as wildcards."""
    segments = F.slice(F.split(path, "/"), 2, 1 << 30)
    return F.transform(
        segments,
        lambda s: F.when(s == "", F.lit("")).otherwise(F.regexp_replace(s, r"^(?:[0-9]+|[0-9a-fA-F-]{8,}|[^.]*[0-9][^.]*|[^.]{25,})(?=\.[A-Za-z]{1,5}$|$)", "*")),
    )


def smoothed(block: Column, labelled: Column, prior: Column, strength: float = STRENGTH) -> Column:
    return (block + prior * strength) / (labelled + strength)


def differ(b: Column, n: Column, c: Column, m: Column, z: float = Z) -> Column:
    """Whether the proportions b / n and c / m are apart by a two-proportion test; without observations they aren't."""
    pooled, one = F.try_divide(b + c, n + m), F.lit(1.0)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(one, n) + F.try_divide(one, m)))
    return F.coalesce(F.abs(F.try_divide(b, n) - F.try_divide(c, m)) > z * error, F.lit(False))


def tree(counts: DataFrame, scratch: Scratch, share: float = SHARE) -> DataFrame:
    """(host, shape, n, labelled, block) -> the same rows with ``template``, the merged path of their branch."""
    df = counts.withColumns({"template": F.lit(""), "_at": F.lit(0)})
    node, level, done = ["host", "template"], 0, None
    while True:
        # a node with one shape is a branch of its own: what is left of it names it
        alone = df.groupBy(*node).agg(F.count("*").alias("_shapes"))
        df = scratch.cut(df.join(alone, node), f"level-{level}")
        left = F.slice("shape", F.col("_at") + 1, F.greatest(F.size("shape") - F.col("_at"), F.lit(0)))
        ended = (F.col("_shapes") == 1) | (F.col("_at") >= F.size("shape"))
        rest = df.where(ended).withColumn("template", F.concat("template", F.array_join(F.transform(left, lambda s: F.concat(F.lit("/"), s)), "")))
        done = rest.drop("_shapes", "_at") if done is None else done.unionByName(rest.drop("_shapes", "_at"))
        df = df.where(~ended).drop("_shapes")
        if df.isEmpty():
            return done
        df = df.withColumn("_seg", F.element_at("shape", F.col("_at") + 1))
        below = F.array_join(F.transform(F.slice("shape", F.col("_at") + 2, F.size("shape")), lambda s: F.when(s.contains("*"), s).otherwise("x")), "/")
        child = df.groupBy(*node, "_seg").agg(F.sum("n").alias("_n"), F.sum("labelled").alias("_l"), F.sum("block").alias("_b"), F.array_join(F.array_sort(F.collect_set(below)), "|").alias("_below"))
        child = scratch.cut(child, f"children-{level}")
        total = child.groupBy(*node).agg(F.sum("_n").alias("_all"), F.sum("_l").alias("_all_l"), F.sum("_b").alias("_all_b"))
        child = child.join(total, node)
        others = differ(F.col("_b"), F.col("_l"), F.col("_all_b") - F.col("_b"), F.col("_all_l") - F.col("_l"))
        rare = (F.col("_n") < share * F.col("_all")) & (F.col("_seg") != "") & ~others
        child = scratch.cut(child.withColumn("_fold", F.when(rare, F.lit("*")).otherwise(F.col("_seg"))), f"folded-{level}")
        kept = child.groupBy(*node, "_fold").agg(F.sum("_l").alias("_l"), F.sum("_b").alias("_b"), F.max("_below").alias("_below"))
        # siblings in order of their rates: a new name begins where one differs from the one before it
        # those without labels are among themselves
        kept = kept.withColumn("_told", F.col("_l") > 0)
        order = Window.partitionBy(*node, "_below", "_told").orderBy(F.coalesce(F.try_divide("_b", "_l"), F.lit(0.5)), "_fold")
        apart = differ(F.col("_b"), F.col("_l"), F.lag("_b").over(order), F.lag("_l").over(order)) | (F.col("_fold") == "") | (F.lag("_fold").over(order) == "")
        kept = kept.withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("_run", F.sum("_new").over(order))
        run = Window.partitionBy(*node, "_below", "_told", "_run")
        kept = kept.withColumns({"_many": F.count("*").over(run), "_one": F.min("_fold").over(run)})
        name = F.when(F.col("_many") > 1, F.concat(F.lit("{"), F.col("_one"), F.lit("~}"))).otherwise(F.col("_fold"))
        names = child.select(*node, "_seg", "_fold").join(kept.select(*node, "_fold", name.alias("_name")), [*node, "_fold"]).drop("_fold")
        names = scratch.cut(names, f"names-{level}")
        df = df.join(names, [*node, "_seg"]).withColumns({"template": F.concat("template", F.lit("/"), "_name"), "_at": F.col("_at") + 1}).drop("_seg", "_name")
        level += 1


def purities(placed: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """(host, template, purity) by the labels of the template, of its shapes on related hosts, and on any host."""
    labels = placed.withColumns({"family": family(F.col("host")), "path": F.array_join("shape", "/")})
    sums = [F.sum("block").alias("_b"), F.sum("labelled").alias("_l")]
    any_ = labels.groupBy("path").agg(*sums).select("path", smoothed(F.col("_b"), F.col("_l"), F.lit(0.5), strength).alias("_any"))
    related = labels.groupBy("family", "path").agg(*sums).join(any_, "path").select("family", "path", smoothed(F.col("_b"), F.col("_l"), F.col("_any"), strength).alias("_related"))
    own = labels.join(related, ["family", "path"]).groupBy("host", "template").agg(*sums, (F.sum(F.col("_related") * F.col("n")) / F.sum("n")).alias("_prior"))
    return own.select("host", "template", smoothed(F.col("_b"), F.col("_l"), F.col("_prior"), strength).alias("purity"))


def family(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def judge(pages: DataFrame, *, url: str = "url", rules=RULES, reject: float = REJECT) -> DataFrame:
    """``pages`` and host, path, rule, template, purity, verdict (allow or block)."""
    s = Scratch(pages.sparkSession, "urls")
    host, path = parts(F.col(url))
    rows = pages.drop("template", "purity", "rule", "verdict").withColumns({"host": host, "path": path})
    rule, label = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_label": label, "_shape": shape(F.col("path"))})
    counts = rows.groupBy("host", F.col("_shape").alias("shape")).agg(F.count("*").alias("n"), F.count("_label").alias("labelled"), F.sum(F.when(F.col("_label") == "block", 1).otherwise(0)).alias("block"))
    placed = s.cut(tree(s.cut(counts, "counts"), s), "placed")
    templates = placed.select("host", F.col("shape").alias("_shape"), "template").join(purities(placed), ["host", "template"])
    templates = s.cut(templates, "templates")
    out = rows.join(templates, ["host", "_shape"], "left")
    verdict = F.coalesce("_label", F.when(F.col("purity") > reject, "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).drop("_label", "_shape")
