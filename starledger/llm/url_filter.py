"""URL filter with a path-template tree per host.

A rule list decides the urls it fits.  All others are judged by the tree:

1. *Generalise.* Digit runs of a path segment become ``{n}``.  Then, level
   by level below each host, a segment is a wildcard ``*`` where the node
   has many children and this one holds only a small share of its pages.
   The tree is as deep as paths run together: below a node with one path
   left there is nothing to tell apart, so its rest is one last step.
2. *Merge.* Labelled pages are counted per node.  From the root down, a
   branch whose labels do not differ from those of the branch above it
   (chi-square of the 2x2 table) is merged with it and shares its counts;
   a branch that differs keeps its own.
3. *Reject.* The same tree over all hosts together gives each template a
   rate smoothed towards the global one; a host's template is smoothed
   towards that.  Templates whose smoothed share of good labels (purity)
   is under ``min_purity`` are blocked.

Pages are first collapsed to distinct (host, generalised path) with
partial aggregation, so a hot host costs one row per task and path; the
levels work on those rows and are joined on (host, template) with AQE
splitting skewed partitions.  Each level is written to the shared folder.
Only DataFrame functions run; the driver learns the depth of the tree and
the number of labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import ascii_lower, shared_table

MAX_RULES = 500
MIN_CHILDREN = 16      # a node with fewer children keeps them all apart
MIN_SHARE = 0.02       # a child of a wide node below this share is variable
CHI_SQUARE = 3.84      # 95 % point with one degree of freedom
PRIOR_WEIGHT = 4.0
MIN_PURITY = 0.5
ALL_HOSTS = "*"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does.
    ``rules`` holds (``allow`` or ``block``, ``host/path``); a rule fits
    its host and all subdomains if the path starts with its own.  Of rules
    of one length ``block`` wins, then the smaller string."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules; join longer lists as a table")
    best_rule, best_verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # built from the weakest rule to the strongest, so the strongest is tested first
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", [-ord(c) for c in r[1]])):
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        best_rule = F.when(fits, F.lit(rule)).otherwise(best_rule)
        best_verdict = F.when(fits, F.lit(verdict)).otherwise(best_verdict)
    return best_rule, best_verdict


def _segments(path: str) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def _templates(paths: DataFrame, min_children: int | None, min_share: float) -> tuple[DataFrame, int]:
    """``paths`` (host, shape, segs, n, good, bad; distinct host and segs)
    plus ``tree``: the array of prefixes from the root to the page's
    template (without ``min_children`` nothing is generalised); and the most
    steps that any has.  A step takes one job; there are as many as two
    distinct paths of one host have segments in common, and one more."""
    paths = paths.withColumns({"tree": F.array(F.lit("")), "ended": F.size("segs") == 0})
    level = 0
    while not paths.where(~F.col("ended")).isEmpty():
        here = F.element_at("tree", -1)
        at = paths.where(~F.col("ended")).select("host", here.alias("node"), F.get("segs", F.lit(level)).alias("seg"), "n")
        kids = at.groupBy("host", "node", "seg").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("paths"))
        nodes = kids.groupBy("host", "node").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("total"),
                                                 F.sum("paths").alias("paths"))
        rare = (kids.select("host", "node", "seg", "n").join(nodes.where(F.lit(False) if min_children is None else F.col("kids") >= min_children), ["host", "node"])
                .where(F.col("n") < F.col("total") * min_share).select("host", "node", "seg", F.lit(True).alias("rare")))
        # below a node with one path a branch holds what the node holds: it can't differ
        alone = nodes.where("paths = 1").select("host", "node", F.lit(True).alias("alone"))
        paths = (paths.withColumn("node", here).withColumn("seg", F.when(~F.col("ended"), F.get("segs", F.lit(level))))
                 .join(rare, ["host", "node", "seg"], "left").join(alone, ["host", "node"], "left"))
        rest = F.concat_ws("/", F.slice("segs", level + 1, F.greatest(F.size("segs") - level, F.lit(0))))
        step = F.concat("node", F.lit("/"), F.when(F.col("alone"), rest).when(F.col("rare"), "*").otherwise(F.col("seg")))
        paths = paths.withColumns({
            "tree": F.when(F.col("ended"), F.col("tree")).otherwise(F.concat("tree", F.array(step))),
            "ended": F.col("ended") | F.coalesce(F.col("alone"), F.lit(False)) | (F.size("segs") <= level + 1)})
        paths = shared_table(paths.drop("node", "seg", "rare", "alone"), "url-level")
        level += 1
    return paths.drop("ended"), level


def _branches(paths: DataFrame, depth: int, chi_square: float) -> DataFrame:
    """(host, node, b_good, b_bad): label counts of the branch that each
    node belongs to after merging from the root down."""
    nodes = (paths.select("host", F.explode(F.transform("tree", lambda t, i: F.struct(i.alias("level"), t.alias("node"))))
                          .alias("at"), "good", "bad")
             .groupBy("host", "at.level", "at.node").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    parents = (paths.select("host", F.explode(F.transform(
        "tree", lambda t, i: F.struct(t.alias("node"), F.get("tree", i - 1).alias("parent")))).alias("at"))
        .select("host", "at.*").distinct())
    nodes = shared_table(nodes.join(parents, ["host", "node"]), "url-nodes")
    done = nodes.where("level = 0").select("host", "node", F.col("good").alias("b_good"), F.col("bad").alias("b_bad"))
    level = done
    for k in range(1, depth + 1):
        up = level.toDF("host", "parent", "p_good", "p_bad")
        x = nodes.where(F.col("level") == k).join(up, ["host", "parent"])
        good, bad, p_good, p_bad = (F.col(c).cast("double") for c in ("good", "bad", "p_good", "p_bad"))
        n, m = good + bad, p_good + p_bad
        rest_bad, rest = p_bad - bad, m - n
        cross = bad * (rest - rest_bad) - good * rest_bad
        margins = n * rest * p_bad * p_good
        differs = F.when(margins > 0, cross * cross * m / F.when(margins > 0, margins)).otherwise(0.0) >= chi_square
        level = shared_table(x.select("host", "node", F.when(differs, F.col("good")).otherwise(F.col("p_good")).alias("b_good"),
                                      F.when(differs, F.col("bad")).otherwise(F.col("p_bad")).alias("b_bad")),
                             "url-branches")
        done = done.unionByName(level)
    return done


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                labels: DataFrame | None = None, min_children: int = MIN_CHILDREN, min_share: float = MIN_SHARE,
                chi_square: float = CHI_SQUARE, prior_weight: float = PRIOR_WEIGHT,
                min_purity: float = MIN_PURITY) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``host``, ``path``,
    ``rule`` (null if none fits), ``verdict`` (``allow`` or ``block``),
    ``template``, ``purity``.

    ``labels`` (url, bad as 0/1) trains the tree; without it, the pages
    that a rule decides are its labels (allow: good, block: bad).  Null
    urls and urls without ``://`` have empty host and path and the empty
    template.  With no label at all purity is the neutral prior and every
    page is allowed.  Repeated rows give repeated result rows; extra
    columns are ignored; an empty table gives an empty result."""
    url = pages[url_col].cast("string")
    judged = pages.select(pages[id_col].alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("path", "[0-9]+", "{n}"), "/+", "/"), "/$", "")
    judged = judged.withColumns({"rule": rule, "ruled": verdict, "shape": shape})

    if labels is None:
        marked = judged.select("host", "shape", F.when(F.col("ruled") == "block", 1)
                               .when(F.col("ruled") == "allow", 0).alias("bad"))
    else:
        l_url = labels["url"].cast("string")
        marked = judged.select("host", "shape", F.lit(None).cast("int").alias("bad")).unionByName(
            labels.select(host_of(l_url).alias("host"), path_of(l_url).alias("path"), labels["bad"].cast("int").alias("bad"))
            .select("host", shape.alias("shape"), "bad"))
    paths = shared_table(
        marked.groupBy("host", "shape").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("bad") == 0).alias("good"),
            F.count_if(F.col("bad") == 1).alias("bad"))
        .withColumn("segs", _segments("shape")), "url-paths")
    total = paths.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    base = ((total["bad"] or 0) + 1.0) / ((total["good"] or 0) + (total["bad"] or 0) + 2.0) if total else 0.5
    if not (total["good"] or total["bad"]):
        base = 1.0 - min_purity

    paths, depth = _templates(paths, min_children, min_share)
    branch = _branches(paths, depth, chi_square)
    templates = paths.groupBy(F.element_at("tree", -1).alias("shape")).agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    everywhere, levels = _templates(shared_table(templates.select(
        F.lit(ALL_HOSTS).alias("host"), "*", _segments("shape").alias("segs")), "url-templates"), None, min_share)
    shared = _branches(everywhere, levels, chi_square).drop("host").toDF("template", "a_good", "a_bad")
    prior = (F.col("a_bad") + prior_weight * base) / (F.col("a_good") + F.col("a_bad") + prior_weight)
    rate = (F.col("b_bad") + prior_weight * prior) / (F.col("b_good") + F.col("b_bad") + prior_weight)
    learnt = (paths.select("host", "shape", F.element_at("tree", -1).alias("template"))
              .join(branch.withColumnRenamed("node", "template"), ["host", "template"]).join(shared, "template")
              .select("host", "shape", "template", (1.0 - rate).alias("purity")))
    learnt = shared_table(learnt, "url-learnt")
    return judged.join(learnt, ["host", "shape"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("purity") < min_purity, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")
