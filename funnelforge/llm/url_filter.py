"""URL verdicts from rules and a path-template tree, in DataFrame functions only.

Rules decide what they fit; the longest wins.  For all other urls a tree of path
templates is learned per host.  Distinct (host, path) pairs are counted first,
with the verdicts that rules gave to them as labels.  Segments that are numbers,
dates, hashes and the like become wildcards by their shape; then, level by
level, a node whose many children have few paths each below them, or mostly the
same ones, has a variable segment there and its children become one ``*``; how
often a url is repeated does not matter.  Then siblings that lead to the same kinds of paths are
merged, labels aside: a branch whose paths' shapes below it (literal words, numbers,
dates, depth, endings) do not differ significantly from those of all its siblings
(chi-square) becomes ``{}``, so a branch without labels joins labelled ones.  The
templates of a branch are rejected if its purity, the blocked share of the labels of
all its urls smoothed towards the overall share, reaches ``reject``; a branch without
any label is allowed.

Everything is counted by partial aggregates, so a host with a third of all urls
needs no task of its own.

Defined results: null urls and urls without ``://`` have an empty host and path
and no rule, and are allowed unless their (empty) template is rejected; repeated
rows count as given; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Rules (host, path, verdict), fixed values.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MAX_RULES = 1000
#: Shapes of variable segments, first match wins; an extension stays.
SHAPES = [
    ("<date>", r"[0-9]{4}-[0-9]{1,2}(?:-[0-9]{1,2})?"),
    ("<num>", r"[0-9]+"),
    ("<uuid>", r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
    ("<hex>", r"(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{8,}"),
    ("<mixed>", r"(?=[^0-9]*[0-9])[A-Za-z0-9_-]{12,}"),
]
EXTENSION = r"(\.[A-Za-z]{1,5})?"
#: Segments from this depth on are one tail.
DEEPEST = 16
#: A node with at least so many children, each with at most so many distinct paths on average, has a variable segment ...
MANY_CHILDREN, SEEN = 20, 3.0
#: ... and also if what follows a child follows this share of its siblings on average.
COMMON = 0.5
#: Siblings whose shapes lie within this normal quantile of their pool's are merged.
ALIKE = 2.326
PRIOR_WEIGHT = 4.0
REJECT = 0.8


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    after = F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def _first_rule(rules: list[tuple[str, str, str]], pick) -> Column:
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        host, path, _ = rule
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        out = F.when(fits, F.lit(pick(rule))).otherwise(out)
    return out


def _typed(segment: Column) -> Column:
    """A segment, or its shape if that is variable."""
    out = segment
    for name, pattern in reversed(SHAPES):
        whole = f"^{pattern}{EXTENSION}$"
        out = F.when(F.rlike(segment, F.lit(whole)), F.concat(F.lit(name), F.regexp_extract(segment, whole, 1))).otherwise(out)
    return out


def _variable(literals: DataFrame) -> DataFrame:
    """(host, template) of nodes whose next segment is a variable."""
    children = literals.groupBy("host", "template").agg(
        F.count_distinct("segment").alias("children"), F.count_distinct("segment", "rest").alias("paths"),
        F.count_distinct("rest").alias("rests"))
    return (children.where((F.col("children") >= MANY_CHILDREN)
                           & ((F.col("paths") <= SEEN * F.col("children"))
                              | (F.col("paths") >= COMMON * F.col("children") * F.col("rests"))))
            .select("host", "template", F.lit(True).alias("variable")))


def _alike(literals: DataFrame) -> DataFrame:
    """(host, branch, segment) of children, two at least of a node, whose paths have
    the same mix of shapes as all of the node's children together."""
    node = ["host", "branch"]
    kinds = literals.groupBy(*node, "segment", "shape").agg(F.count("*").alias("n"))
    pool = kinds.groupBy(*node, "shape").agg(F.sum("n").alias("pooled"))
    total = pool.groupBy(*node).agg(F.sum("pooled").alias("total"), (F.count("*") - 1).alias("df"))
    child = kinds.join(pool, [*node, "shape"]).groupBy(*node, "segment").agg(
        F.sum("n").alias("own"), F.sum(F.col("n") * F.col("n") / F.col("pooled")).alias("fit"))
    chi = F.col("fit") * F.col("total") / F.col("own") - F.col("own")
    part = 2 / (9 * F.col("df"))
    most = F.when(F.col("df") > 0, F.col("df") * F.pow(1 - part + ALIKE * F.sqrt(part), F.lit(3))).otherwise(1e-6)
    like = child.join(total, node).where(chi <= most).select(*node, "segment")
    several = like.groupBy(*node).agg(F.count("*").alias("n")).where("n > 1").select(*node)
    return like.join(several, node).withColumn("alike", F.lit(True))


def templates(paths: DataFrame) -> DataFrame:
    """(host, path, template, branch) for distinct (host, path); in ``branch`` alike
    siblings are merged."""
    split = F.split(F.regexp_replace("path", "^/", ""), "/")
    cut = F.when(F.size(split) > DEEPEST, F.concat(F.slice(split, 1, DEEPEST - 1), F.array(F.lit("<tail>")))).otherwise(split)
    state = common.stored(paths.select("host", "path", F.transform(cut, _typed).alias("segments"),
                                       F.lit("").alias("template"), F.lit("").alias("branch")), "url-paths")
    depth = state.agg(F.max(F.size("segments"))).first()[0] or 0
    for d in range(depth):
        segment = F.get("segments", F.lit(d))
        literal = F.coalesce(~F.startswith(segment, F.lit("<")), F.lit(False))
        below = F.slice("segments", d + 2, DEEPEST)
        shape = F.array_join(F.transform(below, lambda s: F.when(F.startswith(s, F.lit("<")), s).otherwise(
            F.concat(F.lit("w"), F.regexp_extract(s, r"\.[A-Za-z]{1,5}$", 0)))), "/")
        literals = state.where(literal).select("host", "template", "branch", segment.alias("segment"), F.xxhash64(below).alias("rest"), shape.alias("shape"))
        variable = _variable(literals)
        alike = _alike(literals.join(variable, ["host", "template"], "left_anti"))
        own = F.concat(F.lit("/"), segment)
        step = F.when(segment.isNull(), "").when(literal & F.col("variable").isNotNull(), "/*")
        state = common.stored(
            state.withColumn("segment", segment).join(variable, ["host", "template"], "left").join(alike, ["host", "branch", "segment"], "left")
            .select("host", "path", "segments", F.concat("template", step.otherwise(own)).alias("template"),
                    F.concat("branch", step.when(literal & F.col("alike").isNotNull(), "/{}").otherwise(own)).alias("branch")), "url-paths")
    return state.select("host", "path", "template", "branch")


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
          rules: list[tuple[str, str, str]] | None = None, reject: float = REJECT) -> DataFrame:
    """page_id, host, path, rule, verdict, the template, the branch that it is part of
    and this branch's purity (null without labels)."""
    rules = RULES if rules is None else rules
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    host, path = parsed(F.col(url_col))
    rows = (pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumn("rule", _first_rule(rules, lambda r: r[0] + r[1]))
            .withColumn("by_rule", _first_rule(rules, lambda r: r[2])))
    paths = common.stored(rows.groupBy("host", "path").agg(
        F.count("by_rule").alias("labelled"),
        F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked")), "url-counts")
    tree = common.stored(templates(paths), "url-templates")
    totals = paths.agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")).first()
    prior = totals.blocked / totals.labelled if totals.labelled else 0.0
    counted = (paths.join(tree, ["host", "path"]).groupBy("host", "branch")
               .agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    purity = (F.col("blocked") + F.lit(PRIOR_WEIGHT * prior)) / (F.col("labelled") + F.lit(PRIOR_WEIGHT))
    rated = counted.where("labelled > 0").select("host", "branch", purity.alias("purity"))
    verdicts = tree.join(rated, ["host", "branch"], "left")
    learned = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    return (rows.join(verdicts, ["host", "path"])
            .select("page_id", "host", "path", "rule", F.coalesce("by_rule", learned).alias("verdict"), "template", "branch", "purity"))
