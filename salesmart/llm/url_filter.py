"""URL filters: rules by host and path, and a tree of path templates for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import Workspace


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


class TemplateSettings(NamedTuple):
    """What the template tree goes by.

    min_children: a node's children become a wildcard when it has that many distinct
        ones, however many URLs they have, but for those whose labels tell them apart.
    evidence: distinct labelled paths below a child without which it is like the others.
    deviations: branches within so many standard deviations of their parent's
        purity are merged into one.
    prior: labels' worth of the parent's purity that each branch starts with.
    block_at: smoothed share of blocked labels from which a template is rejected.
    """

    min_children: int = 20
    evidence: int = 3
    deviations: float = 2.0
    prior: float = 5.0
    block_at: float = 0.5


def url_host(url: str = "url") -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.col(url), r"^(?s:.*?)://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def url_path(url: str = "url") -> Column:
    """From the end of the host up to ``? #`` or the end; empty without a ``://``."""
    return F.coalesce(F.regexp_extract(F.col(url), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(rules: Sequence[Rule]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct, or null.

    A rule fits its host, every subdomain, and paths that start with its path. The
    rules are part of the plan: meant for short lists written by hand.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = (
            (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        ) & F.col("path").startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


def path_templates(work: Workspace, urls: DataFrame, settings: TemplateSettings) -> DataFrame:
    """``urls`` (``host``, ``segments``, ...) with ``template``, their segments with the
    variable ones as ``*``, level by level down the tree of each host, to the last
    segment of the longest path.

    The children of a node are counted after its own segments are generalised, so
    ``/en/1`` and ``/en/2`` meet in ``/en/*`` and go on as one branch. A child with
    ``evidence`` whose share of blocked paths differs from that of its siblings, by a
    test of two proportions, keeps its name (``told_apart``).
    """
    tree = work.stored(urls.withColumn("template", F.array().cast("array<string>")), "level0")
    schema = tree.schema
    deepest = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(deepest):
        segment = F.get("segments", F.lit(level))
        further = tree.filter(F.size("segments") > level)
        children = further.select("host", "template", segment.alias("segment")).distinct()
        variable = work.stored(
            children.groupBy("host", "template")
            .agg(F.count("*").alias("distinct"))
            .filter(F.col("distinct") >= settings.min_children)
            .select("host", "template", F.lit(True).alias("variable")),
            f"variable{level}",
        )
        own = work.stored(told_apart(further.withColumn("segment", segment), variable, settings), f"own{level}")
        general = F.col("variable") & F.col("named").isNull()
        tree = work.stored(
            further.withColumn("segment", segment)
            .join(variable, ["host", "template"], "left")
            .join(own, ["host", "template", "segment"], "left")
            .withColumn("template", F.concat("template", F.array(F.when(general, F.lit("*")).otherwise(F.col("segment")))))
            .select(*schema.names),
            f"level{level + 1}",
        )
    # A row is whole in the table of its last segment.
    levels = [f"{work.root}/level{level}" for level in range(deepest + 1)]
    return work.spark.read.schema(schema).parquet(*levels).filter(F.size("template") == F.size("segments"))


def told_apart(urls: DataFrame, variable: DataFrame, settings: TemplateSettings) -> DataFrame:
    """``host, template, segment, named``: the children of variable nodes that are not like the others.

    Of a child and of its siblings the shares of blocked ones among the distinct
    labelled paths are compared: they differ when they are more than ``deviations``
    standard errors of the pooled share apart.
    """
    node = ["host", "template"]
    paths = urls.filter("label is not null").join(variable, node, "left_semi")
    children = paths.select(*node, "segment", "path", "label").distinct().groupBy(*node, "segment")
    children = children.agg(F.count("*").alias("n"), F.sum("label").alias("x"))
    whole = children.groupBy(*node).agg(F.sum("n").alias("all_n"), F.sum("x").alias("all_x"))
    others_n, others_x = F.col("all_n") - F.col("n"), F.col("all_x") - F.col("x")
    pooled = F.col("all_x") / F.col("all_n")
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n") + 1 / F.nullif(others_n, F.lit(0))))
    apart = F.abs(F.col("x") / F.col("n") - others_x / F.nullif(others_n, F.lit(0))) > settings.deviations * error
    found = children.join(whole, node).filter((F.col("n") >= settings.evidence) & (others_n > 0) & apart)
    return found.select(*node, "segment", F.lit(True).alias("named"))


def template_verdicts(work: Workspace, tree: DataFrame, settings: TemplateSettings) -> DataFrame:
    """``host, template, purity`` for every template, from the labels of its URLs.

    Top down, a node's purity is its share of blocked labels, smoothed towards its
    parent's. Siblings whose share is within ``deviations`` of the parent's count
    as one branch and share their labels; the others stand for themselves.
    """
    counted = ["labels", "blocked"]
    leaves = work.stored(
        tree.groupBy("host", "template").agg(F.count("label").alias("labels"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked")),
        "leaves",
    )
    total = leaves.agg(
        F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked"), F.max(F.size("template")).alias("deepest")
    ).first()
    deepest = total["deepest"] or 0
    # Nothing is rejected where nothing is labelled.
    overall = (total["blocked"] + 1) / (total["labels"] + 2) if total["labels"] else 0.0

    def smoothed(blocked: Column, labels: Column, parent: Column) -> Column:
        return (blocked + settings.prior * parent) / (labels + settings.prior)

    hosts = leaves.groupBy("host").agg(*[F.sum(c).alias(c) for c in counted])
    level = hosts.select(
        "host",
        F.array().cast("array<string>").alias("node"),
        smoothed(F.col("blocked"), F.col("labels"), F.lit(overall)).alias("purity"),
    )
    level = work.stored(level, "purity0")
    schema = level.schema
    for depth in range(1, deepest + 1):
        nodes = (
            leaves.filter(F.size("template") >= depth)
            .groupBy("host", F.slice("template", 1, depth).alias("node"))
            .agg(*[F.sum(c).alias(c) for c in counted])
            .withColumn("parent", F.slice("node", 1, depth - 1))
            .join(level.select("host", F.col("node").alias("parent"), F.col("purity").alias("above")), ["host", "parent"])
        )
        share = F.col("blocked") / F.greatest(F.col("labels"), F.lit(1))
        error = F.sqrt(F.col("above") * (1 - F.col("above")) / F.greatest(F.col("labels"), F.lit(1)))
        nodes = work.stored(
            nodes.withColumn(
                "alike", (F.col("labels") == 0) | (F.abs(share - F.col("above")) <= settings.deviations * error)
            ),
            f"nodes{depth}",
        )
        merged = nodes.filter("alike").groupBy("host", "parent").agg(*[F.sum(c).alias(f"{c}_alike") for c in counted])
        level = work.stored(
            nodes.join(merged, ["host", "parent"], "left").select(
                "host",
                "node",
                smoothed(
                    F.when(F.col("alike"), F.col("blocked_alike")).otherwise(F.col("blocked")),
                    F.when(F.col("alike"), F.col("labels_alike")).otherwise(F.col("labels")),
                    F.col("above"),
                ).alias("purity"),
            ),
            f"purity{depth}",
        )
    levels = [f"{work.root}/purity{depth}" for depth in range(deepest + 1)]
    return work.spark.read.schema(schema).parquet(*levels).withColumnRenamed("node", "template")


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule], settings: TemplateSettings = TemplateSettings()
) -> DataFrame:
    """One row per row of ``pages`` (``page_id``, ``url``) with its host, path, rule and verdict.

    URLs that a rule fits get its verdict, and are the labels from which the
    templates learn. Any other URL gets the verdict of its template, or of the
    longest part of it that is in the tree (every path template is).

    A null URL and one without ``://`` have an empty host and path and are judged
    like any host; with no labels at all everything is allowed. Repeated rows give
    repeated rows. Other columns are ignored.
    """
    work = Workspace(pages.sparkSession, "url-filter")
    urls = pages.select("page_id", url_host().alias("host"), url_path().alias("path"))
    urls = urls.withColumn("fit", fitting_rule(rules)).select(
        "page_id",
        "host",
        "path",
        "fit.rule",
        F.col("fit.verdict").alias("ruled"),
        F.when(F.col("fit.verdict") == "block", 1).when(F.col("fit.verdict") == "allow", 0).alias("label"),
        F.filter(F.split("path", "/"), lambda s: s != "").alias("segments"),
    )
    tree = work.stored(path_templates(work, urls, settings), "tree")
    purity = work.stored(template_verdicts(work, tree, settings), "purity")
    blocked = F.coalesce(F.col("purity") >= settings.block_at, F.lit(False))
    return tree.join(purity, ["host", "template"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "purity",
    )
