"""URL filters from a path-template tree per host.

A path's segments descend a tree of its host. At each node a segment with enough rows is
judged by its labels, however small its share of the node: segments of one form that
behave alike — the share of bad labels, and the forms that follow — are merged into one
branch by grouping on bins of these, and a segment that differs from the others of its
bin stays a literal. Segments of few rows become a wildcard of their form (digits,
digits with an extension, words, ...). What comes
out is a table of templates with label counts, pre-aggregated level by level; a template
is rejected if its labelled purity, smoothed by its host's and the corpus's, falls below
a bound. Given rules come first: of those that fit, the longest decides.

A node may have any number of segments: all steps are aggregates and joins, and nothing
is ever gathered per host or node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexrarity.llm.common import stored

#: Levels of the tree; what lies deeper is one wildcard.
DEPTH = 4
#: Rows from which on a segment is judged by itself.
LITERAL_ROWS = 5
#: Bins of the bad share (no bin reaches over one half) and of the share of the form that
#: follows most often. Shares of a segment are drawn towards its node's by so many rows.
SHARES = (0.1, 0.25, 0.5, 0.75, 0.9)
FORMS_APART = 0.25
DRAWN = 2.0
#: A segment differs from the others of its bin if the shares do by more than this many
#: standard errors.
ERRORS = 2.0
#: Segments that a branch is named after, at most; beyond, it is named after its bin.
NAMES = 50
#: Weight of the prior, in labelled rows, and the purity below which a template goes.
PRIOR = 8.0
PURITY = 0.5
#: Nodes broadcast at most (some 100 bytes each); beyond, rows join by shuffle.
BROADCAST_NODES = 200_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z in lower case; the
    path up to ``? #``. Both empty if there is no ``://``."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (struct name, verdict) that fits, or NULL."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<name:string,verdict:string>") if found is None else found


def form(segment: Column) -> Column:
    """Wildcard of a segment."""
    return (
        F.when(segment == "", "")
        .when(segment.rlike(r"^[0-9]+$"), "{n}")
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("{n}"), F.regexp_extract(segment, r"\.[^.]+$", 0)))
        .when(segment.rlike(r"^[0-9a-fA-F-]{16,}$"), "{x}")
        .when(segment.rlike(r"\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("{w}"), F.regexp_extract(segment, r"\.[^.]+$", 0)))
        .otherwise("{w}")
    )


def templates(urls: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(``urls`` with ``template``, the node table of each level), from ``host``,
    ``path``, ``good`` and ``bad`` (0 or 1 each; labelled rows)."""
    parts = F.split(F.expr("substring(path, 2)"), "/")
    rows = urls.withColumn("_parts", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(parts))
    rows = rows.withColumn("_node", F.lit(""))
    levels = []
    for level in range(1, DEPTH + 1):
        deeper = F.size("_parts") >= level
        segment = F.get(F.col("_parts"), F.lit(level - 1))
        follows = F.coalesce(form(F.get(F.col("_parts"), F.lit(level))), F.lit("end"))
        seen = rows.where(deeper).select("host", "_node", segment.alias("_segment"), follows.alias("_next"), "good", "bad")
        # Two steps: by segment and what follows, then by segment.
        fine = seen.groupBy("host", "_node", "_segment", "_next").agg(
            F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        segments = fine.groupBy("host", "_node", "_segment").agg(
            F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"),
            F.max(F.struct("n", "_next")).alias("_top"))
        nodes = stored(_merged(stored(segments)))
        levels.append(nodes)
        known = nodes.select("host", "_node", "_segment", "_branch")
        if nodes.count() <= BROADCAST_NODES:
            known = F.broadcast(known)
        rows = (
            rows.withColumn("_segment", segment)
            .join(known, ["host", "_node", "_segment"], "left")
            .withColumn("_node", F.when(
                deeper, F.concat("_node", F.lit("/"), F.coalesce("_branch", form(F.col("_segment")))))
                .otherwise(F.col("_node")))
            .drop("_segment", "_branch"))
    rest = F.when(F.size("_parts") > DEPTH, "/{rest}").otherwise("")
    return rows.withColumn("template", F.concat("_node", rest)).drop("_node", "_parts"), levels


def _merged(segments: DataFrame) -> DataFrame:
    """The segments with enough rows and the name of their branch."""
    at = ["host", "_node"]
    group = [*at, "_form", "_next", "_follow", "_bin"]
    labelled = F.col("good") + F.col("bad")
    sums = segments.groupBy(*at).agg(
        ((F.sum("bad") + 1) / (F.sum("good") + F.sum("bad") + 2)).alias("_mean"))
    share = (F.col("bad") + DRAWN * F.col("_mean")) / (labelled + DRAWN)
    share_bin = sum((share >= edge).cast("int") for edge in SHARES)
    binned = stored(
        segments.where(F.col("n") >= LITERAL_ROWS).join(sums, at)
        .select(*at, "_segment", "n", "good", "bad", form(F.col("_segment")).alias("_form"),
                F.col("_top._next").alias("_next"),
                F.ceil(F.col("_top.n") / F.col("n") / FORMS_APART).cast("int").alias("_follow"),
                share_bin.alias("_bin")))
    groups = binned.groupBy(*group).agg(F.sum("good").alias("_good"), F.sum("bad").alias("_bad"))
    # The others of the bin, drawn towards one half by one row of either label.
    rest_bad, rest = F.col("_bad") - F.col("bad"), F.col("_good") + F.col("_bad") - labelled
    rest_share = (rest_bad + 1) / (rest + 2)
    own = F.greatest(labelled, F.lit(1))
    error = F.sqrt(rest_share * (1 - rest_share) * (1 / own + 1 / (rest + 2)))
    differs = (labelled > 0) & (rest > 0) & (
        F.abs(F.col("bad") / own - rest_share) > ERRORS * error)
    judged_alone = stored(binned.join(groups, group).select(
        *group, "_segment", "n", "good", "bad", F.coalesce(differs, F.lit(False)).alias("_alone")))
    together = judged_alone.where("NOT _alone")
    counted = stored(together.groupBy(*group).agg(F.count(F.lit(1)).alias("_many")))
    few = counted.where(F.col("_many") <= NAMES).select(*group)
    names = together.join(few, group).groupBy(*group).agg(
        F.concat_ws("|", F.array_sort(F.collect_list("_segment"))).alias("_names"))
    named = counted.join(names, group, "left").select(
        *group, F.when(F.col("_many") == 1, F.col("_names"))
        .when(F.col("_many") <= NAMES, F.concat(F.lit("("), "_names", F.lit(")")))
        .otherwise(F.concat("_form", F.lit("{bad "), F.col("_bin").cast("string"), F.lit(", "), "_next",
                            F.lit(" "), F.col("_follow").cast("string"), F.lit("}"))).alias("_named"))
    return judged_alone.join(named, group, "left").select(
        *at, "_segment", F.when(F.col("_alone"), F.col("_segment")).otherwise(F.col("_named")).alias("_branch"),
        "n", "good", "bad")


def judged(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None,
           id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(id, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``) of every row.

    Labelled rows are those a rule decides, and those whose id is in ``labels``
    (``id_column``, ``bad`` 0 or 1; one row per id). A NULL url, or one without ``://``,
    has an empty host and path, and is judged like any other. Rows with equal ids are
    judged one by one; an empty table gives an empty one. Other columns are not returned.
    """
    host, path = split_url(F.col(url_column))
    rows = pages.select(F.col(id_column).alias("_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    mark = F.when(F.col("_rule.verdict") == "block", 1).when(F.col("_rule.verdict") == "allow", 0)
    if labels is not None:
        given = labels.select(F.col(id_column).alias("_id"), F.col("bad").cast("int").alias("_given")).where(
            "_id IS NOT NULL").groupBy("_id").agg(F.max("_given").alias("_given"))
        rows = rows.join(given, "_id", "left")
        mark = F.coalesce(mark, F.col("_given"))
    rows = rows.withColumn("_mark", mark)
    rows = stored(rows.select(
        "_id", "host", "path", "_rule", F.coalesce((F.col("_mark") == 1).cast("long"), F.lit(0).cast("long")).alias("bad"),
        F.coalesce((F.col("_mark") == 0).cast("long"), F.lit(0).cast("long")).alias("good")))
    placed, _ = templates(rows)
    placed = stored(placed)
    leaves = placed.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    every = leaves.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    base = ((every["g"] or 0) + 1) / ((every["g"] or 0) + (every["b"] or 0) + 2)
    hosts = leaves.groupBy("host").agg(
        ((F.sum("good") + PRIOR * base) / (F.sum("good") + F.sum("bad") + PRIOR)).alias("_host"))
    purity = stored(
        leaves.join(hosts, "host").select(
            F.col("host").alias("_h"), F.col("template").alias("_t"),
            ((F.col("good") + PRIOR * F.col("_host")) / (F.col("good") + F.col("bad") + PRIOR)).alias("purity")))
    known = F.broadcast(purity) if purity.count() <= BROADCAST_NODES else purity
    out = placed.join(known, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")), "left")
    return out.select(
        F.col("_id").alias(id_column), "host", "path", F.col("_rule.name").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("purity") < PURITY, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")
