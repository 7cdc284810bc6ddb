"""URL verdicts: given rules first, then path templates judged by the purity of labelled pages.

Each host has a tree of path segments. Segments that vary become wildcards: those that look like
numbers or codes at once, and all children of a node that has too many for its paths. The paths
that are left are templates. Labelled templates of one node whose shares of blocked pages do not
differ beyond chance are merged, level by level towards the root, and a page takes the verdict of
the group that its template ends in: blocked if the smoothed share of allowed pages is too low.
Templates without a label join nobody; they are judged by the share of allowed pages of an average
host, in which every host counts once, however large it is.

Labels come from the rules: a page that a rule decides is a labelled page of its template. All of
it is grouped aggregates over (host, template) with counts taken before each shuffle; pages meet
only the small result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import bind, keep

DEEPEST = 24  # segments of a template; of a path with more, the rest is one wildcard
MANY = 20  # children from which a node may be generalised
SPREAD = 0.5  # children per distinct path from which it is
ALIKE = 1.96  # standard errors by which shares may differ and still be merged
PRIOR = 4.0  # pages for which the average host's share of allowed pages counts in every group
UNKNOWN = 0.25  # and for each page of a group that no label tells about
PURITY = 0.4  # least smoothed share of allowed pages

# Segments that stand for something that varies.
VARIES = r"^([0-9]+|[0-9a-f]{8,}|[0-9a-f]{8}-[0-9a-f-]{27}|.*[0-9]{3,}.*|.{40,})$"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; empty without it."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """The segments with numbers and codes as ``*``; a suffix such as ``.html`` stays."""

    def general(s: Column) -> Column:
        suffix = F.regexp_extract(s, r"(\.[A-Za-z]{2,5})$", 1)
        stem = F.regexp_replace(s, r"\.[A-Za-z]{2,5}$", "")
        return F.when(stem.rlike(VARIES), F.concat(F.lit("*"), suffix)).otherwise(s)

    parts = F.array_remove(F.split(path, "/"), "")
    cut = bind(parts, lambda p: F.when(F.size(p) > DEEPEST, F.concat(F.slice(p, 1, DEEPEST), F.array(F.lit("**")))).otherwise(p))
    return F.transform(cut, general)


def name_of(parts: Column) -> Column:
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def depth_of(rows: DataFrame, column: str) -> int:
    """Segments of the longest path, ``DEEPEST`` and one wildcard at most."""
    return rows.agg(F.coalesce(F.max(F.size(column)), F.lit(0))).first()[0]


def templates(counted: DataFrame) -> DataFrame:
    """``counted`` (stored; a row per ``host`` and ``parts``) with ``template``: crowded nodes generalised, level by level.

    A node is crowded if it has at least ``MANY`` children and at least ``SPREAD`` children for each
    distinct path below it, however often these were crawled; all its children then become one
    wildcard, and their subtrees one.
    """
    rows = counted.withColumn("template", F.col("parts"))
    for level in range(1, min(depth_of(counted, "parts"), DEEPEST) + 1):
        at = [F.col("host"), F.slice("template", 1, level - 1).alias("above")]
        child = rows.filter(F.size("template") >= level).groupBy(*at, F.get("template", F.lit(level - 1)).alias("child")).agg(F.count("*").alias("paths"))
        crowded = child.groupBy("host", "above").agg(F.count("*").alias("children"), F.sum("paths").alias("paths"))
        crowded = crowded.filter((F.col("children") >= MANY) & (F.col("children") >= SPREAD * F.col("paths"))).select("host", "above", F.lit(True).alias("crowded"))
        wild = F.concat(F.slice("template", 1, level - 1), F.array(F.lit("*")), F.slice("template", level + 1, DEEPEST + 1))
        rows = rows.withColumn("above", F.slice("template", 1, level - 1)).join(crowded, ["host", "above"], "left")
        rows = rows.withColumn("template", F.when(F.col("crowded") & (F.size("template") >= level), wild).otherwise(F.col("template"))).drop("above", "crowded")
        rows = keep(rows, "level") if level % 4 == 0 else rows  # a plan of a few levels at most
    return rows


def smoothed(good: Column, known: Column, pages: Column, general: float) -> Column:
    """Share of allowed pages; pages without a label vote weakly for the average host's share."""
    neutral = PRIOR + UNKNOWN * (pages - known)
    return (good + neutral * general) / (known + neutral)


def average_share(stats: DataFrame) -> float:
    """Smoothed share of allowed pages of an average host with labels, in millionths; 1 without any labels."""
    hosts = stats.groupBy("host").agg(F.sum("good").alias("good"), F.sum("known").alias("known")).filter("known > 0")
    share = F.expr("(good + 1) * 1000000 div (known + 2)")
    total, n = hosts.agg(F.sum(share), F.count("*")).first()
    return total / (1_000_000 * n) if n else 1.0


def judged(stats: DataFrame) -> DataFrame:
    """Verdict for each ``host``, ``template`` of ``stats`` (stored; with ``good`` and ``known`` pages).

    From the deepest level up, a node's labelled children are compared with all of them together;
    those whose share of good pages lies within ``ALIKE`` standard errors of it give up their own
    group and join the node's. A branch without labels has nothing to compare and stays alone.
    """
    rows = stats.withColumns({"group": F.col("template"), "open": F.lit(True)})
    for level in range(depth_of(stats, "template"), 0, -1):
        at = F.slice("group", 1, level - 1)
        deep = F.col("open") & (F.size("group") == level)
        groups = rows.filter(deep).groupBy("host", "group").agg(F.sum("good").alias("good"), F.sum("known").alias("known")).filter("known > 0")
        nodes = groups.groupBy("host", at.alias("node")).agg(F.sum("good").alias("node_good"), F.sum("known").alias("node_known"))
        both = groups.withColumn("node", at).join(nodes, ["host", "node"])
        q = (F.col("node_good") + 1) / (F.col("node_known") + 2)
        far = F.abs(F.col("good") - F.col("known") * q) > ALIKE * F.sqrt(F.col("known") * q * (1 - q))
        moved = both.select("host", "group", (~far).alias("alike"))
        rows = rows.join(moved, ["host", "group"], "left").withColumn("alike", F.coalesce("alike", F.lit(False)))
        rows = rows.withColumns({"open": F.when(deep, F.col("alike")).otherwise(F.col("open")), "group": F.when(deep & F.col("alike"), at).otherwise(F.col("group"))}).drop("alike")
        rows = keep(rows, "level") if level % 4 == 0 else rows
    rows = keep(rows, "groups")
    # A merged group has moved up to its node; a template of that name without labels is another group.
    groups = rows.groupBy("host", "group", "open").agg(*[F.sum(c).alias(c) for c in ("good", "known", "pages")])
    general = average_share(stats)
    verdicts = groups.withColumn("purity", smoothed(F.col("good"), F.col("known"), F.col("pages"), general))
    return rows.join(verdicts.select("host", "group", "open", "purity"), ["host", "group", "open"]).select("host", "parts", name_of(F.col("group")).alias("template"), "purity")


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", purity: float = PURITY) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity`` per row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, which form a template like any
    other. Without any rule that fits, nothing is labelled and all is allowed. Null and repeated
    ids and rows give a row each; an empty table gives none; other columns are not looked at.
    """
    found = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = found.withColumns({"ruled": rule_for(F.col("host"), F.col("path"), rules), "parts": segments(F.col("path"))})
    known = F.col("ruled").isNotNull()
    counted = rows.groupBy("host", "parts").agg(
        F.count("*").alias("pages"), F.sum(known.cast("long")).alias("known"), F.sum((known & (F.col("ruled.verdict") == "allow")).cast("long")).alias("good"))
    made = keep(judged(keep(templates(keep(counted, "counted")), "templates")), "verdicts")
    own = F.when(F.col("purity") < purity, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(made, ["host", "parts"]).select("page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", own).alias("verdict"), "template", "purity")
