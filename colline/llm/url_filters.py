"""URL filters (operator 6): rules first, then path templates judged by their labelled purity.

Rules fit a host and its subdomains with a path prefix; the longest one that
fits decides.  The pages that rules decide are labelled ones of the tree, and so are
those of a table of labels, if it is given.

Tree.  Level by level, under every host and template so far, the next segment
becomes a wildcard (with its file ending, if any) if it has the form of an id,
or if the segments there are many and mostly different; otherwise it stays.  So
do the segments that the deciding rule names, as its labels tell about these
alone.  Branches under one node whose share of blocked labels does not differ significantly from the
share of all labelled branches there are merged into one class.  A class is
rejected if its smoothed purity, (blocked + a / 2) / (labelled + a), reaches a
threshold; so a class without labels is let pass.

Urls are first counted by host and path; hosts of any size are aggregated
before they move, and no host is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colline.llm.common import save, small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

MANY = 8  # a node is variable with at least so many different segments ...
DIFFERENT = 0.5  # ... and so many for each of its urls
Z = 1.96  # of the test that tells branches apart
ID_FORM = r"^(?:[0-9]+|[0-9a-fA-F-]{16,})(?:\.[A-Za-z0-9]{1,5})?$"
SMOOTHING = 4.0
PURITY = 0.8
DEPTH = 12  # levels of the tree; what is deeper counts as one more segment


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, null if none does (a fixed, short list)."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _node_key() -> list[Column]:
    return [F.xxhash64("host", "template").alias("_k1"), F.xxhash64(F.lit("node"), "host", "template").alias("_k2")]


def path_templates(urls: DataFrame) -> DataFrame:
    """``urls`` (``host, path, n, fixed`` and more, one row per host and path) with ``parent`` and ``template``.
    The first ``fixed`` segments stay as they are.

    One aggregate and one join a level; the deepest path gives the levels, at most :data:`DEPTH`.
    Paths are joined only with the nodes that are variable, by 128 bits of a hash; while these
    are few enough to be broadcast, no path moves and no host meets in one task.
    """
    now = urls.withColumn("_segments", F.split(F.regexp_replace("path", "^/", ""), "/", DEPTH + 1))
    now = now.withColumn("template", F.lit("")).withColumn("parent", F.lit(""))
    now = save(now, "url-paths")
    depth = now.agg(F.max(F.size("_segments"))).first()[0] or 0
    for level in range(depth):
        here = now.where(F.size("_segments") > level)
        children = here.groupBy("host", "template", F.get("_segments", F.lit(level)).alias("segment")).agg(F.sum("n").alias("n"))
        nodes = children.groupBy("host", "template").agg(F.count(F.lit(1)).alias("segments"), F.sum("n").alias("n"))
        wild = nodes.where((F.col("segments") >= MANY) & (F.col("segments") >= F.col("n") * DIFFERENT))
        wild = save(wild.select(*_node_key(), F.lit(True).alias("variable")), "url-nodes")
        segment = F.get("_segments", F.lit(level))
        loose = (F.col("fixed") <= level) & (F.coalesce("variable", F.lit(False)) | segment.rlike(ID_FORM))
        general = F.when(loose, F.concat(F.lit("*"), F.regexp_extract(segment, r"\.[A-Za-z0-9]{1,5}$", 0))).otherwise(segment)
        deeper = F.size("_segments") > level
        now = now.select("*", *_node_key()).join(small_side(wild), ["_k1", "_k2"], "left")
        now = save(
            now.withColumn("parent", F.when(deeper, F.col("template")).otherwise(F.col("parent")))
            .withColumn("template", F.when(deeper, F.concat("template", F.lit("/"), general)).otherwise(F.col("template")))
            .drop("_k1", "_k2", "variable"),
            "url-level",
        )
    return now.drop("_segments")


def judged_templates(templates: DataFrame) -> DataFrame:
    """``host, template, class, labelled, blocked, purity, verdict`` from rows with
    ``host, parent, template, blocked, allowed``."""
    leaves = templates.groupBy("host", "parent", "template").agg(
        F.sum("blocked").alias("blocked"), F.sum(F.col("blocked") + F.col("allowed")).alias("labelled")
    )
    leaves = save(leaves, "url-leaves")
    pools = leaves.where("labelled > 0").groupBy("host", "parent").agg(
        F.sum("blocked").alias("pool_blocked"), F.sum("labelled").alias("pool_labelled")
    )
    pools = pools.withColumnRenamed("host", "_h").withColumnRenamed("parent", "_p")
    both = leaves.join(pools, (F.col("host") == F.col("_h")) & (F.col("parent") == F.col("_p")), "left").drop("_h", "_p")
    share = F.col("pool_blocked") / F.col("pool_labelled")
    far = F.abs(F.col("blocked") - F.col("labelled") * share) > F.lit(Z) * F.sqrt(F.col("labelled") * share * (F.lit(1.0) - share))
    alone = (F.col("labelled") == 0) | far
    named = both.withColumn("class", F.when(alone, F.col("template")).otherwise(F.concat("parent", F.lit("/{merged}"))))
    sums = named.groupBy("host", "class").agg(F.sum("blocked").alias("class_blocked"), F.sum("labelled").alias("class_labelled"))
    sums = sums.withColumnRenamed("host", "_h").withColumnRenamed("class", "_c")
    out = named.join(sums, (F.col("host") == F.col("_h")) & (F.col("class") == F.col("_c")))
    purity = (F.col("class_blocked") + F.lit(SMOOTHING / 2)) / (F.col("class_labelled") + F.lit(SMOOTHING))
    return out.withColumn("purity", purity).select(
        "host", "parent", "template", "class", "labelled", "blocked", "purity",
        F.when(F.col("purity") >= PURITY, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
    labels: DataFrame | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template``, one row per input row.

    ``labels``: ``blocked`` (boolean, nulls tell nothing) beside the url or, without such a
    column, the id of a page, under the names they have in ``pages``; they count in the
    tree beside the pages that rules decide, and urls need not be in ``pages``.

    ``rule`` is null where the template decided.  A null url, or one without
    ``://``, has an empty host and path and is judged by the empty template of
    the empty host, which no label reaches: allow.  Null ids stay null; repeated
    rows give repeated rows; other columns are not read; an empty table gives an
    empty result.  A rule with path ``/`` does not fit an empty path.
    """
    parsed = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    counts = parsed.select("host", "path", F.lit(1).alias("n"), F.lit(None).cast("boolean").alias("label"))
    if labels is not None:
        if url_col in labels.columns:
            known = labels.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col("blocked").alias("label"))
        else:
            by_id = labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col("blocked").alias("label"))
            known = parsed.dropDuplicates().join(by_id, F.col("page_id") == F.col("_id"))
        known = known.where(F.col("label").isNotNull())
        counts = counts.unionAll(known.select("host", "path", F.lit(0).alias("n"), F.col("label").cast("boolean").alias("label")))
    counts = counts.groupBy("host", "path").agg(
        F.greatest(F.sum("n"), F.count("label")).alias("n"), F.sum("n").alias("_pages"),
        F.count_if(F.col("label")).alias("_blocked"), F.count_if(~F.col("label")).alias("_allowed"),
    )
    counts = counts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    slashes = F.length("_rule.rule") - F.length(F.replace("_rule.rule", F.lit("/"), F.lit("")))
    counts = counts.withColumn("fixed", F.coalesce(slashes - 1, F.lit(0)))
    for name, verdict in (("blocked", "block"), ("allowed", "allow")):
        counts = counts.withColumn(name, F.col(f"_{name}") + F.when(F.col("_rule.verdict") == verdict, F.col("_pages")).otherwise(F.lit(0)))
    templates = path_templates(counts)
    judged = judged_templates(templates).select(
        F.col("host").alias("_h"), F.col("parent").alias("_p"), F.col("template").alias("_t"), F.col("verdict").alias("_verdict")
    )
    known = templates.join(
        judged, (F.col("host") == F.col("_h")) & (F.col("parent") == F.col("_p")) & (F.col("template") == F.col("_t"))
    ).select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("_rule.rule").alias("rule"), "template",
        F.coalesce("_rule.verdict", "_verdict").alias("verdict"),
    )
    out = parsed.join(known, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")))
    return out.select("page_id", "host", "path", "rule", "verdict", "template")
