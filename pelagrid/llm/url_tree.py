"""URL filter: a tree of path templates for each host, judged by its labelled purity.

Labels of urls come from host and path rules (or from any labelled column). The tree is grown
level by level over the different paths of each host:

* **Generalise.** Below one node a segment stays literal if at least ``SUPPORT`` different paths
  go through it and, where the node has more than ``FEW`` different segments, if that number is
  more than three standard deviations above an even spread over them. Every other segment
  becomes a typed wildcard: ``{n}`` (digits), ``{h}`` (hexadecimal), ``{*}``; an extension stays.
* **Merge.** Literal branches of one node are alike if what follows them has mostly the same
  shape and their labelled shares lie on the same side of the node's: not significantly off, or
  significantly above, or below (two standard errors). Branches that are alike become one;
  branches without a label are only merged with others without one.
* **Reject.** A template is rejected if ``(blocked + 1) / (labelled + 2)`` over its different
  paths reaches ``PURITY``. Without labelled paths this is a half, so nothing is rejected
  without evidence.

A rule's verdict goes before the template's. Paths have ``LEVELS`` segments at most; what
follows is compared as one last segment, so no path is cut.

Defined results: a null url or one without ``://`` has an empty host and path, no rule and the
template ``""``. Repeated rows each get their row; equal paths of a host count once in the tree.
Page ids may be null or repeated. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import BROADCAST_ROWS, written

# The rules of the contract, host and path, and their verdicts.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
LEVELS = 8
SUPPORT = 3
FEW = 20
PURITY = 0.8
SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest_rule(rules: tuple[tuple[str, str], ...], host: Column, path: Column, what: int) -> Column:
    """The longest fitting rule (1) or its verdict (0)."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule[1].partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        chosen = F.when(fits, F.lit(rule[what])).otherwise(chosen)
    return chosen


def typed(segment: Column) -> Column:
    """The wildcard of a segment that does not stay literal."""
    stem, extension = F.regexp_extract(segment, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?$", 1), F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    kind = (
        F.when(segment == "", "")
        .when(stem.rlike(r"^[0-9]+$"), "{n}")
        .when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), "{h}")
        .otherwise("{*}")
    )
    return F.concat(kind, extension)


def _segments(path: Column) -> Column:
    """Up to ``LEVELS`` pieces after the first slash; the last holds all that follows."""
    return F.when(path.startswith("/"), F.split(F.substr(path, F.lit(2)), "/", LEVELS)).otherwise(
        F.when(path == "", F.array().cast("array<string>")).otherwise(F.array(path))
    )


def _met(rows: DataFrame, keys: DataFrame, on: list[str], counted: int) -> DataFrame:
    """Left join with unique ``keys``: broadcast while few, else every key once for each salt."""
    if counted <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keys), on, "left")
    spread = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return dealt.join(spread, [*on, "_salt"], "left").drop("_salt")


def _step(rows: DataFrame, branches: DataFrame, level: int, counted: int) -> DataFrame:
    """Lengthen the template of every row that has a segment at this level."""
    own = F.get("segments", F.lit(level))
    known = _met(rows.withColumn("segment", own), branches, ["host", "template", "segment"], counted)
    longer = F.concat("template", F.lit("/"), F.coalesce("branch", typed(F.col("segment"))))
    return known.withColumn("template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(longer)).drop(
        "segment", "branch"
    )


def _branches(paths: DataFrame, level: int) -> DataFrame:
    """Literal segments of this level with the name of the merged branch each is part of."""
    at = paths.select(
        "host",
        "template",
        F.get("segments", F.lit(level)).alias("segment"),
        F.coalesce(typed(F.get("segments", F.lit(level + 1))), F.lit("/")).alias("following"),
        "labelled",
        "blocked",
    ).where("segment IS NOT NULL AND segment <> ''")
    node, segment = ["host", "template"], ["host", "template", "segment"]
    shapes = at.groupBy(*segment, "following").agg(
        F.count("*").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
    )
    siblings = shapes.groupBy(*segment).agg(
        F.sum("n").alias("n"),
        F.sum("labelled").alias("labelled"),
        F.sum("blocked").alias("blocked"),
        F.max_by("following", F.struct("n", "following")).alias("following"),
    )
    spread = siblings.groupBy(*node).agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
    even = F.col("all") / F.col("kinds")
    stays = (F.col("n") >= SUPPORT) & ((F.col("kinds") <= FEW) | (F.col("n") > even + 3 * F.sqrt(even)))
    literal = written(siblings.join(spread, node).where(stays).drop("all", "kinds"), "literal-segments")
    pooled = literal.groupBy(*node).agg(F.sum("blocked").alias("bad"), F.sum("labelled").alias("seen"))
    share = F.col("bad") / F.col("seen")
    error = F.sqrt(share * (1 - share) / F.col("labelled"))
    off = F.col("blocked") / F.col("labelled") - share
    side = (
        F.when(F.col("labelled") == 0, "unlabelled")
        .when(off > 2 * error, "above")
        .when(off < -2 * error, "below")
        .otherwise("alike")
    )
    sided = literal.join(pooled, node).select(*segment, "following", side.alias("side"))
    merged = sided.groupBy(*node, "following", "side").agg(F.min("segment").alias("least"), F.count("*").alias("members"))
    name = F.when(F.col("members") == 1, F.col("least")).otherwise(
        F.concat(F.lit("["), "least", F.lit("+"), F.col("members") - 1, F.lit("]"))
    )
    named = merged.select(*node, "following", "side", name.alias("branch"))
    return written(sided.join(named, [*node, "following", "side"]).select(*segment, "branch"), "branches")


def _labelled(urls: DataFrame) -> DataFrame:
    """Different paths of each host; a path that most of its labelled rows block is a blocked one."""
    sums = urls.groupBy("host", "path").agg(
        F.count("bad").alias("seen"), F.coalesce(F.sum("bad"), F.lit(0)).alias("hits")
    )
    return sums.select(
        "host",
        "path",
        F.lit("").alias("template"),
        _segments(F.col("path")).alias("segments"),
        (F.col("seen") > 0).cast("int").alias("labelled"),
        ((F.col("seen") > 0) & (2 * F.col("hits") >= F.col("seen"))).cast("int").alias("blocked"),
    )


def templates(urls: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, int]]]:
    """From rows of ``host``, ``path`` and ``bad`` (1, 0 or null: not labelled), the templates with
    their purity, and the branches of each level, by which any row finds its template."""
    paths = written(_labelled(urls), "paths")
    deepest = paths.agg(F.max(F.size("segments"))).first()[0] or 0
    levels = []
    for level in range(deepest):  # LEVELS at most
        branches = _branches(paths, level)
        counted = branches.count()
        levels.append((branches, counted))
        paths = written(_step(paths, branches, level, counted), "paths")
    judged = paths.groupBy("host", "template").agg(
        F.count("*").alias("n_paths"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
    )
    purity = (F.col("blocked") + 1) / (F.col("labelled") + 2)
    return written(judged.withColumn("purity", purity), "templates"), levels


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labelled: Column | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``template``, ``purity``, ``rule`` and ``verdict`` of every page.

    ``labelled`` is 1 (bad), 0 (good) or null for each row of ``pages``; by default it is the rules' verdict.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    own = {"page_id": F.col("page_id"), "host": host, "path": path}
    read = pages.select(
        *[c.alias(k) for k, c in own.items()], (F.lit(None).cast("int") if labelled is None else labelled).alias("bad")
    )
    rule = _longest_rule(rules, F.col("host"), F.col("path"), 1)
    said = _longest_rule(rules, F.col("host"), F.col("path"), 0)
    rows = read.withColumns({"rule": rule, "said": said})
    if labelled is None:
        rows = rows.withColumn("bad", (F.col("said") == "block").cast("int"))
    judged, levels = templates(rows.select("host", "path", "bad"))
    placed = rows.withColumns({"template": F.lit(""), "segments": _segments(F.col("path"))})
    placed = reduce(lambda r, k: _step(r, *levels[k][:1], k, levels[k][1]), range(len(levels)), placed)
    found = _met(placed, judged.select("host", "template", "purity"), ["host", "template"], judged.count())
    verdict = F.coalesce("said", F.when(F.col("purity") >= PURITY, "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "template", "purity", "rule", verdict.alias("verdict"))
