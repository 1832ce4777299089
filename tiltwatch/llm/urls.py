"""URL rules, and trust and distrust spread over the links between hosts."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import keep

#: Host, path, verdict.
Rule = tuple[str, str, str]
DAMPING = 0.85
ROUNDS = 10
#: A host is blocked when distrust outweighs trust by more than this.
MARGIN = 0.5
#: A host's links are dealt into groups of about this many for each round.
FAN = 50_000

_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of the longest fitting rule's ``rule`` and ``verdict``, NULL if none fits.

    A rule fits its host and all subdomains where the path starts with its
    own. The list is a setting, short enough for one expression: no join.
    """
    chosen = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        made = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, made) if chosen is None else chosen.when(fits, made)
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return none if chosen is None else chosen.otherwise(none)


def host_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``(src, dst, links)``: absolute links counted between different hosts."""
    found = F.explode(F.regexp_extract_all(F.col(html_col), F.lit(_LINK), F.lit(1)))
    return (
        pages.select(host_of(F.col(url_col)).alias("src"), found.alias("dst"))
        .withColumn("dst", lower_ascii(F.col("dst")))
        .filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def propagate(
    seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS
) -> DataFrame:
    """``(host, trust, distrust)`` from ``(host, trust, distrust)`` seeds.

    Personalised PageRank: trust walks along links, distrust against them, and
    both return to their seeds with ``1 - damping``. A host without a way on
    keeps what it has. Seeds are not scaled to sum to one, so a score reads as
    a share of a full seed at every graph size. Both walks run as one table,
    a round being one join and one sum; a host with very many links is dealt
    over several groups, and all rounds are one Spark job.
    """
    ways = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "links")
    ways = ways.unionAll(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "links")
    )
    out = ways.groupBy("kind", "host").agg(
        F.sum("links").alias("all"), F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("fan")
    )
    hosts = seeds.select("host").unionAll(links.select("src")).unionAll(links.select("dst")).distinct()
    start = (
        hosts.join(seeds, "host", "left")
        .select("host", F.explode(F.create_map(
            F.lit("trust"), F.coalesce("trust", F.lit(0.0)), F.lit("distrust"), F.coalesce("distrust", F.lit(0.0))
        )).alias("kind", "seed"))
        .join(out.select("kind", "host", "fan"), ["kind", "host"], "left")
        .withColumn("fan", F.coalesce("fan", F.lit(0)))
    )
    start = keep(start, "seeds")
    group = F.pmod(F.xxhash64("to"), "fan").cast("int")
    steps = keep(
        ways.join(out, ["kind", "host"]).select(
            "kind", "host", group.alias("group"), "to", (F.col("links") / F.col("all")).alias("share")
        ),
        "steps",
    )
    now = start.withColumn("score", F.col("seed"))
    for _ in range(rounds):
        # Group -1 is the host itself; the plan reads the round before only once.
        groups = F.when(F.col("fan") > 0, F.sequence(F.lit(-1), F.col("fan") - 1)).otherwise(F.array(F.lit(-1)))
        own = F.col("group") == -1
        got = F.when(own, F.when(F.col("fan") == 0, F.col("score")).otherwise(0.0)).otherwise(
            F.coalesce(F.col("score") * F.col("share"), F.lit(0.0))
        )
        now = (
            now.withColumn("group", F.explode(groups))
            .join(steps, ["kind", "host", "group"], "left")
            .select(
                "kind", F.coalesce("to", "host").alias("host"),
                F.when(own, F.col("seed")).otherwise(0.0).alias("seed"),
                F.when(own, F.col("fan")).otherwise(0).alias("fan"), got.alias("got"),
            )
            .groupBy("kind", "host")
            .agg(F.max("seed").alias("seed"), F.max("fan").alias("fan"), F.sum("got").alias("got"))
            .select("kind", "host", "seed", "fan",
                    ((1 - damping) * F.col("seed") + damping * F.col("got")).alias("score"))
        )
    score = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("score"))).alias(kind)
    return now.groupBy("host").agg(score("trust"), score("distrust"))


def judge(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    margin: float = MARGIN, damping: float = DAMPING, rounds: int = ROUNDS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row.

    The longest fitting rule decides. Where none fits, the page's host does:
    it is blocked if distrust exceeds trust by more than ``margin``. Seeds are
    the shares of a host's rows that rules allow (trust) and block (distrust).

    A URL that is NULL or has no ``://`` has an empty host and path, no rule,
    and is allowed with zero scores. NULL pages have no links. Repeated rows
    count and are returned each; an empty table gives an empty result.
    """
    url = F.col(f"`{url_col}`")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    ).withColumn("r", matching_rule(F.col("host"), F.col("path"), rules))
    share = lambda verdict: F.avg(
        F.when(F.col("r.verdict") == verdict, 1.0).otherwise(0.0)
    )
    seeds = keep(
        rows.filter("host != ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")),
        "host-seeds",
    )
    links = keep(host_links(pages, url_col, html_col), "links")
    scores = keep(propagate(seeds, links, damping, rounds), "host-scores")
    held = scores.withColumnRenamed("host", "scored")
    by_host = F.when(F.col("distrust") - F.col("trust") > margin, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(held, rows["host"] == held["scored"], "left").select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
