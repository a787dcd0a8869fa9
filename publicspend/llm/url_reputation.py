"""URL filter: fixed rules first, else the reputation of the host.

A host's share of bad pages is estimated from labelled pages by beta-binomial shrinkage down the
name: the whole table is the prior of a suffix (`net`), the suffix's posterior is the prior of a
registered domain (`example.net`), and that is the prior of a host (`a.example.net`). How strongly
a level holds its children to itself is estimated from how much they differ (empirical Bayes, by
moments). A host is blocked if the lower bound of its posterior lies above a threshold: few bad
pages do not condemn a host unless its domain is bad too.

All of it is joins and sums of built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from publicspend.llm.common import stored, take

MARKS = "#*$%|"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host, with its subdomains, and the start of a path."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


@dataclass(frozen=True)
class Reputation:
    """A host is blocked if its share of bad pages, less ``deviations`` standard deviations, is
    over ``threshold``. Prior strengths, in pages, lie between ``weakest`` and ``strongest``;
    ``weakest`` holds where children cannot be compared. Suffixes with two labels are listed."""

    threshold: float = 0.5
    deviations: float = 1.645
    weakest: float = 2.0
    strongest: float = 1000.0
    long_suffixes: Sequence[str] = ("co.uk", "com.au", "co.jp", "com.br", "co.in")


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    return F.when(known, F.translate(host, UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    bare = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    cut = F.instr(bare, "/")
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    return F.when(known & (cut > 0), F.substring(bare, cut, F.length(bare))).otherwise("")


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of its length, text and verdict, or null.

    The rules lie in a map by host, in which each suffix of the host is looked up.
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,text:string,verdict:string>")
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    entry = "struct<size:int,text:string,verdict:string,path:string>"
    entries = [
        F.array(
            *[
                F.struct(*map(F.lit, (len(r.text), r.text, r.verdict, r.path))).cast(entry)
                for r in found
            ]
        )
        for found in by_host.values()
    ]
    table = F.map_from_arrays(F.array(*map(F.lit, by_host)), F.array(*entries))
    labels = F.split(host, "[.]")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    found = F.flatten(
        F.transform(
            suffixes, lambda s: F.coalesce(F.try_element_at(table, s), F.array().cast(f"array<{entry}>"))
        )
    )
    fitting = F.filter(found, lambda r: F.startswith(path, r["path"]))
    best = F.array_max(fitting)
    return F.struct(best["size"].alias("size"), best["text"].alias("text"), best["verdict"].alias("verdict"))


def _levels(host: Column, rules: Reputation) -> tuple[Column, Column]:
    """The suffix and the registered domain of a host."""
    last_two = F.substring_index(host, ".", -2)
    long = last_two.isin(*rules.long_suffixes)
    suffix = F.when(long, last_two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(long, F.substring_index(host, ".", -3)).otherwise(last_two)
    return suffix, domain


def _shrunk(children: DataFrame, parents: DataFrame, parent: str, rules: Reputation) -> DataFrame:
    """``children`` (n, bad) with the posterior (a, b) under their parents' means (``mean``).

    The strength of the prior is that of a beta distribution whose spread of means fits the
    children of all parents together: with the expected squared deviation of a child's share,
    m (1 - m) (1 + (n - 1) r) / n, the correlation r gives the strength 1 / r - 1.
    """
    met = children.join(parents.select(F.col(parent), F.col("mean").alias("prior")), parent)
    p, n = F.col("prior"), F.col("n")
    noise = p * (1 - p)
    seen = met.where((n > 0) & (noise > 0))
    excess = F.sum(n * F.pow(F.col("bad") / n - p, 2) - noise)
    room = F.sum(noise * (n - 1))
    fitted = seen.agg((excess / F.nullif(room, F.lit(0.0))).alias("r")).select(
        F.when(F.col("r") > 0, 1 / F.col("r") - 1)
        .when(F.col("r") <= 0, F.lit(rules.strongest))
        .alias("fitted")
    )
    bounded = F.least(F.greatest("fitted", F.lit(rules.weakest)), F.lit(rules.strongest))
    strength = F.coalesce(bounded, F.lit(rules.weakest))
    one = fitted.select(strength.alias("strength"), F.lit(1).alias("_one"))
    joined = met.withColumn("_one", F.lit(1)).join(one, "_one").drop("_one")
    a = p * F.col("strength") + F.col("bad")
    b = (1 - p) * F.col("strength") + n - F.col("bad")
    return joined.withColumn("a", a).withColumn("b", b).withColumn("mean", a / (a + b))


def junk(html: Column, share: float = 0.02) -> Column:
    """The outcome of a page by its own text: 1 if over ``share`` of it are signs that prose seldom
    has, 0 if not, null for a null page."""
    text = F.regexp_replace(html, "<[^>]*>", " ")
    marks = F.char_length(text) - F.char_length(F.translate(text, MARKS, ""))
    return (marks > share * F.char_length(text)).cast("int")


def host_reputation(outcomes: DataFrame, hosts: DataFrame, rules: Reputation) -> DataFrame:
    """``host``, ``mean``, ``lower`` of every host.

    ``outcomes`` has ``host`` and ``bad`` (0 or 1) of labelled pages; ``hosts`` has ``host``.
    Both are summed by host before anything else, so that a host with most of the pages is a
    row like others.
    """
    none = F.lit(None).cast("int").alias("bad")
    return _reputation(_counted(outcomes.select("host", "bad").union(hosts.select("host", none))), rules)


def _counted(outcomes: DataFrame) -> DataFrame:
    """Labelled pages ``n`` and those of them that are ``bad``, one row for each host."""
    bad = F.coalesce(F.sum("bad"), F.lit(0))
    return outcomes.groupBy("host").agg(
        F.count("bad").cast("double").alias("n"), bad.cast("double").alias("bad")
    )


def _reputation(counted: DataFrame, rules: Reputation) -> DataFrame:
    suffix, domain = _levels(F.col("host"), rules)
    named = counted.withColumn("suffix", suffix).withColumn("domain", domain)
    domains = named.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("mean")).withColumn(
        "_all", F.lit(0)
    )
    suffixes = _shrunk(suffixes.withColumn("_all", F.lit(0)), whole, "_all", rules)
    domains = _shrunk(domains, suffixes, "suffix", rules)
    judged = _shrunk(named, domains, "domain", rules)
    a, b = F.col("a"), F.col("b")
    spread = F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    return judged.select("host", "mean", (F.col("mean") - rules.deviations * spread).alias("lower"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    reputation: Reputation = Reputation(),
    outcome: str = "bad",
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    ``pages`` has ``page_id`` and ``url``, ``labels`` has ``page_id`` and ``bad``; without them the
    column ``outcome`` of ``pages`` says whether a page is bad. A null url, or
    one without ``://``, has an empty host and path, fits no rule and counts as a host of its own.
    Labels without a page, null labels and null ids take no part; a page with several labels
    counts each. Repeated rows, and pages with null ids, are judged row by row. ``rules`` are a
    short list; without labels every host is allowed.
    """
    rows = take(pages, page_id="page_id", url="url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    if labels is None:
        own = take(pages, url="url", bad=outcome)
        outcomes = own.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("int").alias("bad"))
    else:
        given = take(labels, page_id="page_id", bad="bad").where("bad IS NOT NULL")
        outcomes = rows.select("page_id", "host").join(given, "page_id").select("host", "bad")
        outcomes = outcomes.union(rows.select("host", F.lit(None).cast("int")))
    counted = stored(_counted(outcomes), "hosts")  # one row for each host; the pages are read once
    hosts = _reputation(counted, reputation)
    block = F.col("lower") > reputation.threshold
    blocked = hosts.where(block).select(F.col("host").alias("_host"))
    ruled = rows.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    met = ruled.join(blocked, F.col("host") == F.col("_host"), "left")
    own = F.when(F.col("_host").isNotNull(), "block").otherwise("allow")
    return met.select(
        "page_id",
        "host",
        "path",
        F.col("fit.text").alias("rule"),
        F.coalesce(F.col("fit.verdict"), own).alias("verdict"),
    )
