"""URL filters: ordered rules, and a list of hosts held by a Bloom filter cascade.

A URL's host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case; its path what follows up to ``?``, ``#`` or the end. A rule (host, path,
verdict) fits its host and all subdomains where the URL's path starts with the
rule's. The longest rule (host and path together) that fits decides; of equally long
ones that with the longer host, then a block. If none fits, the list of hosts
does: a host is blocked if it or a domain above it is listed.

The list is never joined with the pages. The corpus's distinct hosts are the key
universe. Level 1 of the cascade is a Bloom filter of the listed hosts of the
universe, level 2 one of the other hosts that level 1 wrongly lets pass, level 3 one of
the listed hosts that level 2 lets pass, and so on until no host is wrong.
A host's membership is then exact for the whole universe: it is listed if the first
level that it doesn't pass is an even one (or it passes all of an odd number).

A level is written as a table of 64-bit words and read as one array by a
scalar subquery. Its size follows the listed hosts in the corpus, about 1.5 bits
times the level's error exponent each; the list is cut by a hash of the
host into blocks of at most ``block_keys`` listed hosts, each with a cascade of its own
and one pass over the pages, so no array outgrows that bound. (Rows of other
blocks are left out by a filter on the host's hash.)

DataFrame functions only. Defined cases: a null URL or one without ``://`` has empty host and path,
fits no rule with a host, and is allowed; repeated rows give repeated rows; an
empty list, rule set or table is fine; other columns aren't needed.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import written

#: (host, path, verdict)
Rule = tuple[str, str, str]
#: Listed hosts of one cascade at most, about: 2 MB for level 1 at an error rate of 2**-10.
BLOCK_KEYS = 1_000_000
WORD = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The deciding rule as text (host and path) and its verdict; nulls if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block"))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    """Bit numbers of a key in a level."""
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits).cast("long")) for j in range(hashes)]


class Level:
    """One Bloom filter: its words as a table, sorted into an array where it is used."""

    def __init__(self, keys: DataFrame, number: int, n: int, error: float):
        self.number = number
        self.hashes = max(1, math.ceil(math.log2(1 / error)))
        self.bits = WORD * max(1, math.ceil(n * self.hashes / math.log(2) / WORD))
        at = F.explode(F.array(*_positions(F.col("host"), number, self.hashes, self.bits)))
        set_words = (keys.select(at.alias("b")).select(F.expr(f"b div {WORD}").alias("i"), F.pmod("b", F.lit(WORD)).cast("int").alias("s"))
                     .select("i", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("s")).alias("w")))
        spark = keys.sparkSession
        zeros = spark.range(self.bits // WORD).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w"))
        self.words = written(set_words.union(zeros).groupBy("i").agg(F.bit_or("w").alias("w")), "bloom-level")

    def passes(self, host: Column) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct("i", "w")))
        array = self.words.select(F.transform(ordered, lambda x: x["w"])).scalar()
        return reduce(lambda a, b: a & b, [
            F.call_function("getbit", F.get(array, _word(p)), F.pmod(p, F.lit(WORD)).cast("int")) == 1
            for p in _positions(host, self.number, self.hashes, self.bits)])


def _word(position: Column) -> Column:
    return F.call_function("shiftright", position, F.lit(6)).cast("int")


class Cascade:
    """Exact membership for the hosts of one block of the universe."""

    def __init__(self, universe: DataFrame):
        """``universe``: ``host`` (distinct) and ``listed``."""
        self.levels: list[Level] = []
        encode, test = universe.where("listed").select("host"), universe.where("not listed").select("host")
        n, others = encode.count(), test.count()
        error = min(0.5, n / (math.sqrt(2) * others)) if n and others else 0.5
        while n:
            level = Level(encode, len(self.levels) + 1, n, error)
            self.levels.append(level)
            wrong = written(test.where(level.passes(F.col("host"))), "bloom-wrong")
            encode, test, n, error = wrong, encode, wrong.count(), 0.5

    def listed(self, host: Column) -> Column:
        """Whether a host of the universe is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            # not passing an odd level: not listed; not passing an even one: listed
            out = F.when(level.passes(host), out).otherwise(F.lit(level.number % 2 == 0))
        return out


def universe_of(hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """``host, listed`` of each distinct host; ``listed`` has the column ``domain``."""
    distinct = hosts.select("host").distinct()
    listed = listed.select(F.translate(F.col("domain"), UPPER, LOWER).alias("domain")).where("domain != ''").distinct()
    depth = listed.agg(F.max(F.size(F.split("domain", r"\.")))).first()[0] or 1
    labels = F.split("host", r"\.")
    last = F.slice("labels", F.greatest(F.size("labels") - depth + 1, F.lit(1)), F.lit(depth))
    domains = (distinct.select("host", labels.alias("labels")).select("host", last.alias("last"))
               .select("host", F.explode(F.transform(
                   F.sequence(F.lit(1), F.size("last")),
                   lambda i: F.array_join(F.slice("last", i, depth), "."))).alias("domain")))
    on_list = domains.join(listed, "domain", "left_semi").select("host").distinct()
    flagged = (distinct.select("host", F.lit(False).alias("l"))
               .union(on_list.select("host", F.lit(True))).groupBy("host").agg(F.max("l").alias("listed")))
    return written(flagged, "url-universe")


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, id_col: str = "page_id", url: str = "url",
          block_keys: int = BLOCK_KEYS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    host, path = host_and_path(F.col(f"`{url}`"))
    parts = pages.select(F.col(f"`{id_col}`").alias(id_col), host.alias("host"), path.alias("path"))
    universe = universe_of(parts, listed)
    n_listed = universe.where("listed").count()
    n_blocks = max(1, -(-n_listed // block_keys))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    block = F.pmod(F.xxhash64("host", F.lit(77)), F.lit(n_blocks))
    out = None
    for b in range(n_blocks):
        cascade = Cascade(universe.where(block == b))
        mine = parts.where(block == b) if n_blocks > 1 else parts
        judged = mine.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(
            verdict, F.when(cascade.listed(F.col("host")), "block").otherwise("allow")).alias("verdict"))
        out = judged if out is None else out.union(judged)
    return out


#: The rules that the registered query judges by.
RULES: list[Rule] = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: The listed sites of the registered query, each under three domains.
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_DOMAINS = [f"{s}.example.{d}" for s in LISTED_SITES for d in ("com", "net", "org")]

_VALUES = ", ".join(f"('{d}')" for d in LISTED_DOMAINS)
ORACLE = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN EXISTS (SELECT 1 FROM (VALUES {_VALUES}) v(d) WHERE host = d OR suffix(host, '.' || d)) THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""
