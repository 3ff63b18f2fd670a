"""URL filters by a Bloom filter cascade, in DataFrame functions only.

Listed keys are rules: a host (with its subdomains) and a path prefix, each with a verdict.  For every URL the possible
keys are each suffix of its host (cut at labels) joined with each prefix of its path that is as long as some rule's path.
These possible keys of the whole corpus are the key universe.  Per verdict one cascade is built: level 1 encodes the
listed keys, level 2 the universe's keys that level 1 passes wrongly, level 3 the listed keys that level 2 passes, and so
on until a level passes nothing wrongly.  A key is listed exactly if the first level that rejects it is an even one (or the
last level passes it and is odd).  So membership over the universe is exact, and the test needs no join.

Scale: a level is one binary literal in the plan.  Level 1 takes log2(universe / listed) * 1.44 bits a listed key and the later
ones hold about as many keys as are listed, so the size follows the list and the logarithm of the corpus.  Where a level would
pass `max_filter_bytes`, the keys are dealt by a hash to slices with a cascade each, so no list is too long; only the driver's
memory bounds their sum.  The list is a table of any size and is itself no part of the plan.  The distinct keys of the corpus
are written once and read by each level.  Words of a level are joined on executors into pieces of 32 kB before they reach the
driver.  A row's keys are tested once, for the rule and its verdict together.

Cases: a null URL, or one without "://", has empty host and path and no possible keys, so no rule.  An empty table gives an
empty result.  Repeated rows are judged each.  Rules given twice count once; the same key with two verdicts is refused.
Other columns pass through untouched; a column of the result's names (host, path, rule, verdict) is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": F.translate(raw, _UPPER, _LOWER), "path": path})


def possible_keys(lengths: list[int]) -> F.Column:
    """All (host suffix, path prefix) keys of a row, longest first."""
    labels = F.split(F.col("host"), r"\.")
    hosts = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    paths = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.array_sort(keys, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).otherwise(0))


def _positions(key: F.Column, level: int, hashes: int, bits: int) -> list[F.Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 64 + i)), F.lit(bits)) for i in range(hashes)]


#: 64-bit words in a piece of a level.
PIECE = 4096


class Level:
    def __init__(self, keys: DataFrame, count: int, rate: float, level: int, most_bytes: int):
        self.level, self.hashes = level, max(1, round(-math.log2(rate)))
        self.bits = 64 * max(1, math.ceil(count * -math.log(rate) / math.log(2) ** 2 / 64))
        if self.bits > 8 * most_bytes:
            raise OverflowError(f"a level of {self.bits // 8} bytes is over the limit of {most_bytes}")
        at = F.explode(F.array(*_positions(F.col("key"), level, self.hashes, self.bits)))
        words = keys.select(at.alias("b")).groupBy(F.floor(F.col("b") / 64).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 64).cast("int"))).alias("v"))
        entries = F.map_from_entries(F.collect_list(F.struct((F.col("w") % PIECE).cast("int").alias("w"), "v")))
        every = F.transform(F.sequence(F.lit(0), F.lit(PIECE - 1)), lambda i: F.lpad(F.hex(F.coalesce(F.col("m")[i], F.lit(0).cast("long"))), 16, "0"))
        pieces = words.groupBy(F.floor(F.col("w") / PIECE).alias("p")).agg(entries.alias("m")).select("p", F.unhex(F.array_join(every, "")).alias("data"))
        data = bytearray(8 * PIECE * math.ceil(self.bits / 64 / PIECE))
        for r in pieces.collect():  # most_bytes in all, checked above
            data[8 * PIECE * r.p : 8 * PIECE * (r.p + 1)] = r.data
        self.data = bytes(data[: self.bits // 8])

    def passes(self, key: F.Column) -> F.Column:
        out, data = F.lit(True), F.lit(self.data)
        for p in _positions(key, self.level, self.hashes, self.bits):
            # words are written high byte first
            byte = F.floor(p / 64) * 8 + 7 - F.floor((p % 64) / 8)
            value = F.ascii(F.decode(F.substring(data, (byte + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
            out = out & (F.call_function("shiftright", value, (p % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return out


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, most_bytes: int = 1 << 23) -> Cascade:
        """listed, universe: tables of a column `key`, the universe's distinct.  Builds until a level passes nothing wrongly."""
        listed = listed.select("key").distinct()
        wrong = universe.select("key").join(listed, "key", "left_anti")
        n = listed.count()
        if n == 0:
            return cls([])
        rate = first_rate(n, wrong.count())
        levels: list[Level] = []
        encode, others = listed, wrong
        while n:  # each level passes about half of the others, so their number falls by powers
            levels.append(Level(encode, n, rate, len(levels), most_bytes))
            encode, others, rate = others.filter(levels[-1].passes(F.col("key"))), encode, 0.5
            n = encode.count()
        return cls(levels)

    def has(self, key: F.Column) -> F.Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            out = F.when(level.passes(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def first_rate(listed: int, others: int) -> float:
    return min(0.5, listed * math.sqrt(0.5) / max(1, others))


class Sliced:
    """Cascades over slices of the keys, as many as keep each level below most_bytes."""

    def __init__(self, slices: list[Cascade]):
        self.slices = slices

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame, most_bytes: int = 1 << 23) -> Sliced:
        n, others = listed.count(), universe.count()
        bits = n * -math.log(first_rate(max(n, 1), others)) / math.log(2) ** 2
        slices = max(1, math.ceil(bits / 8 / most_bytes))
        while True:
            try:
                return cls([Cascade.build(listed.filter(cls.slice(slices) == i), universe.filter(cls.slice(slices) == i), most_bytes) for i in range(slices)])
            except OverflowError:  # a slice holds more than its share
                slices *= 2

    @staticmethod
    def slice(slices: int, key: F.Column | None = None) -> F.Column:
        return F.pmod(F.xxhash64(F.col("key") if key is None else key, F.lit(-1)), F.lit(slices))

    def has(self, key: F.Column) -> F.Column:
        out, at = self.slices[-1].has(key), self.slice(len(self.slices), key)
        for i in range(len(self.slices) - 2, -1, -1):
            out = F.when(at == i, self.slices[i].has(key)).otherwise(out)
        return out


def judge(df: DataFrame, rules: DataFrame | list[tuple[str, str, str]], url: str = "url", default: str = "allow", max_filter_bytes: int = 1 << 23) -> DataFrame:
    """Adds host, path, rule and verdict.  rules: rows (verdict, host, path), few different verdicts; the longest that fits wins."""
    spark = df.sparkSession
    scratch = common.Scratch(spark)
    if isinstance(rules, list):
        rules = common.literal_table(spark, [{"verdict": v, "host": h, "path": p} for v, h, p in rules], "verdict: string, host: string, path: string")
    listed = scratch.table(rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("length"), "verdict").distinct(), "rules")
    if clash := listed.groupBy("key").agg(F.count_distinct("verdict").alias("n")).filter("n > 1").first():
        raise ValueError(f"two verdicts for {clash['key']}")
    lengths = sorted(r["length"] for r in listed.select("length").distinct().collect())  # a row a length of path
    out = with_host_path(df, url)
    if not lengths:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = possible_keys(lengths)
    # rows with the same keys repeat their judgement, so the universe is taken from distinct (host, path starts)
    starts = with_host_path(df.select(url), url).select("host", F.substring("path", 1, max(lengths)).alias("path")).distinct()
    universe = scratch.table(starts.select(F.explode(keys).alias("key")).distinct(), "keys")
    verdicts = sorted(r["verdict"] for r in listed.select("verdict").distinct().collect())
    cascades = [Sliced.build(listed.filter(F.col("verdict") == v), universe, max_filter_bytes) for v in verdicts]
    scratch.drop(universe, listed)

    def judged(key: F.Column) -> F.Column:
        verdict = F.lit(None).cast("string")
        for v, c in zip(verdicts, cascades, strict=True):
            verdict = F.when(c.has(key), F.lit(v)).otherwise(verdict)
        return F.struct(key.alias("rule"), verdict.alias("verdict"))

    hit = F.get(F.filter(F.transform(keys, judged), lambda x: x["verdict"].isNotNull()), F.lit(0))
    out = out.withColumn("__hit", hit)
    return out.withColumns({"rule": F.col("__hit.rule"), "verdict": F.coalesce("__hit.verdict", F.lit(default))}).drop("__hit")


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.documents(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


SQL = f"""
WITH r AS (SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '') AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT *, CASE WHEN {_fits('example.net', '/en/')} THEN 'example.net/en/' WHEN {_fits('example.com', '/de/')} THEN 'example.com/de/'
  WHEN {_fits('org', '/fr/')} THEN 'org/fr/' WHEN {_fits('net', '/')} THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""
