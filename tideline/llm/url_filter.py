"""URL filter: a blocked Bloom filter before an exact hash join.

Listed keys are canonical ``host + path`` strings: a host stands for itself
and its subdomains, a path for all paths that begin with it. Every URL is
tested under each key that could list it (host suffixes times path prefixes of
the listed lengths). The filter, one 64-bit word per block with a few bits per
key, is a table of bounded size that every task holds; it answers most keys
with "not listed" in the stage of the scan. The rest, possible hits, go to a
hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without

#: Bits of a key in its block, listed keys per block on average, and most blocks: 16 MB of filter.
KEY_BITS = 4
KEYS_PER_BLOCK = 4
MAX_BLOCKS = 1 << 20


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for null or no ``://``."""
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*(/[^?#]*)?", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    """The bits of a key in its block: four six-bit pieces of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * k).bitwiseAND(63).cast("int"))
            for k in range(KEY_BITS)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def bloom(keys: DataFrame, key: str = "key") -> tuple[int, DataFrame]:
    """Number of blocks, and ``block, word``, of the filter of ``keys``. A
    block's word is the OR of its keys' masks; there are :data:`MAX_BLOCKS`
    words at most, whatever the list's length."""
    blocks = max(1, min(MAX_BLOCKS, -(-keys.count() // KEYS_PER_BLOCK)))
    return blocks, (keys.groupBy(_block(F.col(key), blocks).alias("block"))
                    .agg(F.bit_or(_mask(F.col(key))).alias("word")))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every page.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all
    subdomains if the page's path begins with the rule's; the longest rule
    (host and path together) wins, of equals the one with the longer host,
    then ``block`` over ``allow``. Pages that no rule fits have a null rule and
    the verdict ``default``. Rules with a null host or path are left out; of
    rules repeated with both verdicts ``block`` counts.

    Null URLs and those without ``://`` have an empty host and path, which no
    rule fits. Repeated pages are judged one by one; extra columns pass
    through, and columns with the added names are replaced.
    """
    rules = (rules.where("host is not null and path is not null and host != ''")
             .withColumn("key", F.concat("host", F.lit("\0"), "path"))
             .groupBy("key").agg(F.min(F.struct(F.col("verdict") != "block", "host", "path", "verdict")).alias("r"))
             .select("key", "r.host", "r.path", "r.verdict"))
    # which keys a URL can be listed under: numbers of labels of listed hosts
    # and lengths of listed paths, each no more than the longest URL has
    shapes = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
                       F.collect_set(F.length("path")).alias("lengths")).collect()[0]
    df = without(pages, "host", "path", "rule", "verdict")
    df = df.withColumn("host", url_host(F.col(f"`{url}`"))).withColumn("path", url_path(F.col(f"`{url}`")))
    if not shapes["labels"]:
        return df.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    sites = df.where("host != ''").select("host", "path").distinct()
    parts = F.split("host", r"\.")
    hosts = F.array_compact(F.array(*[F.when(F.size(parts) >= n, F.substring_index("host", ".", -n))
                                      for n in sorted(shapes["labels"])]))
    paths = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n))
                                      for n in sorted(shapes["lengths"])]))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, F.lit("\0"), p))))
    blocks, words = bloom(rules)
    tried = sites.select("host", "path", F.explode(keys).alias("key"))
    # at most MAX_BLOCKS rows of 16 bytes, so every task can hold them
    possible = (tried.join(F.broadcast(words), _block(F.col("key"), blocks) == F.col("block"))
                .where(F.col("word").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key")))
                .select("host", "path", "key"))
    listed = rules.select("key", F.struct(
        (F.length("host") + F.length("path")).alias("n"), F.length("host").alias("h"),
        (F.col("verdict") == "block").alias("b"), F.concat("host", "path").alias("rule"), "verdict").alias("r"))
    best = possible.join(listed, "key").groupBy("host", "path").agg(F.max("r").alias("__r"))
    return (df.join(best, ["host", "path"], "left")
            .withColumn("rule", F.col("__r.rule"))
            .withColumn("verdict", F.coalesce(F.col("__r.verdict"), F.lit(default)))
            .drop("__r"))
