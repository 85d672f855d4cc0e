"""URL filters: a blocked Bloom filter before an exact hash join.

Rules are (host, path, verdict): a rule fits its host and all subdomains if
the path starts with the rule's. Listed URLs are matched whole, in canonical
form. Every key that could match a URL - each host suffix of as many labels as a
rule has with each rule-path length, and the canonical URL itself - probes one blocked Bloom filter of all
rules and listed URLs; keys that may be in it are joined exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from ._shared import materialise, small_batches

# Query parameters that do not change a page.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)"


#: Rules and listed URLs that are broadcast to the join at most.
BROADCAST_KEYS = 10_000


def _rest(url: Column) -> Column:
    """What follows the first "://" (empty without one)."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """Host after the first "://", A-Z lower-cased; empty for null."""
    return F.coalesce(_ascii_lower(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    """Path from the end of the host to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without "www.", port 80 or 443 and trailing dot, then the path
    (at least "/"), then the query without tracking parameters, sorted. Null,
    or text without "://", is null."""
    plain = F.regexp_replace(F.regexp_replace(host(url), r"\A[^@]*@", ""), r"\A(?:www\.)?(.*?)\.?(?::(?:80|443))?\z", "$1")
    query = F.regexp_extract(_rest(url), r"\A[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(rf"(?i)\A{TRACKING}(?:=|\z)"))), "&")
    road = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    return F.when(F.instr(url, "://") > 0, F.concat(plain, road, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept))))


def _key(kind: str, host_: Column, path_: Column) -> Column:
    return F.concat(F.lit(kind), host_, F.lit("\n"), path_)


def _labels(host_: Column) -> Column:
    return F.length(host_) - F.length(F.replace(host_, F.lit("."), F.lit(""))) + 1


def _suffixes(host_: Column, sizes: list[int]) -> Column:
    """Of the host and its parent domains those of so many labels (none for an
    empty host). A host of very many labels gives no more than any other."""
    none = F.lit(None).cast("string")
    every = F.array(*(F.when(_labels(host_) >= n, F.substring_index(host_, ".", -n)) for n in sizes), none)
    return F.filter(every, lambda s: s.isNotNull() & (s != ""))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame | None = None,
    default: str = "allow",
    bits_per_key: int = 12,
    max_bytes: int = 16 << 20,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    Reads ``page_id`` and ``url``; ``rules`` has host, path, verdict and
    ``listed`` has url, verdict. Of the rules that fit, the longest (host and
    path together, then the longer host, then the text) gives rule and
    verdict. Without a rule, rule is null and the verdict is that of the
    listed canonical URL (``block`` if it has several), else ``default``.

    A null or empty url, or one without "://", has an empty host and path,
    which no rule fits. A very long url is judged whole. Repeated rows are
    judged alike, other columns are ignored whatever their names, empty tables
    give no rows, empty rules leave the default. Only the Bloom
    filter is sent to all machines, at most ``max_bytes`` however long the
    lists are; a fuller filter passes more keys to the join and loses none.
    """
    small_batches(pages.sparkSession, 10_000)
    rules = rules.select(F.col("host").cast("string").alias("h"), F.col("path").cast("string").alias("p"), F.col("verdict").alias("v")).where("h is not null and p is not null")
    known = rules.select(_key("r", F.col("h"), F.col("p")).alias("key"), F.concat("h", "p").alias("rule"), F.length("h").alias("longer"), "v")
    if listed is not None:
        whole = listed.select(canonical_url(F.col("url")).alias("c"), F.col("verdict").alias("v")).where("c is not null")
        known = known.unionByName(whole.select(_key("u", F.col("c"), F.lit("")).alias("key"), F.lit(None).cast("string").alias("rule"), F.lit(-1).alias("longer"), "v"))
    known = materialise(known.groupBy("key", "rule", "longer").agg(F.max("v").alias("v")), "rules")
    keys_known = known.count()
    words = bloom.build(known, F.xxhash64("key"), bloom.blocks_for(keys_known, bits_per_key, max_bytes))
    may_contain = bloom.prober(pages.sparkSession, words)
    # Path lengths that rules have, and numbers of labels: short lists.
    lengths = [r[0] for r in rules.select(F.length("p").alias("n")).distinct().orderBy("n").collect()]
    sizes = [r[0] for r in rules.select(_labels(F.col("h")).alias("n")).distinct().orderBy("n").collect()]

    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id"), host(url).alias("host"), path(url).alias("path"), F.coalesce(canonical_url(url), F.lit("")).alias("c"))
    # Equal URLs are judged once.
    one = rows.select("host", "path", "c").distinct()
    prefixes = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")) if lengths else F.array().cast("array<int>")
    by_rule = F.flatten(F.transform(_suffixes(F.col("host"), sizes), lambda h: F.transform(prefixes, lambda n: _key("r", h, F.substring(F.col("path"), F.lit(1), n)))))
    keys = F.concat(by_rule, F.when(F.col("c") != "", F.array(_key("u", F.col("c"), F.lit("")))).otherwise(F.array().cast("array<string>")))
    asked = one.select("host", "path", "c", F.explode(keys).alias("key"))
    # A short list is broadcast; a longer one is dealt out by the
    # keys' hash and met in hash tables.
    hits = asked.where(may_contain(F.xxhash64("key"))).join(F.broadcast(known) if keys_known <= BROADCAST_KEYS else known.hint("shuffle_hash"), "key")
    best = hits.groupBy("host", "path", "c").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "longer", "rule", "v"))).alias("top"),
        F.max(F.when(F.col("rule").isNull(), F.col("v"))).alias("mark"),
    )
    # Written, so that the join below exchanges both sides and can be split; it
    # is no broadcast, since its rows grow with the pages.
    best = materialise(best, "verdicts")
    out = rows.join(best.hint("merge"), ["host", "path", "c"], "left")
    return out.select("page_id", "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.v", "mark", F.lit(default)).alias("verdict"))
