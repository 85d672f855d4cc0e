"""Secret scans with corpus-wide ownership frequency, natively.

Candidate credentials are located by fixed patterns. Their values, hashed, are
then counted over the whole corpus by distinct repositories and owners: a
value that many owners hold is a copied example, one that a single owner holds
in few repositories looks live. Generic strings become spans only if they look
live and have the form of a key: characters spread over a large alphabet, and
letters and digits that alternate as they do in random strings, not in paths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._native import let, match_spans
from ._shared import materialise

# The patterns of the base kinds, in the order of the report.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
#: Runs that may be a credential of an unknown kind.
GENERIC = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "owned"]
#: Runs of one class of characters.
RUNS = r"[a-z]+|[A-Z]+|[0-9]+"


def key_like(value: Column) -> Column:
    """Whether a string has the form of a random key, in whole numbers.

    It has a letter and a digit. Two characters drawn from it agree with p <= 1/9 (collision entropy of log2(9) bits), and
    without separators, a run of equal classes (lower, upper, digit) is at
    most four characters long on average.
    """
    n = F.length(value)
    agree = let(
        F.array_distinct(F.split(value, "")),
        lambda letters: F.aggregate(letters, F.lit(0).cast("long"), lambda acc, c: acc + F.pow(F.length(value) - F.length(F.replace(value, c, F.lit(""))), F.lit(2)).cast("long")),
    )
    plain = F.regexp_replace(value, "[+/_-]", "")
    runs = F.size(F.regexp_extract_all(plain, F.lit(RUNS), F.lit(0)))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (n.cast("long") * n >= 9 * agree) & (4 * runs >= F.length(plain))


def _spans(text: Column) -> Column:
    """All candidates of a text: struct(start, end, kind number, value)."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    low = F.lower(text)
    named = reduce(lambda a, b: a | b, [low.contains(w) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")])
    assign = F.when(named, F.filter(match_spans(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= 6)).otherwise(none)
    access = F.when(text.contains("AKIA"), F.filter(match_spans(text, ACCESS), lambda x: F.length(x["value"]) >= 20)).otherwise(none)
    hexes = F.when(text.rlike(HEX), match_spans(text, HEX)).otherwise(none)
    generic = F.when(text.rlike(GENERIC), F.filter(match_spans(text, GENERIC), lambda x: key_like(x["value"]))).otherwise(none)
    return F.concat(*(_of_kind(k, a) for k, a in enumerate((assign, access, hexes, generic))))


def _outside(each: DataFrame) -> DataFrame:
    """Base spans, and generic ones that meet no base span of their row: none
    that starts before them ends inside, and none starts inside. Sorted once,
    so the cost of a row is that of sorting its spans."""
    order = W.partitionBy("rid").orderBy("start", "kind")
    before = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    after = F.expr("lead(CASE WHEN kind < 3 THEN start END) IGNORE NULLS OVER (PARTITION BY rid ORDER BY start, kind)")
    marked = each.withColumn("before", before).withColumn("after", after)
    meets = (F.coalesce("before", F.lit(0)) > F.col("start")) | (F.coalesce(F.col("after") < F.col("end"), F.lit(False)))
    return marked.where((F.col("kind") < 3) | ~meets).drop("before", "after")


def _of_kind(k: int, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"], x["end"], F.lit(k).alias("kind"), F.sha2(x["value"], 256).alias("value")))


def _count(spans: Column, of) -> Column:
    return F.size(F.filter(spans, of)).cast("long")


def _count_kind(spans: Column, k: int) -> Column:
    return _count(spans, lambda x: x["kind"] == k)


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined, by start and then kind."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def secret_spans(documents: DataFrame, repository: str = "source", owner: str | None = None, copied_owners: int = 3, live_repositories: int = 5) -> DataFrame:
    """Spans and ownership counts of every document.

    Reads ``doc_id``, ``text`` and the repository column; ``owner`` names a
    column too, or is None: then an owner is what stands before the first "/"
    of the repository. A value looks live if one owner holds it in at most
    ``live_repositories`` repositories (a vendored example of a single owner
    is in more), and is copied if ``copied_owners`` owners or more hold it.

    Returns, one row for each input row, doc_id, n_assign, n_access, n_hex,
    base_sha256, spans (base spans, and ``owned`` ones: generic candidates of
    the form of a key outside all base spans whose value looks live), n_live
    and n_copied (base spans whose value looks live, or is copied),
    n_repositories (the most repositories that hold one of the base values, 0
    without any), and ``labels``: an array of (start, end, kind, value_sha256,
    repositories, owners, occurrences).

    Null and empty texts have no spans, null repositories and owners count as
    one of their own, repeated rows are counted again as occurrences but not
    as owners. Very long texts are searched whole, and keys of any
    length are reported. Spans that start at one
    place are listed by kind. Other columns are ignored, whatever their names.
    An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    repo = F.coalesce(F.col(repository).cast("string"), F.lit("")) if repository in documents.columns else F.lit("")
    own = F.coalesce(F.col(owner).cast("string"), F.lit("")) if owner else F.substring_index(repo, "/", 1)
    # The row number lasts because the table is written at once.
    rows = documents.select("doc_id", repo.alias("repo"), own.alias("owner"), _spans(text).alias("found"), F.monotonically_increasing_id().alias("rid"))
    rows = materialise(rows, "spans")

    each = rows.where(F.size("found") > 0).select("rid", "repo", "owner", F.explode("found").alias("x")).select("rid", "repo", "owner", "x.*")
    each = materialise(_outside(each), "candidates")
    held = each.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
    held = held.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    held = held.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repositories"), F.sum("n").alias("occurrences"))
    held = materialise(held, "owners")

    known = each.select("rid", "start", "end", "kind", "value").join(held, "value")
    label = F.struct("start", "end", "kind", F.col("value").alias("value_sha256"), "repositories", "owners", "occurrences")
    known = materialise(known.groupBy("rid").agg(F.collect_list(label).alias("labels")), "labels")

    joined = rows.select("rid", "doc_id").join(known, "rid", "left")
    labels = F.coalesce("labels", F.array().cast(known.schema["labels"].dataType))
    base = F.filter(labels, lambda x: x["kind"] < 3)
    live = lambda x: (x["owners"] == 1) & (x["repositories"] <= live_repositories)
    owned = F.filter(labels, lambda x: (x["kind"] == 3) & live(x))
    return joined.select(
        "doc_id",
        *[_count_kind(base, k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, owned)).alias("spans"),
        _count(base, live).alias("n_live"),
        _count(base, lambda x: x["owners"] >= copied_owners).alias("n_copied"),
        F.coalesce(F.array_max(F.transform(base, lambda x: x["repositories"])), F.lit(0).cast("long")).alias("n_repositories"),
        F.array_sort(F.concat(base, owned)).alias("labels"),
    )
