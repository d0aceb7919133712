"""URL filter by a temporal list join.

A list is a table of dated entries (kind, value, action, effective). The
entries of one (kind, value) become validity intervals: an entry holds from its
instant until the next one of the same value. Every capture is evaluated
against the entries in force at the instant it was fetched (as-of join). Blocks
of 32 days are join keys only, so that a much captured value is many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Host of an absolute URL: without user, port, path, query and fragment.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]*\]|[^/?#:@]*)"
#: Host and path, without scheme, query and fragment.
HOST_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^?#]*)"

BLOCK_DAYS = 32


def host(url: str | Column) -> Column:
    """Host in lower case, without the dot that ends a fully qualified name."""
    return F.lower(F.regexp_replace(F.regexp_extract(url, HOST, 1), r"\.+$", ""))


def page_key(url: str | Column) -> Column:
    """host/path, the host in lower case, without a trailing slash."""
    hp = F.regexp_extract(url, HOST_PATH, 1)
    path = F.regexp_replace(F.substring_index(hp, "?", 1), r"^[^/]*", "")
    return F.regexp_replace(F.concat(host(url), path), r"/+$", "")


def _suffixes(parts: Column) -> Column:
    """[a, b, c] -> a.b.c, b.c, c as (kind, value, rank) structs."""
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(parts, i, n), ".").alias("value"),
        (n - i + 1).cast("int").alias("rank")))


def _value(kind: Column, value: Column) -> Column:
    """A list value as captures spell it: hosts in lower case, without a last dot."""
    head = F.lower(F.regexp_replace(F.regexp_extract(value, r"^[^/]*", 0), r"\.+$", ""))
    return F.concat(head, F.when(kind == "domain", F.lit("")).otherwise(F.regexp_replace(value, r"^[^/]*", "")))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, value, action, valid_from, valid_to) in instants: valid_to is
    exclusive and null while the entry is the latest. A date counts from its
    first instant. Several entries of a value at one instant count as one, a
    block before an allow. Entries with a null field or no readable time are void."""
    at = (entries.select("kind", _value(F.col("kind"), F.col("value")).alias("value"), "action",
                         F.col("effective").try_cast("timestamp").alias("valid_from"))
          .dropna()
          .groupBy("kind", "value", "valid_from").agg(F.max("action").alias("action")))  # 'block' > 'allow'
    return at.withColumn("valid_to", F.lead("valid_from").over(W.partitionBy("kind", "value").orderBy("valid_from")))


def temporal_url_filter(captures: DataFrame, entries: DataFrame, url_col: str = "url",
                        time_col: str = "fetched_at") -> DataFrame:
    """``captures`` plus matched (int), rule_kind, rule_value, rule_since, blocked.

    ``matched`` counts the entries in force for the URL (its page key, its host
    and each parent domain); the most specific one decides: the page before any
    domain, a longer domain before a shorter. A null URL or time, or one
    without a host, matches nothing and is not blocked. Columns of ``captures``
    are kept, those with the new names replaced; repeated rows stay; an empty
    list or table is no error.

    Times are instants; a date counts as its first instant, a text that is no
    time as null. ``rule_since`` has the type of the list's ``effective``.

    Decisions are made once per distinct (url, instant) and joined back. All
    joins are equi-joins (value and block of 32 days; url and instant) whose
    large side AQE can split. An interval meets only the blocks in which its
    value was captured, so that dates of any year, and entries that never end,
    cost nothing.
    """
    at = F.col(time_col).try_cast("timestamp")
    asked = (captures.select(F.col(url_col).alias("_u"), at.alias("_t")).dropna().distinct()
             .withColumn("_h", host("_u")).filter("_h != ''").withColumn("_p", F.split("_h", r"\.")))
    page = F.array(F.struct(F.lit("page").alias("kind"), page_key("_u").alias("value"), F.lit(1000).alias("rank")))
    block = lambda c: F.floor(F.unix_seconds(c) / F.lit(BLOCK_DAYS * 86400))
    keys = (asked.select("_u", "_t", F.explode(F.concat(page, _suffixes(F.col("_p")))).alias("k"))
            .select("_u", "_t", block(F.col("_t")).alias("_b"), "k.kind", "k.value", "k.rank"))
    held = intervals(entries)
    live = keys.select("kind", "value", "_b").distinct().join(held, ["kind", "value"]).filter(
        (block(F.col("valid_from")) <= F.col("_b")) & (F.col("valid_to").isNull() | (F.col("_b") <= block(F.col("valid_to")))))
    hit = keys.join(live, ["kind", "value", "_b"]).filter(
        (F.col("valid_from") <= F.col("_t")) & (F.col("valid_to").isNull() | (F.col("_t") < F.col("valid_to"))))
    best = hit.groupBy("_u", "_t").agg(
        F.count("*").cast("int").alias("matched"),
        F.max_by(F.struct("kind", "value", "valid_from", "action"), "rank").alias("_r"))
    new = {"matched", "rule_kind", "rule_value", "rule_since", "blocked"}
    out = captures.alias("c").join(best.alias("b"), (F.col(f"c.{url_col}") == F.col("b._u"))
                                   & (F.col(f"c.{time_col}").try_cast("timestamp") == F.col("b._t")), "left")
    return out.select(*[F.col(f"c.`{c}`") for c in captures.columns if c not in new], F.coalesce("b.matched", F.lit(0)).alias("matched"),
                      F.col("b._r.kind").alias("rule_kind"), F.col("b._r.value").alias("rule_value"),
                      F.col("b._r.valid_from").cast(entries.schema["effective"].dataType).alias("rule_since"),
                      F.coalesce(F.col("b._r.action") == "block", F.lit(False)).alias("blocked"))
