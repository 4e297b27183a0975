"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks, keyed by block number and built by one aggregate, so neither a task nor the
driver holds it whole. A URL that lacks a bit of its block is surely not listed. The others, true hits and a few
false ones, go to an exact join with the list.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Filter bits per listed URL, bits per block, and bits set per URL (two in each 64-bit lane).
BITS_PER_URL, BLOCK_BITS, LANES = 16, 256, 4
#: (rule, verdict): a rule is a host with all its subdomains, and the beginning of a path.
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """host/path without scheme, ``www.``, default documents' slash or suffix, query tracking and fragment.

    Null for a null URL or one without ``://``.
    """
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]*|ref)=")))
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/+$", ""), r"\.html?$", "")
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(F.instr(url, "://") > 0, F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), path, tail))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        domain, _, begin = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + begin)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _lane_masks(url: Column) -> list[Column]:
    """For each lane the two bits that a URL sets."""
    bits = F.xxhash64(url, F.lit(1))
    one = F.lit(1).cast("long")
    at = [F.shiftright(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(2 * LANES)]
    return [F.call_function("shiftleft", one, at[2 * i]).bitwiseOR(F.call_function("shiftleft", one, at[2 * i + 1])) for i in range(LANES)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bloom_table(listed: DataFrame, blocks: int) -> DataFrame:
    """__block, __lane0 ...: the filter of the URLs in column ``canonical`` of ``listed``."""
    rows = listed.where(F.col("canonical").isNotNull())
    masks = [m.alias(f"__lane{i}") for i, m in enumerate(_lane_masks(F.col("canonical")))]
    return rows.select(_block(F.col("canonical"), blocks).alias("__block"), *masks).groupBy("__block").agg(*[F.bit_or(f"__lane{i}").alias(f"__lane{i}") for i in range(LANES)])


def blocks_for(n_listed: int) -> int:
    return max(1, math.ceil(n_listed * BITS_PER_URL / BLOCK_BITS))


def mark_listed(urls: DataFrame, listed: DataFrame, blocks: int | None = None) -> DataFrame:
    """urls, with column ``canonical``, and a column ``listed``: whether the list has it. One row per input row.

    A null canonical URL is never listed. Nulls and repeats in the list change nothing.
    """
    listed = listed.select("canonical").where(F.col("canonical").isNotNull()).distinct()
    blocks = blocks or blocks_for(listed.count())
    rows = urls.withColumns({"__block": _block(F.coalesce("canonical", F.lit("")), blocks)} | {f"__mask{i}": m for i, m in enumerate(_lane_masks(F.coalesce("canonical", F.lit(""))))})
    rows = rows.join(bloom_table(listed, blocks), "__block", "left")
    maybe = F.col("canonical").isNotNull()
    for i in range(LANES):
        maybe = maybe & F.coalesce(F.col(f"__lane{i}").bitwiseAND(F.col(f"__mask{i}")) == F.col(f"__mask{i}"), F.lit(False))
    rows = rows.withColumn("__maybe", maybe).select(*urls.columns, "__maybe")
    hits = rows.where("__maybe").join(listed.withColumn("listed", F.lit(True)), "canonical", "left")
    rest = rows.where("not __maybe").withColumn("listed", F.lit(False))
    return hits.select(*urls.columns, F.coalesce("listed", F.lit(False)).alias("listed")).unionByName(rest.select(*urls.columns, "listed"))


def repeated_addresses(pages: DataFrame) -> DataFrame:
    """The list in production: canonical URLs of which the crawl holds more than one page."""
    urls = pages.select(canonical(F.col("url").cast("string")).alias("canonical")).where(F.col("canonical").isNotNull())
    return urls.groupBy("canonical").count().where("count > 1").select("canonical")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the canonical URL, one row per page.

    A rule decides where one fits; else a listed page is blocked and any other allowed. Null URLs and those without
    ``://`` have empty host and path, fit no rule and are allowed. Repeated rows are judged alike. Other columns, of whatever
    name, are left out.
    """
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    marked = mark_listed(rows, listed)
    return marked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "canonical")
