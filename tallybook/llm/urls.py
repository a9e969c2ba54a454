"""URL filters: host and path rules, and a blocked Bloom filter before an exact join on a list."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blocks of the filter, 8 lanes of 32 bits each: 512 KiB at most, whatever the list holds.
BLOCKS = 16_384
LANES = 8

Rule = tuple[str, str, str]  # host, path, verdict


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL; both empty for null or a URL without ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """The form under which URLs are listed: host without ``www.`` or ``m.``, path without a
    closing slash or ``.html``. Empty for a URL without a host."""
    bare = F.regexp_replace(path, r"(\.html|/)+$", "")
    joined = F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), bare)
    return F.when(host == "", F.lit("")).otherwise(joined)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does.

    A rule fits its host and every subdomain of it, where the path starts with the rule's.
    Rules are a parameter, tested longest first within each row.
    """
    text = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS)).cast("int")


def _bit(key: Column, lane: int) -> Column:
    # one of 32 bits in each lane, from a hash that does not share the block's
    place = F.pmod(F.xxhash64(F.lit(lane), key), F.lit(32)).cast("int")
    return F.call_function("shiftleft", F.lit(1), place)


def bloom_filter(keys: DataFrame, key_col: str) -> DataFrame:
    """(block, lane0 ... lane7): the filter's blocks that hold any key, ``BLOCKS`` at most.

    Each task ORs the bits of its own keys before the exchange.
    """
    key = F.col(key_col)
    lanes = [F.bit_or(_bit(key, i)).alias(f"lane{i}") for i in range(LANES)]
    return keys.groupBy(_block(key).alias("block")).agg(*lanes)


def listed_among(
    rows: DataFrame, key_col: str, listed: DataFrame, listed_col: str, out: str = "listed"
) -> DataFrame:
    """The rows with a boolean ``out``: whether their key is on the list.

    Rows whose bits are not all set are off the list. The others meet the list in a hash join
    on the key itself, which takes out the filter's false positives. The filter is broadcast:
    its size is bounded by ``BLOCKS``. Null keys are not listed; a list may repeat keys.
    """
    keys = listed.select(F.col(listed_col).alias("_key")).filter("_key is not null").distinct()
    bits = bloom_filter(keys, "_key").select(
        F.col("block").alias("_block"), *[F.col(f"lane{i}").alias(f"_lane{i}") for i in range(LANES)]
    )
    key = F.col(key_col)
    tested = rows.join(F.broadcast(bits), _block(key) == F.col("_block"), "left")
    hit = F.col("_block").isNotNull() & key.isNotNull()
    for i in range(LANES):
        hit &= F.col(f"_lane{i}").bitwiseAND(_bit(key, i)) != 0
    tested = tested.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    keep = [F.col(f"`{c}`") for c in rows.columns]
    sure = tested.filter(~F.col("_hit")).select(*keep, F.lit(False).alias(out))
    possible = tested.filter("_hit").select(*keep)
    checked = possible.join(keys, key == F.col("_key"), "left").select(
        *keep, F.col("_key").isNotNull().alias(out)
    )
    return sure.unionByName(checked)


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    listed: DataFrame,
    listed_col: str = "url",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every page.

    The longest fitting rule decides; without one, a page is blocked if its canonical URL is
    that of a listed one, and allowed otherwise. A null URL, or one without ``://``, has empty
    host and path and is allowed, unless a rule or the list says otherwise. Repeated rows stay.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_canonical", canonical(F.col("host"), F.col("path")))
    listed_host, listed_path = host_and_path(F.col(listed_col))
    keys = listed.select(canonical(listed_host, listed_path).alias("_url")).filter("_url != ''")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = listed_among(rows, "_canonical", keys, "_url", "_listed")
    other = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, other).alias("verdict")
    )
