"""Verdicts on URLs by rules of host and path, found through hashes of the URL's expressions.

A rule (host, path, verdict) fits a host and all its subdomains, if the URL's path starts with
the rule's. Its expression is its host and its path up to the last slash. Every URL is expanded
into its host suffixes (at the dots) times its path prefixes (at the slashes); as many labels and
slashes as the longest rule has are enough, so long URLs give no more expressions than that.
Expressions meet rules by the first 32 bits of their SHA-256; of those that meet, the whole digest
and the start of the path are compared. Of the rules that fit, that with the longest host and
path wins, then the longer path, then blocking.

Rules are sent to all tasks if there are at most ``most_broadcast`` of them, else both sides are
shuffled by the short hash, each rule in ``salts`` copies, so that an expression that most URLs
have is spread. Results are the same.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
there up to ``?``, ``#`` or the end. A null URL, or one without ``://``, has empty both; no rule
fits an empty host. A rule without a host is not used; its null path is empty. URLs that no rule
fits get ``otherwise``. A null id stays null, repeated rows are each kept; an empty table gives
no rows, an empty list of rules gives every row ``otherwise``. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii

RULES = "host string, path string, verdict string"
BLOCK, ALLOW = "block", "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def _suffixes(host: Column, most: int) -> Column:
    """The last 1 to ``most`` labels of a host, and the host if it has no more."""
    labels = F.slice(F.reverse(F.split(host, r"\.")), 1, most)
    numbers = F.sequence(F.lit(1), F.size(labels))
    return F.transform(numbers, lambda n: F.array_join(F.reverse(F.slice(labels, F.lit(1), n)), "."))


def _prefixes(path: Column, most: int) -> Column:
    """The empty path, and the path up to each of its first ``most`` slashes."""
    if most == 0:
        return F.array(F.lit(""))
    parts = F.split(path, "/", most + 1)
    numbers = F.sequence(F.lit(0), F.size(parts) - 1)
    return F.transform(
        numbers,
        lambda n: F.when(n == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/"))
        ),
    )


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def prepared(rules: DataFrame) -> DataFrame:
    """(short, digest, rule_path, weight) of each rule; ``weight`` orders rules and says all.

    It holds the lengths of host and path together, of the path, and whether the rule blocks:
    the rule's text follows from it and any URL the rule fits.
    """
    host, path = lower_ascii(F.col("host")), F.coalesce("path", F.lit(""))
    lengths = F.char_length(host) + F.char_length(path), F.char_length(path)
    return rules.where(F.col("host") != "").select(
        host.alias("rule_host"),
        path.alias("rule_path"),
        F.regexp_extract(path, r"(?s)^.*/", 0).alias("anchor"),
        (
            F.shiftleft(lengths[0].cast("long"), 32)
            + F.shiftleft(lengths[1].cast("long"), 1)
            + (F.col("verdict") == BLOCK).cast("long")
        ).alias("weight"),
    )


def judge(
    urls: DataFrame,
    rules: DataFrame,
    *,
    otherwise: str = ALLOW,
    id_column: str = "page_id",
    url_column: str = "url",
    most_broadcast: int = 200_000,
    salts: int = 64,
) -> DataFrame:
    """(id, host, path, rule, verdict) per row of ``urls``."""
    listed = prepared(rules)
    slashes = F.char_length("anchor") - F.char_length(F.replace("anchor", F.lit("/")))
    bounds = listed.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.max(slashes).alias("slashes"),
    ).first()

    host, path = host_and_path(F.col("url"))
    rows = urls.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url")).select(
        F.monotonically_increasing_id().alias("row"), "id", host.alias("host"), path.alias("path")
    )
    digest = _digest(F.col("rule_host"), F.col("anchor"))
    hashed = listed.select(_short(digest).alias("short"), digest.alias("digest"), "rule_path", "weight")
    expanded = rows.withColumn("suffix", F.explode(_suffixes(F.col("host"), bounds.labels or 1))).withColumn(
        "prefix", F.explode(_prefixes(F.col("path"), bounds.slashes or 0))
    )
    found = _digest(F.col("suffix"), F.col("prefix"))
    looked_up = expanded.select("row", "id", "host", "path", found.alias("expression")).withColumn(
        "short", _short(F.col("expression"))
    )
    if bounds.n <= most_broadcast:
        met = looked_up.join(F.broadcast(hashed), "short", "left")
    else:
        salt = F.pmod(F.col("row"), F.lit(salts)).cast("int")
        copies = hashed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = looked_up.withColumn("salt", salt).join(copies, ["short", "salt"], "left")
    fits = (
        (F.col("host") != "")
        & (F.col("digest") == F.col("expression"))
        & F.startswith(F.col("path"), F.col("rule_path"))
    )
    # Expressions of a row are together in one task, so the sums below are nearly whole before
    # the shuffle: one row per URL goes through it.
    best = met.groupBy("row", "id", "host", "path").agg(F.max(F.when(fits, F.col("weight"))).alias("weight"))
    both = F.shiftright("weight", 32).cast("int")
    of_path = F.shiftright("weight", 1).bitwiseAND((1 << 31) - 1).cast("int")
    of_host = both - of_path
    rule = F.concat(
        F.substr("host", F.char_length("host") - of_host + 1, of_host), F.substr("path", F.lit(1), of_path)
    )
    blocks = F.when(F.col("weight").bitwiseAND(1) == 1, BLOCK).otherwise(ALLOW)
    verdict = F.when(F.col("weight").isNull(), otherwise).otherwise(blocks)
    return best.select("id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
