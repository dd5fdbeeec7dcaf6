"""URL filter: host-suffix and path-prefix expressions joined to rules by short hashes.

Each different URL is expanded into the expressions (a suffix of its host at a
label boundary, a prefix of its path) that some rule could have: only as many
labels and as many path characters as occur among the rules. The first four
bytes of an expression's SHA-256 are joined to those of the rules; the full
digest then confirms the rule. Of the confirmed rules the longest wins (host and
path together), then the longer host, then ``block``.

Defined cases: a null URL, or one without ``://``, has an empty host and path and
no rule; so has any other row whose host no rule fits. Without a rule the verdict
is ``default``. Repeated rows and repeated ids are judged one by one. An empty
table gives an empty result; an empty rule table gives ``default`` everywhere.
Only the two named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tagweave.storage import literal_rows

#: Fixed rules of the registered query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    host, path, verdict = map(list, zip(*rules, strict=True))
    return literal_rows(spark, {"host": host, "path": path, "verdict": verdict})


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def prepared(rules: DataFrame) -> DataFrame:
    """Rules with their digests, one row for each host and path."""
    rules = rules.select("host", "path", "verdict").filter("host is not null and path is not null")
    rules = rules.groupBy("host", "path").agg(F.min(F.when(F.col("verdict") == "block", 0).otherwise(1)).alias("v"))
    digest = F.sha2(F.concat("host", "path"), 256)
    return rules.select(
        digest.alias("digest"),
        digest.substr(1, 8).alias("short"),
        F.length(F.concat("host", "path")).alias("size"),
        F.length("host").alias("host_size"),
        F.length("path").alias("path_size"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.concat("host", "path").alias("rule"),
        F.when(F.col("v") == 0, "block").otherwise("allow").alias("verdict"),
    )


def judge(
    urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per input row: ``id, host, path, rule, verdict``; ``rule`` is null without one."""
    rules = prepared(rules)
    # Distinct small integers: label counts and path lengths that rules have.
    shape = rules.agg(F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("path_size")).alias("sizes")).first()
    rows = urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    places = rows.select("host", "path").distinct()
    if shape.labels:
        ints = lambda xs: F.array(*[F.lit(int(x)) for x in xs])
        hosts = F.transform(
            F.filter(ints(shape.labels), lambda n: n <= F.size(F.split("host", r"\."))),
            lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n),
        )
        paths = F.transform(
            F.filter(ints(shape.sizes), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
        )
        said = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.sha2(F.concat(h, p), 256))))
        tried = places.select("host", "path", F.explode(F.array_distinct(said)).alias("tried"))
        hits = tried.join(rules, F.col("tried").substr(1, 8) == F.col("short")).filter("tried = digest")
        order = F.struct("size", "host_size", (F.col("verdict") == "block").alias("blocks"), "rule", "verdict")
        best = hits.groupBy("host", "path").agg(F.max(order).alias("best"))
        best = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
        rows = rows.join(best, ["host", "path"], "left")
    else:
        rows = rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    return rows.select("id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
