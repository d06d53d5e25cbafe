"""URL filters by host-suffix and path-prefix expressions.

Every URL is expanded into the expressions host suffix + "/" + path prefix that
a rule could have: suffixes start at label borders, with as many labels as some
rule's host has; prefixes have the length of some rule's path. (Other
expressions equal no rule, so nothing is lost, and a URL makes at most
#label counts x #path lengths expressions.) Expressions and rules are equi-joined
on the first ``prefix_hex`` hex digits of their SHA-256; the full digest and the
expression itself confirm a match, and the longest rule decides.

URLs are judged once per distinct URL: a URL, or a host, on a third of all rows
is one row of the join, and its verdict is joined back to the rows. The rule table
may be of any size; Spark broadcasts it only if it is small.

Defined cases: a null URL, or one without ``://``, has an empty host and path and
no rule; URLs without a rule get ``default``; of equally long fitting rules (the
same expression twice) a block wins; an empty rule table gives ``default``
everywhere. Output columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows (verdict, host, path)."""
    listed = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules])
    return spark.range(1).select(F.inline(listed if rules else listed.cast("array<struct<verdict:string,host:string,path:string>>")))


def url_parts(url):
    """(host, path) columns: A-Z of the host in lower case, query and fragment cut."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", prefix_hex: int = 8, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (host + path of the deciding rule, or null) and verdict."""
    listed = (rules.select("host", "path", F.lower("verdict").alias("verdict")).dropna()
              .withColumn("expression", F.concat("host", "path"))
              # host and path apart: "a.b" + "/c" is not the rule "a" + ".b/c"
              .withColumn("digest", F.sha2(F.concat_ws("\n", "host", "path"), 256))
              .withColumn("prefix", F.substring("digest", 1, prefix_hex)))
    shape = listed.agg(F.collect_set(F.size(F.split("host", "\\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])

    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(url_col).alias("_url")).distinct()
    host_u, path_u = url_parts(F.col("_url"))
    urls = urls.select("_url", host_u.alias("h"), path_u.alias("p")).filter("h != ''")
    n_labels = F.size(F.split("h", "\\."))
    suffixes = F.array_compact(F.array(*[F.when(n_labels >= n, F.substring_index("h", ".", -n)) for n in labels] or [F.lit(None).cast("string")]))
    prefixes = F.array_compact(F.array(*[F.when(F.length("p") >= n, F.substring("p", 1, n) if n else F.lit("")) for n in lengths] or [F.lit(None).cast("string")]))
    asked = (urls.select("_url", F.explode(suffixes).alias("hs"), prefixes.alias("pp"))
             .select("_url", "hs", F.explode("pp").alias("ps"))
             .withColumn("d", F.sha2(F.concat_ws("\n", "hs", "ps"), 256))
             .select("_url", "hs", "ps", "d", F.substring("d", 1, prefix_hex).alias("prefix")))
    fits = (asked.join(listed, "prefix")
            .filter((F.col("d") == F.col("digest")) & (F.col("hs") == F.col("host")) & (F.col("ps") == F.col("path"))))
    # the longest rule first; "block" sorts after "allow"
    best = fits.groupBy("_url").agg(F.max(F.struct(F.length("expression").alias("n"), "verdict", "expression")).alias("best"))
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    # input columns ride in a struct, so that none can clash with those used here
    out = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(url_col).alias("_asked"), host.alias("_host"), path.alias("_path"))
    out = out.join(best, F.col("_asked") == F.col("_url"), "left")
    return out.select(*[F.col("_row").getField(c).alias(c) for c in keep], F.col("_host").alias("host"), F.col("_path").alias("path"),
                      F.col("best.expression").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
