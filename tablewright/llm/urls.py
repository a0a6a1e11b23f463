"""Operator 4: URL filter. Rules decide first; gradient-boosted trees on lexical
features judge the urls that no rule fits.

A rule is a host and a path. It fits its host and all subdomains if the url's
path starts with the rule's; the longest fitting rule wins. The trees learn from
labelled urls: by default those that a rule decides. The training sample is the
``SAMPLE`` distinct labelled urls with the smallest hash. Features: lengths, depth,
digit ratio, entropy, parameter and subdomain counts, and statistics of the host's
suffixes and of the first path part (how often blocked, how frequent) from all
labelled rows; their tables are broadcast if they are counted as small.

Cases: a null url, or one without ``://``, has an empty host and path and is
judged by the trees; with labels of one kind only, that kind is the verdict,
without labels it is allow. Repeated rows give a row each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import lower_ascii, written

SAMPLE, TREES, DEPTH = 20_000, 20, 4
SMOOTHING = 10.0
#: Largest table of suffixes that is broadcast: rows, and bytes of its keys.
BROADCAST_ROWS, BROADCAST_BYTES = 20_000, 2_000_000

Rule = tuple[str, str, str]  # verdict, host, path


def parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` with host (A-Z lower-cased) and path."""
    after = F.when(F.instr(url_col, "://") > 0, F.substr(url_col, F.instr(url_col, "://") + 3))
    rest = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return df.withColumn("host", lower_ascii(host)).withColumn("path", F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def matching_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """struct<rule, verdict> of the longest fitting rule, or null. The list is a
    parameter of the filter and becomes one expression per rule."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _features(df: DataFrame, url_col: str) -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    size = F.char_length(url)
    chars = F.array_distinct(F.split(url, ""))
    share = lambda c: (size - F.char_length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    many = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    return df.select(
        "*", size.cast("double").alias("f_length"), F.char_length("host").cast("double").alias("f_host"),
        F.char_length("path").cast("double").alias("f_path"), many(F.col("path"), "/[^/]").alias("f_depth"),
        F.when(size > 0, many(url, "[0-9]") / size).otherwise(0.0).alias("f_digits"), F.coalesce(entropy, F.lit(0.0)).alias("f_entropy"),
        many(query, "[^&]+").alias("f_parameters"), many(F.col("host"), r"\.").alias("f_dots"),
        many(url, "[^A-Za-z0-9]").alias("f_signs"), F.contains(url, F.lit("#")).cast("double").alias("f_fragment"),
        F.startswith(url, F.lit("https:")).cast("double").alias("f_secure"),
        many(F.col("path"), r"\.[a-z0-9]{1,5}$").alias("f_extension"))


def _suffixes(df: DataFrame) -> DataFrame:
    labels = F.split("host", r"\.")
    return df.select(
        "*", F.element_at(labels, -1).alias("s_last"), F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)).alias("s_two"),
        F.regexp_extract("path", "^/([^/]*)", 1).alias("s_first"))


SUFFIXES = ("s_last", "s_two", "s_first")


def judge(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", labelled: DataFrame | None = None) -> DataFrame:
    """id, host, path, rule (null where none fits), verdict. ``labelled`` has a
    url column and ``verdict``; by default the rules label the urls of ``df``."""
    base = parts(df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))).withColumn(
        "_found", matching_rule(rules, F.col("host"), F.col("path")))
    if labelled is None:
        labels = base.where("_found is not null").select("url", "host", "path", F.col("_found.verdict").alias("verdict"))
    else:
        labels = parts(labelled.select(F.col(url_col).alias("url"), "verdict")).where("verdict is not null")
    labels = labels.withColumn("label", (F.col("verdict") == "block").cast("double"))
    known = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
    rows = _suffixes(_features(base, "url"))
    if len(known) < 2:
        other = "block" if known.get(1.0) else "allow"
        verdict = rows.withColumn("_other", F.lit(other))
    else:
        overall = known[1.0] / sum(known.values())
        distinct = labels.select("url", "host", "path", "label").distinct()
        sample = distinct.orderBy(F.xxhash64("url"), "url", "label").limit(SAMPLE)
        sample = written(_suffixes(_features(sample, "url")), "labelled-urls")
        columns = [c for c in sample.columns if c.startswith("f_")]
        marked = _suffixes(labels.select("host", "path", "label"))
        for s in SUFFIXES:
            stats = marked.groupBy(s).agg(F.sum("label").alias("b"), F.count("*").alias("n")).select(
                F.col(s).alias("_key"), ((F.col("b") + SMOOTHING * overall) / (F.col("n") + SMOOTHING)).alias(f"{s}_rate"),
                F.log1p("n").alias(f"{s}_count"))
            stats = written(stats, f"suffix-{s}")
            many, size = stats.agg(F.count("*"), F.sum(F.octet_length("_key"))).first()
            stats = F.broadcast(stats) if many <= BROADCAST_ROWS and size <= BROADCAST_BYTES else stats.hint("merge")

            def add(d: DataFrame) -> DataFrame:
                return d.join(stats, F.col(s) == F.col("_key"), "left").drop("_key").fillna({f"{s}_rate": overall, f"{s}_count": 0.0})

            sample, rows = add(sample), add(rows)
            columns += [f"{s}_rate", f"{s}_count"]
        sample = sample.coalesce(4).sortWithinPartitions("url", "label")
        assembler = VectorAssembler(inputCols=columns, outputCol="_x")
        trees = GBTClassifier(featuresCol="_x", labelCol="label", predictionCol="_p", maxIter=TREES, maxDepth=DEPTH, seed=7)
        model = trees.fit(assembler.transform(sample).select("_x", "label"))
        verdict = model.transform(assembler.transform(rows)).withColumn("_other", F.when(F.col("_p") == 1.0, "block").otherwise("allow"))
    return verdict.select(F.col("id").alias(id_col), "host", "path", F.col("_found.rule").alias("rule"),
                          F.coalesce(F.col("_found.verdict"), F.col("_other")).alias("verdict"))
