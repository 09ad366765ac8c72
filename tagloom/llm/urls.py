"""URL filter: rules by host and path, and boosted trees on lexical features, trained on the URLs that rules label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import ascii_lower
from tagloom.session import written

ALLOW, BLOCK = "allow", "block"
# Suffixes and directories share this many rows of statistics by hash, so that their table has a fixed size.
BUCKETS = 1 << 14
# A labelled URL's statistics are those of the other folds, so that it does not see its own label.
FOLDS = 5
# Labels that a suffix seems to have before any is seen, at the overall rate.
PRIOR = 20.0
# The trees are fitted on about this many different labelled URLs, those with the smallest hash.
MAX_LABELLED = 16_000
TREES = 30
DEPTH = 4
STEP = 0.2
BINS = 128
SEED = 20240601
# Tasks that fit the trees: the sample has a fixed size.
FIT_TASKS = 4

# Statistics are kept for host suffixes of so many labels, and for the path's first directory.
SUFFIXES = (1, 2, 3)
LEXICAL = (
    "length", "host_length", "path_length", "query_length", "fragment_length", "host_labels", "depth", "longest_segment",
    "parameters", "digit_ratio", "letter_ratio", "host_digit_ratio", "hyphens", "escapes", "entropy", "host_entropy",
)
STATISTICS = tuple(f"{kind}_{name}" for name in ("suffix1", "suffix2", "suffix3", "directory") for kind in ("rate", "support"))
FEATURES = LEXICAL + STATISTICS


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    """A-Z lowered, up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; NULL if none does. A rule is a host, then a path that begins with a slash."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, judged in sorted(rules, key=lambda rule: len(rule[0])):
        cut = text.index("/")
        name, start = text[:cut], text[cut:]
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        found, verdict = F.when(fits, text).otherwise(found), F.when(fits, judged).otherwise(verdict)
    return found, verdict


def entropy(text: Column) -> Column:
    """Bits a character, from the characters' own counts; 0 for an empty text."""
    # Over the sorted characters: the run so far, and the sum of c * log2(c) over the runs before it.
    zero = F.struct(F.lit(None).cast("string").alias("seen"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))

    def closed(held: Column) -> Column:
        return held["total"] + F.when(held["run"] > 0, held["run"] * F.log2(held["run"])).otherwise(0.0)

    def step(held: Column, char: Column) -> Column:
        longer = F.struct(char.alias("seen"), (held["run"] + 1.0).alias("run"), held["total"].alias("total"))
        fresh = F.struct(char.alias("seen"), F.lit(1.0).alias("run"), closed(held).alias("total"))
        return F.when(held["seen"].eqNullSafe(char), longer).otherwise(fresh)

    chars = F.array_sort(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    n = F.char_length(text)
    return F.when(n > 0, F.log2(n) - F.aggregate(chars, zero, step, closed) / n).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(url: Column) -> dict[str, Column]:
    """Features of a URL's text; a NULL is empty. Ratios are per character, 0 for an empty text."""
    whole = F.coalesce(url, F.lit(""))
    name, way = host(url), path(url)
    query = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    fragment = F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^#]*#(.*)$", 1), F.lit(""))
    segments = F.filter(F.split(way, "/"), lambda x: x != "")
    length = lambda text: F.char_length(text).cast("double")
    share = lambda text, pattern: F.coalesce(F.try_divide(_count(text, pattern), length(text)), F.lit(0.0))
    return {
        "length": length(whole),
        "host_length": length(name),
        "path_length": length(way),
        "query_length": length(query),
        "fragment_length": length(fragment),
        "host_labels": F.when(name == "", 0.0).otherwise(F.size(F.split(name, r"\.")).cast("double")),
        "depth": F.size(segments).cast("double"),
        "longest_segment": F.coalesce(F.array_max(F.transform(segments, F.char_length)), F.lit(0)).cast("double"),
        "parameters": F.size(F.filter(F.split(query, "[&;]"), lambda x: x != "")).cast("double"),
        "digit_ratio": share(whole, "[0-9]"),
        "letter_ratio": share(whole, "[A-Za-z]"),
        "host_digit_ratio": share(name, "[0-9]"),
        "hyphens": _count(name, "-"),
        "escapes": _count(whole, "%"),
        "entropy": entropy(whole),
        "host_entropy": entropy(name),
    }


def _places(url: Column) -> list[Column]:
    """Rows of the statistics that a URL belongs to: its host's suffixes and its path's first directory."""
    name = host(url)
    directory = F.regexp_extract(path(url), "^/*([^/]*)", 1)
    kinds = [(f"suffix{n}", F.substring_index(name, ".", -n)) for n in SUFFIXES] + [("directory", directory)]
    return [F.pmod(F.xxhash64(F.lit(kind), text), F.lit(BUCKETS)).cast("int") for kind, text in kinds]


def _hash(url: Column) -> Column:
    return F.xxhash64(url)


@dataclass
class UrlFilter:
    """Rules, suffix statistics by bucket, and the trees; without trees (no labels of both kinds) one verdict for all."""

    rules: tuple[tuple[str, str], ...]
    statistics: DataFrame
    overall: float
    trees: GBTClassificationModel | None
    otherwise: str


def _labelled(pages: DataFrame, url: str, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    rows = pages.select(F.col(url).alias("url"))
    _, verdict = rule_of(host(F.col("url")), path(F.col("url")), rules)
    rows = rows.select("url", verdict.alias("verdict")).filter("verdict IS NOT NULL")
    fold = F.pmod(F.shiftright(_hash(F.col("url")), 20), F.lit(FOLDS)).cast("int")
    return rows.select("url", (F.col("verdict") == BLOCK).cast("int").alias("blocked"), fold.alias("fold"))


def _statistics(labelled: DataFrame) -> DataFrame:
    """(bucket, seen, blocked): labelled rows and blocked ones by fold, over all labelled rows; at most ``BUCKETS`` rows."""
    rows = labelled.select("blocked", "fold", F.explode(F.array(*_places(F.col("url")))).alias("bucket"))
    seen = [F.count(F.when(F.col("fold") == n, 1)) for n in range(FOLDS)]
    blocked = [F.count(F.when((F.col("fold") == n) & (F.col("blocked") == 1), 1)) for n in range(FOLDS)]
    return rows.groupBy("bucket").agg(F.array(*seen).alias("seen"), F.array(*blocked).alias("blocked"))


def _features(rows: DataFrame, statistics: DataFrame, overall: float, fold: Column | None) -> DataFrame:
    """``rows`` (with ``url``) and the columns ``FEATURES``; without the statistics of the row's own ``fold``, if it has one."""
    found = rows.select("*", F.struct(*[c.alias(n) for n, c in lexical(F.col("url")).items()]).alias("_lexical"))
    names = [name.removeprefix("rate_") for name in STATISTICS if name.startswith("rate_")]
    for name, place in zip(names, _places(F.col("url"))):
        # The statistics have a fixed number of rows.
        table = F.broadcast(statistics.select(F.col("bucket").alias(f"_{name}"), F.col("seen").alias(f"_seen_{name}"), F.col("blocked").alias(f"_blocked_{name}")))
        found = found.withColumn("_place", place).join(table, F.col("_place") == F.col(f"_{name}"), "left").drop("_place")

    def total(column: str) -> Column:
        whole = F.aggregate(column, F.lit(0).cast("long"), lambda a, b: a + b)
        own = F.lit(0) if fold is None else F.element_at(column, fold + 1)
        return F.coalesce(whole - own, F.lit(0)).cast("double")

    columns = [F.col("_lexical")[name].alias(name) for name in LEXICAL]
    for name in names:
        seen, blocked = total(f"_seen_{name}"), total(f"_blocked_{name}")
        columns += [((blocked + PRIOR * overall) / (seen + PRIOR)).alias(f"rate_{name}"), F.log1p(seen).alias(f"support_{name}")]
    return found.select(*rows.columns, *columns)


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def fit(pages: DataFrame, rules: tuple[tuple[str, str], ...], url: str = "url", max_labelled: int = MAX_LABELLED) -> UrlFilter:
    """A filter from the URLs that a rule fits; the rule's verdict is the label.

    Statistics of suffixes and directories cover all labelled rows. The trees are fitted on about ``max_labelled``
    different labelled URLs, those whose hash falls below a bound, with each one's statistics taken from the other folds.
    """
    labelled = _labelled(pages, url, rules)
    statistics = written(_statistics(labelled), "url-statistics")
    rows, blocked, different = labelled.agg(
        F.count(F.lit(1)), F.sum("blocked"), F.approx_count_distinct("url", 0.02)
    ).first()
    if not rows or blocked in (0, rows):
        return UrlFilter(rules, statistics, 0.0, None, BLOCK if rows and blocked else ALLOW)
    overall = blocked / rows
    share = min(1.0, max_labelled / different)
    sample = labelled.filter(F.pmod(_hash(F.col("url")), F.lit(1 << 20)) < F.lit(round(share * (1 << 20)))).distinct()
    known = _features(sample, statistics, overall, F.col("fold"))
    known = written(known.select(F.col("blocked").cast("double").alias("blocked"), *FEATURES), "url-sample")
    trees = GBTClassifier(
        labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=BINS, minInstancesPerNode=5, seed=SEED
    ).fit(_assembled(known.coalesce(FIT_TASKS)))
    return UrlFilter(rules, statistics, overall, trees, ALLOW)


def judge(pages: DataFrame, fitted: UrlFilter, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, score) of every row: the rule's verdict, else that of the trees.

    ``score`` is the trees' probability that the URL is to be blocked (NULL
    without trees, where unruled URLs get the only verdict known, else
    ``allow``). A URL that is NULL or without ``://`` has an empty host and path
    and is judged by the trees. Rows are judged one by one where they are, so
    repeated rows and NULL keys keep a row each; other columns are ignored.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    score = F.lit(None).cast("double")
    if fitted.trees is not None:
        rows = fitted.trees.transform(_assembled(_features(rows, fitted.statistics, fitted.overall, None)))
        score = F.element_at(vector_to_array("probability"), 2)
    name, way = host(F.col("url")), path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), fitted.rules)
    judged = F.when(F.col("score") > 0.5, BLOCK).when(F.col("score").isNotNull(), ALLOW).otherwise(fitted.otherwise)
    found = rows.select("key", name.alias("host"), way.alias("path"), score.alias("score"))
    return found.select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, judged).alias("verdict"), "score"
    )
