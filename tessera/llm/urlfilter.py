"""URL rules by host and path prefix, by a sort-merge range join. DataFrame functions throughout."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.linededup import LOWER, UPPER

#: Fixed rules of the query: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
URL = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


#: What closes a label, opens the path and stands for a zero byte of a host in canonical keys.
END, PATH, ZERO = "\x00\x00", "\x00\x01", "\x00\x02"


def labels(host: Column) -> Column:
    """The host's labels from right to left."""
    return F.reverse(F.split(F.replace(host, F.lit("\x00"), F.lit(ZERO)), r"\.", -1))


def canonical(names: Column, path: Column) -> Column:
    """One key for a host (its labels from right to left) and a path: the rules of a host whose paths are prefixes of a
    path are those whose keys are prefixes of its key, so each rule is an interval of keys, and intervals nest or are apart."""
    return F.concat(F.array_join(names, END), F.lit(END + PATH), path)


def openings(rules: DataFrame) -> DataFrame:
    """key, stack: where an interval opens, and the rules active there: its own and those that enclose it.

    Intervals nest or are apart. So a sweep's stack at any key is found in the stack of the last interval that opened
    before it: rules whose interval has closed since are those that the key does not start with. A stack is as deep as
    paths of one host nest, however many rules the host has.
    """
    own = rules.select("verdict", "host", "path").distinct().withColumn("names", labels(F.col("host")))
    entry = F.struct(canonical(F.col("names"), F.col("path")).alias("key"), "host", "path", "verdict")
    at = own.groupBy(canonical(F.col("names"), F.col("path")).alias("outer")).agg(F.collect_list(entry).alias("rules"))
    prefixes = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: canonical(F.col("names"), F.substring(F.col("path"), F.lit(1), n)))
    within = own.select(canonical(F.col("names"), F.col("path")).alias("key"), F.explode(prefixes).alias("outer")).distinct()
    return within.join(at, "outer").groupBy("key").agg(F.flatten(F.collect_list("rules")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", sweeps: int | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for each URL; the longest fitting rule (host and path) decides, then the longer host.

    Canonical keys turn rules into intervals. A URL looks for the rules of its host and of each domain above it that has as
    many labels as the host of some rule, so it has a key for each of these; the numbers of labels that rules' hosts have
    come to the driver. Keys are dealt over ``sweeps`` sorted sweeps (by default as many as shuffle partitions, 64 at least)
    by a hash of the row, so a host with a third of all URLs is spread over all of them; the openings of intervals, which
    are as many as there are rules, go into each. A sweep hands every key the stack of the last opening before it; of
    the rules that have not closed since, the deepest is the best for that domain. The domains' best meet by row.

    Null URLs and those without ``://`` have an empty host and path, fit no rule and take ``default``. A repeated row
    comes back each time. Empty tables are allowed on both sides. Further columns are ignored.
    """
    sweeps = sweeps or max(64, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    row = ["page_id", "host", "path"]
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).withColumn("names", labels(F.col("host")))
    sizes = sorted({1} | {r.n for r in rules.select(F.size(labels(F.col("host"))).alias("n")).distinct().collect() if r.n and r.n > 0})
    depths = F.filter(F.array(*map(F.lit, sizes)), lambda n: n <= F.size("names"))
    keys = F.transform(depths, lambda n: canonical(F.slice("names", F.lit(1), n), F.col("path")))
    asked = urls.select(*row, F.size(depths).alias("domains"), F.explode(keys).alias("key")).withColumn("sweep", F.pmod(F.xxhash64(*row), F.lit(sweeps)))
    opened = openings(rules).withColumn("sweep", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sweeps - 1).cast("long"))))
    none = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in (*row, "domains")]
    events = asked.select("sweep", "key", F.lit(1).alias("kind"), *row, "domains", F.lit(None).cast(opened.schema["stack"].dataType).alias("stack")).unionByName(
        opened.select("sweep", "key", F.lit(0).alias("kind"), *none, "stack")
    )
    order = Window.partitionBy("sweep").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("stack", F.last("stack", ignorenulls=True).over(order)).where("kind = 1")
    active = F.filter("stack", lambda r: F.startswith(F.col("key"), r.key))
    best = F.array_max(F.transform(active, lambda r: F.struct((F.length(r.host) + F.length(r.path)).alias("size"), F.length(r.host).alias("host_size"), r.host.alias("host"), r.path.alias("path"), r.verdict.alias("verdict"))))
    met = swept.select(*row, "domains", best.alias("best")).groupBy(*row).agg(F.max("best").alias("best"), (F.count("*") / F.first("domains")).cast("int").alias("copies"))
    out = met.select(*row, F.concat("best.host", "best.path").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"), F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.drop("col")
