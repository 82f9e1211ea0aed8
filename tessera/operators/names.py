"""Near spellings as a join (Q2): rare pairs of letters as a prefix filter, lengths and places, then the exact ratio."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import written

#: Letters of a gram. Of two names 90 % alike with 4 letters or more, every pair has a gram of two letters in common.
Q = 2
#: Names that share a gram beyond so many are dealt to several tasks.
SHARE = 500


def _meet(a: DataFrame, b: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A join by sorting. Spark guesses a side by its files, not by the pieces that its names are cut into, and would broadcast
    through the driver what grows with the names."""
    return a.join(b.hint("merge"), on, how)


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, a word of bits for all of b at once."""
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << j)
    row = whole = (1 << len(b)) - 1
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & whole
    return len(b) - row.bit_count()


def _ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([200.0 * common_length(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b, strict=True)], dtype="float64")


def edits(size: Column, least: float) -> Column:
    """Insertions and deletions that a name of this length may be away from any name that is alike enough: of both lengths
    together at most 1 - least / 100, where the other is at most least / 100 : 2 - least / 100 longer."""
    r = least / 100
    return F.floor(size * ((1 - r) * (1 + (2 - r) / r)) + 1e-9).cast("int")


def _grams(df: DataFrame, name: str) -> DataFrame:
    """name, size, at, gram: pairs of letters of each distinct name in lower case, the n-th of its kind apart from the first.
    A name of one letter, or none, is a gram by itself."""
    n = df.select(F.lower(name).alias("name")).where("name is not null").distinct().withColumn("size", F.char_length("name"))
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.col("size") - (Q - 1), F.lit(1))), lambda i: F.substring(F.col("name"), i, F.lit(Q)))
    rows = n.select("name", "size", F.posexplode(pieces).alias("at", "piece"))
    lists = rows.groupBy("name", "size", "piece").agg(F.sort_array(F.collect_list("at")).alias("all"))  # the places of one piece in one name
    return lists.select("name", "size", "piece", F.posexplode("all").alias("nth", "at")).select("name", "size", "at", F.concat_ws("\x00", "piece", "nth").alias("gram"))


def _prefix(grams: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """Of each name its rarest grams in turn: as many as its edits can destroy, and one more."""
    ranked = _meet(grams, counts, "gram").groupBy("name", "size").agg(F.sort_array(F.collect_list(F.struct("n", "gram", "at"))).alias("all"))
    taken = F.slice("all", F.lit(1), F.greatest(edits(F.col("size"), least) * Q + 1, F.lit(1)))
    return ranked.select("name", "size", F.posexplode(taken).alias("turn", "g")).select("name", "size", "turn", "g.gram", "g.at", (F.col("g.n") / SHARE).cast("int").alias("parts"))


def near_names(asked: DataFrame, known: DataFrame, asked_name: str, known_name: str, least: float = 90.0) -> DataFrame:
    """asked, known, ratio: all pairs of distinct names, without regard to case, whose Indel ratio is ``least`` or more.

    ratio is 200 times the longest common subsequence over both lengths. If two names differ by d insertions and
    deletions, at most 2 d of a name's pairs of letters are gone, so among the 2 d + 1 rarest ones of each there is one
    that both have: names meet by these, d being what both lengths allow, not by trying all. Lengths and places may differ by d at most.
    ``least`` must be 90 or above, as shorter prefixes promise nothing below. Names that are null are left out; an
    empty name is like itself only.
    """
    if not 90 <= least <= 100:
        raise ValueError("least must be from 90 to 100")
    a, k = _grams(asked, asked_name), _grams(known, known_name)
    counts = a.unionAll(k).groupBy("gram").agg(F.count("*").alias("n"))
    left = _prefix(a, counts, least).select(F.col("name").alias("asked"), F.col("size").alias("n"), F.col("turn").alias("s"), "gram", F.col("at").alias("i"), F.pmod(F.xxhash64("name"), F.col("parts") + 1).alias("part"))
    right = _prefix(k, counts, least).select(F.col("name").alias("known"), F.col("size").alias("m"), F.col("turn").alias("t"), "gram", F.col("at").alias("j"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long"))).alias("part"))
    # lengths tell whether the edits are odd or even, so the last one may be out
    most = F.floor((F.col("n") + F.col("m")) * (1 - least / 100) + 1e-9)
    apart = (most - F.pmod(most - F.col("n") + F.col("m"), F.lit(2))).cast("int")
    close = (F.abs(F.col("n") - F.col("m")) <= apart) & (F.abs(F.col("i") - F.col("j")) <= apart) & (F.greatest("s", "t") <= Q * apart)
    pairs = _meet(left, right, ["gram", "part"]).where(close).select("asked", "known", apart.alias("apart"))
    # a replacement is a deletion and an insertion, so this distance (-1: beyond) is no more than theirs
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # pairs are few bytes but much work, so their tasks stay as many
    some = pairs.where(F.expr("levenshtein(asked, known, apart)") >= 0).repartition(tasks, "asked", "known").distinct()
    ratio = F.pandas_udf(_ratio, "double")
    return some.withColumn("ratio", ratio("asked", "known")).where(F.col("ratio") >= least).select("asked", "known", F.round("ratio", 6).alias("ratio"))


def _nearly(asked: DataFrame, known: DataFrame, asked_name: str, known_name: str) -> DataFrame:
    """asked, known, ratio: equal names, and those of which one lacks a letter of the other: a join by the whole name on
    one side and the name, or it with a letter out, on the other, so no letters that many names share are met."""
    whole = lambda df, c, name: df.select(F.lower(c).alias(name)).where(F.col(name).isNotNull()).distinct()
    a, k = whole(asked, asked_name, "asked"), whole(known, known_name, "known")

    def short(df: DataFrame, name: str) -> DataFrame:
        size, c = F.char_length(name), F.col(name)
        out = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, size)))
        return df.where(size > 0).select(name, F.explode(F.array_distinct(out)).alias("key"))

    equal = _meet(a, k, F.col("asked") == F.col("known"))
    less = _meet(short(a, "asked"), k, F.col("key") == F.col("known")).select("asked", "known")
    more = _meet(short(k, "known"), a, F.col("key") == F.col("asked")).select("asked", "known")
    n, m = F.char_length("asked"), F.char_length("known")
    ratio = F.when(F.col("asked") == F.col("known"), 100.0).otherwise(200.0 * F.least(n, m) / (n + m))
    return equal.unionAll(less).unionAll(more).withColumn("ratio", F.round(ratio, 6))


def closest(asked: DataFrame, known: DataFrame, asked_name: str, known_name: str, least: float = 90.0) -> DataFrame:
    """Q2: each asked name that is like a known one with the closest, the smallest by name if equal, as it is spelt there.

    With one letter too many or too few a ratio of 90 needs ten letters in all, and then no name with two edits is as
    close. So what ``_nearly`` finds is settled, and ``near_names`` tries the other names alone.
    """
    order = F.struct(-F.col("ratio"), F.col("known"))
    best = lambda df: df.groupBy("asked").agg(F.min_by("known", order).alias("_key"), F.max("ratio").alias("ratio"))
    mine = asked.select(F.col(asked_name).alias("name")).distinct().withColumn("asked", F.lower("name"))
    near, _ = written(best(_nearly(asked, known, asked_name, known_name).where(F.col("ratio") >= least)), "near")
    rest, _ = written(_meet(mine.where("asked is not null").select("asked").distinct(), near, "asked", "left_anti"), "rest")
    pairs = near if rest.isEmpty() else near.unionAll(best(near_names(rest, known, "asked", known_name, least)))
    spelt = known.groupBy(F.lower(known_name).alias("_key")).agg(F.min(known_name).alias("known"))
    return _meet(_meet(mine, pairs, "asked"), spelt, "_key").select(F.col("name").alias("asked"), "known", "ratio")
