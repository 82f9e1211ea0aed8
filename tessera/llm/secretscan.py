"""Secrets in texts, by regular expressions behind a trigram index. DataFrame functions throughout."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.linededup import LOWER, UPPER
from tessera.sources.scratch import written


@dataclass(frozen=True)
class Rule:
    """A kind of secret. group: whose length must be at least ``least``; a shorter match is consumed and dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    base: bool = True

    @property
    def regex(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


#: Fixed patterns of the query. Runs of one class are greedy, so a least length inside the pattern finds the same matches there.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds that the method adds.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, base=False),
    Rule("live", r"sk_live_[A-Za-z0-9]{20,}", base=False),
)


def alternatives(pattern: str) -> list[list[str]]:
    """Alternatives of literal runs, at least one of which is whole in any match: read off Python's parse of the regex.

    An alternative is a list of runs that all occur. Sub-patterns that can be left out end a run; a branch or an
    optional part yields alternatives only while they are few, else the part says nothing.
    """
    from re import _constants as C
    from re import _parser

    def walk(items) -> list[list[str]]:
        """Runs are kept with open ends marked by a zero in between parts that need not touch."""
        found: list[list[str]] = [[""]]

        def extend(more: list[list[str]]) -> None:
            nonlocal found
            if len(found) * len(more) > 16:
                for x in found:
                    x.append("")
                return
            found = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in found for b in more]

        for op, arg in items:
            if op is C.LITERAL:
                extend([[chr(arg)]])
            elif op is C.SUBPATTERN:
                extend(walk(arg[3]))
            elif op is C.BRANCH:
                extend([y for x in arg[1] for y in walk(x)])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                low, high, inner = arg
                if (low, high) == (0, 1) and len(inner) == 1 and inner[0][0] is C.LITERAL:
                    extend([[""], [chr(inner[0][1])]])
                elif low:
                    once = walk(inner)
                    extend([[*x, ""] if (low, high) != (1, 1) else x for x in once] if len(once) <= 4 else [["", ""]])
                else:
                    extend([["", ""]])
            elif op is not C.AT:
                extend([["", ""]])
        return found

    return [[x for x in runs if x] for runs in walk(_parser.parse(pattern.replace("(?i)", "")))]


def trigram_query(rule: Rule) -> list[frozenset[str]] | None:
    """Sets of lower-case trigrams; any match holds all of one set. None: a match needs no trigram."""
    sets = []
    for runs in alternatives(rule.pattern):
        grams = {r[i : i + 3].translate(str.maketrans(UPPER, LOWER)) for r in runs for i in range(len(r) - 2) if r.isascii()}
        if not grams:
            return None
        sets.append(frozenset(grams))
    return list(dict.fromkeys(sets))


def postings(base: DataFrame, grams: list[str]) -> DataFrame:
    """gram, row: the inverted index of the trigrams that rules ask for."""
    folded = F.translate("text", UPPER, LOWER)
    held = F.filter(F.array(*(F.when(F.contains(F.col("folded"), F.lit(g)), F.lit(i)) for i, g in enumerate(grams))), lambda x: x.isNotNull())
    return base.select("row", folded.alias("folded")).select("row", F.explode(held).alias("gram"))


def _spans(rule: Rule) -> Column:
    """Spans of a rule's matches in column text: between matches lie the pieces of a split, so lengths add up to places."""
    pieces = F.split("text", rule.regex, -1)
    whole = F.regexp_extract_all("text", F.lit(rule.regex), F.lit(0))
    part = F.regexp_extract_all("text", F.lit(rule.regex), F.lit(rule.group))
    zipped = F.arrays_zip(F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(whole), F.lit(0))), F.char_length).alias("gap"), F.transform(whole, F.char_length).alias("size"), F.transform(part, F.char_length).alias("part"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc.at + x.gap
        end = start + x.size
        spans = F.when(x.part >= rule.least, F.concat(acc.spans, F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc.spans)
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc.spans)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: array of (start, end, rank, kind) of each document's secrets, by start, then in the rules' order.

    Offsets are in code points, the end exclusive. Each rule's Boolean trigram query picks its candidates from the
    index; only they are searched for the rule's matches. Rules that need no trigram search every text.

    Postings are at most one row a document and trigram, so a trigram in all documents is no hot key: the lists are
    intersected by document; what they come to is written to the shared folder. Null texts count as empty; repeated rows each come back, as does a null doc_id. An empty
    table gives an empty result, and further columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    asked = {rule.kind: trigram_query(rule) for rule in rules}
    grams = sorted({g for sets in asked.values() for s in sets or [] for g in s})
    number = {g: i for i, g in enumerate(grams)}
    if grams:
        held = postings(base, grams).groupBy("row").agg(F.collect_set("gram").alias("held"))
        test = {k: None if sets is None else _any([_all([F.array_contains("held", number[g]) for g in sorted(s)]) for s in sets]) for k, sets in asked.items()}
        fits = held.select("row", F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in test.items() if c is not None)), lambda x: x.isNotNull()).alias("fits")).where(F.size("fits") > 0)
        # written, so that Spark knows its size: if that is within its limit for broadcasts, no text is shuffled to meet it
        fits, _ = written(fits, "secret-fits")
        base = base.join(fits, "row", "left")
    else:
        base = base.withColumn("fits", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string>>")
    all_spans = []
    for rank, rule in enumerate(rules):
        marked = F.transform(_spans(rule), _mark(rank, rule.kind))
        spans = F.when(F.col("text").rlike(rule.regex), marked).otherwise(none)
        all_spans.append(spans if asked[rule.kind] is None else F.when(F.array_contains("fits", rule.kind), spans).otherwise(none))
    return base.select("doc_id", F.array_sort(F.concat(*all_spans)).alias("spans"))


def _mark(rank: int, kind: str):
    return lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"))


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for x in parts[1:]:
        out = out & x
    return out


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for x in parts[1:]:
        out = out | x
    return out


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


