"""Names, canonical keys and scalar rules of the cohort (P rows of the inventory)."""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXTENSION = r"\.[A-Za-z0-9]{1,5}$"
#: Fixed vocabulary of malignancy flags.
TRUE_WORDS = ("true", "t", "yes", "y", "1", "malignant", "1.0")
FALSE_WORDS = ("false", "f", "no", "n", "0", "non-malignant", "non malignant", "nonmalignant", "benign", "0.0")
#: Fixed patterns of a growth grade, in the order that settles ties.
PATTERNS = ("lepidic", "papillary", "acinar", "cribriform", "micropapillary", "solid")
HIGH_GRADE = ("cribriform", "micropapillary", "solid")


def make_slide_tile(slide: Column, tile: Column) -> Column:
    """P1."""
    return F.concat_ws("_", F.upper(F.trim(slide)), F.upper(F.trim(tile)))


def normalize_tile(tile: Column, extension: str = ".jpeg") -> Column:
    """Names without an extension get one."""
    return F.when(F.trim(tile).rlike(EXTENSION), F.trim(tile)).otherwise(F.concat(F.trim(tile), F.lit(extension)))


def tile_name_verdict(df: DataFrame, tile: str = "tiles") -> DataFrame:
    """Whether all names have an extension (done), none (short) or some (mixed)."""
    done = F.count_if(F.col(tile).rlike(EXTENSION))
    return df.agg(F.when(done == F.count("*"), "done").when(done == 0, "short").otherwise("mixed").alias("verdict"), done.alias("n_done"), F.count("*").alias("n"))


def sample_from_slide(slide: Column) -> Column:
    """Up to the first space."""
    return F.split(slide, " ")[0]


def tcga_sample(slide: Column) -> Column:
    """The first three parts."""
    return F.substring_index(slide, "-", 3)


def tcga_site(slide: Column) -> Column:
    """The second part."""
    return F.get(F.split(slide, "-"), F.lit(1))


def tile_xy(tile: Column) -> tuple[Column, Column]:
    """P5."""
    pattern = r"^(\d+)_(\d+)"
    return F.regexp_extract(tile, pattern, 1).try_cast("int"), F.regexp_extract(tile, pattern, 2).try_cast("int")


def grid_xy(x: Column, y: Column, pitch: Column) -> tuple[Column, Column]:
    """P6, Q18."""
    return F.floor(x / pitch).cast("int"), F.floor(y / pitch).cast("int")


def native_tile_px(mpp: Column, default: float = 0.252) -> Column:
    """Half to even, as the size in pixels is a whole number; an invalid resolution counts as the default."""
    value = mpp.try_cast("double")
    return F.bround(F.lit(224 * 1.8) / F.when(value > 0, value).otherwise(default), 0).cast("int")


def parse_malignancy(value: Column, strict: bool = False) -> Column:
    """A tri-state; strict raises on words outside the vocabulary."""
    word = F.lower(F.trim(value.cast("string")))
    known = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    if not strict:
        return known
    return F.when(word.isNull() | (word == ""), F.lit(None).cast("boolean")).when(word.isin(*TRUE_WORDS, *FALSE_WORDS), known).otherwise(F.raise_error(F.concat(F.lit("not a malignancy: "), word)).cast("boolean"))


def malignancy_polarity(text: Column) -> Column:
    """Negative wording first."""
    t = F.lower(text)
    return F.when(t.rlike(r"\b(non[- ]?malignant|benign|not malignant)\b"), "non_malignant").when(t.rlike(r"\b(malignant|cancerous|tumou?r)\b"), "malignant")


def purity_number(label: Column) -> Column:
    """P10."""
    t = F.lower(label)
    return F.when(t.contains("high"), 0.85).when(t.contains("medium") | t.contains("moderate"), 0.65).when(t.contains("low"), 0.35)


def clean_columns(df: DataFrame) -> DataFrame:
    """Names stripped, spaces and dashes to underscores, lower; repeats get __dupN."""
    seen: dict[str, int] = {}
    out = []
    for name in df.columns:
        clean = name.strip().replace(" ", "_").replace("-", "_").lower()
        n = seen[clean] = seen.get(clean, -1) + 1
        out.append(f"{clean}__dup{n}" if n else clean)
    return df.toDF(*out)


def category_key(value: Column) -> Column:
    """P16."""
    return F.coalesce(F.nullif(F.lower(F.trim(value)), F.lit("")), F.lit("missing"))


def risk_rgba(risk: Column, dead: float = 0.02) -> Column:
    """Red above, blue below, clear within the dead zone; intensity is clipped at 1."""
    strength = F.least(F.abs(risk), F.lit(1.0))
    none = F.lit(0.0)
    return F.when(F.abs(risk) < dead, F.array(none, none, none, none)).when(risk > 0, F.array(F.lit(1.0), none, none, strength)).otherwise(F.array(none, none, F.lit(1.0), strength))


def grade_of(predominant: Column, high_share: Column) -> Column:
    """P20: a fifth of high-grade patterns makes 3, else lepidic 1, acinar or papillary 2."""
    return F.when(high_share >= 0.20, 3).when(predominant == "lepidic", 1).when(predominant.isin("acinar", "papillary"), 2).otherwise(3)


def clinical_grade(lepidic: Column, acinar: Column, papillary: Column, high: Column) -> Column:
    """The older rule."""
    return F.when(high >= 0.2, "G3").when(acinar + papillary > lepidic, "G2").otherwise("G1")


def supercluster(hpc: Column, groups: dict[str, list[int]]) -> Column:
    """Id to group, else Unknown."""
    mapping = F.create_map(*chain.from_iterable((F.lit(i), F.lit(g)) for g, ids in groups.items() for i in ids))
    return F.coalesce(F.try_element_at(mapping, hpc.cast("int")), F.lit("Unknown"))


def trim_event(months: Column, most: float = 144.0) -> Column:
    """P23."""
    return F.greatest(F.lit(0.0), F.least(months.cast("double"), F.lit(most)))


def scanner_date(text: Column) -> Column:
    """P25: two-digit or four-digit years, with or without a time."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(text), F.lit(f)) for f in ("MM/dd/yy HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "MM/dd/yy", "MM/dd/yyyy")))


def utc_text(ts: Column) -> Column:
    """P26."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit(" UTC"))


def log2_p(p: Column) -> Column:
    """P29."""
    return -F.log2(F.greatest(p, F.lit(1e-300)))


def native_null(value: Column) -> Column:
    """P30."""
    return F.when(~F.isnan(value), value)


def description_key(text: Column, fillers: tuple[str, ...] = ("with", "and", "the", "of", "a", "in")) -> Column:
    """The set of words, whatever their order."""
    parts = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "), " "), lambda w: (w != "") & ~w.isin(*fillers))
    return F.array_join(F.array_sort(F.array_distinct(parts)), " ")


def cut(value: Column, cutoffs: list[float]) -> Column:
    """The number of the right-closed bin."""
    out = F.lit(len(cutoffs))
    for i in range(len(cutoffs) - 1, -1, -1):
        out = F.when(value <= cutoffs[i], i).otherwise(out)
    return F.when(value.isNotNull(), out)


def softmax(scores: Column, temperature: float = 5.0) -> Column:
    """Shares of an array of log scores."""
    top = F.array_max(scores)
    e = F.transform(scores, lambda s: F.exp((s - top) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def rounded(value: Column, digits: int = 6) -> Column:
    """A double as SQL's round on doubles has it: halves are those of the scaled double, and a zero keeps its sign.

    F.round goes by the decimal text, so it differs at ties, and a small negative number becomes 0.0 there and not -0.0.
    """
    unit = F.lit(10.0**digits)
    scaled = F.abs(value * unit)
    return F.when(scaled < float("inf"), F.signum(value) * F.round(scaled) / unit).otherwise(value)


def in_vocabulary(value: Column, words: dict[str, str], default: str = "not_applicable") -> Column:
    """P34."""
    mapping = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in words.items()))
    return F.coalesce(F.try_element_at(mapping, F.lower(F.trim(value))), F.lit(default))
