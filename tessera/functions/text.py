"""Normal forms of questions."""

import re

#: Fixed words for numbers and synonyms.
UNITS = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = {w: 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
SYNONYMS = {"wsi": "slide", "wsis": "slides", "cluster": "hpc", "clusters": "hpcs", "tumour": "malignant", "tumor": "malignant", "cancerous": "malignant", "benign": "non-malignant", "patch": "tile", "patches": "tiles"}


def numbers(text: str) -> str:
    """Number words to digits: thirty two and thirty-two to 32."""
    tens, units = "|".join(TENS), "|".join(UNITS)
    joined = re.sub(rf"\b({tens})[ -]({units})\b", lambda m: str(TENS[m[1].lower()] + UNITS[m[2].lower()]) if UNITS[m[2].lower()] < 10 else m[0], text, flags=re.I)
    return re.sub(rf"\b({tens}|{units})\b", lambda m: str((TENS | UNITS)[m[1].lower()]), joined, flags=re.I)


def enrich(text: str) -> str:
    """Q1: blanks folded, synonyms and number words replaced."""
    out = re.sub(r"\s+", " ", numbers(text)).strip()
    return re.sub(r"\b(" + "|".join(SYNONYMS) + r")\b", lambda m: SYNONYMS[m[1].lower()], out, flags=re.I)


def indel_ratio(a: str, b: str) -> float:
    """Similarity in percent by insertions and deletions: 200 * longest common subsequence / total length."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def partial_ratio(short: str, long: str) -> float:
    """Q3: the best ratio of the shorter text with a piece of the longer one of its length."""
    if len(short) > len(long):
        short, long = long, short
    if not short:
        return 0.0
    return max(indel_ratio(short, long[i : i + len(short)]) for i in range(len(long) - len(short) + 1))
