"""Questions to plans, and plans to frames (Q rows, R37, R38). The plan, not the text, decides what runs."""

import json
import re
from dataclasses import asdict, dataclass, field
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import enrich, indel_ratio, partial_ratio
from tessera.operators import profiles as P
from tessera.operators.keys import log2_p
from tessera.operators.lookup import first_match
from tessera.operators.spatial import edge_counts, grid_pairs

GREETING = re.compile(r"^\s*(hi|hello|hey|good (morning|afternoon|evening))\b[\s!.,]*", re.I)
TILE = re.compile(r"\b([\w.-]+_\d+_\d+(?:_\d+)?\.(?:jpe?g|png))\b", re.I)
HPC = re.compile(r"\bhpcs?\s*(?:id\s*)?#?((?:\d{1,3}(?:\s*(?:,|and|or)\s*)?)+)", re.I)
SLIDE = re.compile(r"\bslides?\s+(?:id\s*)?#?([A-Za-z]*[\w-]*\d[\w-]*)", re.I)
SAMPLE = re.compile(r"\bsample\s+([A-Za-z][\w-]*)", re.I)


@dataclass
class Plan:
    """What a question asks for."""

    intent: str = "unknown"
    entities: dict = field(default_factory=lambda: {"tile": [], "slide": [], "hpc": [], "sample": []})
    flags: dict = field(default_factory=lambda: {"malignant": False, "non_malignant": False, "survival": False})
    operations: list = field(default_factory=list)
    ui_actions: dict = field(default_factory=dict)
    confidence: float = 0.0
    planner: str = "regex"

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "Plan":
        body = re.search(r"\{.*\}", text, re.S)  # a model may wrap it in other text
        return cls(**json.loads(body[0])) if body else cls()


def entities(text: str) -> dict[str, list[str]]:
    """Q7: names in a question, each once, in order; plurals alone are no ids."""
    ids = list(chain.from_iterable(re.findall(r"\d+", m) for m in HPC.findall(text)))
    uniq = lambda xs: list(dict.fromkeys(xs))
    return {"tile": uniq(TILE.findall(text)), "slide": uniq(SLIDE.findall(text)), "hpc": uniq(ids), "sample": uniq(SAMPLE.findall(text))}


def plan(question: str) -> Plan:
    """Q4: a plan from the text alone. An entity outweighs a greeting."""
    text = enrich(question)
    low = text.lower()
    out = Plan(entities=entities(text))
    found = any(out.entities.values())
    out.flags["non_malignant"] = bool(re.search(r"\bnon[- ]?malignant\b", low))
    out.flags["malignant"] = bool(re.search(r"(?<!non[- ])\bmalignant\b", low))
    out.flags["survival"] = bool(re.search(r"\b(survival|hazard|prognos\w+|risk)\b", low))
    if GREETING.match(text) and not found:
        out.intent, out.confidence = "greeting", 0.9
        return out
    if re.search(r"\b(how many|count|number of)\b", low):
        out.operations.append("count")
    if re.search(r"\b(coverage|percent\w*|proportion|share)\b", low):
        out.operations.append("coverage")
    if re.search(r"\b(adjacent|adjacency|neighbou?r\w*|next to|touch\w*)\b", low):
        out.operations.append("adjacency")
        out.ui_actions["adjacency"] = True
    if re.search(r"\b(highlight|show|heat ?map)\b", low):
        out.ui_actions["highlight"] = out.entities["hpc"][:1] or (["malignant"] if out.flags["malignant"] else [])
    if re.search(r"\b(top|most|dominant|highest)\b", low):
        out.operations.append("top")
    out.intent = "survival" if out.flags["survival"] else next((k for k in ("tile", "slide", "sample", "hpc") if out.entities[k]), "analytics" if out.operations else "unknown")
    out.confidence = 0.8 if found else 0.6 if out.operations or any(out.flags.values()) else 0.2
    return out


def merge(base: Plan, other: Plan) -> Plan:
    """Q5: entities and operations join, flags add up, the more confident intent wins."""
    uniq = lambda xs: list(dict.fromkeys(xs))
    best = other if other.confidence > base.confidence and other.intent != "unknown" else base
    return Plan(best.intent, {k: uniq([*map(str, base.entities[k]), *map(str, other.entities.get(k, []))]) for k in base.entities}, {k: base.flags[k] or bool(other.flags.get(k)) for k in base.flags}, uniq([*base.operations, *other.operations]), base.ui_actions | other.ui_actions, max(base.confidence, other.confidence), f"{base.planner}+{other.planner}")


def validated(p: Plan, slides: set[str], hpcs: set[int]) -> Plan:
    """Q5: only slides and clusters that exist; slides also by near spelling (Q2)."""
    names = [y for x in p.entities["slide"] for y in slide_ids(x, slides)]
    ids = [x for x in p.entities["hpc"] if int(x) in hpcs]
    return Plan(p.intent, p.entities | {"slide": list(dict.fromkeys(names)), "hpc": ids}, p.flags, p.operations, p.ui_actions, p.confidence, p.planner)


def slide_ids(text: str, slides: set[str], least: float = 90.0) -> list[str]:
    """Q2: slides named in a text, exactly, else the closest spelling."""
    exact = sorted(s for s in slides if re.search(rf"(?<![\w-]){re.escape(s)}(?![\w-])", text, re.I))
    if exact:
        return exact
    scored = sorted((-indel_ratio(w.lower(), s.lower()), s) for w in re.findall(r"[\w-]{4,}", text) for s in slides)
    return [scored[0][1]] if scored and -scored[0][0] >= least else []


def title_matches(asked: DataFrame, titles: DataFrame, least: float = 80.0, most: int = 10_000) -> DataFrame:
    """Q3: the cluster whose title is closest to a text: distinct texts are scored once, in Arrow batches. Titles are one row a cluster; more than ``most`` are refused."""
    found = titles.select("hpc_title", "hpc_id").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} titles")
    known = sorted((r.hpc_title, r.hpc_id) for r in found)

    @F.pandas_udf("int")
    def best(text: pd.Series) -> pd.Series:
        def one(t: str):
            scored = max(((partial_ratio(t.lower(), k.lower()), -i) for k, i in known), default=(0.0, 0))
            return -scored[1] if t and scored[0] >= least else None

        return text.map(lambda t: one(t or "")).astype("Int32")

    scored = asked.select("q").distinct().withColumn("hpc_id", best("q"))
    return asked.join(scored.withColumnRenamed("q", "_q"), F.col("q").eqNullSafe(F.col("_q")), "left").drop("_q")


def needs_data(p: Plan) -> bool:
    """Q6."""
    return p.intent not in ("greeting", "unknown") or bool(p.operations) or any(p.flags.values())


def execute(p: Plan, tiles: DataFrame, dictionary: DataFrame, survival: DataFrame) -> DataFrame | None:
    """Q8 to Q14: the frame that answers a plan; None if it needs no data."""
    e = p.entities
    if not needs_data(p):
        return None
    if p.intent == "survival":
        hit = survival.where(F.col("hpc_id").isin([int(x) for x in e["hpc"]])) if e["hpc"] else survival.where("p is not null").orderBy("p", "hpc_id").limit(10)
        return hit.select("hpc_id", "coef", "p", F.round(log2_p(F.col("p")), 4).alias("log2_p"))
    if "adjacency" in p.operations:
        scope = tiles.where(F.col("slides").isin(e["slide"])) if e["slide"] else tiles
        pairs = edge_counts(grid_pairs(scope, name=None, first="slide_tile"))
        if e["hpc"]:
            i = int(e["hpc"][0])
            pairs = pairs.where((F.col("a") == i) | (F.col("b") == i))
        return pairs.groupBy("a", "b").agg(F.sum("edges").alias("edges"))
    if p.intent == "tile":
        return first_match(tiles.sparkSession.createDataFrame([(x,) for x in e["tile"]], "q string"), tiles.select("tiles"), "tiles")
    if p.intent in ("slide", "sample"):
        key = "slides" if p.intent == "slide" else "samples"
        prop = P.proportion(tiles.where(F.lower(key).isin([x.lower() for x in e[p.intent]])), group=(key,))
        if "coverage" in p.operations:
            return P.coverage(prop, dictionary, key)
        if p.flags["malignant"]:
            prop = prop.join(dictionary.where("malignant").select("hpc_id"), "hpc_id")
        return prop.select(key, "hpc_id", "n", "proportion").orderBy(F.desc("n"), "hpc_id").limit(5)
    if p.intent == "hpc":
        ids = [int(x) for x in e["hpc"]]
        n = tiles.where(F.col("hpc_id").isin(ids)).groupBy("hpc_id").agg(F.count("*").alias("n_tiles"), F.countDistinct("slides").alias("n_slides"))
        return dictionary.where(F.col("hpc_id").isin(ids)).join(n, "hpc_id", "left")
    return P.tri_counts(dictionary)


def view_state(p: Plan, pairs: DataFrame | None = None) -> dict:
    """What a viewer should show."""
    state = {"slide": next(iter(p.entities["slide"]), None), "heat": next(iter(p.entities["hpc"]), None), "highlight": p.ui_actions.get("highlight", []), "pair": None}
    if p.ui_actions.get("adjacency") and pairs is not None:
        top = pairs.where("a <> b").orderBy(F.desc("edges"), "a", "b").first()
        state["pair"] = (top.a, top.b) if top else None
    return state
