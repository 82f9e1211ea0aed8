"""Sources interleaved to target weights by Pfair scheduling of blocks.

The fluid schedule gives every source its weight's share of each slot until its rows end, when the others' shares grow
in proportion: at any slot a source has had min(its rows, weight times the virtual time), which is known in closed form.
Slots are dealt in periods, and a period ends wherever a source does, so the fluid counts grow evenly within each. At its
ends each source's count is the fluid one rounded, never less than before: largest remainders, with units that were
early carried over. Within it, unit j of a source with q of n slots is released at floor(j n / q) and due at ceil((j +
1) n / q), and of the units released the one with the earliest deadline goes first. Counts are then off by less than one
unit at the ends of a period and by less than one more within it. A unit is half a block, so a source is off by less
than a block at every slot. Counts at the ends are worked out beforehand; periods don't depend on each other then, so
tasks work them out side by side.
"""

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Sources that the plan may have, which goes to tasks as a broadcast; a share is at least one in LEAST.
MOST_SOURCES, LEAST = 1_000_000, 1 << 20
#: Weights are integers of about so many bits, slots of a period at most about so many, and counts at ends of periods that a plan may hold.
BITS, PERIOD, MOST_COUNTS = 62, 4096, 8_000_000
#: Rows of a source that one task ranks, about, and bytes of slots that may be broadcast.
RANKED, BROADCAST = 100_000, 32 << 20


def period(quota: dict[int, int]) -> list[int]:
    """The source of each slot of a period: of the units released, the one with the earliest deadline."""
    n = sum(quota.values())
    waiting: list[tuple[int, int, int]] = []
    ready: list[tuple[int, int, int]] = []
    for s in quota:
        heappush(waiting, (0, s, 0))
    out = []
    for t in range(n):
        while waiting and waiting[0][0] <= t:
            _, s, j = heappop(waiting)
            heappush(ready, (-(-(j + 1) * n // quota[s]), s, j))
        due, s, j = heappop(ready)
        if due <= t:
            raise AssertionError("a deadline was missed")
        out.append(s)
        if j + 1 < quota[s]:
            heappush(waiting, ((j + 1) * n // quota[s], s, j + 1))
    return out


class Plan:
    """Slots of sources with ``rows`` rows each, in units of ``unit`` rows, to positive weights."""

    def __init__(self, names: list[str], rows: list[int], weights: list[float | Fraction], unit: int) -> None:
        self.names, self.rows, self.unit = names, rows, unit
        self.units = [-(-n // unit) for n in rows]
        self.total = sum(self.units)
        whole = sum(map(Fraction, weights))
        self.weights = [max((Fraction(w) / whole * (1 << BITS)).__floor__(), (1 << BITS) // LEAST) for w in weights]
        # sources by the virtual time at which they end; what has ended by then, what is left, and the slot
        self.order = sorted(range(len(names)), key=lambda s: Fraction(self.units[s], self.weights[s]))
        self.ended = [0, *accumulate(self.units[s] for s in self.order)]
        self.left = [sum(self.weights), *(sum(self.weights) - x for x in accumulate(self.weights[s] for s in self.order))]
        self.ends = [self.ended[i] + Fraction(self.units[s], self.weights[s]) * self.left[i] for i, s in enumerate(self.order)]
        self.cuts = self._cuts()
        self.before = self._counts()
        self.periods = len(self.cuts) - 1

    def _cuts(self) -> list[int]:
        """Slots at which periods end: where sources do, and between so that none is long. Where ends are too many for the
        counts that a plan may hold, only every so manieth is one; then sources are few units each."""
        most = max(2, MOST_COUNTS // max(1, len(self.names)))
        ends = sorted({min(-(-e // 1), self.total) for e in self.ends} | {self.total}) if self.total else []
        skip = -(-2 * len(ends) // most)
        kept = [0, *(e for i, e in enumerate(ends) if e == self.total or i % skip == 0)] if ends else [0]
        length = max(PERIOD, -(-2 * self.total // most))
        out = [0]
        for a, b in zip(kept, kept[1:], strict=False):
            n = -(-(b - a) // length)
            out += [a + (b - a) * i // n for i in range(1, n + 1)]
        return out

    def _counts(self) -> np.ndarray:
        """The units of each source before each cut: the fluid counts, rounded so that they add up to the slots and never fall."""
        units, weights = np.array(self.units, np.int64), np.array(self.weights, np.float64)
        out, now = np.zeros((len(self.cuts), len(units)), np.int64), np.zeros(len(units), np.int64)
        order = np.array(self.order, np.int64)
        for k, slot in enumerate(self.cuts):
            i = bisect_right(self.ends, slot)
            fluid = units.astype(np.float64)
            rest = order[i:]
            fluid[rest] = np.minimum(weights[rest] * float(Fraction(slot - self.ended[i], self.left[i])), fluid[rest]) if len(rest) else 0
            base = np.minimum(np.maximum(np.floor(fluid + 1e-9).astype(np.int64), now), units)
            while short := int(slot - base.sum()):
                # the furthest behind get one more; or the furthest ahead, of what isn't given yet, one less
                open_ = np.flatnonzero(base < units if short > 0 else base > now)
                lag = (fluid - base)[open_] * (1 if short > 0 else -1)
                base[open_[np.argsort(-lag, kind="stable")[: abs(short)]]] += 1 if short > 0 else -1
            out[k] = now = base
        return out

    def start(self, k: int) -> int:
        """The first slot of period k, for the last one's successor the number of slots."""
        return self.cuts[k]

    def fluid(self, slot: int, source: int) -> Fraction:
        """The share of the first ``slot`` slots that a source is due."""
        i = bisect_right(self.ends, slot)
        return Fraction(self.units[source]) if source in self.order[:i] else Fraction(self.weights[source] * (slot - self.ended[i]), self.left[i])

    def counts(self, k: int) -> list[int]:
        """The units of each source before period k."""
        return self.before[k].tolist()

    def slots(self, k: int) -> tuple[int, list[int], list[int], list[int]]:
        """The first slot of period k, and for each slot the source, its unit and the row that it starts at."""
        before, after = self.counts(k), self.counts(k + 1)
        sources = period({s: b - a for s, (a, b) in enumerate(zip(before, after, strict=True)) if b > a})
        row = sum(min(n * self.unit, rows) for n, rows in zip(before, self.rows, strict=True))
        units, rows = [], []
        for s in sources:
            units.append(before[s])
            rows.append(row)
            row += min(self.unit, self.rows[s] - before[s] * self.unit)
            before[s] += 1
        return self.start(k), sources, units, rows


_SLOTS = "mix_src string, mix_unit long, mix_slot long, mix_at long"


def _slots(shared):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = shared.value
        names = pa.array(plan.names, pa.string())
        for batch in batches:
            for k in batch.column("id").to_pylist():
                first, sources, units, rows = plan.slots(k)
                slot = np.arange(first, first + len(sources))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(sources, pa.int64())), pa.array(units, pa.int64()), pa.array(slot), pa.array(rows, pa.int64())], ["mix_src", "mix_unit", "mix_slot", "mix_at"])

    return over


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = 16, power: float = 0.5, seed: int = 1, source_col: str = "source") -> DataFrame:
    """``docs`` with mix_block (of its source), mix_slot (of the half block) and mix_pos (of the row, from 0, without gaps).

    A source's documents, in the order of a hash, form blocks of ``block`` (2 or more); slots interleave half blocks so
    that each source's share of any first slots is off its target by less than one block. When a source ends, the others
    go on with weights scaled up: every row has its place once, none is dropped or repeated.

    weights: by source; sources that it lacks get the least share, one in LEAST, to which smaller ones are lifted.
    None: the number of documents to ``power``. Only counts by source reach the driver, of MOST_SOURCES at most (more
    refuse). Slots are worked out by tasks and joined to rows by source and unit, as a broadcast if they are few.
    Ranks come from parts by hash of every source, of about RANKED rows, so a hot source is as many tasks' work as any.

    A null source is a source of its own. The hash is over the whole row (but for columns with maps), so repeated ids, null ones too,
    are spread; rows alike in all columns may change places among themselves. An empty table gives an empty result.
    Columns called mix_* are replaced.
    """
    if block < 2:
        raise ValueError("a block has 2 rows or more")
    spark, unit = docs.sparkSession, block // 2
    own = docs.drop("mix_block", "mix_slot", "mix_pos")
    names = own.columns
    hashed = [f.name for f in own.schema if "map<" not in f.dataType.simpleString()]
    own = own.withColumn("mix_src", F.coalesce(F.concat(F.lit("s"), source_col), F.lit("n"))).withColumn("mix_hash", F.xxhash64(F.lit(seed), *hashed))
    n = {r.mix_src: r.n for r in own.groupBy("mix_src").agg(F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()}
    if len(n) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    n = dict(sorted(n.items()))
    if weights is None:
        share = [float(k) ** power for k in n.values()]
    else:
        share = [max(weights.get(s[1:], 0.0), 0.0) if s != "n" else 0.0 for s in n]
        if n and not sum(share):
            raise ValueError("no source has a weight above zero")
    plan = Plan(list(n), list(n.values()), share, unit)
    tasks = max(1, min(plan.periods, plan.total >> 17))
    slots = spark.range(0, plan.periods, 1, tasks).mapInArrow(_slots(spark.sparkContext.broadcast(plan)), _SLOTS)
    if sum(k * (len(s) + 40) for s, k in zip(n, plan.units, strict=True)) <= BROADCAST:
        slots = F.broadcast(slots)
    # the upper bits of the hash: more parts never change the order
    bits = max(10, (max(n.values(), default=1) // RANKED).bit_length())
    own = own.withColumn("mix_part", F.shiftrightunsigned("mix_hash", 64 - bits))
    counts = own.groupBy("mix_src", "mix_part").agg(F.count("*").alias("n"))
    by_src = Window.partitionBy("mix_src").orderBy("mix_part")
    before = counts.select("mix_src", "mix_part", (F.sum("n").over(by_src) - F.col("n")).alias("before"))
    ranked = own.withColumn("mix_rank", F.row_number().over(Window.partitionBy("mix_src", "mix_part").orderBy("mix_hash")) - 1)
    ranked = ranked.join(before, ["mix_src", "mix_part"]).withColumn("mix_rank", F.col("mix_rank") + F.col("before"))
    ranked = ranked.withColumn("mix_unit", F.floor(F.col("mix_rank") / unit).cast("long"))
    placed = ranked.join(slots, ["mix_src", "mix_unit"])
    return placed.select(*names, F.floor(F.col("mix_rank") / block).cast("long").alias("mix_block"), "mix_slot", (F.col("mix_at") + F.col("mix_rank") % unit).alias("mix_pos"))
