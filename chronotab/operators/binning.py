"""Fitted WoE bins (I1, I2): ordered merging of pre-bin counts, numeric and categorical.

Spark counts events and non-events in pre-bins, all variables in one grouped pass; what comes back
is bounded by the parameters (variables x pre-bins), and the merging of these counts is done here:

1. numeric pre-bins are quantile ranges, in order; levels are ordered by event rate, levels with
   less than ``level_share`` of the rows pooled into one (``rest``), which unseen levels join;
2. neighbours whose event rates break the order are pooled (pool adjacent violators), for numeric
   variables rising or falling, whichever has the larger information value (ties: rising);
3. the first bin with too few rows or events joins the neighbour with the nearer rate (ties: the
   one below), until none is left; the order holds, as a pooled rate lies between the two;
4. null is a bin of its own, outside the order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotab.operators.order import exact_quantiles

SMOOTHING = 0.5  # [ours] added to every bin count so an empty class share has a finite WoE
MISSING = -1
BIN_SCHEMA = ("variable string, kind string, bin int, upper double, levels array<string>, rest boolean, "
              "n_event bigint, n_nonevent bigint, woe double, iv_term double")


@dataclass
class Block:
    """A run of pre-bins: events, non-events and the pre-bins in it."""

    e: int
    n: int
    members: list = field(default_factory=list)

    @property
    def rate(self) -> float:
        return self.e / (self.e + self.n)

    def __add__(self, other: Block) -> Block:
        return Block(self.e + other.e, self.n + other.n, self.members + other.members)


@dataclass(frozen=True)
class Bin:
    variable: str
    kind: str
    bin: int
    upper: float | None
    levels: list[str] | None
    rest: bool
    n_event: int
    n_nonevent: int
    woe: float
    iv_term: float


def pool_violators(blocks: list[Block], rising: bool = True) -> list[Block]:
    """Neighbours pooled until rates strictly rise (or fall)."""
    out: list[Block] = []
    for b in blocks:
        while out and (out[-1].rate >= b.rate if rising else out[-1].rate <= b.rate):
            b = out.pop() + b
        out.append(b)
    return out


def pool_short(blocks: list[Block], min_rows: float, min_events: int) -> list[Block]:
    """Bins below the least rows or events pooled with the neighbour of the nearer rate."""
    out = list(blocks)
    while len(out) > 1:
        k = next((i for i, b in enumerate(out) if b.e + b.n < min_rows or b.e < min_events), None)
        if k is None:
            break
        below = k == len(out) - 1 or k > 0 and abs(out[k].rate - out[k - 1].rate) <= abs(out[k].rate - out[k + 1].rate)
        at = k - 1 if below else k
        out[at:at + 2] = [out[at] + out[at + 1]]
    return out


def weight(e: int, n: int, events: int, nonevents: int) -> tuple[float, float]:
    """(woe, information value term) of a bin."""
    ev, ne = (e + SMOOTHING) / float(events), (n + SMOOTHING) / float(nonevents)
    return round(log(ne / ev), 12), round((ne - ev) * log(ne / ev), 12)


def information(blocks: list[Block], events: int, nonevents: int) -> float:
    return sum(weight(b.e, b.n, events, nonevents)[1] for b in blocks)


def merge_counts(blocks: list[Block], numeric: bool, events: int, nonevents: int, min_share: float, min_events: int) -> list[Block]:
    """Steps 2 and 3 for one variable's pre-bins in order; ``events`` and ``nonevents`` are the
    variable's totals, nulls included."""
    rising = pool_violators(blocks)
    best = rising
    if numeric:
        falling = pool_violators(blocks, rising=False)
        if information(falling, events, nonevents) > information(rising, events, nonevents):
            best = falling
    return pool_short(best, min_share * (events + nonevents), min_events)


def prebin_edges(train: DataFrame, numeric: Sequence[str], n_prebins: int) -> dict[str, list[float]]:
    """Exact quantile edges of every variable (a bounded list each)."""
    if not numeric:
        return {}
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in numeric)
    long = train.selectExpr(f"stack({len(numeric)}, {stack}) AS (variable, value)").where("value IS NOT NULL")
    found: dict[str, set] = {c: set() for c in numeric}
    for r in exact_quantiles(long, "value", [i / n_prebins for i in range(1, n_prebins)], by=["variable"]).collect():
        found[r.variable].add(r.value)
    return {c: sorted(v) for c, v in found.items()}


def below_edges(value: Column, edges: Sequence[float]) -> Column:
    """The number of edges strictly below the value."""
    v = value.cast("double")
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>"), lambda e: e < v))


def fit_bins(train: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = (), n_prebins: int = 20,
             min_share: float = 0.05, min_events: int = 5, level_share: float = 0.01,
             edges: dict[str, list[float]] | None = None) -> list[Bin]:
    """The bins of every variable, fitted on the rows given. ``edges``: pre-bin edges known from
    elsewhere (a stored sketch), in place of exact quantiles."""
    edges = edges or prebin_edges(train, numeric, n_prebins)
    cells = [F.struct(F.lit(v).alias("variable"), F.when(F.col(v).isNotNull(), below_edges(F.col(v), edges[v]).cast("string")).alias("cell"))
             for v in numeric]
    cells += [F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("cell")) for v in categorical]
    label = F.col(y).cast("int")
    counts = train.where(label.isNotNull()).select(label.alias("_y"), F.inline(F.array(*cells))).groupBy("variable", "cell").agg(
        F.sum("_y").cast("bigint").alias("e"), F.sum(1 - F.col("_y")).cast("bigint").alias("n"))
    total = counts.groupBy("variable").agg(F.sum(F.col("e") + F.col("n")).alias("_all"))
    # levels too rare to stand alone become one row, so that what is collected stays bounded
    rare = F.col("variable").isin(list(categorical)) & (F.col("e") + F.col("n") < F.lit(level_share) * F.col("_all")) & F.col("cell").isNotNull()
    pooled = (counts.join(total, "variable").withColumn("_rest", rare).withColumn("cell", F.when(~rare, F.col("cell")))
              .groupBy("variable", "cell", "_rest").agg(F.sum("e").alias("e"), F.sum("n").alias("n"))).collect()
    out: list[Bin] = []
    for v in [*numeric, *categorical]:
        rows = [r for r in pooled if r.variable == v]
        events, nonevents = sum(r.e for r in rows), sum(r.n for r in rows)
        if not events or not nonevents:
            raise ValueError(f"{v}: the training rows hold one class only")
        kept = [r for r in rows if r.cell is not None or r._rest]
        is_numeric = v in numeric
        key = (lambda r: int(r.cell)) if is_numeric else (lambda r: (r.e / (r.e + r.n), r._rest, r.cell or ""))
        blocks = [Block(r.e, r.n, [r]) for r in sorted(kept, key=key)]
        for k, b in enumerate(merge_counts(blocks, is_numeric, events, nonevents, min_share, min_events)):
            last = int(b.members[-1].cell) if is_numeric else None
            out.append(Bin(v, "numeric" if is_numeric else "categorical", k,
                           edges[v][last] if is_numeric and last < len(edges[v]) else None,
                           None if is_numeric else sorted(r.cell for r in b.members if not r._rest),
                           any(r._rest for r in b.members), b.e, b.n, *weight(b.e, b.n, events, nonevents)))
        for r in rows:
            if r.cell is None and not r._rest:
                out.append(Bin(v, "numeric" if is_numeric else "categorical", MISSING, None, None, False, r.e, r.n,
                               *weight(r.e, r.n, events, nonevents)))
        if is_numeric:  # the last bin has no upper end
            top = max((b for b in out if b.variable == v and b.bin >= 0), key=lambda b: b.bin, default=None)
            if top:
                out[out.index(top)] = Bin(**{**top.__dict__, "upper": None})
    return out


def bins_table(spark: SparkSession, bins: Sequence[Bin]) -> DataFrame:
    return spark.createDataFrame([tuple(b.__dict__.values()) for b in bins], BIN_SCHEMA)


def read_bins(table: DataFrame) -> list[Bin]:
    """Bins from their stored table (a bounded number of rows)."""
    return [Bin(**r.asDict()) for r in table.orderBy("variable", "bin").collect()]


def woe_of(variable: str, bins: Sequence[Bin]) -> Column:
    """The WoE of a variable's value as one expression; a level or null never seen weighs 0."""
    own = [b for b in bins if b.variable == variable]
    value = F.col(variable)
    missing = next((b.woe for b in own if b.bin == MISSING), 0.0)
    ordered = sorted((b for b in own if b.bin != MISSING), key=lambda b: b.bin)
    if ordered and ordered[0].kind == "categorical":
        known = [x for b in ordered for level in b.levels or [] for x in (F.lit(level), F.lit(b.woe))]
        rest = next((b.woe for b in ordered if b.rest), 0.0)
        text = value.cast("string")
        seen = F.coalesce(F.element_at(F.create_map(*known), text), F.lit(rest)) if known else F.lit(rest)
    else:
        weights = F.array(*[F.lit(b.woe) for b in ordered]) if ordered else F.array(F.lit(0.0))
        seen = F.get(weights, below_edges(value, [b.upper for b in ordered[:-1]]))
    return F.when(value.isNull(), F.lit(missing)).otherwise(seen)
