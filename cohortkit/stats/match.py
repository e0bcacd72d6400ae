"""Propensity scores and nearest-neighbour matching (ST5, ST6, ST7).

Contract (the study's matching call is unpinned; this is ours): cases are
taken in falling score order (ties by id); in each of ``ratio`` rounds every
case, in that order, takes the nearest control still free (distance
``|score_case - score_control|``, ties by control id).  Rounds are run one
after the other, so every case gets its first control before any gets a
second.

Distributed form, exact and linear.  Go down the scores.  The controls used
below the current case are always the highest ones there, so what is free is
described by a *pointer* (the last control used, counted from the top) and a
*stack* of controls that were passed and left over, nearest on top.  A case
takes the better of the two heads.

* Cases and controls stand in one order and are cut into blocks of
  consecutive rows.  A block with n cases needs its own rows, the n controls
  after the pointer, and the n topmost controls of the stack: at most a
  fixed multiple of the block size, whatever the ties.
* All blocks run at once against the state they are expected to find.  They
  report how far the pointer moved, how many controls came off the stack,
  how many they leave and the ids of the ``KNOWN`` nearest of these.  The
  driver (a bounded entry per block) adds that up in order; a block whose
  pointer, or any control it looked at on the stack, is not the true one
  runs again.  The first such block always becomes right, so the passes end;
  a block is touched only by changes near its borders, so a few passes
  settle them all.  Rows are never paired beyond the block's own needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import positions
from ..session import cut_lineage
from .absorb import fit_absorbed
from .glm import LogitFit, build_design, fit

# --- propensity (ST5) ----------------------------------------------------------

def linear_predictor(lf: LogitFit, df: DataFrame, out: str = "__eta") -> DataFrame:
    """``df`` with the fitted linear predictor, on any frame with the model's
    source columns.  Factor coefficients come by a join to the level table
    (NULL for a value that is no level)."""
    coef = {lb: b or 0.0 for lb, b in zip(lf.labels, lf.coef)}
    eta = F.lit(coef.get("(Intercept)", 0.0))
    res, extra = df, []
    for i, t in enumerate(lf.design.terms):
        if t.kind == "factor":
            name = f"__b{i}"
            rows = [(t.levels[0], 0.0), *((v, coef[lb]) for v, lb in zip(t.levels[1:], t.labels))]
            tab = df.sparkSession.createDataFrame(rows, f"__v{i} string, {name} double")
            # one row per coefficient: broadcast, so that no task sorts all rows of a level
            res = res.join(F.broadcast(tab), res[t.name] == tab[f"__v{i}"], "left").drop(f"__v{i}")
            extra.append(name)
            eta = eta + F.col(name)
        else:
            eta = eta + F.lit(coef[t.labels[0]]) * F.col(t.name).cast("double")
    return res.withColumn(out, eta).drop(*extra)


def propensity(df: DataFrame, treat: str, covariates: Sequence[str],
               levels: Mapping[str, Sequence] | None = None, out: str = "score", absorb: str | None = None) -> DataFrame:
    """ST5: logistic model of ``treat`` on ``covariates``; the fitted
    probability is added as ``out`` (NULL where a covariate is missing).
    ``absorb``: a factor of any number of levels, fitted without columns."""
    if absorb is not None:
        lf = fit_absorbed(df, treat, absorb, [c for c in covariates if c != absorb])
        return lf.predict(df, out)
    lf = fit(build_design(df, treat, covariates, levels))
    return linear_predictor(lf, df).withColumn(out, 1.0 / (1.0 + F.exp(-F.col("__eta")))).drop("__eta")


# --- k nearest controls (exact, no pairs) -------------------------------------

class ControlIndex:
    """Controls numbered in two orders, and each case's insertion point.

    ``r_up``: position by (score up, id up).  ``r_down``: position by (score
    down, id up).  ``below``: for each case, the number of controls with a
    smaller score, from one ordered pass over cases and controls together.
    """

    def __init__(self, cases: DataFrame, controls: DataFrame):
        ctl = controls.select(F.col("id").alias("control_id"), F.col("score").alias("c_score"))
        self.up = positions(ctl, [F.col("c_score").asc(), F.col("control_id").asc()], out="r_up")
        self.down = positions(ctl, [F.col("c_score").desc(), F.col("control_id").asc()], out="r_down")
        self.n = self.up.count()
        both = (cases.select(F.col("id"), F.col("score"), F.lit(0).alias("kind"))
                .unionByName(ctl.select(F.col("control_id").alias("id"), F.col("c_score").alias("score"),
                                        F.lit(1).alias("kind"))))
        ordered = positions(both, [F.col("score").asc(), F.col("kind").asc(), F.col("id").asc()],
                            out="__u", running={"below": F.col("kind")})
        self.cases = cut_lineage(ordered.filter(F.col("kind") == 0).select(
            F.col("id").alias("case_id"), F.col("score").alias("t_score"), F.col("below").cast("long")))

    def candidates(self, k: int) -> DataFrame:
        """Each case's ``k`` nearest controls by (distance, control id): the
        first ``k`` to the right (``r_up`` = below+1 ..) and to the left
        (``r_down`` = n-below+1 ..), found by equi-joins on those numbers;
        then the best ``k`` of the at most ``2k``."""
        cs = self.cases.withColumn("__k", F.lit(int(k)))

        def seq(lo, hi):
            return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<long>"))

        n = F.lit(self.n).cast("long")
        kk = F.col("__k").cast("long")
        right = seq(F.col("below") + 1, F.least(F.col("below") + kk, n))
        left = seq(n - F.col("below") + 1, F.least(n - F.col("below") + kk, n))
        r = cs.withColumn("r_up", F.explode(right)).join(self.up, "r_up")
        l_ = cs.withColumn("r_down", F.explode(left)).join(self.down, "r_down")
        cols = ["case_id", "t_score", "__k", "control_id", "c_score"]
        cand = r.select(*cols).unionByName(l_.select(*cols))
        cand = cand.withColumn("dist", F.abs(F.col("c_score") - F.col("t_score")))
        w = Window.partitionBy("case_id").orderBy(F.col("dist").asc(), F.col("control_id").asc())
        cand = cand.withColumn("cand_rank", F.row_number().over(w)).filter(F.col("cand_rank") <= F.col("__k"))
        return cand.select("case_id", "control_id", "dist", "cand_rank")


def nearest_controls(cases: DataFrame, controls: DataFrame, k: int) -> DataFrame:
    """For each case ``(id, score)`` its ``k`` nearest controls ``(id, score)``
    by (distance, control id): ``case_id, control_id, dist, cand_rank``."""
    return ControlIndex(cases, controls).candidates(k)


# --- one round of serial greedy, block by block --------------------------------

BLOCK_ROWS = 50_000         # cases and controls of one block
_IN = "block long, kind int, ord long, id long, score double, own boolean"
_OUT = ("block long, kind int, ord long, case_id long, control_id long, score double, "
        "taken long, pointer long, tail long, middle long, head long, looked long, tied long, near array<long>")
#: ids of a block's leftovers that the driver knows
KNOWN = 256
CASE, BELOW, ABOVE = 0, 1, 2        # kinds of input rows
MATCH, LEFT, SUMMARY = 0, 1, 2      # kinds of output rows


def _run_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block against the state it expects: its cases in order, the controls
    from the pointer on (falling scores), the stack's top (nearest first)."""
    block = int(pdf["block"].iloc[0])
    pdf = pdf.sort_values("ord")
    cases = pdf[pdf["kind"] == CASE]
    below, above = pdf[pdf["kind"] == BELOW], pdf[pdf["kind"] == ABOVE]
    b_id, b_score, b_ord = below["id"].tolist(), below["score"].tolist(), below["ord"].tolist()
    n_own = int(below["own"].sum())                     # own controls come first
    stack = [(i, s, False) for i, s in zip(above["id"].tolist()[::-1], above["score"].tolist()[::-1])]
    at, taken, looked, tied, pointer = 0, 0, 0, 0, 0
    rows = []

    def passed(limit: float | None) -> None:
        """Own controls above ``limit`` go on the stack, the smallest id of a score on top."""
        nonlocal at, tied
        while at < n_own and (limit is None or b_score[at] > limit):
            end = at
            while end < n_own and b_score[end] == b_score[at]:
                end += 1
            where = len(stack)
            while where and stack[where - 1][1] == b_score[at]:     # a tie that began in earlier blocks: smaller ids
                where -= 1
            if not any(own for *_, own in stack[where - 1:]):
                tied = taken + len(stack) - where + 1       # as many were looked at for a tie
            stack[where:where] = [(b_id[k], b_score[k], True) for k in range(end - 1, at - 1, -1)]
            at = end

    for order, case, s in zip(cases["ord"].tolist(), cases["id"].tolist(), cases["score"].tolist()):
        passed(s)
        up = (abs(stack[-1][1] - s), stack[-1][0]) if stack else None
        if not stack or not stack[-1][2]:
            looked = taken + 1
        down = (abs(b_score[at] - s), b_id[at]) if at < len(b_id) else None
        if up is None and down is None:
            continue
        if down is None or (up is not None and up < down):
            control, _, own = stack.pop()
            taken += not own
            dist = up[0]
        else:
            control, dist, pointer = b_id[at], down[0], b_ord[at]
            at += 1
        rows.append((block, MATCH, order, case, control, dist, 0, 0, 0, 0, 0, 0, 0, None))
    first, last = (b_score[0], b_score[n_own - 1]) if n_own else (None, None)
    passed(None)
    left = [(i, s) for i, s, own in reversed(stack) if own]
    rows += [(block, LEFT, k, 0, i, s, 0, 0, 0, 0, 0, 0, 0, None) for k, (i, s) in enumerate(left, 1)]
    tail = sum(s == last for _, s in left)
    head = 0 if first == last else sum(s == first for _, s in left)
    rows.append((block, SUMMARY, 0, 0, 0, 0.0, taken, pointer, tail, len(left) - tail - head, head, looked,
                 tied, [i for i, _ in left[:KNOWN]]))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])


@dataclass
class _Block:
    """What the driver knows of a block: numbers only."""
    n_cases: int
    first: int                       # rank from the top of its first control (0: none)
    last: int
    high: float | None               # scores of its first and last control
    low: float | None
    found: tuple | None = None       # the state it last ran against
    version: int = -1
    out: tuple = (0, 0, 0, 0, 0)     # taken, pointer, and what it leaves: tail, middle, head
    looked: int = 0                  # controls of the stack that it looked at
    shared: bool = False             # do its first control and the last one before it have one score?
    near: list[int] = field(default_factory=list)


@dataclass
class _Pieces:
    """The stack as pieces (block, version, first place, places, score of a tie or None), nearest last."""
    items: list[list] = field(default_factory=list)

    def top(self, n: int) -> tuple:
        out = []
        for block, version, first, size, _ in reversed(self.items):
            if n <= 0:
                break
            out.append((block, version, first, min(size, n)))
            n -= size
        return tuple(out)

    def ids(self, blocks: list[_Block], n: int) -> tuple:
        """Ids of the topmost controls as far as the driver knows them, ``n`` at most; None marks the stack's end."""
        out: list[int | None] = []
        for block, _, first, size, _ in reversed(self.items):
            known = blocks[block].near[first - 1:first - 1 + min(size, n - len(out))]
            out += known
            if len(known) < size or len(out) >= n:
                return tuple(out)
        return (*out, None)

    def pop(self, n: int) -> None:
        while n > 0 and self.items:
            p = self.items[-1]
            k = min(n, p[3])
            p[2], p[3], n = p[2] + k, p[3] - k, n - k
            if p[3] == 0:
                self.items.pop()

    def push(self, i: int, b: _Block) -> None:
        _, _, tail, middle, head = b.out
        at = 1
        pieces = []
        for size, score in ((tail, b.low), (middle, None), (head, b.high)):
            if size:
                pieces.append([i, b.version, at, size, score])
            at += size
        for k, p in enumerate(reversed(pieces)):        # the farthest first
            where = len(self.items)
            if k == 0 and p[4] is not None:
                # a tie that began in earlier blocks: their smaller ids are nearer
                while where and self.items[where - 1][4] == p[4]:
                    where -= 1
            self.items.insert(where, p)


def _mark_shared(blocks: list[_Block]) -> None:
    low = None
    for b in blocks:
        b.shared = low is not None and b.high == low
        low = b.low if b.low is not None else low


def _cut(top: tuple, n: int) -> list[tuple]:
    """The pieces that hold the first ``n`` controls of ``top``."""
    out = []
    for block, version, first, size in top:
        if n <= 0:
            break
        out.append((block, version, first, min(size, n)))
        n -= size
    return out


def _same(b: _Block, state: tuple) -> bool:
    """Would the block see what it saw when it last ran?"""
    if b.found is None or b.found[0] != state[0]:
        return False
    old, new = b.found[2][:b.looked], state[2][:b.looked]
    return old == new if len(old) == len(new) == b.looked else _cut(b.found[1], b.looked) == _cut(state[1], b.looked)


def _states(blocks: list[_Block]) -> tuple[list[tuple], list[int]]:
    """The state (first free rank, pieces of the stack's top, their known ids)
    each block finds if all before it do what they last reported, and the
    blocks that would see another one than they did."""
    stack, pointer, seen, out, wrong = _Pieces(), 0, 0, [], []
    for i, b in enumerate(blocks):
        start = max(pointer, seen, b.first - 1) + 1
        out.append((start, stack.top(b.n_cases), stack.ids(blocks, KNOWN)))
        end = b.out[1]
        if not _same(b, out[-1]):
            wrong.append(i)
            if end and b.found:                 # a guess for the blocks after it: as many controls, from the new start
                end += start - b.found[0]
        stack.pop(b.out[0])
        stack.push(i, b)
        pointer, seen = max(pointer, end), max(seen, b.last)
    return out, wrong


def _note(b: _Block, state: tuple, version: int, r) -> None:
    """What a block reports after running against ``state``."""
    b.found, b.version = state, version
    b.out = (r["taken"], r["pointer"], r["tail"], r["middle"], r["head"]) if r else (0, 0, 0, 0, 0)
    b.looked = max(r["looked"], r["tied"] if b.shared else 0) if r else 0
    b.near = list(r["near"]) if r else []


def _greedy_round(cases: DataFrame, controls: DataFrame, block_rows: int | None = None) -> DataFrame:
    """cases ``(id, score)``, controls ``(id, score)`` -> ``(case_id,
    control_id, dist)`` with each case and each control at most once."""
    spark = cases.sparkSession
    size = block_rows or BLOCK_ROWS
    both = (cases.select("id", "score", F.lit(0).alias("kind"))
            .unionByName(controls.select("id", "score", F.lit(1).alias("kind"))))
    order = [F.col("score").desc(), F.col("kind").asc(), F.col("id").asc()]
    rows = positions(both, order, out="rn", running={"rank": F.col("kind")})
    rows = cut_lineage(rows.select(F.floor((F.col("rn") - 1) / size).alias("block"), "kind", "rn", "id", "score",
                                   F.col("rank").cast("long").alias("rank")))
    control = F.col("kind") == 1
    info = rows.groupBy("block").agg(
        F.count_if(~control).alias("n"), F.min(F.when(control, F.col("rank"))).alias("first"),
        F.max(F.when(control, F.col("rank"))).alias("last"), F.max(F.when(control, F.col("score"))).alias("high"),
        F.min(F.when(control, F.col("score"))).alias("low")).orderBy("block").collect()      # rows / block size
    blocks = [_Block(r["n"], r["first"] or 0, r["last"] or 0, r["high"], r["low"]) for r in info]
    _mark_shared(blocks)
    n_ctl = max((b.last for b in blocks), default=0)
    ctl = rows.filter(control).select("rank", "id", "score")
    case_rows = rows.filter(~control).select("block", F.col("rn").alias("ord"), "id", "score")
    left: DataFrame | None = None
    outputs = []
    while True:
        states, todo = _states(blocks)
        if not todo:
            break
        need, pieces = [], []
        for i in todo:
            start, top, _ = states[i]
            b = blocks[i]
            end = min(n_ctl, max(b.last, start - 1) + b.n_cases)
            need.append((i, start, end, b.last))
            at = 0
            for j, version, first, n in top:
                pieces.append((i, j, version, first, n, at))
                at += n
        version = len(outputs)
        req = spark.createDataFrame(need, "block long, lo long, hi long, last long")
        want = (req.filter("lo <= hi").withColumn("rank", F.explode(F.sequence("lo", "hi")))
                .join(ctl, "rank").select("block", F.lit(BELOW).alias("kind"), F.col("rank").alias("ord"), "id", "score",
                                          (F.col("rank") <= F.col("last")).alias("own")))
        own = case_rows.join(req.select("block"), "block").select(
            "block", F.lit(CASE).alias("kind"), "ord", "id", "score", F.lit(False).alias("own"))
        feed = want.unionByName(own)
        if pieces:
            p = spark.createDataFrame(pieces, "to long, block long, version int, lo long, n long, at long")
            p = p.withColumn("ord", F.explode(F.sequence(F.col("lo"), F.col("lo") + F.col("n") - 1)))
            feed = feed.unionByName(p.join(left, ["block", "version", "ord"]).select(
                F.col("to").alias("block"), F.lit(ABOVE).alias("kind"), (F.col("ord") - F.col("lo") + F.col("at")).alias("ord"),
                "id", "score", F.lit(False).alias("own")))
        out = cut_lineage(feed.groupBy("block").applyInPandas(_run_block, _OUT).withColumn("version", F.lit(version)))
        outputs.append(out)
        got = {r["block"]: r for r in out.filter(F.col("kind") == SUMMARY).collect()}          # one row per block
        for i in todo:
            _note(blocks[i], states[i], version, got.get(i))
        new = out.filter(F.col("kind") == LEFT).select("block", "version", "ord", F.col("control_id").alias("id"), "score")
        left = new if left is None else left.unionByName(new)
    if not outputs:
        return spark.createDataFrame([], "case_id long, control_id long, dist double")
    valid = spark.createDataFrame([(i, b.version) for i, b in enumerate(blocks)], "block long, version int")
    every = outputs[0]
    for o in outputs[1:]:
        every = every.unionByName(o)
    return (every.filter(F.col("kind") == MATCH).join(valid, ["block", "version"])
            .select("case_id", "control_id", F.col("score").alias("dist")))


def match_pairs(df: DataFrame, treat: str, score: str, id_col: str, ratio: int = 1,
                replace: bool = False, block_rows: int | None = None) -> DataFrame:
    """ST6: ``(case_id, control_id, round, dist)`` pairs."""
    base = df.select(F.col(id_col).alias("id"), F.col(score).cast("double").alias("score"), F.col(treat).alias("t"))
    base = base.filter(F.col("score").isNotNull() & F.col("t").isNotNull())
    cases = base.filter(F.col("t")).select("id", "score")
    controls = base.filter(~F.col("t")).select("id", "score")
    if replace:
        c = nearest_controls(cases, controls, ratio)
        return c.select("case_id", "control_id", F.col("cand_rank").cast("int").alias("round"), "dist")
    out = None
    remaining = controls
    for r in range(1, ratio + 1):
        pr = cut_lineage(_greedy_round(cases, remaining, block_rows).withColumn("round", F.lit(r)))
        out = pr if out is None else out.unionByName(pr)
        remaining = cut_lineage(remaining.join(pr.select(F.col("control_id").alias("id")), "id", "left_anti"))
    return out


def matched_rows(df: DataFrame, pairs: DataFrame, treat: str, score: str, id_col: str,
                 digits: int | None = 6) -> DataFrame:
    """ST7: matched input rows with ``distance`` (the score), ``weights`` and
    ``subclass`` (the case's id).  Cases weigh 1; a control weighs 1 / (its
    case's number of controls), scaled so control weights sum to the number
    of matched controls."""
    per_case = pairs.groupBy("case_id").agg(F.count(F.lit(1)).alias("m"))
    ctl = pairs.join(per_case, "case_id").select(F.col("control_id").alias("__id"), F.col("case_id").alias("subclass"),
                                                 (1.0 / F.col("m")).alias("raw"))
    n, s = ctl.agg(F.count(F.lit(1)), F.sum("raw")).first()
    scale = (n / s) if s else 1.0
    ctl = ctl.select("__id", "subclass", (F.col("raw") * F.lit(float(scale))).alias("weights"))
    cs = per_case.select(F.col("case_id").alias("__id"), F.col("case_id").alias("subclass"), F.lit(1.0).alias("weights"))
    w = cs.unionByName(ctl)
    if digits is not None:
        w = w.withColumn("weights", F.round("weights", digits))
    out = df.join(w, df[id_col] == w["__id"]).drop("__id")
    return out.withColumn("distance", F.col(score).cast("double"))
