"""Oracle SQL of the statistical queries: Newton steps on grouped patterns as recursive CTEs.

A model's rows are grouped to cells (x1, x2, ..., y events, n rows).  Small
systems are solved by Cramer's rule; larger ones by Gauss-Jordan steps, one
nested SELECT per column.  Profile limits solve the score equations of the
other coefficients together with "log likelihood = its target" by the same
kind of step.
"""

from __future__ import annotations

from collections.abc import Sequence

Z = 1.959963984540054


def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    parts = []
    for c in range(len(m)):
        minor = [row[:c] + row[c + 1:] for row in m[1:]]
        parts.append(f"{'-' if c % 2 else '+'} {m[0][c]} * {_det(minor)}")
    return "(" + " ".join(parts).lstrip("+ ") + ")"


def _cramer(m: list[list[str]], r: list[str]) -> list[str]:
    d = _det(m)
    return [f"{_det([row[:c] + [r[i]] + row[c + 1:] for i, row in enumerate(m)])} / {d}" for c in range(len(m))]


def _sums(p: int, x: Sequence[str]) -> str:
    """Information s_i_j, gradient g_i and log likelihood ll at b0..."""
    eta = "(" + " + ".join(f"b{i} * {x[i]}" for i in range(p)) + ")"
    prob = f"(1 / (1 + exp(-{eta})))"
    out = [f"sum(n * {prob} * (1 - {prob}) * {x[i]} * {x[j]}) AS s{i}_{j}" for i in range(p) for j in range(i, p)]
    out += [f"sum((y - n * {prob}) * {x[i]}) AS g{i}" for i in range(p)]
    return ", ".join([*out, f"sum(y * {eta} - n * (greatest({eta}, 0) + ln(1 + exp(-abs({eta}))))) AS ll"])


def _info(p: int) -> list[list[str]]:
    return [[f"s{min(i, j)}_{max(i, j)}" for j in range(p)] for i in range(p)]


def _b(p: int) -> str:
    return ", ".join(f"b{i}" for i in range(p))


def profile_ctes(name: str, cells: str, terms: Sequence[str], label: str | None, p_sql, digits: int = 3) -> tuple[str, str]:
    """(CTEs, SELECT) of an odds-ratio table with profile limits; ``cells``: a query of x1.., y, n."""
    p = 1 + len(terms)
    x = ["1", *[f"x{i}" for i in range(1, p)]]
    bs, zeros = _b(p), ", ".join("CAST(0 AS DOUBLE)" for _ in range(p))
    step = _cramer(_info(p), [f"g{i}" for i in range(p)])
    unit = [_cramer(_info(p), ["1.0" if i == j else "0.0" for i in range(p)]) for j in range(p)]       # columns of the inverse
    rows = [[f"CASE WHEN j = {r} THEN g{c} ELSE {_info(p)[r][c]} END" for c in range(p)] for r in range(p)]
    right = [f"CASE WHEN j = {r} THEN target - ll ELSE g{r} END" for r in range(p)]
    move = _cramer([[f"m{r}_{c}" for c in range(p)] for r in range(p)], [f"m{r}_{p}" for r in range(p)])
    system = ", ".join(f"{e} AS m{r}_{c}" for r in range(p) for c, e in enumerate([*rows[r], right[r]]))
    start = " UNION ALL ".join(
        f"SELECT 0 AS i, {j} AS j, {side} AS side, ll - {Z} * {Z} / 2 AS target, "
        + ", ".join(f"b{k} + {side} * {Z} * {unit[j][k]} / sqrt({unit[j][j]}) AS b{k}" for k in range(p)) + f" FROM {name}_fin"
        for j in range(p) for side in (-1, 1))
    ctes = f"""
{name}_cell AS ({cells}),
{name}_it(i, {bs}) AS (SELECT 0, {zeros} UNION ALL
  SELECT i + 1, {', '.join(f'b{k} + {step[k]}' for k in range(p))}
  FROM (SELECT i, {bs}, {_sums(p, x)} FROM {name}_it, {name}_cell WHERE i < 25 GROUP BY i, {bs})),
{name}_fin AS (SELECT {bs}, {_sums(p, x)} FROM {name}_it, {name}_cell WHERE i = 25 GROUP BY {bs}),
{name}_pr(i, j, side, target, {bs}) AS ({start} UNION ALL
  SELECT i + 1, j, side, target, {', '.join(f'b{k} + {move[k]}' for k in range(p))}
  FROM (SELECT i, j, side, target, {bs}, {system}
        FROM (SELECT i, j, side, target, {bs}, {_sums(p, x)} FROM {name}_pr, {name}_cell WHERE i < 20
              GROUP BY i, j, side, target, {bs}))),
{name}_lim AS (SELECT j, max(CASE WHEN side < 0 THEN b END) AS lo, max(CASE WHEN side > 0 THEN b END) AS hi
  FROM (SELECT j, side, CASE j {' '.join(f'WHEN {k} THEN b{k}' for k in range(p))} END AS b FROM {name}_pr WHERE i = 20) GROUP BY j),
{name}_e AS ({' UNION ALL '.join(f"SELECT {k} AS j, '{t}' AS term, b{k} AS b, sqrt({unit[k][k]}) AS se FROM {name}_fin" for k, t in enumerate(['(Intercept)', *[t + 'TRUE' for t in terms]]))})"""
    head = f"'{label}' AS model, " if label else ""
    select = (f"SELECT {head}term, round(exp(b), {digits}) AS estimate, round(se, {digits}) AS std_error, "
              f"round(b / se, {digits}) AS statistic, round({p_sql('(b / se)')}, {digits}) AS p_value, "
              f"round(exp(lo), {digits}) AS conf_low, round(exp(hi), {digits}) AS conf_high, true AS converged "
              f"FROM {name}_e JOIN {name}_lim USING (j)")
    return ctes, select


def _eliminate(source: str, carry: Sequence[str], p: int, width: int) -> str:
    """Gauss-Jordan on columns m{r}_{c}: one nested SELECT per pivot."""
    q = source
    for k in range(p):
        cols = [(f"m{k}_{c} / m{k}_{k}" if r == k else f"m{r}_{c} - m{r}_{k} * m{k}_{c} / m{k}_{k}") + f" AS m{r}_{c}"
                for r in range(p) for c in range(k + 1, width)]
        q = f"SELECT {', '.join([*carry, *cols])} FROM ({q})"
    return q


def newton_ctes(name: str, cells: str, p: int, steps: int = 15) -> str:
    """CTEs of one model of p columns; ``<name>_fin`` holds its coefficients b0..."""
    x = ["1", *[f"x{i}" for i in range(1, p)]]
    bs = _b(p)
    system = ", ".join(f"{e} AS m{r}_{c}" for r in range(p) for c, e in enumerate([*_info(p)[r], f"g{r}"]))
    step = _eliminate(f"SELECT i, {bs}, {system} FROM (SELECT i, {bs}, {_sums(p, x)} FROM {name}_it, {name}_cell "
                      f"WHERE i < {steps} GROUP BY i, {bs})", ["i", *[f"b{k}" for k in range(p)]], p, p + 1)
    return f"""{name}_cell AS ({cells}),
{name}_it(i, {bs}) AS (SELECT 0, {', '.join('CAST(0 AS DOUBLE)' for _ in range(p))} UNION ALL
  SELECT i + 1, {', '.join(f'b{k} + m{k}_{p}' for k in range(p))} FROM ({step})),
{name}_fin AS (SELECT {bs} FROM {name}_it WHERE i = {steps})"""


def backward_sql(cells: str, terms: Sequence[tuple[str, Sequence[str]]], p_sql, digits: int = 3, steps: int = 12) -> str:
    """The backward AIC search: every subset of the terms (a bit mask) is fitted, then the path is walked.
    ``terms``: (name, labels of its columns); ``cells``: a query of x1.., y, n."""
    owner = [None, *[t for t, (_, labels) in enumerate(terms) for _ in labels]]
    labels = ["(Intercept)", *[lb for _, names in terms for lb in names]]
    p = len(labels)
    inc = ["1", *[f"((mask >> {owner[i]}) & 1)" for i in range(1, p)]]
    x = ["1", *[f"(x{i} * {inc[i]})" for i in range(1, p)]]
    bs = _b(p)

    def system(right: Sequence[str]) -> str:
        out = []
        for r in range(p):
            out += [f"{_info(p)[r][c]}{f' + 1 - {inc[r]}' if r == c and r else ''} AS m{r}_{c}" for c in range(p)]
        return ", ".join(out + list(right))

    newton = _eliminate(
        f"SELECT i, mask, {bs}, {system([f'g{r} AS m{r}_{p}' for r in range(p)])} FROM "
        f"(SELECT i, mask, {bs}, {_sums(p, x)} FROM it, cell WHERE i < {steps} GROUP BY i, mask, {bs})",
        ["i", "mask", *[f"b{k}" for k in range(p)]], p, p + 1)
    unit = [f"{1 if r == c else 0}.0 AS m{r}_{p + c}" for r in range(p) for c in range(p)]
    inverse = _eliminate(f"SELECT mask, {bs}, {system(unit)} FROM (SELECT mask, {bs}, {_sums(p, x)} FROM it, cell "
                         f"WHERE i = {steps} AND mask = (SELECT min(mask) FROM path WHERE depth = (SELECT max(depth) FROM path)) "
                         f"GROUP BY mask, {bs})", ["mask", *[f"b{k}" for k in range(p)]], p, 2 * p)
    n_cols = " + ".join(inc)
    every = (1 << len(terms)) - 1
    return f"""
WITH RECURSIVE cell AS ({cells}),
it(i, mask, {bs}) AS (SELECT 0, CAST(range AS INTEGER), {', '.join('CAST(0 AS DOUBLE)' for _ in range(p))} FROM range({every + 1})
  UNION ALL SELECT i + 1, mask, {', '.join(f'b{k} + m{k}_{p}' for k in range(p))} FROM ({newton})),
fit AS (SELECT mask, -2 * ll + 2 * ({n_cols}) AS aic FROM (SELECT mask, {_sums(p, x)} FROM it, cell WHERE i = {steps} GROUP BY mask)),
path(depth, mask, aic) AS (SELECT 0, mask, aic FROM fit WHERE mask = {every} UNION ALL
  SELECT path.depth + 1, arg_min(f.mask, f.aic), min(f.aic) FROM path JOIN fit f
    ON (f.mask & path.mask) = f.mask AND bit_count(path.mask) - bit_count(f.mask) = 1
  GROUP BY path.depth, path.mask, path.aic HAVING min(f.aic) < path.aic - 1e-12),
fin AS ({inverse}),
e AS ({' UNION ALL '.join(f"SELECT '{lb}' AS term, b{k} AS b, sqrt(m{k}_{p + k}) AS se FROM fin WHERE {inc[k]} = 1" for k, lb in enumerate(labels))})
SELECT term, round(exp(b), {digits}) AS estimate, round(se, {digits}) AS std_error, round(b / se, {digits}) AS statistic,
       round({p_sql('(b / se)')}, {digits}) AS p_value, round(exp(b - {Z} * se), {digits}) AS conf_low,
       round(exp(b + {Z} * se), {digits}) AS conf_high, true AS converged FROM e"""


def absorbed_sql(cells: str, terms: Sequence[str], steps: int = 25) -> str:
    """Newton steps with one effect per level ``lv``, the levels eliminated; ``cells``: lv, x1.., y, n."""
    p = len(terms)
    xs = [f"x{i}" for i in range(1, p + 1)]
    b = ", ".join(f"b{i}" for i in range(1, p + 1))
    eta = "(a + " + " + ".join(f"b{i} * x{i}" for i in range(1, p + 1)) + ")"
    prob = f"(1 / (1 + exp(-{eta})))"
    w = f"n * {prob} * (1 - {prob})"
    per = [f"sum({w}) AS d", f"sum(y - n * {prob}) AS g"]
    over = []
    for i in range(1, p + 1):
        per += [f"sum({w} * x{i}) AS v{i}", f"sum((y - n * {prob}) * x{i}) AS h{i}"]
        over.append(f"sum(h{i} - v{i} * g / d) OVER () AS g{i - 1}")
        for j in range(i, p + 1):
            per.append(f"sum({w} * x{i} * x{j}) AS c{i}_{j}")
            over.append(f"sum(c{i}_{j} - v{i} * v{j} / d) OVER () AS s{i - 1}_{j - 1}")
    step = _cramer(_info(p), [f"g{i}" for i in range(p)])
    unit = [_cramer(_info(p), ["1.0" if i == j else "0.0" for i in range(p)]) for j in range(p)]
    state = lambda cond: (f"SELECT *, {', '.join(over)} FROM (SELECT i, lv, a, {b}, {', '.join(per)} FROM it JOIN cell USING (lv) "  # noqa: E731
                          f"WHERE {cond} GROUP BY i, lv, a, {b})")
    back = " - ".join(["g", *[f"v{i} * ({step[i - 1]})" for i in range(1, p + 1)]])
    u = [f"(f.v{i} / f.d - z.v{i} / z.d)" for i in range(1, p + 1)]
    cov = [[f"f.k{i}_{j}" for j in range(p)] for i in range(p)]
    var = " + ".join(["1 / f.d + 1 / z.d", *[f"{cov[i][j]} * {u[i]} * {u[j]}" for i in range(p) for j in range(p)]])
    return f"""
WITH RECURSIVE cell AS ({cells}),
it(i, lv, a, {b}) AS (
  SELECT 0, lv, ln(sum(y) / (sum(n) - sum(y))), {', '.join('CAST(0 AS DOUBLE)' for _ in xs)} FROM cell GROUP BY lv
  HAVING sum(y) > 0 AND sum(y) < sum(n)
  UNION ALL SELECT i + 1, lv, a + ({back}) / d, {', '.join(f'b{i} + {step[i - 1]}' for i in range(1, p + 1))}
  FROM ({state(f'i < {steps}')})),
fin AS (SELECT *, {', '.join(f'{unit[j][i]} AS k{i}_{j}' for i in range(p) for j in range(p))} FROM ({state(f'i = {steps}')})),
z AS (SELECT * FROM fin ORDER BY lv LIMIT 1),
e AS (SELECT f.lv AS term, f.a - z.a AS b, sqrt({var}) AS se FROM fin f, z WHERE f.lv <> z.lv
      {' '.join(f"UNION ALL SELECT '{t}TRUE', b{i}, sqrt(k{i - 1}_{i - 1}) FROM z" for i, t in enumerate(terms, 1))})
SELECT term, round(b, 6) AS estimate, round(se, 6) AS std_error FROM e"""
