"""SQL that fits the logistic models itself: Newton steps as a chain of common table expressions.

Every step sums the weighted cross products and the gradient over the training rows of each model, and solves the
small system by Gauss-Jordan elimination on a list of lists. The system is positive definite, so no pivoting is needed.
"""

from __future__ import annotations

from clientele.oracle.base import with_bank
from clientele.oracle.profiles import _INPUTS, _metrics, ML

ORACLES: dict[str, str] = {}

_STEPS = 16  # far more than the step after which nothing changes any more
_N = len(_INPUTS) + 1
_Z = ["1.0", *[f"z{j}" for j in range(1, _N)]]


def _eliminated(inner: str, k: int) -> str:
    cell = f"CASE WHEN r = {k} THEN m[{k}][c] / m[{k}][{k}] ELSE m[r][c] - m[r][{k}] * m[{k}][c] / m[{k}][{k}] END"
    return f"SELECT model, b, [[{cell} for c in range(1, {_N + 2})] for r in range(1, {_N + 1})] AS m FROM ({inner}) e{k}"


def _step(before: str) -> str:
    margin = " + ".join(f"b[{j + 1}] * {z}" for j, z in enumerate(_Z))
    weighted = f"""SELECT *, w * p * (1 - p) AS v, w * (y - p) AS g
        FROM (SELECT z.*, b, 1 / (1 + exp(-({margin}))) AS p FROM z JOIN {before} USING (model)) q"""
    lines = []
    for i, zi in enumerate(_Z):
        cells = [f"sum(v * {zi} * {zj})" + (" + 1.0" if i == j and i else "") for j, zj in enumerate(_Z)]
        slope = f"sum(g * {zi})" + (f" - any_value(b)[{i + 1}]" if i else "")
        lines.append(f"[{', '.join([*cells, slope])}]")
    system = f"SELECT model, any_value(b) AS b, [{', '.join(lines)}] AS m FROM ({weighted}) s GROUP BY model"
    for k in range(1, _N + 1):
        system = _eliminated(system, k)
    return f"SELECT model, [b[i] + m[i][{_N + 1}] for i in range(1, {_N + 1})] AS b FROM ({system}) f"


def fitted(rows: str, trained: str, final: str, **more: str) -> str:
    """``final`` over ``rows`` (everything), ``scaler``, ``fit`` (``model``, ``b``) and the expressions in ``more``.

    ``trained`` selects model, y and the inputs x1, x2, ... of the training rows from ``rows``.
    """
    moments = ", ".join(f"avg(x{j}) AS m{j}, coalesce(stddev_samp(x{j}), 0) AS d{j}" for j in range(1, _N))
    scaled = ", ".join(f"coalesce((x{j} - m{j}) / nullif(d{j}, 0), 0) AS z{j}" for j in range(1, _N))
    parts = {
        "rows": rows, "trained": trained,
        "scaler": f"SELECT model, count(*) AS n, sum(y) AS pos, {moments} FROM trained GROUP BY model",
        "z": f"""SELECT t.model, y, CASE WHEN y = 1 THEN n / (2 * greatest(pos, 1)) ELSE n / (2 * greatest(n - pos, 1)) END AS w, {scaled}
            FROM trained t JOIN scaler s ON s.model = t.model""",
        "b0": f"SELECT model, [{', '.join(['0.0::DOUBLE'] * _N)}] AS b FROM scaler",
        **{f"b{i}": _step(f"b{i - 1}") for i in range(1, _STEPS)},
        "fit": f"SELECT * FROM b{_STEPS - 1}", **more,
    }
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in parts.items()) + f"\n{final}"


def probability(row: str = "r") -> str:
    """Of a row joined with ``scaler`` s and ``fit`` f of its model."""
    terms = " + ".join(f"f.b[{j + 1}] * coalesce(({row}.x{j} - s.m{j}) / nullif(s.d{j}, 0), 0)" for j in range(1, _N))
    return f"1 / (1 + exp(-(f.b[1] + {terms})))"


_VALUES = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS x{j + 1}" for j, c in enumerate(_INPUTS))
_X = ", ".join(f"x{j}" for j in range(1, _N))
_SPLIT = with_bank(
    f"""SELECT l.customer_id, l.churn_flag, CAST(l.churn_flag AS DOUBLE) AS y, r <= ceil(n * CAST(0.2 AS DOUBLE)) AS is_test, 0 AS model, {_VALUES}
    FROM labelled l JOIN ranked k ON k.customer_id = l.customer_id""", **ML)
_TRAIN = f"SELECT model, y, {_X} FROM rows WHERE NOT is_test"
_ALL_SCORES = f"""SELECT r.*, {probability()} AS s FROM rows r JOIN scaler s ON s.model = r.model JOIN fit f ON f.model = r.model"""
_TEST = {
    "everyone": _ALL_SCORES, "scored": "SELECT churn_flag, s, s > 0.5 AS said FROM everyone WHERE is_test", "steps": ML["steps"],
}
_LONG = ", ".join(f"('{c}', {j + 2})" for j, c in enumerate(_INPUTS))


def _folds(source: str) -> str:
    return with_bank(
        f"""SELECT l.customer_id, l.churn_flag, CAST(l.churn_flag AS DOUBLE) AS y, CAST((r - 1) % 5 AS INT) AS model, {_VALUES}
        FROM labelled l JOIN ranked k ON k.customer_id = l.customer_id""", **{**ML, "labelled": source})


_OTHERS = f"SELECT m AS model, y, {_X} FROM rows, (SELECT unnest(range(5))::INT AS m) WHERE m <> model"
#: Per fold: area under the curve by rank sum, and the ratios of the confusion table; then their means.
_FOLD_MEANS = """
SELECT round(avg(coalesce(auc, 0.5)), 3) AS auc, round(avg(recall), 3) AS recall, round(avg(precision), 3) AS precision, round(avg(f1), 3) AS f1
FROM (
  SELECT model, coalesce(CAST(tp AS DOUBLE) / nullif(pos, 0), 0) AS recall, coalesce(CAST(tp AS DOUBLE) / nullif(sd, 0), 0) AS precision,
    coalesce(2.0 * tp / nullif(pos + sd, 0), 0) AS f1,
    (SELECT sum(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0.0 END) / nullif(count(*), 0)
     FROM everyone a JOIN everyone b ON a.model = b.model AND a.churn_flag = 1 AND b.churn_flag = 0 WHERE a.model = c.model) AS auc
  FROM (SELECT model, count(*) FILTER (WHERE churn_flag = 1) AS pos, count(*) FILTER (WHERE s > 0.5) AS sd,
          count(*) FILTER (WHERE s > 0.5 AND churn_flag = 1) AS tp FROM everyone GROUP BY model) c) m"""

ORACLES["ml5_logistic"] = ORACLES["ml14_production_model"] = fitted(_SPLIT, _TRAIN, _metrics("scored"), **_TEST)
ORACLES["ml15_scores"] = fitted(
    _SPLIT, _TRAIN, "SELECT customer_id, churn_flag, is_test, round(s, 6) AS score, CAST(s > 0.5 AS INT) AS prediction FROM everyone",
    everyone=_ALL_SCORES)
ORACLES["ml15_coefficients"] = fitted(
    _SPLIT, _TRAIN, f"SELECT variable, round(b[spot], 6) + 0.0 AS coefficient FROM fit, (VALUES {_LONG}) t(variable, spot)")
ORACLES["ml4_scaled_features"] = fitted(
    _SPLIT, _TRAIN, """
SELECT is_test, CAST(spot AS INT) AS rang, round(avg(v[spot + 1]), 6) + 0.0 AS moyenne, round(stddev_samp(v[spot + 1]), 6) AS ecart_type
FROM values_of, (SELECT unnest(range(9)) AS spot) GROUP BY ALL""",
    values_of="SELECT r.is_test, [" + ", ".join(f"coalesce((x{j} - m{j}) / nullif(d{j}, 0), 0)" for j in range(1, _N))
    + "] AS v FROM rows r JOIN scaler s ON s.model = r.model")
_SLOPES = ", ".join(
    f"round(sum(w * (y - p) * {z})" + (f" - any_value(b)[{j + 1}]" if j else "") + f", 6) + 0.0 AS g{j}" for j, z in enumerate(_Z))
ORACLES["ml5_gradient"] = fitted(
    _SPLIT, _TRAIN, f"SELECT variable, g[spot] AS gradient FROM (SELECT [{', '.join(f'g{j}' for j in range(_N))}] AS g FROM slopes), "
    f"(VALUES ('(intercept)', 1), {_LONG}) t(variable, spot)",
    slopes=f"""SELECT {_SLOPES} FROM (SELECT z.*, b, 1 / (1 + exp(-({' + '.join(f'b[{j + 1}] * {z}' for j, z in enumerate(_Z))}))) AS p
        FROM z JOIN fit USING (model)) q""")
_EDGES = ", ".join(f"quantile_cont(s, {i / 10})" for i in range(11))
ORACLES["ml15_train_test_psi"] = fitted(
    _SPLIT, _TRAIN, """
SELECT round(CASE WHEN (SELECT len(e) FROM edges) < 3 THEN 0.0 ELSE sum((cur - ref) * ln(cur / ref)) END, 4) AS psi
FROM (SELECT greatest(coalesce(r, 0) / sum(r) OVER (), 1e-4) AS ref, greatest(coalesce(c, 0) / sum(c) OVER (), 1e-4) AS cur
  FROM (SELECT bin, CAST(count(*) FILTER (WHERE NOT is_test) AS DOUBLE) AS r, CAST(count(*) FILTER (WHERE is_test) AS DOUBLE) AS c
        FROM binned GROUP BY bin) n) x""",
    everyone=_ALL_SCORES, edges=f"SELECT list_sort(list_distinct([{_EDGES}])) AS e FROM everyone WHERE NOT is_test",
    binned="SELECT is_test, len(list_filter(e[2:len(e) - 1], lambda x: x < s)) AS bin FROM everyone, edges")
ORACLES["ml11_cross_validation"] = fitted(_folds(ML["labelled"]), _OTHERS, _FOLD_MEANS, everyone=_ALL_SCORES)
ORACLES["ml11_held_out_scores"] = fitted(
    _folds(ML["labelled"]), _OTHERS,
    "SELECT customer_id, model AS fold, round(s, 6) AS score, CAST(s > 0.5 AS INT) AS prediction FROM everyone", everyone=_ALL_SCORES)
#: What the exported nodes of a tree model must give: the model's own scores and classes, for every customer.
for _name in ("ml6_node_scores", "ml7_node_scores"):
    ORACLES[_name] = with_bank(
        "SELECT customer_id, r <= ceil(n * CAST(0.2 AS DOUBLE)) AS is_test, 0.0::DOUBLE AS ecart, TRUE AS meme_classe FROM ranked", **ML)
