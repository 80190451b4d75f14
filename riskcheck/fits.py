"""SQL that fits models from the tables, for comparison with the fitted ones.

Trees: two levels of greedy splits over every distinct value of a few features. Logistic
regression: Newton's method in three unknowns, unrolled.
"""

from __future__ import annotations

from collections.abc import Sequence

#: Line items with the return flag as label and weights that balance the classes.
LINES = """counted AS (SELECT count(*) AS n, sum(CAST(l_returnflag = 'R' AS DOUBLE)) AS n1 FROM lineitem),
src AS (SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_returnflag = 'R' AS DOUBLE) AS y,
  CASE WHEN l_returnflag = 'R' THEN n / (2 * n1) ELSE n / (2 * (n - n1)) END AS w,
  CAST(l_quantity AS DOUBLE) AS f0, CAST(l_discount AS DOUBLE) AS f1, CAST(l_tax AS DOUBLE) AS f2
  FROM lineitem, counted)"""
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def tree_ctes(stats: str, worth: str, able: str, least: float, features: int = 3) -> str:
    """CTEs up to ``best1``, ``best2`` (the splits: node, feature, value, gain) and ``leaf`` (id, node, a, b).

    ``stats`` gives a row's a and b, ``worth`` the worth of sums {a}, {b}; a split gains the
    worth of its sides less that of the node, at least ``least``; ``able`` is its condition.
    """
    parts = [f"row1 AS (SELECT id, 1 AS node, {', '.join(f'f{i}' for i in range(features))}, {stats} FROM src)"]
    for level in (1, 2):
        cells = " UNION ALL ".join(f"SELECT node, {i} AS feature, f{i} AS value, a, b FROM row{level}" for i in range(features))
        upto = "OVER (PARTITION BY node, feature ORDER BY value)"
        whole = "OVER (PARTITION BY node, feature)"
        gain = f"{worth.format(a='la', b='lb')} + {worth.format(a='(ta - la)', b='(tb - lb)')} - {worth.format(a='ta', b='tb')}"
        right = "CASE best.feature " + " ".join(f"WHEN {i} THEN row.f{i}" for i in range(features)) + " END"
        parts += [
            f"cell{level} AS (SELECT node, feature, value, sum(a) AS a, sum(b) AS b, count(*) AS n FROM ({cells}) GROUP BY node, feature, value)",
            f"""cum{level} AS (SELECT node, feature, value, sum(a) {upto} AS la, sum(b) {upto} AS lb, sum(n) {upto} AS ln,
  sum(a) {whole} AS ta, sum(b) {whole} AS tb, sum(n) {whole} AS tn FROM cell{level})""",
            f"""best{level} AS (SELECT node, feature, value, gain FROM (SELECT *, {gain} AS gain FROM cum{level} WHERE ln < tn AND {able})
  WHERE gain >= {least} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, value) = 1)""",
            f"""row{level + 1} AS (SELECT row.* REPLACE (CASE WHEN best.node IS NULL THEN row.node
  WHEN {right} > best.value THEN 2 * row.node + 1 ELSE 2 * row.node END AS node) FROM row{level} AS row LEFT JOIN best{level} AS best USING (node))"""]
    parts.append("leaf AS (SELECT id, node, sum(a) OVER (PARTITION BY node) AS a, sum(b) OVER (PARTITION BY node) AS b FROM row3)")
    return ",\n".join(parts)


GINI = tree_ctes("w * y AS a, w AS b", "({a} * {a} + ({b} - {a}) * ({b} - {a})) / {b}", "TRUE", 0)


def penalised(l1: float, l2: float, gamma: float, least: float) -> str:
    """The first tree of boosting with penalties, from margins of 0."""
    worth = f"(greatest(abs({{a}}) - {l1}, 0) * greatest(abs({{a}}) - {l1}, 0) / ({{b}} + {l2}))"
    return tree_ctes("w * (0.5 - y) AS a, w * 0.25 AS b", worth, f"lb >= {least} AND tb - lb >= {least}", gamma)


def told(probability: str, source: str, key: str = "event_id") -> str:
    """prediction, rounded probability and band as a scored table has them."""
    return f"""SELECT id AS {key}, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
  round(p, 6) AS risk_probability, CASE WHEN p > 0.5 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS risk_band
FROM (SELECT id, {probability} AS p FROM {source})"""


def newton(train: str, steps: int = 9, unknowns: Sequence[str] = ("1.0", "x1", "x2")) -> str:
    """CTEs up to ``fit`` (b0, b1, b2): weighted maximum likelihood over ``train`` (y, w, x1, x2)."""
    margin = "b0 + b1 * x1 + b2 * x2"
    parts = ["step0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    for i in range(steps):
        gradient = ", ".join(f"sum(w * (y - p) * {u}) AS g{j}" for j, u in enumerate(unknowns))
        hessian = ", ".join(f"sum(w * p * (1 - p) * {unknowns[j]} * {unknowns[k]}) AS h{j}{k}" for j in range(3) for k in range(j, 3))
        det = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
        parts += [
            f"sums{i} AS (SELECT {gradient}, {hessian} FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM {train}, step{i}))",
            f"""step{i + 1} AS (SELECT
  b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / {det} AS b0,
  b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / {det} AS b1,
  b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / {det} AS b2
  FROM step{i}, sums{i})"""]
    return ",\n".join([*parts, f"fit AS (SELECT * FROM step{steps})"])
