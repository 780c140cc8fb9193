"""DuckDB SQL building blocks for the oracle side of every checked query.

Each block is a named CTE over the pre-registered base tables; a query's SQL
is ``WITH <the blocks it needs> <body>``. Dependencies are resolved here so a
query names only what it reads.
"""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]})" for n in order]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


cte("hist", [], """
  SELECT o_custkey AS c_custkey,
         min(CASE WHEN o_orderdate < TIMESTAMP '2000-07-01' THEN o_orderdate END) AS first_order,
         count(CASE WHEN o_orderdate < TIMESTAMP '2000-07-01' THEN 1 END) AS n_hist,
         count(CASE WHEN o_orderdate < TIMESTAMP '2000-07-01'
                     AND o_orderdate >= TIMESTAMP '1999-07-01' THEN 1 END) AS n_recent,
         max(CASE WHEN o_orderdate < TIMESTAMP '2000-07-01' AND o_orderpriority LIKE '1%'
                  THEN 1 ELSE 0 END) AS has_card,
         max(CASE WHEN o_orderdate < TIMESTAMP '2000-07-01'
                   AND o_orderdate >= TIMESTAMP '2000-01-01' THEN 1 ELSE 0 END) AS active,
         sum(CASE WHEN o_orderdate < TIMESTAMP '2000-07-01'
                  THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS spend,
         max(CASE WHEN o_orderdate >= TIMESTAMP '2000-07-01' THEN 1 ELSE 0 END) AS has_later
  FROM orders GROUP BY o_custkey""")

cte("profile", ["hist"], """
  SELECT c.c_custkey AS CustomerId,
         CAST(350 + (c.c_custkey * 7919) % 501 AS INTEGER) AS CreditScore,
         r.r_name AS Geography,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
         CAST(18 + (c.c_custkey * 37) % 75 AS INTEGER) AS Age,
         CAST(2000 - year(h.first_order) AS INTEGER) AS Tenure,
         greatest(c.c_acctbal, 0.0) AS Balance,
         CAST(least(greatest(h.n_recent, 1), 4) AS INTEGER) AS NumOfProducts,
         CAST(h.has_card AS INTEGER) AS HasCrCard,
         CAST(h.active AS INTEGER) AS IsActiveMember,
         CAST(h.spend AS DOUBLE) / 6 AS EstimatedSalary,
         CAST(1 - h.has_later AS INTEGER) AS Exited
  FROM customer c
  JOIN hist h ON c.c_custkey = h.c_custkey AND h.n_hist > 0
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("ranked", ["profile"], """
  SELECT *, row_number() OVER (PARTITION BY Exited
                                ORDER BY md5('21:' || CAST(CustomerId AS VARCHAR)), CustomerId) AS rk,
         count(*) OVER (PARTITION BY Exited) AS n_label
  FROM profile""")

cte("split", ["ranked"], """
  SELECT * EXCLUDE (rk, n_label), rk <= floor(0.1 * n_label + 0.5) AS is_test FROM ranked""")

cte("train", ["split"], "SELECT * EXCLUDE (is_test) FROM split WHERE NOT is_test")
cte("test", ["split"], "SELECT * EXCLUDE (is_test) FROM split WHERE is_test")

cte("folds", ["train"], """
  SELECT *, CAST((row_number() OVER (PARTITION BY Exited
                   ORDER BY md5('21:' || CAST(CustomerId AS VARCHAR)), CustomerId) - 1) % 5
                 AS INTEGER) AS fold
  FROM train""")

cte("features", ["profile"], """
  SELECT *, Balance / (EstimatedSalary + 1) AS BalanceSalaryRatio,
         IsActiveMember * HasCrCard AS IsActive_by_CreditCard,
         NumOfProducts / (Tenure + 1) AS ProductsPerYear,
         CASE WHEN Age > 0 AND Age <= 35 THEN 'Young'
              WHEN Age > 35 AND Age <= 55 THEN 'Middle'
              WHEN Age > 55 AND Age <= 100 THEN 'Senior' ELSE 'nan' END AS AgeGroup
  FROM profile""")

cte("scored", ["profile"], """
  SELECT CustomerId, CAST(Exited AS INTEGER) AS y,
         floor((CAST(300.0 AS DOUBLE) * Exited + CAST(0.7 AS DOUBLE) * ((CustomerId * 7919) % 1000)) / 10) / 100 AS p
  FROM profile""")

cte("counts", ["scored"], """
  SELECT p AS threshold, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS pos,
         CAST(count(*) - sum(y) AS BIGINT) AS neg
  FROM scored GROUP BY p""")

cte("cum", ["counts"], """
  SELECT threshold, n, pos, neg,
         CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
         CAST(sum(pos) OVER () AS BIGINT) AS tot_pos, CAST(sum(neg) OVER () AS BIGINT) AS tot_neg
  FROM counts""")

cte("curve", ["cum"], """
  SELECT threshold, tp, fp,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tot_pos > 0 THEN tp / tot_pos ELSE 1.0 END AS recall
  FROM cum""")

cte("curve_f1", ["curve"], """
  SELECT *, 2 * (precision * recall) / (precision + recall + 1e-8) AS f1 FROM curve""")

cte("best", ["curve_f1"], """
  SELECT threshold, precision, recall, f1, recall >= 0.6 AS meets_floor
  FROM curve_f1 ORDER BY meets_floor DESC, f1 DESC, threshold ASC LIMIT 1""")

cte("decided", ["scored", "best"], """
  SELECT s.CustomerId, s.y AS actual, s.p AS probability,
         CAST(s.p >= (SELECT threshold FROM best) AS INTEGER) AS predicted
  FROM scored s""")

cte("auc", ["cum"], """
  SELECT CASE WHEN max(tot_pos) > 0 AND max(tot_neg) > 0
              THEN CAST(sum(pos * (2 * (tot_neg - fp) + neg)) AS DOUBLE)
                   / (2.0 * max(tot_pos) * max(tot_neg)) END AS roc_auc,
         max(tot_pos) AS positives, max(tot_neg) AS negatives
  FROM cum""")

cte("point", ["decided", "best"], """
  SELECT (SELECT threshold FROM best) AS threshold,
         CAST(count(CASE WHEN actual = 0 AND predicted = 0 THEN 1 END) AS BIGINT) AS tn,
         CAST(count(CASE WHEN actual = 0 AND predicted = 1 THEN 1 END) AS BIGINT) AS fp,
         CAST(count(CASE WHEN actual = 1 AND predicted = 0 THEN 1 END) AS BIGINT) AS fn,
         CAST(count(CASE WHEN actual = 1 AND predicted = 1 THEN 1 END) AS BIGINT) AS tp
  FROM decided""")

cte("point_metrics", ["point"], """
  SELECT threshold, tn, fp, fn, tp,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
         (tp + tn) / (tp + tn + fp + fn) AS accuracy
  FROM point""")


def calibration_bin_sql(col: str, n_bins: int = 10) -> str:
    edges = [repr(k / n_bins) for k in range(1, n_bins)]
    return "(" + " + ".join(f"CAST({col} > CAST({e} AS DOUBLE) AS INTEGER)" for e in edges) + ")"


# ---------------------------------------------------------------- feature table
# The test tables' categories (used only by the oracle side; the Spark side
# learns them at fit time): first alphabetical category dropped.
ORACLE_CATEGORIES = {
    "Geography": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "Gender": ["Male"],
    "AgeGroup": ["Senior", "Young"],
}
ORACLE_NUM = ["CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "EstimatedSalary",
              "BalanceSalaryRatio", "ProductsPerYear"]
ORACLE_PASS = ["HasCrCard", "IsActiveMember", "IsActive_by_CreditCard"]
ORACLE_NAMES = (ORACLE_NUM + [f"{c}_{v}" for c, vs in ORACLE_CATEGORIES.items() for v in vs]
                + ORACLE_PASS)

cte("train_features", ["train"], """
  SELECT *, Balance / (EstimatedSalary + 1) AS BalanceSalaryRatio,
         IsActiveMember * HasCrCard AS IsActive_by_CreditCard,
         NumOfProducts / (Tenure + 1) AS ProductsPerYear,
         CASE WHEN Age > 0 AND Age <= 35 THEN 'Young'
              WHEN Age > 35 AND Age <= 55 THEN 'Middle'
              WHEN Age > 55 AND Age <= 100 THEN 'Senior' ELSE 'nan' END AS AgeGroup
  FROM train""")

cte("fstats", ["train_features"], "SELECT " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}"
    for i, c in enumerate(ORACLE_NUM)) + " FROM train_features")

cte("ftab", ["train_features", "fstats"], "SELECT CustomerId, Exited, " + ", ".join(
    [f"(CAST({c} AS DOUBLE) - m{i}) / (CASE WHEN s{i} > 0 THEN s{i} ELSE 1.0 END) AS {c}"
     for i, c in enumerate(ORACLE_NUM)]
    + [f'CAST(COALESCE({c} = \'{v}\', false) AS DOUBLE) AS "{c}_{v}"'
       for c, vs in ORACLE_CATEGORIES.items() for v in vs]
    + [f"CAST({c} AS DOUBLE) AS {c}" for c in ORACLE_PASS]) + " FROM train_features, fstats")


def qcol(name: str) -> str:
    return f'"{name}"'


def sq_distance_sql(a: str, b: str) -> str:
    return " + ".join(f"({a}.{qcol(n)} - {b}.{qcol(n)}) * ({a}.{qcol(n)} - {b}.{qcol(n)})"
                      for n in ORACLE_NAMES)
