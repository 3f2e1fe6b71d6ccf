"""The isolation forest in SQL for DuckDB, grown level by level: the check of the forest queries.

One aggregation for each level finds the lowest and highest values of all nodes of all trees, one join sends their
rows on to the children; scoring walks all rows through all trees, one join for each level. Nothing here is shared with the
engine but the documented rules: which md5 decides a draw, a feature and a limit.
"""

from __future__ import annotations

from telemetra import rules
from telemetra.schemas import FEATURES

PRIME = 2**31 - 1
EULER = 0.5772156649015329
LEVELS = 8


def _hex(text: str, place: int) -> str:
    """A group of eight digits of a text's md5 as a number."""
    return f"CAST('0x' || substr(md5({text}), {1 + 8 * place}, 8) AS BIGINT)"


def _mean_path(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0e0 WHEN {n} = 2 THEN 1e0 ELSE 2e0 * (ln({n} - 1e0) + {EULER}) - 2e0 * ({n} - 1e0) / {n} END"


def forest(rows: str, name: str = "f") -> list[str]:
    """Common table expressions that end with ``<name>_nodes`` and ``<name>_scores`` for complete rows (row_id and features)."""
    values = ", ".join(f"CAST({feature} AS DOUBLE)" for feature in FEATURES)
    texts = ", ".join(f"CAST(CAST(x[{i + 1}] AS DECIMAL(38,6)) AS VARCHAR)" for i in range(len(FEATURES)))
    key = f"'{rules.SEED}|' || tree_id"
    low, high = (", ".join(f"{f}(x[{i + 1}])" for i in range(len(FEATURES))) for f in ("MIN", "MAX"))
    everything = list(range(1, len(FEATURES) + 1))
    ctes = [
        f"{name}_rows AS MATERIALIZED (SELECT row_id, [{values}] AS x FROM ({rows}) AS complete)",
        f"{name}_marked AS (SELECT *, {_hex(f'''concat_ws('|', CAST(row_id AS VARCHAR), {texts}, '1')''', 0)} % {PRIME} AS mark FROM {name}_rows)",
        f"""{name}_trees AS (
  SELECT tree_id, 1 + {_hex(key, 0)} % {PRIME - 1} AS a, {_hex(key, 1)} % {PRIME} AS b FROM range({rules.N_TREES}) AS t(tree_id))""",
        f"""{name}_members_0 AS MATERIALIZED (
  SELECT tree_id, CAST(0 AS BIGINT) AS node, x FROM {name}_marked, {name}_trees
  QUALIFY ROW_NUMBER() OVER (PARTITION BY tree_id ORDER BY (a * mark + b) % {PRIME}, row_id) <= {rules.MAX_SAMPLES})""",
        f"{name}_size AS MATERIALIZED (SELECT COUNT(*) AS n, CAST(ceil(log2(greatest(COUNT(*), 2))) AS INTEGER) AS levels FROM {name}_members_0 WHERE tree_id = 0)",
    ]
    for level in range(LEVELS + 1):
        node = f"{key} || '|' || node"
        ctes += [
            f"""{name}_split_{level} AS MATERIALIZED (
  SELECT tree_id, node, size, feature, CASE WHEN feature > 0 THEN CASE WHEN spot >= high[feature] THEN low[feature] ELSE spot END END AS threshold
  FROM (
    SELECT *, CASE WHEN feature > 0 THEN low[feature] + CAST({_hex(node, 1)} AS DOUBLE) / 4294967296e0 * (high[feature] - low[feature]) END AS spot
    FROM (
      SELECT *, CASE WHEN {level} < levels AND len(differ) > 0 THEN differ[1 + CAST(({_hex(node, 0)} * len(differ)) >> 32 AS INTEGER)] ELSE 0 END AS feature
      FROM (
        SELECT *, list_filter({everything}, lambda i: low[i] < high[i]) AS differ
        FROM (SELECT tree_id, node, COUNT(*) AS size, [{low}] AS low, [{high}] AS high FROM {name}_members_{level} GROUP BY tree_id, node) AS ranges
      ) AS found, {name}_size
    ) AS chosen
  ) AS placed)""",
            f"""{name}_members_{level + 1} AS MATERIALIZED (
  SELECT m.tree_id, 2 * m.node + CASE WHEN m.x[s.feature] <= s.threshold THEN 1 ELSE 2 END AS node, m.x
  FROM {name}_members_{level} m JOIN {name}_split_{level} s ON s.tree_id = m.tree_id AND s.node = m.node WHERE s.feature > 0)""",
        ]
    levels = " UNION ALL ".join(f"SELECT *, {level} AS depth FROM {name}_split_{level}" for level in range(LEVELS + 1))
    ctes.append(f"""{name}_nodes AS MATERIALIZED (
  SELECT CAST(tree_id AS INTEGER) AS tree_id, CAST(node AS INTEGER) AS node_id, CAST(feature - 1 AS INTEGER) AS feature, threshold,
    CAST(CASE WHEN feature > 0 THEN 2 * node + 1 ELSE -1 END AS INTEGER) AS "left", CAST(CASE WHEN feature > 0 THEN 2 * node + 2 ELSE -1 END AS INTEGER) AS "right",
    CAST(size AS INTEGER) AS size, CAST(depth AS INTEGER) AS depth, CASE WHEN feature = 0 THEN depth + {_mean_path("size")} END AS path_length
  FROM ({levels}) AS levels)""")
    ctes.append(f"{name}_at_0 AS MATERIALIZED (SELECT row_id, x, tree_id, 0 AS node FROM {name}_rows, {name}_trees)")
    for level in range(LEVELS):
        ctes.append(f"""{name}_at_{level + 1} AS MATERIALIZED (
  SELECT w.row_id, w.x, w.tree_id, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END AS node
  FROM {name}_at_{level} w JOIN {name}_nodes n ON n.tree_id = w.tree_id AND n.node_id = w.node WHERE n.feature >= 0)""")
    ends = " UNION ALL ".join(
        f"SELECT w.row_id, n.path_length FROM {name}_at_{level} w JOIN {name}_nodes n ON n.tree_id = w.tree_id AND n.node_id = w.node WHERE n.feature < 0"
        for level in range(LEVELS + 1)
    )
    # Twelve digits: sums in another order differ beyond, and equal rows must have equal scores.
    ctes += [
        f"""{name}_raw AS MATERIALIZED (
  SELECT row_id, round(pow(2e0, -SUM(path_length) / ({rules.N_TREES} * (SELECT {_mean_path("n")} FROM {name}_size))), 12) AS score
  FROM ({ends}) AS ends GROUP BY row_id)""",
        f"""{name}_scores AS MATERIALIZED (
  SELECT row_id, score, CAST(CASE WHEN score > (SELECT quantile_cont(score, {1 - rules.CONTAMINATION}) FROM {name}_raw) THEN {rules.ANOMALY} ELSE {rules.NORMAL} END AS INTEGER) AS prediction
  FROM {name}_raw)""",
    ]
    return ctes
