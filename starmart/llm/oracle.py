"""SQL equivalents for DuckDB of the corpus queries that SQL can express."""

from starmart.llm.clustering import SCALE, Lloyd


def cluster_sql(plan: Lloyd = Lloyd()) -> str:
    """Rounds of plain Lloyd, one after the other; whole numbers in doubles, which hold them exactly at these sizes."""
    squared = "list_inner_product(x, x) - 2 * list_inner_product(x, m) + list_inner_product(m, m)"
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda e: floor({SCALE} * CAST(e AS DOUBLE))) AS x
  FROM embeddings
  WHERE len(embedding) = {plan.dims} AND len(list_filter(embedding, lambda e: isfinite(e))) = {plan.dims}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY hash, x) - 1 AS c, x AS m
  FROM (SELECT *, sha256('{plan.seed}:' || vec_id) AS hash FROM v) ORDER BY hash, x LIMIT {plan.k}
)""",
    ]
    for i in range(plan.rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, min(d * {plan.k} + c) AS code FROM (SELECT r, c, {squared} AS d FROM v CROSS JOIN c{i}) GROUP BY r
)"""
        )
        if i < plan.rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY j) AS m FROM (
      SELECT CAST(code % {plan.k} AS BIGINT) AS c, j, sum(x[j]) AS s, count(*) AS n
      FROM a{i} JOIN v USING (r) CROSS JOIN (SELECT unnest(range(1, {plan.dims + 1})) AS j) GROUP BY ALL
    ) GROUP BY c
  ) n USING (c)
)"""
            )
    last = plan.rounds
    return f"""WITH {", ".join(steps)},
found AS MATERIALIZED (
  SELECT vec_id, CAST(code % {plan.k} AS BIGINT) AS c, CAST(floor(code / {plan.k}) AS BIGINT) AS distance
  FROM a{last} JOIN v USING (r)
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(m, lambda e: CAST(e AS BIGINT)), ',')) AS centroid_sha256
FROM found JOIN c{last} USING (c)"""


def all_oracles() -> dict[str, str]:
    return {"op11_cluster": cluster_sql()}
