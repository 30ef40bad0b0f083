"""DuckDB SQL for the least-squares oracle: another form than the engine's, a
regression on u = x - mean and then on the part of u² that u leaves over."""


def moments_sql(src: str, group: str, x: str, y: str) -> str:
    """CTE body; ``cf`` has one row per group: m_n and what ``predicted`` uses."""
    return f"""
pp AS (SELECT {group}, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {src}
       WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
sc AS (SELECT {group}, avg(x) AS xm, avg(y) AS ym, count(*)::DOUBLE AS m_n, count(DISTINCT x) AS nd FROM pp GROUP BY {group}),
pu AS (SELECT {group}, x - xm AS u, y FROM pp JOIN sc USING ({group})),
s1 AS (SELECT {group}, sum(u * u) AS su2, sum(u * u * u) AS su3, sum(u * y) AS suy, avg(u * u) AS q0 FROM pu GROUP BY {group}),
pq AS (SELECT {group}, u * u - q0 - (CASE WHEN su2 > 0 THEN u * su3 / su2 ELSE 0.0 END) AS q, y FROM pu JOIN s1 USING ({group})),
s2 AS (SELECT {group}, sum(q * q) AS sqq, sum(q * y) AS sqy FROM pq GROUP BY {group}),
cf AS (SELECT {group}, m_n, xm, ym, q0,
              CASE WHEN nd >= 2 THEN suy / su2 ELSE 0.0 END AS b1, CASE WHEN nd >= 2 THEN su3 / su2 ELSE 0.0 END AS q1,
              CASE WHEN nd >= 3 THEN sqy / sqq ELSE 0.0 END AS b2
       FROM sc JOIN s1 USING ({group}) JOIN s2 USING ({group}))"""


def predicted(x: str) -> str:
    u = f"(({x}) - cf.xm)"
    return f"greatest(0.0, cf.ym + cf.b1 * {u} + cf.b2 * ({u} * {u} - cf.q0 - cf.q1 * {u}))"
