"""Shared pieces of the SQL counterparts."""


def half_up(expression: str, decimals: int) -> str:
    """Decimal rounding, half away from zero, of a double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(34, 16)), {decimals}) AS DOUBLE)"


SALES = """
WITH units AS (
    SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS units FROM lineitem GROUP BY l_orderkey
), sold AS (
    SELECT o.*, u.units, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount
    FROM orders o JOIN units u ON l_orderkey = o_orderkey
), visited AS (
    SELECT o_custkey AS cust, s_nationkey AS nk, max(o_orderdate) AS last_order
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY ALL
), principal AS (
    SELECT cust, nk FROM visited
    QUALIFY row_number() OVER (PARTITION BY cust ORDER BY last_order DESC, nk) = 1
), city AS (
    SELECT n_nationkey AS nk, n_name AS ciudad, r_name AS plain, replace(r_name, 'A', 'Á') AS accented,
        CASE WHEN n_nationkey % 7 <> 6 THEN -55e0 + 1.3e0 * n_nationkey END AS lat,
        CASE WHEN n_nationkey % 7 <> 6 THEN -70e0 + 0.7e0 * n_nationkey END AS lon,
        CASE WHEN n_nationkey % 10 <> 9 THEN CAST(1000 + 137 * n_nationkey AS INTEGER) END AS population
    FROM nation JOIN region ON n_regionkey = r_regionkey
), located AS (
    SELECT s.*, c.* FROM sold s LEFT JOIN principal p ON p.cust = o_custkey LEFT JOIN city c ON c.nk = p.nk
), by_city AS (
    SELECT ciudad, upper(plain) AS provincia, 'Argentina' AS pais, any_value(lat) AS latitud,
        any_value(lon) AS longitud, any_value(population) AS population,
        count(DISTINCT cust) AS clientes_unicos, count(o_orderkey) AS total_pedidos,
        CAST(sum(amount) AS DOUBLE) AS revenue_total,
        CAST(sum(amount) AS DOUBLE) / count(amount) AS ticket_promedio
    FROM principal p JOIN city c ON c.nk = p.nk LEFT JOIN sold ON o_custkey = cust
    GROUP BY ciudad, plain
)
"""

MARKET = (
    SALES
    + f""", rated AS (
    SELECT *, CAST(total_pedidos AS DOUBLE) / population AS rate FROM by_city WHERE population > 0
), national AS (
    SELECT CAST(sum(total_pedidos) AS DOUBLE) / sum(population) AS national_rate,
        sum(revenue_total) / sum(total_pedidos) AS national_ticket,
        quantile_cont(rate, 0.25) AS p25, quantile_cont(rate, 0.75) AS p75, median(population) AS middle
    FROM rated
), market AS (
    SELECT ciudad, provincia, pais, latitud, longitud, population, total_pedidos, clientes_unicos,
        revenue_total, ticket_promedio, {half_up("rate", 6)} AS tasa_penetracion,
        {half_up("revenue_total / population", 2)} AS revenue_per_capita,
        CASE WHEN rate < national_rate
            THEN {half_up("(national_rate - rate) * population * national_ticket", 2)} ELSE 0e0
        END AS revenue_potencial_incremental,
        {half_up("national_rate", 6)} AS tasa_penetracion_nacional,
        {half_up("national_ticket", 2)} AS ticket_promedio_nacional,
        CASE WHEN population >= middle AND rate >= p75 THEN 'Vaca lechera'
            WHEN population >= middle AND rate < p25 THEN 'Gigante dormido'
            WHEN population < middle AND rate >= p75 THEN 'Nicho fiel'
            ELSE 'Sin foco' END AS cuadrante_estrategico
    FROM rated, national
)
"""
)

CATALOGUE = """
WITH sold AS (
    SELECT o_orderpriority AS canal, l_partkey AS part, l_orderkey,
        CAST(l_quantity AS BIGINT) AS units, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), catalogue AS (
    SELECT CAST(substr(canal, 1, 1) AS INTEGER) AS canal_id, canal, part AS producto_id_origen,
        p_name AS nombre, p_brand AS categoria_id, count(DISTINCT l_orderkey) AS total_pedidos,
        CAST(sum(units) AS BIGINT) AS total_unidades, CAST(sum(amount) AS DOUBLE) AS revenue_total,
        CAST(min(amount) AS DOUBLE) AS precio_min, CAST(max(amount) AS DOUBLE) AS precio_max,
        CAST(sum(amount) AS DOUBLE) / count(amount) AS precio_promedio
    FROM sold JOIN part ON part = p_partkey
    GROUP BY canal, part, p_name, p_brand
    HAVING sum(units) > 0
)
"""
