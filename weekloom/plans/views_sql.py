"""The same views as SQL text for the comparison engine."""

SALES = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS invoice_id,
         CAST(o_orderdate AS DATE) AS invoice_date,
         n_name AS city,
         p_type AS category,
         CAST(l_extendedprice AS DECIMAL(12,2))
           * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS total_sales,
         l_quantity AS quantity
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
"""

DIRTY = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, invoice_id, quantity,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 50 <> 0 THEN total_sales END AS total_sales,
         total_sales AS full_sales,
         CASE WHEN (l_orderkey * 3 + l_linenumber) % 40 <> 0 THEN
           CASE WHEN l_linenumber % 2 = 0 THEN concat('  ', upper(city), '*& ') ELSE city END
         END AS city,
         CASE WHEN (l_orderkey * 3 + l_linenumber) % 12 <> 0 THEN city END AS city_hi,
         CASE WHEN (l_partkey * 5 + l_linenumber) % 150 <> 0 THEN category END AS category,
         CASE WHEN (l_partkey * 5 + l_linenumber) % 30 <> 0 THEN category END AS category_hi,
         CASE WHEN (l_orderkey * 11 + l_linenumber) % 60 <> 0 THEN
           CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' ELSE strftime(invoice_date, '%m/%d/%Y') END
         END AS invoice_date,
         CASE WHEN (l_orderkey * 11 + l_linenumber) % 15 <> 0 THEN invoice_date END AS date_hi
  FROM (SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE l_orderkey % 40 = 0) AS repeated
"""


def with_views(query: str, *ctes: str) -> str:
    """Put the views, and further named queries, in front of ``query``."""
    named = [f"sales AS ({SALES})", f"dirty AS ({DIRTY})", *ctes]
    return "WITH " + ",\n".join(named) + "\n" + query
