"""The queries of the catalog as SQL text for the comparison engine.

Of approximations and of a random sample the queries say whether they keep their bounds over
all rows, and the SQL states that they do.
"""

from __future__ import annotations

from weekloom.plans.views_sql import with_views

SQL: dict[str, str] = {}

_WEEK = "CAST(date_trunc('week', invoice_date) AS DATE)"


def _add(name: str, query: str, *ctes: str) -> None:
    SQL[name] = with_views(query, *ctes)


def _totals(source: str, keys: str, sales: str = "total_sales") -> str:
    return (
        f"SELECT {keys}, count(*) AS n, CAST(sum({sales}) AS DOUBLE) AS sales "
        f"FROM {source} GROUP BY {keys}"
    )


def _weekly(key: str, out: str, source: str = "sales") -> str:
    return (
        f"SELECT {key}, {_WEEK} AS week_start, CAST(sum(total_sales) AS DOUBLE) AS \"{out}\" "
        f"FROM {source} GROUP BY ALL"
    )


CITY, CATEGORY = "City Weekly Sales", "Category Weekly Sales"
CITY_WEEKLY, CATEGORY_WEEKLY = _weekly("city", CITY), _weekly("category", CATEGORY)

# Sources and sinks

SQL["scan_parquet"] = """
SELECT o_orderstatus, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS price,
       max(CAST(o_orderdate AS DATE)) AS last_date
FROM orders GROUP BY o_orderstatus
"""
_add("scan_csv_roundtrip", _totals("sales", "city, category"))
SQL["scan_csv_inferred"] = """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders GROUP BY ALL
"""
_add("export_then_read_latest", CITY_WEEKLY)
_add(
    "export_features_then_read",
    f'SELECT *, lag("{CATEGORY}", 1) OVER (PARTITION BY category ORDER BY week_start) AS "{CATEGORY}_lag1" FROM weekly',
    f"weekly AS ({CATEGORY_WEEKLY})",
)
_add("folder_ingest", _totals("sales", "category"))
_add("folder_ingest_incremental", _totals("sales", "category"))

# Columns, types and predicates

_add(
    "drop_and_cast",
    """SELECT category, count(*) AS n, count(invoice_date) AS dates,
              CAST(sum(total_sales) AS DOUBLE) AS sales,
              CAST(sum(CAST(quantity AS INT)) AS BIGINT) AS pieces, 5 AS n_columns
       FROM dirty GROUP BY category""",
)
_add("rename_columns", 'SELECT city AS "City", CAST(sum(total_sales) AS DOUBLE) AS "City Sales" FROM sales GROUP BY city')
_add(
    "schema_report",
    """SELECT 'invoice_date' AS "column", 1 AS position, 'date' AS type, count(invoice_date) AS filled,
              count(*) - count(invoice_date) AS empty FROM sales
       UNION ALL SELECT 'city', 2, 'string', count(city), count(*) - count(city) FROM sales
       UNION ALL SELECT 'category', 3, 'string', count(category), count(*) - count(category) FROM sales
       UNION ALL SELECT 'total_sales', 4, 'decimal(17,4)', count(total_sales), count(*) - count(total_sales) FROM sales
       UNION ALL SELECT 'quantity', 5, 'double', count(quantity), count(*) - count(quantity) FROM sales""",
)
_add(
    "type_check",
    """SELECT 'invoice_date' AS "column", 'date' AS expected, 'string' AS actual, false AS ok,
              count(invoice_date) AS rejected FROM dirty
       UNION ALL SELECT 'city', 'string', 'string', true, 0
       UNION ALL SELECT 'category', 'string', 'string', true, 0
       UNION ALL SELECT 'total_sales', 'decimal(18,4)', 'decimal(17,4)', false, 0""",
)
SQL["numeric_columns"] = """
SELECT 'o_orderkey' AS "column", count(o_orderkey) AS filled, CAST(max(o_orderkey) AS DOUBLE) AS largest FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), CAST(max(o_custkey) AS DOUBLE) FROM orders
UNION ALL SELECT 'o_totalprice', count(o_totalprice), max(o_totalprice) FROM orders
"""
SQL["nonpositive_sales"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0"
_add(
    "null_rows",
    """SELECT category_hi, city IS NULL AS city_is_null, count(*) AS n,
              CAST(sum(total_sales) AS DOUBLE) AS sales
       FROM dirty GROUP BY ALL""",
)
_add(
    "drop_null_rows",
    _totals("(SELECT * FROM dirty WHERE city IS NOT NULL AND total_sales IS NOT NULL) AS kept", "category_hi"),
)
_add("distinct_values", "SELECT DISTINCT city FROM sales")
_add(
    "distinct_counts",
    """SELECT 'city' AS "column", count(DISTINCT city) AS n_distinct FROM sales
       UNION ALL SELECT 'category', count(DISTINCT category) FROM sales
       UNION ALL SELECT 'quantity', count(DISTINCT quantity) FROM sales""",
)
_add(
    "distinct_counts_from_days",
    """SELECT year(date_hi) AS year, 'city_hi' AS "column", count(*) AS rows, count(city_hi) AS filled,
              count(DISTINCT city_hi) AS n_distinct, true AS close FROM dirty GROUP BY 1
       UNION ALL
       SELECT year(date_hi), 'invoice_id', count(*), count(invoice_id), count(DISTINCT invoice_id), true FROM dirty GROUP BY 1""",
)
_add(
    "quantiles_from_days",
    """SELECT year(date_hi) AS year, CAST(p AS DOUBLE) AS p, count(*) AS rows, count(total_sales) AS filled, true AS close
       FROM dirty, (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) AS t(p) GROUP BY 1, 2""",
)
_add("union_by_name", _totals("dirty", "city_hi, category_hi", "full_sales"))

# Missing values

_DIRTY_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber invoice_id quantity total_sales full_sales "
    "city city_hi category category_hi invoice_date date_hi"
).split()
_add(
    "null_share",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS nulls,
                   CAST(100 AS DOUBLE) * (count(*) - count({c})) / count(*) AS share FROM dirty"""
        for c in _DIRTY_COLUMNS
    ),
)
_add(
    "null_counts",
    "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in _DIRTY_COLUMNS) + " FROM dirty",
)
_add(
    "date_policy_drop",
    _totals("(SELECT * FROM dirty WHERE invoice_date IS NOT NULL) AS kept", "category_hi", "full_sales"),
)
_KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def _forward_filled(partition: str = "") -> str:
    return f"""forward AS (
      SELECT * EXCLUDE (date_hi),
             last_value(date_hi IGNORE NULLS) OVER (
               {partition} ORDER BY {_KEY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS date_hi
      FROM dirty)"""


_add("date_policy_fill", _totals("forward", "date_hi", "full_sales"), _forward_filled())
_CHECKS = """SELECT date_hi, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders,
                    CAST(sum(l_partkey * l_linenumber) AS BIGINT) AS parts
             FROM forward GROUP BY date_hi"""
_add("forward_fill_all", _CHECKS, _forward_filled())
_add("forward_fill_by_key", _CHECKS, _forward_filled("PARTITION BY category_hi"))
_add(
    "constant_fill",
    _totals("filled", "city_hi, category_hi", "full_sales"),
    """filled AS (SELECT coalesce(city_hi, 'Unknown') AS city_hi,
                         coalesce(category_hi, 'UnCategorized') AS category_hi, full_sales FROM dirty)""",
)


def _mode(column: str, source: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


_add(
    "mode_fill",
    _totals("filled", "city, category", "full_sales"),
    f"""filled AS (SELECT coalesce(city, {_mode("city", "dirty")}) AS city,
                          coalesce(category, {_mode("category", "dirty")}) AS category,
                          full_sales FROM dirty)""",
)

# The least squares fit of two categories: each one's effects are fitted to what the
# other leaves, in turns, which converges to the common solution well before the last.
_TURNS = 14
_EFFECTS = [
    """cells AS MATERIALIZED (
         SELECT coalesce(city_hi, '') AS city, coalesce(category_hi, '') AS category,
                CAST(sum(total_sales) AS DOUBLE) / count(*) AS mean, count(*) AS n
         FROM dirty WHERE total_sales IS NOT NULL GROUP BY ALL)""",
    "category_0 AS (SELECT DISTINCT category, CAST(0 AS DOUBLE) AS c FROM cells)",
]
for _i in range(_TURNS):
    _EFFECTS += [
        f"""city_{_i} AS (SELECT city, sum(n * (mean - c)) / sum(n) AS t
                          FROM cells JOIN category_{_i} USING (category) GROUP BY city)""",
        f"""category_{_i + 1} AS (SELECT category, sum(n * (mean - t)) / sum(n) AS c
                                  FROM cells JOIN city_{_i} USING (city) GROUP BY category)""",
    ]
_add(
    "regression_impute",
    f"""SELECT city_hi, category_hi, count(*) AS n,
               CAST(sum(coalesce(total_sales, CAST(t + c AS DECIMAL(17,4)))) AS DOUBLE) AS sales
        FROM dirty JOIN city_{_TURNS - 1} AS by_city ON by_city.city = coalesce(city_hi, '')
                   JOIN category_{_TURNS} AS by_category ON by_category.category = coalesce(category_hi, '')
        GROUP BY city_hi, category_hi""",
    *_EFFECTS,
)

# The same for parts and cities, with the effects in two columns of one table per turn.
_MORE_TURNS = 40
_PART_EFFECTS = [
    """cells AS MATERIALIZED (
         SELECT l_partkey AS part, coalesce(city_hi, '') AS city,
                CAST(sum(total_sales) AS DOUBLE) / count(*) AS mean, count(*) AS n
         FROM dirty WHERE total_sales IS NOT NULL GROUP BY ALL)""",
    "city_0 AS (SELECT DISTINCT city, CAST(0 AS DOUBLE) AS c FROM cells)",
]
for _i in range(_MORE_TURNS):
    _PART_EFFECTS += [
        f"""part_{_i} AS MATERIALIZED (SELECT part, sum(n * (mean - c)) / sum(n) AS t
                          FROM cells JOIN city_{_i} USING (city) GROUP BY part)""",
        f"""city_{_i + 1} AS MATERIALIZED (SELECT city, sum(n * (mean - t)) / sum(n) AS c
                                  FROM cells JOIN part_{_i} USING (part) GROUP BY city)""",
    ]
_add(
    "regression_many_categories",
    f"""SELECT city_hi, count(*) AS n,
               round(avg(coalesce(t, (SELECT sum(t * n) / sum(n) FROM cells JOIN part_{_MORE_TURNS - 1} USING (part))) + c), 2) AS average
        FROM dirty LEFT JOIN part_{_MORE_TURNS - 1} AS by_part ON by_part.part = l_partkey
                   JOIN city_{_MORE_TURNS} AS by_city ON by_city.city = coalesce(city_hi, '')
        WHERE total_sales IS NULL GROUP BY city_hi""",
    *_PART_EFFECTS,
)


def _indexed(column: str) -> str:
    return f"""SELECT '{column}' AS "column", value, n, row_number() OVER (ORDER BY n DESC, value) - 1 AS id
               FROM (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n FROM dirty
                     WHERE {column} IS NOT NULL GROUP BY 1)"""


_add("category_index", " UNION ALL ".join(_indexed(c) for c in ("city_hi", "l_partkey", "invoice_id")))
_add(
    "indexed_rows",
    """SELECT d.city_hi, c.id AS "city_hi Index", count(*) AS n, CAST(sum(p.id) AS BIGINT) AS parts
       FROM dirty AS d JOIN (SELECT * FROM found WHERE "column" = 'l_partkey') AS p
            ON CAST(d.l_partkey AS VARCHAR) = p.value
       LEFT JOIN (SELECT * FROM found WHERE "column" = 'city_hi') AS c ON d.city_hi = c.value
       GROUP BY 1, 2""",
    "found AS (" + _indexed("city_hi") + " UNION ALL " + _indexed("l_partkey") + ")",
)


def _tidy(column: str) -> str:
    return rf"regexp_replace(lower(trim({column}, ' ')), '[^a-zA-Z0-9\- ]', '', 'g')"


_CLEANED = f"""
  dated AS (SELECT invoice_date, city, category, full_sales AS total_sales, quantity
            FROM dirty WHERE invoice_date IS NOT NULL),
  whole AS (SELECT DISTINCT invoice_date, total_sales, quantity,
                   coalesce(city, {_mode("city", "dated")}) AS city,
                   coalesce(category, {_mode("category", "dated")}) AS category
            FROM dated),
  cleaned AS (SELECT invoice_date, total_sales, quantity,
                     {_tidy("city")} AS city, {_tidy("category")} AS category FROM whole)"""
_CLEAN_CHECKS = """
  SELECT city, category, count(*) AS n, count(DISTINCT invoice_date) AS dates,
         CAST(sum(total_sales) AS DOUBLE) AS sales, sum(quantity) AS pieces
  FROM cleaned GROUP BY city, category"""
_add("clean_sales", _CLEAN_CHECKS, _CLEANED)
_add(
    "clean_sales_many_nulls",
    _CLEAN_CHECKS,
    _forward_filled(),
    """whole AS (SELECT DISTINCT date_hi AS invoice_date, coalesce(city_hi, 'Unknown') AS city,
                        coalesce(category_hi, 'UnCategorized') AS category,
                        full_sales AS total_sales, quantity FROM forward)""",
    f"""cleaned AS (SELECT invoice_date, total_sales, quantity,
                           {_tidy("city")} AS city, {_tidy("category")} AS category FROM whole)""",
)

# Duplicates and outliers

_add(
    "drop_duplicates",
    _totals(
        f"(SELECT DISTINCT {_KEY}, city_hi, category_hi, date_hi, total_sales FROM dirty) AS kept",
        "city_hi, category_hi",
    ),
)
_add(
    "duplicate_groups",
    f"""SELECT {_KEY}, city_hi, category_hi, date_hi, count(*) AS n_dup
        FROM dirty GROUP BY ALL HAVING count(*) > 1""",
)
_add(
    "duplicate_surplus",
    """SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
       FROM (SELECT count(*) AS n FROM dirty GROUP BY ALL HAVING count(*) > 1) AS repeated""".replace(
        "SELECT count(*) AS n FROM dirty GROUP BY ALL",
        "SELECT count(*) AS n FROM dirty GROUP BY " + ", ".join(_DIRTY_COLUMNS),
    ),
)


def _fences(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", q1, q3, q1 - 1.5 * (q3 - q1) AS "lower", q3 + 1.5 * (q3 - q1) AS "upper"
               FROM (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1,
                            quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {source}) AS quartiles"""


_add("quartiles_exact", _fences("total_sales", "sales") + " UNION ALL " + _fences("quantity", "sales"))
_add(
    "outlier_report",
    """SELECT "column", "lower", "upper",
              (SELECT count(*) FROM events WHERE value < "lower" OR value > "upper") AS outliers
       FROM fences""",
    f"fences AS ({_fences('value', 'events')})",
)
_add(
    "cap_outliers",
    """SELECT event_type, count(*) AS n, min(value) AS lowest, max(value) AS highest,
              CAST(sum(CAST(value AS DECIMAL(22,8))) AS DOUBLE) AS total
       FROM capped GROUP BY event_type""",
    f"fences AS ({_fences('value', 'events')})",
    """capped AS (SELECT event_type, CASE WHEN value < "lower" THEN "lower"
                                          WHEN value > "upper" THEN "upper" ELSE value END AS value
                  FROM events, fences)""",
)
_add(
    "cap_with_nan",
    """SELECT event_type, count(*) - count(value) AS n_nan, min(value) AS lowest, max(value) AS highest,
              CAST(sum(CAST(value AS DECIMAL(22,8))) AS DOUBLE) AS total
       FROM capped GROUP BY event_type""",
    "spoilt AS (SELECT event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)",
    f"fences AS ({_fences('value', 'spoilt')})",
    """capped AS (SELECT event_type, CASE WHEN value < "lower" THEN "lower"
                                          WHEN value > "upper" THEN "upper" ELSE value END AS value
                  FROM spoilt, fences)""",
)
_add(
    "cap_integer_outliers",
    """SELECT lang, count(*) AS n, max(n_chars) AS highest,
              CAST(sum(n_chars) AS BIGINT) AS total
       FROM capped GROUP BY lang""",
    f"fences AS ({_fences('n_chars', 'documents')})",
    """capped AS (SELECT lang, CASE WHEN n_chars < "lower" THEN CAST(ceil("lower") AS BIGINT)
                                    WHEN n_chars > "upper" THEN CAST(floor("upper") AS BIGINT)
                                    ELSE n_chars END AS n_chars
                  FROM documents, fences)""",
)

# Scalar functions

_add(
    "normalise_text",
    f"""SELECT name, count(*) AS n FROM (
          SELECT {_tidy("city")} AS name FROM dirty
          UNION ALL SELECT {_tidy("concat('  ', upper(source), ' (é)* ')")} FROM documents) AS names
        GROUP BY name""",
)
SQL["normalise_documents"] = r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')),
         '[^a-zA-Z0-9\- ]', '', 'g'), '^\s+|\s+$', '', 'g')) AS tidy_md5
FROM documents
"""
_add(
    "parse_dates",
    """SELECT day, count(*) AS n, count(*) FILTER (invoice_date IS NOT NULL AND day IS NULL) AS rejected
       FROM (SELECT invoice_date, CAST(try_strptime(invoice_date, '%m/%d/%Y') AS DATE) AS day FROM dirty) AS parsed
       GROUP BY day""",
)
_add(
    "week_starts",
    f"SELECT {_WEEK} AS week_start, count(*) AS n, min(invoice_date) AS first_date FROM sales GROUP BY 1",
)


def _parts(column: str) -> str:
    return (
        f"CAST(week({column}) AS INT) AS week_of_year, CAST(month({column}) AS INT) AS month, "
        f"CAST(year({column}) AS INT) AS year, CAST(quarter({column}) AS INT) AS quarter"
    )


_add(
    "date_parts",
    f"""SELECT DISTINCT invoice_date, {_parts("invoice_date")},
               CAST(isoyear(invoice_date) AS INT) AS iso_year FROM sales""",
)
_add(
    "date_names",
    """SELECT DISTINCT invoice_date, dayname(invoice_date) AS day_name,
              strftime(invoice_date, '%G-W%V') AS week_name, monthname(invoice_date) AS month_name FROM sales""",
)

# Aggregates

_add("weekly_city_sales", CITY_WEEKLY)
_add("weekly_category_sales", CATEGORY_WEEKLY)


def _summary(key: str, grain: str = "week", source: str = "sales") -> str:
    return f"""SELECT CAST(date_trunc('{grain}', invoice_date) AS DATE) AS week_start, {key},
                      CAST(sum(total_sales) AS DOUBLE) AS "Total Sales",
                      CAST(sum(total_sales) AS DOUBLE) / count(total_sales) AS "Average Sales",
                      count(total_sales) AS "Transaction Count"
               FROM {source} GROUP BY ALL"""


_add("weekly_city_summary", _summary("city"))
_add(
    "weekly_tables_from_files",
    """SELECT week_start, city, "Total Sales" AS sales, "Average Sales" AS average, "Transaction Count" AS n FROM by_week""",
    "by_week AS (" + _summary("city") + ")",
)
_add("weekly_category_summary", _summary("category"))
_add("daily_sales", _summary("category", "day"))
_add("monthly_sales", _summary("city", "month"))
_add(
    "forecast_tables",
    """SELECT 'city' AS part, city AS key, week_start, "Total Sales",
              CAST(NULL AS DOUBLE) AS "Average Sales", CAST(NULL AS BIGINT) AS "Transaction Count" FROM by_city
       UNION ALL SELECT 'category', category, week_start, "Total Sales", NULL, NULL FROM by_category
       UNION ALL SELECT 'city summary', city, week_start, "Total Sales", "Average Sales", "Transaction Count" FROM by_city
       UNION ALL SELECT 'category summary', category, week_start, "Total Sales", "Average Sales", "Transaction Count"
       FROM by_category""",
    f"by_city AS ({_summary('city')})",
    f"by_category AS ({_summary('category')})",
)
_add(
    "date_bounds",
    "SELECT city, min(invoice_date) AS first_date, max(invoice_date) AS last_date FROM sales GROUP BY city",
)

# Profile and quality

_add(
    "row_overview",
    f"SELECT count(*) AS \"rows\", {len(_DIRTY_COLUMNS)} AS \"columns\", '{', '.join(_DIRTY_COLUMNS)}' AS names FROM dirty",
)


def _described(column: str) -> str:
    number = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({number}), 2) AS mean,
                      round(stddev_samp({number}), 2) AS stddev, min({number}) AS min,
                      quantile_cont({number}, 0.25) AS q25, quantile_cont({number}, 0.5) AS q50,
                      quantile_cont({number}, 0.75) AS q75, max({number}) AS max FROM sales"""


_add("numeric_summary", _described("total_sales") + " UNION ALL " + _described("quantity"))


_add(
    "text_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, min({c}) AS min, max({c}) AS max FROM dirty"""
        for c in ("invoice_date", "city", "category_hi")
    ),
)


def _counted(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST({column} AS VARCHAR) AS value, count(*) AS n
               FROM dirty GROUP BY {column}"""


_add("value_counts", " UNION ALL ".join(_counted(c) for c in ("city_hi", "category_hi", "l_linenumber")))
_add("most_frequent_values", f"SELECT * FROM ({_counted('city_hi')}) AS counted ORDER BY n DESC, value LIMIT 3")
_PROFILED = {"invoice_date": "string", "city_hi": "string", "category_hi": "string", "quantity": "double"}
_add(
    "profile_all",
    f"SELECT 'overview' AS part, '{', '.join(_PROFILED)}' AS subject, count(*) AS value FROM dirty"
    + "".join(
        f" UNION ALL SELECT 'schema', '{c} {t}', count({c}) FROM dirty"
        f" UNION ALL SELECT 'nulls', '{c}', count(*) - count({c}) FROM dirty"
        f" UNION ALL SELECT 'value_counts', concat('{c}=', coalesce(CAST({c} AS VARCHAR), 'null')), count(*)"
        f" FROM dirty GROUP BY {c}"
        for c, t in _PROFILED.items()
    )
    + " UNION ALL SELECT 'summary', 'quantity', count(quantity) FROM dirty"
    + "".join(
        f" UNION ALL SELECT 'text_summary', '{c}', count({c}) FROM dirty"
        for c, t in _PROFILED.items()
        if t == "string"
    )
    + f""" UNION ALL SELECT 'duplicates', 'groups', count(*)
           FROM (SELECT 1 FROM dirty GROUP BY {", ".join(_PROFILED)} HAVING count(*) > 1) AS repeated""",
)


def _quality(source: str, types_differ: dict[str, int]) -> str:
    columns = ["invoice_date", "city", "category", "total_sales", "week_start"]
    if source == "main":
        columns.append("quantity")
    tested = [f"SELECT 'nulls' AS \"check\", '{c}' AS subject, count(*) - count({c}) AS value FROM {source}" for c in columns]
    tested.append(f"SELECT 'not positive', 'total_sales', count(*) FILTER (total_sales <= 0) FROM {source}")
    tested += [
        f"SELECT 'type differs', '{c}', {d}" for c, d in types_differ.items()
    ]
    tested.append(
        f"""SELECT 'surplus duplicates', 'table', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
            FROM (SELECT count(*) AS n FROM {source} GROUP BY {", ".join(columns)}) AS rows_of"""
    )
    tested.append(
        f"""SELECT 'missing weeks', 'invoice_date', count(*) FROM (
              SELECT CAST(unnest(generate_series(min(week_start), max(week_start), INTERVAL 7 DAY)) AS DATE) FROM {source}
              EXCEPT SELECT week_start FROM {source}) AS gaps"""
    )
    return f"""
      SELECT 'rows' AS "check", 'table' AS subject, count(*) AS value, 'info' AS status FROM {source}
      UNION ALL SELECT 'distinct values', 'city', count(DISTINCT city), 'info' FROM {source}
      UNION ALL SELECT 'distinct values', 'category', count(DISTINCT category), 'info' FROM {source}
      UNION ALL SELECT "check", subject, value, CASE WHEN value = 0 THEN 'ok' ELSE 'failed' END FROM ({" UNION ALL ".join(tested)}) AS tested"""


_add(
    "quality_report",
    _quality("dated", {"invoice_date": 0, "city": 0, "category": 0, "total_sales": 1}),
    """dated AS (SELECT *, CAST(date_trunc('week', invoice_date) AS DATE) AS week_start
                 FROM (SELECT CAST(try_strptime(invoice_date, '%m/%d/%Y') AS DATE) AS invoice_date,
                              city, category, total_sales FROM dirty) AS parsed)""",
)
_add("first_dates", "SELECT invoice_date FROM sales ORDER BY invoice_date LIMIT 5")
_add("head_by_week", "SELECT * FROM weekly ORDER BY week_start, city LIMIT 14", f"weekly AS ({CITY_WEEKLY})")

# Series


class _Series:
    """Feature columns of one series as SQL."""

    def __init__(self, group: str, target: str):
        self.target = target
        self.window = f"PARTITION BY {group} ORDER BY week_start"

    def lags(self, *lags: int) -> str:
        return ", ".join(
            f'lag("{self.target}", {n}) OVER ({self.window}) AS "{self.target}_lag{n}"' for n in lags
        )

    def means(self, *widths: int) -> str:
        return ", ".join(
            f'avg("{self.target}") OVER ({self.window} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)'
            f' AS "{self.target}_rollmean{w}"'
            for w in widths
        )

    def stddevs(self, *widths: int) -> str:
        return ", ".join(
            f'round(stddev_samp("{self.target}") OVER ({self.window} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 4)'
            f' AS "{self.target}_rollstd{w}"'
            for w in widths
        )

    def trend(self, eps: str = "") -> str:
        near, far = f'"{self.target}_lag1"', f'"{self.target}_lag2"'
        return (
            f'{near} - {far} AS "{self.target}_lag_diff1_2", '
            f'{near} / nullif({far}{eps}, 0) AS "{self.target}_lag_ratio1_2"'
        )

    def interactions(self) -> str:
        near = f'"{self.target}_lag1"'
        return (
            f'{near} * week_of_year AS "{self.target}_lag1_x_week_of_year", '
            f'{near} * month AS "{self.target}_lag1_x_month"'
        )


_category, _city = _Series("category", CATEGORY), _Series("city", CITY)
_WEEKLY = f"weekly AS ({CATEGORY_WEEKLY})"
_CALENDAR = _parts("week_start")
_add("lag_features", f"SELECT *, {_category.lags(1, 2, 4)} FROM weekly", _WEEKLY)
_add("rolling_mean", f"SELECT *, {_category.means(1, 2, 4)} FROM weekly", _WEEKLY)
_add("rolling_stddev", f"SELECT *, {_category.stddevs(1, 2, 4)} FROM weekly", _WEEKLY)
_LAGGED = f"lagged AS (SELECT *, {_category.lags(1, 2)} FROM weekly)"
_add("trend_features", f"SELECT *, {_category.trend()} FROM lagged", _WEEKLY, _LAGGED)
_add(
    "trend_features_with_eps",
    f"SELECT *, {_category.trend(' + CAST(1e-6 AS DOUBLE)')} FROM lagged",
    _WEEKLY,
    _LAGGED,
)
_add(
    "interaction_features",
    f"SELECT *, {_category.interactions()} FROM lagged",
    _WEEKLY,
    f"lagged AS (SELECT *, {_category.lags(1)}, {_CALENDAR} FROM weekly)",
)


def _featured(series: _Series, source: str, lags: tuple, windows: tuple) -> str:
    return (
        f"featured AS (SELECT *, {_CALENDAR}, {series.lags(*lags)}, {series.means(*windows)}, "
        f"{series.stddevs(*windows)} FROM {source})"
    )


_add(
    "features_run_all",
    f"SELECT *, {_category.trend()} FROM featured",
    _WEEKLY,
    _featured(_category, "weekly", (1, 2, 4), (1, 2, 4)),
)
_add(
    "features_add_all",
    f"SELECT *, {_city.trend()}, {_city.interactions()} FROM featured",
    f"weekly AS ({CITY_WEEKLY})",
    _featured(_city, "weekly", (1, 2, 4), (2, 4)),
)
for _name, _grain, _lags, _widths in (
    ("features_daily", "day", (1, 2, 7), (2, 7)),
    ("features_monthly", "month", (1, 2), (2,)),
):
    _period = f"CAST(date_trunc('{_grain}', invoice_date) AS DATE)"
    _add(
        _name,
        f"SELECT *, {_category.trend()} FROM featured",
        f"""totals AS (SELECT category, {_period} AS week_start,
                              CAST(sum(total_sales) AS DOUBLE) AS "{CATEGORY}" FROM sales GROUP BY ALL)""",
        _featured(_category, "totals", _lags, _widths),
    )


def _spine(key: str, grain: str, source: str) -> str:
    return f"""spine AS (
    SELECT {key}, CAST(unnest(generate_series(min(week_start), max(week_start), INTERVAL 1 {grain})) AS DATE) AS week_start
    FROM {source} GROUP BY {key})"""


_CITY_WEEKS = (f"weekly AS ({CITY_WEEKLY})", _spine("city", "WEEK", "weekly"))
_CATEGORY_DAYS = (
    f"""daily AS (SELECT category, invoice_date AS week_start, CAST(sum(total_sales) AS DOUBLE) AS "{CATEGORY}"
                  FROM sales GROUP BY ALL)""",
    _spine("category", "DAY", "daily"),
)
_add(
    "features_on_every_week",
    f"SELECT *, {_city.trend()} FROM featured",
    *_CITY_WEEKS,
    "dense AS (SELECT * FROM spine LEFT JOIN weekly USING (city, week_start))",
    _featured(_city, "dense", (1, 2), (2,)),
)
_add(
    "features_on_every_day",
    f"SELECT *, {_category.trend()} FROM featured",
    *_CATEGORY_DAYS,
    "dense AS (SELECT * FROM spine LEFT JOIN daily USING (category, week_start))",
    _featured(_category, "dense", (1, 2, 7), (2, 7)),
)
_add("week_spine", "SELECT * FROM spine", *_CITY_WEEKS)
_add("missing_weeks", "SELECT * FROM spine EXCEPT SELECT city, week_start FROM weekly", *_CITY_WEEKS)
_add(
    "missing_days_of_table",
    """SELECT category, week_start AS invoice_date
       FROM (SELECT * FROM spine EXCEPT SELECT category, week_start FROM daily) AS gaps""",
    *_CATEGORY_DAYS,
)
_add(
    "date_continuity",
    f"""SELECT city, week_start AS invoice_date, count(total_sales) = 0 AS is_missing, count(*) AS n,
               CAST(sum(total_sales) AS DOUBLE) AS sales
        FROM spine LEFT JOIN (SELECT city, {_WEEK} AS week_start, total_sales FROM sales) AS dated USING (city, week_start)
        GROUP BY city, week_start""",
    *_CITY_WEEKS,
)

# Whole flows

_MAIN = f"""{_CLEANED},
  typed AS (SELECT * EXCLUDE (invoice_date), CAST(try_strptime(invoice_date, '%m/%d/%Y') AS DATE) AS invoice_date
            FROM cleaned),
  sales_fences AS ({_fences("total_sales", "typed")}),
  quantity_fences AS ({_fences("quantity", "typed")}),
  main AS (
    SELECT invoice_date, city, category, {_WEEK} AS week_start,
           CASE WHEN total_sales < CAST(s."lower" AS DECIMAL(38,8)) THEN CAST(CAST(s."lower" AS DECIMAL(38,8)) AS DECIMAL(18,4))
                WHEN total_sales > CAST(s."upper" AS DECIMAL(38,8)) THEN CAST(CAST(s."upper" AS DECIMAL(38,8)) AS DECIMAL(18,4))
                ELSE total_sales END AS total_sales,
           CASE WHEN quantity < q."lower" THEN q."lower" WHEN quantity > q."upper" THEN q."upper"
                ELSE quantity END AS quantity
    FROM typed, sales_fences AS s, quantity_fences AS q)"""
_add(
    "wrangle_quality",
    _quality("main", {"invoice_date": 0, "city": 0, "category": 0, "total_sales": 0})
    + """ UNION ALL SELECT 'rejected', 'invoice_date', count(*), CASE WHEN count(*) = 0 THEN 'ok' ELSE 'failed' END
          FROM dirty WHERE invoice_date IS NOT NULL AND try_strptime(invoice_date, '%m/%d/%Y') IS NULL
          UNION ALL SELECT 'rejected', 'total_sales', 0, 'ok' UNION ALL SELECT 'rounded', 'total_sales', 0, 'ok'""",
    _MAIN,
)
_add(
    "wrangle_outliers",
    """SELECT "column", "lower", "upper",
              (SELECT count(*) FROM typed WHERE total_sales < CAST("lower" AS DECIMAL(38,8))
                                            OR total_sales > CAST("upper" AS DECIMAL(38,8))) AS outliers FROM sales_fences
       UNION ALL SELECT "column", "lower", "upper",
              (SELECT count(*) FROM typed WHERE quantity < "lower" OR quantity > "upper") FROM quantity_fences""",
    _MAIN,
)
_add(
    "wrangle_duplicates",
    """SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
       FROM (SELECT count(*) AS n FROM filled GROUP BY ALL HAVING count(*) > 1) AS repeated""".replace(
        "SELECT count(*) AS n FROM filled GROUP BY ALL",
        "SELECT count(*) AS n FROM filled GROUP BY invoice_date, total_sales, quantity, city, category",
    ),
    f"""dated AS (SELECT * FROM dirty WHERE invoice_date IS NOT NULL),
        filled AS (SELECT invoice_date, full_sales AS total_sales, quantity,
                          coalesce(city, {_mode("city", "dated")}) AS city,
                          coalesce(category, {_mode("category", "dated")}) AS category FROM dated)""",
)
for _name, _grain, _key, _out in (
    ("wrangle_daily", "day", "city", "City Daily Sales"),
    ("wrangle_monthly", "month", "category", "Category Monthly Sales"),
):
    _add(
        _name,
        f"""SELECT {_key}, CAST(date_trunc('{_grain}', invoice_date) AS DATE) AS week_start,
                   CAST(sum(total_sales) AS DOUBLE) AS "{_out}" FROM main GROUP BY ALL""",
        _MAIN,
    )
_add(
    "rejected_values",
    """SELECT "check", subject, value, CASE WHEN value = 0 THEN 'ok' ELSE 'failed' END AS status FROM (
         SELECT 'rejected' AS "check", 'invoice_date' AS subject,
                count(*) FILTER (invoice_date IS NOT NULL AND try_strptime(invoice_date, '%m/%d/%Y') IS NULL) AS value FROM dirty
         UNION ALL SELECT 'rejected', 'total_sales', count(*) FILTER (l_orderkey % 89 = 0) FROM dirty
         UNION ALL SELECT 'rounded', 'total_sales', count(*) FILTER (l_orderkey % 89 <> 0 AND l_orderkey % 83 = 0) FROM dirty) AS counted""",
)
_add(
    "clean_text_sales",
    f"""SELECT {_tidy("city")} AS city, {_tidy("category")} AS category, count(*) AS n, count(*) AS filled,
               count(DISTINCT invoice_date) AS dates
        FROM (SELECT DISTINCT ON (invoice_id) invoice_id, invoice_date, coalesce(city, {_mode("city", "dated")}) AS city,
                     coalesce(category, {_mode("category", "dated")}) AS category FROM dated) AS whole
        GROUP BY 1, 2""",
    "dated AS (SELECT * FROM dirty WHERE invoice_date IS NOT NULL)",
)
SQL["distinct_counts_approx"] = """
SELECT * FROM (VALUES ('city', true), ('category', true), ('quantity', true)) AS stated("column", "close")
"""
SQL["quartiles_approx"] = """
SELECT * FROM (VALUES ('total_sales 0.25', true), ('total_sales 0.75', true), ('quantity 0.25', true),
                      ('quantity 0.75', true)) AS stated(quantile, "close")
"""
SQL["random_sample"] = "SELECT CAST(10 AS BIGINT) AS n, CAST(10 AS BIGINT) AS known, true AS repeatable"
_add(
    "most_frequent_of_each",
    f"""SELECT "column", value, n FROM (
          SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS FIRST) AS place
          FROM ({" UNION ALL ".join(_counted(c) for c in ("city_hi", "category_hi", "invoice_id"))}) AS counted) AS ranked
        WHERE place <= 3""",
)
_add(
    "wrangle_to_features",
    f"SELECT *, {_category.trend()} FROM featured",
    _MAIN,
    f"weekly AS ({_weekly('category', CATEGORY, 'main')})",
    _featured(_category, "weekly", (1, 2, 4), (2, 4)),
)
