"""Independent SQL (DuckDB dialect) for every registered query.

Written from the semantics, not generated from the Spark plans. Shared
common table expressions are composed below; each query string is complete.
"""

from __future__ import annotations

from pricewise.config import FORWARD_PROJECTION_MONTHS

SALE = """
sale AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         p_brand AS make, p_name AS model,
         CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'compact' ELSE lower(p_type) END AS body,
         CAST(year(o_orderdate) AS BIGINT) AS year,
         l_shipdate AS saledate,
         CAST(month(l_shipdate) AS BIGINT) AS sale_month,
         strftime(l_shipdate, '%Y-%m') AS year_month,
         CAST(greatest(year(l_shipdate) - year(o_orderdate), 0) AS BIGINT) AS vehicle_age,
         CAST(l_quantity * 1000 AS BIGINT) AS odometer,
         nullif(l_discount * 50, 0.0) AS condition,
         nullif(l_returnflag, 'N') AS transmission,
         l_extendedprice AS sellingprice
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""

# some (body, month) cells without a sale, one sparse body
SPARSE_SALE = SALE.rstrip()[:-1] + """
  WHERE NOT (p_type = 'LARGE' AND month(l_shipdate) BETWEEN 8 AND 11)
    AND NOT (p_type = 'PROMO' AND l_quantity > 5))"""

PRICE = """
price AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS year_month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS price
  FROM orders GROUP BY 1)"""

INDEX = PRICE + """,
qv AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS year_month, avg(l_quantity) AS quantity,
         CAST(count(*) AS DOUBLE) AS volume
  FROM lineitem GROUP BY 1),
aligned AS (
  SELECT coalesce(p.year_month, q.year_month) AS year_month, p.price, q.quantity, q.volume
  FROM price p FULL OUTER JOIN qv q ON p.year_month = q.year_month),
filled AS (
  SELECT year_month,
         last_value(price IGNORE NULLS) OVER w AS price,
         last_value(quantity IGNORE NULLS) OVER w AS quantity,
         last_value(volume IGNORE NULLS) OVER w AS volume
  FROM aligned
  WHERE price IS NOT NULL OR quantity IS NOT NULL OR volume IS NOT NULL
  WINDOW w AS (ORDER BY year_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
idx AS (
  SELECT f.year_month, f.price, f.quantity, f.volume, f.price / b.base AS cpi_multiplier
  FROM filled f, (SELECT list_reduce(list_sort(list(price)), lambda a, x: a + x) / count(price) AS base
                 FROM filled WHERE substr(year_month, 1, 4) = '1998') b)"""

FRAME = """
frame AS (
  SELECT * FROM sale
  WHERE vehicle_age IS NOT NULL AND sale_month IS NOT NULL AND odometer IS NOT NULL
    AND condition IS NOT NULL AND year_month IS NOT NULL AND make IS NOT NULL
    AND model IS NOT NULL AND body IS NOT NULL AND sellingprice IS NOT NULL
    AND sellingprice BETWEEN 500 AND 150000 AND odometer BETWEEN 1 AND 500000
    AND vehicle_age BETWEEN 0 AND 30),
gb AS (
  SELECT make, body, CAST(sum(CAST(sellingprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS prediction
  FROM frame GROUP BY make, body)"""

ROWS = """
srows AS (
  SELECT f.l_orderkey, f.l_partkey, f.l_suppkey, f.l_linenumber, f.body, f.sale_month, f.year_month,
         f.sellingprice / i.cpi_multiplier AS normalized_price,
         greatest(g.prediction, 500.0) AS reference_prediction,
         (f.sellingprice / i.cpi_multiplier) / greatest(g.prediction, 500.0) AS price_ratio
  FROM frame f JOIN gb g ON f.make = g.make AND f.body = g.body
  JOIN idx i ON f.year_month = i.year_month
  WHERE f.sale_month BETWEEN 1 AND 12)"""

def factors_cte(src: str = "srows", p: str = "") -> str:
    """CTE chain computing the factor table ``{p}factors`` from rows ``src``."""
    return (FACTORS_TEMPLATE.replace("{src}", src).replace("{p}", p))


FACTORS_TEMPLATE = """
{p}body_stats AS (
  SELECT body, median(price_ratio) AS body_ratio_median, count(*) AS body_observations
  FROM {src} GROUP BY body),
{p}cells AS (
  SELECT r.body, r.sale_month, median(r.price_ratio / b.body_ratio_median) AS raw, count(*) AS n
  FROM {src} r JOIN {p}body_stats b ON r.body = b.body GROUP BY r.body, r.sale_month),
{p}grid AS (
  SELECT b.body, b.body_observations, CAST(m.m AS BIGINT) AS sale_month
  FROM {p}body_stats b CROSS JOIN range(1, 13) m(m)),
{p}g AS (
  SELECT grid.body, grid.sale_month, grid.body_observations,
         CAST(coalesce(cells.n, 0) AS BIGINT) AS observations,
         coalesce(cells.raw, 1.0) AS raw,
         CASE WHEN coalesce(cells.n, 0) > 0 THEN
              least(greatest(1.0 + (cells.raw - 1.0) * (cells.n / (cells.n + 1000)), 0.85), 1.15)
              ELSE 1.0 END AS factor
  FROM {p}grid grid LEFT JOIN {p}cells cells ON grid.body = cells.body AND grid.sale_month = cells.sale_month),
{p}rec AS (
  SELECT body,
         CAST(sum(CASE WHEN observations >= 100 THEN 1 ELSE 0 END) AS BIGINT) AS recommendation_eligible_months,
         coalesce(arg_max(sale_month, (factor, -sale_month)) FILTER (WHERE observations >= 100),
                  arg_max(sale_month, (factor, -sale_month)) FILTER (WHERE observations > 0), 2) AS best_month,
         coalesce(arg_max(factor, (factor, -sale_month)) FILTER (WHERE observations >= 100),
                  arg_max(factor, (factor, -sale_month)) FILTER (WHERE observations > 0), 1.0) AS best_factor,
         coalesce(arg_min(sale_month, (factor, sale_month)) FILTER (WHERE observations >= 100),
                  arg_min(sale_month, (factor, sale_month)) FILTER (WHERE observations > 0), 2) AS worst_month,
         coalesce(arg_min(factor, (factor, sale_month)) FILTER (WHERE observations >= 100),
                  arg_min(factor, (factor, sale_month)) FILTER (WHERE observations > 0), 1.0) AS worst_factor
  FROM {p}g GROUP BY body),
{p}mn AS (
  SELECT * FROM (VALUES (1, 'Jan'), (2, 'Feb'), (3, 'Mar'), (4, 'Apr'), (5, 'May'), (6, 'Jun'),
                        (7, 'Jul'), (8, 'Aug'), (9, 'Sep'), (10, 'Oct'), (11, 'Nov'), (12, 'Dec')) t(m, name)),
{p}factors AS (
  SELECT g.body, g.sale_month, m1.name AS month_name,
         round(g.factor, 4) AS seasonal_factor,
         round((g.factor - 1.0) * 100, 1) AS seasonal_delta_pct,
         round(g.raw, 4) AS raw_factor,
         g.observations,
         CASE WHEN g.observations = 0 THEN 'no_data' WHEN g.observations < 100 THEN 'low'
              WHEN g.observations < 1000 THEN 'medium' ELSE 'high' END AS confidence,
         g.observations > 0 AS is_observed,
         g.body_observations, rec.recommendation_eligible_months,
         rec.recommendation_eligible_months >= 2 AS has_recommendation,
         CAST(rec.best_month AS BIGINT) AS best_month, m2.name AS best_month_name,
         round(rec.best_factor, 4) AS best_factor,
         CAST(rec.worst_month AS BIGINT) AS worst_month, m3.name AS worst_month_name,
         round(rec.worst_factor, 4) AS worst_factor
  FROM {p}g g JOIN {p}rec rec ON g.body = rec.body
  JOIN {p}mn m1 ON m1.m = g.sale_month JOIN {p}mn m2 ON m2.m = rec.best_month
  JOIN {p}mn m3 ON m3.m = rec.worst_month)"""
FACTORS = factors_cte()


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


CHAIN = with_(SALE, INDEX, FRAME, ROWS, FACTORS)

ORACLE: dict[str, str] = {}

ORACLE["seasonality_factors"] = CHAIN + "SELECT * FROM factors"
ORACLE["seasonality_factors_sparse"] = with_(SPARSE_SALE, INDEX, FRAME, ROWS, FACTORS) + "SELECT * FROM factors"

# five folds by key; a group's mean without the row's own fold, else the mean of all rows outside it
ROWS_OUT_OF_FOLD = """
folded AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) || '|fold'), 1, 8) AS BIGINT) % 5
            AS fold FROM frame),
fold_sum AS (
  SELECT fold, make, body, sum(CAST(sellingprice AS DECIMAL(18,2))) AS s, count(*) AS n FROM folded GROUP BY fold, make, body),
group_sum AS (SELECT make, body, sum(s) AS s, sum(n) AS n FROM fold_sum GROUP BY make, body),
fold_all AS (SELECT fold, sum(s) AS s, sum(n) AS n FROM fold_sum GROUP BY fold),
every AS (SELECT sum(s) AS s, sum(n) AS n FROM fold_sum),
unseen AS (
  SELECT f.*, coalesce(CAST(g.s - o.s AS DOUBLE) / nullif(g.n - o.n, 0), CAST(e.s - a.s AS DOUBLE) / (e.n - a.n)) AS prediction
  FROM folded f JOIN group_sum g ON f.make = g.make AND f.body = g.body
  JOIN fold_sum o ON f.fold = o.fold AND f.make = o.make AND f.body = o.body
  JOIN fold_all a ON f.fold = a.fold CROSS JOIN every e),
srows AS (
  SELECT u.l_orderkey, u.l_partkey, u.l_suppkey, u.l_linenumber, u.body, u.sale_month, u.year_month,
         u.sellingprice / i.cpi_multiplier AS normalized_price, greatest(u.prediction, 500.0) AS reference_prediction,
         (u.sellingprice / i.cpi_multiplier) / greatest(u.prediction, 500.0) AS price_ratio
  FROM unseen u JOIN idx i ON u.year_month = i.year_month WHERE u.sale_month BETWEEN 1 AND 12)"""
ORACLE["seasonality_factors_out_of_fold"] = with_(SALE, INDEX, FRAME, ROWS_OUT_OF_FOLD, FACTORS) + "SELECT * FROM factors"

ORACLE["quote_chain"] = with_(SALE, INDEX, FRAME, ROWS, FACTORS) + """,
fallback AS (SELECT CAST(sum(CAST(sellingprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS fb FROM frame),
bounds AS (SELECT min(year_month) AS lo, max(year_month) AS hi FROM idx),
q AS (
  SELECT s.l_orderkey, s.l_partkey, s.l_suppkey, s.l_linenumber, s.body,
         s.sale_month AS target_month,
         strftime(s.saledate, '%Y-%m') AS year_month,
         CAST(least(greatest(year(s.saledate) - s.year, 0), 30) AS BIGINT) AS vehicle_age,
         coalesce(g.prediction, fb.fb) AS stage1_price,
         least(greatest(strftime(s.saledate, '%Y-%m'), b.lo), b.hi) AS key
  FROM sale s LEFT JOIN gb g ON s.make = g.make AND s.body = g.body
  CROSS JOIN fallback fb CROSS JOIN bounds b),
resolved AS (
  SELECT q.*, (SELECT max(i.year_month) FROM idx i WHERE i.year_month <= q.key) AS resolved_month
  FROM q),
priced AS (
  SELECT r.*, i.cpi_multiplier, r.stage1_price * i.cpi_multiplier AS stage2_price,
         f.seasonal_factor AS f_factor, f.observations AS f_obs, f.has_recommendation AS f_rec,
         f.best_month_name AS f_best_name, f.best_factor AS f_best_factor
  FROM resolved r JOIN idx i ON i.year_month = r.resolved_month
  LEFT JOIN factors f ON f.body = lower(trim(r.body)) AND f.sale_month = r.target_month),
final AS (
  SELECT *, coalesce(f_factor, 1.0) AS sf, coalesce(f_rec, false) AS rec,
         (coalesce(f_factor, 1.0) - 1.0) * 100 AS dpct
  FROM priced)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, body, target_month, year_month,
       resolved_month, resolved_month <> year_month AS is_carried, vehicle_age,
       round(stage1_price, 6) AS stage1_price, round(cpi_multiplier, 6) AS cpi_multiplier,
       round(stage2_price, 6) AS stage2_price, sf AS seasonal_factor,
       round(stage2_price * sf, 6) AS final_price,
       round(stage2_price - stage1_price, 6) AS index_delta,
       round((cpi_multiplier - 1.0) * 100, 6) AS index_delta_pct,
       round(stage2_price * sf - stage2_price, 6) AS seasonal_delta,
       round(dpct, 6) AS seasonal_delta_pct,
       CASE WHEN rec THEN f_best_name END AS best_month_name,
       round(CASE WHEN rec THEN (f_best_factor - sf) * 100 END, 6) AS best_gap_points,
       CASE WHEN coalesce(f_obs, 0) = 0 THEN 'no_data' WHEN dpct > 2.0 THEN 'strong'
            WHEN dpct < -2.0 THEN 'weak' ELSE 'average' END AS verdict,
       CASE WHEN coalesce(f_obs, 0) <> 0 AND NOT (dpct > 2.0) AND dpct < -2.0 AND rec
            THEN f_best_name END AS hint_month
FROM final"""


KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
KEYTEXT = "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
BUCKET = f"(('0x' || substr(md5({KEYTEXT}), 1, 8))::BIGINT % 100)"
SALE_TIME = "'Tue Dec 16 2014 12:30:00 GMT-0800 (PST)'"
STRIP_U = r"regexp_replace({x}, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')"


def norm_category(x: str) -> str:
    stripped = STRIP_U.format(x=x)
    return (f"nullif(replace(regexp_replace(lower({stripped}), '[\\s\\pZ]+', ' ', 'g'), "
            f"'navitgation', 'navigation'), '')")


REPAIRED = f"""
WITH lp AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS line_id,
         concat_ws(',', CAST(1990 + p_size % 30 AS VARCHAR), p_brand, p_name,
                   CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, ' ', ', ')
                        WHEN p_partkey % 3 = 1 THEN '"' || replace(p_name, ' ', ', ') || '"'
                        ELSE p_name END,
                   p_type, 'automatic', 'vin' || CAST(p_partkey AS VARCHAR), 'ca',
                   CAST(p_size % 5 + 1 AS VARCHAR), CAST(p_size * 1000 AS VARCHAR), 'black', 'gray',
                   'dealer', CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR),
                   CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR), {SALE_TIME}) AS line
  FROM part),
ld AS (
  SELECT 'd' || CAST(doc_id AS VARCHAR) AS line_id,
         concat_ws(',', '2012', source, lang,
                   CASE WHEN doc_id % 2 = 0 THEN '"' || replace(text, '"', '""') || '"'
                        ELSE replace(text, chr(10), ' ') END,
                   'sedan', 'automatic', 'doc' || CAST(doc_id AS VARCHAR), 'ca', '3',
                   CAST(n_chars AS VARCHAR), 'black', 'gray', 'dealer', '10000', '10000', {SALE_TIME}) AS line
  FROM documents),
lines AS (SELECT * FROM lp UNION ALL SELECT * FROM ld),
tok AS (
  SELECT line_id,
         list_transform(regexp_extract_all(line || ',', '("[^"]*(?:""[^"]*)*"|[^,]*),', 1),
                        lambda t: CASE WHEN starts_with(t, '"') AND ends_with(t, '"') AND length(t) >= 2
                                  THEN replace(substr(t, 2, length(t) - 2), '""', '"') ELSE t END) AS f
  FROM lines),
rep AS (
  SELECT line_id, CAST(len(f) AS BIGINT) AS n_fields,
         CASE WHEN len(f) = 16 THEN 'ok' WHEN len(f) = 17 THEN 'repaired' ELSE 'bad' END AS status,
         CASE WHEN len(f) = 16 THEN f
              WHEN len(f) = 17 THEN list_concat(f[1:3], [f[4] || ', ' || {STRIP_U.format(x='f[5]')}], f[6:17])
         END AS g
  FROM tok)"""

ORACLE["record_repair"] = REPAIRED + """
SELECT line_id, n_fields, status, g[1] AS year, g[2] AS make, g[3] AS model, g[4] AS trim,
       g[5] AS body, g[7] AS vin, g[15] AS sellingprice
FROM rep"""

# the same records through files; without the ids of the lines
ORACLE["raw_file_repair"] = REPAIRED + """
SELECT n_fields, status, g[1] AS year, g[2] AS make, g[3] AS model, g[4] AS trim,
       g[5] AS body, g[7] AS vin, g[15] AS sellingprice
FROM rep"""

_NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
ORACLE["numeric_coercion"] = f"""
WITH ev AS (
  SELECT 'events' AS source, event_id AS id, regexp_extract(props, ':(.*)\\}}', 1) AS raw FROM events),
pt AS (
  SELECT 'part' AS source, p_partkey AS id,
         unnest(list_concat(string_split(p_name, ' '),
                            [CAST(p_retailprice AS VARCHAR), CAST(p_size AS VARCHAR) || 'd',
                             regexp_extract(p_brand, '#(.*)', 1),
                             ' ' || CAST(p_size AS VARCHAR) || 'e1 '])) AS raw
  FROM part),
u AS (SELECT * FROM ev UNION ALL SELECT * FROM pt),
s AS (SELECT source, id, raw, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS t FROM u)
SELECT source, id, raw,
       CASE WHEN regexp_matches(t, '{_NUM}') THEN TRY_CAST(t AS DOUBLE) END AS value
FROM s"""

_RAW = ["year", "make", "model", "trim", "body", "transmission", "vin", "state", "condition",
        "odometer", "color", "interior", "seller", "mmr", "sellingprice", "saledate"]


def _clean(i: int, name: str) -> str:
    """Typed value of field ``i`` of a repaired record."""
    number = f"CASE WHEN regexp_matches(trim(g[{i}]), '{_NUM}') THEN TRY_CAST(trim(g[{i}]) AS DOUBLE) END"
    if name in ("year", "odometer", "mmr", "sellingprice"):
        return f"CAST({number} AS BIGINT) AS {name}"
    if name == "condition":
        return f"{number} AS {name}"
    if name == "saledate":
        return (f"strftime(timezone('UTC', try_strptime(regexp_replace(g[{i}], ' \\([A-Z]{{3}}\\)$', ''), "
                f"'%a %b %d %Y %H:%M:%S GMT%z')), '%Y-%m-%d %H:%M:%S') || '+0000' AS {name}")
    text = norm_category(f"g[{i}]")
    return (f"coalesce({text}, 'unknown')" if name == "transmission" else text) + f" AS {name}"


CLEANED = REPAIRED + f""",
clean AS (SELECT line_id, {", ".join(_clean(i, c) for i, c in enumerate(_RAW, 1))}
          FROM rep WHERE status <> 'bad')"""

ORACLE["clean_sales"] = CLEANED + """
SELECT * FROM clean WHERE sellingprice IS NOT NULL AND odometer IS NOT NULL"""

ORACLE["cleaning_accounting"] = CLEANED + """,
written AS (SELECT count(*) AS n FROM clean WHERE sellingprice IS NOT NULL AND odometer IS NOT NULL)
SELECT CAST(count(*) AS BIGINT) AS rows_loaded, CAST(any_value(n) AS BIGINT) AS rows_written,
       CAST(count(*) - any_value(n) AS BIGINT) AS rows_removed
FROM rep, written"""

ORACLE["category_normalise"] = f"""
WITH a AS (
  SELECT 'part' AS source, CAST(p_partkey AS VARCHAR) AS id,
         CASE p_partkey % 4 WHEN 0 THEN ' ' || upper(p_name) || chr(9)
                            WHEN 1 THEN chr(160) || replace(p_name, ' ', '   ')
                            WHEN 2 THEN 'Navitgation  ' || p_brand
                            ELSE '   ' END AS raw
  FROM part),
b AS (SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS id,
             chr(9) || upper(source) || '  ' AS raw FROM documents)
SELECT source, id, {norm_category('raw')} AS value FROM a
UNION ALL SELECT source, id, {norm_category('raw')} AS value FROM b
UNION ALL
SELECT 'transmission' AS source, {KEYTEXT} AS id,
       coalesce({norm_category("nullif(l_returnflag, 'N')")}, 'unknown') AS value
FROM lineitem"""

_LOCAL = "(l_shipdate + to_hours(CAST(l_partkey % 24 AS BIGINT)))"
ORACLE["sale_time_parse"] = f"""
WITH a AS (
  SELECT {KEYTEXT} AS id,
         (CASE WHEN l_orderkey % 50 = 0 THEN 'Xyz' ELSE strftime({_LOCAL}, '%a') END) || ' ' ||
         strftime({_LOCAL}, '%b %d %Y %H:%M:%S') || ' GMT' ||
         (['-0800', '+0100', '-0500'])[l_suppkey % 3 + 1] ||
         ([' (PST)', '', ' (pst)', ' (EST)'])[l_linenumber % 4 + 1] AS text
  FROM lineitem),
b AS (
  SELECT 'e' || CAST(event_id AS VARCHAR) AS id,
         strftime(ts, '%a %b %d %Y %H:%M:%S') || ' GMT' || (['+0000', '-0800', '+0530'])[event_id % 3 + 1] AS text
  FROM events),
t AS (
  SELECT id, timezone('UTC', try_strptime(regexp_replace(text, ' \\([A-Z]{{3}}\\)$', ''),
                                          '%a %b %d %Y %H:%M:%S GMT%z')) AS ts
  FROM (SELECT * FROM a UNION ALL SELECT * FROM b))
SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '+0000' AS saledate_utc,
       CAST(year(ts) AS BIGINT) AS sale_year, CAST(month(ts) AS BIGINT) AS sale_month,
       strftime(ts, '%Y-%m') AS year_month
FROM t"""

ORACLE["integer_cast"] = f"""
SELECT {KEYS}, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_quantity * 1000 AS BIGINT) AS odometer
FROM lineitem"""

_FEATURE_OK = ("year IS NOT NULL AND make IS NOT NULL AND model IS NOT NULL AND body IS NOT NULL "
               "AND condition IS NOT NULL AND odometer IS NOT NULL AND saledate IS NOT NULL "
               "AND sellingprice IS NOT NULL")
ORACLE["clean_accounting"] = with_(SALE) + f"""
SELECT CAST(count(*) AS BIGINT) AS rows_loaded,
       CAST(count_if({_FEATURE_OK}) AS BIGINT) AS rows_written,
       CAST(count(*) - count_if({_FEATURE_OK}) AS BIGINT) AS rows_removed
FROM sale"""

ORACLE["feature_rows"] = with_(SALE) + f"""
SELECT {KEYS}, vehicle_age, year_month, sale_month, make, model, odometer, condition, body,
       sellingprice
FROM sale WHERE {_FEATURE_OK}"""

_FRAME_COLUMNS = "vehicle_age, sale_month, odometer, condition, year_month, make, model, body, sellingprice"
ORACLE["modeling_frame"] = with_(SALE, FRAME) + f"""
SELECT {KEYS}, {_FRAME_COLUMNS} FROM frame"""

ORACLE["modeling_sample"] = with_(SALE, FRAME) + f"""
SELECT {KEYS}, {_FRAME_COLUMNS} FROM frame
ORDER BY md5(concat_ws('|', {KEYS}, '42')), {KEYS}
LIMIT 10000"""

ORACLE["index_last_value"] = """
SELECT event_type AS series, strftime(ts, '%Y-%m-%d %H') AS period,
       arg_max(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL) AS value
FROM events GROUP BY 1, 2"""

_EVENT_SERIES = ["click", "error", "purchase", "signup", "view"]
_HOURS = ", ".join(f"max(value) FILTER (WHERE series = '{s}') AS {s}" for s in _EVENT_SERIES)
_FILLED = ", ".join(f"last_value({s} IGNORE NULLS) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING "
                    f"AND CURRENT ROW) AS {s}" for s in _EVENT_SERIES)
ORACLE["index_from_events"] = f"""
WITH last AS ({ORACLE["index_last_value"]}),
hours AS (SELECT period, {_HOURS} FROM last GROUP BY period),
filled AS (SELECT period, {_FILLED} FROM hours WHERE coalesce({", ".join(_EVENT_SERIES)}) IS NOT NULL),
base AS (
  SELECT list_reduce(list_sort(list(purchase)), lambda a, x: a + x) / count(*) AS base
  FROM filled WHERE substr(period, 1, 4) = '2024' AND purchase IS NOT NULL)
SELECT period, {", ".join(_EVENT_SERIES)}, round(purchase / (SELECT base FROM base), 6) AS multiplier
FROM filled"""

ORACLE["index_align"] = with_(INDEX) + """
SELECT year_month, round(price, 6) AS price, round(quantity, 6) AS quantity, volume FROM filled"""

IDX1 = PRICE + """,
idx1 AS (
  SELECT year_month, price,
         price / (SELECT list_reduce(list_sort(list(price)), lambda a, x: a + x) / count(price)
                  FROM price WHERE substr(year_month, 1, 4) = '1998') AS cpi_multiplier
  FROM price)"""

GAPPY = PRICE + """,
gp AS (SELECT * FROM price WHERE substr(year_month, 6, 2) <> '04' AND year_month >= '1995-06'),
gidx AS (
  SELECT year_month, price,
         price / (SELECT list_reduce(list_sort(list(price)), lambda a, x: a + x) / count(price)
                  FROM gp WHERE substr(year_month, 1, 4) = '1998') AS cpi_multiplier
  FROM gp)"""


def asof(src: str, index: str, month: str = "year_month") -> str:
    """Rows of ``src`` with the resolved month of ``index`` (exact, else the
    latest earlier month, clamped to the index range)."""
    return f"""(
  SELECT s.*, (SELECT max(i.year_month) FROM {index} i
               WHERE s.{month} IS NOT NULL
                 AND i.year_month <= least(greatest(s.{month}, b.lo), b.hi)) AS resolved_month
  FROM {src} s CROSS JOIN (SELECT min(year_month) AS lo, max(year_month) AS hi FROM {index}) b)"""


ORACLE["index_base_ratio"] = with_(IDX1) + """
SELECT year_month, round(price, 6) AS price, round(cpi_multiplier, 6) AS cpi_multiplier FROM idx1"""

ORACLE["enrich_left"] = with_(SALE, IDX1) + f"""
SELECT {', '.join('s.' + k for k in KEYS.split(', '))}, s.year_month, round(i.price, 6) AS price,
       round(i.cpi_multiplier, 6) AS cpi_multiplier
FROM sale s LEFT JOIN idx1 i ON s.year_month = i.year_month"""

ORACLE["enrich_missing_audit"] = with_(SALE, IDX1) + """
SELECT CAST(count_if(i.cpi_multiplier IS NULL) AS BIGINT) AS rows_without_index,
       coalesce(string_agg(DISTINCT CASE WHEN i.cpi_multiplier IS NULL THEN s.year_month END, ','
                           ORDER BY CASE WHEN i.cpi_multiplier IS NULL THEN s.year_month END), '')
       AS missing_months
FROM sale s LEFT JOIN idx1 i ON s.year_month = i.year_month"""

ORACLE["index_asof"] = with_(SALE, GAPPY) + f""",
r AS {asof('sale', 'gidx')}
SELECT {', '.join('r.' + k for k in KEYS.split(', '))}, r.year_month, r.resolved_month,
       r.resolved_month <> r.year_month AS is_carried,
       round(i.cpi_multiplier, 6) AS cpi_multiplier,
       round(r.sellingprice * i.cpi_multiplier, 6) AS adjusted_price
FROM r JOIN gidx i ON i.year_month = r.resolved_month"""

ORACLE["index_snapshot"] = with_(IDX1) + f""",
months AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS year_month FROM lineitem),
r AS {asof('months', 'idx1')}
SELECT r.year_month, r.resolved_month, round(i.cpi_multiplier, 4) AS cpi_multiplier,
       round(i.price, 6) AS price
FROM r JOIN idx1 i ON i.year_month = r.resolved_month"""

ORACLE["macro_snapshot"] = with_(INDEX) + f""",
wide AS (SELECT *, CASE WHEN year_month >= '1996-01' THEN volume END AS late FROM idx),
months AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS year_month FROM lineitem
           UNION ALL VALUES ('1980-01'), ('2050-12')),
r AS {asof('months', 'idx')}
SELECT r.year_month, r.resolved_month, round(w.quantity, 4) AS quantity, round(w.volume, 4) AS volume,
       round(w.late, 4) AS late, round(w.cpi_multiplier, 4) AS cpi_multiplier
FROM r JOIN wide w ON w.year_month = r.resolved_month"""

ORACLE["index_from_files"] = with_(INDEX) + """
SELECT year_month, round(price, 6) AS price, round(quantity, 6) AS quantity, volume,
       round(cpi_multiplier, 6) AS cpi_multiplier, 'oil' AS skipped FROM idx"""

ORACLE["catalogue_choices"] = """
SELECT DISTINCT p_brand AS make, p_name AS model FROM part
UNION ALL SELECT 'Brand#00', p_name FROM (SELECT DISTINCT p_name FROM part)"""

ORACLE["body_list"] = with_(SALE) + "SELECT DISTINCT lower(trim(body)) AS body FROM sale"

TEST_PRED = f""",
fb AS (SELECT *, {BUCKET} AS bucket FROM frame),
train AS (SELECT * FROM fb WHERE bucket >= 20),
test AS (SELECT * FROM fb WHERE bucket < 20),
gbt AS (
  SELECT make, body, CAST(sum(CAST(sellingprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS prediction
  FROM train GROUP BY make, body),
fbt AS (SELECT CAST(sum(CAST(sellingprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS fallback FROM train),
tp AS (
  SELECT t.*, coalesce(g.prediction, f.fallback) AS prediction
  FROM test t LEFT JOIN gbt g ON t.make = g.make AND t.body = g.body CROSS JOIN fbt f)"""

_FIXED = ", ".join(f"('{m}')" for m in FORWARD_PROJECTION_MONTHS)
ORACLE["index_projection"] = with_(SALE, FRAME, IDX1) + TEST_PRED + f""",
base AS (SELECT median(prediction) AS stage1_baseline FROM tp),
months AS (
  SELECT DISTINCT year_month FROM (
    SELECT strftime(l_shipdate, '%Y-%m') AS year_month FROM lineitem
    UNION ALL SELECT * FROM (VALUES {_FIXED}) v(year_month))),
r AS {asof('months', 'idx1')}
SELECT r.year_month, r.resolved_month, round(i.cpi_multiplier, 4) AS cpi_multiplier,
       round(b.stage1_baseline, 0) AS stage1_baseline,
       round(b.stage1_baseline * i.cpi_multiplier, 0) AS stage2_price,
       round((i.cpi_multiplier - 1.0) * 100, 1) AS delta_pct
FROM r JOIN idx1 i ON i.year_month = r.resolved_month CROSS JOIN base b"""


def metrics_sql(y: str, p: str, prefix: str = "", extended: bool = False) -> str:
    e = f"({y} - {p})"
    cols = [f"round(avg(abs({e})), 2) AS {prefix}mae",
            f"round(sqrt(avg({e} * {e})), 2) AS {prefix}rmse",
            f"round(1 - sum({e} * {e}) / (count(*) * var_pop({y})), 4) AS {prefix}r2",
            f"round(avg(abs({e} / {y})) * 100, 2) AS {prefix}mape_percent"]
    if extended:
        cols += [f"round(avg(abs({e})) / avg({y}) * 100, 2) AS {prefix}mae_relative_percent",
                 f"round(avg({y}), 6) AS {prefix}mean_price"]
    return ",\n       ".join(cols)


ORACLE["index_backtest"] = with_(SALE, INDEX, FRAME) + TEST_PRED + f""",
r AS {asof('tp', 'idx')},
t AS (SELECT r.*, i.cpi_multiplier, r.prediction * i.cpi_multiplier AS stage2
      FROM r JOIN idx i ON i.year_month = r.resolved_month)
SELECT CAST(count(*) AS BIGINT) AS test_rows,
       {metrics_sql('sellingprice', 'prediction', 'stage1_')},
       {metrics_sql('sellingprice', 'stage2', 'stage2_')},
       round(min(cpi_multiplier), 6) AS multiplier_min, round(max(cpi_multiplier), 6) AS multiplier_max,
       round(avg(cpi_multiplier), 6) AS multiplier_mean, round(median(prediction), 6) AS stage1_median
FROM t"""

ORACLE["split_holdout"] = f"""
SELECT {KEYS}, {BUCKET} AS bucket, {BUCKET} < 20 AS is_test FROM lineitem"""

ORACLE["group_baseline"] = with_(SALE, FRAME) + f""",
fb AS (SELECT CAST(sum(CAST(sellingprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS fallback FROM frame),
p AS (SELECT f.*, coalesce(g.prediction, fb.fallback) AS prediction
      FROM frame f LEFT JOIN gb g ON f.make = g.make AND f.body = g.body CROSS JOIN fb)
SELECT {KEYS}, make, body, round(prediction, 6) AS prediction,
       round(greatest(prediction, 500.0), 6) AS floored_prediction,
       round(sellingprice / greatest(prediction, 500.0), 6) AS price_ratio
FROM p"""

ORACLE["median_baseline"] = with_(SALE, FRAME) + TEST_PRED + f""",
m AS (SELECT median(sellingprice) AS med FROM train),
s AS (SELECT t.sellingprice, m.med AS prediction FROM test t CROSS JOIN m)
SELECT CAST(count(*) AS BIGINT) AS n, {metrics_sql('sellingprice', 'prediction', extended=True)}
FROM s"""

ORACLE["regression_metrics"] = with_(SALE, FRAME) + TEST_PRED + f"""
SELECT CAST(count(*) AS BIGINT) AS n, {metrics_sql('sellingprice', 'prediction', extended=True)}
FROM tp"""

_SEGS = ("('Budget', 500, 5000, '$500–$5,000'), ('Economy', 5000, 10000, '$5,000–$10,000'), "
         "('Mid-Range', 10000, 20000, '$10,000–$20,000'), "
         "('Premium', 20000, 40000, '$20,000–$40,000'), "
         "('Luxury', 40000, 150000, '$40,000–$150,000')")
ORACLE["segment_metrics"] = with_(SALE, FRAME) + TEST_PRED + f""",
seg AS (SELECT * FROM (VALUES {_SEGS}) v(segment, lo, hi, price_range)),
j AS (SELECT tp.sellingprice, tp.prediction, seg.segment, seg.price_range
      FROM tp JOIN seg ON tp.sellingprice BETWEEN seg.lo AND seg.hi)
SELECT segment, price_range, CAST(count(*) AS BIGINT) AS n,
       round(avg(abs(sellingprice - prediction)), 2) AS mae,
       round(sqrt(avg((sellingprice - prediction) * (sellingprice - prediction))), 2) AS rmse,
       round(avg(abs((sellingprice - prediction) / sellingprice)) * 100, 2) AS mape_percent
FROM j GROUP BY segment, price_range HAVING count(*) >= 10"""

ORACLE["seasonality_rows"] = with_(SALE, INDEX, FRAME, ROWS) + f"""
SELECT {KEYS}, body, sale_month, year_month, round(normalized_price, 6) AS normalized_price,
       round(reference_prediction, 6) AS reference_prediction, round(price_ratio, 6) AS price_ratio
FROM srows"""

ORACLE["seasonality_backfill"] = CHAIN + """
SELECT body, sale_month, observations,
       CAST(sum(CASE WHEN observations >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY body) AS BIGINT)
         AS recommendation_eligible_months,
       sum(CASE WHEN observations >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY body) >= 2
         AS has_recommendation
FROM factors"""

ORACLE["seasonality_lookup"] = CHAIN + f""",
s AS (
  SELECT {KEYS}, sale_month, sellingprice,
         lower(trim(CASE WHEN l_linenumber = 7 THEN 'Wagon' ELSE ' ' || upper(body) || ' ' END)) AS bkey
  FROM sale)
SELECT {', '.join('s.' + k for k in KEYS.split(', '))}, s.sale_month,
       coalesce(f.seasonal_factor, 1.0) AS seasonal_factor,
       coalesce(f.confidence, 'no_data') AS confidence,
       coalesce(f.observations, 0) AS observations,
       coalesce(f.best_month, s.sale_month) AS best_month,
       coalesce(f.worst_month, s.sale_month) AS worst_month,
       round(s.sellingprice * coalesce(f.seasonal_factor, 1.0), 6) AS adjusted_price
FROM s LEFT JOIN factors f ON f.body = s.bkey AND f.sale_month = s.sale_month"""

ORACLE["seasonality_holdout"] = with_(SALE, INDEX, FRAME, ROWS) + f""",
flag AS (SELECT *, {BUCKET} < 20 AS is_test FROM srows),
trows AS (SELECT * FROM flag WHERE NOT is_test),
{factors_cte('trows', 't_').strip()},
j AS (SELECT f.*, coalesce(tf.seasonal_factor, 1.0) AS factor
      FROM flag f LEFT JOIN t_factors tf ON f.body = tf.body AND f.sale_month = tf.sale_month),
m AS (
  SELECT CAST(count_if(NOT is_test) AS BIGINT) AS training_rows,
         CAST(count_if(is_test) AS BIGINT) AS test_rows,
         avg(CASE WHEN is_test THEN abs(normalized_price - reference_prediction) END) AS baseline_mae,
         avg(CASE WHEN is_test THEN abs(normalized_price - reference_prediction * factor) END) AS stage3_mae
  FROM j)
SELECT training_rows, test_rows, round(baseline_mae, 2) AS baseline_mae, round(stage3_mae, 2) AS stage3_mae,
       round(stage3_mae - baseline_mae, 2) AS mae_change,
       round((stage3_mae / baseline_mae - 1.0) * 100, 2) AS mae_change_percent
FROM m"""

ORACLE["seasonality_summary"] = CHAIN + """,
per AS (
  SELECT body, max(body_observations) AS total_observations,
         CAST(sum(CAST(is_observed AS INTEGER)) AS BIGINT) AS observed_months,
         max(best_month_name) AS best_month, max(best_factor) AS best_factor,
         max(worst_month_name) AS worst_month, max(worst_factor) AS worst_factor,
         bool_or(has_recommendation) AS has_recommendation
  FROM factors GROUP BY body),
cov AS (
  SELECT CAST(count(*) AS BIGINT) AS bodies_total,
         CAST(count_if(has_recommendation) AS BIGINT) AS bodies_with_recommendation,
         CAST(count_if(NOT has_recommendation) AS BIGINT) AS bodies_without_recommendation
  FROM per),
top AS (SELECT * FROM per ORDER BY total_observations DESC, body ASC LIMIT 12)
SELECT top.*, cov.* FROM top CROSS JOIN cov"""

ORACLE["unobserved_months"] = with_(SPARSE_SALE) + """,
s AS (SELECT DISTINCT lower(trim(body)) AS body, sale_month FROM sale),
grid AS (SELECT b.body, CAST(m.m AS BIGINT) AS sale_month
         FROM (SELECT DISTINCT body FROM s) b CROSS JOIN range(1, 13) m(m)),
mn AS (SELECT * FROM (VALUES (1, 'Jan'), (2, 'Feb'), (3, 'Mar'), (4, 'Apr'), (5, 'May'), (6, 'Jun'),
                             (7, 'Jul'), (8, 'Aug'), (9, 'Sep'), (10, 'Oct'), (11, 'Nov'), (12, 'Dec')) t(m, name))
SELECT g.body, g.sale_month, mn.name AS month_name
FROM grid g JOIN mn ON mn.m = g.sale_month
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.body = g.body AND s.sale_month = g.sale_month)"""

ORACLE["catalogue"] = """
SELECT DISTINCT p_brand AS make, p_name AS model FROM part"""

_CATS = ["year_month", "make", "model", "body"]
_LEVELS = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level FROM frame"
                             for c in _CATS)
ORACLE["rare_levels"] = with_(SALE, FRAME) + f""",
lv AS ({_LEVELS})
SELECT feature, level, CAST(count(*) AS BIGINT) AS n, count(*) < 50 AS is_rare,
       CASE WHEN count(*) < 50 THEN '__rare__' ELSE level END AS encoded_level
FROM lv GROUP BY feature, level"""

ORACLE["ordinal_codes"] = with_(SALE, FRAME) + f""",
lv AS (SELECT DISTINCT * FROM ({_LEVELS}))
SELECT feature, level, CAST(row_number() OVER (PARTITION BY feature ORDER BY level) - 1 AS BIGINT) AS code
FROM lv"""

_NUMS = ["vehicle_age", "sale_month", "odometer", "condition"]
ORACLE["scaled_numerics"] = with_(SALE, FRAME) + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS sd FROM frame"
    for c in _NUMS)

ORACLE["log_linear_by_body"] = with_(SALE, FRAME) + """
SELECT body, CAST(count(*) AS BIGINT) AS n,
       round(regr_slope(ln(1 + sellingprice), CAST(odometer AS DOUBLE)), 12) AS slope,
       round(regr_intercept(ln(1 + sellingprice), CAST(odometer AS DOUBLE)), 6) AS intercept,
       round(regr_r2(ln(1 + sellingprice), CAST(odometer AS DOUBLE)), 6) AS r2
FROM frame GROUP BY body"""


ORACLE["example_bodies"] = CHAIN + """
SELECT body, sale_month, month_name, seasonal_factor, seasonal_delta_pct, observations, confidence
FROM factors WHERE body IN (SELECT * FROM (VALUES ('compact'), ('coupe'), ('large'), ('suv')) v(b))"""


_BODIES = ["compact", "large", "medium", "promo", "standard"]
_SCALED = [f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS x{i}" for i, c in enumerate(_NUMS)]
_ONE_HOT = [f"CAST(body = '{b}' AS DOUBLE) AS x{i}" for i, b in enumerate(_BODIES, len(_NUMS))]


def design(one_hot: bool) -> tuple[str, list[tuple[str, str]]]:
    """CTE ``x`` with scaled numbers (population deviation), one-hot bodies and the log price; names of its columns."""
    cols = _SCALED + (_ONE_HOT if one_hot else [])
    names = [(f"'{c}'", "NULL") for c in _NUMS] + ([("'body'", f"'{b}'") for b in _BODIES] if one_hot else [])
    return f"x AS (SELECT {', '.join(cols)}, ln(1 + sellingprice) AS y FROM frame)", names


def normal_equations(alpha: float, one_hot: bool = False) -> str:
    """Ridge coefficients (``alpha`` 0: least squares).

    Gaussian elimination without pivoting on the centred cross products, one
    CTE a step; the matrix is positive definite. The intercept carries no penalty.
    """
    x, names = design(one_hot)
    n = len(names)
    cross = [f"count(*) * covar_pop(x{i}, x{j}) + {alpha if i == j else 0.0} AS a{i}_{j}" for i in range(n) for j in range(n)]
    rhs = [f"count(*) * covar_pop(x{i}, y) AS a{i}_{n}" for i in range(n)]
    means = [f"avg(x{i}) AS m{i}" for i in range(n)]
    keep = ", ".join(["b"] + [f"m{i}" for i in range(n)])
    ctes = [x, f"e0 AS (SELECT avg(y) AS b, {', '.join(means + cross + rhs)} FROM x)"]
    for k in range(n):
        row = [f"a{k}_{j} / a{k}_{k} AS a{k}_{j}" for j in range(n + 1)]
        rest = [f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}"
                for i in range(n) if i != k for j in range(n + 1)]
        ctes.append(f"e{k + 1} AS (SELECT {keep}, {', '.join(row + rest)} FROM e{k})")
    level = (lambda v: f", {v} AS level") if one_hot else (lambda v: "")
    rows = [f"SELECT {c} AS feature{level(v)}, round(a{i}_{n}, 8) AS coefficient FROM e{n}" for i, (c, v) in enumerate(names)]
    fixed = " - ".join(["b"] + [f"m{i} * a{i}_{n}" for i in range(n)])
    rows.append(f"SELECT '(intercept)' AS feature{level('NULL')}, round({fixed}, 8) AS coefficient FROM e{n}")
    return with_(SALE, FRAME) + ",\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(rows)


def lasso(alpha: float, sweeps: int = 200) -> str:
    """Lasso coefficients by coordinate descent, one step a row of a recursive CTE."""
    x, names = design(True)
    n = len(names)
    grid = "[" + ", ".join("[" + ", ".join(f"covar_pop(x{i}, x{j})" for j in range(n)) + "]" for i in range(n)) + "]"
    right = "[" + ", ".join(f"covar_pop(x{i}, y)" for i in range(n)) + "]"
    means = "[" + ", ".join(f"avg(x{i})" for i in range(n)) + "]"
    labels = ", ".join(f"({i + 1}, {c}, {v})" for i, (c, v) in enumerate(names))
    return f"""WITH RECURSIVE {with_(SALE, FRAME).strip()[len('WITH'):]},
{x},
m AS MATERIALIZED (SELECT {grid} AS g, {right} AS r, {means} AS mu, avg(y) AS b FROM x),
step AS (
  SELECT 0 AS k, list_transform(range({n}), lambda i: CAST(0 AS DOUBLE)) AS w
  UNION ALL
  SELECT k + 1, list_transform(w, lambda v, i: CASE WHEN i = j THEN
           (CASE WHEN c > 0 THEN 1 ELSE -1 END) * greatest(abs(c) - {alpha}, 0) / d ELSE v END)
  FROM (SELECT k, w, k % {n} + 1 AS j, m.g[k % {n} + 1][k % {n} + 1] AS d,
               m.r[k % {n} + 1] - list_dot_product(m.g[k % {n} + 1], w) + m.g[k % {n} + 1][k % {n} + 1] * w[k % {n} + 1] AS c
        FROM step, m WHERE k < {n * sweeps})),
done AS (SELECT w FROM step WHERE k = {n * sweeps})
SELECT l.feature, l.level, round(done.w[l.i], 8) AS coefficient
FROM done, (VALUES {labels}) l(i, feature, level)
UNION ALL
SELECT '(intercept)', NULL, round(m.b - list_dot_product(m.mu, done.w), 8) FROM done, m"""


ORACLE["linear_coefficients"] = normal_equations(0.0)
ORACLE["ridge_coefficients"] = normal_equations(10.0)
ORACLE["ridge_one_hot_coefficients"] = normal_equations(10.0, True)
ORACLE["lasso_one_hot_coefficients"] = lasso(0.002)
# the penalty exceeds every covariance with the log price: only the intercept is left
ORACLE["lasso_coefficients"] = with_(SALE, FRAME) + """
SELECT unnest(['vehicle_age', 'sale_month', 'odometer', 'condition', '(intercept)']) AS feature,
       unnest([0.0, 0.0, 0.0, 0.0, round(avg(ln(1 + sellingprice)), 8)]) AS coefficient
FROM frame"""

_SPLIT_CELLS = " UNION ALL ".join(
    [f"SELECT {i} AS f, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, r FROM res" for i, c in enumerate(_NUMS)]
    + [f"SELECT {i} AS f, '{c}' AS feature, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS v, r FROM res"
       for i, c in enumerate(_CATS, len(_NUMS))])
# 0.06: rate, 0.05: penalty, 20: rows of a leaf
ORACLE["boosted_first_split"] = with_(SALE, FRAME) + f""",
res AS (SELECT *, ln(1 + sellingprice) - avg(ln(1 + sellingprice)) OVER () AS r FROM frame),
cell AS (SELECT f, feature, v, count(*) AS n, sum(r) AS s FROM ({_SPLIT_CELLS}) GROUP BY f, feature, v),
run AS (SELECT *, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY f) AS na,
               sum(s) OVER (PARTITION BY f) AS sa, lead(v) OVER w AS up FROM cell WINDOW w AS (PARTITION BY f ORDER BY v)),
best AS (SELECT *, sl * sl / (nl + 0.05) + (sa - sl) * (sa - sl) / (na - nl + 0.05) - sa * sa / (na + 0.05) AS gain
         FROM run WHERE up IS NOT NULL AND nl >= 20 AND na - nl >= 20 ORDER BY gain DESC, f, v LIMIT 1)
SELECT feature, (v + up) / 2 AS threshold, side, round(gain, 6) AS gain,
       round(0.06 * CASE side WHEN 'left' THEN sl / (nl + 0.05) ELSE (sa - sl) / (na - nl + 0.05) END, 8) AS leaf_value
FROM best, (VALUES ('left'), ('right')) t(side)"""

ORACLE["raw_frame"] = with_(SALE) + f"""
SELECT {KEYS}, condition, odometer, CAST(year(saledate) - year AS BIGINT) AS vehicle_age, make, body,
       coalesce(transmission, 'unknown') AS transmission, sellingprice
FROM sale WHERE condition IS NOT NULL AND sellingprice BETWEEN 500 AND 150000 AND odometer <= 500000"""

ORACLE["tree_stump"] = with_(SALE, FRAME) + """,
per AS (SELECT make, count(*) AS n, sum(ln(1 + sellingprice)) AS s FROM frame GROUP BY make),
run AS (SELECT make, row_number() OVER (ORDER BY make) - 1 AS code, n, s,
               sum(n) OVER (ORDER BY make) AS nl, sum(s) OVER (ORDER BY make) AS sl,
               sum(n) OVER () AS na, sum(s) OVER () AS sa FROM per),
best AS (SELECT code AS cut, sl / nl AS lo, (sa - sl) / (na - nl) AS hi FROM run WHERE nl < na
         ORDER BY sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) DESC, code LIMIT 1)
SELECT make AS level, CAST(code AS BIGINT) AS code,
       round(CASE WHEN code <= cut THEN lo ELSE hi END, 8) AS log_price
FROM run, best"""
