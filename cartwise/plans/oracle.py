"""DuckDB SQL for the registered queries: an independent engine's version.

Every statement starts with the same adapter CTEs that map the parquet
tables onto the store tables (the DuckDB twin of ``cartwise.sources.tables``),
then states the operator's semantics directly in SQL.
"""

from __future__ import annotations

# Fixed values, written out so that nothing here comes from the code under test:
# windows relative to 2001-07-15, its Unix time, the age buckets (lower bound,
# code), the candidates of the trend (regParam, fitIntercept, elasticNetParam).
SINCE_24 = "DATE '1999-07-15'"
LAST6_LO, LAST6_HI = "DATE '2001-01-15'", "DATE '2001-07-15'"
FIRST = "DATE '2001-07-01'"
HIST_LO = {24: "DATE '1999-07-01'", 48: "DATE '1997-07-01'"}
HIST_HI = FIRST
NOW_SECS = 995155200
BRAND_AGES = [(16, 0), (20, 1), (25, 2), (30, 3), (40, 4), (50, 5), (60, 6)]
PROFILE_AGES = [(16, 0), (22, 1), (30, 2), (50, 3)]
BRAND_LABELS = [(0, "16-19"), (1, "20-24"), (2, "25-29"), (3, "30-39"), (4, "40-49"), (5, "50-59"), (6, "more than 60")]
PROFILE_LABELS = [(0, "16-21"), (1, "22-29"), (2, "30-49"), (3, "more than 50")]
GRID = [(0.1, True, 0.0), (0.1, True, 0.5), (0.1, True, 1.0), (0.1, False, 0.0), (0.1, False, 0.5), (0.1, False, 1.0),
        (0.01, True, 0.0), (0.01, True, 0.5), (0.01, True, 1.0), (0.01, False, 0.0), (0.01, False, 0.5), (0.01, False, 1.0)]

ADAPTER = """
f_customer AS (
  SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name,
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              ELSE DATE '1995-12-31' - CAST((c_custkey * 7919) % 25000 AS INTEGER) END AS birthdate,
         CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 <= 2 THEN 'M' ELSE 'F' END AS sex,
         n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
f_state_map AS (
  SELECT n_name AS name, 'N' || LPAD(CAST(n_nationkey AS VARCHAR), 2, '0') AS abbreviation
  FROM nation WHERE n_nationkey < 20),
f_item AS (
  SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS title,
         CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN '' ELSE p_brand END AS brand,
         p_type || ' size ' || CAST(p_size AS VARCHAR) AS description,
         'img/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS imUrl,
         p_retailprice AS price
  FROM part),
f_item_tag AS (
  SELECT CAST(p_partkey AS BIGINT) AS item_id, SPLIT_PART(p_name, ' ', 1) AS tag FROM part
  UNION SELECT CAST(p_partkey AS BIGINT), SPLIT_PART(p_name, ' ', 2) FROM part
  UNION SELECT CAST(p_partkey AS BIGINT), p_type FROM part),
f_category AS (
  SELECT CAST(100 + DENSE_RANK() OVER (ORDER BY tag) AS INTEGER) AS id, tag AS name
  FROM (SELECT DISTINCT tag FROM f_item_tag) d),
f_item_category AS (
  SELECT item_id AS items_id, id AS categories_id FROM f_item_tag JOIN f_category ON tag = name),
f_order AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS BIGINT) AS customer_id,
         CAST(o_orderdate AS DATE) AS date, o_totalprice AS totalPrice
  FROM orders),
f_ordereditem AS (
  SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_partkey AS BIGINT) AS item_id,
         CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem),
f_review AS (
  SELECT CAST(o_custkey AS BIGINT) AS customer_id, CAST(l_partkey AS BIGINT) AS item_id,
         CAST(1 + (l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 5 AS DOUBLE) AS overall,
         CAST(l_quantity AS INTEGER) AS helpful,
         CAST((l_orderkey + l_linenumber * 11) % 40 AS INTEGER) AS unhelpful,
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
f_fixed_profile AS (
  SELECT c.id AS profile_id, CAST(p_partkey AS BIGINT) AS item_id, [p_type] AS categories
  FROM part JOIN f_category c ON c.name = p_type)"""


def _q(*ctes: str, body: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {ADAPTER}{extra}\n{body}"


MONEY = "CAST(SUM(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"

ORDERS_KNOWN_24 = f"""orders_known AS (
  SELECT o.*, c.state, s.abbreviation FROM f_order o
  JOIN f_customer c ON o.customer_id = c.id JOIN f_state_map s ON c.state = s.name
  WHERE o.date > {SINCE_24})"""

LINES_KNOWN_24 = f"""lines_known AS (
  SELECT li.item_id, li.quantity, o.date, c.state, s.abbreviation FROM f_ordereditem li
  JOIN f_order o ON li.order_id = o.id JOIN f_customer c ON o.customer_id = c.id
  JOIN f_item i ON i.id = li.item_id JOIN f_state_map s ON c.state = s.name
  WHERE o.date > {SINCE_24})"""

YM = "CAST(MONTH(date) AS INTEGER) AS month, CAST(YEAR(date) AS INTEGER) AS year"

AGE_SUMS = f"""age_sums AS (
  SELECT c.state, s.abbreviation,
         SUM({NOW_SECS} - EPOCH(c.birthdate)) AS s_all, COUNT(*) AS n_all,
         SUM(CASE WHEN sex = 'M' THEN {NOW_SECS} - EPOCH(c.birthdate) END) AS s_m,
         COUNT(CASE WHEN sex = 'M' THEN 1 END) AS n_m,
         SUM(CASE WHEN sex = 'F' THEN {NOW_SECS} - EPOCH(c.birthdate) END) AS s_f,
         COUNT(CASE WHEN sex = 'F' THEN 1 END) AS n_f
  FROM f_customer c JOIN f_state_map s ON c.state = s.name
  WHERE c.birthdate IS NOT NULL GROUP BY c.state, s.abbreviation)"""


def _mean(s: str, n: str) -> str:
    return f"(CAST({s} AS DOUBLE) / CAST({n} AS DOUBLE) / CAST(31536000 AS DOUBLE))"


def _age_code(age: str, buckets) -> str:
    whens = " ".join(f"WHEN {age} >= {lo} THEN {code}" for lo, code in reversed(buckets))
    return f"CAST(CASE {whens} ELSE 99 END AS INTEGER)"


def _shares_sql(key: str, source: str, buckets) -> str:
    age = f"(({NOW_SECS} - EPOCH(birthdate)) // 31536000)"
    return f"""per AS (
  SELECT customer_id, birthdate, {key}, CAST(SUM(quantity) AS BIGINT) AS quantity
  FROM ({source}) src GROUP BY customer_id, birthdate, {key}),
tot AS (SELECT customer_id, SUM(quantity) AS total FROM per GROUP BY customer_id)
SELECT per.customer_id, {_age_code(age, buckets)} AS age_code, {key}, quantity,
       CASE WHEN total > 0 THEN CAST(quantity AS DOUBLE) / CAST(total AS DOUBLE)
            ELSE CAST(quantity AS DOUBLE) END AS share
FROM per JOIN tot ON per.customer_id = tot.customer_id"""


PURCHASES = """SELECT o.customer_id, c.birthdate, li.item_id, li.quantity FROM f_ordereditem li
  JOIN f_order o ON li.order_id = o.id JOIN f_customer c ON c.id = o.customer_id
  WHERE c.birthdate IS NOT NULL"""


def _series_sql(value: str, source: str, history: int, keys: list[str]) -> str:
    k = "".join(f", {x}" for x in keys)
    return f"""SELECT CAST(YEAR(date) AS INTEGER) AS year, CAST(MONTH(date) AS INTEGER) AS month{k},
         {value} AS label
  FROM ({source}) src WHERE date >= {HIST_LO[history]} AND date < {HIST_HI}
  GROUP BY 1, 2{k}"""


VALUE_SUM = "CAST(CAST(SUM(CAST(totalPrice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS DOUBLE)"
UNIT_SUM = "CAST(CAST(SUM(quantity) AS BIGINT) AS DOUBLE)"
LINES_ALL = """SELECT li.item_id, li.quantity, o.date, o.customer_id FROM f_ordereditem li
  JOIN f_order o ON li.order_id = o.id"""
LINES_ITEM = LINES_ALL + " JOIN f_item i ON i.id = li.item_id"


def _stats_sql(cond: str, p: str) -> str:
    y = "CAST(label AS DECIMAL(38,2))"
    x = "CAST(t AS DECIMAL(38,0))"
    return (f"CAST(COUNT(CASE WHEN {cond} THEN 1 END) AS DOUBLE) AS {p}_n, "
            f"CAST(SUM(CASE WHEN {cond} THEN CAST(t AS BIGINT) END) AS DOUBLE) AS {p}_sx, "
            f"CAST(SUM(CASE WHEN {cond} THEN CAST(t AS BIGINT) * CAST(t AS BIGINT) END) AS DOUBLE) AS {p}_sxx, "
            f"CAST(SUM(CASE WHEN {cond} THEN {y} END) AS DOUBLE) AS {p}_sy, "
            f"CAST(SUM(CASE WHEN {cond} THEN {x} * {y} END) AS DOUBLE) AS {p}_sxy, "
            f"CAST(SUM(CASE WHEN {cond} THEN {y} * {y} END) AS DOUBLE) AS {p}_syy")


def _solve_sql(p: str, reg: str, enet: str, fi: str) -> tuple[str, str]:
    n = f"{p}_n"
    mx, my = f"({p}_sx / {n})", f"({p}_sy / {n})"
    mxx, mxy, myy = f"({p}_sxx / {n})", f"({p}_sxy / {n})", f"({p}_syy / {n})"
    var_x = f"({mxx} - ({mx} * {mx}))"
    var_y = f"({myy} - ({my} * {my}))"
    sd_x, sd_y = f"SQRT({var_x})", f"SQRT({var_y})"
    lam = f"({reg} / {sd_y})"
    c = (f"(CASE WHEN {fi} THEN (({mxy} - ({mx} * {my})) / ({sd_x} * {sd_y})) "
         f"ELSE ({mxy} / ({sd_x} * {sd_y})) END)")
    denom = f"((CASE WHEN {fi} THEN 1.0 ELSE ({mxx} / {var_x}) END) + ({lam} * (1.0 - {enet})))"
    w = f"((CAST(SIGN({c}) AS DOUBLE) * GREATEST(ABS({c}) - ({lam} * {enet}), 0.0)) / {denom})"
    slope = (f"(CASE WHEN ({var_x} <= 0 OR {var_y} <= 0) THEN "
             f"(CASE WHEN {fi} THEN 0.0 ELSE ({mxy} / {mxx}) END) ELSE (({w} * {sd_y}) / {sd_x}) END)")
    icpt = f"(CASE WHEN {fi} THEN ({my} - ({slope} * {mx})) ELSE 0.0 END)"
    return slope, icpt


def _trend_sql(series_body: str, value_expr: str) -> str:
    """Closed-form model choice on the key-based split, then the 12-month horizon."""
    grid_rows = ", ".join(f"({pos}, {reg}, {enet}, {'TRUE' if fi else 'FALSE'})"
                          for pos, (reg, fi, enet) in enumerate(GRID))
    is_val = "(t % 4) = 3"
    s_tr, i_tr = _solve_sql("tr", "reg", "enet", "fi")
    sse = (f"(((((va_syy - ((2.0 * _i) * va_sy)) - ((2.0 * _s) * va_sxy)) + ((va_n * _i) * _i)) "
           f"+ (((2.0 * _i) * _s) * va_sx)) + ((_s * _s) * va_sxx))")
    s_al, i_al = _solve_sql("al", "reg", "enet", "fi")
    return f"""series AS ({series_body}),
numbered AS (SELECT year, month, CAST(DENSE_RANK() OVER (ORDER BY year, month) - 1 AS INTEGER) AS t, label
  FROM series),
stats AS (SELECT {_stats_sql(f"NOT ({is_val})", "tr")}, {_stats_sql(is_val, "va")},
  {_stats_sql("TRUE", "al")}, MAX(t) AS max_t FROM numbered),
grid(pos, reg, enet, fi) AS (VALUES {grid_rows}),
cand AS (SELECT stats.*, grid.*, {s_tr} AS _s, {i_tr} AS _i FROM stats, grid),
scored AS (SELECT *, COALESCE(CASE WHEN va_n > 0 THEN SQRT(GREATEST({sse}, 0.0) / va_n) ELSE 0.0 END,
  CAST('inf' AS DOUBLE)) AS rmse FROM cand),
best AS (SELECT * FROM scored ORDER BY rmse, pos LIMIT 1),
model AS (SELECT {s_al} AS slope, {i_al} AS intercept, max_t FROM best),
steps AS (SELECT h, {FIRST} + TO_MONTHS(CAST(h AS INTEGER)) AS d FROM range(0, 12) r(h)),
pred AS (SELECT CAST(MONTH(d) AS INTEGER) AS month, CAST(YEAR(d) AS INTEGER) AS year,
  (intercept + (slope * CAST((max_t + h) + 1 AS DOUBLE))) AS prediction FROM model, steps)
SELECT month, year, {value_expr} FROM pred"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["finances_monthly"] = _q(ORDERS_KNOWN_24, body=f"""
SELECT {YM}, {MONEY.format('totalPrice')} AS value FROM orders_known GROUP BY 1, 2""")
    q["finances_monthly_by_state"] = _q(ORDERS_KNOWN_24, body=f"""
SELECT {YM}, state, {MONEY.format('totalPrice')} AS sales, 'US-' || abbreviation AS abbreviation
FROM orders_known GROUP BY 1, 2, state, abbreviation""")
    q["stock_monthly"] = _q(LINES_KNOWN_24, body=f"""
SELECT {YM}, CAST(SUM(quantity) AS BIGINT) AS numProducts FROM lines_known GROUP BY 1, 2""")
    q["stock_monthly_by_state"] = _q(LINES_KNOWN_24, body=f"""
SELECT {YM}, state, CAST(SUM(quantity) AS BIGINT) AS sales, 'US-' || abbreviation AS abbreviation
FROM lines_known GROUP BY 1, 2, state, abbreviation""")
    q["stock_top_products"] = _q(LINES_KNOWN_24, body="""
SELECT l.item_id AS id, i.title, CAST(SUM(l.quantity) AS BIGINT) AS quantity
FROM lines_known l JOIN f_item i ON i.id = l.item_id GROUP BY l.item_id, i.title
ORDER BY quantity DESC, id ASC LIMIT 20""")
    q["best_reviewers"] = _q(body="""
SELECT c.name, r.customer_id AS customerId, CAST(SUM(helpful - unhelpful) AS BIGINT) AS usefullness,
       COUNT(*) AS numberOfReviews
FROM f_review r JOIN f_customer c ON r.customer_id = c.id GROUP BY c.name, r.customer_id
ORDER BY usefullness DESC, customerId ASC LIMIT 20""")
    q["customers_mean_age"] = _q(AGE_SUMS, body=f"""
SELECT {_mean('SUM(s_all)', 'SUM(n_all)')} AS average_age, {_mean('SUM(s_m)', 'SUM(n_m)')} AS average_age_male,
       {_mean('SUM(s_f)', 'SUM(n_f)')} AS average_age_female FROM age_sums""")
    q["customers_age_by_state"] = _q(AGE_SUMS, body=f"""
SELECT state AS name, 'US-' || abbreviation AS abbreviation, {_mean('s_all', 'n_all')} AS age FROM age_sums""")
    q["customers_by_state"] = _q(AGE_SUMS, body="""
SELECT state AS name, 'US-' || abbreviation AS abbreviation, n_all AS totalCustomers FROM age_sums""")
    q["customer_brand_shares"] = _q(_shares_sql("brand", f"""SELECT p.*, i.brand FROM ({PURCHASES}) p
  JOIN f_item i ON i.id = p.item_id WHERE i.brand IS NOT NULL AND i.brand <> ''""", BRAND_AGES), body="")
    q["customer_profile_shares_fixed"] = _q(_shares_sql("profile_id", f"""SELECT p.*, fp.profile_id FROM ({PURCHASES}) p
  JOIN f_fixed_profile fp ON fp.item_id = p.item_id""", PROFILE_AGES), body="")
    q["item_category_features"] = _q(body="""
SELECT ic.items_id AS item_id, c.id AS category_id, c.name AS category
FROM f_item_category ic JOIN f_category c ON ic.categories_id = c.id JOIN f_item i ON i.id = ic.items_id""")
    q["also_bought_pairs"] = _q(body="""
SELECT a.item_id, b.item_id AS r_item_id, ri.title, ri.brand, ri.imUrl, CAST(SUM(b.quantity) AS BIGINT) AS quantity
FROM f_ordereditem a JOIN f_item ai ON ai.id = a.item_id
JOIN f_ordereditem b ON a.order_id = b.order_id AND a.item_id <> b.item_id
JOIN f_item ri ON ri.id = b.item_id
GROUP BY a.item_id, b.item_id, ri.title, ri.brand, ri.imUrl""")
    item_cols = ("i.id AS item_id, i.brand AS item_brand, i.description AS item_description, "
                 "i.imUrl AS item_imUrl, i.price AS item_price, i.title AS item_title")
    q["most_sold_6m"] = _q(body=f"""
SELECT {item_cols}, CAST(SUM(li.quantity) AS BIGINT) AS quantity
FROM f_ordereditem li JOIN f_order o ON li.order_id = o.id JOIN f_item i ON i.id = li.item_id
WHERE o.date >= {LAST6_LO} AND o.date < {LAST6_HI}
GROUP BY i.id, i.brand, i.description, i.imUrl, i.price, i.title
ORDER BY quantity DESC, item_id ASC LIMIT 50""")
    q["best_reviewed_6m"] = _q(f"""rv AS (SELECT r.item_id, r.overall FROM f_review r JOIN f_item i ON i.id = r.item_id
  WHERE r.date >= {LAST6_LO} AND r.date < {LAST6_HI})""",
                               "cm AS (SELECT SUM(overall) / COUNT(*) AS c FROM rv)",
                               """per AS (SELECT item_id, SUM(overall) AS _s, CAST(COUNT(*) AS DOUBLE) AS _n
  FROM rv GROUP BY item_id)""", body=f"""
SELECT {item_cols}, ((1.0 / (_n + 1.0)) * ((_n * (_s / _n)) + (1.0 * c))) AS averageOverall
FROM per JOIN f_item i ON i.id = per.item_id, cm
ORDER BY averageOverall DESC, item_id ASC LIMIT 50""")
    q["profile_recommender_fixed"] = _q("sizes AS (SELECT profile_id, COUNT(*) AS n_items FROM f_fixed_profile GROUP BY profile_id)",
                                        body="""
SELECT fp.item_id, ARRAY_TO_STRING(fp.categories, '|') AS categories, fp.profile_id, s.n_items
FROM f_fixed_profile fp JOIN f_item i ON i.id = fp.item_id JOIN sizes s ON s.profile_id = fp.profile_id""")
    q["value_series"] = _q(f"series AS ({_series_sql(VALUE_SUM, 'SELECT * FROM f_order', 24, [])})", body="""
SELECT year, month, CAST(DENSE_RANK() OVER (ORDER BY year, month) - 1 AS INTEGER) AS t, label FROM series""")
    q["unit_series"] = _q(f"series AS ({_series_sql(UNIT_SUM, LINES_ALL, 24, [])})", body="""
SELECT year, month, CAST(DENSE_RANK() OVER (ORDER BY year, month) - 1 AS INTEGER) AS t, label FROM series""")
    by_state_src = "SELECT o.*, c.state FROM f_order o JOIN f_customer c ON o.customer_id = c.id"
    q["value_series_by_state"] = _q(f"series AS ({_series_sql(VALUE_SUM, by_state_src, 48, ['state'])})", body="""
SELECT year, month, state, CAST(DENSE_RANK() OVER (ORDER BY state NULLS FIRST) - 1 AS INTEGER) AS state_idx, label FROM series""")
    lines_state = f"SELECT l.*, c.state FROM ({LINES_ALL}) l JOIN f_customer c ON l.customer_id = c.id"
    q["unit_series_by_state"] = _q(f"series AS ({_series_sql(UNIT_SUM, lines_state, 48, ['state'])})", body="""
SELECT year, month, state, CAST(DENSE_RANK() OVER (ORDER BY state NULLS FIRST) - 1 AS INTEGER) AS state_idx, label FROM series""")
    q["unit_series_by_item"] = _q(f"series AS ({_series_sql(UNIT_SUM, LINES_ITEM, 48, ['item_id'])})", body="""
SELECT year, month, item_id, CAST(DENSE_RANK() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_idx, label FROM series""")
    lines_prof = f"SELECT l.*, fp.profile_id FROM ({LINES_ITEM}) l JOIN f_fixed_profile fp ON fp.item_id = l.item_id"
    q["unit_series_by_profile_fixed"] = _q(f"series AS ({_series_sql(UNIT_SUM, lines_prof, 48, ['profile_id'])})",
                                           body="SELECT year, month, profile_id, label FROM series")
    q["forecast_horizon_by_state"] = _q(
        f"series AS ({_series_sql(VALUE_SUM, by_state_src, 48, ['state'])})",
        "states AS (SELECT state, CAST(DENSE_RANK() OVER (ORDER BY state NULLS FIRST) - 1 AS INTEGER) AS state_idx "
        "FROM (SELECT DISTINCT state FROM series) d)",
        f"steps AS (SELECT {FIRST} + TO_MONTHS(CAST(h AS INTEGER)) AS d FROM range(0, 12) r(h))",
        body="""
SELECT CAST(MONTH(d) AS INTEGER) AS month, CAST(YEAR(d) AS INTEGER) AS year, s.state, s.state_idx,
       'US-' || COALESCE(m.abbreviation, 'DESC') AS abbreviation
FROM states s LEFT JOIN f_state_map m ON m.name = s.state, steps""")
    q["sales_value_predictions"] = _q(_trend_sql(
        _series_sql(VALUE_SUM, "SELECT * FROM f_order", 24, []),
        "CASE WHEN ROUND(prediction, 2) >= 0 THEN ROUND(prediction, 2) ELSE 0.0 END AS salesValue"), body="")
    q["sales_predictions"] = _q(_trend_sql(
        _series_sql(UNIT_SUM, LINES_ALL, 24, []),
        "GREATEST(CAST(FLOOR(prediction + 0.5) AS INTEGER), 0) AS sales"), body="")
    # the documents, unnested, must say what the flat forms say
    for document, flat in (("customers_overview_means", "customers_mean_age"),
                           ("customers_overview_ages", "customers_age_by_state"),
                           ("customers_overview_totals", "customers_by_state"),
                           ("finances_overview_monthly", "finances_monthly"),
                           ("finances_overview_by_state", "finances_monthly_by_state"),
                           ("stock_overview_monthly", "stock_monthly"),
                           ("stock_overview_by_state", "stock_monthly_by_state"),
                           ("stock_overview_top_products", "stock_top_products"),
                           ("also_bought_rows", "also_bought_pairs")):
        q[document] = q[flat]
    q["profile_members_fixed"] = _q(body="""
SELECT fp.profile_id, i.id, i.title, i.brand, i.imUrl, i.price FROM f_fixed_profile fp JOIN f_item i ON i.id = fp.item_id""")
    with_category = "f_item i WHERE i.id IN (SELECT ic.items_id FROM f_item_category ic JOIN f_category c ON ic.categories_id = c.id)"
    q["item_profile_map_items"] = _q(body=f"""
SELECT i.id AS item_id, i.brand AS item_brand, i.description AS item_description, i.imUrl AS item_imUrl,
       i.title AS item_title, i.price AS item_price FROM {with_category}""")
    q["item_profiles_total"] = _q(body=f"SELECT COUNT(*) AS number_items, COUNT(*) > 0 AS none_empty FROM {with_category}")
    for name, source in (
            ("brand", f"SELECT p.customer_id FROM ({PURCHASES}) p JOIN f_item i ON i.id = p.item_id "
                      "WHERE i.brand IS NOT NULL AND i.brand <> ''"),
            ("profile", f"""SELECT p.customer_id FROM ({PURCHASES}) p
  JOIN (SELECT i.id FROM {with_category}) i ON i.id = p.item_id""")):
        q[f"segments_age_{name}_total"] = _q(body=f"""
SELECT COUNT(DISTINCT customer_id) AS number_customers, COUNT(*) > 0 AS at_most_k FROM ({source}) s""")
    # the reports of clusters formed by rule: customers by id modulo 5 with the largest value of each coordinate as the
    # centroid, items by their first category with the mean vector
    shares = {"brand": ("brand", f"""SELECT p.*, i.brand FROM ({PURCHASES}) p
  JOIN f_item i ON i.id = p.item_id WHERE i.brand IS NOT NULL AND i.brand <> ''""", BRAND_AGES, BRAND_LABELS),
              "profile": ("profile_id", f"""SELECT p.*, fp.profile_id FROM ({PURCHASES}) p
  JOIN f_fixed_profile fp ON fp.item_id = p.item_id""", PROFILE_AGES, PROFILE_LABELS)}
    for name, (key, source, ages, age_labels) in shares.items():
        ctes = (f"sh AS (WITH {_shares_sql(key, source, ages)})",
                f"voc AS (SELECT {key}, CAST(DENSE_RANK() OVER (ORDER BY {key}) - 1 AS INTEGER) AS pos FROM (SELECT DISTINCT {key} FROM sh))",
                f"""vec AS (SELECT customer_id, pos, share AS value FROM sh JOIN voc USING ({key})
  UNION ALL SELECT DISTINCT customer_id, CAST((SELECT COUNT(*) FROM voc) AS INTEGER), CAST(age_code AS DOUBLE) FROM sh)""",
                """cent AS (SELECT prediction, s.pos, COALESCE(MAX(value), 0.0) AS weight
  FROM (SELECT DISTINCT customer_id % 5 AS prediction FROM sh) c CROSS JOIN voc s
  LEFT JOIN vec ON vec.customer_id % 5 = prediction AND vec.pos = s.pos GROUP BY prediction, s.pos)""",
                f"""cluster AS (SELECT customer_id % 5 AS prediction, COUNT(DISTINCT customer_id) AS number_customers,
  CASE MAX(age_code) {" ".join(f"WHEN {c} THEN '{x}'" for c, x in age_labels)} ELSE 'Other' END AS age_interval FROM sh GROUP BY 1)""")
        if name == "brand":
            q["brand_vector_slots"] = _q(*ctes[:3], body="SELECT customer_id, pos, value FROM vec WHERE value <> 0")
            q["segments_age_brand_fixed"] = _q(*ctes, """heavy AS (SELECT prediction, pos,
  ROW_NUMBER() OVER (PARTITION BY prediction ORDER BY weight DESC, pos DESC) AS r FROM cent)""", body="""
SELECT CAST(prediction AS INTEGER) AS profile_id, number_customers, age_interval, STRING_AGG(brand, '|' ORDER BY r) AS brands
FROM cluster JOIN heavy USING (prediction) JOIN voc USING (pos) WHERE r <= 7 GROUP BY ALL""")
        else:
            q["segments_age_profile_fixed"] = _q(*ctes, """heavy AS (SELECT prediction, pos,
  ROW_NUMBER() OVER (PARTITION BY prediction ORDER BY weight DESC, pos) AS r FROM cent)""", body="""
SELECT CAST(prediction AS INTEGER) AS profile_id, number_customers, age_interval, c.name AS categories
FROM cluster JOIN heavy USING (prediction) JOIN voc USING (pos) JOIN f_category c ON c.id = profile_id WHERE r = 1""")
    by_first = ("has AS (SELECT DISTINCT i.id AS item_id, ic.categories_id AS id FROM f_item_category ic "
                "JOIN f_category c ON c.id = ic.categories_id JOIN f_item i ON i.id = ic.items_id)",
                "voc AS (SELECT id, name, CAST(DENSE_RANK() OVER (ORDER BY id) - 1 AS INTEGER) AS pos FROM f_category)",
                "ass AS (SELECT item_id, MIN(pos) AS prediction FROM has JOIN voc USING (id) GROUP BY 1)",
                "sizes AS (SELECT prediction, COUNT(*) AS number_items FROM ass GROUP BY 1)",
                """lab AS (SELECT prediction, STRING_AGG(name, '|' ORDER BY pos) AS categories FROM (
  SELECT a.prediction, v.pos, v.name, COUNT(*) AS n FROM ass a JOIN has USING (item_id) JOIN voc v USING (id) GROUP BY ALL) x
  JOIN sizes USING (prediction) WHERE CAST(n AS DOUBLE) / number_items >= 0.5 GROUP BY 1)""")
    q["item_profiles_fixed"] = _q(*by_first, body="""
SELECT prediction AS profile_id, number_items, COALESCE(categories, '') AS categories FROM sizes LEFT JOIN lab USING (prediction)""")
    q["item_profile_map_fixed"] = _q(*by_first, body="""
SELECT prediction AS profile_id, item_id, COALESCE(categories, '') AS categories, i.brand AS item_brand,
       i.description AS item_description, i.imUrl AS item_imUrl, i.title AS item_title, i.price AS item_price
FROM ass JOIN f_item i ON i.id = item_id LEFT JOIN lab USING (prediction)""")
    steps = f"steps AS (SELECT {FIRST} + TO_MONTHS(CAST(h AS INTEGER)) AS d FROM range(0, 12) r(h))"
    ym = "CAST(MONTH(d) AS INTEGER) AS month, CAST(YEAR(d) AS INTEGER) AS year"
    item_series = f"series AS ({_series_sql(UNIT_SUM, LINES_ITEM, 48, ['item_id'])})"
    items = """items AS (SELECT item_id, CAST(DENSE_RANK() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_idx
  FROM (SELECT DISTINCT item_id FROM series) x)"""
    q["horizon_by_item"] = _q(item_series, items, steps, body=f"""
SELECT {ym}, items.item_id, item_idx, i.title FROM items LEFT JOIN f_item i ON i.id = items.item_id, steps""")
    q["sales_predictions_by_item_keys"] = _q(item_series, items, steps, body=f"""
SELECT {ym}, items.item_id AS itemId, i.title AS itemName FROM items LEFT JOIN f_item i ON i.id = items.item_id, steps""")
    q["horizon_by_profile_fixed"] = _q(steps, body=f"""
SELECT {ym}, p.profile_id, ARRAY_TO_STRING(p.categories, '|') AS categories
FROM (SELECT DISTINCT profile_id, categories FROM f_fixed_profile fp JOIN f_item i ON i.id = fp.item_id) p, steps""")
    # top 20 of factors that follow from the ids: users (id % 3, id % 2, 1), items (half of id % 4, id % 3, quarter of id % 5)
    q["recommend_products_fixed"] = _q("""scored AS (SELECT u.id AS customer_id, i.id,
  CAST((u.id % 3) * (i.id % 4) AS DOUBLE) / 2 + (u.id % 2) * (i.id % 3) + CAST(i.id % 5 AS DOUBLE) / 4 AS rating
  FROM f_customer u, f_item i WHERE u.id % 100 = 0)""", """ranked AS (SELECT *,
  CAST(ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY rating DESC, id) AS INTEGER) AS rank FROM scored)""", body="""
SELECT customer_id, rank, r.id, rating, title, brand, imUrl, price FROM ranked r JOIN f_item i ON i.id = r.id
WHERE rank <= 20 AND rating >= 3.0""")
    q["als_ratings"] = _q(body="SELECT customer_id, item_id, overall FROM f_review")
    q["sales_value_predictions_by_state_keys"] = (
        f"SELECT month, year, state, abbreviation FROM ({q['forecast_horizon_by_state']}) k")
    q["sales_predictions_by_state_keys"] = _q(
        f"series AS ({_series_sql(UNIT_SUM, lines_state, 48, ['state'])})", steps, body=f"""
SELECT {ym}, s.state, 'US-' || COALESCE(m.abbreviation, 'DESC') AS abbreviation
FROM (SELECT DISTINCT state FROM series) s LEFT JOIN f_state_map m ON m.name = s.state, steps""")
    return q
