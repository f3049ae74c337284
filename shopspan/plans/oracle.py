"""DuckDB SQL with the results the registered queries must give."""

from __future__ import annotations

import re

# Named subqueries; a statement gets the ones it mentions, directly or through others.
CTES: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def _with(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", text)):
            if word in CTES and word not in needed:
                visit(CTES[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + sql


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in ORACLE.items()}


END = "DATE '2001-08-01'"
N_WEEKS = 156
BANNERS = "('AMERICA', 'ASIA', 'EUROPE')"

# --- adapters -------------------------------------------------------------------

CTES["t_sale"] = """
SELECT o_custkey AS customer_id, l_orderkey AS transaction_number,
       CAST(o_orderdate AS DATE) AS fiscal_date, l_suppkey AS store_number, l_partkey AS item_id,
       CASE WHEN l_discount > 0.05 THEN l_linenumber ELSE 0 END AS offer_id,
       CAST(l_extendedprice * (1 - l_discount) * CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN -1 ELSE 1 END
            AS DECIMAL(18,4)) AS merch_sales,
       CAST(l_extendedprice * CAST(0.8 AS DOUBLE) AS DECIMAL(18,4)) AS product_cost,
       l_quantity AS unit_count,
       CASE WHEN l_linestatus = 'O' THEN l_quantity / 2 ELSE 0 END AS weight,
       CAST(floor(l_extendedprice / 100) * CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN -1 ELSE 1 END
            AS BIGINT) AS points_issued,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_linenumber ELSE 0 END AS BIGINT) AS points_redeemed,
       CASE WHEN o_orderpriority = '1-URGENT' THEN l_orderkey END AS ecomm_trans_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
CTES["t_customer"] = """
SELECT c_custkey AS cx, c_custkey // 2 AS hhn, nullif(c_mktsegment, 'HOUSEHOLD') AS card_type,
       c_custkey % 31 <> 0 AND c_custkey % 23 <> 0 AS live FROM customer"""
CTES["t_store"] = f"""
SELECT s_suppkey AS location_id, n_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN {BANNERS} AND s_acctbal > 0 AND s_suppkey % 13 <> 0"""
CTES["t_item"] = """
SELECT p_partkey AS item_id, CAST(6600 + p_size * 40 AS VARCHAR) AS sub_cat, CASE WHEN p_partkey % 29 = 0 THEN 'C/C RECORD ' || p_name ELSE p_name END AS item_name, p_size % 17 <> 0 AS active,
       CASE WHEN p_size % 10 = 0 THEN 'N' ELSE 'Y' END AS financial
FROM part"""
CTES["t_date"] = """
SELECT CAST(d AS DATE) AS date, CAST(date_trunc('week', d) AS DATE) + 6 AS week_end_date,
       CAST(week(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS period,
       CAST(isoyear(d) AS INTEGER) AS year
FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS TIMESTAMP), max(o_orderdate),
                                    INTERVAL 1 DAY)) AS d FROM orders)"""

# --- calendar -------------------------------------------------------------------

CTES["t_bounds"] = f"""
SELECT min(week_end_date) AS min_week_end_date, max(week_end_date) AS max_week_end_date
FROM (SELECT week_end_date FROM t_date WHERE date < {END} GROUP BY 1 HAVING count(*) = 7
      ORDER BY 1 DESC LIMIT {N_WEEKS})"""
CTES["t_key"] = """
SELECT min(date) FILTER (week_end_date = min_week_end_date) AS min_date,
       max(date) FILTER (week_end_date = max_week_end_date) AS max_date,
       min(period) FILTER (week_end_date = min_week_end_date) AS start_period,
       max(period) FILTER (week_end_date = max_week_end_date) AS end_period,
       min(week) FILTER (week_end_date = min_week_end_date) AS start_week,
       max(week) FILTER (week_end_date = max_week_end_date) AS end_week,
       min(year) FILTER (week_end_date = min_week_end_date) AS start_year,
       max(year) FILTER (week_end_date = max_week_end_date) AS end_year
FROM t_date, t_bounds"""
ORACLE["min_max_complete_weeks"] = "SELECT * FROM t_bounds"
ORACLE["key_dates"] = """
SELECT min_date, max_date, start_period, end_period, start_year, end_year FROM t_key"""
ORACLE["key_weeks"] = "SELECT start_week, end_week, start_year, end_year FROM t_key"

# --- weekly tables --------------------------------------------------------------

CTES["t_line"] = """
SELECT fiscal_date, customer_id AS cx, store_number AS location_id, transaction_number, item_id,
       merch_sales, product_cost, unit_count, weight, points_issued, points_redeemed,
       CASE WHEN weight = 0 AND unit_count <> 0 THEN unit_count
            WHEN weight = 0 THEN unit_count ELSE weight END AS units,
       offer_id IS NOT NULL AND offer_id <> 0 AS offered,
       (sub_cat BETWEEN '8044' AND '8104' OR sub_cat BETWEEN '7431' AND '7440'
        OR sub_cat BETWEEN '6994' AND '7024'
        OR sub_cat IN ('8040', '6639', '6638', '6637', '6636', '6635', '6634')
        OR item_name LIKE '%C/C RECORD%') AS non_merch
FROM t_sale JOIN t_item USING (item_id), t_key
WHERE customer_id <> 0 AND fiscal_date BETWEEN min_date AND max_date
  AND store_number IN (SELECT location_id FROM t_store) AND active"""
CTES["t_txn"] = """
SELECT fiscal_date, cx, location_id, transaction_number, max(fiscal_date) AS transaction_dt,
       sum(merch_sales) AS sales_dollars, sum(product_cost) AS extended_cost,
       sum(CASE WHEN offered THEN merch_sales ELSE 0 END) AS sales_dollars_offer,
       sum(CASE WHEN offered THEN product_cost ELSE 0 END) AS extended_cost_offer,
       sum(units) AS units_sales, sum(CASE WHEN offered THEN units ELSE 0 END) AS units_sales_offer,
       sum(CASE WHEN non_merch THEN 0 ELSE units END) AS units_sales_real,
       sum(CASE WHEN offered AND NOT non_merch THEN units ELSE 0 END) AS units_sales_real_offer,
       count(DISTINCT CASE WHEN NOT non_merch THEN item_id END) AS unique_item_count,
       count(DISTINCT CASE WHEN NOT non_merch AND offered THEN item_id END) AS unique_item_count_offer,
       sum(unit_count) AS sales_quantity, sum(weight) AS sales_weight,
       sum(points_issued) AS points_earned, sum(-points_redeemed) AS points_redeemed,
       sum(CASE WHEN points_redeemed < 0 THEN units ELSE 0 END) AS redeem_count,
       count(*) AS row_count
FROM t_line GROUP BY 1, 2, 3, 4"""
ORACLE["transaction_grain"] = """
SELECT fiscal_date, cx, location_id, transaction_number, transaction_dt,
       CAST(sales_dollars AS DOUBLE) AS sales_dollars, CAST(extended_cost AS DOUBLE) AS extended_cost,
       CAST(sales_dollars_offer AS DOUBLE) AS sales_dollars_offer,
       CAST(extended_cost_offer AS DOUBLE) AS extended_cost_offer,
       units_sales, units_sales_offer, units_sales_real, units_sales_real_offer,
       unique_item_count, unique_item_count_offer, sales_quantity, sales_weight,
       CAST(points_earned AS BIGINT) AS points_earned,
       CAST(points_redeemed AS BIGINT) AS points_redeemed, redeem_count, row_count
FROM t_txn"""
CTES["t_online"] = """
SELECT DISTINCT fiscal_date, customer_id AS cx, transaction_number, 1 AS ecomm_flag
FROM t_sale, t_key
WHERE ecomm_trans_id IS NOT NULL AND customer_id <> 0 AND fiscal_date BETWEEN min_date AND max_date"""
CTES["t_flagged"] = """
SELECT t_txn.*, coalesce(ecomm_flag, 0) AS ecomm_flag
FROM t_txn LEFT JOIN t_online USING (fiscal_date, cx, transaction_number)"""
ORACLE["ecomm_flag_join"] = """
SELECT fiscal_date, cx, location_id, transaction_number, ecomm_flag FROM t_flagged"""
CTES["t_cx"] = """
SELECT cx, week AS week_number, year AS year_number, location_id, count(*) AS n_transaction,
       sum(ecomm_flag) AS n_ecomm_trans, sum(sales_dollars) AS sales_dollars,
       sum(extended_cost) AS extended_cost, sum(sales_dollars_offer) AS sales_dollars_offer,
       sum(units_sales) AS units_sales, sum(units_sales_offer) AS units_sales_offer,
       sum(points_earned) AS points_earned, sum(points_redeemed) AS points_redeemed,
       sum(redeem_count) AS redeem_count
FROM t_flagged JOIN t_date ON fiscal_date = date GROUP BY 1, 2, 3, 4"""
ORACLE["customer_weeks"] = """
SELECT cx, week_number, year_number, location_id, n_transaction,
       CAST(n_ecomm_trans AS BIGINT) AS n_ecomm_trans, CAST(sales_dollars AS DOUBLE) AS sales_dollars,
       CAST(extended_cost AS DOUBLE) AS extended_cost,
       CAST(sales_dollars_offer AS DOUBLE) AS sales_dollars_offer, units_sales, units_sales_offer,
       CAST(points_earned AS BIGINT) AS points_earned,
       CAST(points_redeemed AS BIGINT) AS points_redeemed, redeem_count
FROM t_cx"""
CTES["t_store_week"] = """
SELECT hhn, week_number, year_number, location_id, count(*) AS n_transaction,
       sum(n_ecomm_trans) AS n_ecomm_trans, sum(sales_dollars) AS sales_dollars,
       sum(extended_cost) AS extended_cost, sum(units_sales) AS units_sales,
       sum(units_sales_offer) AS units_sales_offer, sum(points_earned) AS points_earned,
       sum(points_redeemed) AS points_redeemed, sum(redeem_count) AS redeem_count
FROM t_cx JOIN t_customer USING (cx), t_key
WHERE hhn <> 0 AND live AND year_number BETWEEN start_year AND end_year
  AND NOT (year_number = start_year AND week_number < start_week)
  AND NOT (year_number = end_year AND week_number > end_week)
GROUP BY 1, 2, 3, 4"""
CTES["t_top"] = """
SELECT hhn, week_number, year_number, location_id AS maxsales_location_id
FROM t_store_week
QUALIFY row_number() OVER (PARTITION BY hhn, week_number, year_number
                           ORDER BY sales_dollars DESC, location_id) = 1"""
ORACLE["top_store"] = "SELECT * FROM t_top"
CTES["t_total"] = """
SELECT hhn, week_number, year_number, week_ending_date, n_transaction, n_ecomm_trans,
       maxsales_location_id, sales_dollars, extended_cost, units_sales,
       CASE WHEN units_sales <= 0 THEN 0.0 WHEN units_sales_offer > units_sales THEN 1.0
            WHEN units_sales_offer <= 0 THEN 0.0
            ELSE units_sales_offer / units_sales END AS unit_offer_ratio,
       points_earned, points_redeemed, redeem_count
FROM (SELECT hhn, week_number, year_number, CAST(sum(n_transaction) AS BIGINT) AS n_transaction,
             CAST(sum(n_ecomm_trans) AS BIGINT) AS n_ecomm_trans,
             sum(sales_dollars) AS sales_dollars, sum(extended_cost) AS extended_cost,
             sum(units_sales) AS units_sales, sum(units_sales_offer) AS units_sales_offer,
             CAST(sum(points_earned) AS BIGINT) AS points_earned,
             CAST(sum(points_redeemed) AS BIGINT) AS points_redeemed,
             sum(redeem_count) AS redeem_count
      FROM t_store_week GROUP BY 1, 2, 3)
JOIN t_top USING (hhn, week_number, year_number)
JOIN (SELECT DISTINCT year AS year_number, week AS week_number, week_end_date AS week_ending_date
      FROM t_date) USING (year_number, week_number)"""
CTES["t_global"] = """
SELECT year_number, week_number, quantile_disc(sales_dollars, 0.5) AS median_sales,
       quantile_disc(units_sales, 0.5) AS median_units_sales,
       round(avg(n_transaction), 5) AS avg_n_transaction,
       round(avg(n_ecomm_trans), 5) AS avg_n_ecomm_trans
FROM t_total GROUP BY 1, 2"""
CTES["t_batch"] = """
SELECT hhn, row_number() OVER (ORDER BY hhn) - 1 AS unique_hhn_num
FROM (SELECT DISTINCT hhn FROM t_total)"""
CTES["t_hh"] = """
SELECT hhn, week_number, year_number, week_ending_date, n_transaction, n_ecomm_trans,
       maxsales_location_id, CAST(sales_dollars AS DOUBLE) AS sales_dollars,
       CAST(extended_cost AS DOUBLE) AS extended_cost, units_sales,
       CAST(unit_offer_ratio AS DOUBLE) AS unit_offer_ratio, points_earned, points_redeemed,
       redeem_count, region AS divisional_regional_rollup,
       CAST(median_sales AS DOUBLE) AS median_sales, median_units_sales, avg_n_transaction,
       avg_n_ecomm_trans, unique_hhn_num // 100 AS hhn_batch_num
FROM t_total JOIN t_store ON maxsales_location_id = location_id
LEFT JOIN t_global USING (year_number, week_number) JOIN t_batch USING (hhn)"""
ORACLE["household_weeks"] = "SELECT * FROM t_hh"
ORACLE["household_batches"] = """
SELECT hhn, unique_hhn_num, unique_hhn_num // 100 AS hhn_batch_num FROM t_batch"""
ORACLE["stable_household_batches"] = """
SELECT hhn, unique_hhn_num, unique_hhn_num // 100 AS hhn_batch_num, run
FROM (SELECT hhn, run, row_number() OVER (ORDER BY run, hhn) - 1 AS unique_hhn_num
      FROM (SELECT hhn, CASE WHEN min(week_ending_date) <= (SELECT min(week_ending_date) FROM t_total) + 28 THEN 1 ELSE 2 END AS run
            FROM t_total GROUP BY 1))"""

# --- windows, splits, sampling ----------------------------------------------------

# CRC-32 of the household id's text (reflected polynomial 0xEDB88320), spelled out
# because DuckDB has no such function: a table built bit by bit, then a fold over bytes.
CTES["t_crc_table"] = """
SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
                        lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
                                          ELSE c >> 1 END, i) AS v
  FROM (SELECT unnest(range(256)) AS i))"""


def _crc(text: str) -> str:
    return (
        f"xor(list_reduce(list_transform(range(1, length({text}) + 1), "
        f"lambda p: CAST(ascii(substr({text}, p, 1)) AS BIGINT)), "
        "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
    )


CTES["t_hash"] = f"""
SELECT hhn, {_crc("s")} AS crc, {_crc("'123:' || s")} AS sample_crc, {_crc("'101:' || s")} AS fold_crc
FROM (SELECT hhn, CAST(hhn AS VARCHAR) AS s FROM (SELECT DISTINCT hhn FROM t_hh)), t_crc_table"""
SPACE = "CAST(4294967296 AS DOUBLE)"
CTES["t_axis_end"] = f"SELECT week_end_date - 7 AS last_week FROM t_date WHERE date = {END}"
ORACLE["week_window"] = f"""
SELECT last_week - 7 * ({N_WEEKS} - 1) AS start_week_ending_date, last_week AS end_week_ending_date,
       {N_WEEKS} AS n_weeks FROM t_axis_end"""
CTES["t_window"] = f"""
SELECT year_number, week_number, week_ending_date, hhn, n_transaction, n_ecomm_trans,
       maxsales_location_id, sales_dollars, extended_cost, units_sales, unit_offer_ratio,
       points_earned, points_redeemed, redeem_count, divisional_regional_rollup, median_sales,
       median_units_sales, avg_n_transaction, avg_n_ecomm_trans
FROM t_hh WHERE week_ending_date < {END} AND week_ending_date >= {END} - 7 * {N_WEEKS}"""
ORACLE["history_window"] = "SELECT * FROM t_window"
ORACLE["hash_split_train_test"] = f"""
SELECT part, hhn, count(*) AS n_weeks
FROM t_window JOIN t_hash USING (hhn)
JOIN (VALUES ('train', CAST(0.0 AS DOUBLE), CAST(0.7 AS DOUBLE)),
             ('test', CAST(0.7 AS DOUBLE), CAST(1.0 AS DOUBLE))) s(part, lo, hi)
  ON crc > lo * {SPACE} AND crc <= hi * {SPACE}
GROUP BY 1, 2"""
ORACLE["prediction_halves"] = f"""
SELECT half, hhn, count(*) AS n_weeks
FROM t_window JOIN t_hash USING (hhn)
JOIN (VALUES ('low', CAST(0.0 AS DOUBLE), CAST(0.5 AS DOUBLE)),
             ('high', CAST(0.5 AS DOUBLE), CAST(1.0 AS DOUBLE))) s(half, lo, hi)
  ON crc > lo * {SPACE} AND crc <= hi * {SPACE}
GROUP BY 1, 2"""
CTES["t_size"] = """
SELECT hhn, (count(*) - 1) // 4 AS size_bin FROM t_window GROUP BY 1"""
CTES["t_bin"] = "SELECT size_bin, count(*) AS hh_count FROM t_size GROUP BY 1"
CTES["t_cutoff"] = "SELECT CAST(floor(quantile_cont(hh_count, 0.6)) AS BIGINT) AS cutoff FROM t_bin"
ORACLE["size_bins"] = "SELECT * FROM t_bin"
ORACLE["bin_cutoff"] = "SELECT * FROM t_cutoff"
CTES["t_kept"] = """
SELECT hhn FROM (
  SELECT hhn, row_number() OVER (PARTITION BY size_bin ORDER BY sample_crc, hhn) AS place
  FROM t_size JOIN t_hash USING (hhn)), t_cutoff
WHERE place <= cutoff"""
ORACLE["undersample"] = """
SELECT hhn, week_ending_date, n_transaction FROM t_window WHERE hhn IN (SELECT hhn FROM t_kept)"""
ORACLE["folds"] = """
SELECT hhn, CAST(fold_crc % 5 AS INTEGER) AS fold
FROM t_hash WHERE hhn IN (SELECT hhn FROM t_window)"""

# --- features -----------------------------------------------------------------------

CTES["t_lookup"] = """
SELECT CAST(row_number() OVER (ORDER BY divisional_regional_rollup) AS INTEGER) AS div_reg_index,
       divisional_regional_rollup
FROM (SELECT DISTINCT divisional_regional_rollup FROM t_window)"""
ORACLE["region_lookup"] = "SELECT * FROM t_lookup"
CTES["t_small_lookup"] = """
SELECT CAST(row_number() OVER (ORDER BY divisional_regional_rollup) AS INTEGER) AS div_reg_index,
       divisional_regional_rollup
FROM (SELECT DISTINCT divisional_regional_rollup FROM t_hh
      WHERE divisional_regional_rollup IN (
        SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA' AND s_acctbal > 0))"""
ORACLE["region_index"] = """
SELECT hhn, week_ending_date, divisional_regional_rollup,
       coalesce(div_reg_index, (SELECT div_reg_index FROM t_small_lookup
                                WHERE divisional_regional_rollup = 'NATION_21')) AS div_reg_index
FROM t_hh LEFT JOIN t_small_lookup USING (divisional_regional_rollup)"""
ORACLE["unseen_regions"] = """
SELECT DISTINCT divisional_regional_rollup FROM t_hh
WHERE divisional_regional_rollup NOT IN (SELECT divisional_regional_rollup FROM t_small_lookup)"""
ORACLE["region_cardinality"] = """
SELECT count(DISTINCT div_reg_index) + 1 AS div_reg_unique_count
FROM t_window JOIN t_lookup USING (divisional_regional_rollup)"""
CTES["t_feature"] = """
SELECT hhn, week_ending_date, CAST(n_transaction AS INTEGER) AS n_transaction,
       CAST(n_ecomm_trans AS INTEGER) AS n_ecomm_trans,
       greatest(sales_dollars, 0) AS sales_dollars, greatest(extended_cost, 0) AS extended_cost,
       greatest(units_sales, 0) AS units_sales, greatest(points_earned, 0) AS points_earned,
       greatest(points_redeemed, 0) AS points_redeemed,
       CAST(trunc(redeem_count) AS BIGINT) AS redeem_count,
       CAST(avg_n_transaction AS DOUBLE) AS avg_n_transaction,
       CAST(avg_n_ecomm_trans AS DOUBLE) AS avg_n_ecomm_trans,
       median_sales, median_units_sales, unit_offer_ratio,
       cos(week_number * (2 * pi()) / 52) AS week_in_year_cos,
       sin(week_number * (2 * pi()) / 52) AS week_in_year_sin, div_reg_index
FROM t_window JOIN t_lookup USING (divisional_regional_rollup)"""
_RESCALED = (
    "n_transaction n_ecomm_trans sales_dollars extended_cost units_sales points_earned "
    "points_redeemed redeem_count avg_n_transaction avg_n_ecomm_trans median_sales "
    "median_units_sales"
).split()
_PLAIN = "unit_offer_ratio week_in_year_cos week_in_year_sin".split()
_NUMERIC = ", ".join(
    [f"round(ln(1 + {c}), 6) AS {c}" for c in _RESCALED] + [f"round({c}, 6) AS {c}" for c in _PLAIN]
)
ORACLE["features"] = f"SELECT hhn, week_ending_date, {_NUMERIC}, div_reg_index FROM t_feature"

# --- sequences ----------------------------------------------------------------------

CTES["t_axis"] = """
SELECT min(week_ending_date) AS first_week, max(week_ending_date) AS last_week,
       (max(week_ending_date) - min(week_ending_date)) // 7 + 1 AS n_axis FROM t_window"""
_ZERO = ", ".join(f"coalesce({c}, 0) AS {c}" for c in _RESCALED + _PLAIN)
CTES["t_grid"] = """
SELECT hhn, start, CAST(unnest(generate_series(CAST(start AS TIMESTAMP), CAST(last_week AS TIMESTAMP),
                                               INTERVAL 7 DAY)) AS DATE) AS week_ending_date
FROM (SELECT hhn, min(week_ending_date) AS start FROM t_feature GROUP BY 1), t_axis"""
CTES["t_dense"] = f"""
SELECT hhn, week_ending_date, CAST((week_ending_date - first_week) // 7 AS INTEGER) AS k,
       CAST((week_ending_date - start) // 7 AS INTEGER) AS t, {_ZERO},
       CAST(coalesce(div_reg_index, 0) AS DOUBLE) AS div_reg_index,
       CAST(coalesce(n_transaction, 0) > 0 AS INTEGER) AS event
FROM t_grid LEFT JOIN t_feature USING (hhn, week_ending_date), t_axis"""
ORACLE["densify"] = f"SELECT hhn, week_ending_date, k, t, {_NUMERIC}, div_reg_index FROM t_dense"
ORACLE["prediction_sequences"] = ORACLE["densify"]
_AHEAD = "(PARTITION BY hhn ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_LATER = "(PARTITION BY hhn ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
CTES["t_target"] = f"""
SELECT *, coalesce(min(CASE WHEN event = 1 THEN t END) OVER {_AHEAD},
                   max(t) OVER (PARTITION BY hhn) + 1) - t AS tte,
       max(event) OVER {_AHEAD} AS u
FROM t_dense"""
ORACLE["tte_discrete"] = "SELECT hhn, k, t, event, tte FROM t_target"
ORACLE["tte_continuous"] = f"""
SELECT hhn, k, t, 7 * t AS elapsed,
       7 * (coalesce(min(CASE WHEN event = 1 THEN t END) OVER {_LATER},
                     max(t) OVER (PARTITION BY hhn)) - t) AS tte
FROM t_dense"""
ORACLE["censoring"] = f"""
SELECT hhn, k, max(event) OVER {_AHEAD} AS u_discrete,
       coalesce(max(event) OVER {_LATER}, 0) AS u_continuous FROM t_dense"""
ORACLE["sequence_lengths"] = "SELECT hhn, count(*) AS seq_length FROM t_dense GROUP BY 1"
N_CUT = 17
CTES["t_train"] = f"""
SELECT hhn, k, t, {", ".join(f"lag({c}) OVER by_t AS {c}" for c in _RESCALED + _PLAIN)},
       lag(div_reg_index) OVER by_t AS div_reg_index, event,
       coalesce(min(CASE WHEN event = 1 THEN t END) OVER {_AHEAD}, max(t) OVER (PARTITION BY hhn) + 1) - t AS tte,
       max(event) OVER {_AHEAD} AS u
FROM t_dense, t_axis WHERE k < n_axis - {N_CUT}
WINDOW by_t AS (PARTITION BY hhn ORDER BY t)
QUALIFY row_number() OVER by_t > 1"""
_PAIR = f"hhn, k, t, {_NUMERIC}, div_reg_index, event, tte, u"
ORACLE["train_sequences"] = f"SELECT {_PAIR} FROM t_train"
CTES["t_pair"] = f"""
SELECT hhn, k, t, {", ".join(f"lag({c}) OVER by_t AS {c}" for c in _RESCALED + _PLAIN)},
       lag(div_reg_index) OVER by_t AS div_reg_index, event, tte, u
FROM t_target WINDOW by_t AS (PARTITION BY hhn ORDER BY t)
QUALIFY row_number() OVER by_t > 1"""
ORACLE["valid_sequences"] = f"""
SELECT {_PAIR}, CAST(k >= n_axis - {N_CUT} AS DOUBLE) AS weight
FROM t_pair, t_axis WHERE k < n_axis - {N_CUT} + 5
  AND hhn IN (SELECT hhn FROM t_pair, t_axis WHERE k BETWEEN n_axis - {N_CUT} AND n_axis - {N_CUT} + 4)"""
CTES["t_valid"] = f"""
SELECT t_pair.*, CAST(k >= n_axis - {N_CUT} AS DOUBLE) AS weight, n_axis, n_axis - {N_CUT} AS begin_k
FROM t_pair, t_axis
WHERE hhn IN (SELECT hhn FROM t_pair, t_axis WHERE k >= n_axis - {N_CUT})"""
CTES["t_since"] = """
SELECT hhn, CAST(any_value(begin_k) - 1 - coalesce(max(k) FILTER (tte = 0 AND k < begin_k), 0)
                 AS INTEGER) AS time_since,
       max(k) FILTER (tte = 0 AND k < begin_k) IS NOT NULL AS is_valid
FROM t_valid GROUP BY 1"""
ORACLE["time_since_last_event"] = "SELECT * FROM t_since"
_MASKED = ", ".join(
    [f"coalesce(round(ln(1 + {c}), 6), 0.133713) AS {c}" for c in _RESCALED]
    + [f"coalesce(round({c}, 6), 0.133713) AS {c}" for c in _PLAIN + ["div_reg_index"]]
)
ORACLE["dense_export_roundtrip"] = f"""
SELECT hhn, t, {_MASKED}, CAST(tte AS DOUBLE) AS tte, CAST(u AS DOUBLE) AS u,
       CASE WHEN u IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS weight
FROM (SELECT hhn, CAST(unnest(range(1, n_axis)) AS INTEGER) AS t FROM (SELECT DISTINCT hhn, n_axis FROM t_valid))
LEFT JOIN (SELECT * EXCLUDE (weight) FROM t_valid) USING (hhn, t)"""

# --- Weibull functions --------------------------------------------------------------

CTES["t_scored"] = """
SELECT hhn, k, t, tte, u, prior, begin_k, round(t / prior, 6) AS alpha,
       round(0.75::DOUBLE + prior / (prior + 8), 6) AS beta
FROM (SELECT *, CAST(coalesce(sum(event) OVER (PARTITION BY hhn ORDER BY t
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS prior
      FROM t_valid)"""
ORACLE["weibull_functions"] = """
SELECT hhn, k, round(h, 5) AS cumulative_hazard, round(beta / alpha * pow(s / alpha, beta - 1), 5) AS hazard,
       round(1 - exp(-h), 5) AS cdf,
       round(beta / alpha * pow(s / alpha, beta - 1) * exp(-h), 5) AS pdf,
       round(1 - exp(-h1), 5) AS cmf, round((1 - exp(-h1)) - (1 - exp(-h)), 5) AS pmf,
       round(CASE WHEN beta <= 1 THEN 0 ELSE alpha * pow(greatest(beta - 1, 0) / beta, 1 / beta) END, 5) AS mode,
       round(alpha * gamma(1 + 1 / beta), 5) AS mean,
       round(alpha * pow(-ln(0.5::DOUBLE), 1 / beta), 5) AS median,
       round(beta / alpha * pow((t + s) / alpha, beta - 1) * exp(gone - ahead), 5) AS excess_pdf,
       round(1 - exp(gone - ahead), 5) AS excess_cdf,
       round(alpha * pow(gone - ln(0.5::DOUBLE), 1 / beta) - t, 5) AS excess_median
FROM (SELECT *, tte + 1 AS s, pow((tte + 1) / alpha, beta) AS h, pow((tte + 2) / alpha, beta) AS h1,
             pow(t / alpha, beta) AS gone, pow((t + tte + 1) / alpha, beta) AS ahead FROM t_scored)"""
ORACLE["output_transform"] = """
SELECT hhn, k, round(10 * exp(0.4::DOUBLE * (prior / t)), 5) AS alpha,
       round(5 / (1 + exp(-(0.4::DOUBLE * (u - 0.5) - ln(4.0::DOUBLE)))), 5) AS beta FROM t_scored"""
CTES["t_loglik"] = """
SELECT hhn, k, u * ((h1 - h0) + ln(1 - exp(-(h1 - h0)))) - h1 AS discrete,
       u * (-h0 + ln(1 - exp(-(h1 - h0)))) - (1 - u) * h1 AS discrete_equality,
       u * (ln(beta) + beta * ln((tte + 1) / alpha)) - h1 AS continuous,
       u * (ln(beta) + beta * ln((tte + 1 + 1e-7) / alpha)) - pow((tte + 1 + 1e-7) / alpha, beta) AS continuous_eps,
       u * ln(beta / alpha * pow((tte + 1) / alpha, beta - 1)) - h1 AS continuous_equality,
       u * ((h1 - he) + ln(1 - (1 - 1e-7) * exp(-(h1 - he)))) - h1 AS training
FROM (SELECT *, pow(tte / alpha, beta) AS h0, pow((tte + 1) / alpha, beta) AS h1,
             pow((tte + 1e-7) / alpha, beta) AS he FROM t_scored)"""
ORACLE["censored_loglik"] = """
SELECT hhn, k, round(discrete, 5) AS discrete, round(discrete_equality, 5) AS discrete_equality,
       round(continuous, 5) AS continuous, round(continuous_equality, 5) AS continuous_equality,
       round(training, 5) AS training FROM t_loglik"""
ORACLE["loss"] = """
SELECT round(avg(-least(greatest(training, ln(1e-5)), ln(1 - 1e-5))), 6) AS discrete_loss,
       round(avg(-least(greatest(continuous_eps, ln(1e-6)), ln(1 - 1e-6))), 6) AS continuous_loss
FROM t_loglik"""
ORACLE["init_alpha"] = """
SELECT round(avg(tte), 6) AS mean_tte, round(avg(u), 6) AS mean_u,
       round(-1 / ln(1 - 1 / (avg(tte) + 1)) / avg(u), 6) AS init_alpha FROM t_train"""

# --- segments -----------------------------------------------------------------------

CTES["t_step"] = """
SELECT hhn, k, t, tte, u, t - 1 - last_event AS recency, n_events, region_id,
       CAST(floor(log2(t - last_event)) AS INTEGER) AS recency_bin,
       CAST(least(floor(n_events * 5 / t), 4) AS INTEGER) AS frequency_bin
FROM (SELECT *, coalesce(max(CASE WHEN event = 1 THEN t END) OVER past, 0) AS last_event,
             CAST(coalesce(sum(event) OVER past, 0) + 1 AS BIGINT) AS n_events,
             CAST(last_value(nullif(div_reg_index, 0) IGNORE NULLS) OVER (PARTITION BY hhn ORDER BY t
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS region_id
      FROM t_train
      WINDOW past AS (PARTITION BY hhn ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
ORACLE["step_segments"] = """
SELECT hhn, k, recency, n_events, region_id, recency_bin, frequency_bin FROM t_step"""
ORACLE["tte_histogram"] = """
SELECT region_id, recency_bin, frequency_bin, tte, u, CAST(count(*) AS DOUBLE) AS weight
FROM t_step GROUP BY 1, 2, 3, 4, 5"""
_LEVELS = {
    "overall": ("NULL", "NULL", "NULL"),
    "behaviour": ("NULL", "recency_bin", "frequency_bin"),
    "regional": ("region_id", "recency_bin", "frequency_bin"),
}
CTES["t_segment"] = " UNION ALL ".join(
    f"SELECT '{name}' AS candidate, CAST({r} AS INTEGER) AS region_id, CAST({c} AS INTEGER) AS recency_bin, "
    f"CAST({f} AS INTEGER) AS frequency_bin, CAST(count(*) AS DOUBLE) AS n_rows, CAST(sum(u) AS DOUBLE) AS n_events "
    "FROM t_step GROUP BY 1, 2, 3, 4 HAVING sum(u) > 0"
    for name, (r, c, f) in _LEVELS.items()
)
ORACLE["fit_optimality"] = """
SELECT candidate, coalesce(region_id, -1) AS region_id, coalesce(recency_bin, -1) AS recency_bin,
       coalesce(frequency_bin, -1) AS frequency_bin, n_rows, n_events, TRUE AS converged, TRUE AS best
FROM t_segment"""
CTES["t_current"] = """
SELECT *, CAST(floor(log2(recency + 1)) AS INTEGER) AS recency_bin,
       CAST(least(floor(n_events * 5 / n_steps), 4) AS INTEGER) AS frequency_bin
FROM (SELECT hhn, CAST((any_value(last_week) - max(week_ending_date) FILTER (n_transaction > 0)) // 7
                       AS INTEGER) AS recency,
             count(*) FILTER (n_transaction > 0) AS n_events,
             CAST((any_value(last_week) - min(week_ending_date)) // 7 + 1 AS INTEGER) AS n_steps,
             arg_max(div_reg_index, week_ending_date) AS region_id
      FROM t_feature, t_axis GROUP BY 1)"""
ORACLE["current_segments"] = "SELECT * FROM t_current"
_CLOSED = "n_rows / n_events AS alpha, 1 + 1 / (1 + n_events) AS beta"
CTES["t_closed"] = f"SELECT *, {_CLOSED} FROM t_segment"
ORACLE["score_closed_form"] = """
SELECT hhn, round(coalesce(r.alpha, b.alpha, o.alpha), 6) AS alpha, round(coalesce(r.beta, b.beta, o.beta), 6) AS beta
FROM t_current c
LEFT JOIN t_closed r ON r.candidate = 'regional' AND r.region_id = c.region_id
  AND r.recency_bin = c.recency_bin AND r.frequency_bin = c.frequency_bin
LEFT JOIN t_closed b ON b.candidate = 'behaviour' AND b.recency_bin = c.recency_bin AND b.frequency_bin = c.frequency_bin
LEFT JOIN t_closed o ON o.candidate = 'overall'"""

# --- weekly state -------------------------------------------------------------------

ORACLE["household_state"] = """
SELECT hhn, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS weeks,
       coalesce(string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) FILTER (n_transaction > 0), '') AS events,
       arg_max(divisional_regional_rollup, day) AS divisional_regional_rollup
FROM (SELECT *, week_ending_date - DATE '1970-01-01' AS day FROM t_window, t_axis WHERE week_ending_date > last_week - 140)
GROUP BY 1"""
ORACLE["state_segments"] = ORACLE["current_segments"]

# --- pooled segments ----------------------------------------------------------------

CTES["t_any_segment"] = CTES["t_segment"].replace(" HAVING sum(u) > 0", "")
_PARAMETERS = ("alpha", "beta")
CTES["t_estimate"] = """
SELECT candidate, region_id, recency_bin, frequency_bin,
       CASE WHEN n_events > 0 THEN ln(n_rows / n_events) END AS ln_alpha,
       CASE WHEN n_events > 0 THEN 1 / (1 + n_events) END AS ln_beta,
       CASE WHEN n_events > 0 THEN 1 / n_events END AS variance_alpha,
       CASE WHEN n_events > 0 THEN 2 / n_events END AS variance_beta
FROM t_any_segment"""


def _pooled_level(name: str, parent: str, on: str) -> None:
    """Gaps to the parents, their spread by moments in two steps, and the posterior means of a level."""
    CTES[f"t_gap_{name}"] = f"""
SELECT e.*, p.ln_alpha AS centre_alpha, p.ln_beta AS centre_beta
FROM t_estimate e JOIN {parent} p ON {on} WHERE e.candidate = '{name}'"""
    for step, weight in (("once", "1 / variance_{p}"), ("twice", "1 / (variance_{p} + spread_{p})")):
        rows = f"t_gap_{name}" if step == "once" else f"t_gap_{name}, t_once_{name}"
        CTES[f"t_{step}_{name}"] = "SELECT " + ", ".join(
            f"greatest(sum({weight} * (pow(ln_{{p}} - centre_{{p}}, 2) - variance_{{p}})) / sum({weight}), 1e-6) AS spread_{{p}}".format(p=p)
            for p in _PARAMETERS
        ) + f" FROM {rows}"
    CTES[f"t_pooled_{name}"] = "SELECT candidate, region_id, recency_bin, frequency_bin, " + ", ".join(
        f"CASE WHEN ln_{p} IS NULL THEN centre_{p} ELSE (ln_{p} * spread_{p} + centre_{p} * variance_{p}) / (spread_{p} + variance_{p}) END AS ln_{p}, "
        f"centre_{p}, spread_{p}" for p in _PARAMETERS
    ) + f" FROM t_gap_{name}, t_twice_{name}"


CTES["t_pooled_overall"] = """
SELECT candidate, region_id, recency_bin, frequency_bin, ln_alpha, CAST(NULL AS DOUBLE) AS centre_alpha, CAST(NULL AS DOUBLE) AS spread_alpha,
       ln_beta, CAST(NULL AS DOUBLE) AS centre_beta, CAST(NULL AS DOUBLE) AS spread_beta
FROM t_estimate WHERE candidate = 'overall' AND ln_alpha IS NOT NULL"""
_pooled_level("behaviour", "t_pooled_overall", "TRUE")
_pooled_level("regional", "t_pooled_behaviour", "e.recency_bin = p.recency_bin AND e.frequency_bin = p.frequency_bin")
ORACLE["segment_pooling"] = " UNION ALL ".join(
    "SELECT candidate, " + ", ".join(f"coalesce({c}, -1) AS {c}" for c in ("region_id", "recency_bin", "frequency_bin")) + ", "
    + ", ".join(f"round({k}_{p}, 6) AS {k}_{p}" for k in ("ln", "centre", "spread") for p in _PARAMETERS) + f" FROM t_pooled_{name}"
    for name in ("overall", "behaviour", "regional")
)
ORACLE["pooled_fit_optimality"] = ORACLE["fit_optimality"].replace("t_segment", "t_any_segment")

# --- parameters from the features ---------------------------------------------------

_INPUTS = [*_RESCALED, *_PLAIN, "log_recency", "purchase_share"]
_WEEK = ", ".join([f"ln(1 + {c}) AS {c}" for c in _RESCALED] + _PLAIN)
CTES["t_input"] = f"""
SELECT s.hhn, s.k, s.tte, s.u, ln(1 + s.recency) AS log_recency, s.n_events / CAST(s.t AS DOUBLE) AS purchase_share,
       {", ".join(f"w.{c}" for c in _RESCALED + _PLAIN)}
FROM t_step s JOIN (SELECT hhn, k, {_WEEK} FROM t_train) w USING (hhn, k)"""
CTES["t_input_scale"] = "SELECT " + ", ".join(
    f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) > 1e-9 THEN stddev_pop({c}) ELSE 1 END AS spread_{c}" for c in _INPUTS
) + " FROM t_input"


def _weight(k: int) -> str:
    return repr((k % 5 - 2) * 0.05)


def _raw_score(head: int) -> str:
    at = head * (len(_INPUTS) + 1)
    return " + ".join(
        [_weight(at)] + [f"({c} - mean_{c}) / spread_{c} * {_weight(at + 1 + k)}" for k, c in enumerate(_INPUTS)]
    )


_TO_PARAMETERS = "10 * exp(x0) AS alpha, 5 / (1 + exp(-(x1 - ln(4.0::DOUBLE)))) AS beta"
CTES["t_input_slope"] = f"""
SELECT *, u * (after - before + ln(1 - exp(before - after))) - after AS loglik,
       u * pull * (a0 - b0) - a0 AS slope_alpha, u * pull * (a1 - b1) - a1 AS slope_beta
FROM (
  SELECT *, 1 / (1 - exp(before - after)) AS pull, -beta * after AS a0, -beta * before AS b0,
         after * ln((tte + 1) / alpha) * turn AS a1,
         CASE WHEN tte > 0 THEN before * ln(greatest(tte, 1) / alpha) * turn ELSE 0 END AS b1
  FROM (
    SELECT *, pow((tte + 1) / alpha, beta) AS after, pow(tte / alpha, beta) AS before, beta * (1 - beta / 5) AS turn
    FROM (SELECT *, {_TO_PARAMETERS} FROM (
      SELECT *, {_raw_score(0)} AS x0, {_raw_score(1)} AS x1 FROM t_input, t_input_scale))))"""
ORACLE["feature_likelihood"] = "SELECT 'all' AS head, 'loglik' AS input, round(avg(loglik), 6) AS value FROM t_input_slope" + "".join(
    f" UNION ALL SELECT '{head}', '{c}', round(avg(slope_{head}{f' * (({c} - mean_{c}) / spread_{c})' if c != 'intercept' else ''}), 6)"
    " FROM t_input_slope"
    for head in ("alpha", "beta") for c in ["intercept", *_INPUTS]
)
ORACLE["feature_fit_optimality"] = " UNION ALL ".join(
    f"SELECT '{head}' AS head, '{c}' AS input, TRUE AS flat, TRUE AS converged" for head in ("alpha", "beta") for c in ["intercept", *_INPUTS]
)
_AT_END = ", ".join(
    [f"coalesce(max(ln(1 + {c})) FILTER (week_ending_date = last_week), 0) AS {c}" for c in _RESCALED]
    + [f"coalesce(max({c}) FILTER (week_ending_date = last_week), 0) AS {c}" for c in _PLAIN]
)
CTES["t_current_input"] = f"""
SELECT c.hhn, ln(1 + c.recency) AS log_recency, c.n_events / CAST(c.n_steps AS DOUBLE) AS purchase_share,
       {", ".join(f"w.{c}" for c in _RESCALED + _PLAIN)}
FROM t_current c JOIN (SELECT hhn, {_AT_END} FROM t_feature, t_axis GROUP BY 1) w USING (hhn)"""
ORACLE["feature_scores"] = f"""
SELECT hhn, round(alpha, 6) AS alpha, round(beta, 6) AS beta FROM (SELECT hhn, {_TO_PARAMETERS} FROM (
  SELECT *, {_raw_score(0)} AS x0, {_raw_score(1)} AS x1 FROM t_current_input, t_input_scale))"""

# --- churn metrics ------------------------------------------------------------------

CTES["t_frame"] = """
SELECT hhn, alpha, beta, tte, begin_k - 1 - last_event AS since
FROM t_scored
JOIN (SELECT hhn, max(k) AS last_event FROM t_scored WHERE tte = 0 AND k < begin_k GROUP BY 1)
  USING (hhn)
WHERE k = begin_k"""
ORACLE["eval_frame_without_last_event"] = """
SELECT hhn, alpha, beta, tte, 0 AS since FROM t_scored WHERE k = begin_k"""
ORACLE["eval_frame"] = "SELECT * FROM t_frame"
ORACLE["packed_evaluation"] = "SELECT * FROM t_frame"
CTES["t_outcome"] = """
SELECT hhn, box_width, CAST(tte > box_width - since AS INTEGER) AS churned,
       round(1 - (1 - exp(-pow((box_width - since + 1) / alpha, beta))), 9) AS score
FROM t_frame, (SELECT CAST(unnest(range(10, 17)) AS INTEGER) AS box_width)
WHERE box_width >= since"""
ORACLE["box_outcomes"] = "SELECT * FROM t_outcome"
CTES["t_calibration"] = """
SELECT box_width, bin, coalesce(mean_label, 0) AS mean_label, coalesce(mean_score, 0) AS mean_score,
       coalesce(n, 0) / total AS fraction
FROM (SELECT box_width, total, CAST(unnest(range(1, 11)) AS INTEGER) AS bin
      FROM (SELECT box_width, count(*) AS total FROM t_outcome GROUP BY 1))
LEFT JOIN (SELECT box_width, bin, avg(churned) AS mean_label, avg(score) AS mean_score, count(*) AS n
           FROM t_outcome JOIN (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS bin)
             ON score <= bin / 10 AND (score > (bin - 1) / 10 OR bin = 1)
           GROUP BY 1, 2) USING (box_width, bin)"""
ORACLE["calibration"] = """
SELECT box_width, bin, round(mean_label, 6) AS mean_label, round(mean_score, 6) AS mean_score,
       round(fraction, 6) AS fraction FROM t_calibration"""
CTES["t_ece"] = """
SELECT box_width, sum(fraction * abs(mean_label - mean_score)) AS ece FROM t_calibration GROUP BY 1"""
ORACLE["calibration_error"] = "SELECT box_width, round(ece, 6) AS ece FROM t_ece"


def _curves(rows: str, keys: str) -> str:
    """Counts per distinct score and their running sums down the scores."""
    return f"""
SELECT *, CAST(sum(pos) OVER down AS BIGINT) AS cum_pos, CAST(sum(neg) OVER down AS BIGINT) AS cum_neg,
       CAST(sum(pos) OVER (PARTITION BY {keys}) AS BIGINT) AS all_pos,
       CAST(sum(neg) OVER (PARTITION BY {keys}) AS BIGINT) AS all_neg,
       row_number() OVER down AS place, lead(pos) OVER down AS next_pos, lead(neg) OVER down AS next_neg
FROM (SELECT {keys}, score, CAST(sum(churned) AS BIGINT) AS pos,
             CAST(sum(1 - churned) AS BIGINT) AS neg FROM {rows} GROUP BY ALL)
WINDOW down AS (PARTITION BY {keys} ORDER BY score DESC)"""


CTES["t_curve"] = _curves("t_outcome", "box_width")
ORACLE["roc_points"] = """
SELECT box_width, round(score, 6) AS threshold, round(cum_neg / all_neg, 6) AS fpr,
       round(cum_pos / all_pos, 6) AS tpr
FROM t_curve WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT box_width, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM t_curve"""
ORACLE["pr_points"] = """
SELECT box_width, round(score, 6) AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS "precision",
       round(cum_pos / all_pos, 6) AS recall
FROM t_curve WHERE cum_pos - pos < all_pos
UNION ALL SELECT DISTINCT box_width, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) FROM t_curve"""


def _auc(curve: str, keys: str) -> str:
    return f"""
SELECT {keys}, sum(neg * (2 * cum_pos - pos)) / (2.0::DOUBLE * any_value(all_pos * all_neg)) AS auc,
       sum(pos / any_all * (cum_pos / (cum_pos + cum_neg))) AS ap
FROM (SELECT *, all_pos AS any_all FROM {curve}) GROUP BY {keys}"""


CTES["t_auc"] = _auc("t_curve", "box_width")
CTES["t_metric"] = """
SELECT box_width, auc, ap, ece, frac_in_box, observations
FROM t_auc JOIN t_ece USING (box_width)
JOIN (SELECT box_width, avg(1 - churned) AS frac_in_box, count(*) AS observations
      FROM t_outcome GROUP BY 1) USING (box_width)"""
ORACLE["horizon_metrics"] = """
SELECT box_width, round(auc, 6) AS auc, round(ap, 6) AS ap, round(ece, 6) AS ece,
       round(frac_in_box, 6) AS frac_in_box, observations FROM t_metric"""
ORACLE["mean_metrics"] = """
SELECT round(avg(auc), 6) AS mean_auc, round(avg(ap), 6) AS mean_ap, round(avg(ece), 6) AS mean_ece
FROM t_metric"""
CTES["t_fold_outcome"] = """
SELECT hhn, CAST(fold_crc % 5 AS INTEGER) AS fold, model, box_width,
       CAST(tte > box_width - since AS INTEGER) AS churned,
       round(1 - (1 - exp(-pow((box_width - since + 1) / alpha,
                               CASE WHEN model = 'champion' THEN 1 ELSE beta END))), 9) AS score
FROM t_frame JOIN t_hash USING (hhn), (SELECT unnest(['champion', 'challenger']) AS model),
     (SELECT CAST(unnest(range(10, 17)) AS INTEGER) AS box_width)
WHERE box_width >= since"""
CTES["t_fold_curve"] = _curves("t_fold_outcome", "fold, model, box_width")
CTES["t_fold_auc"] = _auc("t_fold_curve", "fold, model, box_width")
CTES["t_fold_ece"] = """
SELECT fold, model, box_width, sum(n * abs(label - prob)) / sum(n) AS ece
FROM (SELECT fold, model, box_width, bin, avg(churned) AS label, avg(score) AS prob, count(*) AS n
      FROM t_fold_outcome JOIN (SELECT unnest(range(1, 11)) AS bin)
        ON score <= bin / 10 AND (score > (bin - 1) / 10 OR bin = 1)
      GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3"""
CTES["t_fold"] = """
SELECT fold, model, avg(auc) AS mean_auc, avg(ap) AS mean_ap, avg(ece) AS mean_ece
FROM t_fold_auc JOIN t_fold_ece USING (fold, model, box_width) GROUP BY 1, 2"""
ORACLE["fold_metrics"] = """
SELECT fold, model, round(mean_auc, 6) AS mean_auc, round(mean_ap, 6) AS mean_ap,
       round(mean_ece, 6) AS mean_ece FROM t_fold"""
CTES["t_test"] = """
SELECT *, gap / (spread / sqrt(n_folds)) AS statistic
FROM (SELECT avg(champion) AS mean_champion, avg(challenger) AS mean_challenger,
             avg(champion - challenger) AS gap, stddev_samp(champion - challenger) AS spread,
             count(*) AS n_folds
      FROM (SELECT fold, max(mean_auc) FILTER (model = 'champion') AS champion,
                   max(mean_auc) FILTER (model = 'challenger') AS challenger
            FROM t_fold GROUP BY 1))"""
# Student's distribution function has a closed form for four degrees of freedom.
CTES["t_test_p"] = """
SELECT *, 0.5 + statistic * (statistic * statistic + 6) / (2 * pow(statistic * statistic + 4, 1.5)) AS p_value
FROM t_test"""
ORACLE["fold_compare"] = """
SELECT round(mean_champion, 5) AS mean_champion, round(mean_challenger, 5) AS mean_challenger,
       round(gap, 5) AS gap, round(spread, 5) AS spread, n_folds, round(statistic, 5) AS statistic,
       round(p_value, 5) AS p_value, CASE WHEN p_value <= 0.05 THEN 'promote' ELSE 'keep' END AS decision
FROM t_test_p"""
CTES["t_fold_n"] = "SELECT count(DISTINCT fold) AS n, count(DISTINCT fold) FILTER (fold = 0) AS first FROM t_fold"
ORACLE["fold_compare_edges"] = """
SELECT 'constant_up' AS "case", n AS n_folds, FALSE AS undefined, TRUE AS p_in_0_1, TRUE AS p_near_0, 'promote' AS decision FROM t_fold_n
UNION ALL SELECT 'constant_down', n, FALSE, TRUE, FALSE, 'keep' FROM t_fold_n
UNION ALL SELECT 'tiny_spread', n, FALSE, TRUE, TRUE, 'promote' FROM t_fold_n
UNION ALL SELECT 'equal', n, TRUE, FALSE, FALSE, 'keep' FROM t_fold_n
UNION ALL SELECT 'one_fold', first, TRUE, FALSE, FALSE, 'keep' FROM t_fold_n
UNION ALL SELECT 'no_fold', 0, TRUE, FALSE, FALSE, 'default' FROM t_fold_n"""
ORACLE["best_run"] = """
SELECT fold, model, round(mean_auc, 6) AS mean_auc FROM t_fold WHERE fold * 10 <= 24
ORDER BY t_fold.mean_auc DESC LIMIT 1"""

# --- business reports -----------------------------------------------------------------

CTES["t_one"] = "SELECT hhn, score, churned FROM t_outcome WHERE box_width = 13"


def _report(n: int, name: str) -> str:
    edges = [1.0 / n * (i + 1) for i in range(n)]
    segment = " + ".join(f"CAST(score >= {e!r}::DOUBLE AS INTEGER)" for e in edges[:-1])
    ranges = ", ".join(f"'{lo:.2f} - {hi:.2f}'" for lo, hi in zip([0.0, *edges], edges))
    return f"""
SELECT segment, {name} AS segment_name, ([{ranges}])[segment + 1] AS prob_range,
       round(avg(score), 6) AS mean_prob, round(median(score), 6) AS median_prob,
       count(*) AS total_count, CAST(sum(churned) AS BIGINT) AS churned,
       round(sum(churned) / count(*) * 100, 6) AS percent_churned,
       round(sum(churned) * 100.0::DOUBLE / (SELECT sum(churned) FROM t_one), 6) AS percent_of_total_churned
FROM (SELECT *, {segment} AS segment FROM t_one) GROUP BY segment"""


ORACLE["risk_report"] = _report(4, "(['Low', 'Medium', 'High', 'At Risk'])[segment + 1]")
ORACLE["risk_report_deciles"] = _report(10, "CAST(segment AS VARCHAR)")
ORACLE["risk_report_check"] = """
SELECT segment, round(segment / 10, 2) AS left_edge, round((segment + 1) / 10, 2) AS right_edge,
       count(score) AS total_count, CAST(coalesce(sum(churned), 0) AS BIGINT) AS churned,
       round(sum(churned) * 100.0::DOUBLE / nullif(count(score), 0), 6) AS percent_churned
FROM (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS segment)
LEFT JOIN t_one ON score >= 0.1::DOUBLE * segment
  AND (score < 0.1::DOUBLE * (segment + 1) OR (segment = 9 AND score <= 1))
GROUP BY segment"""
ORACLE["score_histogram"] = """
SELECT series, bin, count(v) AS n
FROM (SELECT series, CAST(unnest(range(0, 10)) AS INTEGER) AS bin
      FROM (SELECT unnest(['model', 'truth']) AS series))
LEFT JOIN (SELECT series, bin, 1 AS v FROM (
             SELECT 'model' AS series, CAST(least(floor((score - (SELECT min(score) FROM t_one))
               / (SELECT max(score) - min(score) FROM t_one) * 10), 9) AS INTEGER) AS bin FROM t_one
             UNION ALL SELECT 'truth', least(churned * 10, 9) FROM t_one)) USING (series, bin)
GROUP BY 1, 2"""
ORACLE["scale_up"] = """
SELECT count(*) AS n_rows, CAST(sum(churned) AS BIGINT) AS n_churned,
       count(*) / 0.025::DOUBLE AS n_rows_scaled FROM t_one"""

# --- predictions ----------------------------------------------------------------------

LAST_WEEK = "DATE '2001-07-29'"
CTES["t_kpi"] = f"""
SELECT hhn, {LAST_WEEK} AS max_week_ending_date, max(week_ending_date) AS last_event,
       min(week_ending_date) AS first_event, sum(CAST(sales_dollars AS DECIMAL(38,4))) AS historical_sales,
       CAST(sum(n_transaction) AS INTEGER) AS historical_transactions
FROM t_hh WHERE week_ending_date BETWEEN {LAST_WEEK} - 7 * 155 AND {LAST_WEEK} GROUP BY 1"""
CTES["t_recency"] = """
SELECT *, CAST((max_week_ending_date - first_event) // 7 AS INTEGER) AS weeks_since_first_shop,
       CAST((max_week_ending_date - last_event) // 7 AS INTEGER) AS weeks_since_last_shop,
       CAST(ceil(((max_week_ending_date - first_event) / 7 + 1) / 4) AS INTEGER) AS tenure_4wk_periods,
       CAST(greatest(0, 13 - (max_week_ending_date - last_event) // 7) AS INTEGER) AS weeks_until_churned
FROM t_kpi"""
ORACLE["household_kpis"] = """
SELECT * REPLACE (CAST(historical_sales AS DOUBLE) AS historical_sales), 156 AS historical_kpis_num_weeks
FROM t_recency"""
CTES["t_churn"] = f"""
SELECT {END} AS prediction_date, max_week_ending_date, hhn, alpha, beta,
       exp(-pow(weeks_until_churned / alpha, beta)) AS churn_probability,
       13 AS churn_definition_weeks, weeks_until_churned, weeks_since_last_shop,
       weeks_since_first_shop, 'gap-rule' AS model_version
FROM t_recency
JOIN (SELECT hhn, round(n_steps / n_events, 6) AS alpha,
             round(0.75::DOUBLE + n_events / (n_events + 8), 6) AS beta
      FROM (SELECT hhn, count(*) FILTER (n_transaction > 0) AS n_events,
                   (any_value(last_week) - min(week_ending_date)) // 7 + 1 AS n_steps
            FROM t_feature, t_axis GROUP BY 1)) USING (hhn)"""
ORACLE["churn_output"] = """
SELECT * REPLACE (round(churn_probability, 6) AS churn_probability) FROM t_churn"""
CTES["t_latest"] = """
SELECT hhn, max_week_ending_date, prediction_date, churn_probability, weeks_since_last_shop, beta,
       CASE WHEN weeks_until_churned = 0 THEN alpha + 1 ELSE alpha END AS alpha,
       CASE WHEN weeks_until_churned = 0 THEN TIMESTAMP '2001-08-02 09:00:00'
            ELSE TIMESTAMP '2001-08-02 06:00:00' END AS table_update_dt
FROM t_churn"""
ORACLE["latest_prediction"] = """
SELECT hhn, max_week_ending_date, prediction_date, alpha, table_update_dt FROM t_latest"""

# --- gold tables ------------------------------------------------------------------------


def _tenure(years: int, week: str = LAST_WEEK) -> str:
    return f"""
SELECT hhn, {week} AS max_wed, first_event_trunc,
       CAST(({week} - first_event_trunc) // 7 AS INTEGER) AS weeks_since_first_shop_trunc,
       13 AS period_length_weeks,
       CAST(ceil((({week} - first_event_trunc) // 7 + 1) / 13) AS BIGINT) AS n_periods_tenure
FROM (SELECT hhn, min(week_end_date) - 7 AS first_event_trunc
      FROM t_sale JOIN t_date ON fiscal_date = date JOIN t_customer ON customer_id = cx
      WHERE date BETWEEN {week} - (364 * {years} - 1) AND {week} GROUP BY 1)"""


def _annual(years: int, week: str = LAST_WEEK) -> str:
    return f"""
SELECT hhn, round(CAST(sum(merch_sales) AS DOUBLE) / n_periods_tenure * 4, 0) AS annualized_sales,
       max_wed AS churn_max_week_ending_date
FROM t_sale JOIN t_customer ON customer_id = cx JOIN t_item USING (item_id)
JOIN ({_tenure(years, week)}) USING (hhn)
WHERE hhn <> 0 AND coalesce(card_type, '') <> 'MACHINERY' AND financial = 'Y'
  AND fiscal_date > first_event_trunc AND fiscal_date <= max_wed
GROUP BY hhn, n_periods_tenure, max_wed"""


ORACLE["base_tenure"] = _tenure(2)
CTES["t_annual"] = _annual(2)
CTES["t_annual_short"] = _annual(1)
CTES["t_annual_before"] = _annual(1, f"{LAST_WEEK} - 7")
ORACLE["annualized_sales"] = "SELECT * FROM t_annual"
ORACLE["rolling_sales"] = "SELECT * FROM t_annual_short UNION ALL SELECT * FROM t_annual_before"
CTES["t_gold"] = """
SELECT max_week_ending_date, hhn, p AS churn_probability, weeks_since_last_shop,
       round(1 - exp(-pow(1 / alpha, beta)), 4) AS next_week_shop_prob, annualized_sales,
       CASE WHEN p = 1 THEN 'Churned' WHEN p >= 0.75 THEN 'At Risk' WHEN p >= 0.5 THEN 'High'
            WHEN p >= 0.25 THEN 'Med' ELSE 'Low' END AS churn_segment, prediction_date
FROM (SELECT *, round(churn_probability, 4) AS p FROM t_latest)
JOIN (SELECT hhn, churn_max_week_ending_date AS max_week_ending_date, annualized_sales FROM t_annual)
  USING (hhn, max_week_ending_date)"""
ORACLE["household_churn"] = "SELECT * FROM t_gold"

# --- sinks --------------------------------------------------------------------------------

ORACLE["merge_annualized_sales"] = """
SELECT coalesce(n.hhn, o.hhn) AS hhn, coalesce(n.annualized_sales, o.annualized_sales) AS annualized_sales,
       coalesce(n.churn_max_week_ending_date, o.churn_max_week_ending_date) AS churn_max_week_ending_date
FROM t_annual n FULL JOIN t_annual_short o
  ON n.hhn = o.hhn AND n.churn_max_week_ending_date = o.churn_max_week_ending_date"""
ORACLE["merge_household_churn"] = """
SELECT * REPLACE (CASE WHEN churn_segment = 'Churned' THEN 0 ELSE weeks_since_last_shop END
                  AS weeks_since_last_shop) FROM t_gold"""
ORACLE["partition_overwrite"] = """
SELECT * FROM t_annual UNION ALL SELECT * FROM t_annual_before"""
ORACLE["read_as_of"] = """
SELECT *, 'version' AS pinned FROM t_annual_short UNION ALL SELECT *, 'time' FROM t_annual"""
ORACLE["table_history"] = """
SELECT version, committed_at, 'WRITE' AS operation, 9 AS days_since,
       (SELECT count(*) FROM t_annual_short) AS n_live_rows
FROM (VALUES (CAST(1 AS BIGINT), TIMESTAMP '2001-07-15'), (CAST(2 AS BIGINT), TIMESTAMP '2001-08-01'))
  v(version, committed_at)"""

# --- quality --------------------------------------------------------------------------------


def _checks(table: str, columns: str, numeric: str, rules: dict[str, str]) -> list[str]:
    parts = [
        f"SELECT 'no_nulls:{c}', count(*) FILTER ({c} IS NULL), count(*) FILTER ({c} IS NULL) = 0 FROM {table}"
        for c in columns.split()
    ]
    parts += [
        f"SELECT 'not_all_zero:{c}', count(*) FILTER ({c} = 0), count(*) FILTER ({c} = 0) < count(*) FROM {table}"
        for c in numeric.split()
    ]
    parts += [
        f"SELECT '{name}', count(*) FILTER ({bad}), count(*) FILTER ({bad}) = 0 FROM {table}"
        for name, bad in rules.items()
    ]
    return parts


def _floors(table: str) -> list[str]:
    return [
        f"SELECT '{name}', min(v), min(v) >= 1 FROM "
        f"(SELECT {measure} AS v FROM {table} GROUP BY year_number, week_number)"
        for name, measure in (
            ("rows_per_week", "count(*)"), ("sales_per_week", "sum(sales_dollars)"),
            ("units_per_week", "sum(units_sales)"),
        )
    ]


def _report_of(parts: list[str]) -> str:
    return (
        "SELECT a AS rule, CAST(b AS DOUBLE) AS observed, c AS passed FROM ("
        + "\nUNION ALL ".join(parts) + ") r(a, b, c)"
    )


_HH_NUMERIC = (
    "hhn week_number year_number n_transaction n_ecomm_trans maxsales_location_id sales_dollars "
    "extended_cost units_sales unit_offer_ratio points_earned points_redeemed redeem_count "
    "median_sales median_units_sales avg_n_transaction avg_n_ecomm_trans hhn_batch_num"
)
CTES["t_hh_money"] = "SELECT * REPLACE (CAST(sales_dollars AS DECIMAL(18,4)) AS sales_dollars) FROM t_hh"
ORACLE["quality_report"] = _report_of(
    _floors("t_hh_money")
    + _checks(
        "t_hh", _HH_NUMERIC + " week_ending_date divisional_regional_rollup", _HH_NUMERIC,
        {
            "avg_n_transaction_at_least_1": "avg_n_transaction < 1",
            "avg_n_ecomm_trans_not_0": "avg_n_ecomm_trans = 0",
            "unit_offer_ratio_in_0_1": "unit_offer_ratio < 0 OR unit_offer_ratio > 1",
        },
    )
)
_CX = (
    "cx week_number year_number location_id n_transaction n_ecomm_trans sales_dollars extended_cost "
    "sales_dollars_offer units_sales units_sales_offer points_earned points_redeemed redeem_count"
)
ORACLE["quality_customer_weeks"] = _report_of(_floors("t_cx") + _checks("t_cx", _CX, _CX, {}))
_CHURN_NUMERIC = (
    "hhn alpha beta churn_probability churn_definition_weeks weeks_until_churned "
    "weeks_since_last_shop weeks_since_first_shop"
)
CTES["t_churn_stamped"] = "SELECT *, TIMESTAMP '2001-08-02' AS table_update_dt FROM t_churn"
ORACLE["quality_churn_output"] = _report_of(
    _checks(
        "t_churn_stamped",
        _CHURN_NUMERIC + " prediction_date max_week_ending_date model_version table_update_dt",
        _CHURN_NUMERIC,
        {
            "churn_probability_in_0_1": "churn_probability < 0 OR churn_probability > 1",
            "weeks_until_churned_in_range": "weeks_until_churned < 0 OR weeks_until_churned > 13",
            "alpha_beta_positive": "alpha <= 0 OR beta <= 0",
            "weeks_since_shop_in_range": "weeks_since_last_shop > 156 OR weeks_since_first_shop > 156",
        },
    )
)
ORACLE["quality_household_churn"] = _report_of(
    ["SELECT 'exact_columns', 0, true"]
    + _checks(
        "t_gold",
        "max_week_ending_date hhn churn_probability weeks_since_last_shop next_week_shop_prob "
        "annualized_sales churn_segment prediction_date",
        "", {"churn_probability_in_0_1": "churn_probability < 0 OR churn_probability > 1"},
    )
    + ["SELECT 'households_per_week', 0, true", "SELECT 'not_empty', count(*), count(*) > 0 FROM t_gold"]
)
ORACLE["low_weeks_except_holiday"] = """
SELECT week_ending_date AS max_week_ending_date, count(*) AS n_households FROM t_hh
WHERE week_ending_date NOT IN (SELECT week_end_date FROM t_date WHERE strftime(date, '%m-%d') = '12-25')
GROUP BY 1 HAVING count(*) < 40"""
