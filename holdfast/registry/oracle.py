"""SQL counterparts of the registered queries, over the same tables.

Written from the meaning of each result, not from the Spark plans: self-joins
against all snapshots, sorts and window functions, whatever reads plainest.
"""

from __future__ import annotations

from holdfast import fixed
from holdfast.functions.wording import plain_label
from holdfast.sources import standin

_DAY = "86400000000.0"
#: numeric features of the audit: the model's inputs and what was left out of them
AUDITED = sorted({*fixed.NUMERIC_FEATURES, *fixed.DUPLICATED_FEATURES, *fixed.DUPLICATED_FEATURES.values(), *fixed.COLLINEAR_FEATURES})


def _floor(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / {_DAY}) AS BIGINT)"


def _trunc(a: str, b: str) -> str:
    return f"CAST(trunc((epoch_us({b}) - epoch_us({a})) / {_DAY}) AS BIGINT)"


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def _pct(a: str, b: str, digits: int = 2) -> str:
    return f"round(CAST({a} AS DOUBLE) / nullif({b}, 0) * 100, {digits})"


def _ts(day) -> str:
    return f"TIMESTAMP '{day:%Y-%m-%d %H:%M:%S}'"


_SNAPS = ", ".join(f"({_ts(d)}, '{s}')" for d, s in standin.SPLITS.items())
_AS_OF = _ts(standin.MAX_VALID_DATE)
_TRANSLATED = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in standin.TRANSLATION.items())
_OVERRIDDEN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in standin.OVERRIDES.items())

_BASE = f"""
li AS (
  SELECT *, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS ext,
    CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS dp,
    CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS tp
  FROM lineitem),
items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
    (ext * (100 - dp) + 50) // 100 AS price_c, (ext * tp + 50) // 100 AS freight_c
  FROM li),
shipped AS (SELECT l_orderkey, max(l_shipdate) AS delivered FROM lineitem GROUP BY 1),
ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS cust, o_orderstatus AS status, o_orderdate AS ts,
    delivered, o_orderdate + INTERVAL 30 DAY AS estimated, n_name AS state,
    o_orderpriority AS city, {_trunc('o_orderdate', 'delivered')} AS delivery_days,
    {_floor('o_orderdate + INTERVAL 30 DAY', 'delivered')} AS delay
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN shipped ON o_orderkey = l_orderkey),
category AS (
  SELECT p_partkey AS product_id, p_type,
    coalesce(CASE p_type {_TRANSLATED} END, CASE p_type {_OVERRIDDEN} ELSE 'unknown' END) AS cat
  FROM part),
order_value AS (
  SELECT order_id, {_sum('price_c')} + {_sum('freight_c')} AS total_c FROM items GROUP BY 1),
order_paid AS (
  SELECT l_orderkey AS order_id, {_sum('ext')} AS pay_c, avg(l_linenumber) AS inst
  FROM li GROUP BY 1),
order_type AS (
  SELECT order_id, ptype FROM (
    SELECT l_orderkey AS order_id, l_returnflag AS ptype, row_number() OVER (
      PARTITION BY l_orderkey ORDER BY count(*) DESC, l_returnflag) AS rn
    FROM lineitem GROUP BY 1, 2) WHERE rn = 1),
order_review AS (
  SELECT l_orderkey AS order_id, avg(1 + l_linenumber % 5) AS score
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
osum AS (
  SELECT ord.*, total_c, pay_c, inst, ptype, score FROM ord
  LEFT JOIN order_value USING (order_id) LEFT JOIN order_paid USING (order_id)
  LEFT JOIN order_type USING (order_id) LEFT JOIN order_review USING (order_id)),
ev AS (
  SELECT *, {_floor('prev', 'ts')} AS gap FROM (
    SELECT cust, ts, min_order, lag(ts) OVER (PARTITION BY cust ORDER BY ts) AS prev
    FROM (SELECT cust, ts, min(order_id) AS min_order FROM ord GROUP BY 1, 2))),
tickets AS (
  SELECT o_custkey AS cust, l_shipdate AS ts, l_linestatus = 'F' AS resolved,
    l_linestatus <> 'F' AND l_discount > 0.07 AS escalated, l_quantity AS hours,
    1 + l_linenumber % 5 AS happy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
campaigns AS (
  SELECT o_custkey AS cust, l_shipdate AS ts, l_linestatus = 'O' AS opened,
    l_linestatus = 'O' AND l_discount > 0.05 AS clicked,
    l_linestatus = 'O' AND l_discount > 0.05 AND l_tax > 0.04 AS converted,
    CASE l_linenumber % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'sms' ELSE 'push' END AS channel
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'),
interventions AS (
  SELECT o_custkey AS cust, l_shipdate AS ts,
    CASE l_linenumber % 4 WHEN 0 THEN 'discount_offer' WHEN 1 THEN 'personal_outreach'
      WHEN 2 THEN 'free_shipping' ELSE 'loyalty_points' END AS kind
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'N' AND l_quantity > 45)
"""

_BEHAVIOR = f"""
summary AS (
  SELECT cust, min(ts) AS first_purchase, max(ts) AS last_purchase, count(*) AS n_orders,
    avg(delivery_days) AS avg_delivery_days,
    count(*) FILTER (WHERE delivery_days > 46) AS n_late_deliveries,
    round(avg(score), 9) AS raw_score, {_sum('coalesce(total_c, 0)')} AS rev_c,
    {_sum('coalesce(has_voucher, 0)')} AS n_voucher_payments
  FROM osum LEFT JOIN (
    SELECT l_orderkey AS order_id, max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS has_voucher
    FROM lineitem GROUP BY 1) USING (order_id) GROUP BY 1),
behavior AS (
  SELECT *, coalesce(raw_score, (SELECT quantile_cont(raw_score, 0.5) FROM summary)) AS avg_review_score,
    rev_c / 100.0 AS total_revenue,
    ((SELECT count(*) FROM summary s2 WHERE s2.rev_c < s.rev_c)
      + ((SELECT count(*) FROM summary s3 WHERE s3.rev_c = s.rev_c) + 1) / 2.0)
      / (SELECT count(*) FROM summary) AS pr
  FROM summary s),
tiers AS (
  SELECT *, CASE WHEN pr >= 0.99 THEN 'platinum' WHEN pr >= 0.9 THEN 'gold'
      WHEN pr >= 0.6 THEN 'silver' ELSE 'bronze' END AS customer_tier,
    CASE WHEN pr >= 0.9 THEN 'high_value' WHEN pr >= 0.6 THEN 'standard'
      ELSE 'low_value' END AS segment FROM behavior),
costs AS (
  SELECT cust, CAST(floor(coalesce(hours, 0) * 150 + 0.5) AS BIGINT) / 100.0 AS support_cost,
    CAST(floor(coalesce(hours, 0) * 150 + 0.5) AS BIGINT) AS support_c, rev_c
  FROM behavior LEFT JOIN (SELECT cust, sum(hours) AS hours FROM tickets GROUP BY 1) USING (cust))
"""

_D = {n: f"INTERVAL {n} DAY" for n in (30, 90, 180)}
_NEG = "score <= 2"


def _feat(snaps: str, strict: bool = False) -> str:
    """Features of all snapshots; ``panel`` has the person-snapshot rows kept."""
    masked = """REPLACE (
    CASE WHEN delivered <= snap THEN delay END AS delay,
    CASE WHEN delivered <= snap THEN delivery_days END AS delivery_days,
    CASE WHEN delivered <= snap THEN delivered END AS delivered,
    CASE WHEN delivered IS NULL OR delivered <= snap THEN score END AS score)""" if strict else ""
    open_only = "ts + to_minutes(CAST(round(hours * 60) AS BIGINT)) <= snap" if strict else "true"
    return f"""
snap AS (SELECT * FROM (VALUES {snaps}) t(snap, split)),
past AS (SELECT snap, split, osum.* {masked} FROM snap JOIN osum ON ts <= snap),
panel AS (
  SELECT cust, snap, split FROM (
    SELECT DISTINCT cust, snap, split, first_value(split) OVER (
      PARTITION BY cust ORDER BY snap, order_id) AS fs FROM past) WHERE split = fs),
f_orders AS (
  SELECT cust, snap, max(ts) AS last_ts, min(ts) AS first_ts, count(*) AS n_rows,
    {_sum('coalesce(total_c, 0)')} / 100.0 AS lifetime_revenue,
    coalesce({_sum(f'total_c')}, 0) / 100.0 / nullif(count(total_c), 0) AS average_order_value,
    max(total_c) / 100.0 AS max_order_value,
    coalesce(sum(total_c) FILTER (WHERE ts > snap - {_D[90]}), 0) / 100.0 AS rev90,
    coalesce(sum(total_c) FILTER (WHERE ts > snap - {_D[180]} AND ts <= snap - {_D[90]}), 0)
      / 100.0 AS prev90,
    avg(delay) AS average_delivery_delay,
    avg(CASE WHEN delay > 0 THEN 1 ELSE 0 END) FILTER (WHERE delivered IS NOT NULL) AS late_delivery_rate,
    avg(delivery_days) AS average_delivery_days,
    avg(score) AS average_review_score,
    CASE WHEN count(score) > 0 THEN count(*) FILTER (WHERE {_NEG}) / CAST(count(*) AS DOUBLE) END
      AS negative_review_rate,
    avg(inst) AS installment_frequency, coalesce(sum(pay_c), 0) / 100.0 AS payment_value,
    avg(score) FILTER (WHERE ts > snap - {_D[90]})
      - avg(score) FILTER (WHERE ts > snap - {_D[180]} AND ts <= snap - {_D[90]}) AS review_trend_90d,
    avg(delay) FILTER (WHERE ts > snap - {_D[90]}) AS recent_delivery_delay
  FROM past GROUP BY 1, 2),
f_events AS (
  SELECT cust, snap, count(*) AS lifetime_orders,
    count(*) FILTER (WHERE ts > snap - {_D[30]}) AS e30,
    count(*) FILTER (WHERE ts > snap - {_D[90]}) AS e90,
    count(*) FILTER (WHERE ts > snap - {_D[180]}) AS e180,
    count(*) FILTER (WHERE ts > snap - {_D[180]} AND ts <= snap - {_D[90]}) AS eprev,
    avg(gap) AS purchase_gap_mean, stddev_samp(gap) AS purchase_gap_std
  FROM snap JOIN ev ON ts <= snap GROUP BY 1, 2),
f_next AS (SELECT cust, snap, min(ts) AS next_ts FROM snap JOIN ev ON ts > snap GROUP BY 1, 2),
f_tickets AS (
  SELECT cust, snap, count(*) AS n, count(*) FILTER (WHERE ts > snap - {_D[90]}) AS n90,
    avg(CAST(resolved AS INT)) FILTER (WHERE {open_only}) AS resolved,
    avg(CAST(escalated AS INT)) FILTER (WHERE {open_only}) AS escalated,
    avg(hours) FILTER (WHERE {open_only}) AS hours, avg(happy) FILTER (WHERE {open_only}) AS happy
  FROM snap JOIN tickets ON ts <= snap GROUP BY 1, 2),
f_campaigns AS (
  SELECT cust, snap, count(*) AS n, avg(CAST(opened AS INT)) AS opened,
    avg(CAST(clicked AS INT)) AS clicked, avg(CAST(converted AS INT)) AS converted,
    max(ts) AS last_touch
  FROM snap JOIN campaigns ON ts <= snap GROUP BY 1, 2),
f_touched AS (SELECT DISTINCT cust, snap FROM snap JOIN interventions ON ts <= snap),
bought AS (
  SELECT cust, snap, seller_id, cat, price_c FROM snap JOIN ord ON ts <= snap
  JOIN items USING (order_id) LEFT JOIN category USING (product_id)),
f_cat AS (
  SELECT cust, snap, count(*) AS n, sum(r * r) / nullif(sum(r) * sum(r), 0) AS hhi FROM (
    SELECT cust, snap, cat, CAST(sum(price_c) AS DOUBLE) AS r FROM bought
    WHERE cat IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2),
f_sel AS (
  SELECT cust, snap, count(*) AS n, sum(r * r) / nullif(sum(r) * sum(r), 0) AS hhi FROM (
    SELECT cust, snap, seller_id, CAST(sum(price_c) AS DOUBLE) AS r FROM bought GROUP BY 1, 2, 3)
  GROUP BY 1, 2),
f_pay AS (
  SELECT cust, snap, ptype FROM (
    SELECT cust, snap, ptype, row_number() OVER (
      PARTITION BY cust, snap ORDER BY count(*) DESC, ptype) AS rn
    FROM past WHERE ptype IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1),
geo_state AS (
  SELECT cust, state FROM (SELECT cust, state, row_number() OVER (
    PARTITION BY cust ORDER BY count(*) DESC, state) AS rn FROM ord GROUP BY 1, 2) WHERE rn = 1),
geo_city AS (
  SELECT cust, city FROM (SELECT cust, city, row_number() OVER (
    PARTITION BY cust ORDER BY count(*) DESC, city) AS rn FROM ord GROUP BY 1, 2) WHERE rn = 1),
feat AS (
  SELECT k.cust AS customer_unique_id, k.snap AS snapshot_date, k.split,
    {_floor('o.last_ts', 'k.snap')} AS days_since_last_purchase,
    e30 AS orders_last_30_days, e90 AS orders_last_90_days, e180 AS orders_last_180_days,
    lifetime_orders, lifetime_revenue, rev90 AS revenue_last_90_days, average_order_value,
    max_order_value,
    CAST(lifetime_orders AS DOUBLE) / greatest({_floor('o.first_ts', 'k.snap')}, 1) AS purchase_frequency,
    purchase_gap_mean, purchase_gap_std,
    {_floor('o.last_ts', 'k.snap')} AS days_since_previous_order,
    average_delivery_delay, late_delivery_rate, average_delivery_days, average_review_score,
    negative_review_rate, f_pay.ptype AS preferred_payment_method, installment_frequency,
    payment_value, rev90 - prev90 AS spend_trend_90d,
    e90 - eprev AS purchase_frequency_trend_90d, review_trend_90d,
    rev90 AS recent_90d_revenue, prev90 AS previous_90d_revenue, e90 AS recent_90d_order_count,
    CAST(lifetime_orders AS DOUBLE) / greatest({_floor('o.first_ts', 'k.snap')}, 1)
      AS lifetime_purchase_frequency,
    recent_delivery_delay, average_delivery_delay AS historical_delivery_delay,
    coalesce(t.n, 0) AS n_support_tickets, coalesce(t.n90, 0) AS n_tickets_last_90_days,
    t.resolved AS pct_tickets_resolved, t.escalated AS pct_tickets_escalated,
    t.hours AS avg_resolution_hours, t.happy AS avg_ticket_satisfaction,
    coalesce(c.n, 0) AS n_campaigns_received, c.opened AS pct_campaigns_opened,
    c.clicked AS pct_campaigns_clicked, c.converted AS pct_campaigns_converted,
    {_floor('c.last_touch', 'k.snap')} AS days_since_last_campaign,
    CAST(CASE WHEN f_touched.cust IS NOT NULL THEN 1 ELSE 0 END AS BIGINT)
      AS has_been_targeted_for_retention,
    {_floor('k.snap', 'next_ts')} AS days_to_next_purchase,
    CAST(CASE WHEN {_floor('k.snap', 'next_ts')} <= 180 THEN 0 ELSE 1 END AS BIGINT) AS churned,
    f_cat.n AS unique_categories, f_cat.hhi AS category_concentration,
    f_sel.n AS unique_sellers, f_sel.hhi AS seller_concentration,
    geo_state.state AS customer_state, geo_city.city AS customer_city
  FROM panel k JOIN f_orders o USING (cust, snap) JOIN f_events e USING (cust, snap)
  LEFT JOIN f_next USING (cust, snap) LEFT JOIN f_tickets t USING (cust, snap)
  LEFT JOIN f_campaigns c USING (cust, snap) LEFT JOIN f_touched USING (cust, snap)
  LEFT JOIN f_cat USING (cust, snap) LEFT JOIN f_sel USING (cust, snap)
  LEFT JOIN f_pay USING (cust, snap) LEFT JOIN geo_state USING (cust) LEFT JOIN geo_city USING (cust))
"""


_FEAT = _feat(_SNAPS)
# the score used for metrics: recency against 30 days per purchase
_P = "days_since_last_purchase / (days_since_last_purchase + 30.0 * lifetime_orders)"
_SCORED = f"{_BASE}, {_FEAT}, scored AS (SELECT *, {_P} AS p FROM feat)"
_VALUE = f"""{_BASE}, {_feat(f"({_AS_OF}, 'now')")}, {_BEHAVIOR},
risk AS (
  SELECT customer_unique_id, lifetime_revenue AS customer_value, {_P} AS p,
    lifetime_revenue * ({_P}) AS revenue_at_risk, segment, support_cost
  FROM feat JOIN tiers ON customer_unique_id = tiers.cust JOIN costs ON customer_unique_id = costs.cust),
edges AS (
  SELECT min(p) AS e0, quantile_cont(p, 0.5) AS e1, quantile_cont(p, 0.8) AS e2, max(p) AS e3 FROM risk),
tiered AS (
  SELECT risk.*, CASE WHEN p <= e1 THEN 'low' WHEN p <= e2 THEN 'medium' ELSE 'high' END AS risk_tier
  FROM risk, edges)"""

# Feature names by query.
GROUPS = {
    "snapshot_rfm": [
        "days_since_last_purchase",
        "orders_last_30_days",
        "orders_last_90_days",
        "orders_last_180_days",
        "lifetime_orders",
        "lifetime_revenue",
        "revenue_last_90_days",
        "average_order_value",
        "max_order_value",
        "purchase_frequency",
        "purchase_gap_mean",
        "purchase_gap_std",
        "days_since_previous_order",
        "spend_trend_90d",
        "purchase_frequency_trend_90d",
        "recent_90d_revenue",
        "previous_90d_revenue",
        "recent_90d_order_count",
        "lifetime_purchase_frequency",
    ],
    "snapshot_delivery": [
        "average_delivery_delay",
        "late_delivery_rate",
        "average_delivery_days",
        "recent_delivery_delay",
        "historical_delivery_delay",
    ],
    "snapshot_reviews_payments": [
        "average_review_score",
        "negative_review_rate",
        "review_trend_90d",
        "preferred_payment_method",
        "installment_frequency",
        "payment_value",
    ],
    "snapshot_support": [
        "n_support_tickets",
        "n_tickets_last_90_days",
        "pct_tickets_resolved",
        "pct_tickets_escalated",
        "avg_resolution_hours",
        "avg_ticket_satisfaction",
    ],
    "snapshot_campaigns": [
        "n_campaigns_received",
        "pct_campaigns_opened",
        "pct_campaigns_clicked",
        "pct_campaigns_converted",
        "days_since_last_campaign",
        "has_been_targeted_for_retention",
    ],
    "snapshot_items_hhi": [
        "unique_categories",
        "category_concentration",
        "unique_sellers",
        "seller_concentration",
    ],
    "snapshot_label": [
        "days_to_next_purchase",
        "churned",
    ],
}
GROUPS["snapshot_features_full"] = [
    *[name for names in GROUPS.values() for name in names],
    "customer_state",
    "customer_city",
]

# Features that are whole numbers or texts.
WHOLE = {
    "days_since_last_purchase",
    "orders_last_30_days",
    "orders_last_90_days",
    "orders_last_180_days",
    "lifetime_orders",
    "days_since_previous_order",
    "purchase_frequency_trend_90d",
    "recent_90d_order_count",
    "preferred_payment_method",
    "n_support_tickets",
    "n_tickets_last_90_days",
    "n_campaigns_received",
    "days_since_last_campaign",
    "has_been_targeted_for_retention",
    "unique_categories",
    "unique_sellers",
    "days_to_next_purchase",
    "churned",
    "customer_state",
    "customer_city",
}


def _columns(names: list[str]) -> str:
    return ", ".join(c if c in WHOLE else f"round({c}, 6) AS {c}" for c in names)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _check(name: str, count: str) -> str:
    return f"SELECT '{name}' AS name, CAST(({count}) AS BIGINT) AS violation_count"


_CHECKS = " UNION ALL ".join(
    [
        _check("duplicate_pk_orders", "SELECT count(*) - count(DISTINCT o_orderkey) FROM orders"),
        _check("duplicate_pk_products", "SELECT count(*) - count(DISTINCT p_partkey) FROM part"),
        _check("duplicate_pk_sellers", "SELECT count(*) - count(DISTINCT s_suppkey) FROM supplier"),
        _check(
            "orphan_fk_order_items",
            "SELECT count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL",
        ),
        _check(
            "orphan_fk_payments",
            "SELECT count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL",
        ),
        _check(
            "orphan_fk_reviews",
            "SELECT count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey "
            "WHERE o_orderkey IS NULL AND l_linestatus = 'F'",
        ),
        _check("negative_price", "SELECT count(*) FROM items WHERE price_c < 0"),
        _check("negative_freight_value", "SELECT count(*) FROM items WHERE freight_c < 0"),
        _check("negative_payment_value", "SELECT count(*) FROM li WHERE ext < 0"),
        _check("delivered_before_purchased", "SELECT count(*) FROM ord WHERE delivered < ts"),
        _check(
            "future_purchase_timestamp",
            "SELECT count(*) FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'",
        ),
        _check(
            "review_score_out_of_range",
            "SELECT count(*) FROM lineitem WHERE l_linestatus = 'F' AND (1 + l_linenumber % 5) NOT BETWEEN 1 AND 5",
        ),
        _check(
            "customer_identity_consistency",
            "SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey) > 1)",
        ),
        _check("late_delivery_outliers", "SELECT count(*) FROM ord WHERE delivery_days > 46"),
        _check(
            "same_timestamp_order_pairs",
            "SELECT count(*) FROM (SELECT cust, ts FROM ord GROUP BY 1, 2 HAVING count(*) > 1)",
        ),
        _check(
            "uncategorized_products",
            "SELECT count(*) FROM part WHERE p_type NOT IN ("
            + ", ".join(f"'{k}'" for k in standin.TRANSLATION)
            + ")",
        ),
    ]
)
_SEVERITY = "CASE WHEN name IN ('late_delivery_outliers', 'same_timestamp_order_pairs', 'uncategorized_products') THEN 'warning' ELSE 'critical' END"


def _pareto(cte: str, percents) -> str:
    """Top percents of ``cte(c)`` by a plain running sum."""
    rows = " UNION ALL ".join(
        f"""SELECT CAST({p} AS BIGINT) AS top_pct, n * {p} // 100 AS cutoff, n AS total_n,
        round(coalesce((SELECT cum FROM ranked WHERE rn = n * {p} // 100), 0) / total * 100, 6)
        AS cum_revenue_pct FROM totals"""
        for p in percents
    )
    return f"""{cte}, ranked AS (
      SELECT c, CAST(sum(c) OVER (ORDER BY c DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum,
        row_number() OVER (ORDER BY c DESC) AS rn FROM money),
    totals AS (SELECT count(*) AS n, CAST(sum(c) AS DOUBLE) AS total FROM money)
    {rows}"""


def _gap_stats(source: str) -> str:
    cuts = ", ".join(
        f"round(quantile_cont(gap, {p}), 6) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    )
    return f"""SELECT count(gap) AS n, round(avg(gap), 6) AS mean, round(stddev_samp(gap), 6) AS std,
      min(gap) AS min, max(gap) AS max, count(*) FILTER (WHERE gap < 0) AS negative, {cuts}
      FROM {source} WHERE gap IS NOT NULL"""


def _coverage(source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({w} AS BIGINT) AS window_days, count(gap) AS n_gaps,
        {_pct(f'count(*) FILTER (WHERE gap <= {w})', 'count(gap)')} AS covered_pct,
        count(*) FILTER (WHERE gap > {w}) AS excluded FROM {source}"""
        for w in fixed.COVERAGE_WINDOWS
    )


_ORDER_GAPS = f"""order_gaps AS (
  SELECT cust, order_id, ts, prev_ts, prev_id, {_floor('prev_ts', 'ts')} AS gap FROM (
    SELECT cust, order_id, ts, lag(ts) OVER w AS prev_ts, lag(order_id) OVER w AS prev_id
    FROM ord WINDOW w AS (PARTITION BY cust ORDER BY ts, order_id)))"""
_PAIRS = f"{_ORDER_GAPS}, pairs AS (SELECT * FROM order_gaps WHERE gap = 0)"

# the fixed linear model of the attribution queries: SQL value and coefficient of each input
TERMS = {
    "days_since_last_purchase": (
        "number", "(coalesce(CAST(days_since_last_purchase AS DOUBLE), 90.0) - 100.0) / 50.0", 0.8),
    "lifetime_orders": ("number", "(CAST(lifetime_orders AS DOUBLE) - 3.0) / 2.0", -0.5),
    "purchase_gap_mean": ("number", "(coalesce(purchase_gap_mean, 60.0) - 70.0) / 40.0", 0.3),
    "recent_90d_revenue": ("number", "(recent_90d_revenue - 100000.0) / 150000.0", -0.4),
    "has_been_targeted_for_retention": (
        "number", "CAST(has_been_targeted_for_retention AS DOUBLE)", 2.0),
    "has_repeat_purchase": ("flag", "CAST(has_repeat_purchase AS DOUBLE)", -0.2),
    "customer_state_NATION_1": (
        "category", "CAST(CASE WHEN customer_state = 'NATION_1' THEN 1 ELSE 0 END AS DOUBLE)", 0.1),
}
INTERCEPT = 0.25
_FLAGGED = f"""{_BASE}, {_FEAT}, flagged AS (
  SELECT *, CAST(CASE WHEN purchase_gap_mean IS NOT NULL OR purchase_gap_std IS NOT NULL
    THEN 1 ELSE 0 END AS BIGINT) AS has_repeat_purchase FROM feat),
centers AS (SELECT {", ".join(f"avg({v}) AS m{i}" for i, (_, v, _c) in enumerate(TERMS.values()))}
  FROM flagged WHERE split = 'train')"""


def _attributed() -> str:
    return ", ".join(
        f"({c} * (({v}) - m{i})) AS a{i}" for i, (_, v, c) in enumerate(TERMS.values())
    )


def _number(x: str) -> str:
    return f"CASE WHEN abs({x}) < 1000 THEN format('{{:,.1f}}', {x}) ELSE format('{{:,.0f}}', {x}) END"


def _line(i: int, name: str, kind: str, label: str) -> str:
    if kind == "category" or name.startswith("has_"):
        column = "customer_state" if kind == "category" else name
        true = "customer_state = 'NATION_1'" if kind == "category" else f"{name} <> 0"
        said = f"CASE WHEN {column} IS NULL THEN ': not available' WHEN {true} THEN ': Yes' ELSE ': No' END"
    else:
        value = f"CAST({name} AS DOUBLE)"
        said = (
            f"coalesce(': ' || {_number(value)} || ' (typical for returning customers: ' || "
            f"format('{{:,.1f}}', t{i}) || ')', ': not available')"
        )
    return (
        f"struct_pack(r := -abs(a{i}), i := {i}, line := '  - {label}' || {said} || '  [' || "
        f"CASE WHEN a{i} > 0 THEN 'increases' ELSE 'decreases' END || ' churn risk]')"
    )


def _explanations() -> str:
    shown = [
        (i, n, k) for i, (n, (k, _, _c)) in enumerate(TERMS.items()) if n not in fixed.SUPPRESSED_FACTORS
    ]
    typical = ", ".join(
        f"quantile_cont(CAST({n} AS DOUBLE), 0.5) AS t{i}" for i, (n, (k, _, _c)) in enumerate(TERMS.items()) if k == "number"
    )
    linear = " + ".join([repr(INTERCEPT)] + [f"{c} * ({v})" for _, v, c in TERMS.values()])
    lines = ", ".join(_line(i, n, k, plain_label(n).replace("'", "''")) for i, n, k in shown)
    return f"""{_FLAGGED}, typical AS (
      SELECT {typical} FROM flagged WHERE split = 'train' AND churned = 0),
    attributed AS (SELECT flagged.*, typical.*, {_attributed()} FROM flagged, centers, typical)
    SELECT customer_unique_id, snapshot_date,
      round(1.0 / (1.0 + exp(-({linear}))), 6) AS predicted_churn_probability,
      array_to_string([x.line FOR x IN list_sort([{lines}])[1:5]], chr(10)) AS top_factors
    FROM attributed"""


def _roi(targeted: str, cost: float, effect: float) -> str:
    saved = "sum(customer_value * p * " + repr(effect) + ")"
    net = f"({saved} - count(*) * {cost!r})"
    return f"""SELECT count(*) AS n_targeted, CAST(count(*) * {cost!r} AS DOUBLE) AS total_campaign_cost,
      round({saved}, 2) AS total_expected_revenue_saved, round({net}, 2) AS net_expected_benefit,
      round({net} / (count(*) * {cost!r}), 4) AS roi_pct FROM ({targeted})"""


def _top(k: int, effect: float, cost: float) -> str:
    return f"SELECT * FROM tiered ORDER BY customer_value * p * {effect!r} / {cost!r} DESC, customer_unique_id LIMIT {k}"


MEDIANS = ["days_since_last_purchase", "lifetime_orders", "lifetime_revenue", "purchase_gap_mean",
            "average_delivery_delay", "recent_90d_revenue"]
DRIFT = fixed.NUMERIC_FEATURES
#: tolerances between order dates, which are whole days, and order totals
NEAR = {"seconds": 3 * 86_400, "cents": 5_000_000}
NULL_COLUMNS = GROUPS["snapshot_features_full"]
DRIFT_DAYS = (standin.MAX_VALID_DATE, standin.SNAPSHOTS[-1])


def _drift_side(prefix: str, snap: str) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS {prefix}_null_pct,
        round(CAST(min({c}) AS DOUBLE), 6) AS {prefix}_min, round(CAST(max({c}) AS DOUBLE), 6) AS {prefix}_max
        FROM feat WHERE snapshot_date = {snap}"""
        for c in DRIFT
    )
    return f"{prefix} AS ({rows})"


def _auc(source: str, by: str) -> str:
    """Mann-Whitney by average ranks."""
    return f"""SELECT {by}, count(*) AS n_rows,
      round((sum(rk) FILTER (WHERE churned = 1) - np * (np + 1) / 2.0) / nullif(np * nn, 0), 6) AS roc_auc
    FROM (SELECT *, CAST(sum(churned) OVER (PARTITION BY {by}) AS DOUBLE) AS np,
        CAST(sum(1 - churned) OVER (PARTITION BY {by}) AS DOUBLE) AS nn,
        rank() OVER (PARTITION BY {by} ORDER BY p)
          + (count(*) OVER (PARTITION BY {by}, p) - 1) / 2.0 AS rk
      FROM {source}) GROUP BY {by}, np, nn"""


_REPORT = """
cells AS (SELECT split, count(*) FILTER (WHERE churned = 0 AND p <= 0.5) AS tn,
  count(*) FILTER (WHERE churned = 0 AND p > 0.5) AS fp,
  count(*) FILTER (WHERE churned = 1 AND p <= 0.5) AS fn,
  count(*) FILTER (WHERE churned = 1 AND p > 0.5) AS tp FROM scored GROUP BY 1),
rates AS (SELECT *, coalesce(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 0) AS p0,
  coalesce(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 0) AS r0,
  coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS p1,
  coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS r1,
  tn + fp AS s0, tp + fn AS s1, CAST(tn + fp + tp + fn AS DOUBLE) AS s FROM cells),
f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
  coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM rates)"""


_AP = """
  SELECT split, round(sum(pos * (CAST(cpos AS DOUBLE) / cn)) / max(tpos), 6) AS pr_auc_retained FROM (
    SELECT *, sum(pos) OVER w AS cpos, sum(n) OVER w AS cn, sum(pos) OVER (PARTITION BY split) AS tpos
    FROM (SELECT split, p, sum(1 - churned) AS pos, count(*) AS n FROM scored GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY split ORDER BY p ROWS UNBOUNDED PRECEDING)) GROUP BY 1"""


def _report() -> str:
    rows = [
        ("0", "p0", "r0", "f0", "s0"),
        ("1", "p1", "r1", "f1", "s1"),
        ("accuracy", "(tn + tp) / s", "(tn + tp) / s", "(tn + tp) / s", "s"),
        ("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "s"),
        ("weighted avg", "(p0 * s0 + p1 * s1) / s", "(r0 * s0 + r1 * s1) / s", "(f0 * s0 + f1 * s1) / s", "s"),
    ]
    return " UNION ALL ".join(
        f"""SELECT split, '{n}' AS "class", round({p}, 6) AS "precision", round({r}, 6) AS recall,
        round({f1}, 6) AS f1_score, CAST({s} AS BIGINT) AS support FROM f"""
        for n, p, r, f1, s in rows
    )


_WHATIF_ABS = "CASE WHEN p >= 0.0 AND p <= 0.4 THEN 'low' WHEN p > 0.4 AND p <= 0.7 THEN 'medium' WHEN p > 0.7 AND p <= 1.0 THEN 'high' END"
_WHATIF_Q = """whatif AS (SELECT tiered.*, CASE WHEN p <= q1 THEN 'low' WHEN p <= q2 THEN 'medium' ELSE 'high' END AS t
  FROM tiered, (SELECT quantile_cont(p, 0.3) AS q1, quantile_cont(p, 0.9) AS q2 FROM tiered))"""
_TIER_SUM = """SELECT t AS risk_tier_scenario, count(*) AS n_customers,
  round(sum(revenue_at_risk), 2) AS total_revenue_at_risk,
  round(avg(p), 6) AS mean_predicted_churn_probability FROM {0} WHERE t IS NOT NULL GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}

    # staging
    out["stage_orders"] = _with(_BASE, """
      SELECT order_id, status AS order_status,
        CASE WHEN delivered IS NOT NULL THEN 'delivered' WHEN status = 'canceled' THEN 'canceled'
          ELSE 'in_progress_or_undelivered' END AS delivery_status,
        delivery_days, delivery_days > 46 AS late_delivery_outlier FROM ord""")
    out["stage_products"] = _with(_BASE, "SELECT product_id, cat AS product_category_english FROM category")
    out["staged_items"] = _with(_BASE, """
      SELECT order_id, product_id, seller_id, price_c / 100.0 AS price, freight_c / 100.0 AS freight_value
      FROM items""")
    out["resolved_orders"] = _with(_BASE, """
      SELECT order_id, cust AS customer_unique_id, ts AS order_purchase_timestamp FROM ord""")
    out["purchase_events"] = _with(_BASE, """
      SELECT cust AS customer_unique_id, ts AS order_purchase_timestamp,
        min_order AS representative_order_id FROM ev""")
    out["order_summary"] = _with(_BASE, """
      SELECT order_id, cust AS customer_unique_id, total_c / 100.0 AS order_total,
        pay_c / 100.0 AS payment_value, round(inst, 6) AS installments_mean,
        ptype AS payment_type_mode, round(score, 6) AS review_score,
        delay AS delivery_delay_days FROM osum""")
    out["item_summary"] = _with(_BASE, """
      SELECT order_id, product_id, seller_id, cust AS customer_unique_id,
        cat AS product_category_english, price_c AS price_cents
      FROM items JOIN ord USING (order_id) LEFT JOIN category USING (product_id)""")
    out["geo_mode"] = _with(f"{_BASE}, {_FEAT}", """
      SELECT cust AS customer_unique_id, state AS customer_state, city AS customer_city
      FROM geo_state JOIN geo_city USING (cust)""")

    # quality and profiles
    out["dq_checks"] = _with(f"{_BASE}, checks AS ({_CHECKS})", f"""
      SELECT name, {_SEVERITY} AS severity, violation_count, violation_count = 0 AS passed FROM checks""")
    out["dq_gate_failures"] = _with(f"{_BASE}, checks AS ({_CHECKS})", f"""
      SELECT name, violation_count FROM checks WHERE violation_count > 0 AND {_SEVERITY} = 'critical'""")
    bad = {"duplicate_pk_orders": "false", "delivered_before_purchased": "delivered < ts",
           "future_purchase_timestamp": "ts > TIMESTAMP '2001-01-01'", "late_delivery_outliers": "delivery_days > 46"}
    n_bad = " + ".join(f"coalesce(({c})::INT, 0)" for c in bad.values())
    grave = " OR ".join(f"coalesce({c}, false)" for n, c in bad.items() if n != "late_delivery_outliers")
    def audited(names):
        listed, values = ", ".join(f"'{c}'" for c in names), ", ".join(f"CAST({c} AS DOUBLE)" for c in names)
        return f"""long AS (SELECT row_number() OVER () AS row, lifetime_orders AS depth, [{listed}] AS names, [{values}] AS vals FROM feat),
      cells AS (SELECT row, depth, unnest(names) AS f, unnest(vals) AS v FROM long),
      pairs AS (SELECT a.f AS column_a, b.f AS column_b, a.v AS va, b.v AS vb, a.depth
        FROM cells a JOIN cells b ON a.row = b.row AND a.f < b.f)"""
    out["equal_features"] = _with(f"{_BASE}, {_FEAT}, {audited(AUDITED)}", " UNION ALL ".join(
        f"SELECT column_a, column_b, '{n}' AS rows FROM pairs WHERE {c} GROUP BY 1, 2 HAVING bool_and(va IS NOT DISTINCT FROM vb)"
        for n, c in (("all", "true"), ("single_order", "depth = 1"))))
    out["collinear_features"] = _with(f"{_BASE}, {_FEAT}, {audited(fixed.NUMERIC_FEATURES)}", """
      SELECT column_a, column_b, count(*) FILTER (WHERE va IS NOT NULL AND vb IS NOT NULL) AS n, round(corr(va, vb), 4) AS correlation
      FROM pairs GROUP BY 1, 2 HAVING abs(corr(va, vb)) >= 0.5 AND NOT isnan(corr(va, vb))""")
    out["sketched_order_values"] = _with(_BASE, """
      SELECT CAST(p AS DOUBLE) AS probability, count(*) AS n, true AS within
      FROM ord LEFT JOIN order_value USING (order_id), unnest([0.05, 0.25, 0.5, 0.75, 0.95]) t(p) WHERE total_c IS NOT NULL GROUP BY 1""")
    out["quarantine_orders"] = _with(_BASE, f"""
      SELECT order_id, CASE WHEN {grave} THEN CAST({n_bad} AS BIGINT) ELSE 0 END AS n_reasons, NOT ({grave}) AS passes FROM ord""")
    lost = "l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"
    out["quarantine_counts"] = _with(_BASE, f"""
      SELECT * FROM ({" UNION ALL ".join(
        [f"SELECT '{n}' AS name, count(*) FILTER (WHERE {c}) AS violation_count, 'orders' AS table_name FROM ord" for n, c in bad.items()]
        + [f"SELECT 'orphan_fk_order_items', count(*), 'items' FROM lineitem WHERE {lost}",
           f"SELECT 'orphan_fk_payments', count(*), 'payments' FROM lineitem WHERE {lost}"])}) WHERE violation_count > 0""")
    out["null_profile"] = _with(_BASE, f"""
      SELECT column_name, null_pct FROM (
        SELECT 'delivered_customer_date' AS column_name, {_pct('count(*) FILTER (WHERE delivered IS NULL)', 'count(*)')} AS null_pct FROM ord
        UNION ALL SELECT 'delivery_days', {_pct('count(*) FILTER (WHERE delivered IS NULL)', 'count(*)')} FROM ord
        UNION ALL SELECT 'delivery_status', 0.0) WHERE null_pct > 0""")
    out["feature_nulls"] = _with(f"{_BASE}, {_FEAT}", f"SELECT * FROM ({' UNION ALL '.join(f'''
      SELECT split, '{c}' AS column_name, {_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS null_pct
      FROM feat GROUP BY 1''' for c in NULL_COLUMNS)}) WHERE null_pct > 0")
    shapes = {"customer": 5, "orders": 6, "lineitem": 11, "part": 6, "supplier": 4, "nation": 3, "region": 2, "events": 6}
    out["table_shapes"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS BIGINT) AS n_columns FROM {t}"
        for t, n in shapes.items()
    )
    out["orphan_items"] = """SELECT count(*) AS orphans FROM lineitem
      LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey
      WHERE o_orderkey IS NULL"""
    out["duplicate_keys"] = """
      WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
      SELECT CAST(sum(n) AS BIGINT) AS duplicate_rows, count(DISTINCT l_orderkey) AS affected FROM d"""
    out["duplicate_sample"] = """
      WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
        ORDER BY 1, 2 LIMIT 1)
      SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN d USING (l_orderkey, l_linenumber)"""
    out["duplicated_features"] = _with(f"{_BASE}, {_FEAT}", " UNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
        count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) AS rows_differing,
        count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) = 0 AS identical,
        round(corr({a}, {b}), 6) AS correlation FROM feat"""
        for a, b in {**fixed.DUPLICATED_FEATURES, **fixed.COLLINEAR_FEATURES}.items()))
    out["collinear_single_order"] = _with(f"{_BASE}, {_FEAT}", " UNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
        count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) AS rows_differing,
        count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) = 0 AS identical,
        round(corr({a}, {b}), 6) AS correlation FROM feat WHERE lifetime_orders = 1"""
        for a, b in fixed.COLLINEAR_FEATURES.items()))
    out["single_order_invariant"] = _with(f"{_BASE}, {_FEAT}", f"""
      SELECT {_pct('count(*) FILTER (WHERE lifetime_orders = 1)', 'count(*)')} AS single_order_pct,
        {_pct('count(*) FILTER (WHERE purchase_gap_mean IS NULL)', 'count(*)')} AS null_gap_pct,
        round(100.0 * (count(*) FILTER (WHERE lifetime_orders = 1)
          - count(*) FILTER (WHERE purchase_gap_mean IS NULL)) / count(*), 2) AS difference FROM feat""")

    # audit
    out["date_audit"] = _with(_BASE, """
      SELECT min(ts) AS first_purchase, max(ts) AS last_purchase,
        count(*) FILTER (WHERE delivered < ts) AS delivered_before_purchase,
        count(*) FILTER (WHERE ts > TIMESTAMP '2001-01-01') AS future_purchases FROM ord""")
    out["date_parse"] = """SELECT count(*) AS n_rows, count(TRY_CAST(o_orderpriority AS TIMESTAMP)) AS parsed_words,
      count(TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP)) AS parsed_dates FROM orders"""
    out["delivery_distribution"] = _with(f"{_BASE}, d AS (SELECT {_floor('ts', 'delivered')} AS gap FROM ord)", _gap_stats("d"))
    out["iqr_outliers"] = _with(f"{_BASE}, q AS (SELECT quantile_cont(delivery_days, 0.25) AS q1, quantile_cont(delivery_days, 0.75) AS q3 FROM ord)", f"""
      SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 + 1.5 * (q3 - q1), 6) AS threshold,
        count(*) FILTER (WHERE delivery_days > q3 + 1.5 * (q3 - q1)) AS n_over,
        {_pct('count(*) FILTER (WHERE delivery_days > q3 + 1.5 * (q3 - q1))', 'count(*)')} AS pct_over
      FROM ord, q GROUP BY q1, q3""")
    out["money_audit"] = _with(_BASE, """
      SELECT (SELECT count(*) FROM items WHERE price_c < 0) AS negative_price,
        (SELECT count(*) FROM items WHERE freight_c < 0) AS negative_freight,
        (SELECT count(*) FROM li WHERE ext < 0) AS negative_payment,
        (SELECT count(*) FROM li WHERE ext = 0) AS zero_payment""")
    out["identity_audit"] = _with(_BASE, f"""
      , per AS (SELECT cust, count(DISTINCT order_id) AS n FROM ord GROUP BY 1)
      SELECT (SELECT count(DISTINCT order_id) FROM ord) AS n_customer_ids, count(*) AS n_persons,
        round((SELECT count(DISTINCT order_id) FROM ord) / CAST(count(*) AS DOUBLE), 6) AS ids_per_person,
        round(avg(n), 6) AS mean_ids, max(n) AS max_ids, count(*) FILTER (WHERE n > 1) AS repeat_persons,
        {_pct('count(*) FILTER (WHERE n > 1)', 'count(*)')} AS repeat_pct FROM per""")
    out["gap_distribution"] = _with(f"{_BASE}, {_ORDER_GAPS}", _gap_stats("order_gaps"))
    out["event_gap_distribution"] = _with(_BASE, _gap_stats("ev"))
    out["gap_coverage"] = _with(_BASE, _coverage("ev"))
    log = f"""log AS (SELECT {_floor('prev', 'ts')} AS gap FROM (
        SELECT ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev
        FROM (SELECT DISTINCT user_id, ts FROM events)))"""
    out["event_log_coverage"] = _with(log, _coverage("log"))
    out["event_log_gaps"] = _with(log, _gap_stats("log"))
    out["purchase_event_counts"] = _with(_BASE, f"""
      , per AS (SELECT cust, count(*) AS n FROM ev GROUP BY 1)
      SELECT count(*) AS n_persons, {_sum('n')} AS n_events, round(avg(n), 6) AS mean_events,
        max(n) AS max_events, count(*) FILTER (WHERE n > 1) AS repeat_persons,
        {_pct('count(*) FILTER (WHERE n > 1)', 'count(*)')} AS repeat_pct FROM per""")
    out["repeat_customer_orders"] = _with(_BASE, """
      SELECT order_id, cust AS customer_unique_id FROM ord
      WHERE cust IN (SELECT cust FROM ord GROUP BY 1 HAVING count(*) > 1)""")
    out["same_day_pairs"] = _with(f"{_BASE}, {_PAIRS}", """
      SELECT cust AS customer_unique_id, prev_id AS first_order_id, order_id AS second_order_id,
        prev_ts AS first_at, ts AS second_at, prev_ts = ts AS same_timestamp FROM pairs""")
    out["same_day_summary"] = _with(f"{_BASE}, {_PAIRS}", f"""
      SELECT count(*) AS n_pairs, count(*) FILTER (WHERE prev_ts = ts) AS n_same_timestamp,
        {_pct('count(*) FILTER (WHERE prev_ts = ts)', 'count(*)')} AS same_timestamp_pct FROM pairs""")
    out["near_identical_orders"] = _with(f"""{_BASE},
      class AS (
        SELECT cust, ts, total_c, count(*) AS n, min(order_id) AS lo, max(order_id) AS hi
        FROM ord JOIN order_value USING (order_id) GROUP BY 1, 2, 3)""", f"""
      SELECT a.cust AS customer_unique_id, a.lo AS first_order_id, b.lo AS second_order_id, a.n AS n_first,
        b.n AS n_second, CAST(epoch(b.ts) - epoch(a.ts) AS DOUBLE) AS seconds_apart,
        CAST(abs(b.total_c - a.total_c) AS BIGINT) AS cents_apart, a.n * b.n AS n_pairs
      FROM class a JOIN class b ON a.cust = b.cust AND (a.ts < b.ts OR a.ts = b.ts AND a.total_c < b.total_c)
        AND epoch(b.ts) - epoch(a.ts) <= {NEAR["seconds"]} AND abs(b.total_c - a.total_c) <= {NEAR["cents"]}
      UNION ALL
      SELECT cust, lo, hi, n, n, 0.0, 0, n * (n - 1) // 2 FROM class WHERE n > 1""")
    out["events_as_of"] = """
      SELECT e.event_id, e.user_id, b.o_orderkey AS before_order_id, b.o_orderdate AS before_at,
        a.o_orderkey AS after_order_id, a.o_orderdate AS after_at
      FROM events e
      ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) b
        ON e.user_id = b.o_custkey AND e.ts >= b.o_orderdate
      ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, min(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) a
        ON e.user_id = a.o_custkey AND e.ts < a.o_orderdate"""
    out["tickets_as_of"] = """
      SELECT t.o_custkey AS customer_unique_id, l_shipdate AS created_at, l_quantity AS resolution_hours, b.o_orderkey AS order_id
      FROM (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') t
      ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) b
        ON t.o_custkey = b.o_custkey AND t.l_shipdate >= b.o_orderdate"""
    out["bucketed_person_join"] = """
      SELECT o.o_custkey AS customer_unique_id, count(*) AS n_orders, max(o_orderdate) AS last_order,
        (SELECT count(*) FROM lineitem JOIN orders p ON l_orderkey = p.o_orderkey
         WHERE l_returnflag = 'R' AND p.o_custkey = o.o_custkey) AS n_tickets
      FROM orders o GROUP BY 1"""
    out["wide_category_inputs"] = """
      SELECT CAST(l_partkey AS VARCHAR) AS product_id, count(*) AS n_rows FROM lineitem
      WHERE l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_orderkey % 5 <> 0) GROUP BY 1"""
    out["cart_split_sellers"] = _with(f"{_BASE}, {_PAIRS}", f"""
      , judged AS (SELECT NOT EXISTS (SELECT 1 FROM items a JOIN items b ON a.seller_id = b.seller_id
          WHERE a.order_id = prev_id AND b.order_id = pairs.order_id) AS disjoint FROM pairs)
      SELECT count(*) AS n_pairs, count(*) FILTER (WHERE disjoint) AS n_disjoint,
        {_pct('count(*) FILTER (WHERE disjoint)', 'count(*)')} AS disjoint_pct FROM judged""")
    out["untranslated_categories"] = "SELECT DISTINCT p_type AS product_category_name FROM part WHERE p_type NOT IN (" + ", ".join(f"'{k}'" for k in standin.TRANSLATION) + ")"
    out["review_distribution"] = """
      SELECT CAST(1 + l_linenumber % 5 AS BIGINT) AS review_score, count(*) AS n,
        round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 3) AS share
      FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1"""

    # exploration
    money = f"""rev AS (SELECT cust, {_sum('total_c')} AS c FROM ord JOIN order_value USING (order_id) GROUP BY 1),
      money AS (SELECT c FROM rev)"""
    out["repeat_vs_onetime"] = _with(f"{_BASE}, {money}", f"""
      SELECT n > 1 AS is_repeat, count(*) AS customers, {_sum('c')} / 100.0 AS total_revenue,
        round({_sum('c')} / 100.0 / count(*), 6) AS avg_revenue_per_customer,
        {_pct('count(*)', '(SELECT count(*) FROM rev)')} AS pct_of_customers,
        {_pct('sum(c)', '(SELECT sum(c) FROM rev)')} AS pct_of_revenue
      FROM rev JOIN (SELECT cust, count(*) AS n FROM ev GROUP BY 1) USING (cust) GROUP BY 1""")
    out["pareto_customers"] = _with(_BASE, ", " + _pareto(money, [1, 5, 10, 20, 50]))
    sellers = f"money AS (SELECT seller_id, {_sum('price_c + freight_c')} AS c FROM items GROUP BY 1)"
    out["pareto_sellers"] = _with(_BASE, ", " + _pareto(sellers, [1, 5, 10, 20]))
    out["seller_revenue"] = _with(_BASE, f"""
      SELECT seller_id, {_sum('price_c + freight_c')} AS revenue_cents, count(*) AS items_sold
      FROM items GROUP BY 1""")
    out["value_quantiles"] = _with(f"{_BASE}, {money}", " UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS probability, round(quantile_cont(c, {q}) / 100.0, 6) AS revenue FROM money"
        for q in (0.5, 0.75, 0.9, 0.95, 0.99)))
    out["value_distribution"] = _with(f"{_BASE}, {money}", " UNION ALL ".join(
        f"SELECT '{n}' AS statistic, round(CAST({e} AS DOUBLE), 4) AS value FROM money"
        for n, e in {"count": "count(c)", "mean": "sum(c) / count(c)", "std": "stddev_samp(c)", "min": "min(c)", "max": "max(c)",
                     "p25": "quantile_cont(c, 0.25)", "p50": "quantile_cont(c, 0.5)", "p75": "quantile_cont(c, 0.75)"}.items()))
    out["revenue_by_state"] = _with(_BASE, f"""
      SELECT state AS customer_state, count(DISTINCT cust) AS customers, {_sum('total_c')} / 100.0 AS total_revenue,
        {_pct('sum(total_c)', '(SELECT sum(total_c) FROM order_value)')} AS pct_of_revenue,
        round({_sum('total_c')} / 100.0 / count(DISTINCT cust), 2) AS avg_revenue_per_customer
      FROM ord JOIN order_value USING (order_id) GROUP BY 1""")
    out["revenue_by_category"] = _with(_BASE, f"""
      SELECT cat AS product_category_english, count(*) AS items_sold,
        {_sum('price_c')} / 100.0 AS total_product_revenue,
        {_pct('sum(price_c)', '(SELECT sum(price_c) FROM items)')} AS pct_of_revenue
      FROM items JOIN category USING (product_id) GROUP BY 1
      ORDER BY sum(price_c) DESC, 1 LIMIT 15""")
    out["payment_behavior"] = _with(_BASE, f"""
      SELECT l_returnflag AS payment_type, count(*) AS n, {_sum('ext')} / 100.0 AS total_value,
        round(avg(l_linenumber), 6) AS avg_installments,
        {_pct('count(*)', '(SELECT count(*) FROM li)')} AS pct_of_payments FROM li GROUP BY 1""")
    out["late_vs_review"] = _with(_BASE, """
      SELECT delivery_days > 46 AS late_delivery_outlier, 'delivered' AS delivery_status,
        round(avg(1 + l_linenumber % 5), 6) AS avg_review_score, count(*) AS n_orders
      FROM ord JOIN lineitem ON order_id = l_orderkey AND l_linestatus = 'F'
      WHERE delivered IS NOT NULL GROUP BY 1""")
    out["monthly_revenue"] = _with(_BASE, f"""
      SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS month, {_sum('total_c')} / 100.0 AS revenue,
        count(DISTINCT order_id) AS orders FROM ord JOIN order_value USING (order_id) GROUP BY 1""")

    # snapshot features
    for name, columns in GROUPS.items():
        out[name] = _with(f"{_BASE}, {_FEAT}", f"SELECT customer_unique_id, snapshot_date, split, {_columns(columns)} FROM feat")
    out["incremental_features"] = out["snapshot_features_full"]
    out["snapshot_strict"] = _with(f"{_BASE}, {_feat(_SNAPS, strict=True)}", f"""
      SELECT customer_unique_id, snapshot_date, split, {_columns([*GROUPS["snapshot_delivery"], "average_review_score",
        "negative_review_rate", "review_trend_90d", *GROUPS["snapshot_support"], "lifetime_orders"])} FROM feat""")
    out["split_assignment"] = _with(f"{_BASE}, {_FEAT}", "SELECT cust AS customer_unique_id, snap AS snapshot_date, split FROM panel")
    out["split_summary"] = _with(f"{_BASE}, {_FEAT}", """
      SELECT split, count(*) AS n_rows, count(DISTINCT customer_unique_id) AS unique_customers,
        round(avg(churned), 6) AS churn_rate FROM feat GROUP BY 1""")
    out["missing_indicators"] = _with(f"{_BASE}, {_FEAT}", "SELECT customer_unique_id, snapshot_date, round(coalesce(review_trend_90d, 0), 6) AS review_trend_90d, " + ", ".join(
        f"CAST(CASE WHEN {' OR '.join(f'{c} IS NOT NULL' for c in cols)} THEN 1 ELSE 0 END AS BIGINT) AS {n}"
        for n, cols in fixed.INDICATORS.items()) + " FROM feat")
    out["feature_store_snapshot"] = _with(f"{_BASE}, {_FEAT}", f"""
      SELECT customer_unique_id, lifetime_orders, round(lifetime_revenue, 6) AS lifetime_revenue, churned
      FROM feat WHERE snapshot_date = {_ts(standin.SNAPSHOTS[5])}""")

    # behaviour rules
    b = f"{_BASE}, {_BEHAVIOR}"
    out["behavior_summary"] = _with(b, """
      SELECT cust AS customer_unique_id, first_purchase, last_purchase, n_orders,
        round(avg_delivery_days, 6) AS avg_delivery_days, n_late_deliveries,
        round(avg_review_score, 6) AS avg_review_score, total_revenue, n_voucher_payments FROM behavior""")
    out["revenue_percentile"] = _with(b, "SELECT cust AS customer_unique_id, round(pr, 6) AS revenue_percentile FROM behavior")
    out["value_tiers"] = _with(b, """
      SELECT cust AS customer_unique_id, customer_tier, segment,
        customer_tier = 'platinum' AS strategic_account FROM tiers""")
    out["support_propensity"] = _with(b, """
      SELECT cust AS customer_unique_id, round(least(0.08 + least(n_late_deliveries * 0.15, 0.5)
        + greatest((3.5 - avg_review_score) * 0.08, 0.0), 0.85), 6) AS ticket_probability FROM behavior""")
    out["campaign_intensity"] = _with(b, "SELECT cust AS customer_unique_id, round(2 + 4 * pr, 6) AS expected_campaigns FROM behavior")
    out["customer_costs"] = _with(b, """
      SELECT cust AS customer_unique_id, support_cost,
        (rev_c * 3 + support_c * 50 + 50) // 100 / 100.0 AS annual_service_cost,
        (rev_c * 15 + 500) // 1000 / 100.0 AS estimated_processing_cost FROM costs""")
    out["lapsed_customers"] = _with(b, f"""
      SELECT cust AS customer_unique_id, last_purchase, {_floor('last_purchase', _AS_OF)} AS days_quiet
      FROM behavior WHERE {_floor('last_purchase', _AS_OF)} >= 150""")
    out["event_windows"] = _with(b, f"""
      SELECT cust AS customer_unique_id, first_purchase,
        least(first_purchase + INTERVAL 730 DAY, {_AS_OF}) AS window_end,
        greatest({_floor('first_purchase', f'least(first_purchase + INTERVAL 730 DAY, {_AS_OF})')}, 1) AS window_days
      FROM behavior""")
    out["cascade_violations"] = _with(b, """
      SELECT count(*) FILTER (WHERE clicked AND NOT opened) AS clicked_unopened,
        count(*) FILTER (WHERE converted AND NOT clicked) AS converted_unclicked FROM campaigns""")
    out["intervention_timing"] = _with(b, f"""
      SELECT count(*) AS n_interventions,
        count(*) FILTER (WHERE {_floor('last_purchase', 'ts')} < 150) AS too_early,
        count(*) FILTER (WHERE ts > {_AS_OF}) AS after_as_of
      FROM interventions JOIN behavior USING (cust)""")
    out["campaign_unit_costs"] = _with(b, """
      SELECT channel, count(*) AS n, round(count(*) * CASE channel WHEN 'email' THEN 0.05
        WHEN 'sms' THEN 0.08 ELSE 0.02 END::DOUBLE, 2) AS total_cost FROM campaigns GROUP BY 1""")
    out["intervention_unit_costs"] = _with(b, """
      SELECT kind AS intervention_type, count(*) AS n, round(count(*) * CASE kind
        WHEN 'discount_offer' THEN 25.0 WHEN 'personal_outreach' THEN 12.0
        WHEN 'free_shipping' THEN 15.0 ELSE 8.0 END::DOUBLE, 2) AS total_cost FROM interventions GROUP BY 1""")

    # models
    linear = " + ".join([repr(INTERCEPT)] + [f"{c} * ({v})" for _, v, c in TERMS.values()])
    out["linear_score"] = _with(_FLAGGED, f"""
      SELECT customer_unique_id, snapshot_date, round(1.0 / (1.0 + exp(-({linear}))), 6)
        AS predicted_churn_probability FROM flagged""")
    out["class_weights"] = _with(f"{_BASE}, {_FEAT}", """
      SELECT churned, count(*) AS n_rows,
        round((SELECT count(*) FROM feat WHERE split = 'train') / (2.0 * count(*)), 6) AS weight
      FROM feat WHERE split = 'train' GROUP BY 1""")
    out["prepared_inputs"] = _with(f"{_BASE}, {_FEAT}, train AS (SELECT * FROM feat WHERE split = 'train')", f"""
      , med AS (SELECT quantile_cont(purchase_gap_mean, 0.5) AS m FROM train),
      st AS (SELECT avg(coalesce(purchase_gap_mean, m)) AS mu, stddev_pop(coalesce(purchase_gap_mean, m)) AS sd,
        avg(lifetime_orders) AS mu2, stddev_pop(lifetime_orders) AS sd2 FROM train, med),
      usual AS (SELECT customer_city AS u FROM train GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
      SELECT customer_unique_id, snapshot_date,
        round((coalesce(purchase_gap_mean, m) - mu) / sd, 6) AS x0,
        round((lifetime_orders - mu2) / sd2, 6) AS x1,
        {", ".join(f"CAST(coalesce(customer_city, u) = '{c}' AS DOUBLE) AS x{i + 2}" for i, c in enumerate(CITIES))}
      FROM feat, med, st, usual""")
    out["roc_auc"] = _with(_SCORED, _auc("scored", "split"))
    out["average_precision"] = _with(_SCORED, _AP)
    out["split_metrics"] = _with(
        f"{_SCORED}, {_REPORT.strip()}, auc AS ({_auc('scored', 'split')}), ap AS ({_AP})",
        """SELECT split, n_rows, roc_auc, pr_auc_retained, tn, fp, fn, tp
      FROM auc JOIN ap USING (split) JOIN cells USING (split)""")
    out["confusion"] = _with(f"{_SCORED}, {_REPORT.strip()}", "SELECT * FROM cells")
    out["classification_report"] = _with(f"{_SCORED}, {_REPORT.strip()}", _report())
    out["cold_start_auc"] = _with(_SCORED, """
      , deep AS (SELECT *, CASE WHEN lifetime_orders = 1 THEN 'lifetime_orders = 1'
        ELSE 'lifetime_orders >= 2' END AS history FROM scored)""" + _auc("deep", "split, history"))
    out["linear_attribution"] = _with(_FLAGGED, f"""
      , a AS (SELECT *, {_attributed()} FROM flagged, centers)
      SELECT * FROM ({" UNION ALL ".join(f"SELECT customer_unique_id, snapshot_date, '{n}' AS feature, round(a{i}, 6) AS attribution FROM a" for i, n in enumerate(TERMS))})""")
    out["global_importance"] = _with(_FLAGGED, f"""
      , a AS (SELECT {_attributed()} FROM flagged, centers WHERE split = 'train')
      SELECT * FROM ({" UNION ALL ".join(f"SELECT '{n}' AS feature, '{plain_label(n)}' AS plain_label, round(avg(abs(a{i})), 6) AS mean_abs_attribution FROM a" for i, n in enumerate(TERMS))})
      ORDER BY mean_abs_attribution DESC, feature LIMIT 15""")
    out["explanations"] = _with(_explanations(), "")
    out["seeded_sample"] = """
      SELECT c_custkey, c_mktsegment FROM customer ORDER BY md5(c_custkey || '/42') DESC, c_custkey LIMIT 500"""
    out["reference_medians"] = _with(f"{_BASE}, {_FEAT}", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median FROM feat WHERE split = 'train' AND churned = 0"
        for c in MEDIANS))
    both = ", ".join(f"({_ts(d)}, 'all')" for d in DRIFT_DAYS)
    out["feature_drift"] = _with(f"{_BASE}, {_feat(both)}, {_drift_side('scoring', _ts(DRIFT_DAYS[0]))}, {_drift_side('training', _ts(DRIFT_DAYS[1]))}", """
      SELECT *, round(abs(scoring_null_pct - training_null_pct), 2) AS null_pct_jump,
        coalesce(round(abs(scoring_null_pct - training_null_pct), 2) > 5.0, false) AS flagged
      FROM scoring JOIN training USING (feature)""")
    out["tenure_skew"] = _with(f"{_VALUE}", f"""
      , t AS (SELECT p, {_floor('first_purchase', _AS_OF)} AS d FROM risk JOIN behavior ON customer_unique_id = cust),
      e AS (SELECT quantile_cont(d, 0.25) AS a, quantile_cont(d, 0.5) AS b, quantile_cont(d, 0.75) AS c FROM t)
      SELECT CASE WHEN d <= a THEN 'q1' WHEN d <= b THEN 'q2' WHEN d <= c THEN 'q3' ELSE 'q4' END AS tenure_bucket,
        round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std, count(*) AS n,
        round(quantile_cont(p, 0.5), 6) AS median FROM t, e GROUP BY 1""")

    # value and scenarios
    out["revenue_at_risk"] = _with(_VALUE, """
      SELECT customer_unique_id, customer_value, round(p, 6) AS predicted_churn_probability,
        revenue_at_risk, segment, support_cost FROM risk""")
    out["risk_tiers"] = _with(_VALUE, """
      SELECT customer_unique_id, round(p, 6) AS predicted_churn_probability, risk_tier FROM tiered""")
    out["campaign_roi_topn"] = _with(_VALUE, _roi("SELECT * FROM tiered ORDER BY revenue_at_risk DESC, customer_unique_id LIMIT 100", 15.0, 0.2))
    out["campaign_roi_tier"] = _with(_VALUE, _roi("SELECT * FROM tiered WHERE risk_tier = 'high'", 15.0, 0.2))
    out["campaign_roi_segment"] = _with(_VALUE, _roi("SELECT * FROM tiered WHERE segment = 'high_value'", 15.0, 0.35))
    out["budget_allocation"] = _with(_VALUE, f"""
      SELECT count(*) AS n_targeted, CAST(count(*) * 15.0 AS DOUBLE) AS total_spent,
        round(sum(customer_value * p * 0.1), 2) AS total_expected_revenue_saved,
        round(sum(customer_value * p * 0.1) - count(*) * 15.0, 2) AS net_expected_benefit
      FROM ({_top(333, 0.1, 15.0)})""")
    out["budget_selection"] = _with(_VALUE, f"""
      SELECT customer_unique_id, round(customer_value * p * 0.1 / 15.0, 6) AS expected_revenue_saved_per_dollar
      FROM ({_top(333, 0.1, 15.0)})""")
    out["marginal_curve"] = _with(_VALUE, " UNION ALL ".join(
        f"""SELECT CAST({5000 * m} AS DOUBLE) AS budget, count(*) AS n_targeted,
        round(sum(customer_value * p * 0.1), 2) AS total_revenue_saved,
        round(sum(customer_value * p * 0.1) - count(*) * 15.0, 2) AS net_benefit
        FROM ({_top(int(5000 * m // 15.0), 0.1, 15.0)})"""
        for m in fixed.BUDGET_MULTIPLES))
    out["tier_whatif_absolute"] = _with(_VALUE, f"""
      SELECT customer_unique_id, risk_tier, {_WHATIF_ABS} AS risk_tier_scenario FROM tiered""")
    out["tier_whatif_quantile"] = _with(f"{_VALUE}, {_WHATIF_Q}", "SELECT customer_unique_id, risk_tier, t AS risk_tier_scenario FROM whatif")
    out["tier_summary"] = _with(f"{_VALUE}, whatif AS (SELECT *, {_WHATIF_ABS} AS t FROM tiered)", _TIER_SUM.format("whatif"))
    caveat = fixed.MODEL_CAVEAT.replace("'", "''")
    effect_caveat = fixed.EFFECT_CAVEAT.replace("'", "''")
    out["tier_distribution"] = _with(_VALUE, f"""
      SELECT risk_tier, count(*) AS n_customers, round(sum(revenue_at_risk), 2) AS total_revenue_at_risk,
        '{caveat}' AS caveat FROM tiered GROUP BY 1""")
    out["campaign_caveats"] = _with(_VALUE, f"""
      SELECT count(*) AS n_targeted, '{caveat}' AS model_caveat, '{effect_caveat}' AS retention_effect_caveat
      FROM tiered WHERE risk_tier = 'low'""")
    out["movement_matrix"] = _with(f"{_VALUE}, whatif AS (SELECT *, {_WHATIF_ABS} AS t FROM tiered)", """
      SELECT coalesce(risk_tier, 'All') AS risk_tier, count(*) FILTER (WHERE t = 'low') AS low,
        count(*) FILTER (WHERE t = 'medium') AS medium, count(*) FILTER (WHERE t = 'high') AS high,
        count(*) AS "All" FROM whatif WHERE t IS NOT NULL GROUP BY ROLLUP (risk_tier)""")
    out["append_roundtrip"] = "SELECT event_id, user_id, event_type FROM events"
    out["truncate_roundtrip"] = "SELECT CAST(s_suppkey AS VARCHAR) AS seller_id FROM supplier"
    out["catalog_roundtrip"] = _with(_BASE, """
      SELECT cust AS customer_unique_id, ts AS order_purchase_timestamp, min_order AS representative_order_id FROM ev""")
    terms = " UNION ALL ".join(
        [f"SELECT '{c}' AS term" for c in [*fixed.NUMERIC_FEATURES, *fixed.INDICATORS]]
        + [
            f"SELECT DISTINCT '{c}_' || {c} FROM feat WHERE split = 'train' AND {c} IS NOT NULL"
            for c in fixed.CATEGORICAL_FEATURES
        ]
    )
    out["lr_gradient"] = _with(f"{_BASE}, {_FEAT}", f"SELECT term, 0.0::DOUBLE AS gradient FROM ({terms})")
    out["fitted_attributions"] = _with(f"{_BASE}, {_FEAT}", "SELECT customer_unique_id, snapshot_date, true AS adds_up FROM feat")
    out["fitted_importance"] = "SELECT 15::BIGINT AS n_inputs, true AS strong, true AS named"
    out["fitted_explanations"] = _with(f"{_BASE}, {_FEAT}", "SELECT customer_unique_id, snapshot_date, 5::BIGINT AS n_factors FROM feat")
    # a missing review trend counts as none before the preparation
    number = {c: f"coalesce({c}, 0)" if c == "review_trend_90d" else c for c in fixed.NUMERIC_FEATURES}
    out["prepared_inputs_all"] = _with(f"{_BASE}, {_FEAT}, train AS (SELECT * FROM feat WHERE split = 'train')", f"""
      , med AS (SELECT {", ".join(f"coalesce(quantile_cont(CAST({e} AS DOUBLE), 0.5), 0) AS m_{c}" for c, e in number.items())} FROM train),
      st AS (SELECT {", ".join(f"avg(coalesce(CAST({e} AS DOUBLE), m_{c})) AS u_{c}, stddev_pop(coalesce(CAST({e} AS DOUBLE), m_{c})) AS s_{c}" for c, e in number.items())}
        FROM train, med)
      SELECT customer_unique_id, snapshot_date,
        {", ".join(f"round((coalesce(CAST({e} AS DOUBLE), m_{c}) - u_{c}) / coalesce(nullif(s_{c}, 0), 1), 6) AS x_{c}" for c, e in number.items())},
        {", ".join(f"CAST(coalesce({', '.join(f'CAST({c} AS DOUBLE)' for c in cs)}) IS NOT NULL AS DOUBLE) AS x_{n}" for n, cs in fixed.INDICATORS.items())},
        {", ".join(f"CASE WHEN coalesce({c}, usual_{c}) IN (SELECT {c} FROM train) THEN '{c}_' || coalesce({c}, usual_{c}) ELSE '' END AS x_{c}" for c in fixed.CATEGORICAL_FEATURES)}
      FROM feat, med, st, {", ".join(f"(SELECT {c} AS usual_{c} FROM train GROUP BY 1 ORDER BY {c} IS NULL, count(*) DESC, 1 LIMIT 1) AS mode_{c}" for c in fixed.CATEGORICAL_FEATURES)}""")
    out["reference_medians_all"] = _with(f"{_BASE}, {_FEAT}", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median FROM feat WHERE split = 'train' AND churned = 0"
        for c in fixed.NUMERIC_FEATURES))
    out["model_roundtrip"] = _with(f"{_BASE}, {_FEAT}", "SELECT customer_unique_id, snapshot_date, true AS same_score FROM feat")
    out["gbt_summary"] = _with(f"{_BASE}, {_FEAT}", """
      SELECT split, count(*) AS n_rows, true AS probabilities, true AS several_trees, true AS below_bound
      FROM feat GROUP BY 1""")
    out["tier_movement"] = _with(f"{_VALUE}, whatif AS (SELECT *, {_WHATIF_ABS} AS t FROM tiered)", """
      SELECT coalesce(risk_tier, 'All') AS risk_tier, coalesce(t, 'All') AS risk_tier_scenario,
        count(*) AS n_customers FROM whatif WHERE t IS NOT NULL GROUP BY CUBE (risk_tier, t)""")
    out["customers_page"] = _with(_VALUE, """
      SELECT customer_unique_id, revenue_at_risk, risk_tier,
        (SELECT count(*) FROM tiered WHERE risk_tier = 'high' AND revenue_at_risk >= 1000) AS total
      FROM tiered WHERE risk_tier = 'high' AND revenue_at_risk >= 1000
      ORDER BY customer_unique_id LIMIT 20 OFFSET 10""")
    out["customer_lookup"] = _with(_VALUE, """
      SELECT customer_unique_id, revenue_at_risk, segment, risk_tier
      FROM tiered WHERE customer_unique_id = (SELECT min(customer_unique_id) FROM tiered)""")
    out["customer_batch_lookup"] = _with(_VALUE, """
      SELECT customer_unique_id, risk_tier FROM tiered WHERE customer_unique_id IN (
        SELECT cust FROM interventions)""")
    out["scenario_record"] = _with(_VALUE, _roi("SELECT * FROM tiered WHERE risk_tier = 'medium'", 15.0, 0.1))
    out["csv_roundtrip"] = _with(_BASE, """
      SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(seller_id AS VARCHAR) AS seller_id,
        price_c / 100.0 AS price, freight_c / 100.0 AS freight_value FROM items""")
    return out


CITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
