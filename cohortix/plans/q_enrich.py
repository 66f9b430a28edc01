"""Catalog: logistics and support-ticket enrichments."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.functions.hashing import choice, choice_sql, uniform_decimal_sql
from cohortix.operators import enrich as E
from cohortix.operators import experiments as X
from cohortix.params import (
    AGENTS,
    AS_OF,
    CARRIER_MULTIPLIER,
    CARRIERS,
    CHANNELS,
    DELIVERY_INSTRUCTIONS,
    ISSUE_CATEGORIES,
    PACKAGE_BASE_COST,
    PRIORITIES,
    PRIORITY_BY_CATEGORY,
    RESOLUTION_BASE_HOURS,
    RESOLUTION_PRIORITY_MULT,
    RESPONSE_BASE_MINUTES,
    RESPONSE_PRIORITY_MULT,
    SATISFACTION_BY_STATUS,
    TICKET_DESCRIPTIONS,
    TICKET_STATUSES,
    TICKETS_PER_USER,
    TRACKING_PATTERN,
    WAREHOUSES,
)
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx

SEED = 42


def d(key: str, salt: str) -> str:
    return Q.bucket(f"'{SEED}_{salt}_' || CAST({key} AS VARCHAR)")


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(Q.sql_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def _tracking_sql(key: str) -> str:
    h = f"md5('{SEED}_tracking_' || CAST({key} AS VARCHAR))"
    parts, li = [], 0
    for i, ch in enumerate(TRACKING_PATTERN):
        if ch == "#":
            parts.append(f"CAST((('0x' || substr({h}, {i + 1}, 1))::INTEGER % 10) AS VARCHAR)")
        else:
            idx = f"(('0x' || substr({h}, {17 + 2 * li}, 2))::INTEGER % {len(E.LETTERS)})"
            parts.append(f"substr('{E.LETTERS}', {idx} + 1, 1)")
            li += 1
    return " || ".join(parts)


def _package_sql(key: str) -> str:
    b = d(key, "package")
    return (f"CASE WHEN num_of_item = 1 THEN {choice_sql(b, ['envelope', 'small_box'])} "
            f"WHEN num_of_item <= 3 THEN {choice_sql(b, ['small_box', 'medium_box'])} "
            f"WHEN num_of_item <= 6 THEN {choice_sql(b, ['medium_box', 'large_box'])} ELSE 'oversized' END")


COMPLETED = "WITH " + Q.SRC_ORDERS.strip() + """,
completed AS (SELECT * FROM src_orders WHERE status = 'Complete')"""

LOGISTICS = COMPLETED + f""",
lg0 AS (
  SELECT order_id, user_id,
         {choice_sql(d('order_id', 'warehouse'), [w[0] for w in WAREHOUSES])} AS warehouse_id,
         {choice_sql(d('order_id', 'carrier'), list(CARRIERS))} AS shipping_carrier,
         {_package_sql('order_id')} AS package_type,
         {uniform_decimal_sql(d('order_id', 'cost_jitter'), '-2', '2')} AS jitter,
         CAST(1 + {d('order_id', 'processing')} % 3 AS INTEGER) AS processing_days,
         CAST(1 + {d('order_id', 'transit')} % 7 AS INTEGER) AS transit_days,
         {_tracking_sql('order_id')} AS tracking_number,
         CAST(round_even({uniform_decimal_sql(d('order_id', 'insurance'), '0', '5')}, 2) AS DECIMAL(10,2)) AS insurance_cost,
         {d('order_id', 'expedite')} < 150000 AS is_expedited,
         {choice_sql(d('order_id', 'instructions'), list(DELIVERY_INSTRUCTIONS))} AS delivery_instructions
  FROM completed),
wh AS (SELECT * FROM {_values(WAREHOUSES, ['warehouse_id', 'warehouse_location', 'warehouse_region'])}),
pk AS (SELECT package_type, CAST(base_cost AS DECIMAL(6,2)) AS base_cost
       FROM {_values(PACKAGE_BASE_COST, ['package_type', 'base_cost'])}),
cr AS (SELECT shipping_carrier, CAST(m AS DECIMAL(4,2)) AS carrier_multiplier
       FROM {_values(CARRIER_MULTIPLIER, ['shipping_carrier', 'm'])}),
logistics AS (
  SELECT lg0.order_id, lg0.user_id, lg0.warehouse_id, wh.warehouse_location, wh.warehouse_region,
         lg0.shipping_carrier, lg0.package_type,
         CAST(greatest(CAST(0 AS DECIMAL(10,2)), round_even(pk.base_cost * cr.carrier_multiplier + lg0.jitter, 2))
              AS DECIMAL(10,2)) AS shipping_cost,
         processing_days, transit_days, processing_days + transit_days AS total_delivery_days,
         tracking_number, insurance_cost, is_expedited, delivery_instructions,
         pk.base_cost, cr.carrier_multiplier
  FROM lg0 JOIN wh ON lg0.warehouse_id = wh.warehouse_id JOIN pk ON lg0.package_type = pk.package_type
  JOIN cr ON lg0.shipping_carrier = cr.shipping_carrier)"""

LOGISTICS_COLS = ("order_id, user_id, warehouse_id, warehouse_location, warehouse_region, shipping_carrier, "
                  "package_type, shipping_cost, processing_days, transit_days, total_delivery_days, "
                  "tracking_number, insurance_cost, is_expedited, delivery_instructions")


def _completed(spark, sf_dir):
    return X.completed_orders(fx.orders(spark, sf_dir)).withColumnRenamed("order_date", "created_at")


def _logistics(spark, sf_dir):
    return E.order_logistics(spark, _completed(spark, sf_dir), SEED)


@query("order_logistics", LOGISTICS + f"\nSELECT {LOGISTICS_COLS} FROM logistics")
def order_logistics(spark, sf_dir):
    return _logistics(spark, sf_dir)


@query("shipping_cost", LOGISTICS + """
SELECT order_id, package_type, shipping_carrier, base_cost, carrier_multiplier, shipping_cost FROM logistics""")
def shipping_cost(spark, sf_dir):
    return E.shipping_cost(spark, _completed(spark, sf_dir), SEED)


# ---------------------------------------------------------------------------
# Tickets
# ---------------------------------------------------------------------------

def _cond_choice_sql(col: str, b: str, table: dict, default) -> str:
    parts = []
    for key, opts in table.items():
        parts.append(f"WHEN {col} = {Q.sql_lit(key)} THEN "
                     f"{choice_sql(b, [v for v, _ in opts], [w for _, w in opts])}")
    dflt = choice_sql(b, [v for v, _ in default], [w for _, w in default])
    return f"(CASE {' '.join(parts)} ELSE {dflt} END)"


_TK = "CAST(user_id AS VARCHAR) || '_' || CAST(ticket_num AS VARCHAR)"

TICKETS = "WITH " + Q.SRC_ORDERS.strip() + ",\n" + Q.SRC_USERS.strip() + f""",
contact AS (SELECT user_id, registration_date,
                   {choice_sql(d('user_id', 'n_tickets'), [v for v, _ in TICKETS_PER_USER], [w for _, w in TICKETS_PER_USER])} AS n_tickets
            FROM src_users WHERE {d('user_id', 'contact')} < 250000),
fan AS (SELECT user_id, registration_date, n_tickets, unnest(generate_series(1, n_tickets)) AS ticket_num FROM contact),
t0 AS (
  SELECT user_id, ticket_num, {_TK} AS tk, registration_date FROM fan),
t1 AS (
  SELECT user_id, ticket_num,
         'TICK_' || upper(substr(md5('{SEED}_ticket_' || tk), 1, 12)) AS ticket_id,
         CAST(registration_date + CAST({d('tk', 'created')} % (greatest(date_diff('day', registration_date, DATE '{AS_OF[:10]}'), 0) + 1) AS INTEGER) AS DATE) AS created_date,
         {choice_sql(d('tk', 'category'), [c for c, _ in ISSUE_CATEGORIES], [w for _, w in ISSUE_CATEGORIES])} AS issue_category,
         {choice_sql(d('tk', 'status'), [s for s, _ in TICKET_STATUSES], [w for _, w in TICKET_STATUSES])} AS status,
         {choice_sql(d('tk', 'agent'), list(AGENTS))} AS assigned_agent,
         {choice_sql(d('tk', 'channel'), [c for c, _ in CHANNELS], [w for _, w in CHANNELS])} AS contact_channel,
         {d('tk', 'escalated')} < 150000 AS is_escalated,
         {d('tk', 'follow_up')} < 250000 AS follow_up_required,
         CAST({d('tk', 'description')} % 4 AS INTEGER) AS desc_idx,
         {uniform_decimal_sql(d('tk', 'resolution'), '0.7', '1.3')} AS u_res,
         {uniform_decimal_sql(d('tk', 'response'), '0.5', '1.5')} AS u_resp,
         {d('tk', 'satisfaction')} AS b_sat, {d('tk', 'priority')} AS b_pri
  FROM t0),
t2 AS (
  SELECT *, {_cond_choice_sql('issue_category', 'b_pri', PRIORITY_BY_CATEGORY, PRIORITIES)} AS priority,
         CAST({_cond_choice_sql('status', 'b_sat', SATISFACTION_BY_STATUS, ((3, 1.0),))} AS INTEGER) AS satisfaction_score
  FROM t1),
descs AS (SELECT * FROM {_values([(c, i, dsc) for c, ds in TICKET_DESCRIPTIONS.items() for i, dsc in enumerate(ds)], ['issue_category', 'desc_idx', 'ticket_description'])}),
resb AS (SELECT * FROM {_values(RESOLUTION_BASE_HOURS, ['issue_category', 'res_base'])}),
resm AS (SELECT * FROM {_values(RESOLUTION_PRIORITY_MULT, ['priority', 'res_mult'])}),
rspb AS (SELECT * FROM {_values(RESPONSE_BASE_MINUTES, ['contact_channel', 'resp_base'])}),
rspm AS (SELECT * FROM {_values(RESPONSE_PRIORITY_MULT, ['priority', 'resp_mult'])}),
nord AS (SELECT user_id, count(*) AS user_order_count FROM src_orders GROUP BY user_id),
t3 AS (
  SELECT t2.*, descs.ticket_description,
         CASE WHEN t2.status IN ('open', 'in_progress') THEN NULL ELSE
           CAST(round_even(CAST(resb.res_base AS DECIMAL(10,0)) * CAST(resm.res_mult AS DECIMAL(3,1)) * u_res, 1) AS DECIMAL(10,1))
         END AS resolution_time_hours,
         greatest(1, CAST(round_even(CAST(rspb.resp_base AS DECIMAL(10,0)) * CAST(rspm.resp_mult AS DECIMAL(3,1)) * u_resp, 0) AS INTEGER))
           AS first_response_time_minutes,
         coalesce(nord.user_order_count, 0) AS user_order_count
  FROM t2 JOIN descs ON t2.issue_category = descs.issue_category AND t2.desc_idx = descs.desc_idx
  JOIN resb ON t2.issue_category = resb.issue_category JOIN resm ON t2.priority = resm.priority
  JOIN rspb ON t2.contact_channel = rspb.contact_channel JOIN rspm ON t2.priority = rspm.priority
  LEFT JOIN nord ON t2.user_id = nord.user_id),
tickets AS (
  SELECT ticket_id, user_id, ticket_num, created_date, issue_category, priority, status, assigned_agent,
         contact_channel, ticket_description, resolution_time_hours, satisfaction_score, is_escalated,
         follow_up_required,
         CASE WHEN resolution_time_hours IS NULL THEN NULL
              ELSE CAST(created_date + CAST(floor(resolution_time_hours / 24) AS INTEGER) AS DATE) END AS resolved_date,
         first_response_time_minutes, user_order_count
  FROM t3)"""


def _tickets(spark, sf_dir):
    return E.support_tickets(spark, fx.users(spark, sf_dir), fx.orders(spark, sf_dir, with_items=False), AS_OF, SEED)


@query("support_tickets", TICKETS + "\nSELECT * FROM tickets")
def support_tickets(spark, sf_dir):
    return _tickets(spark, sf_dir)


@query("ticket_fanout", TICKETS + "\nSELECT user_id, registration_date, n_tickets, ticket_num FROM fan")
def ticket_fanout(spark, sf_dir):
    return E.ticket_fanout(fx.users(spark, sf_dir), SEED)


@query("ticket_sla", TICKETS + """
SELECT ticket_id, priority, status, contact_channel, resolution_time_hours, resolved_date, first_response_time_minutes
FROM tickets""")
def ticket_sla(spark, sf_dir):
    return _tickets(spark, sf_dir).select(
        "ticket_id", "priority", "status", "contact_channel", "resolution_time_hours", "resolved_date",
        "first_response_time_minutes",
    )


@query("weighted_choice", "WITH " + Q.SRC_USERS.strip() + f"""
SELECT user_id, {d('user_id', 'category')} AS bucket,
       {choice_sql(d('user_id', 'category'), [c for c, _ in ISSUE_CATEGORIES], [w for _, w in ISSUE_CATEGORIES])} AS issue_category
FROM src_users""")
def weighted_choice(spark, sf_dir):
    b = E.draw(F.col("user_id"), "category", SEED)
    return fx.users(spark, sf_dir).select(
        "user_id", b.alias("bucket"),
        choice(b, [c for c, _ in ISSUE_CATEGORIES], [w for _, w in ISSUE_CATEGORIES]).alias("issue_category"),
    )


@query("value_shares", TICKETS + """
SELECT issue_category, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM tickets GROUP BY issue_category""")
def value_shares(spark, sf_dir):
    return E.value_shares(_tickets(spark, sf_dir), "issue_category")
