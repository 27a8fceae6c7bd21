"""Logical source roles (tasks, calls, orders, ...) derived from the given tables.

Each role is one SELECT over the given tables, written so that both Spark and DuckDB can run it; the
few dialect differences are in ``Dialect``. Apart from one grouping for the tasks and one for the user
tags, every role is a row-by-row projection, so filters and column pruning reach the Parquet scan.
FIXTURES.md describes the roles.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadwright.sources.snapshots import write_copies
from leadwright.sources.tables import write_dated


@dataclass(frozen=True)
class Dialect:
    json_k: str
    minus_days: str
    plus_days: str
    day_number: str


SPARK = Dialect(
    json_k="get_json_object(props, '$.k')",
    minus_days="timestampadd(DAY, -({n}), {t})",
    plus_days="date_add({d}, cast({n} as int))",
    day_number="datediff(cast({t} as date), date '2024-01-01')",
)
#: The same over ``extracted_events``, where the one JSON field the roles use stands in a column.
EXTRACTED = replace(SPARK, json_k="k_text")
DUCK = Dialect(
    json_k="json_extract_string(props, '$.k')",
    minus_days="({t} - to_days(cast({n} as int)))",
    plus_days="({d} + cast({n} as int))",
    day_number="date_diff('day', date '2024-01-01', cast({t} as date))",
)

# User tag columns drawn from the customer key: (column, every p-th is NULL, factor, modulus, kind).
_TAG_SPEC = [
    ("os_type", 6, 1, 2, "text"), ("verify_flag", 0, 1, 2, "int"), ("wx_sex", 7, 1, 3, "sex"),
    ("author_flag", 5, 1, 2, "int"), ("donate_case_num", 4, 3, 9, "int"), ("donate_amt", 4, 7, 211, "amt"),
    ("donate_cnt", 4, 5, 11, "int"), ("cf_fst_donate_amt", 4, 11, 97, "amt"), ("cf_min_donate_amt", 4, 13, 61, "amt"),
    ("cf_last_donate_amt", 4, 17, 83, "amt"), ("sdb_order_num", 3, 1, 6, "int"), ("sdb_order_amt", 3, 19, 501, "amt"),
    ("sdb_normal_order_num", 3, 1, 4, "int"), ("sdb_normal_order_amt", 3, 23, 401, "amt"),
    ("sdb_pay_order_amt", 3, 29, 307, "amt"), ("sdb_normal_pay_order_amt", 3, 31, 203, "amt"),
    ("is_add_hz_flag", 5, 1, 2, "text"), ("hz_user_advance_flag", 9, 1, 2, "int"),
    ("hz_total_charge_cnt", 8, 3, 12, "int"), ("hz_total_charge_amt", 8, 37, 317, "amt"),
    ("hz_total_pay_amt", 8, 41, 113, "amt"), ("hz_fst_join_amt", 8, 43, 41, "amt"), ("hz_insu_type_cnt", 8, 1, 5, "int"),
    ("hz_insu_20_cnt", 10, 1, 3, "int"), ("hz_insu_20_flag", 10, 1, 2, "text"),
    ("hz_insu_1_cnt", 11, 1, 3, "int"), ("hz_insu_1_flag", 11, 1, 2, "text"),
    ("hz_insu_2_cnt", 12, 1, 3, "int"), ("hz_insu_2_flag", 12, 1, 2, "text"),
    ("hz_insu_3_cnt", 13, 1, 3, "int"), ("hz_insu_3_flag", 13, 1, 2, "text"),
    ("hz_insu_4_cnt", 14, 1, 3, "int"), ("hz_insu_4_flag", 14, 1, 2, "text"),
    ("hz_insu_21_cnt", 15, 1, 3, "int"), ("hz_insu_21_flag", 15, 1, 2, "text"),
]
_TAG_KINDS = {
    "int": "cast((c_custkey * {a}) % {m} as int)",
    "amt": "cast((c_custkey * {a}) % {m} as double) * 0.5",
    "text": "cast((c_custkey * {a}) % {m} as string)",
    "sex": "CASE (c_custkey * {a}) % {m} WHEN 0 THEN 'unknown' WHEN 1 THEN 'M' ELSE 'F' END",
}


def _tag_columns() -> str:
    parts = []
    for name, every, a, m, kind in _TAG_SPEC:
        value = _TAG_KINDS[kind].format(a=a, m=m)
        parts.append(f"CASE WHEN c_custkey % {every} = 0 THEN NULL ELSE {value} END AS {name}" if every
                     else f"{value} AS {name}")
    return ",\n  ".join(parts)


def role_sql(name: str, d: Dialect) -> str:
    """SELECT statement of a role; ``@table`` stands for a given table."""
    ev = f"""SELECT event_id, ts, user_id, event_type, value, cast({d.json_k} as int) AS k,
      cast(ts as date) AS dt, 
      'm' || cast(user_id % 97 as string) || '-' || cast({d.day_number.format(t='ts')} % 10 as string) AS mobile,
      user_id * 1000 + {d.day_number.format(t='ts')} AS day_task FROM @events"""
    def visit(counters: str, rest: int) -> str:
        return f"""SELECT user_id, {d.minus_days.format(t='ts', n='k')} AS first_visit_time, ts AS last_visit_time,
      cast(k % 7 as int) AS last_week_visit_cnt, cast(k as int) AS visit_cnt, {counters},
      dt AS dw_start_date, {d.plus_days.format(d='dt', n='k % 4')} AS dw_end_date
      FROM ({ev}) e WHERE event_type = 'view' AND k % 3 = {rest}"""

    hz_counters = "cast(k % 10 as int) AS visit_event_cnt, cast(k % 5 as int) AS visit_payment_cnt"
    task = f"""SELECT user_id, mobile, dt, day_task AS task_id, min(ts) AS create_time, min_by(k, ts) AS k
      FROM ({ev}) e WHERE event_type = 'signup' GROUP BY user_id, mobile, dt, day_task"""
    task_row = """SELECT task_id,
      CASE WHEN k % 29 = 3 THEN 'u' ELSE '' END || cast(user_id as string) AS target_user_id,
      mobile AS target_user_mobile, create_time,
      CASE k % 4 WHEN 0 THEN 'paid_plan' WHEN 1 THEN 'free_insurance_a' ELSE 'x_free_insurance_b' END AS first_chance_name,
      {agent} AS agent_name, cast(k % 3 + 1 as int) AS agent_type, dt FROM task"""
    sql = {
        "crm_task": f"WITH task AS ({task}) " + task_row.format(agent="'agent' || cast(k % 5 as string)")
        + " UNION ALL " + task_row.format(agent="'agentX'") + " WHERE k % 13 = 1",
        "call_record": f"""SELECT event_id AS call_id, day_task - k % 3 AS task_id, mobile, ts AS start_time,
          CASE WHEN k % 3 = 0 THEN 'no_answer' ELSE 'both_connected' END AS status,
          CASE k % 5 WHEN 0 THEN 'Customer Service Team' WHEN 1 THEN 'VIP Customer Service' WHEN 2 THEN NULL
            ELSE 'Sales' END AS team_name, dt
          FROM ({ev}) e WHERE event_type IN ('error', 'click')""",
        "policy_order": f"""SELECT CASE WHEN k % 11 = 0 THEN day_task + 1 ELSE day_task - k % 20 END AS task_id,
          mobile AS phone, 'P' || cast(event_id as string) AS policy_no, ts AS policy_time, value AS origin,
          cast((k + 1) % 2 as int) AS is_long, CASE WHEN k % 5 = 0 THEN 0 ELSE 1 END AS valid,
          cast(3 + k % 4 as int) AS status, dt FROM ({ev}) e WHERE event_type = 'purchase'""",
        "clue": f"""SELECT event_id AS clue_id, mobile,
          CASE k % 8 WHEN 0 THEN 'feed' WHEN 1 THEN 'sem' WHEN 2 THEN 'qywx' WHEN 3 THEN 'SQ_1' WHEN 4 THEN 'lesson_2'
            WHEN 5 THEN 'huzhusq' WHEN 6 THEN 'app' ELSE 'misc' END AS channel,
          's' || cast(k % 4 as string) AS subchannel,
          CASE WHEN k % 3 = 0 THEN 'other' ELSE 'free_insurance' END AS chance_type_name, ts AS create_time, dt
          FROM ({ev}) e WHERE event_type = 'view'""",
        "wx_detail": f"""SELECT dt, user_id, CASE k % 11 WHEN 0 THEN 1 WHEN 1 THEN 104 WHEN 2 THEN 309 WHEN 3 THEN 3
          WHEN 4 THEN 17 WHEN 5 THEN 61 WHEN 6 THEN 115 WHEN 7 THEN 116 WHEN 8 THEN 7 WHEN 9 THEN 420 ELSE 999 END
          AS third_type, cast(k % 2 as int) AS subscribe FROM ({ev}) e""",
        "visit_cf": visit("cast(k % 10 as int) AS visit_case_cnt, cast(k % 5 as int) AS visit_caseid_num", 0),
        "visit_hz": visit(hz_counters, 1) + " UNION ALL SELECT user_id, first_visit_time, last_visit_time,"
        " last_week_visit_cnt + 1, visit_cnt + 1, 0, 99, dw_start_date, dw_end_date FROM ("
        + visit(hz_counters, 1) + " AND k % 10 = 1) twice",
        "visit_bao": visit("cast(k % 10 as int) AS page_cnt", 2),
        "user_action": f"""SELECT user_id, ts AS operation_time,
          CASE WHEN k % 25 = 0 THEN 'nopath' ELSE '/p/x/prod_' || lpad(cast(k % 20 + 1 as string), 2, '0') END
            AS current_original_path,
          CASE WHEN k % 7 = 0 THEN 'hz' ELSE 'ins' END AS biz,
          CASE WHEN k % 4 = 0 THEN 'page_leave' ELSE 'page_enter' END AS operation, dt
          FROM ({ev}) e WHERE event_type IN ('view', 'click')""",
        "ins_order": f"""SELECT event_id AS id, 'O' || cast(event_id as string) AS order_no, user_id, value AS money,
          value * k AS origin, cast(k % 2 as int) AS order_type,
          CASE WHEN k % 10 = 0 THEN '' ELSE 'P' || cast(event_id as string) END AS policy_no,
          CASE k % 9 WHEN 0 THEN 'feed' WHEN 1 THEN 'cf' WHEN 2 THEN 'sdhz' WHEN 3 THEN 'qywx' WHEN 4 THEN 'x_BD_1'
            WHEN 5 THEN 'myapp' WHEN 6 THEN 'sdbao' WHEN 7 THEN 'sem' ELSE 'zz' END AS channel,
          ts AS create_time, dt FROM ({ev}) e WHERE event_type = 'purchase'""",
        "share_action": f"""SELECT user_id, ts AS time, dt FROM ({ev}) e WHERE event_type = 'click' AND k < 30""",
        "app_tag": f"""SELECT user_id, ts AS last_appstart_op_time, dt FROM ({ev}) e
          WHERE event_type = 'click' AND k >= 90""",
        "user_ua": """SELECT c_custkey AS user_id, c_name AS ua, c_mktsegment AS device_type FROM @customer
          WHERE c_custkey % 7 <> 0""",
        "user_tag": f"""SELECT c_custkey AS user_id,
          CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE cast(16 + c_custkey % 50 as int) END AS id_age,
          CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'M' ELSE 'F' END AS id_gender,
          CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'NATION_' || cast(c_nationkey as string) END AS id_city_name,
          CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'NATION_' || cast((c_nationkey + 3) % 25 as string) END AS register_city,
          CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'NATION_' || cast((c_nationkey + 13) % 25 as string) END AS most_visit_city,
          CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'NATION_' || cast((c_nationkey + 7) % 25 as string) END AS wx_city,
          CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'NATION_' || cast((c_nationkey + 5) % 25 as string) END AS last_visit_city,
          CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'NATION_' || cast((c_nationkey + 17) % 25 as string) END AS mobile_city,
          CASE c_custkey % 4 WHEN 0 THEN '移动' WHEN 1 THEN '联通' WHEN 2 THEN '电信' ELSE c_mktsegment END AS mobile_operator,
          {_tag_columns()},
          cast(o.n_orders as int) AS hz_order_num, cast(o.n_filled as int) AS hz_eff_order_num,
          c_acctbal / 1000 AS hz_total_bal_amt, o.first_order AS hz_fst_join_time, o.last_order AS cf_last_donate_time,
          o.first_filled AS cf_fst_donate_time, o.max_price AS cf_max_donate_amt
          FROM @customer c LEFT JOIN (
            SELECT o_custkey, count(*) AS n_orders, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_filled,
              min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
              min(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS first_filled, max(o_totalprice) AS max_price
            FROM @orders GROUP BY o_custkey) o ON c_custkey = o_custkey
          WHERE c_custkey % 13 <> 0""",
    }
    return sql[name]


ROLES = [
    "crm_task", "call_record", "policy_order", "clue", "wx_detail", "visit_cf", "visit_hz", "visit_bao",
    "user_action", "ins_order", "share_action", "app_tag", "user_ua", "user_tag",
]
_GIVEN = re.compile(r"@(\w+)")


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def extracted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with the JSON field that the roles use as text, ``k_text``. Most roles read it several times per row, so a build
    that reads all roles does better to write these once."""
    return given(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", F.expr(f"{SPARK.json_k} AS k_text"))


def role(spark: SparkSession, sf_dir: str, name: str, opened: dict[str, DataFrame] | None = None) -> DataFrame:
    """A role as a lazy DataFrame over the given Parquet tables; ``opened`` holds tables opened before, the events either as given or extracted."""
    sql = role_sql(name, EXTRACTED if opened and "events" in opened and "k_text" in opened["events"].columns else SPARK)
    opened = {} if opened is None else opened
    tables = {}
    for table in sorted(set(_GIVEN.findall(sql))):
        if table not in opened:
            opened[table] = given(spark, sf_dir, table)
        tables[table] = opened[table]
    return spark.sql(_GIVEN.sub(r"{\1}", sql), **tables)


def load_roles(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> dict[str, DataFrame]:
    """All roles; ``events`` are the extracted events, if they have been written."""
    opened: dict[str, DataFrame] = {} if events is None else {"events": events}
    return {name: role(spark, sf_dir, name, opened) for name in ROLES}


def duck_role(name: str) -> str:
    return _GIVEN.sub(r"\1", role_sql(name, DUCK))


# Snapshot stamps: the snapshot of day D holds all rows up to D and is stamped dt = D.
STAMPS = ["2024-01-29", "2024-01-30"]


def stamped_sql(name: str, d: Dialect) -> str:
    return " UNION ALL ".join(
        f"SELECT * REPLACE (date '{day}' AS dt) FROM ({role_sql(name, d)}) s WHERE dt <= date '{day}'"
        for day in STAMPS
    )


def snapshots(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role as a table of full daily snapshots, one per stamp."""
    rows = role(spark, sf_dir, name)
    parts = [rows.where(F.col("dt") <= F.lit(day).cast("date")).withColumn("dt", F.lit(day).cast("date"))
             for day in STAMPS]
    return parts[0].unionByName(parts[1])


def duck_snapshots(name: str) -> str:
    return _GIVEN.sub(r"\1", stamped_sql(name, DUCK))


# ---------------------------------------------------------------- a store of stamped tables
# What lies in the store: full copies of several days (one of them late), daily increments, and histories without stamps.
COPY_DAYS = ["2024-01-28", "2024-01-29", "2024-01-30", "2024-01-31"]
LATE_DAYS = {"clue": COPY_DAYS[:2]}
INCREMENT_ROLES = ["wx_detail", "user_action"]
UNSTAMPED_ROLES = ["visit_cf", "visit_hz", "visit_bao"]
#: Users of the two tables without a day of their own join on this day.
_JOINED = "date_add(date '2023-12-25', cast(user_id % 40 as int))"
_DUCK_JOINED = "(date '2023-12-25' + cast(user_id % 40 as int))"
_DAYLESS = ("user_ua", "user_tag")


def copied_roles() -> list[str]:
    return [r for r in ROLES if r not in INCREMENT_ROLES and r not in UNSTAMPED_ROLES]


def write_store(spark: SparkSession, sf_dir: str, folder: str, events: DataFrame | None = None) -> dict[str, str]:
    """Write every role as a table of the store; the path of each."""
    paths = {}
    for name, rows in load_roles(spark, sf_dir, events).items():
        path = paths[name] = f"{folder}/{name}"
        if name in UNSTAMPED_ROLES:
            rows.write.mode("overwrite").parquet(path)
        elif name in INCREMENT_ROLES:
            write_dated(rows, path)
        else:
            known = F.expr(_JOINED) if name in _DAYLESS else F.col("dt")
            write_copies(rows, known, path, LATE_DAYS.get(name, COPY_DAYS))
    return paths


def duck_copy(name: str, stamp: str) -> str:
    """What the copy of one day holds, as DuckDB SQL."""
    if name in _DAYLESS:
        return f"SELECT *, DATE '{stamp}' AS dt FROM ({duck_role(name)}) c WHERE {_DUCK_JOINED} <= DATE '{stamp}'"
    return f"SELECT * REPLACE (DATE '{stamp}' AS dt) FROM ({duck_role(name)}) c WHERE dt <= DATE '{stamp}'"
