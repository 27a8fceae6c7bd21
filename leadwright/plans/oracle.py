"""DuckDB statements that the Spark queries are checked against.

They are written from the definitions, with joins per pair, correlated subqueries and plain windows where
the Spark jobs use timelines, range sorts and folds. ``statement`` adds the common table expressions used.
"""

from __future__ import annotations

import re

from leadwright.functions import fixed_values as fx
from leadwright.sources import roles

START, END, CALLS_UNTIL = "2024-01-01", "2024-01-31", "2024-02-15"
SINCE, SNAPSHOT, AS_OF = "2023-12-01", "2024-01-30", "2024-01-31"

TIER_PATTERNS = [("Tier_1", "NATION_[0-3]$"), ("New_Tier_1", "NATION_[4-9]$"), ("Tier_2", "NATION_1[0-4]$")]


def tier(column: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{label}'" for label, p in TIER_PATTERNS)
    return f"CASE WHEN {column} IS NULL THEN 'unknown' {whens} ELSE 'others' END"


def channel_type(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, 'feed|sem|.*BD.*') THEN 'Ads' "
            f"WHEN regexp_full_match({c}, 'cf|sdhz|sdbao|.*app.*') THEN 'Internal' "
            f"WHEN {c} = 'qywx' THEN 'Community' ELSE 'Others' END")


def channel_group(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, 'feed|cf|sdhz|qywx') THEN {c} WHEN regexp_matches({c}, 'BD') THEN 'BD' "
            f"WHEN regexp_full_match({c}, 'sdbao|.*app.*') THEN 'sdbao' ELSE 'others' END")


def gap(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', CAST({earlier} AS DATE), CAST({later} AS DATE)) AS INTEGER)"


def moved(home: str, now: str, unknown: str) -> str:
    return (f"CASE WHEN {home} = 'unknown' OR {now} = 'unknown' THEN '{unknown}' "
            f"WHEN {home} <> 'Tier_1' AND {now} = 'Tier_1' THEN '1' ELSE '0' END")


def any_of(column: str, values) -> str:
    return f"list_contains([{', '.join(repr(v) for v in values)}], {column})"


def _asof(role: str, extras: list[str], at: str = "l.alloc_time") -> str:
    order = ["last_visit_time", "dw_end_date", "first_visit_time", "last_week_visit_cnt", "visit_cnt", *extras]
    return (f"SELECT * FROM {role} h WHERE h.user_id = l.user_id AND h.last_visit_time < {at} "
            f"ORDER BY {', '.join('h.' + c + ' DESC' for c in order)} LIMIT 1")


_FOLLOW = {f"follow_{g}": codes for g, codes in zip(("hz", "cf", "sdb"), fx.SUBSCRIPTION_CODES.values())}
_OPERATOR = ("CASE mobile_operator WHEN '移动' THEN 'Operator_A' WHEN '联通' THEN 'Operator_B' "
             "WHEN '电信' THEN 'Operator_C' ELSE 'others' END")
_TAG_KEPT = ", ".join(f"t.{c}" for c in [*fx.KEEP_NULL_TAGS])
_TAG_ZERO = ", ".join(f"coalesce(t.{c}, 0) AS {c}" for c in fx.ZERO_FILL_TAGS)
_TAG_FLAG = ", ".join(f"coalesce(t.{c}, '0') AS {c}" for c in fx.FLAG_FILL_TAGS)
_TAG_DIFF = ", ".join(f"{gap('l.alloc_date', 't.' + c)} AS {n}" for c, n in fx.TAG_TIMES.items())
_CLASSES = ", ".join(f"CASE WHEN t.user_id IS NOT NULL THEN {tier('t.' + c)} END AS {n}" for c, n in fx.CITY_COLUMNS.items())


def _mapped(inner: str, unknown: str) -> str:
    """Add the columns computed from other feature columns."""
    return f"""SELECT * EXCLUDE (mobile_operator, order_channel), {_OPERATOR} AS mobile_operator,
      {channel_type('order_channel')} AS channel_type, {channel_group('order_channel')} AS channel_group,
      {moved('id_city_class', 'most_visit_city_class', unknown)} AS id_mostvisit_city_up_flag,
      {moved('id_city_class', 'wx_city_class', unknown)} AS id_wx_city_up_flag,
      id_city_class || wx_city_class AS id_wx_class_concat,
      id_city_class || most_visit_city_class AS id_mostvisit_class_concat,
      CASE WHEN follow_hz_tag = '1' OR follow_cf_tag = '1' OR follow_sdb_tag = '1' THEN '1' ELSE '0' END AS follow_tag
      FROM ({inner})"""


def _visits_reference(g: str, extras: list[str]) -> dict[str, str]:
    counters = ["last_week_visit_cnt", "visit_cnt"]
    named = [f"max(e.{c}) AS {c}_{g}" for c in counters] + [f"max(e.{c}) AS {c}" for c in extras]
    return {
        f"ref_{g}_rows": f"""SELECT DISTINCT h.* FROM (
            SELECT l.user_id, l.alloc_time, max(h.last_visit_time) AS newest FROM lead_tasks l
            JOIN visit_{g} h ON h.user_id = l.user_id AND h.last_visit_time < l.alloc_time GROUP BY ALL) a
            JOIN visit_{g} h ON h.user_id = a.user_id AND h.last_visit_time = a.newest""",
        f"ref_{g}": f"""SELECT l.user_id, {', '.join(named)},
            max({gap('l.alloc_date', 'e.first_visit_time')}) AS datediff_first_visit_{g},
            max({gap('l.alloc_date', 'e.last_visit_time')}) AS datediff_last_visit_{g}
            FROM lead_tasks l JOIN ref_{g}_rows e ON e.user_id = l.user_id GROUP BY l.user_id""",
    }


_CALL_DAYS = f"CAST(start_time AS DATE) BETWEEN DATE '{START}' AND DATE '{CALLS_UNTIL}'"
_FINAL_TAIL = ["alloc_time", "last_visit_time"]

CTE: dict[str, str] = {
    **{name: roles.duck_role(name) for name in roles.ROLES},
    "lead_tasks": f"""SELECT DISTINCT task_id, try_cast(target_user_id AS BIGINT) AS user_id, target_user_mobile,
        first_chance_name, agent_name, agent_type, create_time AS alloc_time, CAST(create_time AS DATE) AS alloc_date
        FROM crm_task WHERE contains(first_chance_name, 'free_insurance')
        AND CAST(create_time AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'""",
    "leads0": "SELECT DISTINCT * EXCLUDE (agent_name) FROM lead_tasks",
    "connected_calls": f"SELECT * FROM call_record WHERE status = 'both_connected' AND {_CALL_DAYS}",
    "numbered_calls": "SELECT *, row_number() OVER (PARTITION BY mobile ORDER BY start_time, task_id) AS callnum FROM call_record",
    "policies": f"""SELECT * FROM policy_order WHERE CAST(policy_time AS DATE) >= DATE '{START}'
        AND is_long = 1 AND valid = 1 AND status IN (3, 4, 6)""",
    "clue1": """SELECT mobile, channel, subchannel, CASE WHEN regexp_full_match(channel, 'feed|sem|qywx|dy|DY') THEN 'Ads'
        WHEN regexp_full_match(channel, 'huzhusq|SQ.*|lesson.*|sdbsqnew|lujiekz') THEN 'Community' ELSE 'Normal' END AS channel_type
        FROM clue WHERE contains(chance_type_name, 'free_insurance')
        QUALIFY row_number() OVER (PARTITION BY mobile ORDER BY create_time, clue_id) = 1""",
    "lead_labels": """SELECT l.task_id,
        CAST(coalesce(bool_or(d BETWEEN 0 AND 7), false) AS INTEGER) AS t7_policy_flag,
        count(DISTINCT policy_no) FILTER (WHERE d BETWEEN 0 AND 7) AS t7_policy_cnt,
        round(sum(origin) FILTER (WHERE d BETWEEN 0 AND 7), 4) AS t7_origin,
        CAST(coalesce(bool_or(d BETWEEN 0 AND 14), false) AS INTEGER) AS t14_policy_flag,
        count(DISTINCT policy_no) FILTER (WHERE d BETWEEN 0 AND 14) AS t14_policy_cnt,
        round(sum(origin) FILTER (WHERE d BETWEEN 0 AND 14), 4) AS t14_origin
        FROM leads0 l LEFT JOIN (SELECT p.*, date_diff('day', alloc_date, CAST(policy_time AS DATE)) AS d
          FROM policies p JOIN leads0 USING (task_id)) p USING (task_id) GROUP BY l.task_id""",
    "lead_flags": """SELECT l.task_id,
        CASE WHEN (SELECT min(start_time) FROM connected_calls c WHERE c.task_id = l.task_id
          AND team_name NOT LIKE '%Customer Service%') > l.alloc_time THEN 1 ELSE 0 END AS through_flag,
        CASE WHEN EXISTS (SELECT 1 FROM numbered_calls n WHERE n.task_id = l.task_id AND callnum = 1 AND start_time =
          (SELECT min(start_time) FROM connected_calls c WHERE c.task_id = l.task_id AND c.start_time > l.alloc_time
            AND team_name <> 'Customer Service Team')) THEN 1 ELSE 0 END AS fst_through_flag FROM leads0 l""",
    "base_leads": """SELECT l.*, through_flag, fst_through_flag, b.* EXCLUDE (task_id), channel_type, channel, subchannel
        FROM leads0 l JOIN lead_flags USING (task_id) JOIN lead_labels b USING (task_id)
        LEFT JOIN clue1 ON mobile = target_user_mobile""",
    "ref_labels": """SELECT l.task_id, l.user_id, l.target_user_mobile, first_chance_name, agent_type, alloc_time, alloc_date,
        CASE WHEN date_diff('day', alloc_date, CAST(policy_time AS DATE)) <= 7 THEN 1 ELSE 0 END AS t7_policy_flag,
        CASE WHEN date_diff('day', alloc_date, CAST(policy_time AS DATE)) <= 14 THEN 1 ELSE 0 END AS t14_policy_flag,
        count(DISTINCT policy_no) FILTER (WHERE t7_policy_flag = 1) AS t7_policy_cnt,
        round(sum(origin) FILTER (WHERE t7_policy_flag = 1), 4) AS t7_origin,
        count(DISTINCT policy_no) FILTER (WHERE t14_policy_flag = 1) AS t14_policy_cnt,
        round(sum(origin) FILTER (WHERE t14_policy_flag = 1), 4) AS t14_origin,
        channel_type, channel, subchannel
        FROM lead_tasks l LEFT JOIN policies p ON p.task_id = l.task_id LEFT JOIN clue1 ON mobile = target_user_mobile
        GROUP BY ALL""",
    "subscribed": f"""SELECT dt, user_id, {', '.join(
        f"max(CASE WHEN {any_of('third_type', codes)} THEN 1 ELSE 0 END) AS {g}_flag" for g, codes in _FOLLOW.items())}
        FROM wx_detail WHERE subscribe = 1 AND dt BETWEEN DATE '{SINCE}' AND DATE '{SNAPSHOT}' GROUP BY dt, user_id""",
    "follow": f"""SELECT l.task_id, {', '.join(
        f"CASE WHEN l.user_id IS NOT NULL THEN coalesce(max(CASE WHEN s.dt <= l.alloc_date - 1 AND {g}_flag = 1 THEN '1' ELSE '0' END), '0') END AS {g}_tag"
        for g in _FOLLOW)} FROM leads0 l LEFT JOIN subscribed s ON s.user_id = l.user_id GROUP BY l.task_id, l.user_id""",
    "page_views": f"""SELECT DISTINCT user_id, operation_time, string_split(current_original_path, '/')[-1] AS produ_no
        FROM user_action WHERE biz = 'ins' AND operation = 'page_enter' AND user_id <> 0
        AND dt BETWEEN DATE '{SINCE}' AND DATE '{SNAPSHOT}' AND contains(current_original_path, '/')
        AND regexp_full_match(produ_no, 'prod_(0[1-9]|1[0-7])')""",
    "gift": "SELECT * FROM ins_order WHERE order_type = 1 AND policy_no <> ''",
    "lead_views": """SELECT l.task_id, count(DISTINCT v.operation_time) AS total_visit_cnt_short,
        count(DISTINCT CASE WHEN CAST(v.operation_time AS DATE) >= l.alloc_date - 7 THEN v.operation_time END) AS last_week_visit_cnt_short,
        count(DISTINCT v.produ_no) AS product_cnt_short, min(v.operation_time) AS first_view, max(v.operation_time) AS last_view
        FROM leads0 l LEFT JOIN page_views v ON v.user_id = l.user_id AND v.operation_time < l.alloc_time GROUP BY l.task_id""",
    "lead_orders": """SELECT l.task_id, count(o.order_no) AS cnt, round(sum(o.money), 4) AS money, round(sum(o.origin), 4) AS origin,
        count(DISTINCT o.id) FILTER (WHERE o.order_type = 1 AND o.policy_no <> '') AS gift_insurance_cnt,
        arg_max(o.channel, (o.create_time, o.id)) FILTER (WHERE o.order_type = 1 AND o.policy_no <> '') AS order_channel
        FROM leads0 l LEFT JOIN ins_order o ON o.user_id = l.user_id AND o.create_time < l.alloc_time GROUP BY l.task_id""",
    "lead_app": """SELECT l.task_id, max(a.last_appstart_op_time) AS app_start FROM leads0 l LEFT JOIN app_tag a
        ON a.user_id = l.user_id AND a.last_appstart_op_time < l.alloc_time GROUP BY l.task_id""",
    "lead_share": """SELECT l.task_id, max(s.time) AS last_share, count(s.time) AS share_cnt FROM leads0 l
        LEFT JOIN share_action s ON s.user_id = l.user_id AND s.time < l.alloc_time GROUP BY l.task_id""",
    "lead_visits": f"""SELECT l.task_id,
        cf.first_visit_time AS first_visit_time_cf, cf.last_visit_time AS last_visit_time_cf,
        cf.last_week_visit_cnt AS last_week_visit_cnt_cf, cf.visit_cnt AS visit_cnt_cf, cf.visit_case_cnt, cf.visit_caseid_num,
        {gap('l.alloc_date', 'cf.first_visit_time')} AS datediff_first_visit_cf, {gap('l.alloc_date', 'cf.last_visit_time')} AS datediff_last_visit_cf,
        hz.first_visit_time AS first_visit_time_hz, hz.last_visit_time AS last_visit_time_hz,
        hz.last_week_visit_cnt AS last_week_visit_cnt_hz, hz.visit_cnt AS visit_cnt_hz, hz.visit_event_cnt, hz.visit_payment_cnt,
        {gap('l.alloc_date', 'hz.first_visit_time')} AS datediff_first_visit_hz, {gap('l.alloc_date', 'hz.last_visit_time')} AS datediff_last_visit_hz,
        bao.first_visit_time AS first_visit_time_bao, bao.last_visit_time AS last_visit_time_bao,
        bao.last_week_visit_cnt AS last_week_visit_cnt_bao, bao.visit_cnt AS visit_cnt_bao,
        {gap('l.alloc_date', 'bao.first_visit_time')} AS datediff_first_visit_bao, {gap('l.alloc_date', 'bao.last_visit_time')} AS datediff_last_visit_bao
        FROM leads0 l
        LEFT JOIN LATERAL ({_asof('visit_cf', ['visit_case_cnt', 'visit_caseid_num'])}) cf ON true
        LEFT JOIN LATERAL ({_asof('visit_hz', ['visit_event_cnt', 'visit_payment_cnt'])}) hz ON true
        LEFT JOIN LATERAL ({_asof('visit_bao', [])}) bao ON true""",
    "lead_tags": f"""SELECT l.task_id, {_TAG_KEPT}, {_TAG_ZERO}, {_TAG_FLAG}, {_TAG_DIFF}, {_CLASSES}, t.mobile_operator
        FROM leads0 l LEFT JOIN user_tag t ON t.user_id = l.user_id""",
    "features": "SELECT {cols} FROM ({inner})".format(
        cols=", ".join(["user_id", "task_id"]) + ", * EXCLUDE (user_id, task_id)",
        inner=_mapped("""SELECT l.user_id, l.task_id, l.target_user_mobile, l.alloc_date, l.first_chance_name, l.agent_type,
          l.t14_policy_flag, l.alloc_time, g.* EXCLUDE (task_id), u.device_type, f.* EXCLUDE (task_id),
          coalesce(v.last_week_visit_cnt_cf, 0) AS last_week_visit_cnt_cf, coalesce(v.visit_cnt_cf, 0) AS visit_cnt_cf,
          coalesce(v.visit_case_cnt, 0) AS visit_case_cnt, coalesce(v.visit_caseid_num, 0) AS visit_caseid_num,
          coalesce(v.last_week_visit_cnt_hz, 0) AS last_week_visit_cnt_hz, coalesce(v.visit_cnt_hz, 0) AS visit_cnt_hz,
          coalesce(v.visit_event_cnt, 0) AS visit_event_cnt, coalesce(v.visit_payment_cnt, 0) AS visit_payment_cnt,
          coalesce(v.last_week_visit_cnt_bao, 0) AS last_week_visit_cnt_bao, coalesce(v.visit_cnt_bao, 0) AS visit_cnt_bao,
          v.datediff_first_visit_cf, v.datediff_last_visit_cf, v.datediff_first_visit_hz, v.datediff_last_visit_hz,
          v.datediff_first_visit_bao, v.datediff_last_visit_bao,
          w.total_visit_cnt_short, w.last_week_visit_cnt_short, w.product_cnt_short,
          """ + gap("l.alloc_date", "w.first_view") + """ AS datediff_first_oper_short,
          """ + gap("l.alloc_date", "w.last_view") + """ AS datediff_last_oper_short,
          o.gift_insurance_cnt, o.order_channel, CASE WHEN a.app_start IS NOT NULL THEN 1 ELSE 0 END AS sdb_app_start_flag,
          """ + gap("l.alloc_date", "s.last_share") + """ AS datediff_lastshare,
          greatest(v.last_visit_time_cf, v.last_visit_time_hz, v.last_visit_time_bao) AS last_visit_time
          FROM base_leads l JOIN lead_tags g USING (task_id) JOIN follow f USING (task_id) JOIN lead_visits v USING (task_id)
          JOIN lead_views w USING (task_id) JOIN lead_orders o USING (task_id) JOIN lead_app a USING (task_id)
          JOIN lead_share s USING (task_id) LEFT JOIN user_ua u ON u.user_id = l.user_id""", "unknown")),
    # ---- original user-level results, with the joins on the user written out
    **_visits_reference("cf", ["visit_case_cnt", "visit_caseid_num"]),
    **_visits_reference("hz", ["visit_event_cnt", "visit_payment_cnt"]),
    "ref_bao_rows": _visits_reference("bao", [])["ref_bao_rows"],
    "ref_bao": f"""SELECT l.task_id, max(h.last_week_visit_cnt) AS last_week_visit_cnt_bao, max(h.visit_cnt) AS visit_cnt_bao,
        max({gap('l.alloc_date', 'h.first_visit_time')}) AS datediff_first_visit_bao, max({gap('l.alloc_date', 'h.last_visit_time')}) AS datediff_last_visit_bao
        FROM lead_tasks l JOIN (SELECT l.user_id, max(h.last_visit_time) AS newest FROM lead_tasks l JOIN visit_bao h
          ON h.user_id = l.user_id AND h.last_visit_time < l.alloc_time GROUP BY l.user_id) m ON m.user_id = l.user_id
        JOIN visit_bao h ON h.user_id = m.user_id AND h.last_visit_time = m.newest GROUP BY l.task_id""",
    "ref_views_day": """SELECT l.user_id, l.alloc_date, min(CAST(operation_time AS DATE)) AS first_day, max(CAST(operation_time AS DATE)) AS last_day,
        count(DISTINCT operation_time) AS total, count(DISTINCT CASE WHEN CAST(operation_time AS DATE) >= alloc_date - 7 THEN operation_time END) AS week,
        count(DISTINCT produ_no) AS products FROM lead_tasks l JOIN page_views v ON v.user_id = l.user_id AND v.operation_time < l.alloc_time
        GROUP BY l.user_id, l.alloc_date""",
    "ref_views": f"""SELECT l.task_id, max(total) AS total_visit_cnt_short, max(week) AS last_week_visit_cnt_short, max(products) AS product_cnt_short,
        max({gap('l.alloc_date', 'first_day')}) AS datediff_first_oper_short, max({gap('l.alloc_date', 'last_day')}) AS datediff_last_oper_short
        FROM lead_tasks l JOIN ref_views_day d ON d.user_id = l.user_id GROUP BY l.task_id""",
    "ref_gifts": """SELECT l.user_id, count(DISTINCT CASE WHEN CAST(g.create_time AS DATE) <= l.alloc_date THEN g.id END) AS gift_insurance_cnt
        FROM lead_tasks l JOIN gift g ON g.user_id = l.user_id GROUP BY l.user_id""",
    "ref_channel": """SELECT user_id, max(channel) AS order_channel FROM gift g
        WHERE create_time = (SELECT max(create_time) FROM gift x WHERE x.user_id = g.user_id) GROUP BY user_id""",
    "ref_follow": f"""SELECT l.user_id, {', '.join(
        f"max(CASE WHEN s.dt <= l.alloc_date - 1 AND {g}_flag = 1 THEN '1' ELSE '0' END) AS {g}_tag" for g in _FOLLOW)}
        FROM lead_tasks l LEFT JOIN subscribed s ON s.user_id = l.user_id WHERE l.user_id IS NOT NULL GROUP BY l.user_id""",
    "features_reference": _mapped(f"""SELECT l.user_id, l.task_id, l.target_user_mobile, l.alloc_date, l.first_chance_name, l.agent_type,
          l.t14_policy_flag, g.* EXCLUDE (task_id), u.device_type, f.* EXCLUDE (user_id),
          {', '.join(f"coalesce({a}, 0) AS {c}" for a, c in [
              (f'{g}.{c}', c) for g, cs in {
                  'cf': ['last_week_visit_cnt_cf', 'visit_cnt_cf', 'visit_case_cnt', 'visit_caseid_num'],
                  'hz': ['last_week_visit_cnt_hz', 'visit_cnt_hz', 'visit_event_cnt', 'visit_payment_cnt'],
                  'b': ['last_week_visit_cnt_bao', 'visit_cnt_bao'],
                  'w': ['total_visit_cnt_short', 'last_week_visit_cnt_short', 'product_cnt_short'],
                  'o': ['gift_insurance_cnt']}.items() for c in cs])},
          cf.datediff_first_visit_cf, cf.datediff_last_visit_cf, hz.datediff_first_visit_hz, hz.datediff_last_visit_hz,
          b.datediff_first_visit_bao, b.datediff_last_visit_bao, w.datediff_first_oper_short, w.datediff_last_oper_short,
          c.order_channel,
          CASE WHEN EXISTS (SELECT 1 FROM app_tag a WHERE a.user_id = l.user_id) THEN 1 ELSE 0 END AS sdb_app_start_flag,
          {gap('l.alloc_date', "(SELECT max(time) FROM share_action s WHERE s.user_id = l.user_id AND s.dt = DATE '" + SNAPSHOT + "')")} AS datediff_lastshare
          FROM (SELECT user_id, task_id, max(target_user_mobile) AS target_user_mobile, max(alloc_date) AS alloc_date,
            max(first_chance_name) AS first_chance_name, max(agent_type) AS agent_type, max(t14_policy_flag) AS t14_policy_flag
            FROM ref_labels GROUP BY user_id, task_id) l
          JOIN lead_tags g ON g.task_id = l.task_id LEFT JOIN user_ua u ON u.user_id = l.user_id
          LEFT JOIN ref_cf cf ON cf.user_id = l.user_id LEFT JOIN ref_hz hz ON hz.user_id = l.user_id
          LEFT JOIN ref_bao b ON b.task_id = l.task_id LEFT JOIN ref_views w ON w.task_id = l.task_id
          LEFT JOIN ref_gifts o ON o.user_id = l.user_id LEFT JOIN ref_channel c ON c.user_id = l.user_id
          LEFT JOIN ref_follow f ON f.user_id = l.user_id""", "unkonwn"),
}


def rule_values() -> str:
    """The deployed points as a relation (variable, lo, hi, category, missing, points)."""
    rows = []
    for variable, table in fx.DEPLOYED_POINTS.items():
        for mark, points in table.items():
            lo = hi = category = "NULL"
            if isinstance(mark, tuple):
                lo, hi = ("NULL" if x is None else str(float(x)) for x in mark)
            elif mark != "missing":
                category = f"'{mark}'"
            rows.append(f"('{variable}', {lo}, {hi}, {category}, {str(mark == 'missing').lower()}, {points})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") r(variable, lo, hi, category, missing, points)"


def _lookup(variable: str, kind: str) -> str:
    value = f"f.{variable}"
    if kind == "text":
        test = f"r.category = {value}"
    else:
        test = (f"((r.missing AND {value} IS NULL) OR (NOT r.missing AND {value} IS NOT NULL "
                f"AND {value} >= coalesce(r.lo, '-infinity'::DOUBLE) AND {value} < coalesce(r.hi, 'infinity'::DOUBLE)))")
    return f"coalesce((SELECT max(points) FROM rules r WHERE r.variable = '{variable}' AND {test}), 0) AS {variable}_score"


SCORED_VARIABLES = list(fx.DEPLOYED_POINTS)
_TEXT = {"wx_city_class", "channel_group"}
CTE["rules"] = rule_values()
CTE["scored"] = f"""SELECT *, CAST({' + '.join(v + '_score' for v in SCORED_VARIABLES)} + {fx.BASE_POINTS} AS INTEGER) AS total_score
    FROM (SELECT f.*, {', '.join(_lookup(v, 'text' if v in _TEXT else 'number') for v in SCORED_VARIABLES)} FROM features f
          WHERE most_visit_city_class IS NOT NULL)"""
CTE["ranked"] = """SELECT row_number() OVER (ORDER BY total_score DESC, last_visit_time DESC NULLS LAST, user_id NULLS LAST, task_id)
    AS lead_rank, total_score, user_id, task_id, t14_policy_flag, last_visit_time FROM scored"""

def variant(goal: str, replaced: dict[str, str], suffix: str) -> dict[str, str]:
    """``goal`` and all it is made of once more, under names with ``suffix``, on other versions of some relations."""
    out: dict[str, str] = {}

    def visit(name: str) -> bool:
        """Whether the relation changes, and so stands under the new name."""
        if name + suffix in out:
            return True
        if name in replaced:
            out[name + suffix] = replaced[name]
            return True
        text = CTE[name]
        changed = [w for w in dict.fromkeys(_WORD.findall(text)) if w in CTE and w != name and visit(w)]
        if not changed:
            return False
        out[name + suffix] = re.sub(r"\b(" + "|".join(changed) + r")\b(?!\.)", rf"\1{suffix}", text)
        return True

    visit(goal)
    return out


_WORD = re.compile(r"\b[a-z_][a-z_0-9]*\b")


def statement(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the common table expressions it uses, in an order that resolves."""
    known = CTE | (extra or {})
    needed: list[str] = []

    def visit(text: str, self_name: str | None = None) -> None:
        for word in dict.fromkeys(_WORD.findall(text)):
            if word in known and word != self_name and word not in needed:
                visit(known[word], word)
                if word not in needed:
                    needed.append(word)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + "\n" + body
