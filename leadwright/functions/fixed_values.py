"""Fixed values of the business domain: results depend on them, so they are stated as given."""

from __future__ import annotations

# --- Fixed values: campaign and source filters -------------------------------------------------
CAMPAIGN_MARK = "free_insurance"
CONNECTED_STATUS = "both_connected"
SERVICE_TEAM_MARK = "Customer Service"
SERVICE_TEAM_NAME = "Customer Service Team"
POLICY_STATUS = [3, 4, 6]
LABEL_HORIZONS = [7, 14]
SUBSCRIPTION_CODES = {
    "follow_hz_flag": [1, 104, 309],
    "follow_cf_flag": [3, 17, 61, 115, 116],
    "follow_sdb_flag": [7, 420],
}
PRODUCT_CODES = [f"prod_{i:02d}" for i in range(1, 18)]
PAGE_BIZ = "ins"
PAGE_OPERATION = ["page_enter"]

# --- Fixed values: category maps, (label, [(operator, value), ...]), first match wins ------------
CHANNEL_TYPE_INITIAL = [
    ("Ads", [("in", ["feed", "sem", "qywx", "dy", "DY"])]),
    ("Community", [("in", ["huzhusq", "sdbsqnew", "lujiekz"]), ("prefix", "SQ"), ("prefix", "lesson")]),
]
CHANNEL_TYPE_INITIAL_ELSE = "Normal"
CHANNEL_TYPE_FINAL = [
    ("Ads", [("in", ["feed", "sem"]), ("contains", "BD")]),
    ("Internal", [("in", ["cf", "sdhz", "sdbao"]), ("contains", "app")]),
    ("Community", [("in", ["qywx"])]),
]
CHANNEL_TYPE_FINAL_ELSE = "Others"
CHANNEL_GROUP_FINAL = [
    ("feed", [("in", ["feed"])]),
    ("cf", [("in", ["cf"])]),
    ("sdhz", [("in", ["sdhz"])]),
    ("qywx", [("in", ["qywx"])]),
    ("BD", [("contains", "BD")]),
    ("sdbao", [("contains", "app"), ("in", ["sdbao"])]),
]
CHANNEL_GROUP_FINAL_ELSE = "others"
OPERATOR_MAP = [
    ("Operator_A", [("in", ["移动"])]),
    ("Operator_B", [("in", ["联通"])]),
    ("Operator_C", [("in", ["电信"])]),
]
OPERATOR_ELSE = "others"

# --- Fixed values: city tiers ---------------------------------------------------------------------
TIER_1_CITIES = ["北京", "上海", "广州", "深圳"]
NEW_TIER_1_CITIES = ["成都", "杭州", "重庆", "武汉", "苏州", "西安", "天津", "南京", "郑州", "长沙", "沈阳", "青岛", "宁波", "东莞", "无锡"]
ID_CITY_TIERS = [
    ("Tier_1", [("regex", "|".join(TIER_1_CITIES))]),
    ("New_Tier_1", [("regex", "|".join(NEW_TIER_1_CITIES))]),
]
VISIT_CITY_TIERS = [("Tier_1", [("regex", "|".join(TIER_1_CITIES))])]
TIER_ELSE = "others"
TIER_UNKNOWN = "unknown"
TIER_UNKNOWN_MISSPELT = "unkonwn"  # the mobility flags are delivered with this spelling
LOWER_TIERS = ["New_Tier_1", "Tier_2", "Tier_3", "Tier_4", "Tier_5", "others"]
CITY_CLASSES = ["New_Tier_1", "Tier_1", "Tier_2", "Tier_3", "Tier_4", "Tier_5", "others", "unknown"]

# --- Fixed values: column names of the feature table -----------------------------------------------
ID_COLUMNS = ["user_id", "task_id", "target_user_mobile"]
TARGET = "t14_policy_flag"
CITY_COLUMNS = {  # tag column -> class column
    "id_city_name": "id_city_class",
    "register_city": "register_city_class",
    "most_visit_city": "most_visit_city_class",
    "wx_city": "wx_city_class",
    "last_visit_city": "last_visit_city_class",
    "mobile_city": "mobile_city_class",
}
KEEP_NULL_TAGS = ["os_type", "id_age", "id_gender", "wx_sex", "author_flag"]
ZERO_FILL_TAGS = [
    "donate_case_num", "donate_amt", "donate_cnt",
    "cf_fst_donate_amt", "cf_min_donate_amt", "cf_max_donate_amt", "cf_last_donate_amt",
    "sdb_order_num", "sdb_order_amt", "sdb_normal_order_num", "sdb_normal_order_amt",
    "sdb_pay_order_amt", "sdb_normal_pay_order_amt",
    "hz_order_num", "hz_eff_order_num", "hz_user_advance_flag", "hz_total_charge_cnt",
    "hz_total_charge_amt", "hz_total_pay_amt", "hz_total_bal_amt", "hz_fst_join_amt",
    "hz_insu_type_cnt", "hz_insu_20_cnt", "hz_insu_1_cnt", "hz_insu_2_cnt", "hz_insu_3_cnt",
    "hz_insu_4_cnt", "hz_insu_21_cnt",
]
FLAG_FILL_TAGS = [
    "is_add_hz_flag", "hz_insu_20_flag", "hz_insu_1_flag", "hz_insu_2_flag", "hz_insu_3_flag",
    "hz_insu_4_flag", "hz_insu_21_flag",
]
TAG_TIMES = {  # tag time column -> recency column
    "cf_fst_donate_time": "datediff_cf_fst_donate",
    "cf_last_donate_time": "datediff_cf_lst_donate",
    "hz_fst_join_time": "datediff_hz_fst_join",
}

# --- Fixed values: model settings --------------------------------------------------------------------
SPLIT_RATIO = 0.7
SPLIT_SEED = 20200107
L1_C = 0.1
POINTS0 = 600
ODDS0 = 1 / 19
PDO = 50
NOT_BINNED = [
    "device_type", "alloc_date", "first_chance_name", "agent_type", "datediff_lastshare",
    "sdb_normal_order_amt", "sdb_normal_order_num", "sdb_normal_pay_order_amt",
    "sdb_order_amt", "sdb_order_num", "sdb_pay_order_amt",
]
BREAKS = {
    "author_flag": [1],
    "cf_fst_donate_amt": [1, 15, 50],
    "cf_last_donate_amt": [1, 15, 50],
    "cf_max_donate_amt": [1, 15, 25, 100],
    "cf_min_donate_amt": [1, 6, 20, 50],
    "channel_group": ["sdbao", "sdhz", "cf", "feed", "BD", "others", "qywx"],
    "channel_type": ["Internal", "Ads", "Community", "Others"],
    "datediff_cf_fst_donate": ["missing", 181, 361, 541, 721],
    "datediff_first_visit_bao": ["missing", 10, 80, 270],
    "datediff_last_visit_hz": ["missing", 91, 181, 361],
    "datediff_first_oper_short": ["missing", 2, 5, 8],
    "donate_amt": [1, 50, 100, 150],
    "hz_order_num": [1, 2, 3, 5],
    "hz_total_bal_amt": [1, 4],
    "hz_total_charge_amt": [1, 14, 62],
    "id_age": ["missing", 18, 24, 31, 41, 50],
    "id_city_class": CITY_CLASSES,
    "last_visit_city_class": CITY_CLASSES,
    "mobile_city_class": CITY_CLASSES,
    "most_visit_city_class": CITY_CLASSES,
    "wx_city_class": CITY_CLASSES,
    "id_gender": ["missing", "M", "F"],
    "wx_sex": ["unknown", "M", "F"],
    "mobile_operator": ["Operator_A", "Operator_C", "Operator_B", "others"],
    "total_visit_cnt_short": [1, 2, 3],
    "visit_cnt_bao": [7, 16, 25],
    "visit_cnt_hz": [1, 6, 12, 22, 66],
}
SELECTED = [
    "wx_city_class", "channel_group", "id_age", "hz_total_bal_amt", "total_visit_cnt_short",
    "sdb_app_start_flag", "datediff_last_visit_hz", "hz_eff_order_num",
]

# --- Fixed values: deployed points, {variable: {label or (from, to): points}} ---------------------------
# An interval contains its lower end. Anything not listed gets 0 points.
BASE_POINTS = 327
DEPLOYED_POINTS = {
    "wx_city_class": {
        "New_Tier_1": 36, "Tier_1": 27, "Tier_2": 25, "Tier_3": 30,
        "Tier_4": 36, "Tier_5": 51, "others": 34, "unknown": -81,
    },
    "channel_group": {
        "sdbao": 32, "sdhz": 24, "cf": -8, "feed": 1, "BD": -19, "others": -13, "qywx": 156,
    },
    "id_age": {
        "missing": -97, (None, 18): 12, (18, 24): 13, (24, 31): -9, (31, 41): -1, (41, 50): 3, (50, None): 0,
    },
    "hz_total_bal_amt": {(None, 1): -1, (1, 4): -1, (4, None): 8},
    "total_visit_cnt_short": {(None, 1): -5, (1, 2): -8, (2, 3): 4, (3, None): 20},
    "sdb_app_start_flag": {(None, 1): -1, (1, None): 55},
}

# --- Fixed values: monitoring limits -------------------------------------------------------------------
KS_FLOOR = 0.30
AUC_FLOOR = 0.65
WEEKS_BELOW = 2
PSI_CEILING = 0.20
MATURATION_DAYS = 14
TOP_SHARE = 0.30
