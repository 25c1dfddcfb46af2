"""Schemas of the fixed-layout inputs and of the long-lived tables."""

OFFER_CONTROL = """
    offer string, uc1_priority int, active_flg_kd int, active_flg_fb int, active_flg_pt int,
    screen_size double, rrp int, apollo_price int, min_pack int,
    start_year string, start_month string, start_day string,
    end_year string, end_month string, end_day string,
    target_rlp_min int, target_rlp_max int,
    min_ctr string, min_landings string, min_submits string, min_s2l string, max_cps string
"""

DEVICE_CLUSTERS = """
    model string, reach double, marketing_name string, vendor string, price_released double,
    year_released double, month_released double, time_released double,
    diagonal_screen_size double, camera_pixels double, display_height double,
    display_width double, age double, clusterscrcam_km7 double
"""

FEEDBACK = """
    sighted_date date, offer string, source string, hl_platform string, dvc_techname string,
    imps bigint, clicks bigint, landings bigint, submits bigint, year int, month int, day int
"""

RULES = """
    source string, offer string, uc1_priority int, rule string, year int, month int, day int
"""

PARTITION = ["year", "month", "day"]
