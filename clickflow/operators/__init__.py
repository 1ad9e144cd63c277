"""The jobs, as DataFrame -> DataFrame functions with plain arguments."""

from clickflow.operators.ads import (
    ad_click_trend,
    ad_click_trend_by_arrival,
    ad_click_trend_json,
    ad_click_trend_windows,
    ads_daily_clicks,
    province_ad_clicks,
    province_top_ads,
    province_top_ads_json,
    rank_province_ads,
)
from clickflow.operators.blacklist import (
    accepted_clicks,
    blacklisted_users,
    first_bans,
    over_threshold,
    user_ad_daily_clicks,
)
from clickflow.operators.categories import category_action_counts, category_top_n, rank_categories
from clickflow.operators.filters import action_kind, filter_time_range
from clickflow.operators.pagejump import (
    flow_pairs,
    page_jump_counts,
    page_jump_rate,
    page_view_counts,
    session_page_pairs,
)
from clickflow.operators.sessions import category_session_top_n

__all__ = [
    "filter_time_range",
    "action_kind",
    "category_action_counts",
    "rank_categories",
    "category_top_n",
    "category_session_top_n",
    "session_page_pairs",
    "flow_pairs",
    "page_jump_counts",
    "page_view_counts",
    "page_jump_rate",
    "ads_daily_clicks",
    "province_ad_clicks",
    "rank_province_ads",
    "province_top_ads",
    "province_top_ads_json",
    "ad_click_trend",
    "ad_click_trend_by_arrival",
    "ad_click_trend_json",
    "ad_click_trend_windows",
    "user_ad_daily_clicks",
    "over_threshold",
    "blacklisted_users",
    "first_bans",
    "accepted_clicks",
]
