"""Job runners (source -> operator -> sink) and plan inspection helpers."""

from clickflow.plans.inspect import count_nodes, plan_text
from clickflow.plans.jobs import run_category_session_top, run_category_top, run_page_jump_rate

__all__ = [
    "plan_text",
    "count_nodes",
    "run_category_top",
    "run_category_session_top",
    "run_page_jump_rate",
]
